"""Runs one registered query over a folder of Parquet tables and writes its rows.

``python -m linefold QUERY --input FOLDER [--output FOLDER] [--format F] [--report FILE] [--gate]``

``python -m linefold TOOL ...`` runs a command over files (:mod:`linefold.tools`).

With ``--gate`` the exit code is 1 where a column ``verdict`` says FAIL or a column
``passed`` is false, after the rows were written.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import catalog, tools
from .sources import files


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="linefold", description=__doc__.splitlines()[0])
    p.add_argument("query", choices=sorted(catalog.QUERIES), metavar="QUERY")
    p.add_argument("--input", required=True)
    p.add_argument("--output")
    p.add_argument("--format", choices=["parquet", "csv", "json"], default="parquet")
    p.add_argument("--overwrite", action="store_true", help="replace what is in the output folder")
    p.add_argument("--report", help="write a Markdown table of a small result")
    p.add_argument("--gate", action="store_true")
    return p.parse_args(given)


def main(given: list[str] | None = None, spark: SparkSession | None = None) -> int:
    given = sys.argv[1:] if given is None else given
    if given and given[0] in tools.TOOLS:
        return tools.main(given, spark)
    a = arguments(given)
    spark = spark or SparkSession.builder.appName(f"linefold {a.query}").getOrCreate()
    rows = catalog.QUERIES[a.query](spark, a.input)
    if a.output:
        writer = rows.write.mode("overwrite" if a.overwrite else "errorifexists").format(a.format)
        (writer.option("header", True).option("escape", '"') if a.format == "csv" else writer).save(a.output)
    if a.report:
        with open(a.report, "w", encoding="utf-8") as f:
            f.write(files.markdown(rows, a.query))
    if not a.output and not a.report and not a.gate:
        rows.show(20, truncate=False)
    if not a.gate:
        return 0
    failed = [F.col(c) == F.lit(v) for c, v in (("verdict", "FAIL"), ("passed", False)) if c in rows.columns]
    if not failed:
        raise ValueError(f"{a.query} has neither verdict nor passed")
    return int(any(not rows.where(x).isEmpty() for x in failed))


if __name__ == "__main__":
    sys.exit(main())
