"""All registered queries and the SQL that gives the same rows."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .functions.dialect import Arrow, Duck
from .operators import pieces
from .operators import queries as pixels
from .plans import coverage, gates, images, lines, loader, rules
from .sources import queries as through_files

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: A table below this many bytes may be one split that a single core would read; its
#: rows are dealt to all cores before the line rules.  Larger scans are never shuffled.
SPREAD_BYTES = 256 << 20

#: A kernel and its rows, without another kernel inside.
KERNEL = re.compile(r"/\*in ([\w ]+)\*/((?:(?!/\*in ).)*?)/\*out\*/", re.DOTALL)

PLANS = {**lines.PLANS, **images.PLANS, **rules.PLANS, **coverage.PLANS, **gates.PLANS, **loader.PLANS}


def tables_of(sql: str) -> list[str]:
    """The test tables that a plan reads."""
    return [t for t in TABLES if re.search(rf"\b(?:from|join) {t}\b", sql)]


def spread(spark: SparkSession, path: str) -> str:
    """The hint that deals a small table's rows to all cores, or none."""
    size = spark.read.parquet(path)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return f"/*+ REPARTITION({spark.sparkContext.defaultParallelism}) */" if int(str(size)) < SPREAD_BYTES else ""


def resolved(spark: SparkSession, sql: str) -> DataFrame:
    """The rows of a plan that names kernels, innermost first.  What a kernel gives is a
    view while the plan around it is analysed; its name is used once."""
    views = []
    try:
        while found := KERNEL.search(sql):
            name, *also = found[1].split()
            views.append(f"kernel_{uuid.uuid4().hex}")
            pieces.KERNELS[name](spark.sql(found[2]), *also).createOrReplaceTempView(views[-1])
            sql = sql.replace(found[0], views[-1])
        return spark.sql(sql)
    finally:
        for view in views:
            spark.catalog.dropTempView(view)


def query(plan: Callable) -> Callable[[SparkSession, str], DataFrame]:
    """A plan as a query over the Parquet tables of a folder.

    The tables are named by path inside the plan, so nothing is registered in the
    session and two folders can be read at a time.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sql = plan(Arrow)
        if "/*spread*/" in sql:
            sql = sql.replace("/*spread*/", spread(spark, f"{sf_dir.rstrip('/')}/documents.parquet"))
        for name in tables_of(sql):
            sql = re.sub(rf"\b(from|join) {name}\b", rf"\1 parquet.`{sf_dir.rstrip('/')}/{name}.parquet`", sql)
        return resolved(spark, sql)

    return run


_FILE_QUERIES, _FILE_SQL = through_files.build(query)
QUERIES = {**{name: query(plan) for name, plan in PLANS.items()}, **_FILE_QUERIES, **pixels.build(query)}
SQL = {**{name: plan(Duck) for name, plan in PLANS.items()}, **_FILE_SQL}
