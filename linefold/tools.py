"""Commands over files: images, quality, audit, charset, manifest, inspect.

``python -m linefold TOOL ...``; each reads CSV or Parquet, writes its result and a Markdown
report, and ends with code 1 where its gate fails, before anything that depends on the gate
is written.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.dialect import Spark
from .operators import raster
from .operators.degrade import PROFILES, degrade
from .plans import gates
from .sources import files

#: Rows of a smoke test.
SMOKE = 10


def rows_of(spark: SparkSession, path: str) -> DataFrame:
    """A table from CSV (every column text) or from Parquet."""
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"') if path.rstrip("/").endswith(".csv") else spark.read.parquet(path)


def asked(rows: DataFrame, gate, **columns: str) -> DataFrame:
    """A gate over rows, some columns of which have other names."""
    given = {v: k for k, v in columns.items() if v in rows.columns and v != k}
    rows.withColumnsRenamed(given).createOrReplaceTempView("_judged")
    return rows.sparkSession.sql(gate(Spark, "select * from _judged"))


def wrote(path: str | None, text: str) -> None:
    if path:
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
    else:
        print(text)


def profile_of(config: dict, seed: int):
    """A profile for each line_id, drawn by the config's ``profile_weights`` (else evenly)."""
    weights = config.get("profile_weights") or {p: 1 for p in PROFILES}
    if unknown := sorted(set(weights) - set(PROFILES)):
        raise ValueError(f"unknown profiles: {unknown}")
    u = F.expr(Spark.draw(f"'{seed}'", "'profile'", "line_id")) / F.lit(float(1 << 32)) * F.lit(float(sum(weights.values())))
    out, below = F.lit(list(weights)[-1]), sum(weights.values())
    for name in reversed(weights):
        below -= weights[name]
        out = F.when(u < below + weights[name], F.lit(name)).otherwise(out)
    return out


def images(spark: SparkSession, a: argparse.Namespace) -> int:
    """Draws and degrades labels as PNG files, with their metadata."""
    labels = rows_of(spark, a.labels)
    if a.split:
        labels = labels.where(F.col("split") == a.split)
    if a.only_has_digit:
        labels = labels.where(F.lower(F.col("has_digit").cast("string")) == "true")
    if a.limit or a.smoke_test:
        labels = labels.orderBy("line_id").limit(min(a.limit or SMOKE, SMOKE if a.smoke_test else a.limit))
    config = files.yaml_config(spark, a.config) if a.config else {}
    font = config.get("font", -1)
    drawn = raster.render(labels.select("line_id", F.col("text" if "text" in labels.columns else "t").alias("t")), font, config.get("font_size", 24), prefer=a.renderer)
    good = drawn.where("reason = 'ok'").select(F.xxhash64("line_id").alias("row_id"), profile_of(config, a.seed).alias("profile"), "height", "width", "data", "line_id")
    done = degrade(good, a.seed, keep=("line_id",))
    if not a.allow_unreadable_risk:
        done = done.where("not risk")
    done = done.withColumn("name", F.concat("line_id", F.lit("_"), F.regexp_extract("profile", "^(D[0-9]+)", 1)))
    folder = f"{a.output.rstrip('/')}/{a.output_subdir}"
    measures = done.drop("data", "row_id").withColumn("image_path", F.concat(F.lit(f"{a.output_subdir}/"), "name", F.lit(".png"))).drop("name")
    files.write_png(done, folder).write.mode("overwrite" if a.overwrite else "errorifexists").parquet(f"{a.output.rstrip('/')}/{a.output_subdir}.written")
    measures.join(labels, "line_id").write.mode("overwrite" if a.overwrite else "errorifexists").parquet(a.metadata_out)
    wrote(a.report, files.report("Images", [("Reasons", drawn.groupBy("reason").count().orderBy("reason")), ("Profiles", spark.read.parquet(a.metadata_out).groupBy("profile").agg(F.count("*").alias("n"), F.round(F.avg("score"), 2).alias("score")).orderBy("profile"))]))
    return 0


def quality(spark: SparkSession, a: argparse.Namespace) -> int:
    """Measures of all images of a folder; fails if one cannot be read or is a risk."""
    plain = files.png_pixels(spark, a.images).select(F.xxhash64("name").alias("row_id"), F.lit("D0_clean_print").alias("profile"), "height", "width", "data", "name")
    found = degrade(plain, keep=("name",)).select("name", "contrast", "score", "risk", "clipped")
    if a.output:
        found.write.mode("overwrite").parquet(a.output)
    summary = found.agg(F.count("*").alias("n"), F.count_if("risk").alias("risks"), F.count_if("clipped").alias("clipped"), F.count_if(F.col("score").isNull()).alias("unreadable"), F.round(F.avg("score"), 2).alias("score"))
    wrote(a.report, files.report("Quality", [("Summary", summary)]))
    one = summary.first()
    return int(one.n == 0 or one.risks > 0 and not a.allow_unreadable_risk or one.unreadable > 0)


def audit(spark: SparkSession, a: argparse.Namespace) -> int:
    found = asked(rows_of(spark, a.metadata), gates.audit, original="source_text_original", rendered="source_text_rendered")
    wrote(a.report, files.report("Audit", [("Counters", found)]))
    return int(found.first().verdict != "PASS")


def charset(spark: SparkSession, a: argparse.Namespace) -> int:
    """The vocabulary of labels as JSON, if its gate passes or ``--force``."""
    labels = rows_of(spark, a.labels)
    labels.select("line_id", F.col("text" if "text" in labels.columns else "t").alias("t")).createOrReplaceTempView("_labels")
    counted = spark.sql(f"select ch, count(*) as freq from ({Spark.chars('_labels', 'line_id')}) group by ch")
    order = F.row_number().over(Window.orderBy(F.ascii("ch")))  # at most one row for each code point
    counted.select(order.alias("char_id"), "ch", "freq").createOrReplaceTempView("_chars")
    gate = spark.sql(gates.charset(Spark, "select * from _labels", "select char_id, ch from _chars"))
    one = gate.first()
    names = files.char_names(spark.table("_chars")).orderBy(F.desc("freq"), "ch")
    wrote(a.report, files.report("Vocabulary", [("Gate", gate), ("Most frequent", names.limit(50)), ("Punctuation", names.where("punctuation"))]))
    if one.passed or a.force:
        files.write_charset(spark.table("_chars").select("char_id", "ch"), a.output)
    return int(not one.passed)


def manifest(spark: SparkSession, a: argparse.Namespace) -> int:
    """The manifest in whole and by split; nothing is written if a required value lacks."""
    rows = rows_of(spark, a.metadata)
    listed = files.png_pixels(spark, a.images).select(F.concat("name", F.lit(".png")).alias("_name"), F.lit(True).alias("present"))
    joined = rows.join(listed, F.element_at(F.split("image_path", "/"), -1) == F.col("_name"), "left").drop("_name").withColumn("present", F.coalesce("present", F.lit(False)))
    if "variant_index" not in joined.columns:
        joined = joined.withColumn("variant_index", F.lit(1))
    gate = asked(joined, gates.manifest, text="t")
    by = joined.groupBy("split", "domain").count().orderBy("split", "domain") if "domain" in joined.columns else joined.groupBy("split").count().orderBy("split")
    wrote(a.report, files.report("Manifest", [("Counters", gate), ("Rows", by)]))
    if not gate.first().passed:
        return 1
    files.write_manifest(joined.drop("present"), a.output)
    return 0


def inspect(spark: SparkSession, a: argparse.Namespace) -> int:
    """Row problems of stored labels; fails if there is one."""
    found = asked(rows_of(spark, a.labels), gates.row_problems, text="t").where("problems <> ''")
    wrote(a.report, files.report("Labels", [("Problems", found.groupBy("problems").count().orderBy(F.desc("count"), "problems").limit(a.limit or 50))]))
    return int(not found.isEmpty())


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="linefold", description=__doc__.splitlines()[0])
    sub = p.add_subparsers(dest="tool", required=True)

    def tool(run, *required: str):
        t = sub.add_parser(run.__name__, help=(run.__doc__ or "Checks metadata of images.").splitlines()[0])
        for name in required:
            t.add_argument(f"--{name}", required=True)
        t.add_argument("--report", help="a Markdown file; printed if not given")
        t.set_defaults(run=run)
        return t

    t = tool(images, "labels", "output", "metadata-out")
    t.add_argument("--output-subdir", default="images")
    t.add_argument("--split", choices=["train", "val", "test"])
    t.add_argument("--limit", type=int)
    t.add_argument("--seed", type=int, default=42)
    t.add_argument("--config", help="YAML with font, font_size and profile_weights")
    t.add_argument("--renderer", default="auto", choices=["auto", *raster.RENDERERS])
    for flag in ("smoke-test", "overwrite", "allow-unreadable-risk", "only-has-digit"):
        t.add_argument(f"--{flag}", action="store_true")
    t = tool(quality, "images")
    t.add_argument("--output")
    t.add_argument("--allow-unreadable-risk", action="store_true")
    tool(audit, "metadata")
    tool(charset, "labels", "output").add_argument("--force", action="store_true")
    tool(manifest, "metadata", "images", "output")
    tool(inspect, "labels").add_argument("--limit", type=int)
    return p


TOOLS = ("images", "quality", "audit", "charset", "manifest", "inspect")


def main(given: list[str], spark: SparkSession | None = None) -> int:
    a = parser().parse_args(given)
    return a.run(spark or SparkSession.builder.appName(f"linefold {a.tool}").getOrCreate(), a)
