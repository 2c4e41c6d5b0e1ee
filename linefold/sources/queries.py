"""Queries that pass through files: written, read back and compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dialect import Duck
from ..plans import images, lines, rules
from ..streaming import dedup
from . import files

LABELS = "line_id string, source_id string, t string, domain string, split string, line_length int, has_danda boolean, has_double_danda boolean, has_digit boolean, has_conjunct boolean"


def build(run) -> tuple[dict, dict]:
    """The queries and their SQL; ``run`` makes a query of a plan."""
    labels = run(lines.PLANS["label_rows"])
    tagged_labels = run(lambda d: f"select line_id, t, domain from ({lines.labels(d)})")

    def scan_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
        at = files.work_folder(spark)
        files.write_csv(labels(spark, sf_dir), at, [c.split()[0] for c in LABELS.split(", ")], ["line_id"])
        return files.csv_rows(spark, at, LABELS)

    def ingest_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
        at, parts = files.work_folder(spark), ["en", "fr"]
        rows = tagged_labels(spark, sf_dir).where(F.col("domain").isin(parts))
        rows.write.partitionBy("domain").csv(f"{at}/all", header=True, escape='"')
        paths = {part: files.existing(spark, f"{at}/all/domain={part}", "line_id string, t string") for part in parts}
        return files.tagged(spark, {path: part for part, path in paths.items()}, "line_id string, t string")

    def split_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
        at = files.work_folder(spark)
        files.write_manifest(labels(spark, sf_dir).select("line_id", F.upper("split").alias("split")), at)
        return spark.read.parquet(f"{at}/by_split").select("line_id", F.col("split_name").cast("string").alias("split_name"))

    def nfc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select("doc_id", files.nfc(F.col("text")).alias("text"))

    def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
        at = files.work_folder(spark)
        run(lines.PLANS["scan_lines"])(spark, sf_dir).select("t").write.parquet(f"{at}/in")
        dedup.drain(dedup.first_texts(spark, f"{at}/in", "t string"), f"{at}/out", f"{at}/state")
        return spark.read.parquet(f"{at}/out")

    def ingest_part(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Two parts of which the second is missing, as one table."""
        at, schema = files.work_folder(spark), "line_id string, t string"
        labels(spark, sf_dir).where("split = 'val'").select("line_id", "t").write.csv(f"{at}/first", header=True, escape='"')
        found = [files.optional_part(spark, f"{at}/{name}", schema, i, f"round_{i}") for i, name in enumerate(("first", "second"), 1)]
        return found[0].unionByName(found[1])

    def split_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
        at = files.work_folder(spark)
        number = F.regexp_extract("source", "([0-9]+)$", 1).cast("int") % 10
        split = F.when(number <= 7, " train").when(number == 8, "val ").otherwise("test")
        sources = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select("source").distinct()
        sources.select(F.col("source").alias("source_id"), split.alias("split_group")).write.csv(at, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        return files.split_mapping(spark, at)

    def charset_load(spark: SparkSession, sf_dir: str) -> DataFrame:
        at = files.work_folder(spark)
        files.write_charset(run(lines.PLANS["charset_ids"])(spark, sf_dir), at)
        return files.charset_rows(spark, at)

    def missing_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Manifest images of which only the first variant is on the list of files."""
        rows = run(rules.PLANS["image_names"])(spark, sf_dir)
        listed = rows.where("variant_index = 1").select(F.concat(F.lit("/images/"), "image_path").alias("path"))
        return files.missing_paths(rows, listed).select("line_id", "variant_index")

    def char_names(spark: SparkSession, sf_dir: str) -> DataFrame:
        return files.char_names(run(lines.PLANS["charset_ids"])(spark, sf_dir).select("char_id", "ch"))

    def png_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The pixel fixture as PNG files, read again: measures of the decoded pixels."""
        at = files.work_folder(spark)
        value = lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor(160 + 50 * (1 + F.col("vec_id") % 8) * x.cast("double")).cast("int")))
        rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
        pictures = rows.select(F.col("vec_id").alias("name"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.unhex(F.array_join(F.transform("embedding", lambda x: F.lpad(F.hex(value(x)), 2, "0")), "")).alias("data"))
        files.write_png(pictures, at).write.format("noop").mode("overwrite").save()
        byte = "transform(sequence(1, length(data)), i -> cast(conv(hex(substring(data, i, 1)), 16, 10) as bigint))"
        return files.png_pixels(spark, at).select(F.col("name").cast("long").alias("vec_id"), "height", "width", F.expr(f"aggregate({byte}, 0L, (a, x) -> a + x)").alias("total"), F.expr(f"array_max({byte})").alias("brightest"))

    own = lines.PLANS["label_rows"](Duck)
    sql = {
        "scan_labels": own,
        "ingest_tagged": f"select line_id, t, domain from ({own}) where domain in ('en', 'fr')",
        "split_manifest": f"select line_id, split as split_name from ({own})",
        "nfc_text": "select doc_id, nfc_normalize(text) as text from documents",
        "ingest_part": f"select line_id, t, 1 as variant_index, 'round_1' as generation_round from ({own}) where split = 'val'",
        "split_mapping": "select distinct source as source_id, case when cast(regexp_extract(source, '([0-9]+)$', 1) as int) % 10 <= 7 then 'train' when cast(regexp_extract(source, '([0-9]+)$', 1) as int) % 10 = 8 then 'val' else 'test' end as split from documents",
        "charset_load": f"select char_id, ch from ({lines.PLANS['charset_ids'](Duck)})",
        "missing_paths": f"select line_id, variant_index from ({rules.PLANS['image_names'](Duck)}) where variant_index <> 1",
        "png_roundtrip": f"select vec_id, 8 as height, 8 as width, cast(sum(v) as bigint) as total, cast(max(v) as bigint) as brightest from ({images.pixels(Duck)}) group by vec_id",
        "stream_dedup": f"select distinct t from ({lines.lines(Duck)})",
    }
    found = {f.__name__: f for f in (scan_labels, ingest_tagged, ingest_part, split_manifest, split_mapping, charset_load, missing_paths, nfc_text, stream_dedup, char_names, png_roundtrip)}
    return found, sql
