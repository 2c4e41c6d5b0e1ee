"""Degradation over the pixel fixture: embeddings taken as 8 by 8 gray images."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import lines
from . import raster
from .degrade import PROFILES, degrade


def degraded_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each image, tripled in both directions, with a profile by its number."""
    value = lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor(160 + 50 * (1 + F.col("vec_id") % 8) * x.cast("double")).cast("int")))
    byte = lambda x: F.repeat(F.lpad(F.hex(value(x)), 2, "0"), 3)
    line = lambda i: F.repeat(F.array_join(F.transform(F.slice("embedding", i * 8 + 1, 8), byte), ""), 3)
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    names = F.array(*[F.lit(p) for p in PROFILES])
    images = rows.select(
        F.col("vec_id").alias("row_id"), names[(F.col("vec_id") % len(PROFILES)).cast("int")].alias("profile"), F.lit(24).alias("height"), F.lit(24).alias("width"),
        F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), line), "")).alias("data"),
    )
    return degrade(images).select("row_id", "profile", "attempts", F.round("contrast", 6).alias("contrast"), "score", "risk", "clipped", F.sha2("data", 256).alias("pixels"))


def rendered_lines(run):
    """Labels drawn in a font that lacks some characters, sizes drawn by plan."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        drawn = raster.render(run(lambda d: f"select line_id, t from ({lines.labels(d)})")(spark, sf_dir), font=3, digest=True)
        return drawn.select("line_id", "renderer", "reason", "height", "width", "pixels")

    return query


def build(run) -> dict:
    return {"degraded_images": degraded_images, "rendered_lines": rendered_lines(run)}
