"""Contiguous shards of near-equal bytes from global prefix sums.

Rows are ordered over the whole table, each partition reports its totals, and the
driver turns those (one row per partition) into offsets; a second look at each
partition gives every row its global byte offset and row number.  A row belongs to
the shard in which the middle of its bytes falls; a cut that would split a group of
rows moves to the nearer end of the group, if that is close.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, stable, table

#: How far a cut may move to spare a group, as a share of a shard's bytes.
SLACK = 0.01


def assign(rows: DataFrame, size: Column, order: list[str], shards: int, grouped: bool = False) -> DataFrame:
    """``rows`` with ``size, shard, slot``: ``shards`` contiguous runs in ``order``.

    ``size`` must not be null and at least 1.  Rows that tie in ``order`` may swap
    places among themselves; the order should end in a unique key.  An empty table
    gives an empty result.  Only ``rows`` itself is shuffled, so pass light columns.
    With ``grouped``, rows that agree in the first column of ``order`` (a string) are a
    group: it stays in one shard where a cut need not move by more than ``SLACK``.
    """
    spark = rows.sparkSession
    ordered = rows.withColumn("size", size.cast("long")).repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    ordered = stable(ordered.withColumn("_part", F.spark_partition_id()))
    totals = ordered.groupBy("_part").agg(F.sum("size"), F.count("*")).orderBy("_part").collect()
    parts = [t[0] for t in totals]
    bytes_before = dict(zip(parts, accumulate([t[1] for t in totals], initial=0)))
    rows_before = dict(zip(parts, accumulate([t[2] for t in totals], initial=0)))
    total = sum(t[1] for t in totals)
    size_at, part_at = ordered.columns.index("size"), ordered.columns.index("_part")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        """Each batch with the global begin in bytes and the number of each row."""
        now: dict[int, list[int]] = {}
        for batch in batches:
            part, sizes = batch.column(part_at).to_numpy(), batch.column(size_at).to_numpy()
            runs = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            begin, place = np.empty(len(part), np.int64), np.empty(len(part), np.int64)
            for a, b in zip(runs, runs[1:]):
                if a == b:
                    continue
                at = now.setdefault(int(part[a]), [bytes_before[int(part[a])], rows_before[int(part[a])]])
                ends = at[0] + np.cumsum(sizes[a:b])
                begin[a:b] = ends - sizes[a:b]
                place[a:b] = at[1] + np.arange(b - a)
                at[0], at[1] = int(ends[-1]), at[1] + b - a
            yield batch, begin, place

    cuts = [-(-total * k // shards) for k in range(1, shards)]
    if grouped and total:
        cuts = _spared(ordered, order[0], places, cuts, SLACK * total / shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doubled = 2 * np.array(cuts, np.int64)
        for batch, begin, place in places(batches):
            middle = 2 * begin + batch.column(size_at).to_numpy()  # doubled, to stay an integer
            shard = np.searchsorted(doubled, middle, side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard), pa.array(place)], [*batch.schema.names, "shard", "_place"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema.fields)
    placed = ordered.mapInArrow(run, f"{fields}, shard int, _place long")
    first = {r[0]: r[1] for r in placed.groupBy("shard").agg(F.min("_place")).collect()}
    start = F.element_at(F.create_map(*[F.lit(x) for kv in first.items() for x in kv]), F.col("shard")) if first else F.lit(0).cast("long")
    return placed.withColumn("slot", F.col("_place") - start).drop("_place", "_part")


def _spared(ordered: DataFrame, group: str, places, cuts: list[int], slack: float) -> list[int]:
    """The cuts, moved to the nearer end of the group they fall into, by ``slack`` at most.

    The first look finds the groups at the cuts (one for each at most), the second
    where these begin and end.
    """
    at, size_at = ordered.columns.index(group), ordered.columns.index("size")

    def spans(picked: set[str] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            edges = np.array(cuts, np.int64)
            for batch, begin, _ in places(batches):
                end = begin + batch.column(size_at).to_numpy()
                if picked is None:
                    rows = np.flatnonzero(np.searchsorted(edges, end) > np.searchsorted(edges, begin))  # begin <= a cut < end
                else:
                    rows = np.flatnonzero([x in picked for x in batch.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(at).take(pa.array(rows)), pa.array(begin[rows]), pa.array(end[rows])], ["key", "begin", "end"])

        return ordered.mapInArrow(run, "key string, begin long, end long").groupBy("key").agg(F.min("begin").alias("begin"), F.max("end").alias("end")).collect()

    touched = {r["key"] for r in spans(None)}
    held = [(r["begin"], r["end"]) for r in spans(touched)] if touched else []
    out = []
    for c in cuts:
        ends = next(((a, b) for a, b in held if a < c < b), None)
        near = min(ends, key=lambda x: abs(x - c)) if ends else c
        out.append(near if abs(near - c) <= slack else c)
    return out


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    The order is by a digest of the text, then doc_id, so equal texts lie together.  A
    group of them stays in one shard where the cut need not move by more than ``SLACK``
    of a shard; other groups, those too large for a shard among them, go on in the next,
    so that the sizes stay near equal.  Null and empty texts have size 1 and crc32 0; rows
    without doc_id come first within their text.
    """
    text = F.coalesce("text", F.lit(""))
    light = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("_bytes"), F.crc32(text).alias("text_crc32"), F.md5(text).alias("_group")
    )
    got = assign(light, F.col("_bytes") + 1, ["_group", "doc_id"], shards, grouped=True)
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
