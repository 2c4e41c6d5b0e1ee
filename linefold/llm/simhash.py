"""SimHash near-duplicate linking by covering locality-sensitive hashing.

Fingerprints of 64 bits link at ``RADIUS`` or fewer differing bits.  A covering
family needs ``2**(RADIUS+1) - 1`` tables: bit ``i`` carries a non-zero vector
``phi(i)`` over GF(2), and table ``t`` keeps the bits with ``<phi(i), t> = 1``.  Two
fingerprints that differ in at most ``RADIUS`` bits span too few vectors to touch
every table, so some table keeps none of the differing bits and the pair falls
into one bucket there: no link is missed.

A bucket may hold very many fingerprints of one group, so its pairs are never
listed.  Members of a shared bucket are confirmed through midpoints instead: two
fingerprints lie within two bits exactly if some word is within one bit of both.
Every member therefore sends itself and its one-bit flips (only bits that the
bucket leaves free), and each midpoint has at most 65 distinct members.

Texts with few edits differ in more bits than that.  ``near_copies`` therefore looks
for pairs within ``WIDE_RADIUS`` bits of a second fingerprint, of ``WIDE_SHINGLE``-word
shingles, by a covering family of half-width masks, and links those whose whole sets of
``CONFIRM_SHINGLE``-word shingles have a Jaccard similarity of ``TAU`` or more.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_words, map_arrow, measured, stable, table
from .components import components

BITS, RADIUS, SHINGLE, SEED = 64, 2, 3, 42
WIDE_RADIUS, WIDE_SHINGLE, CONFIRM_SHINGLE, TAU = 6, 2, 5, 0.8
#: Pairs of one text that are compared in one task.
SHARE = 1000


def masks() -> list[int]:
    """The covering masks, as signed 64-bit integers."""
    vectors = 2 ** (RADIUS + 1) - 1
    out = []
    for t in range(1, vectors + 1):
        m = sum(1 << i for i in range(BITS) if bin((1 + i % vectors) & t).count("1") % 2)
        out.append(m - (1 << 64) if m >> 63 else m)
    return out


def wide_masks() -> list[int]:
    """Masks of a covering family for ``WIDE_RADIUS``, signed, of 32 bits each.

    Bit ``i`` carries the vector ``(1, i mod 2**WIDE_RADIUS)``, so that table ``(c, u)``
    keeps the bits with ``<i, u> = c + 1`` and every mask but the full one halves the word.
    """
    ones = 1 << WIDE_RADIUS
    out = [sum(1 << i for i in range(BITS) if bin((ones | i % ones) & t).count("1") % 2) for t in range(1, 2 * ones) if t != ones]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """XXH64 of each shingle, repeats included; fewer words are one shingle."""
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(line[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())], dtype="<u8"
    )


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The unsigned SimHash of a text's shingles (3 words), repeats included.

    Fewer words: the whole sequence is the one shingle; null, empty or blank: 0.
    """
    words = lower_words(text)
    if not words:
        return 0
    hashes = shingle_hashes(words, width)
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 16384):  # bounded memory for very long texts
        bits = np.unpackbits(hashes[at : at + 16384].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp long)`` for every row; ``fp`` holds the 64 bits, signed."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, fp long")


def links(words: DataFrame) -> DataFrame:
    """``words(fp, rep)`` of distinct fingerprints to edges ``(a, b)`` between
    their ``rep`` ids, enough to connect all that lie within two bits."""
    tables = F.array(
        *[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k"), F.lit(~m).alias("free")) for t, m in enumerate(masks())]
    )
    keyed = words.select("fp", "rep", F.explode(tables).alias("x")).select("fp", "rep", "x.*")
    shared = keyed.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1").select("t", "k")
    near = (
        keyed.join(shared, ["t", "k"])
        .groupBy("fp")
        .agg(F.min("rep").alias("rep"), F.bit_or("free").alias("free"))
    )
    bits = F.array(*[F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(BITS)])
    flips = F.filter(bits, lambda b: F.col("free").bitwiseAND(b) != 0)
    mid = near.select("rep", F.explode(F.concat(F.array("fp"), F.transform(flips, lambda b: F.col("fp").bitwiseXOR(b)))).alias("mid"))
    met = mid.groupBy("mid").agg(F.collect_set("rep").alias("reps")).where(F.size("reps") > 1)
    return met.select(F.array_min("reps").alias("a"), F.explode("reps").alias("b")).where("a <> b").distinct()


def similarity(a: str | None, b: str | None) -> float:
    """Jaccard similarity of the sets of 5-word shingles; without words on either side 0."""
    x, y = (np.unique(shingle_hashes(w, CONFIRM_SHINGLE)) if (w := lower_words(t)) else np.zeros(0, "<u8") for t in (a, b))
    same = len(np.intersect1d(x, y, assume_unique=True))
    return same / max(1, len(x) + len(y) - same)


def _beside(pairs: DataFrame, texts: DataFrame, side: str) -> DataFrame:
    """``pairs`` with the text of one side; a text of very many pairs goes out in as many
    copies as it has thousands of them, so that no task gets all its pairs."""
    shares = pairs.groupBy(side).agg(F.ceil(F.count("*") / SHARE).alias("shares"))
    other = "b" if side == "a" else "a"
    dealt = pairs.join(shares, side).withColumn("share", F.pmod(F.xxhash64(other), "shares"))
    copies = texts.select(F.col("h").alias(side), F.col("text").alias(f"t{side}")).join(shares, side).withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))
    return dealt.drop("shares").join(copies.drop("shares"), [side, "share"]).drop("share")


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of text keys that are similar enough."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        near = [similarity(x.as_py(), y.as_py()) >= TAU for x, y in zip(batch.column(2), batch.column(3))]
        return batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    both = _beside(_beside(pairs, texts, "a"), texts, "b")
    return map_arrow(both.select("a", "b", "ta", "tb"), run, "a long, b long")


def near_copies(docs: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` between doc_ids, enough to connect all texts that are within
    ``WIDE_RADIUS`` bits of each other and similar by ``TAU``.

    Equal texts (by 64 bits of a digest) are one node, that of their least doc_id; texts
    without words and nodes without id have no edge.  Each is compared first
    with the least of the least members of its buckets, which joins most of a group of near
    copies by one pair a text; then with the least of each bucket, if that is in another
    component yet; then all that are still apart in a bucket of three or more.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    key = F.conv(F.substring(F.md5("text"), 1, 15), 16, 10).cast("long")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        wide = [np.uint64(fingerprint(t, WIDE_SHINGLE)).view(np.int64).item() if t.strip(" \t\n\r\x0b\x0c") else None for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(wide, pa.int64())], ["doc_id", "h", "wide"])

    prints = map_arrow(docs.where("text is not null and doc_id is not null").withColumn("h", key), run, "doc_id long, h long, wide long")
    nodes = stable(prints.where("wide is not null").groupBy("h", "wide").agg(F.min("doc_id").alias("rep")))
    tables = F.explode(F.array(*[F.xxhash64(F.lit(t), F.col("wide").bitwiseAND(F.lit(m))) for t, m in enumerate(wide_masks())]))
    close = (F.bit_count(F.col("wa").bitwiseXOR(F.col("wb"))) <= WIDE_RADIUS) & (F.col("a") != F.col("b"))
    at = lambda side, source, *more: source.select(F.col("h").alias(side), *[F.col(c).alias(c[0] + side) for c in more])
    member = lambda source: source.withColumn("key", tables)

    def parted(linked: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The nodes with their component so far, and the buckets that hold several."""
        labels = components(linked)
        own = stable(nodes.join(labels, F.col("h") == F.col("node"), "left").select("h", "wide", F.coalesce("component", "h").alias("part")))
        buckets = member(own).groupBy("key").agg(F.count("*").alias("n"), F.min("h").alias("a"), F.min("part").alias("lo"), F.max("part").alias("hi"))
        return own, stable(buckets.where("lo < hi").select("key", "n", "a"))

    def texts(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct().join(nodes, "h")
        ids = stable(ids.select(F.col("h").alias("_h"), F.col("rep").alias("_rep")))
        own = docs.join(measured(ids, 32), (F.col("doc_id") == F.col("_rep")) & (key == F.col("_h")))
        return stable(own.select(F.col("_h").alias("h"), "text").dropDuplicates(["h"]))

    shared = stable(member(nodes).groupBy("key").agg(F.count("*").alias("n"), F.min("h").alias("a")).where("n > 1").select("key", "a"))
    one = member(nodes).join(measured(shared, 16), "key").groupBy(F.col("h").alias("b"), F.col("wide").alias("wb")).agg(F.min("a").alias("a"))
    pairs = stable(one.join(at("a", nodes, "wide"), "a").where(close).select("a", "b"))
    linked = stable(_confirmed(pairs, texts(pairs)))

    own, split = parted(linked)
    split = stable(split.join(at("a", own, "wide", "part"), "a").select("key", "a", "wa", "pa"))
    found = member(own.toDF("b", "wb", "pb").withColumn("wide", F.col("wb"))).join(measured(split, 32), "key").where(close & (F.col("pa") != F.col("pb")))
    pairs = stable(found.select("a", "b").distinct())
    linked = stable(linked.unionAll(_confirmed(pairs, texts(pairs))))

    own, split = parted(linked)
    split = measured(stable(split.where("n > 2").select("key")), 8)
    held = member(own).join(split, "key")
    cross = held.toDF("key", "a", "wa", "pa").join(held.toDF("key", "b", "wb", "pb"), "key").where(close & (F.col("pa") < F.col("pb")))
    pairs = stable(cross.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti"))
    both = linked.unionAll(_confirmed(pairs, texts(pairs)))
    ids = lambda side: nodes.select(F.col("h").alias(side), F.col("rep").alias(f"r{side}"))
    return both.join(ids("a"), "a").join(ids("b"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))


def near_duplicates(docs: DataFrame, copies: bool | Callable[[DataFrame], DataFrame] = False) -> DataFrame:
    """``docs(doc_id, text)`` to ``(doc_id, fp, component_id)``, a row per row.

    With ``copies`` the links of ``near_copies``, or of the function given, count beside
    those of fingerprints.

    ``component_id`` is the least doc_id reachable over links.  Rows with equal
    fingerprints (copies; all texts without words, null texts too) are one node
    whose id is their least doc_id; null ids take part only if the whole component
    has no other, and then its id is null.  Repeated rows stay repeated.
    """
    prints = stable(fingerprints(docs))
    words = stable(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    edges = links(words.where("rep is not null"))
    if copies:
        own = words.where("rep is not null").select("fp", "rep")
        ids = prints.join(own, "fp").where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
        found = stable((copies if callable(copies) else near_copies)(docs))
        ids = ids.join(measured(stable(found.select(F.explode(F.array("a", "b")).alias("a")).distinct()), 16), "a", "left_semi")
        edges = edges.unionAll(found).unionAll(ids)
    labels = components(edges)
    named = words.join(labels, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, copies: bool | Callable[[DataFrame], DataFrame] = False) -> DataFrame:
    """One document of each component (that with the least id) with all columns.

    ``copies`` is that of ``near_duplicates``.

    A document is its doc_id: it goes if none of its rows leads a component, and of
    rows that repeat an id one stays.  Rows without id stay, as no id leads them.
    """
    found = near_duplicates(docs, copies).where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), F.max(F.expr("doc_id = component_id")).alias("leads"))
    odd = stable(found.where("n > 1 or not leads").select(F.col("doc_id").alias("_odd_id"), "leads"))
    on = docs["doc_id"].cast("long") == F.col("_odd_id")
    out = docs.join(measured(odd, 32), on, "left_anti")
    repeated = docs.join(measured(stable(odd.where("leads")), 32), on, "left_semi")
    return out.unionByName(repeated.dropDuplicates(["doc_id"]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
