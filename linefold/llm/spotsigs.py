"""Document fingerprints by SpotSigs.

A signature is a common word (the anchor) with the ``CHAIN`` content words that
follow it.  A fingerprint is the sorted set of a text's signatures, hashed to 32
bits each.  Sets are partitioned by length, so that only sets of the same or of
neighbouring partitions can reach a Jaccard similarity of ``tau``, and compared by
a merge that stops as soon as ``tau`` is out of reach.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, stable, table
from .components import components

CHAIN = 2
#: Function words that anchor signatures and never take part in a chain.
ANCHORS = """
a an and are as at be but by for from had has have he her his in is it its not of on or she so that the their them
they this to was we were which will with you
au aux avec ce ces cette dans de des du elle en est et il la le les leur mais ne nous ou par pas pour qu que qui sa se
ses son sur un une vous
am auf aus bei das dem den der die doch durch ein eine einen einer es für hat ich im ist mit nach nicht noch nur oder
sein sich sie sind über und von vor war wie wir zu zum zur
al como con del el ella entre era esta este ha hay las lo los más muy no nos o para pero por si sin sobre su sus también
una uno y ya
""".split()
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_TABLES: dict[str, np.ndarray] = {}


def _tables() -> dict[str, np.ndarray]:
    if not _TABLES:
        whole = "".join(map(chr, range(0xD800))) + "?" * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
        word = np.zeros(0x110000, bool)
        for m in regex.finditer(r"[\p{L}\p{M}\p{N}]+", whole):
            word[m.start() : m.end()] = True
        _TABLES["word"] = word
        _TABLES["power"] = np.ones(1, np.uint64)
        _TABLES["anchors"] = np.sort(np.concatenate([_words(_codes(a)) for a in ANCHORS]))
    return _TABLES


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _words(c: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of letters, marks and digits."""
    t = _TABLES
    inside = t["word"][c]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first[inside])
    if not len(starts):
        return np.zeros(0, np.uint64)
    c = c[inside].astype(np.uint64)
    size = np.diff(starts, append=len(c))
    while len(t["power"]) < size.max():
        t["power"] = np.concatenate([t["power"], t["power"] * (t["power"][-1:] * _K[0])])
    place = np.arange(len(c)) - np.repeat(starts, size)
    c = (c + np.uint64(1)) * _K[3]
    c ^= c >> np.uint64(29)
    h = np.add.reduceat(c * t["power"][place], starts)
    return h ^ h >> np.uint64(32)


def signatures(text: str | None) -> np.ndarray:
    """The sorted set of signatures, as uint32.

    Null and empty texts have none.  A text in which no anchor is followed by a full
    chain has one signature: the hash of its words, or without words of its
    characters.
    """
    t = _tables()
    c = _codes(text or "")
    if not len(c):
        return np.zeros(0, np.uint32)
    w = _words(c)
    if len(w):
        at = np.minimum(np.searchsorted(t["anchors"], w), len(t["anchors"]) - 1)
        anchor = t["anchors"][at] == w
        content = np.flatnonzero(~anchor)
        spots = np.flatnonzero(anchor)
        nth = np.searchsorted(content, spots)
        full = nth + CHAIN <= len(content)
        spots, nth = spots[full], nth[full]
        if len(spots):
            sig = w[spots] * _K[0]
            for k in range(CHAIN):
                sig = (sig ^ sig >> np.uint64(31)) * _K[1] + w[content[nth + k]]
            sig *= _K[2]
            return np.unique((sig ^ sig >> np.uint64(33)) >> np.uint64(32)).astype(np.uint32)
    digest = hashlib.sha256((w if len(w) else c).tobytes()).digest()
    return np.frombuffer(digest[:4], np.uint32)


def as_string(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def partition_of(size: int, tau: float) -> int:
    """Sets whose lengths are within ``tau`` of one another differ by one at most."""
    return int(math.log(max(size, 1)) / -math.log(tau)) if 0 < tau < 1 else 0


def pruned_jaccard(a: np.ndarray, b: np.ndarray, tau: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets, or 0.0 where it cannot reach ``tau``.

    Two empty sets are equal (1.0).  Blocks of the shorter set are looked up in the
    longer until too many are missing.
    """
    if len(a) > len(b):
        a, b = b, a
    if not len(b):
        return 1.0
    if len(a) < tau * len(b) or not len(a):
        return 0.0
    need = tau * (len(a) + len(b)) / (1 + tau)
    same, block = 0, 512 if tau else len(a)
    for at in range(0, len(a), block):
        part = a[at : at + block]
        same += int((b[np.minimum(np.searchsorted(b, part), len(b) - 1)] == part).sum())
        if same + len(a) - at - len(part) < need:
            return 0.0
    return same / (len(a) + len(b) - same)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` (eight hex digits a signature) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [as_string(signatures(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def within_reach(a: int, b: int, tau: float) -> bool:
    """Whether the partitions of two lengths allow a similarity of ``tau``."""
    return abs(partition_of(a, tau) - partition_of(b, tau)) <= 1


def _verified(pairs: DataFrame, own: DataFrame, tau: float) -> DataFrame:
    """The pairs ``a, b`` of class ids whose whole sets are as similar as ``tau``."""
    both = pairs.join(own.toDF("a", "fa"), "a").join(own.toDF("b", "fb"), "b").select("a", "b", "fa", "fb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = lambda s: np.frombuffer(bytes.fromhex(s), ">u4")
        for batch in batches:
            near = [pruned_jaccard(read(x), read(y), tau) >= tau for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, tau: float = 0.8) -> DataFrame:
    """``doc_id, class_id``: the least doc_id reachable over pairs of fingerprints
    with a Jaccard similarity of ``tau`` or more, for each row.

    Equal fingerprints are one class from the start, so copies make no pairs.  Of each
    set only its rarest ``n - ceil(tau * n) + 1`` signatures are indexed, in the bucket of
    the signature and of each of the two pairs of neighbouring partitions that the set's
    length belongs to.  In a first round the members of a bucket are compared with its
    least one only, which joins a group of near copies without listing its pairs; in the
    second, members of a bucket that are in different components yet.  Sets are compared
    whole.  Null texts class with empty ones; rows without id take the id of their class,
    null if it has none.
    """
    prints = stable(fingerprints(docs))
    classes = stable(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("rep")).where("rep is not null"))
    own = classes.select("rep", "fingerprint")
    size = F.length("fingerprint") / 8
    sigs = classes.select("rep", size.cast("int").alias("n"), F.explode(F.expr("transform(sequence(1, length(fingerprint) div 8), i -> substring(fingerprint, 8 * i - 7, 8))")).alias("sig")).where("n > 0")
    rare = sigs.groupBy("sig").agg(F.count("*").alias("df")).where("df > 1")
    ranked = sigs.join(rare, "sig").groupBy("rep", "n").agg(F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("s"))
    # signatures of one class only come first in rarity and never match
    alone = F.col("n") - F.size("s")
    keep = F.greatest(F.lit(0), F.col("n") - F.ceil(F.lit(tau) * F.col("n") - 1e-9).cast("int") + 1 - alone)
    part = F.floor(F.log("n") / -math.log(tau)).cast("int")
    kept = ranked.select("rep", "n", F.explode(F.array(part, part + 1)).alias("part"), F.slice("s", 1, keep).alias("s"))
    index = stable(kept.select("rep", "n", "part", F.explode("s").alias("x")).select("part", "x.sig", "rep", "n"))
    bucket = ["part", "sig"]
    far = (F.least("na", "nb") >= tau * F.greatest("na", "nb")) & (F.col("a") != F.col("b"))
    least = index.groupBy(bucket).agg(F.min(F.struct("rep", "n")).alias("m"), F.count("*").alias("k")).where("k > 1").select(*bucket, F.col("m.rep").alias("a"), F.col("m.n").alias("na"))
    first = index.withColumnsRenamed({"rep": "b", "n": "nb"}).join(least, bucket).where(far).select("a", "b").distinct()
    linked = stable(_verified(first, own, tau))
    labels = stable(components(linked))
    tagged = index.join(labels, F.col("rep") == F.col("node"), "left").select(*bucket, "rep", "n", F.coalesce("component", "rep").alias("part_of"))
    tagged = stable(tagged)
    held = tagged.select(*bucket, "part_of").distinct()
    split = held.groupBy(bucket).agg(F.count("*").alias("k")).where("k > 1").select(*bucket)
    held = held.join(split, bucket)
    cross = held.withColumnRenamed("part_of", "pa").join(held.withColumnRenamed("part_of", "pb"), bucket).where("pa < pb")
    second = cross.join(tagged.toDF(*bucket, "a", "na", "pa"), [*bucket, "pa"]).join(tagged.toDF(*bucket, "b", "nb", "pb"), [*bucket, "pb"]).where(far).select("a", "b").distinct()
    labels = components(linked.unionAll(_verified(second, own, tau)))
    named = classes.join(labels, F.col("rep") == F.col("node"), "left").select("fingerprint", F.coalesce("component", "rep").alias("class_id"))
    return prints.join(named, "fingerprint", "left").select("doc_id", "class_id")


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, length_part int, edited_is_near boolean, next_is_near boolean"
#: The similarity from which two texts count as near duplicates.
TAU = 0.8


def _smaller(bounds: list[int], x: Column) -> Column:
    """How many of the sorted bounds are below ``x``, by stretches of about their root."""
    step = max(1, math.isqrt(len(bounds)))
    stretches = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    numbers = lambda ns: F.split(F.lit(",".join(map(str, ns))), ",").cast("array<bigint>")
    if not bounds:
        return F.lit(0)
    whole = F.size(F.filter(numbers([s[-1] for s in stretches]), lambda b: b < x))
    rest = F.get(F.transform(F.split(F.lit(";".join(",".join(map(str, s)) for s in stretches)), ";"), lambda s: F.split(s, ",").cast("array<bigint>")), whole)
    return F.least(F.lit(len(bounds)), whole * step + F.coalesce(F.array_size(F.filter(rest, lambda b: b < x)), F.lit(0)))


def with_edited(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint beside that of its edited text and of the next.

    The next document is the one before in doc_id, and the last one's next is the
    first; rows without id come last, rows with equal id by falling text.  The edited
    text is the text with its last ``n_chars div 2`` characters replaced by as many of
    the next one's first.  A null text counts as empty.  ``length_part`` is the partition
    of the fingerprint's length; ``edited_is_near`` and ``next_is_near`` say whether the
    similarity is ``TAU`` or more, by partitions first and then by pruned Jaccard.

    The table is cut at ids taken from it, one run of ids for each partition, and each
    partition also gets the head of the run below (the cut itself), so one shuffle
    brings every document together with its next.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = partitions(spark)
    cuts = rows.agg(F.percentile_approx("doc_id", [(i + 1) / n for i in range(n)], max(10000, 50 * n)).alias("q"), F.max("doc_id").alias("top")).first()
    top = cuts["top"]
    bounds = sorted({q for q in cuts["q"] or [] if q is not None and q < top}) if top is not None else []
    below = F.when(F.col("doc_id").isNull(), 0).otherwise(_smaller(bounds, F.col("doc_id")))
    copies = F.array(F.struct(below.alias("run"), F.lit(False).alias("ghost")))
    if bounds:
        copies = F.when(F.col("doc_id").isin(bounds), F.concat(copies, F.array(F.struct((below + 1).alias("run"), F.lit(True).alias("ghost"))))).otherwise(copies)
    first = F.col("doc_id") == top if top is not None else F.col("doc_id").isNull()
    wrap = F.when(first, F.array(F.struct(F.lit(0).alias("run"), F.lit(True).alias("ghost"), F.lit(True).alias("wrap")))).otherwise(F.array().cast("array<struct<run:int,ghost:boolean,wrap:boolean>>"))
    copies = F.concat(F.transform(copies, lambda x: F.struct(x["run"].alias("run"), x["ghost"].alias("ghost"), F.lit(False).alias("wrap"))), wrap)
    dealt = rows.select("doc_id", "text", F.explode(copies).alias("x")).select("doc_id", "text", "x.*")
    dealt = dealt.repartitionById(len(bounds) + 1, F.col("run")).sortWithinPartitions("wrap", F.col("doc_id").desc_nulls_last(), F.col("text").desc())

    near = lambda a, b: within_reach(len(a), len(b), TAU) and pruned_jaccard(a, b, TAU) >= TAU

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out: list[list] = [[] for _ in range(10)]
            for doc_id, text, ghost in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                sig = signatures(text)
                if held:
                    own_id, own, own_sig = held
                    half = len(own) // 2
                    edited = own[: len(own) - half] + text[:half]
                    edited_sig = signatures(edited)
                    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    for c, v in zip(out, (own_id, len(own), sha, as_string(own_sig), as_string(edited_sig), pruned_jaccard(own_sig, edited_sig), pruned_jaccard(own_sig, sig), partition_of(len(own_sig), TAU), near(own_sig, edited_sig), near(own_sig, sig))):
                        c.append(v)
                held = None if ghost else (doc_id, text, sig)
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], [f.split()[0] for f in SCHEMA.split(", ")])

    return dealt.mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_edited(table(spark, sf_dir, "documents"))
