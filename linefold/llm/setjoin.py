"""All texts alike by Jaccard, as an exact set similarity join by prefixes.

A text's set are the digests of its ``CONFIRM_SHINGLE``-word shingles.  Two sets whose
Jaccard similarity is 4/5 or more share an element among the first ``n // 5 + 1`` of
each, in any one order of all elements (Chaudhuri et al., Xiao et al.); here that of
frequency in a sample, which decides the cost and no result, then of the digest.  Pairs
of a bucket (texts that share such an element) must pass exact bounds by size, by place in
the prefix and by a parity bitmap, whose differing bits never exceed the differing elements
(Sandes et al.), and are then compared as whole sets.

A bucket of a group of near copies would list the pairs of the group, so members of a
bucket of more than ``FEW`` name one other member each at first; what is found makes
components, and only pairs across components are listed at last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_words, map_arrow, measured, partitions, stable
from .components import components
from .simhash import CONFIRM_SHINGLE, _confirmed, shingle_hashes

#: Buckets up to this size list their pairs; texts that give the order; its elements.
FEW, SAMPLE, ORDERED = 4, 4000, 1 << 17
#: Rows of a large bucket that are compared at a time; bytes of shared elements that a task
#: holds, beyond which they are joined.
BLOCK, HELD_BYTES = 512, 64 << 20


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted digests of a text's shingles, none for a text without words."""
    words = lower_words(text)
    return np.unique(shingle_hashes(words, CONFIRM_SHINGLE)).astype(np.uint64) if words else np.zeros(0, np.uint64)


def prefix(own: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first ``n // 5 + 1`` elements by (count, digest); unknown ones count 0."""
    if len(known):
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        own = own[np.lexsort((own, np.where(known[at] == own, counts[at], 0)))]
    return own[: len(own) // 5 + 1]


def bitmap(own: np.ndarray) -> bytes:
    """A bit for each class of digests modulo a power of two, at least n and 64: whether
    the set has an odd number of the class."""
    size = max(64, 1 << (len(own) - 1).bit_length())
    odd = np.bincount((own & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _fold(bits: np.ndarray, lanes: int) -> np.ndarray:
    while bits.shape[-1] > lanes:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def apart(a: bytes, b: bytes) -> int:
    """Differing bits of two bitmaps, at most the differing elements of their sets."""
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    lanes = min(len(x), len(y))
    return int(np.bitwise_count(_fold(x, lanes) ^ _fold(y, lanes)).sum())


def _sizes(n, i, m, j):
    """Whether sizes n and m allow 4/5, and the places i and j in the prefixes of the
    first element that both have."""
    return (5 * np.minimum(n, m) >= 4 * np.maximum(n, m)) & (9 * np.minimum(n - i, m - j) >= 4 * (n + m))


def _listed(at: np.ndarray, n: np.ndarray, place: np.ndarray, key: np.ndarray, part: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (sorted by ``at``) in buckets of up to ``FEW``."""
    out = []
    for k in range(1, FEW):
        x, y = slice(0, len(at) - k), slice(k, len(at))
        ok = (at[x] == at[y]) & (part[x] != part[y]) & _sizes(n[x], place[x], n[y], place[y])
        out.append((key[x][ok], key[y][ok]))
    return out


def _bucket(n: np.ndarray, place: np.ndarray, key: np.ndarray, part: np.ndarray, bits: list[bytes], every: bool) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one large bucket that pass the bounds and lie in different components:
    all, or for each row that with the least other key."""
    order = np.lexsort((key, n))
    n, place, key, part, bits = n[order], place[order], key[order], part[order], [bits[k] for k in order]
    lanes = np.array([len(b) // 8 for b in bits])
    steps = {w: np.stack([np.frombuffer(bits[k], "<u8") for k in np.flatnonzero(lanes == w)]) for w in np.unique(lanes)}
    first = {w: int(np.flatnonzero(lanes == w)[0]) for w in steps}
    least = np.full(len(key), np.iinfo(np.int64).max)
    out = []
    for w, own in steps.items():
        for v, other in steps.items():  # sizes grow with the row, so bitmaps do
            if not w <= v <= 2 * w:
                continue
            folded = _fold(other, w)
            for a in range(0, len(own), BLOCK):
                x = np.arange(first[w] + a, first[w] + min(a + BLOCK, len(own)))
                start = a if v == w else 0
                stop = int(np.searchsorted(n, 5 * n[x[-1]] // 4, "right")) - first[v]
                for b in range(start, min(stop, len(other)), BLOCK):
                    y = np.arange(first[v] + b, first[v] + min(b + BLOCK, len(other)))
                    ok = _sizes(n[x, None], place[x, None], n[None, y], place[None, y]) & (part[x, None] != part[None, y]) & (x[:, None] < y[None, :])
                    i, j = np.nonzero(ok)
                    if not len(i):
                        continue
                    far = np.zeros(ok.shape, np.int64)
                    for lane in range(w):
                        far += np.bitwise_count(own[x - first[w], lane][:, None] ^ folded[y - first[v], lane][None, :])
                    near = 9 * far[i, j] <= n[x[i]] + n[y[j]]
                    i, j = x[i[near]], y[j[near]]
                    if every:
                        out.append((key[i], key[j]))
                    else:
                        np.minimum.at(least, i, key[j])
                        np.minimum.at(least, j, key[i])
    if not every:
        has = least != np.iinfo(np.int64).max
        out.append((key[has], least[has]))
    return out


def _pairs(held: DataFrame, every: bool) -> DataFrame:
    """``held(at, t, n, place, part, bits)`` to distinct ``(a, b)``, a < b, that may be alike;
    ``bits`` is null in buckets of up to ``FEW``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def found(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            at, t, n, place, part = (rows.column(c).to_numpy().astype(np.int64) for c in ("at", "t", "n", "place", "part"))
            small = rows.column("bits").is_null().to_numpy()
            out = _listed(at[small], n[small], place[small], t[small], part[small])
            edges = np.flatnonzero(np.diff(at, prepend=at[:1] - 1, append=at[-1:] + 1))
            for x, y in zip(edges[:-1], edges[1:]):
                if not small[x]:
                    out += _bucket(n[x:y], place[x:y], t[x:y], part[x:y], rows.column("bits").slice(x, y - x).to_pylist(), every)
            a, b = (np.concatenate([np.zeros(0, np.int64), *[o[k] for o in out]]) for k in (0, 1))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rest = rows if rest is None else pa.concat_tables([rest, rows])
            if batch.column(0)[-1].as_py() == rest.column("at")[0].as_py():
                continue  # all one bucket as yet
            at = rest.column("at").to_numpy()
            whole = int(np.searchsorted(at, at[-1]))
            yield from found(rest.slice(0, whole))
            rest = rest.slice(whole)
        if rest is not None:
            yield from found(rest)

    dealt = held.select("at", "t", "n", "place", "part", "bits").repartition("at").sortWithinPartitions("at")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _order(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Digests that several of about ``SAMPLE`` texts have, and in how many."""
    share = SAMPLE / max(1, docs.count())
    some = docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.lit(share * (1 << 30))).select("text").dropDuplicates(["text"])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t.as_py()).view(np.int64) for t in batch.column(0)]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets))], ["s"])

    counts = map_arrow(some, run, "s long").groupBy("s").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "s").limit(ORDERED).toArrow()
    known, n = counts.column("s").to_numpy().astype(np.int64).view(np.uint64), counts.column("n").to_numpy()
    by = np.argsort(known)
    return known[by], n[by]


def _several(nodes: DataFrame) -> DataFrame:
    """``(at, k)`` of the prefixes' elements that k > 1 nodes have.  Elements go out by
    their remainder, all of a batch in one row, and are counted in arrays."""
    tasks = partitions(nodes.sparkSession)
    groups = 4 * tasks

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.column(0).flatten().to_numpy().view(np.uint64)
        group = (at % np.uint64(groups)).astype(np.int64)
        at, ends = at[np.argsort(group, kind="stable")], np.cumsum(np.bincount(group, minlength=groups))
        some = np.flatnonzero(np.diff(ends, prepend=0))
        return pa.RecordBatch.from_arrays([pa.array(some), pa.array([at[(ends[g - 1] if g else 0) : ends[g]].tobytes() for g in some], pa.binary())], ["g", "at"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for g, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(g, []).append(at)
        for g in sorted(held):
            at, k = np.unique(np.frombuffer(b"".join(held.pop(g)), np.int64), return_counts=True)
            if (k > 1).any():
                yield pa.RecordBatch.from_arrays([pa.array(at[k > 1]), pa.array(k[k > 1])], ["at", "k"])

    return map_arrow(nodes.select("first"), deal, "g long, at binary").repartition(tasks, "g").mapInArrow(count, "at long, k long")


def _shared(nodes: DataFrame) -> DataFrame:
    """``(at, t, n, place, hot)`` of the prefixes' elements that several nodes have;
    ``hot`` where more than ``FEW`` have it."""
    keyed = nodes.select("t", "n", F.posexplode("first").alias("place", "at"))
    counts = stable(_several(nodes))
    if counts.count() * 16 > HELD_BYTES:
        return keyed.join(counts, "at").select("at", "t", "n", "place", (F.col("k") > FEW).alias("hot"))
    held = counts.toArrow()
    order = np.argsort(held.column("at").to_numpy())
    several, hot = held.column("at").to_numpy()[order], held.column("k").to_numpy()[order] > FEW

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(2)
        at, up = lists.flatten().to_numpy(), pa.compute.list_parent_indices(lists).to_numpy()
        place = np.arange(len(at)) - np.searchsorted(up, up)
        found = np.minimum(np.searchsorted(several, at), max(0, len(several) - 1))
        own = np.flatnonzero(several[found] == at) if len(several) else np.zeros(0, np.int64)
        up = pa.array(up[own])
        return pa.RecordBatch.from_arrays([pa.array(at[own]), batch.column(0).take(up), batch.column(1).take(up), pa.array(place[own]), pa.array(hot[found[own]])], ["at", "t", "n", "place", "hot"])

    return map_arrow(nodes.select("t", "n", "first"), run, "at long, t long, n long, place long, hot boolean")


def alike(docs: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` between doc_ids, enough to connect all texts whose sets of
    5-word shingles have a Jaccard similarity of 0.8 or more.

    Equal texts (by 60 bits of a digest) are one node, that of their least doc_id; texts
    without words and texts without id have no edge.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null and doc_id is not null")
    key = F.conv(F.substring(F.md5("text"), 1, 15), 16, 10).cast("long")
    known, counts = _order(docs)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, first, bits = [], [], []
        for text in batch.column(2):  # one set at a time is held
            own = shingle_set(text.as_py())
            sizes.append(len(own))
            first.append(prefix(own, known, counts).view(np.int64) if len(own) else own.view(np.int64))
            bits.append(bitmap(own) if len(own) else None)
        columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(first, pa.list_(pa.int64())), pa.array(bits, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["t", "rep", "n", "first", "bits"])

    keyed = docs.withColumn("t", key)
    copies = stable(keyed.groupBy("t").agg(F.min("doc_id").alias("_rep"), F.count("*").alias("k")).where("k > 1").select(F.col("t").alias("_t"), "_rep"))
    copies = measured(copies, 32)
    alone = keyed.join(copies, F.col("t") == F.col("_t"), "left_anti")
    folded = keyed.join(copies, (F.col("t") == F.col("_t")) & (F.col("doc_id") == F.col("_rep"))).dropDuplicates(["t"])
    lone = alone.select("t", "doc_id", "text").unionAll(folded.select("t", "doc_id", "text"))
    nodes = stable(map_arrow(lone, run, "t long, rep long, n long, first array<long>, bits binary").where("n > 0"))
    rows = stable(_shared(nodes))
    large = stable(nodes.join(measured(stable(rows.where("hot").select("t").distinct()), 16), "t").select(F.col("t").alias("_t"), "bits"))
    size = large.agg(F.sum(F.length("bits") + 16)).first()[0] or 0
    bits = F.broadcast(large) if size <= 16 << 20 else large
    on = (F.col("t") == F.col("_t")) & F.col("hot")

    def beside(pairs: DataFrame, side: str) -> DataFrame:
        return pairs.join(nodes.select(F.col("t").alias(side), F.col("n").alias(f"n{side}"), F.col("bits").alias(f"b{side}")), side)

    def near(pairs: DataFrame) -> DataFrame:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            n = np.add(batch.column(2).to_numpy(), batch.column(3).to_numpy())
            far = np.array([apart(x.as_py(), y.as_py()) for x, y in zip(batch.column(4), batch.column(5))], np.int64)
            return batch.select(["a", "b"]).filter(pa.array(9 * far <= n, pa.bool_()))

        return map_arrow(beside(beside(pairs, "a"), "b").select("a", "b", "na", "nb", "ba", "bb"), run, "a long, b long")

    def texts(pairs: DataFrame) -> DataFrame:
        ids = stable(pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct().join(nodes, F.col("h") == F.col("t")).select(F.col("h").alias("_h"), F.col("rep").alias("_rep")))
        own = docs.join(measured(ids, 32), (F.col("doc_id") == F.col("_rep")) & (key == F.col("_h")))
        return stable(own.select(F.col("_h").alias("h"), "text").dropDuplicates(["h"]))

    def confirmed(pairs: DataFrame) -> DataFrame:
        pairs = stable(near(pairs))
        return stable(_confirmed(pairs, texts(pairs))) if pairs.head(1) else pairs

    tried = stable(_pairs(rows.withColumn("part", F.col("t")).join(bits, on, "left"), False))
    linked = confirmed(tried)
    for every in (False, True) if size else ():  # small buckets have listed all by now
        held = rows.where("hot").join(measured(components(linked), 16), F.col("t") == F.col("node"), "left").withColumn("part", F.coalesce("component", "t"))
        split = stable(held.groupBy("at").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("at"))
        listed = stable(_pairs(held.join(measured(split, 16), "at", "left_semi").join(bits, on), every).join(tried, ["a", "b"], "left_anti"))
        linked, tried = stable(linked.unionAll(confirmed(listed))), stable(tried.unionAll(listed))
    ids = lambda side: nodes.select(F.col("t").alias(side), F.col("rep").alias(f"r{side}"))
    return linked.join(ids("a"), "a").join(ids("b"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")).where("a <> b")
