"""Log-bilinear language model with noise-contrastive estimation, in numpy.

Words are told apart by a 64-bit hash.  The output is a tree of two levels whose size
grows with the square root of the vocabulary: groups, and in each group as many leaves.
Each of the most frequent training words is a leaf of its own; the others, and words
never seen, share hashed leaves, and within its leaf a word has its add-one smoothed
frequency.  The vector predicted from the leaves of the two words before is a sum of
linearly transformed embeddings; the score of a group or of a leaf is its dot product
with the embedding there plus a bias.

Every training document is learned from: each task runs noise-contrastive steps on
its own tokens from one common start, and the parameters are averaged with the
numbers of tokens as weights.  For scoring, groups, and leaves within their group, are
normalised by matrix products over all of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_fold, stable, table, word_hashes

#: Leaves: 0 begin (context only), 1 end, then frequent words, then hashed leaves.  There
#: are ``max(LEAST, PER_ROOT * sqrt(V))`` frequent words and a quarter as many hashed leaves.
BEGIN, END, LEAST, PER_ROOT = 0, 1, 1021, 2
WIDTH, NOISE, GROUP_NOISE, BATCH, RATE = 32, 40, 16, 4096, 0.15
#: Words whose counts every worker holds, the most frequent; other counts are joined.
HELD = 1 << 18
#: Texts are taken in runs of about so many bytes.
RUN_BYTES = 4 << 20
#: The hash of the end token; no word has an even hash.
END_HASH = np.int64(0)
#: The hashed leaf of a word comes from the bits of its hash above so many.
SHIFT = 20


def hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all tokens of all texts, an end after each text's words, and the
    number of tokens of each text."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    c = np.frombuffer(b"\n".join(raw).lower() + b"\n", np.uint8)
    blank = (c - np.uint8(9) < 5) | (c == 32)
    first = ~blank
    first[1:] &= blank[:-1]
    begin = np.flatnonzero(first)
    words = np.diff(np.searchsorted(begin, np.cumsum([len(r) + 1 for r in raw])), prepend=0)
    x = word_hashes(c, begin)
    x ^= x >> np.uint64(32)
    h = (x * np.uint64(0xD6E8FEB86659FD93) | np.uint64(1)).view(np.int64)
    out = np.full(len(h) + len(texts), END_HASH)
    out[np.arange(len(h)) + np.repeat(np.arange(len(texts)), words)] = h
    return out, words + 1


def runs(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of runs of about ``RUN_BYTES``."""
    begin, size, texts = 0, 0, []
    for t in batch.column(at).to_pylist():
        texts.append(t)
        size += len(t or "")
        if size >= RUN_BYTES:
            yield begin, texts
            begin, size, texts = begin + len(texts), 0, []
    if texts:
        yield begin, texts


def count_tokens(docs: DataFrame) -> DataFrame:
    """``hash, c`` of every token of every document, ends included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in runs(batch, 0):
                keys, n = np.unique(hashes(texts)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], ["hash", "c"])

    return docs.select("text").mapInArrow(run, "hash long, c long").groupBy("hash").agg(F.sum("c").alias("c"))


@dataclass
class Model:
    top: np.ndarray  # sorted hashes of the words with a leaf of their own, the end too
    top_leaf: np.ndarray
    mass: np.ndarray  # training tokens of each leaf
    kinds: np.ndarray  # training words of each leaf
    hashed: int  # the leaves from this one on are hashed
    tokens: int  # N
    types: int  # V
    held: np.ndarray  # sorted hashes of the words whose counts are held
    counts: np.ndarray
    params: dict[str, np.ndarray]  # q: leaves, then groups; the last column is the bias

    @property
    def leaves(self) -> int:
        return len(self.mass)

    @property
    def width(self) -> int:
        """Leaves of a group."""
        return math.isqrt(self.leaves - 1) + 1

    @property
    def groups(self) -> int:
        return -(-(self.leaves - 1) // self.width)

    def leaf(self, h: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.top, h), len(self.top) - 1)
        rest = self.hashed + (h.view(np.uint64) >> np.uint64(SHIFT)) % np.uint64(self.leaves - self.hashed)
        return np.where(self.top[at] == h, self.top_leaf[at], rest.astype(np.int64))

    def group(self, leaf: np.ndarray) -> np.ndarray:
        return (leaf - 1) // self.width

    def count(self, h: np.ndarray) -> np.ndarray:
        """The training count of each word that is held, 0 for others."""
        if not len(self.held):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.held, h), len(self.held) - 1)
        return np.where(self.held[at] == h, self.counts[at], 0)

    def unigrams(self) -> tuple[np.ndarray, np.ndarray]:
        """Smoothed shares of the leaves (begin: none) and of the groups."""
        leaf = self.mass + 0.5
        leaf[BEGIN] = 0
        leaf /= leaf.sum()
        return leaf, np.bincount(self.group(np.arange(1, self.leaves)), leaf[1:], self.groups)


def contexts(classes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two tokens before, begin at the start of a text."""
    starts = np.cumsum(sizes) - sizes
    one, two = np.roll(classes, 1), np.roll(classes, 2)
    one[starts] = two[starts] = BEGIN
    second = starts[sizes > 1] + 1
    two[second] = BEGIN
    return one, two


def start(model: Model) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(7)
    near = lambda *s: rng.normal(0, 0.1, s).astype(np.float32)
    eye = np.eye(WIDTH, WIDTH - 1, dtype=np.float32)
    shares = np.concatenate(model.unigrams())
    q = near(len(shares), WIDTH)
    q[:, -1] = np.log(np.maximum(shares, 1e-12))
    return {"r": near(model.leaves, WIDTH), "q": q, "c1": eye * 0.7, "c2": eye * 0.3}


def _step(p: dict[str, np.ndarray], adapt: dict[str, np.ndarray], name: str, at, grad: np.ndarray) -> None:
    """An AdaGrad step on some rows, which must differ."""
    total = adapt[name][at] + grad * grad
    adapt[name][at] = total
    p[name][at] += RATE * grad / np.sqrt(total + 1e-8)


def _logistic(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.clip(x, -30, 30, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _drawn(shares: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    draw = np.cumsum(shares)
    return np.minimum(np.searchsorted(draw, rng.random(n) * draw[-1], side="right"), len(shares) - 1)


def _by_key(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and the sums of their rows; ``keys`` must be sorted."""
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(rows, first, axis=0)


def _small(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint16) if len(x) and x.max() < 65536 else x  # sorted by digits


def learn(p: dict[str, np.ndarray], adapt: dict[str, np.ndarray], model: Model, w: np.ndarray, one: np.ndarray, two: np.ndarray, rng: np.random.Generator) -> None:
    """Noise-contrastive AdaGrad steps over shuffled tokens, in place.  Each step tells
    the tokens' leaves from ``NOISE`` leaves, and their groups from ``GROUP_NOISE``
    groups, which all its tokens share and which are drawn by frequency."""
    leaf_share, group_share = model.unigrams()
    log_noise = np.log(np.maximum(np.concatenate([NOISE * leaf_share, GROUP_NOISE * group_share]), 1e-12)).astype(np.float32)
    k, order = model.leaves, rng.permutation(len(w))
    for s in range(0, len(w), BATCH):
        i = order[s : s + BATCH]
        i = i[np.argsort(_small(w[i]), kind="stable")]
        n, t, u, v = len(i), w[i], one[i], two[i]
        g = k + model.group(t)
        noise = np.sort(np.concatenate([_drawn(leaf_share, NOISE, rng), k + _drawn(group_share, GROUP_NOISE, rng)]))
        h = np.ones((n, WIDTH), np.float32)  # a last one for the bias
        h[:, :-1] = p["r"].take(u, axis=0) @ p["c1"] + p["r"].take(v, axis=0) @ p["c2"]
        qt, qg, qn = p["q"].take(t, axis=0), p["q"].take(g, axis=0), p["q"][noise]
        gt = 1 - _logistic(np.einsum("ij,ij->i", qt, h) - log_noise[t])
        gg = 1 - _logistic(np.einsum("ij,ij->i", qg, h) - log_noise[g])
        gn = h @ qn.T
        gn -= log_noise[noise]
        gn = np.negative(_logistic(gn), out=gn)
        qt *= gt[:, None]
        qg *= gg[:, None]
        dh = gn @ qn
        dh += qt
        dh += qg
        dh /= n
        h /= n
        for at, weight in ((t, gt), (g, gg)):
            _step(p, adapt, "q", *_by_key(at, np.multiply(h, weight[:, None], out=qt)))
        _step(p, adapt, "q", *_by_key(noise, gn.T @ h))
        for at, name in ((u, "c1"), (v, "c2")):
            sort = np.argsort(_small(at), kind="stable")
            rows, sums = _by_key(at[sort], dh.take(sort, axis=0))
            sums = sums[:, :-1]
            held = p["r"][rows]
            _step(p, adapt, "r", rows, sums @ p[name].T)
            _step(p, adapt, name, slice(None), held.T @ sums)


def _pack(p: dict[str, np.ndarray]) -> bytes:
    return b"".join(p[k].astype("<f4").tobytes() for k in sorted(p))


def _unpack(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One model from many, each weighted by its tokens; one is held beside the sum."""
    total, weight = None, 0
    for batch in batches:
        for n, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            x = np.frombuffer(data.as_buffer(), "<f4").astype(np.float64) * n
            total, weight = x if total is None else total + x, weight + n
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([weight], pa.int64()), pa.array([(total / weight).astype("<f4").tobytes()], pa.binary())], ["n", "params"])


def _hashed_leaf(n: int) -> Column:
    return F.pmod(F.shiftrightunsigned("hash", SHIFT), F.lit(n))


def _shape(counts: DataFrame) -> Model:
    """The tree, the sums of its leaves and the counts that are held; no parameters yet."""
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    words = counts.where(F.col("hash") != F.lit(int(END_HASH)))
    frequent = max(LEAST, math.ceil(PER_ROOT * math.sqrt(v)))
    best = words.orderBy(F.desc("c"), "hash").limit(frequent).collect()
    ends = sum(r["c"] for r in counts.where(F.col("hash") == F.lit(int(END_HASH))).collect())
    hashed, spread = 2 + len(best), frequent // 4
    mass, kinds = np.zeros(hashed + spread), np.zeros(hashed + spread)
    mass[END], kinds[END] = ends, bool(ends)
    mass[2:hashed], kinds[2:hashed] = [r["c"] for r in best], 1
    for leaf, c, k in words.groupBy(_hashed_leaf(spread)).agg(F.sum("c"), F.count("*")).collect():
        mass[hashed + leaf], kinds[hashed + leaf] = c, k
    own = np.array([r["hash"] for r in best], np.int64)
    out = hashed + ((own.view(np.uint64) >> np.uint64(SHIFT)) % np.uint64(spread)).astype(np.int64)
    np.subtract.at(mass, out, mass[2:hashed])
    np.subtract.at(kinds, out, 1)
    step = F.floor(F.log2("c") * 4)
    left, least = HELD, None
    for bucket, k in sorted(words.groupBy(step).count().collect(), reverse=True):
        if k > left:
            break
        left, least = left - k, bucket
    held = words.where(step >= (least if least is not None else 1 << 10)).select("hash", "c").toArrow()
    keys = np.append(held.column("hash").to_numpy(), END_HASH)
    order = np.argsort(keys)
    seen = np.append(held.column("c").to_numpy(), ends)[order]
    top = np.append(own, END_HASH)
    sort = np.argsort(top)
    return Model(top[sort], np.append(np.arange(2, hashed), END)[sort], mass, kinds, hashed, int(n), int(v), keys[order], seen, {})


def fit(train: DataFrame) -> tuple[Model, DataFrame]:
    """The model and the table ``hash, c`` of all training tokens.

    An empty training set leaves a model in which nothing is known (N = V = 0).
    """
    counts = stable(count_tokens(train))
    model = _shape(counts)
    model.params = start(model)
    sent = train.sparkSession.sparkContext.broadcast(replace(model, held=model.held[:0], counts=model.counts[:0]))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        p = {k: x.copy() for k, x in own.params.items()}
        adapt = {k: np.full_like(x, 1e-6) for k, x in p.items()}
        rng, seen = np.random.default_rng(11), 0
        for batch in batches:
            for _, texts in runs(batch, 0):
                h, sizes = hashes(texts)
                w = own.leaf(h)
                learn(p, adapt, own, w, *contexts(w, sizes), rng)
                seen += len(w)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([_pack(p)], pa.binary())], ["n", "params"])

    if model.tokens:
        schema = "n long, params binary"
        parts = stable(train.select("text").mapInArrow(local, schema))
        width = max(1, math.isqrt(parts.rdd.getNumPartitions()))
        (_, data), = parts.coalesce(width).mapInArrow(_averaged, schema).repartition(1).mapInArrow(_averaged, schema).collect()
        model.params = _unpack(np.frombuffer(data, "<f4"), model.params)
    return model, counts


class Scorer:
    """Normalised log-probabilities of leaves, by matrix products over whole levels."""

    def __init__(self, model: Model) -> None:
        p = model.params
        self.model, self.q = model, p["q"]
        self.one, self.two = ((np.concatenate([p["r"] @ p[c], np.full((model.leaves, 1), 0.5, np.float32)], axis=1)) for c in ("c1", "c2"))
        far = lambda x: float(np.linalg.norm(x, axis=1).max())
        #: Whether no score can be too large for exp().
        self.tame = (far(self.one) + far(self.two)) * far(self.q) < 80

    def _level(self, h: np.ndarray, q: np.ndarray, pick: np.ndarray) -> np.ndarray:
        s = h @ q.T
        got = s[np.arange(len(s)), pick]
        if not self.tame:
            top = s.max(axis=1)
            s -= top[:, None]
            got = got - top
        return got - np.log(np.exp(s, out=s) @ np.ones(s.shape[1], np.float32))

    def logs(self, w: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Natural log-probability of each leaf given its two predecessors."""
        k, width = self.model.leaves, self.model.width
        out = np.empty(len(w), np.float64)
        for at in range(0, len(w), 1 << 15):
            t = w[at : at + (1 << 15)]
            order = np.argsort(_small(t), kind="stable")
            t = t[order]
            h = self.one.take(one[at : at + (1 << 15)][order], axis=0)
            h += self.two.take(two[at : at + (1 << 15)][order], axis=0)
            g = self.model.group(t)
            found = self._level(h, self.q[k:], g).astype(np.float64)
            first = np.flatnonzero(np.diff(g, prepend=-1))
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(g)]):
                low = 1 + int(g[a]) * width
                high = min(k, low + width)
                found[a:b] += self._level(h[a:b], self.q[low:high], t[a:b] - low)
            out[at + order] = found
        return out


def _sums(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, np.cumsum(sizes) - sizes)


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every text.

    Null and empty texts are a lone end.  ``score`` is the log10 of a proper
    distribution: a word in a hashed leaf has the probability of the leaf times its share
    there, ``(c + 1) / (tokens + words of the leaf + 1)``, the last one for all unseen.
    The counts of the ``HELD`` most frequent words are broadcast; the other words of a
    text are kept with its row, which is written, and joined with the table of counts, so
    rarity decides the way, not the size of the corpus.  Ids may be null or repeated.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        scorer = Scorer(own)
        hidden = np.log10(own.mass + own.kinds + 1)
        floor = np.log10(own.tokens + own.types + 1)
        for batch in batches:
            for begin, texts in runs(batch, 1):
                h, sizes = hashes(texts)
                unique, which = np.unique(h, return_inverse=True)
                leaf, c = own.leaf(unique), own.count(unique)
                w = leaf[which]
                logs = scorer.logs(w, *contexts(w, sizes)) / np.log(10)
                logs += np.where(leaf >= own.hashed, np.log10(c + 1) - hidden[leaf], 0.0)[which]
                asked = np.flatnonzero((c == 0)[which])
                ends = np.concatenate([[0], np.cumsum(np.add.reduceat((c == 0)[which].astype(np.int64), np.cumsum(sizes) - sizes))])
                cols = [pa.array(sizes, pa.int64()), pa.array(_sums((c > 0).astype(np.int64)[which], sizes), pa.int64()), pa.array(_sums((np.log10(c + 1) - floor)[which], sizes)), pa.array(_sums(logs, sizes))]
                words = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(h[asked], pa.int64()))
                own_leaf = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(w[asked] >= own.hashed, pa.bool_()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(texts)), *cols, words, own_leaf], ["doc_id", "n_tokens", "known", "base", "own", "words", "shared"])

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    got = keyed.mapInArrow(run, "doc_id long, n_tokens long, known long, base double, own double, words array<long>, shared array<boolean>")
    got = stable(got.withColumn("row", F.monotonically_increasing_id()))
    asked = got.select("row", F.explode(F.arrays_zip("words", "shared")).alias("x")).select("row", F.col("x.words").alias("hash"), F.col("x.shared").alias("shared"))
    log = F.log10(F.col("c") + 1)
    found = asked.join(counts, "hash").groupBy("row").agg(F.count("*").alias("more"), F.sum(log).alias("base_more"), F.sum(F.when(F.col("shared"), log).otherwise(0.0)).alias("own_more"))
    plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0)))
    return got.join(found, "row", "left").select(
        "doc_id", "n_tokens", plus("known", "more").alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"), plus("base", "base_more").alias("base_score"), plus("own", "own_more").alias("score")
    )


def held_out(key: Column) -> Column:
    return F.coalesce(crc_fold(key, 7) == 2, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, counts = fit(docs.where(~held_out(F.col("doc_id"))))
    got = score(docs, model, counts)
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
