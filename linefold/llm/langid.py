"""Language identification by nearest centroid.

A text is the L2-normalised TF-IDF vector of its letter 1- to 3-grams, hashed to
``DIM`` cells.  Each language has several centroids from spherical k-means; the most
cosine-similar centroid names the language.  A text is rejected below the ``REJECT``
quantile of the cosines that texts of the language had to centroids fitted without
them; short texts, whose cosines are lower, have bounds of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_fold, measured, stable, table

DIM, CENTROIDS, ROUNDS = 4096, 4, 12
#: Training texts of each language, on average: the model is fitted on a hash sample.
PER_LANGUAGE = 500
#: The quantile of the cosines of left-out texts below which a text is rejected.
REJECT = 0.005
#: Texts that lie close together reach this many times as far below their median as
#: their lowest twentieth does (3.5 standard deviations of a normal law).
FENCE = 2.1
#: A centroid stands for at least this share of its language's texts.
SUPPORT = 0.02
#: Each text is left out of one fit of so many.
FOLDS = 5
#: Texts of fewer grams than the last are short; the steps divide them by length.
SHORT = np.array([64, 256])
#: Left-out texts that a centroid, or a length of a language, needs for its own bound.
ENOUGH = 20
CHUNK = 256
_KINDS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether a code point is a letter, for all code points; built once."""
    if not _KINDS:
        whole = "".join(map(chr, range(0xD800))) + "?" * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
        is_letter = np.zeros(0x110000, bool)
        for m in regex.finditer(r"[\p{L}\p{M}]+", whole):
            is_letter[m.start() : m.end()] = True
        _KINDS.append(is_letter)
    return _KINDS[0]


def grams(text: str | None) -> np.ndarray | None:
    """Counts of hashed 1- to 3-grams over the lower-cased letters, with one space
    around each run of letters; None for null and for texts without a letter."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    keep = _letters()[c] if len(c) else np.zeros(0, bool)
    if not keep.any():
        return None
    gap = ~keep
    gap[1:] &= keep[:-1]  # one of each run of other characters
    pick = keep | gap
    c = np.where(keep, c, 32)[pick]
    c = np.concatenate(([32], c, [32])).astype(np.uint32)
    mixed = c * np.uint32(0x9E3779B1)
    total = np.zeros(DIM, np.float32)
    roll = mixed
    for _ in range(3):
        total += np.bincount((roll ^ roll >> np.uint32(15)) * np.uint32(0x85EBCA6B) >> np.uint32(32 - DIM.bit_length() + 1), minlength=DIM)
        if len(roll) < 2:
            break
        roll = roll[:-1] * np.uint32(0x01000193) + mixed[len(mixed) - len(roll) + 1 :]
    return total


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    reach: np.ndarray  # the least cosine that is not rejected, for each centroid and length

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, cosine, rejected) of each text; ("und", 0.0, True) for null
        texts, texts without a letter, and when nothing has been learned."""
        out: list[tuple[str, float, bool]] = []
        for at in range(0, len(texts), CHUNK):
            counts = [grams(t) for t in texts[at : at + CHUNK]]
            some = [i for i, x in enumerate(counts) if x is not None]
            part = [("und", 0.0, True)] * len(counts)
            if some and self.languages:
                own = np.stack([counts[i] for i in some])
                likeness = weigh(own, self.idf) @ self.centroids.T
                least = self.least(own.sum(1))
                best = likeness.argmax(axis=1)
                score = np.clip(likeness[np.arange(len(some)), best], 0, 1)
                for k, (i, b, s) in enumerate(zip(some, best.tolist(), score.tolist())):
                    part[i] = (self.languages[b], float(s), bool(s < least[k, b]))
            out += part
        return out

    def least(self, size: np.ndarray) -> np.ndarray:
        """The bound of every centroid for texts of these numbers of grams.  Where too few
        short texts were left out (NaN), the bound of long texts falls with the length."""
        bound = self.reach[:, np.searchsorted(SHORT, size, "right")].T
        return np.where(np.isnan(bound), self.reach[:, -1] * np.minimum(1, size / SHORT[-1])[:, None], bound)


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def cluster(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; seeds are picked farthest from those before."""
    seeds = [int((x @ x.sum(0)).argmax())]
    while len(seeds) < min(k, len(x)):
        seeds.append(int((x @ x[seeds].T).max(axis=1).argmin()))
    c = x[seeds]
    for _ in range(ROUNDS):
        near = (x @ c.T).argmax(axis=1)
        c = np.stack([x[near == i].sum(0) if (near == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


def centroids(x: np.ndarray) -> np.ndarray:
    """Those that do not rest on a few odd texts."""
    c = cluster(x, CENTROIDS).astype(np.float32)
    held = np.bincount((x @ c.T).argmax(axis=1), minlength=len(c))
    return c[held >= min(SUPPORT * len(x), held.max())]


def left_out(x: np.ndarray) -> np.ndarray:
    """The cosine of each text to the nearest centroid fitted without it; NaN for a lone text."""
    got, fold = np.full(len(x), np.nan, np.float32), np.arange(len(x)) % FOLDS
    for f in range(min(FOLDS, len(x)) if len(x) > 1 else 0):
        got[fold == f] = (x[fold == f] @ centroids(x[fold != f]).T).max(axis=1)
    return got


def low(cosine: np.ndarray) -> float:
    """The bound from left-out cosines; one odd text alone does not set it."""
    middle, tail = np.quantile(cosine, [0.5, 0.05])
    return float(min(np.quantile(cosine, REJECT, method="higher"), middle - FENCE * (middle - tail)))


def bounds(names: np.ndarray, near: np.ndarray, langs: np.ndarray, size: np.ndarray, cosine: np.ndarray) -> np.ndarray:
    """A row per centroid, a column per length, the last for long texts.

    ``names`` has the language of each centroid; ``near`` the nearest centroid,
    ``langs`` the language, ``size`` the grams and ``cosine`` the left-out cosine of
    each training text.  Long texts have a bound per centroid, short ones per
    language; with fewer than ``ENOUGH`` texts it is that of the language, then of all.
    """
    step = np.searchsorted(SHORT, size, "right")
    some = ~np.isnan(cosine)
    out = np.full((len(names), len(SHORT) + 1), np.nan)
    for j in range(len(SHORT) + 1):
        whole = cosine[some & (step == j)]
        if len(whole) >= ENOUGH:
            out[:, j] = low(whole)
        for lang in set(names):
            mine = some & (step == j) & (langs == lang)
            if mine.sum() >= ENOUGH:
                out[names == lang, j] = low(cosine[mine])
    for i in range(len(names)):
        mine = some & (step == len(SHORT)) & (near == i)
        if mine.sum() >= ENOUGH:
            out[i, -1] = low(cosine[mine])
    if some.any():
        # no long texts to learn from: the bound of all texts
        out[np.isnan(out[:, -1]), -1] = low(cosine[some])
    else:
        out[:, -1] = 0.0
    return out


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """From ``labelled(key, text, lang)``; rows with a null text, null lang or no
    letter teach nothing.  Each language gives about ``per_language`` texts, picked by
    a hash of ``key``.  Each language is fitted in a task of its own, which gets the
    counts of its texts (16 kB each); the driver gets the centroids."""
    rows = labelled.where("lang is not null and text is not null")
    per = measured(stable(rows.groupBy("lang").count()), 96)
    picked = rows.join(per, "lang").where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < F.least(F.lit(1.0), F.lit(float(per_language)) / F.col("count")) * (1 << 20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(l, x.tobytes()) for l, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if (x := grams(t)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.binary())], ["lang", "grams"])

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, found = 0, np.zeros(DIM, np.int64)
        for batch in batches:
            for g in batch.column(0):
                texts, found = texts + 1, found + (np.frombuffer(g.as_buffer(), np.float32) > 0)
        yield pa.RecordBatch.from_arrays([pa.array([texts], pa.int64()), pa.array([found.tobytes()], pa.binary())], ["n", "found"])

    sample = stable(picked.select("lang", "text").mapInArrow(run, "lang string, grams binary"))
    parts = sample.select("grams").mapInArrow(seen, "n long, found binary").collect()
    texts = sum(r["n"] for r in parts)
    if not texts:
        return Model([], np.zeros((0, DIM), np.float32), np.zeros(DIM, np.float32), np.zeros((0, len(SHORT) + 1)))
    idf = (np.log((1 + texts) / (1 + sum(np.frombuffer(r["found"], np.int64) for r in parts))) + 1).astype(np.float32)

    def one(key, batch):
        counts = np.stack([np.frombuffer(g.as_buffer(), np.float32) for g in batch.column("grams")])
        x = weigh(counts, idf).astype(np.float32)
        order = np.argsort(x @ np.random.default_rng(0).normal(size=DIM), kind="stable")  # whatever order the rows came in
        x, size = x[order], counts.sum(1)[order]
        c = centroids(x)
        cols = [c.tobytes(), (x @ c.T).argmax(axis=1).astype(np.int64).tobytes(), size.astype(np.float32).tobytes(), left_out(x).tobytes()]
        return pa.table({"lang": pa.array([key[0].as_py()], pa.string()), **{k: pa.array([v], pa.binary()) for k, v in zip(("c", "near", "size", "cosine"), cols)}})

    fitted = sorted(sample.groupBy("lang").applyInArrow(one, "lang string, c binary, near binary, size binary, cosine binary").collect(), key=lambda r: r["lang"])
    cents = [np.frombuffer(r["c"], np.float32).reshape(-1, DIM) for r in fitted]
    first = np.cumsum([0, *map(len, cents)])
    names = [r["lang"] for r, c in zip(fitted, cents) for _ in c]
    near = [np.frombuffer(r["near"], np.int64) for r in fitted]
    langs = np.array([r["lang"] for r, n in zip(fitted, near) for _ in n], object)
    flat = lambda k: np.concatenate([np.frombuffer(r[k], np.float32) for r in fitted])
    reach = bounds(np.array(names, object), np.concatenate([n + f for n, f in zip(near, first)]), langs, flat("size"), flat("cosine"))
    return Model(names, np.concatenate(cents), idf, reach)


SCHEMA = "doc_id long, lang_pred string, score double, rejected boolean"


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every whole text, without a shuffle.

    Only the text is looked at.  ``score`` is the cosine to the nearest centroid.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 16 kB a centroid, CENTROIDS a language at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = sent.value.predict(batch.column(1).to_pylist())
            cols = [pa.array([g[i] for g in got], t) for i, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def held_out(key: Column) -> Column:
    """Keys kept from training; a null key is not."""
    return F.coalesce(crc_fold(key, 4) == 2, F.lit(False))


def fit_documents(docs: DataFrame) -> Model:
    return fit(docs.where(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("key"), "text", "lang"))


def keep_known(docs: DataFrame) -> DataFrame:
    """The documents that a model fitted on them does not reject, with all columns.

    Rejected: null texts, texts without a letter, and texts too far from every
    centroid.  Decided row by row inside one map, so ids need not be unique.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_documents(docs))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([not r for _, _, r in model.value.predict(batch.column(at).to_pylist())]))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = predict(docs, fit_documents(docs))
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
