"""Benchmark decontamination with one Aho-Corasick automaton.

The benchmark items become windows of ``WINDOW`` normalised words; one automaton
over all windows scans each document once.  Its letters are numbers of benchmark
words, so a window has at most ``WINDOW`` nodes however long its words are.  A match
ends at a word number, and word numbers map to code-point offsets in the original.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, measured, stable, table, word_hashes

WINDOW = 13
#: Benchmark words that one automaton takes, with at most ``WINDOW`` nodes each (about
#: 150 MB in a worker); a larger benchmark is scanned in several passes over all documents.
BLOCK_WORDS = 150_000
#: Windows of an item that stay together; a longer item is cut into overlapping pieces.
PIECE = 2_000
#: Texts are looked through in runs of about so many bytes.
RUN_BYTES = 1 << 20
#: A word in text whose A-Z are not lower-cased yet.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Every ASCII byte that is not in a word becomes a space; A-Z become a-z.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: The column that numbers the rows where the benchmark has several blocks.
ROW = "_row"
SCHEMA = "doc_id long, n_words long, hits array<struct<first:int,last:int>>, spans array<struct<begin:int,end:int>>, items array<long>"


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


class Windows:
    """One automaton over all windows of pieces ``(item, words)``; each piece is a run of
    an item's words, and a piece shorter than a window is one window."""

    def __init__(self, pieces: list[tuple[int, list[bytes]]]) -> None:
        self.numbers: dict[bytes, int] = {}
        self.owners: list[set[int]] = []
        self.lengths: list[int] = []
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for item, own in pieces:
            ids = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in own)
            for i in range(max(1, len(ids) - WINDOW + 1) if ids else 0):
                window = ids[i : i + WINDOW]
                at = self.automaton.get(window, -1)
                if at < 0:
                    at = len(self.owners)
                    self.automaton.add_word(window, at)
                    self.owners.append(set())
                    self.lengths.append(len(window))
                self.owners[at].add(item)
        if self.owners:
            self.automaton.make_automaton()
        self.least = min(self.lengths, default=0)
        line = np.frombuffer(b" ".join(self.numbers), np.uint8)
        self.known = np.zeros(1 << 22, bool)
        self.known[self._cells(line, np.cumsum([0, *(len(w) + 1 for w in self.numbers)])[:-1])] = True

    @staticmethod
    def _cells(c: np.ndarray, begin: np.ndarray) -> np.ndarray:
        h = word_hashes(c, begin)
        return ((h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(42)).astype(np.int64)

    def look(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of words, and whether a text has a run of words of the benchmark as long
        as the shortest window; only such a text can hold one."""
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        c = np.frombuffer(b" ".join(raw).translate(_FOLD) + b" ", np.uint8)
        first = c != 32
        first[1:] &= c[:-1] == 32
        begin = np.flatnonzero(first)
        last = np.searchsorted(begin, np.cumsum([len(r) + 1 for r in raw]))
        n = np.diff(last, prepend=0)
        held = np.zeros(len(texts), bool)
        if len(begin) and self.owners:
            at = np.arange(len(begin))
            stop = np.where(self.known[self._cells(c, begin)], -1, at)
            run = at - np.maximum(np.maximum.accumulate(stop), np.repeat(last - n, n) - 1)
            some = np.flatnonzero(n)
            held[some] = np.maximum.reduceat(run, (last - n)[some]) >= self.least
        return n, held

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[int]]:
        """Number of words; merged runs (first, last) of hit words; items found."""
        w = words(text)
        if not w or not self.owners:
            return len(w), [], set()
        number = self.numbers.get
        found = list(self.automaton.iter(tuple([number(x, 0) for x in w])))
        items: set[int] = set()
        runs: list[list[int]] = []
        for first, last in sorted((last - self.lengths[at] + 1, last) for last, at in found):
            if runs and first <= runs[-1][1] + 1:
                runs[-1][1] = max(runs[-1][1], last)
            else:
                runs.append([first, last])
        for at in {at for _, at in found}:
            items |= self.owners[at]
        return len(w), [(a, b) for a, b in runs], items


def original(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code-point offsets of runs of words in the text as it was given."""
    at = [(m.start(), m.end()) for m in WORD.finditer(text)]
    return [(at[a][0], at[b][1]) for a, b in runs]


def _looked(own: Windows, column: pa.Array) -> Iterator[tuple[str | None, int, bool]]:
    """(text, number of words, whether it must be scanned), a run of texts at a time."""
    size, texts = 0, []
    for t in column.to_pylist():
        texts.append(t)
        size += len(t or "")
        if size >= RUN_BYTES:
            n, held = own.look(texts)
            yield from zip(texts, n.tolist(), held.tolist())
            size, texts = 0, []
    if texts:
        n, held = own.look(texts)
        yield from zip(texts, n.tolist(), held.tolist())


Load = Callable[[], list[tuple[int, list[bytes]]]]


_MADE: dict[str, Windows] = {}


def _windows(spark: SparkSession, pieces: list[tuple[int, list[bytes]]]) -> Callable[[], Windows]:
    """What gives a worker the automaton; a worker builds it once and holds one."""
    name = uuid.uuid4().hex
    sent = spark.sparkContext.broadcast(pieces)  # BLOCK_WORDS words

    def made() -> Windows:
        if name not in _MADE:
            _MADE.clear()
            _MADE[name] = Windows(sent.value)
        return _MADE[name]

    return made


def _pass(docs: DataFrame, pieces: list[tuple[int, list[bytes]]]) -> DataFrame:
    ids = [ROW] if ROW in docs.columns else []
    made = _windows(docs.sparkSession, pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = made()
        for batch in batches:
            cols: list[list] = [[], [], [], []]
            for text, n, held in _looked(own, batch.column(batch.num_columns - 1)):
                runs, found = own.scan(text)[1:] if held else ([], ())
                spans = original(text, runs) if runs else []
                for c, v in zip(cols, (n, [{"first": a, "last": b} for a, b in runs], [{"begin": a, "end": b} for a, b in spans], sorted(found))):
                    c.append(v)
            pair = lambda a, b: pa.list_(pa.struct([(a, pa.int32()), (b, pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(cols[0], pa.int64()), pa.array(cols[1], pair("first", "last")), pa.array(cols[2], pair("begin", "end")), pa.array(cols[3], pa.list_(pa.int64()))],
                [*ids, "doc_id", "n_words", "hits", "spans", "items"],
            )

    return docs.select(*ids, F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"{ROW} long, {SCHEMA}" if ids else SCHEMA)


def _blocks(benchmark: DataFrame, block_words: int) -> list[Load]:
    """What loads each block of pieces of the items, of about ``block_words`` words."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.regexp_extract_all(lower, F.lit(WORD.pattern), F.lit(0)).alias("w")).where("item_id is not null and size(w) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("w") - WINDOW), F.lit(PIECE))
    pieces = items.select("item_id", "w", F.explode(starts).alias("at")).select("item_id", "at", F.slice("w", F.col("at") + 1, F.lit(PIECE + WINDOW - 1)).alias("w"))
    blocks = max(1, -(-(pieces.agg(F.sum(F.size("w"))).first()[0] or 0) // block_words))
    pick = lambda b: pieces.where(F.pmod(F.xxhash64("item_id", "at"), F.lit(blocks)) == b).select("item_id", "w")
    return [lambda b=b: [(r[0], [x.encode("utf-8", "surrogatepass") for x in r[1]]) for r in pick(b).collect()] for b in range(blocks)]


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number of its own for each row, which stays whatever is read again."""
    return stable(docs.withColumn(ROW, F.monotonically_increasing_id()))


def _passes(numbered: DataFrame, blocks: list[Load]) -> DataFrame:
    first, *more = [_pass(numbered, load()) for load in blocks]
    sparse = None
    for df in [first, *more]:
        part = stable(df.where("size(items) > 0").select(ROW, F.explode("items").alias("item"), "hits", "spans"))
        sparse = part if sparse is None else sparse.unionAll(part)
    gathered = sparse.groupBy(ROW).agg(F.array_sort(F.collect_set("item")).alias("items"), F.flatten(F.collect_set("hits")).alias("hits"), F.flatten(F.collect_set("spans")).alias("spans"))
    gathered = map_arrow(gathered.select(ROW, "items", "hits", "spans"), _merged, f"{ROW} long, items array<long>, hits array<struct<first:int,last:int>>, spans array<struct<begin:int,end:int>>")
    counted = first.select(ROW, "doc_id", "n_words")
    empty = lambda c: F.coalesce(c, F.array().cast(gathered.schema[c].dataType)).alias(c)
    return counted.join(gathered, ROW, "left").select(ROW, "doc_id", "n_words", empty("hits"), empty("spans"), empty("items"))


def matches(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row per document: ``doc_id, n_words, hits`` (merged runs of word
    numbers), ``spans`` (the same as code-point offsets in the original text) and
    ``items`` (sorted ids of the items with an occurring window).

    Null and empty texts have no words and no hits; items without words (null,
    empty) and rows without item_id have no windows; repeated items count once.
    A benchmark beyond ``block_words`` words is split by a hash of its pieces into blocks
    of about that size; the documents are numbered and written, each block is one more
    pass over them, and its few hits are written and joined by the number of the row.
    Ids may be null or repeated.
    """
    blocks = _blocks(benchmark, block_words)
    if len(blocks) == 1:
        return _pass(docs, blocks[0]())
    return _passes(_numbered(docs.select("doc_id", "text")), blocks).drop(ROW)


def _merged(batch: pa.RecordBatch) -> pa.RecordBatch:
    def union(rows: list[list[dict]], a: str, b: str, gap: int) -> list[list[dict]]:
        out = []
        for row in rows:
            runs: list[dict] = []
            for x in sorted(row, key=lambda x: (x[a], x[b])):
                if runs and x[a] <= runs[-1][b] + gap:
                    runs[-1][b] = max(runs[-1][b], x[b])
                else:
                    runs.append(dict(x))
            out.append(runs)
        return out

    hits = union(batch.column(2).to_pylist(), "first", "last", 1)
    spans = union(batch.column(3).to_pylist(), "begin", "end", 0)
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hits, batch.column(2).type), pa.array(spans, batch.column(3).type)], [ROW, "items", "hits", "spans"])


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from :func:`matches`."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda s, x: s + x["last"] - x["first"] + 1)
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.withColumn("n_hit", n_hit).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents in which no window of the benchmark occurs, with all columns.

    One window is enough to drop a document, however long it is.  Decided row by row,
    so ids may be null or repeated; documents without words stay.
    """
    blocks = _blocks(benchmark, block_words)
    if len(blocks) > 1:
        numbered = _numbered(docs)
        bad = _passes(numbered, blocks).where(F.size("hits") > 0).select(ROW)
        return numbered.join(measured(stable(bad), 32), ROW, "left_anti").select(*docs.columns)
    made = _windows(docs.sparkSession, blocks[0]())
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = made()
        for batch in batches:
            yield batch.filter(pa.array([not (held and own.scan(t)[1]) for t, _, held in _looked(own, batch.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))

