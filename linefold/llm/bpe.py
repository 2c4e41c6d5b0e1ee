"""Byte-level BPE encoding and decoding with a two-tier lookup.

Pre-tokens that are vocabulary entries resolve through a minimal perfect hash
(hash, displace, compare the key); the others are merged with a heap of candidate
pairs over a linked list of byte pieces.  A worker looks each pre-token up once.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Distinct pre-tokens that a worker remembers; beyond, it begins anew.
REMEMBER = 1 << 18
#: Texts are encoded in runs of about so many bytes, to bound memory.
RUN_CHARS = 1 << 18


class PerfectHash:
    """A minimal perfect hash from ``n`` byte keys to their values.

    Keys fall into buckets of four on average; from the fullest bucket on, the
    first displacement that sends all keys of the bucket to free slots is kept.
    """

    def __init__(self, keys: list[bytes], values: list[int]) -> None:
        self.n = n = max(1, len(keys))
        self.buckets = n // 4 + 1
        self.shift = np.zeros(self.buckets, np.int64)  # below zero: -1 - slot, for a bucket of one key
        slot = np.full(n, -1, np.int64)
        by: dict[int, list[int]] = {}
        hashes = self.hashes(keys)
        for i, b in enumerate((hashes % np.uint64(self.buckets)).tolist()):
            by.setdefault(b, []).append(i)
        free = np.ones(n, bool)
        order = sorted(by.items(), key=lambda x: -len(x[1]))
        for b, members in order:
            if len(members) == 1:
                break
            own, tries = hashes[members], 16
            d = np.arange(tries)
            while True:
                at = np.sort(self._slots(own[None, :], d[:, None]), axis=1)
                good = np.flatnonzero(free[at].all(axis=1) & (np.diff(at, axis=1) > 0).all(axis=1))
                if len(good):
                    break
                d = np.arange(d[-1] + 1, d[-1] + 1 + tries)
                tries = min(4096, tries * 4)
                if d[0] > 1 << 24:
                    raise ValueError("two keys have one hash")
            self.shift[b] = d[good[0]]
            at = self._slots(own, self.shift[b])
            free[at], slot[at] = False, members
        for (b, (i,)), s in zip([x for x in order if len(x[1]) == 1], np.flatnonzero(free).tolist()):
            self.shift[b], slot[s] = -1 - s, i
        self.keys = [keys[i] for i in slot] if keys else [None]
        self.values = [values[i] for i in slot] if keys else [-1]

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    def _slots(self, hashes: np.ndarray, d) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = (hashes ^ (np.asarray(d).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
            return ((x >> np.uint64(31)) % np.uint64(self.n)).astype(np.int64)

    def find(self, keys: list[bytes]) -> list[int]:
        """The value of each key, -1 for keys that are not in the table."""
        h = self.hashes(keys)
        d = self.shift[(h % np.uint64(self.buckets)).astype(np.int64)]
        at = np.where(d < 0, -1 - d, self._slots(h, d)).tolist()
        own, values = self.keys, self.values
        return [values[s] if own[s] == k else -1 for s, k in zip(at, keys)]


class Splitter:
    """The tokenizers' public pattern, over arrays of code points.

    The pattern's rules in terms of runs of letters, numbers, white space and
    others: a run takes one space before it along; white space before anything else
    leaves its last character out; an apostrophe that begins a match takes one of
    seven endings along.
    """

    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    SPACE, LETTER, NUMBER, OTHER, EDGE = range(5)

    def __init__(self) -> None:
        whole = "".join(map(chr, range(0xD800))) + "?" * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
        self.kind = np.full(0x110001, self.OTHER, np.uint8)
        for kind, name in ((self.SPACE, r"\s+"), (self.LETTER, r"\p{L}+"), (self.NUMBER, r"\p{N}+")):
            for m in regex.finditer(name, whole):
                self.kind[m.start() : m.end()] = kind
        self.kind[0x110000] = self.EDGE

    def starts(self, c: np.ndarray) -> np.ndarray:
        """Where the matches and the edges (code 0x110000) of ``c`` begin; ``c``
        begins and ends with an edge."""
        kind = self.kind[c]
        turn = np.empty(len(c), bool)
        turn[0] = True
        np.not_equal(kind[1:], kind[:-1], out=turn[1:])
        turn |= kind == self.EDGE
        first = turn.copy()
        # the last of the white space before a run of something else
        runs = np.flatnonzero(turn)
        after = runs[1:][(kind[runs[1:] - 1] == self.SPACE) & (kind[runs[1:]] != self.EDGE)]
        first[after - 1] = True
        first[after[c[after - 1] == 32]] = False
        quote = np.flatnonzero((c[:-1] == 39) & turn[:-1] & (kind[1:] == self.LETTER))
        quote = quote[c[quote - 1] != 32]
        if len(quote):
            x, y = c[quote + 1], c[np.minimum(quote + 2, len(c) - 1)]
            size = np.where(np.isin(x, [115, 116, 109, 100]), 2, 0)
            for u, v in ((114, 101), (118, 101), (108, 108)):
                size[(x == u) & (y == v)] = 3
            quote, size = quote[size > 0], size[size > 0]
            first[quote + 1] = False
            first[quote + size] = True
        return np.flatnonzero(first)


class Codec:
    """Encoding by the ranks of a vocabulary (bytes to rank), ids back to bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, table: PerfectHash | None = None, splitter: Splitter | None = None) -> None:
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.table = table or PerfectHash(list(ranks), list(ranks.values()))
        self.splitter = (splitter or Splitter()) if pattern == Splitter.PATTERN else None
        self.pieces = {v: k for k, v in ranks.items()}
        self.pairs = [ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)]
        self.power = np.ones(1, np.uint64)
        self.forget()

    def forget(self) -> None:
        self.number: dict[int, int] = {}
        self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, "<u4")

    def whole(self, pretokens: list[bytes]) -> list[list[int]]:
        """The ids of each pre-token: from the table, or else merged."""
        return [[r] if r >= 0 else self.merge(b) for b, r in zip(pretokens, self.table.find(pretokens))]

    def merge(self, piece: bytes) -> list[int]:
        """Lowest rank first, leftmost first: a heap of pairs over linked parts.

        A part is known by where it begins; ``end[i]`` is where it ends (0: merged
        into the part before) and so where the next begins.
        """
        get, n = self.ranks.get, len(piece)
        end, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [r << 64 | i << 32 | i + 2 for i, (a, b) in enumerate(zip(piece, piece[1:])) if (r := self.pairs[a << 8 | b]) >= 0]
        heapify(heap)
        while heap:
            x = heappop(heap)
            i, stop = x >> 32 & 0xFFFFFFFF, x & 0xFFFFFFFF
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue  # one of the two parts has changed since
            end[i], end[j] = stop, 0
            if stop < n:
                left[stop] = i
                to = end[stop]
                if (r := get(piece[i:to])) is not None:
                    heappush(heap, r << 64 | i << 32 | to)
            if (k := left[i]) >= 0 and (r := get(piece[k:stop])) is not None:
                heappush(heap, r << 64 | k << 32 | stop)
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, bytes]]:
        """The ids of each text, as little-endian unsigned 32-bit integers, and the
        bytes that they decode to.

        Pre-tokens are told apart by a 64-bit hash; a clash would show in the decoded
        bytes, and then that text is encoded again, match by match.
        """
        if self.splitter is None:
            return [self.slow(t) for t in texts]
        out = []
        for text, ids in zip(texts, self._fast(texts)):
            back = self.decode(ids)
            out.append((ids, back) if back == text.encode("utf-8", "surrogatepass") else self.slow(text))
        return out

    def slow(self, text: str) -> tuple[np.ndarray, bytes]:
        parts = [t.encode("utf-8", "surrogatepass") for t in self.pattern.findall(text)]
        ids = np.fromiter(chain.from_iterable(self.whole(parts)), np.int64).astype("<u4")
        return ids, self.decode(ids)

    def _fast(self, texts: list[str]) -> list[np.ndarray]:
        edge = np.array([0x110000], "<u4")
        parts = [edge]
        for t in texts:
            parts += [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4"), edge]
        c = np.concatenate(parts)
        starts = self.splitter.starts(c)
        length = np.diff(starts, append=len(c))
        while len(self.power) < length.max():
            last = self.power[-1:] * np.uint64(0x9E3779B97F4A7C15)
            self.power = np.concatenate([self.power, self.power * last])
        place = np.arange(len(c)) - np.repeat(starts, length)
        code = (c.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        code ^= code >> np.uint64(32)
        hashes = np.add.reduceat(code * self.power[place], starts)
        edges = np.flatnonzero(c[starts] == 0x110000)
        unique, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.number) > REMEMBER:
            self.forget()
        number, keys = self.number, unique.tolist()
        new = [i for i, k in enumerate(keys) if k not in number]
        if new:
            raw = [c[a : a + n].tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass") if c[a] != 0x110000 else b"" for a, n in zip(starts[first[new]].tolist(), length[first[new]].tolist())]
            fresh = self.whole(raw)
            for i in new:
                number[keys[i]] = len(number)
            self.size = np.concatenate([self.size, np.fromiter(map(len, fresh), np.int64, len(fresh))])
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(fresh), np.int64).astype("<u4")])
        begin = np.cumsum(self.size) - self.size
        row = np.fromiter(map(number.__getitem__, keys), np.int64, len(keys))[which]
        n = self.size[row]
        ends = np.cumsum(n)
        ids = self.flat[np.arange(int(ends[-1])) + np.repeat(begin[row] - (ends - n), n)]
        cuts = ends[edges].tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def decode(self, ids) -> bytes:
        """The bytes of ids; an unknown id raises KeyError."""
        return b"".join(map(self.pieces.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))


def read_ranks(data: bytes) -> dict[bytes, int]:
    """A rank file: base64 of the bytes, a space, the rank, on each line."""
    return {base64.b64decode(k): int(v) for k, v in (line.split() for line in data.splitlines() if line.strip())}


_CODECS: dict[str, Codec] = {}


def codec(data: bytes, pattern: str, table: PerfectHash | None = None, splitter: Splitter | None = None) -> Codec:
    """The process's codec for a rank file, built once."""
    key = f"{hashlib.sha256(data).hexdigest()} {pattern}"
    if key not in _CODECS:
        _CODECS[key] = Codec(read_ranks(data), pattern, table, splitter)
    return _CODECS[key]


def _runs(column: pa.Array) -> Iterator[list[str]]:
    """The column's texts (null: empty) in runs of at least RUN_CHARS bytes, the last
    excepted; only one run's texts are held at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = before = 0
    while at < len(column):
        to = min(len(column), int(np.searchsorted(ends, before + RUN_CHARS)) + 1)
        yield [t or "" for t in column.slice(at, to - at).to_pylist()]
        at, before = to, int(ends[to - 1])


SCHEMA = "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string"


def encode(docs: DataFrame, path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """A row per document: ``doc_id, n_tokens, ids, ids_sha256, decoded_sha256``.

    ``path`` is a rank file that the driver reads (about 1 MB, sent to executors).
    A null text is encoded as the empty text: no ids.  Nothing is shuffled.
    ``with_ids=False`` leaves ``ids`` null where only the digests are wanted.
    """
    with open(path, "rb") as f:
        data = f.read()
    own = codec(data, pattern)
    sent = docs.sparkSession.sparkContext.broadcast((data, pattern, own.table, own.splitter))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(*sent.value)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            at = 0
            for texts in _runs(batch.column(1)):
                ids, back = zip(*coder.encode(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([x.view(np.int32) for x in ids] if with_ids else [None] * len(ids), pa.list_(pa.int32())),
                        pa.array([sha(x.tobytes()) for x in ids]),
                        pa.array([sha(x) for x in back]),
                    ],
                    ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"],
                )
                at += len(texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``rows(doc_id, ids array<int>)`` back to ``(doc_id, text)``.

    Ids that are null give a null text; bytes that are no UTF-8 are replaced.
    """
    with open(path, "rb") as f:
        data = rows.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(data.value, "")
        for batch in batches:
            texts = [None if x is None else coder.decode(x).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def tokenizer(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def digests(docs: DataFrame) -> DataFrame:
    return encode(docs, *tokenizer(), with_ids=False).drop("ids")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
