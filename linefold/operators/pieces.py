"""The lines of documents, their character classes and both rule cascades over Arrow batches.

The same rows as ``plans.lines`` gives in SQL (the tests compare them).  All texts of a
slice are one array of code points: it is cut, translated and judged as a whole, and only
the lines in which a marker of the last rules occurs are looked at one by one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ..plans import lines as ln
from ..plans import loader

#: Bytes of text that are held as code points at a time; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20
LONG_WORD = 40
_NAMES = ["blank", "dev", "letters", "latin", "digits", "symbols", "label_symbols", "bad", "brackets", "digit"]
BIT = {name: 1 << i for i, name in enumerate(_NAMES)}
#: Columns that may be asked for beside the lines, with their types.
COUNTS = {"n": "", "n_dev": "dev", "n_letters": "letters", "n_latin": "latin", "n_digits": "digits", "n_symbols": "symbols", "n_label_symbols": "label_symbols"}
TYPES = {**{c: "int" for c in COUNTS}, "first_reason": "string", "reason": "string", "digit": "boolean"}
BASE = "doc_id long, source string, lang string, line_no int, piece_no int, t string"

FIRST = ["keep", "blank", "too_short", "no_devanagari", "insufficient_devanagari_letters", "too_much_latin", "insufficient_devanagari_ratio", "consecutive_junk_symbols", "ocr_junk_filter"]
SECOND = [
    "keep", "too_short", "too_long", "contains_ascii_digit", "bad_ocr_symbols", "brackets_or_guillemets", "noisy_header", "fragment_like_too_few_letters", "fragment_like_mostly_non_letters", "low_devanagari_ratio",
    *(f"ocr_junk_pattern_{w}" for w in ln.JUNK_WORDS), "ocr_junk_repeating_digits", "ocr_junk_latin_characters", "ocr_junk_long_word_garbage", "symbol_heavy", "reference_or_frontmatter_fragment",
]
HEADER, REPEATED = "भाषाबंशावती", "००००"
REFERENCES = [re.compile(p, re.ASCII) for p in ("अशुद्ध|शुद्ध अशुद्ध|बिषय-सूची|विषय-सूची|सूची-पत्र|सहायक ग्रन्थ", "(ऐजन|एैजन|एजन)\\s*(पृ|पू)[.]", "पृष्ठ\\s*[०-९0-9]+")]
NUMBERED = re.compile(r"^\s*[०-९0-9]+\s*[.]\s*[a-zA-Zऀ-ॿ]", re.ASCII)
#: One of these is in every line that a rule on words rejects.
MARKERS = "|".join(map(re.escape, [HEADER, *ln.JUNK_WORDS, REPEATED, "अशुद्ध", "बिषय-सूची", "विषय-सूची", "सूची-पत्र", "सहायक ग्रन्थ", "ऐजन", "एैजन", "एजन", "पृष्ठ", *ln.CITING]))


def _classes() -> np.ndarray:
    """The classes of every code point, as bits."""
    table = np.zeros(0x110000, np.uint16)
    blank = re.compile("[" + re.sub(r"\\x\{(\w+)\}", r"\\u\1", ln.BLANK) + "]")
    table[[c for c in range(0x10000) if blank.match(chr(c))]] = BIT["blank"]
    for name, ranges in {"dev": ["ऀॿ"], "letters": ["ऀॣ", "॰ॿ"], "latin": ["az", "AZ"], "digits": ["09"], "digit": ["09", ln.DIGITS[0] + ln.DIGITS[-1]]}.items():
        for a, b in ranges:
            table[ord(a) : ord(b) + 1] |= BIT[name]
    for a, b in re.findall("(.)(?:-(.))?", ln.OTHER_DIGITS):
        table[ord(a) : ord(b or a) + 1] |= BIT["digit"]
    for name, characters in {"symbols": ln.SYMBOLS, "label_symbols": ln.LABEL_SYMBOLS, "bad": ln.BAD_SYMBOLS[:8], "brackets": ln.BAD_SYMBOLS[8:]}.items():
        for c in characters:
            table[ord(c)] |= BIT[name]
    return table


CLASSES = _classes()


def _letters(lower: bool) -> np.ndarray:
    """What each ASCII character becomes, blanks apart."""
    to = np.arange(128, dtype=np.uint32)
    for a, b in zip(ln.SRC, ln.DST, strict=True):
        to[ord(a)] = ord(b)
        if lower:
            to[ord(a.upper())] = ord(b)
    return to


LETTERS = {lower: _letters(lower) for lower in (False, True)}


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of code points, and where each begins (and the last ends);
    bytes that are no text become replacement marks, as in the engine."""
    texts = texts.cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    try:
        cp = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    except UnicodeDecodeError:
        return code_points(pa.array([b.decode("utf-8", "replace") for b in texts.cast(pa.binary()).to_pylist()], pa.string()))
    if len(cp) == len(raw):
        return cp, offsets - offsets[0]
    before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return cp, before[offsets - offsets[0]]


def as_texts(cp: np.ndarray, at: np.ndarray) -> pa.Array:
    """The inverse of ``code_points``."""
    data = cp.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
    size = 1 + (cp >= 0x80).astype(np.uint8) + (cp >= 0x800) + (cp >= 0x10000)
    offsets = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])[at].astype(np.int32)
    return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(offsets), pa.py_buffer(data))


def starts_at(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


class Slice:
    """Lines as code points ``cp``, line i from ``at[i]`` to ``at[i + 1]``."""

    def __init__(self, cp: np.ndarray, at: np.ndarray):
        self.cp, self.at, self.n = cp, at, np.diff(at)
        self.cls, self.filled = CLASSES[cp], np.flatnonzero(self.n)
        self.texts = as_texts(cp, at)

    def reduced(self, ufunc: np.ufunc, x: np.ndarray, dtype=None) -> np.ndarray:
        """A reduction over each line's characters; 0 for a line without any."""
        out = np.zeros(len(self.n), dtype or x.dtype)
        if len(self.filled):
            out[self.filled] = ufunc.reduceat(x, self.at[self.filled], dtype=dtype)
        return out

    def count(self, name: str) -> np.ndarray:
        return self.reduced(np.add, (self.cls & BIT[name]) != 0, np.int64)

    def any(self) -> np.ndarray:
        """All classes that occur in each line."""
        return self.reduced(np.bitwise_or, self.cls)

    def long_word(self) -> np.ndarray:
        """Whether a line has ``LONG_WORD`` characters without a space."""
        last, hit = self.at[:-1] - 1, np.zeros(len(self.n), bool)
        at = np.flatnonzero(self.cp == 32)
        if len(at):
            line = np.searchsorted(self.at, at, side="right") - 1
            before = np.concatenate([[-1], at[:-1]])
            gap = at - np.maximum(before, last[line]) - 1
            hit[line[gap >= LONG_WORD]] = True
            last = last.copy()
            last[line] = at
        return hit | (self.at[1:] - last - 1 >= LONG_WORD)

    def first_reasons(self) -> np.ndarray:
        n, dev, letters, latin, digits = self.n, *(self.count(c) for c in ("dev", "letters", "latin", "digits"))
        out = np.select([n == 0, n < 5, dev == 0, letters < 2, 20 * latin > 3 * n, 5 * dev < 2 * n], [1, 2, 3, 4, 5, 6], 0)
        junk = ((n < 25) & (digits > 2) & (letters < 6) & (20 * digits > 3 * n)) | (5 * self.count("symbols") > n) | self.long_word()
        left = np.flatnonzero(out == 0)
        some = self.texts.take(pa.array(left))
        odd = np.asarray(pc.match_substring_regex(some, r"[^a-zA-Z0-9ऀ-ॿ\s।॥]{3,}"))
        runs = np.asarray(pc.match_substring_regex(some, r"[0-1]{4,}|[0-9]{5,}|:{3,}[0-9]+|:{2,}[0-9]+:{2,}"))
        out[left] = np.select([odd, junk[left] | runs], [7, 8], 0)
        return out

    def reasons(self) -> np.ndarray:
        n, dev, letters, held = self.n, self.count("dev"), self.count("letters"), self.any()
        code = {name: i for i, name in enumerate(SECOND)}
        has = lambda name: (held & BIT[name]) != 0
        early = np.select([n < 5, n > 160, has("digits"), has("bad"), has("brackets")], [1, 2, 3, 4, 5], 0)
        middle = np.select([letters < 4, (n < 12) & (10 * (n - letters) > 6 * n), 2 * dev < n], [7, 8, 9], 0)
        late = np.select([has("latin"), self.long_word(), 20 * self.count("label_symbols") > 3 * n], [code["ocr_junk_latin_characters"], code["ocr_junk_long_word_garbage"], code["symbol_heavy"]], 0)
        out = np.where(early > 0, early, np.where(middle > 0, middle, late))
        open_ = np.flatnonzero(early == 0)
        some = self.texts.take(pa.array(open_))
        marked = open_[np.asarray(pc.match_substring_regex(some, MARKERS))]
        for i, t in zip(marked, self.texts.take(pa.array(marked)).to_pylist()):
            out[i] = code[_worded(t, int(middle[i]), int(late[i]))]
        return out


def _worded(t: str, middle: int, late: int) -> str:
    """The second cascade for a line that got past its first rules, given what the rules
    on counts say."""
    if HEADER in t:
        return "noisy_header"
    if middle:
        return SECOND[middle]
    for w in ln.JUNK_WORDS:
        if w in t:
            return f"ocr_junk_pattern_{w}"
    if REPEATED in t:
        return "ocr_junk_repeating_digits"
    if late:
        return SECOND[late]
    referring = any(p.search(t) for p in REFERENCES) or (NUMBERED.search(t) and any(w in t for w in ln.CITING))
    return "reference_or_frontmatter_fragment" if referring else "keep"


def cut(cp: np.ndarray, docs: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lines of texts: code points, where each begins, text, line and piece number.
    Texts are cut at line feeds and after a full stop before a space."""
    size, first = len(cp), docs[:-1]
    feed = np.flatnonzero(cp == 10)
    stop = np.flatnonzero((cp[:-1] == 46) & (cp[1:] == 32))
    begins = np.zeros(size + 2, bool)
    begins[first] = True
    stop = stop[~begins[stop + 1]]
    # Where a text is empty or ends with a cut, the cut's piece comes before the next text.
    at = np.concatenate([feed + 1, stop + 2, first])
    kind = np.repeat([1, 2, 0], [len(feed), len(stop), len(first)])
    order = np.argsort(at, kind="stable")
    at, kind = at[order], kind[order]
    ends = np.append(at[1:] - kind[1:], size)
    inside = np.ones(size, bool)
    inside[feed] = inside[stop] = inside[stop + 1] = False
    here = np.arange(len(at))
    text = np.cumsum(kind == 0) - 1
    line = np.cumsum(kind == 1)
    line_no = line - line[np.flatnonzero(kind == 0)][text]
    piece_no = here - np.maximum.accumulate(np.where(kind == 2, 0, here))

    cp, n = cp[inside], ends - at
    at = starts_at(n)
    blank = (CLASSES[cp] & BIT["blank"]) != 0
    after = np.empty(len(cp), bool)
    after[1:] = blank[:-1]
    after[at[:-1][n > 0]] = True
    stays = ~(blank & after)
    cp, blank = cp[stays], blank[stays]
    at = np.concatenate([[0], np.cumsum(stays)])[at]
    ends = at[1:][np.diff(at) > 0] - 1
    last = ends[blank[ends]]
    if len(last):
        stays = np.ones(len(cp), bool)
        stays[last] = False
        cp, blank = cp[stays], blank[stays]
        at = np.concatenate([[0], np.cumsum(stays)])[at]
    low = cp < 128
    cp = cp.copy()
    cp[low] = LETTERS[lower][cp[low]]
    cp[blank] = 32
    return cp, at, text, line_no, piece_no


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text each, one row at least."""
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def pieces(documents: DataFrame, lower: bool, also: list[str], kept: bool = False) -> DataFrame:
    """Rows (doc_id, source, lang, line_no, piece_no, t) of ``documents(doc_id, source,
    lang, text)``, with the columns ``also``; only those the second cascade keeps, if so asked."""
    schema = ", ".join([BASE, *(f"{c} {TYPES[c]}" for c in also)])
    names = [c.split()[0] for c in schema.split(", ")]

    def column(s: Slice, name: str, reasons: np.ndarray | None) -> pa.Array:
        if name == "n":
            return pa.array(s.n, pa.int32())
        if name in COUNTS:
            return pa.array(s.count(COUNTS[name]), pa.int32())
        if name == "digit":
            return pa.array((s.any() & BIT["digit"]) != 0)
        if name == "first_reason":
            return pa.array(FIRST).take(pa.array(s.first_reasons()))
        return pa.array(SECOND).take(pa.array(s.reasons() if reasons is None else reasons))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 3):
                cp, at, text, line_no, piece_no = cut(*code_points(part.column(3)), lower)
                s = Slice(cp, at)
                reasons = s.reasons() if kept else None
                own = [part.column(i).take(pa.array(text)) for i in range(3)]
                cols = [*own, pa.array(line_no, pa.int32()), pa.array(piece_no, pa.int32()), s.texts, *(column(s, c, reasons) for c in also)]
                rows = pa.RecordBatch.from_arrays(cols, names)
                yield rows.filter(pa.array(reasons == 0)) if kept else rows

    return documents.select("doc_id", "source", "lang", "text").mapInArrow(run, schema)


def characters(rows: DataFrame) -> DataFrame:
    """How often each character occurs in ``rows(t)``, counted for each partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0x110000, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                cp, _ = code_points(pc.fill_null(part.column(0), ""))
                if len(cp):
                    seen = np.bincount(cp)
                    total[: len(seen)] += seen
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([chr(c) for c in found], pa.string()), pa.array(total[found])], ["ch", "n"])

    return rows.mapInArrow(run, "ch string, n long")


class Alphabet:
    """A character's id is its place from 1; other characters have 0, and 0 stands for
    the first character where ids are read without blanks."""

    def __init__(self, characters: str):
        held = np.array([ord(c) for c in characters], np.int64)
        self.id_of = np.zeros(0x110000, np.int32)
        self.id_of[held[::-1]] = np.arange(len(held), 0, -1)
        self.of_id = np.concatenate([held[:1] if len(held) else [-1], held])
        self.numbers = pa.array([str(i) for i in range(len(held) + 1)])


def by_alphabet(rows: DataFrame, schema: str, give: Callable[[Alphabet, np.ndarray, np.ndarray], list[pa.Array]]) -> DataFrame:
    """``line_id`` and what ``give`` makes of the texts of ``rows(line_id, t, v)``; the
    alphabet ``v`` comes with the first row of a partition."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = None
        for batch in batches:
            if alphabet is None and batch.num_rows:
                alphabet = Alphabet(batch.column(2)[0].as_py() or "")
            for part in slices(batch, 1):
                yield pa.RecordBatch.from_arrays([part.column(0), *give(alphabet, *code_points(part.column(1)))], names)

    return rows.mapInArrow(run, schema)


def encoded(rows: DataFrame) -> DataFrame:
    def give(a: Alphabet, cp: np.ndarray, at: np.ndarray) -> list[pa.Array]:
        ids = pa.ListArray.from_arrays(pa.array(at, pa.int32()), a.numbers.take(pa.array(a.id_of[cp])))
        return [pc.binary_join(ids, ","), pa.array(np.diff(at), pa.int64())]

    return by_alphabet(rows, "line_id string, ids string, label_length long", give)


def decoded(rows: DataFrame) -> DataFrame:
    """Each text, and whether it comes back from its ids."""
    def give(a: Alphabet, cp: np.ndarray, at: np.ndarray) -> list[pa.Array]:
        wrong = starts_at(a.of_id[a.id_of[cp]] != cp)[at]
        return [as_texts(cp, at), pa.array(np.diff(wrong) == 0)]

    return by_alphabet(rows, "line_id string, t string, same boolean", give)


def from_ids(rows: DataFrame) -> DataFrame:
    """Texts decoded from ids between blanks (0), which decoding drops."""
    def give(a: Alphabet, cp: np.ndarray, at: np.ndarray) -> list[pa.Array]:
        ids = np.zeros(2 * len(cp), np.int32)
        ids[::2] = a.id_of[cp]
        some = ids != 0
        return [as_texts(a.of_id[ids[some]].astype(np.uint32), starts_at(some)[2 * at])]

    return by_alphabet(rows, "line_id string, back string", give)


def difficulties(digests: np.ndarray) -> np.ndarray:
    """``loader.difficulty`` of digests, 16 bytes a row: 0 easy, 1 medium, 2 hard."""
    active, hard = np.zeros(len(digests), np.int64), np.zeros(len(digests), bool)
    for i, names in enumerate(loader.STAGES.values()):
        high, middle, low = digests[:, 3 * i : 3 * i + 3].astype(np.int64).T
        drawn = (high << 16 | middle << 8 | low) % len(names)
        active += np.array([n != "" for n in names])[drawn]
        hard |= np.array([n in loader.HARD for n in names])[drawn]
    return np.where(hard & (active >= 3), 2, np.where(active >= 2, 1, 0))


def first_draws(rows: DataFrame) -> DataFrame:
    """For ``rows(line_id, wanted)`` the first of ``loader.TRIES`` digests whose difficulty
    is the wanted one (``hit``, null if none), and that or the last digest ``h``.  Only
    rows without a hit are drawn again; in SQL all digests are made first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [f"{k}|".encode() for k in batch.column(0).to_pylist()]
            wanted = np.array([["easy", "medium", "hard"].index(w) for w in batch.column(1).to_pylist()])
            hits, held = np.full(len(keys), -1), np.zeros((len(keys), 16), np.uint8)
            left = np.arange(len(keys))
            for i in range(loader.TRIES):
                if not len(left):
                    break
                end = b"%d" % i
                drawn = np.frombuffer(b"".join([hashlib.md5(keys[k] + end, usedforsecurity=False).digest() for k in left]), np.uint8).reshape(-1, 16)
                held[left] = drawn
                hit = difficulties(drawn) == wanted[left]
                hits[left[hit]] = i
                left = left[~hit]
            cols = [batch.column(0), batch.column(1), pa.array(hits, pa.int64(), mask=hits < 0), pa.array([h.tobytes().hex() for h in held], pa.string())]
            yield pa.RecordBatch.from_arrays(cols, ["line_id", "wanted", "hit", "h"])

    return rows.mapInArrow(run, "line_id string, wanted string, hit long, h string")


#: Kernels that a plan may name: rows in, rows out.
KERNELS: dict[str, Callable[..., DataFrame]] = {
    "lines": lambda rows, *also: pieces(rows, True, list(also)),
    "plain_lines": lambda rows, *also: pieces(rows, False, list(also)),
    "kept_lines": lambda rows, *also: pieces(rows, True, list(also), kept=True),
    "characters": characters,
    "encoded": encoded,
    "decoded": decoded,
    "from_ids": from_ids,
    "first_draws": first_draws,
}
