"""Lines of text as gray images, by a substitute for fonts.

A character's cell comes from a digest of its code point, so that equal characters look
alike and different ones differ; letters of the script hang from a headline.  Real fonts
and shaping are not available to an engine; what is kept is what the callers see: an order
of renderers, sizes and padding, boxes for missing characters, and reasons of failure.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .degrade import INK, clipped

ROWS, COLS, HEADLINE = 12, 8, 2
#: A fixture font lacks the code points whose value mod ``FONTS`` is its number.
FONTS = 12
#: Characters without a width of their own.
JOINERS = "‌‍"
PAPER, BLACK = 255, 0


def covered(c: str, font: int) -> bool:
    return c == " " or c in JOINERS or ord(c) % FONTS != font


def cell(c: str, font: int) -> np.ndarray:
    """The ink of one character; a box for one that the font lacks."""
    if c in JOINERS:
        return np.zeros((ROWS, 0), bool)
    wide = COLS // 2 if unicodedata.category(c).startswith("M") else COLS
    ink = np.zeros((ROWS, wide), bool)
    if c.isspace():
        return ink
    if not covered(c, font):
        ink[[1, -2], :] = ink[1:-1, [0, -1]] = True
        return ink
    bits = np.unpackbits(np.frombuffer(hashlib.blake2b(c.encode("utf-8", "surrogatepass")).digest(), np.uint8))
    ink[HEADLINE + 1 : ROWS - 1, 1:-1] = bits[: (ROWS - HEADLINE - 2) * (wide - 2)].reshape(-1, wide - 2) == 1
    ink[HEADLINE + 1, 1] = True
    if "ऄ" <= c <= "ह" or "क़" <= c <= "ॡ" or wide < COLS:
        ink[HEADLINE] = True
    return ink


@lru_cache(maxsize=1 << 14)
def scaled_cell(c: str, font: int, scale: int) -> np.ndarray:
    """A cell as it is drawn; texts share few characters, so each is made once a worker."""
    return cell(c, font).repeat(scale, 0).repeat(scale, 1)


def raster(text: str, font: int, scale: int) -> np.ndarray:
    return np.concatenate([np.zeros((ROWS * scale, 0), bool), *[scaled_cell(c, font, scale) for c in text]], axis=1)


def strict(text: str, font: int, scale: int) -> np.ndarray:
    """Refuses what it has no cell for, as shaping engines do."""
    if lacking := [c for c in set(text) if not covered(c, font)]:
        raise ValueError(f"no cells for {lacking!r}")
    return raster(text, font, scale)


#: Tried in this order; a preference names one of them, and then no other is tried.
RENDERERS: dict[str, Callable[[str, int, int], np.ndarray]] = {"strict": strict, "raster": raster}


def render_line(text: str | None, font: int = -1, size: int = 24, padding: tuple[int, int] = (15, 15), prefer: str = "auto") -> tuple[np.ndarray, str, str]:
    """The image, the renderer that gave it, and "ok" or why it must not be used: the
    renderer failed, characters are missing, nothing is seen, too small, or cut off."""
    names = [prefer] if prefer in RENDERERS else list(RENDERERS)
    across, down = padding
    for name in names:
        try:
            ink = RENDERERS[name](text or "", font, max(1, size // ROWS))
        except ValueError:
            continue
        image = np.full((ink.shape[0] + 2 * down, ink.shape[1] + 2 * across), PAPER, np.uint8)
        image[down : down + ink.shape[0], across : across + ink.shape[1]] -= ink.view(np.uint8) * np.uint8(PAPER - BLACK)
        return image, name, _reason(text or "", font, image)
    return np.full((40, 100), PAPER, np.uint8), "failed", f"renderer_{prefer}_failed"


def _reason(text: str, font: int, image: np.ndarray) -> str:
    if any(not covered(c, font) for c in set(text)):
        return "tofu_missing_glyphs"
    ink = image < INK
    rows, cols = np.flatnonzero(ink.any(axis=1)), np.flatnonzero(ink.any(axis=0))
    if not rows.size:
        return "blank_image"
    if rows.max() - rows.min() < 5 or cols.max() - cols.min() < 3:
        return "unreadably_small_output"
    return "clipped_text" if clipped(image) else "ok"


def render(lines: DataFrame, font: int = -1, size: int = 24, padding: tuple[int, int] = (15, 15), prefer: str = "auto", digest: bool = False) -> DataFrame:
    """``lines(line_id, t)`` as ``line_id, renderer, reason, height, width, data``; a null
    text is an empty one.  One batch of images is held at a time.  With ``digest`` the
    last column is ``pixels``, the SHA-256 of the data, and no image leaves the worker."""
    schema = f"line_id string, renderer string, reason string, height int, width int, {'pixels string' if digest else 'data binary'}"
    last = (lambda g: hashlib.sha256(g).hexdigest()) if digest else (lambda g: g.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                got = [render_line(t, font, size, padding, prefer) for t in part.column(1).to_pylist()]
                cols = [[g[1] for g in got], [g[2] for g in got], [g[0].shape[0] for g in got], [g[0].shape[1] for g in got], [last(g[0]) for g in got]]
                types = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string() if digest else pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, t) for c, t in zip(cols, types)]], [f.split()[0] for f in schema.split(", ")])

    return lines.select("line_id", "t").mapInArrow(run, schema)


def sheet(cells: list[tuple[str, np.ndarray]], columns: int, cell_w: int, cell_h: int, margin: int = 10, label: int = 0) -> np.ndarray:
    """A contact sheet: each image shrunk or grown by nearest pixels to what fits its
    cell, centred, with its label drawn below.  ``cells`` is a report's few images."""
    rows = -(-len(cells) // columns)
    out = np.full((rows * cell_h, columns * cell_w), PAPER, np.uint8)
    free_w, free_h = cell_w - 2 * margin, cell_h - label - 2 * margin
    for i, (name, x) in enumerate(cells):
        top, left = i // columns * cell_h, i % columns * cell_w
        h, w = x.shape
        if h and w:
            by = min(free_w / w, free_h / h)
            new_h, new_w = max(1, int(h * by)), max(1, int(w * by))
            small = x[(np.arange(new_h) * h // new_h)[:, None], np.arange(new_w) * w // new_w]
            y, z = top + margin + (free_h - new_h) // 2, left + (cell_w - new_w) // 2
            out[y : y + new_h, z : z + new_w] = small
        if label >= ROWS:
            ink = raster(name, -1, 1)[:, : cell_w - 2 * margin]
            at = top + cell_h - label
            out[at : at + ROWS, left + margin : left + margin + ink.shape[1]][ink] = BLACK
    return out
