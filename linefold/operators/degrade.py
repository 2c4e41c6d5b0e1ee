"""Degradation of gray line images: numpy kernels, profiles, retries.

Images are rows (row_id long, height int, width int, data binary of height * width
gray bytes).  A kernel takes (image, generator, strength) and returns an image of the
same size.  Random numbers come from the seed, the row id and the attempt, so a task
that runs again gives the same pixels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

Image = np.ndarray
INK, RISKY_CONTRAST, RISKY_DEVIATION = 160, 35, 10
ATTEMPTS = 5


def clip(x) -> Image:
    return np.clip(x, 0, 255).astype(np.uint8)


def around(x: Image, rows: int, cols: int) -> np.ndarray:
    """Each pixel's window as a stack of shifted copies, edges repeated."""
    up, left = rows // 2, cols // 2
    wide = np.pad(x, ((up, rows - 1 - up), (left, cols - 1 - left)), mode="edge")
    h, w = x.shape
    return np.stack([wide[i : i + h, j : j + w] for i in range(rows) for j in range(cols)])


def illumination(x, rng, s):
    h, w = x.shape
    slope = np.linspace(-1, 1, w) * rng.uniform(-1, 1) + (np.linspace(-1, 1, h) * rng.uniform(-1, 1))[:, None]
    return clip(x + 30 * s * slope)


def texture(x, rng, s):
    return clip(x + rng.normal(0, 12 * s, x.shape))


def stain(x, rng, s):
    h, w = x.shape
    yy, xx = np.mgrid[:h, :w]
    far = ((yy - rng.uniform(0, h)) / max(h / 2, 1)) ** 2 + ((xx - rng.uniform(0, w)) / max(w / 8, 1)) ** 2
    return clip(x - 60 * s * np.exp(-far))


def dark_edges(x, rng, s):
    h, w = x.shape
    near = np.minimum(np.minimum(np.arange(h), np.arange(h)[::-1])[:, None], np.minimum(np.arange(w), np.arange(w)[::-1]))
    return clip(x - 50 * s * np.exp(-near / 4))


def show_through(x, rng, s):
    """The mirrored line, faint, on background pixels only."""
    return np.where(x >= INK, clip(x - (255 - x[:, ::-1].astype(float)) * 0.25 * s), x)


def patterns(x, rng, s):
    """Faint slanted lines of a page below, on background pixels only."""
    h, w = x.shape
    yy, xx = np.mgrid[:h, :w]
    lines = (xx + int(rng.integers(1, 4)) * yy + int(rng.integers(0, 9))) % 9 < 2
    return np.where((x >= INK) & lines, clip(x - 25.0 * s), x)


def bleed_through(x, rng, s):
    """The mirrored line, blurred and shifted, through the whole sheet."""
    back = around(np.roll(x[:, ::-1], int(rng.integers(-3, 4)), axis=1), 3, 3).mean(0)
    return clip(x - (255 - back) * 0.2 * s)


def fade(x, rng, s, floor: float = 60, ceiling: float = 240):
    return (floor * s + x / 255 * (ceiling - floor * s)).astype(np.uint8)


def thin(x, rng, s):
    return clip((1 - s) * x + s * around(x, 2, 2).max(0))


def thicken(x, rng, s):
    return clip((1 - s) * x + s * around(x, 2, 2).min(0))


def bleed(x, rng, s):
    """Ink spread into the paper around it: darker near ink, and soft."""
    spread = around(x, 3, 3).min(0)
    return clip((1 - 0.6 * s) * x + 0.6 * s * around(spread, 3, 3).mean(0))


def opacity(x, rng, s):
    share = np.interp(np.arange(x.shape[1]), np.linspace(0, x.shape[1], 6), rng.uniform(1 - 0.5 * s, 1, 6))
    return clip(255 - (255.0 - x) * share)


def broken(x, rng, s):
    return np.where((x < INK) & (around(rng.random(x.shape), 2, 2).min(0) < 0.02 * s), 235, x).astype(np.uint8)


def headline_gaps(x, rng, s):
    """Gaps in the row with the most ink, the headline."""
    out, row = x.copy(), int((x < INK).sum(1).argmax()) if x.size else 0
    gaps = np.repeat(rng.random(x.shape[1] // 6 + 1) < 0.3 * s, 6)[: x.shape[1]]
    out[max(0, row - 1) : row + 2, gaps] = 235
    return out


def low_resolution(x, rng, s):
    step = 1 + int(round(s))
    return x[::step, ::step].repeat(step, 0).repeat(step, 1)[: x.shape[0], : x.shape[1]]


def blur(x, rng, s):
    return clip((1 - s) * x + s * around(x, 3, 3).mean(0))


def motion(x, rng, s):
    return clip((1 - s) * x + s * around(x, 1, 5).mean(0))


def streaks(x, rng, s):
    return clip(x + np.where(rng.random(x.shape[0]) < 0.05 * s, 35, 0)[:, None])


def specks(x, rng, s):
    u = rng.random(x.shape)
    return np.where(u < 0.006 * s, 0, np.where(u > 1 - 0.006 * s, 255, x)).astype(np.uint8)


def wormholes(x, rng, s):
    """Round holes, each only where it takes at most 4 % of the ink."""
    out, (h, w) = x.copy(), x.shape
    yy, xx = np.mgrid[:h, :w]
    ink = max(1, int((x < INK).sum()))
    for _ in range(int(1 + 4 * s)):
        hole = (yy - rng.uniform(0, h)) ** 2 + (xx - rng.uniform(0, w)) ** 2 <= rng.uniform(1, 3) ** 2
        if ((out < INK) & hole).sum() <= 0.04 * ink:
            out[hole] = 245
    return out


def crease(x, rng, s):
    far = np.abs(np.arange(x.shape[1]) - rng.uniform(0, x.shape[1]))
    return clip(x - 45 * s * np.exp(-far / 2))


def moved(x, dy, dx):
    """Pixels taken from (row + dy, column + dx), white beyond the border."""
    h, w = x.shape
    yy, xx = np.mgrid[:h, :w]
    r, c = np.rint(yy + dy).astype(int), np.rint(xx + dx).astype(int)
    inside = (r >= 0) & (r < h) & (c >= 0) & (c < w)
    return np.where(inside, x[r.clip(0, h - 1), c.clip(0, w - 1)], 255).astype(np.uint8)


def skew(x, rng, s):
    """A small rotation about the centre, with shear and translation."""
    h, w = x.shape
    yy, xx = np.mgrid[:h, :w]
    y, z = yy - h / 2, xx - w / 2
    turn, shear = np.deg2rad(rng.uniform(-0.6, 0.6) * s), rng.uniform(-0.04, 0.04) * s
    down, right = rng.uniform(-1, 1, 2) * s
    return moved(x, y * (np.cos(turn) - 1) + z * np.sin(turn) + down, z * (np.cos(turn) - 1) - y * np.sin(turn) + shear * y + right)


def warp(x, rng, s):
    return moved(x, 1.5 * s * np.sin(np.arange(x.shape[1]) / 40 + rng.uniform(0, 6))[None, :], 0.0)


Kernel = Callable[[Image, np.random.Generator, float], Image]
PROFILES: dict[str, list[tuple[Kernel, float]]] = {
    "D0_clean_print": [], "D1_light_scan": [(texture, 0.4), (skew, 0.5)], "D2_low_contrast_faded_ink": [(fade, 1.0)], "D3_uneven_background": [(illumination, 1.0)],
    "D4_broken_strokes": [(broken, 1.0)], "D5_noisy_archive_scan": [(specks, 1.0), (texture, 0.8)], "D6_blurred_scan": [(blur, 1.0)], "D7_old_paper_texture": [(texture, 1.0), (dark_edges, 0.6)],
    "D8_old_scan_soft": [(blur, 0.5), (texture, 0.3)], "D9_faded_gray_ink": [(fade, 1.2), (opacity, 0.5)], "D10_noisy_scan_crop": [(specks, 0.8), (dark_edges, 1.0)], "D11_mild_warped_line": [(warp, 1.0)],
    "D12_dark_thick_scan": [(thicken, 0.8)], "D13_washed_out_faint_manuscript": [(fade, 1.8), (opacity, 0.8), (blur, 0.4)], "D14_low_dpi_compressed_scan": [(low_resolution, 1.0), (blur, 0.4)],
    "D15_bleedthrough_archival": [(bleed_through, 1.5), (texture, 0.6)], "D16_ink_bleed_spread": [(bleed, 1.0), (blur, 0.4)], "D17_local_stain_shadow": [(stain, 1.0), (illumination, 0.8)],
    "D18_fold_crease_damage": [(crease, 1.5), (wormholes, 0.8)], "D19_weak_shirorekha_dropout": [(headline_gaps, 1.0), (fade, 0.8)], "D20_partial_erosion_thin_strokes": [(thin, 0.7), (broken, 0.6)],
    "D21_mixed_manuscript_hard": [(stain, 0.7), (opacity, 0.6), (texture, 0.8), (skew, 1.0)], "D22_reverse_showthrough_soft": [(show_through, 0.8), (patterns, 0.5), (blur, 0.4)], "D23_fragmented_scan_crop": [(wormholes, 1.0), (motion, 0.4), (streaks, 1.0)],
}


# Profiles that are tried again with milder strength, and the least contrast,
# score and continuity that a try must reach.
ADAPTIVE = {"D13_washed_out_faint_manuscript": (35, 0, 0.0), "D14_low_dpi_compressed_scan": (35, 0, 0.0), "D19_weak_shirorekha_dropout": (35, 75, 0.70), "D20_partial_erosion_thin_strokes": (35, 75, 0.65)}

#: Stages of a composed degradation; None leaves the image as it is.
COMPOSED: dict[str, dict[str, tuple[Kernel, float] | None]] = {
    "substrate": {"illumination": (illumination, 0.8), "texture": (texture, 0.6), "stains": (stain, 0.5), "bleedthrough": (bleed_through, 0.5), "showthrough": (show_through, 0.3), "none": None},
    "ink": {"fade": (fade, 1.0), "thin": (thin, 0.4), "thick": (thicken, 0.5), "broken": (broken, 1.0), "shirorekha": (headline_gaps, 0.5), "bleed": (bleed, 0.5), "none": None},
    "scan": {"downsample": (low_resolution, 1.0), "blur": (blur, 0.5), "streaks": (streaks, 0.4), "none": None},
    "damage": {"pepper": (specks, 0.2), "wormholes": (wormholes, 0.3), "crease": (crease, 0.4), "none": None},
    "geometry": {"affine": (skew, 0.8), "warp": (warp, 0.5), "none": None},
}
#: Stages that are skipped half of the time, and effects that make an image hard.
OPTIONAL = ("damage", "geometry")
HARD = {"bleedthrough", "showthrough", "shirorekha", "broken", "wormholes", "crease", "warp"}
COMPOSED_TRIES = 50


def difficulty(picks: dict[str, str]) -> str:
    active = [p for p in picks.values() if p != "none"]
    return "hard" if len(active) >= 3 and HARD & set(active) else "medium" if len(active) >= 2 else "easy"


def compose(seed: int, row_id: int, target: str | None = None) -> tuple[dict[str, str], int]:
    """One effect for each stage and the draw's number: the first draw of the target's
    difficulty, else the last of ``COMPOSED_TRIES``.  No pixel is touched to find it."""
    picks: dict[str, str] = {}
    for attempt in range(COMPOSED_TRIES):
        rng = np.random.default_rng([seed, row_id & 0xFFFFFFFFFFFFFFFF, attempt, 1])
        for stage, effects in COMPOSED.items():
            names = [n for n in effects if stage not in OPTIONAL or n != "none"]
            picks[stage] = "none" if stage in OPTIONAL and rng.random() < 0.5 else str(rng.choice(names))
        if target is None or difficulty(picks) == target:
            break
    return picks, attempt


def degrade_composed(x: Image, seed: int, row_id: int, target: str | None = None) -> tuple[Image, dict[str, str]]:
    """The image after its drawn effects, and their names with the difficulty."""
    picks, attempt = compose(seed, row_id, target)
    rng = np.random.default_rng([seed, row_id & 0xFFFFFFFFFFFFFFFF, attempt, 2])
    for stage, name in picks.items():
        step = COMPOSED[stage][name]
        x = step[0](x, rng, step[1]) if step and x.size else x
    return x, {**picks, "difficulty": difficulty(picks)}


def quality(x: Image) -> tuple[float, float, bool]:
    """Contrast, readability score and risk of an image (no ink counts as mean 0, no
    background as 255; an image without pixels is a risk)."""
    if not x.size:
        return 0.0, 0.0, True
    ink, paper = x[x < INK], x[x >= INK]
    contrast = float((paper.mean() if paper.size else 255) - (ink.mean() if ink.size else 0))
    deviation = float(x.std())
    score = min(80, contrast / 150 * 80) + min(20, deviation / 50 * 20)
    return contrast, round(float(min(100, max(0, score))), 2), contrast < RISKY_CONTRAST or deviation < RISKY_DEVIATION or x.shape[0] < 20


def continuity(x: Image, clean: Image) -> float:
    """Ink of an image as a share of the clean one's; 1 where that has none."""
    had = int((clean < INK).sum())
    return int((x < INK).sum()) / had if had else 1.0


def seen(x: Image) -> bool:
    """Whether anything differs from white paper."""
    return bool((x < 255).any())


def clipped(x: Image, median: bool = True) -> bool:
    """Whether ink, after a 3 by 3 median if asked, touches the outermost pixels."""
    if not any((edge < INK).any() for edge in (x[:3], x[-3:], x[:, :3], x[:, -3:])):
        return False
    rows, cols = np.nonzero((np.median(around(x, 3, 3), axis=0) if median else x) < INK)
    h, w = x.shape
    return bool(rows.size) and bool(rows.min() <= 1 or cols.min() <= 1 or rows.max() >= h - 2 or cols.max() >= w - 2)


def degrade_one(x: Image, profile: str | None, seed: int, row_id: int) -> tuple[Image, int]:
    """The degraded image and the attempts taken.  Adaptive profiles are tried again at a
    strength lower by a fifth each time until contrast, score and continuity suffice;
    others blend in 20 % more of the clean image at each retry (80 % at most) until the
    image is no risk.  An image on which nothing is seen is tried again too.  Unknown
    profiles leave the image as it is."""
    out, asked = x, ADAPTIVE.get(profile or "")
    for attempt in range(ATTEMPTS):
        rng = np.random.default_rng([seed, row_id & 0xFFFFFFFFFFFFFFFF, attempt])
        out = x
        for kernel, strength in PROFILES.get(profile or "", []) if x.size else []:
            out = kernel(out, rng, strength * (1 - 0.2 * attempt) if asked else strength)
        if attempt and not asked:
            keep = min(0.8, 0.2 * attempt)
            out = clip(keep * x + (1 - keep) * out.astype(float))
        contrast, score, risk = quality(out)
        enough = contrast >= asked[0] and score >= asked[1] and continuity(out, x) >= asked[2] if asked else not risk
        if enough and seen(out):
            return out, attempt + 1
    return out, ATTEMPTS


SCHEMA = "row_id long, profile string, height int, width int, data binary, attempts int, contrast double, score double, risk boolean, clipped boolean"


def degrade(images: DataFrame, seed: int = 42, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every image (row_id, profile, height, width, data) with its degraded pixels and
    their measures.  Rows whose data are null or not height * width bytes come back
    with null data and as a risk; a batch is held at a time.  ``keep`` names further
    columns, texts, that come along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                h, w, data = r["height"] or 0, r["width"] or 0, r["data"]
                if data is None or len(data) != h * w:
                    out.append({**r, "data": None, "attempts": 0, "contrast": None, "score": None, "risk": True, "clipped": None})
                    continue
                y, n = degrade_one(np.frombuffer(data, np.uint8).reshape(h, w), r["profile"], seed, r["row_id"] or 0)
                contrast, score, risk = quality(y)
                out.append({**r, "data": y.tobytes(), "attempts": n, "contrast": contrast, "score": score, "risk": risk, "clipped": clipped(y)})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = pa.schema([("row_id", pa.int64()), ("profile", pa.string()), ("height", pa.int32()), ("width", pa.int32()), ("data", pa.binary()), ("attempts", pa.int32()), ("contrast", pa.float64()), ("score", pa.float64()), ("risk", pa.bool_()), ("clipped", pa.bool_()), *((k, pa.string()) for k in keep)])
    more = "".join(f", `{k}` string" for k in keep)
    return images.select("row_id", "profile", "height", "width", "data", *keep).mapInArrow(run, SCHEMA + more)
