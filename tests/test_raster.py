"""Drawn lines, sheets, adaptive profiles and the loader's samples."""

import numpy as np
import pytest

from linefold import catalog
from linefold.operators import degrade as dg
from linefold.operators import raster
from linefold.sources.loader import LineDataset, collate


def test_lines_are_drawn_alike_and_apart():
    (a, name, ok), (b, _, _), (c, _, _) = (raster.render_line(t) for t in ("नेपाल", "नेपाल", "नेपाक"))
    assert (a == b).all() and a.shape == c.shape and (a != c).any() and (name, ok) == ("strict", "ok")
    assert a.shape[0] == 24 + 30 and (a[:15] == 255).all() and (a[:, :15] == 255).all()
    assert raster.render_line("नेपाल", size=48)[0].shape[0] == 48 + 30
    assert raster.render_line("क‌ष")[0].shape == raster.render_line("कष")[0].shape


@pytest.mark.parametrize(
    "text, given, reason",
    [("नेपाल", {}, "ok"), ("", {}, "blank_image"), (None, {}, "blank_image"), ("   ", {}, "blank_image"), ("क", {"font": ord("क") % 12}, "tofu_missing_glyphs"), ("क", {"padding": (0, 0)}, "clipped_text")],
)
def test_reasons(text, given, reason):
    assert raster.render_line(text, **given)[2] == reason


def test_renderers_in_order():
    font = ord("क") % raster.FONTS
    assert raster.render_line("क", font)[1] == "raster" and raster.render_line("क", font, prefer="strict")[1:] == ("failed", "renderer_strict_failed")
    assert raster.render_line("क", prefer="raster")[1] == "raster"


def test_rows_and_query(spark):
    rows = spark.createDataFrame([("a", "नेपाल"), ("b", None), ("c", "ab")], "line_id string, t string")
    got = {r.line_id: r for r in raster.render(rows).collect()}
    assert got["a"].reason == "ok" and len(got["a"].data) == got["a"].height * got["a"].width and got["b"].reason == "blank_image"
    assert raster.render(rows.limit(0)).count() == 0
    found = catalog.QUERIES["rendered_lines"](spark, "/root/testdata/sf0.001").groupBy("reason").count().collect()
    assert {r.reason for r in found} <= {"ok", "tofu_missing_glyphs"} and sum(r["count"] for r in found) > 100


def test_sheet():
    x = np.zeros((10, 40), np.uint8)
    out = raster.sheet([("a", x), ("b", x), ("c", x[:0])], 2, 100, 60, 10, 20)
    assert out.shape == (120, 200) and (out[10:30, 10:90] == 0).sum() == 20 * 80 and (out[60:100] == 255).all()


def test_adaptive_profiles():
    x = raster.render_line("नेपाल राम्रो देश हो।")[0]
    for profile, (contrast, score, kept) in dg.ADAPTIVE.items():
        y, attempts = dg.degrade_one(x, profile, 42, 3)
        got = dg.quality(y)
        assert attempts == dg.ATTEMPTS or (got[0] >= contrast and got[1] >= score and dg.continuity(y, x) >= kept and dg.seen(y))
    white = np.full((30, 50), 255, np.uint8)
    assert dg.continuity(x, white) == 1.0 and dg.continuity(white, x) == 0.0 and not dg.seen(white)


@pytest.mark.parametrize("kernel", [dg.patterns, dg.bleed_through, dg.bleed, dg.skew])
def test_new_kernels(kernel):
    x = raster.render_line("नेपाल")[0]
    y, z = kernel(x, np.random.default_rng(1), 1.0), kernel(x, np.random.default_rng(1), 1.0)
    assert y.shape == x.shape and y.dtype == np.uint8 and (y == z).all() and (y != x).any()
    if kernel is dg.patterns:
        assert (y[x < dg.INK] == x[x < dg.INK]).all()


def test_samples_by_place(spark):
    chars = spark.createDataFrame([(1, "क"), (2, "ख")], "char_id int, ch string")
    rows = [(f"l{i}", "कख"[i % 2], 8, 10 + i, bytes(80 + 8 * i), f"p{i}.png", "en") for i in range(5)]
    data = LineDataset(spark.createDataFrame(rows, "line_id string, t string, height int, width int, data binary, image_path string, domain string").repartition(3), chars)
    assert [data[i]["line_id"] for i in (0, 4, -1, -5)] == ["l0", "l4", "l4", "l0"]
    for wrong in (5, -6):
        with pytest.raises(IndexError):
            data[wrong]
    batch = collate([data[1], data[2]])
    assert batch["image_paths"] == ["p1.png", "p2.png"] and batch["domains"] == ["en", "en"] and batch["degradation_profiles"] == ["", ""]
    assert data[2]["processed_width"] == 96 and data[2]["label_length"] == 1 and data[2]["width"] == 12
