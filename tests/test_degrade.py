"""Kernels keep size and type, profiles are repeatable, odd rows are defined."""

import numpy as np
import pytest

from linefold.operators import degrade as dg


def line(h=32, w=120):
    x = np.full((h, w), 245, np.uint8)
    x[8:11, 6:-6] = 20
    x[11:24, 20:-20:12] = 20
    return x


@pytest.mark.parametrize("profile", list(dg.PROFILES))
def test_profile(profile):
    x = line()
    (a, n), (b, _) = dg.degrade_one(x, profile, 42, 7), dg.degrade_one(x, profile, 42, 7)
    assert a.shape == x.shape and a.dtype == np.uint8 and 1 <= n <= dg.ATTEMPTS and (a == b).all()
    assert (a != x).any() == (profile != "D0_clean_print") and not dg.quality(a)[2]


def test_measures():
    x = line()
    contrast, score, risk = dg.quality(x)
    assert (contrast, risk) == (225.0, False) and score == round(80 + min(20, float(x.std()) / 50 * 20), 2)
    assert not dg.clipped(x) and dg.clipped(x[8:]) and dg.quality(x[:0])[2] and not dg.clipped(x[:0])
    assert (dg.fade(np.array([[0, 255]], np.uint8), None, 1.0) == [[60, 240]]).all()


def test_rows(spark):
    x = line()
    rows = [(1, "D1_light_scan", 32, 120, bytearray(x.tobytes())), (2, None, 32, 120, bytearray(x.tobytes())), (3, "D0_clean_print", 2, 2, None), (4, "nope", 0, 0, bytearray()), (None, "D6_blurred_scan", 3, 1, bytearray(b"abc"))]
    got = {r.row_id: r for r in dg.degrade(spark.createDataFrame(rows, "row_id long, profile string, height int, width int, data binary")).collect()}
    assert got[2].data == x.tobytes() and got[2].attempts == 1
    assert got[3].data is None and got[3].risk and got[4].risk and len(got[None].data) == 3
    assert dg.degrade(spark.createDataFrame([], "row_id long, profile string, height int, width int, data binary")).count() == 0
