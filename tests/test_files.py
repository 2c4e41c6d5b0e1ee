"""Sources and sinks on small files, and the stream over a growing folder."""

import struct
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.errors import AnalysisException

from linefold.sources import files
from linefold.streaming import dedup


def png(width: int, height: int) -> bytes:
    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IEND", b"")


@pytest.mark.parametrize("text", ["a b\nc\r\nd\x0be\x85f\u2028h\u2029 g", "one\n", "\n\nx", "", "é ऩ"])
def test_text_lines(spark, tmp_path, text):
    (tmp_path / "a.txt").write_bytes(text.encode())
    rows = files.text_lines(spark, str(tmp_path)).orderBy("line_no").collect()
    assert [r.line for r in rows] == unicodedata.normalize("NFC", text).splitlines()


def test_csv_with_mark_quotes_and_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿line_id,t\nx,"a ""b"", c\nd"\ny,\n'.encode())
    assert [tuple(r) for r in files.csv_rows(spark, str(tmp_path), "line_id string, t string").collect()] == [("x", 'a "b", c\nd'), ("y", None)]


def test_tagged_needs_every_part(spark, tmp_path):
    with pytest.raises(AnalysisException):
        files.tagged(spark, {str(tmp_path / "none"): "en"}, "t string").collect()


def test_optional_part(spark, tmp_path):
    (tmp_path / "small.csv").write_text("t\n")
    (tmp_path / "full.csv").write_text("t\n" + "word\n" * 20)
    count = lambda name: files.optional_part(spark, str(tmp_path / name), "t string", 2, "r").count()
    assert (count("absent.csv"), count("small.csv"), count("full.csv")) == (0, 0, 20)


def test_image_headers_and_missing(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(png(321, 64))
    (tmp_path / "b.png").write_bytes(b"no image")
    listed = files.image_headers(spark, str(tmp_path)).orderBy("path")
    assert [(r.width, r.height) for r in listed.collect()] == [(321, 64), (None, None)]
    rows = spark.createDataFrame([("x\\a.png",), ("y/c.png",)], "image_path string")
    assert [r[0] for r in files.missing_paths(rows, listed).collect()] == ["y/c.png"]


def test_manifest_keeps_unknown_splits_in_all_only(spark, tmp_path):
    files.write_manifest(spark.createDataFrame([("a", "Train"), ("b", "odd")], "line_id string, split string"), str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m/all")).count() == 2
    assert [r.line_id for r in spark.read.parquet(str(tmp_path / "m/by_split")).collect()] == ["a"]


def test_markdown_escapes_bars(spark):
    assert "a\\|b" in files.markdown(spark.createDataFrame([("a|b",)], "t string"), "T")


def test_stream_goes_on(spark, tmp_path):
    where = [str(tmp_path / n) for n in ("in", "out", "state")]
    for texts in (["a", "b", "a"], ["b", "c"]):
        spark.createDataFrame([(t,) for t in texts], "t string").write.mode("append").parquet(where[0])
        dedup.drain(dedup.first_texts(spark, where[0], "t string"), where[1], where[2])
    assert sorted(r.t for r in spark.read.parquet(where[1]).collect()) == ["a", "b", "c"]


def test_png_files(spark, tmp_path):
    images = {"a": np.arange(48, dtype=np.uint8).reshape(6, 8), "b": np.full((1, 3), 255, np.uint8)}
    rows = [(k, *x.shape, bytearray(x.tobytes())) for k, x in images.items()] + [("odd", 2, 2, bytearray(b"x")), ("none", 1, 1, None), (None, 1, 1, bytearray(b"x"))]
    done = files.write_png(spark.createDataFrame(rows, "name string, height int, width int, data binary"), str(tmp_path / "p")).collect()
    assert {r.name for r in done} == {"a", "b"} == {p.stem for p in (tmp_path / "p").iterdir()}
    (tmp_path / "p/bad.png").write_bytes(b"no image")
    got = {r.name: r for r in files.png_pixels(spark, str(tmp_path / "p")).collect()}
    assert all(got[k].data == x.tobytes() and (got[k].height, got[k].width) == x.shape for k, x in images.items()) and got["bad"].data is None
    assert [(r.width, r.height) for r in files.image_headers(spark, str(tmp_path / "p/a.png")).collect()] == [(8, 6)]


def test_png_filters_and_colours():
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    made = lambda rows, w, colour: files.PNG_MARK + chunk(b"IHDR", struct.pack(">IIBBBBB", w, len(rows), 8, colour, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(map(bytes, rows)))) + chunk(b"IEND", b"")
    rows = [[0, 10, 20, 30], [1, 1, 2, 3], [2, 5, 5, 255], [3, 10, 10, 10], [4, 1, 1, 1]]
    # sub: sums; up: above added, modulo 256; average: (left + above) // 2; the last: the nearest of left, above, left above
    assert files.png_decoded(made(rows, 3, 0)).tolist() == [[10, 20, 30], [1, 3, 6], [6, 8, 5], [13, 20, 22], [14, 21, 23]]
    assert files.png_decoded(made([[0, 255, 0, 0, 0, 255, 0, 0, 0, 255, 9, 9, 9]], 4, 2)).tolist() == [[76, 150, 29, 9]]
    assert files.png_decoded(made([[0, 7, 255, 8, 0]], 2, 4)).tolist() == [[7, 8]] and files.png_decoded(made([[0, 1]], 1, 3)) is None and files.png_decoded(b"") is None


def test_names_config_and_report(spark, tmp_path):
    for name, text in (("x (1).csv", "one"), ("x (2).csv", "two"), ("y.csv", "y"), ("z (3)", "z")):
        (tmp_path / name).write_text(text)
    assert files.standard_names(spark, str(tmp_path)) == ["x.csv", "z"] and (tmp_path / "x.csv").read_text() == "two" and (tmp_path / "z").read_text() == "z"
    pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text("a: 1\nweights:\n  D0: 0.5\nfonts: [x, y]\n")
    assert files.yaml_config(spark, str(tmp_path / "c.yaml")) == {"a": 1, "weights": {"D0": 0.5}, "fonts": ["x", "y"]}
    table = spark.createDataFrame([("a|b", 1)], "k string, n int")
    assert files.report("T", [("One", table), ("Two", "text")]) == "# T\n\n## One\n\n| k | n |\n| --- | --- |\n| a\\|b | 1 |\n\n## Two\n\ntext\n"


def test_character_names(spark):
    got = files.char_names(spark.createDataFrame([(c,) for c in "क।॥-$१\n"], "ch string")).collect()
    assert [(r.name, r.category, r.punctuation) for r in got] == [(unicodedata.name(r.ch, ""), unicodedata.category(r.ch), r.ch in "।॥-$") for r in got]
