"""Template generation against plain loops, the loader, composed draws, commands."""

import itertools
import re

import numpy as np
import pytest

from linefold import __main__ as command
from linefold import catalog
from linefold.functions.dialect import Spark
from linefold.operators import degrade
from linefold.plans import coverage, loader
from linefold.sources import files
from linefold.sources.loader import LineDataset, collate, resized

SF = "/root/testdata/sf0.001"


def fillings(template, slots):
    parts = re.split(r"\{(\w+)\}", template)
    for chosen in itertools.product(*(slots[n] for n in parts[1::2])):
        yield "".join(itertools.chain(*itertools.zip_longest(parts[::2], chosen, fillvalue="")))


def test_space_is_every_filling(spark):
    rows = spark.sql(coverage.space(Spark)).collect()
    assert len(rows) == coverage.space_size()
    assert sorted((r.tidx, r.raw) for r in rows) == sorted((i, raw) for i, b in enumerate(coverage.BANK) for raw in fillings(*b))
    of = {r.raw: r.t for r in rows}
    assert of["वि. सं २०७२ देखि १९९० सम्म सीता पोखरामा बसे।"] == "वि. सं १९९० देखि २०७२ सम्म सीता पोखरामा बसे।"
    assert of["वि. सं १९९० देखि २०७२ सम्म सीता पोखरामा बसे।"] == "वि. सं १९९० देखि २०७२ सम्म सीता पोखरामा बसे।"
    assert of["पोखराबाट सीता र रमेश आए॥"] == "पोखराबाट सीता र रमेश आए॥"


@pytest.mark.parametrize(
    "text, want",
    [("वि. सं २०७२ देखि १९९० सम्म", "वि. सं १९९० देखि २०७२ सम्म"), ("क वि. सं ९ देखि ८ सम्म, वि. सं ९ देखि ८ सम्म ख", "क वि. सं ८ देखि ९ सम्म, वि. सं ९ देखि ८ सम्म ख"),
     ("वि. सं १ देखि २ सम्म", "वि. सं १ देखि २ सम्म"), ("वि. सं ९ देखि १० सम्म", "वि. सं १० देखि ९ सम्म"), ("none", "none"), ("", "")],
)
def test_range_swap(spark, text, want):
    rows = spark.createDataFrame([(text,)], "t string")
    assert rows.selectExpr(f"{coverage.swapped(Spark)} as t").collect()[0].t == want


def test_quotes_and_braces_in_a_template(spark):
    bank = [("it's {x} {y}", {"x": ["a'b", "{x}"]})]
    assert sorted(r.raw for r in spark.sql(coverage.space(Spark, bank)).collect()) == ["it's a'b {y}", "it's {x} {y}"]


def test_generated_lines_keep_the_caps(spark):
    rows = catalog.QUERIES["coverage_generate"](spark, SF).collect()
    assert len({r.t for r in rows}) == len(rows) <= coverage.WANTED
    per = [sum(r.tidx == i for r in rows) for i in range(len(coverage.BANK))]
    assert max(per) <= coverage.CAP
    known = {r.t for r in catalog.QUERIES["dedup_global"](spark, SF).collect()}
    assert not known & {r.t for r in rows}
    assert catalog.QUERIES["coverage_qa"](spark, SF).collect()[0].verdict == "PASS"


def test_composed_draws(spark):
    names = set(loader.STAGES)
    for r in catalog.QUERIES["composed_difficulty"](spark, SF).collect():
        assert r.difficulty == degrade.difficulty({s: r[s] for s in names})
        assert r.difficulty == r.wanted or r.attempt == loader.TRIES - 1


@pytest.mark.parametrize("target", ["easy", "medium", "hard", None])
def test_composed_pixels(target):
    x = np.random.default_rng(1).integers(0, 256, (24, 90)).astype(np.uint8)
    for row in range(30):
        (y, found), (again, _) = degrade.degrade_composed(x, 7, row, target), degrade.degrade_composed(x, 7, row, target)
        assert y.shape == x.shape and y.dtype == np.uint8 and (y == again).all()
        picks, attempt = degrade.compose(7, row, target)
        assert target is None or found["difficulty"] == target or attempt == degrade.COMPOSED_TRIES - 1


def test_loader(spark):
    chars = spark.createDataFrame([(1, " "), (2, "क"), (3, "ख")], "char_id int, ch string")
    rows = [("a", "कख", 8, 10, bytes(80)), ("b", "क ख", 64, 3, b"\xff" * 192), ("c", "", 16, 4, b"\x80" * 64)]
    data = LineDataset(spark.createDataFrame(rows, "line_id string, t string, height int, width int, data binary").orderBy("line_id"), chars)
    assert len(data) == 3 and data.decode([0, 2, 0, 3]) == "कख"
    first, last = data.batches(2)
    assert first["images"].shape == (2, 1, 64, 80) and first["labels"].tolist() == [2, 3, 2, 1, 3] and first["label_lengths"].tolist() == [2, 3]
    assert first["images"][1, 0, :, 3:].min() == 1 and first["images"][0].max() == 0 and last["images"].shape == (1, 1, 64, 16)
    for wrong in (lambda: data.encode("x"), lambda: data.decode([9]), lambda: collate([])):
        with pytest.raises(ValueError):
            wrong()
    data.max_width = 50
    with pytest.raises(ValueError):
        next(iter(data))
    assert resized(np.full((5, 7), 9, np.uint8), 64).shape == (64, 90)


def test_charset_file(spark, tmp_path):
    chars = spark.createDataFrame([(2, "क"), (1, '"'), (3, "\\")], "char_id int, ch string")
    files.write_charset(chars, str(tmp_path / "c"))
    assert sorted(map(tuple, files.charset_rows(spark, str(tmp_path / "c")).collect())) == sorted(map(tuple, chars.collect()))


def test_append_by_name(spark, tmp_path):
    at = str(tmp_path / "a")
    files.write_csv(spark.createDataFrame([("1", "x")], "a string, b string"), at, ["a", "b"], ["a"])
    files.append_csv(spark.createDataFrame([("y", "2")], "b string, a string"), at)
    assert sorted(map(tuple, files.csv_rows(spark, at, "a string, b string").collect())) == [("1", "x"), ("2", "y")]


def test_ranks_over_ranges(spark):
    spark.range(3000).selectExpr("cast(id as string) as line_id", "case when id % 3 = 0 then null else id % 2 end as g").createOrReplaceTempView("ids")
    got = spark.sql(Spark.hash_rank("select * from ids", "g", "5"))
    want = spark.sql("select line_id, g, row_number() over (partition by g order by md5(concat('5|', line_id)), line_id) as k, count(*) over (partition by g) as n from ids")
    assert sorted(map(repr, got.select("line_id", "g", "n", "k").collect())) == sorted(map(repr, want.select("line_id", "g", "n", "k").collect()))


def test_command(spark, tmp_path):
    out, report = str(tmp_path / "out"), tmp_path / "r.md"
    assert command.main(["coverage_qa", "--input", SF, "--output", out, "--format", "csv", "--report", str(report), "--gate"], spark) == 0
    assert "PASS" in report.read_text() and spark.read.csv(out, header=True).count() == 1
    with pytest.raises(ValueError):
        command.main(["len_stats", "--input", SF, "--gate"], spark)
