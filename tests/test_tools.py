"""Commands over small files: what they write, and their exit codes."""

import pytest

from linefold import __main__ as command
from linefold import tools

TEXTS = ["नेपाल राम्रो देश हो।", "काठमाडौं ५ पोखरा", "०१२३४५६७८९ ॥ क्ष", "सीता र रमेश आए।"]
COLUMNS = "line_id string, text string, split string, domain string, line_length int, has_danda boolean, has_double_danda boolean, has_digit boolean, has_conjunct boolean"


@pytest.fixture
def labels(spark, tmp_path):
    rows = [(f"a_{i}", t, ("train", "val")[i % 2], "d", len(t), "।" in t, "॥" in t, any(c.isdigit() for c in t), "्" in t) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(tmp_path / "labels"))
    spark.createDataFrame(rows, COLUMNS).write.csv(str(tmp_path / "labels.csv"), header=True)
    return tmp_path


def ran(spark, *given):
    return command.main([str(g) for g in given], spark)


def test_from_labels_to_a_manifest(spark, labels):
    images = ("images", "--labels", labels / "labels", "--output", labels / "out", "--metadata-out", labels / "meta", "--report", labels / "i.md", "--allow-unreadable-risk")
    assert ran(spark, *images) == 0
    meta = spark.read.parquet(str(labels / "meta"))
    assert meta.count() == 4 and {p.name for p in (labels / "out/images").iterdir()} == {r.image_path.split("/")[-1] for r in meta.collect()}
    assert ran(spark, "quality", "--images", labels / "out/images", "--output", labels / "q", "--report", labels / "q.md", "--allow-unreadable-risk") == 0
    assert spark.read.parquet(str(labels / "q")).count() == 4 and "| n | risks |" in (labels / "q.md").read_text()
    assert ran(spark, "manifest", "--metadata", labels / "meta", "--images", labels / "out/images", "--output", labels / "m", "--report", labels / "m.md") == 0
    assert spark.read.parquet(str(labels / "m/by_split")).count() == 4
    (next((labels / "out/images").iterdir())).write_bytes(b"no image")
    assert ran(spark, "quality", "--images", labels / "out/images", "--report", labels / "q.md") == 1
    again = [*images, "--overwrite", "--split", "train", "--limit", "1", "--seed", "7"]
    assert ran(spark, *again) == 0 and spark.read.parquet(str(labels / "meta")).count() == 1
    with pytest.raises(Exception):
        ran(spark, *images)


def test_images_of_some_lines(spark, labels):
    (labels / "c.yaml").write_text("font_size: 36\nprofile_weights:\n  D1_light_scan: 1\n")
    images = ("images", "--labels", labels / "labels.csv", "--output", labels / "o", "--metadata-out", labels / "meta", "--report", labels / "i.md", "--only-has-digit", "--smoke-test", "--config", labels / "c.yaml")
    assert ran(spark, *images) == 0
    rows = spark.read.parquet(str(labels / "meta")).collect()
    assert {r.line_id for r in rows} == {"a_1", "a_2"} and {(r.profile, r.height) for r in rows} == {("D1_light_scan", 36 + 30)}
    with pytest.raises(ValueError):
        tools.profile_of({"profile_weights": {"none": 1}}, 1)


def test_charset(spark, labels):
    given = ("charset", "--labels", labels / "labels", "--output", labels / "chars", "--report", labels / "c.md")
    assert ran(spark, *given) == 0 and "DEVANAGARI LETTER KA" in (labels / "c.md").read_text() and (labels / "chars").exists()
    spark.createDataFrame([("x", "क 5")], "line_id string, text string").write.parquet(str(labels / "bad"))
    given = ("charset", "--labels", labels / "bad", "--output", labels / "none", "--report", labels / "c.md")
    assert ran(spark, *given) == 1 and not (labels / "none").exists()
    assert ran(spark, *given, "--force") == 1 and (labels / "none").exists()


def test_audit_and_inspect(spark, labels):
    spark.createDataFrame([("a", "x ।", "x ।", "x ।")], "line_id string, source_text_original string, source_text_rendered string, text string").write.parquet(str(labels / "ok"))
    spark.createDataFrame([("a", "x ।", "x", "x")], "line_id string, source_text_original string, source_text_rendered string, text string").write.parquet(str(labels / "lost"))
    assert [ran(spark, "audit", "--metadata", labels / n, "--report", labels / "a.md") for n in ("ok", "lost")] == [0, 1]
    assert ran(spark, "inspect", "--labels", labels / "labels", "--report", labels / "a.md") == 0
    spark.read.parquet(str(labels / "labels")).selectExpr("* except(line_length)", "7 as line_length").write.parquet(str(labels / "odd"))
    assert ran(spark, "inspect", "--labels", labels / "odd", "--report", labels / "a.md") == 1 and "line_length_mismatch" in (labels / "a.md").read_text()


def test_a_manifest_that_lacks_a_split_is_not_written(spark, labels):
    spark.createDataFrame([("a", "x.png", " ", "क")], "line_id string, image_path string, split string, text string").write.parquet(str(labels / "bad"))
    (labels / "none").mkdir()
    assert ran(spark, "manifest", "--metadata", labels / "bad", "--images", labels / "none", "--output", labels / "m", "--report", labels / "m.md") == 1 and not (labels / "m").exists()
