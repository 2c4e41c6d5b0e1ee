"""The Arrow kernels against the same plans in SQL, on odd texts, and what plans cost."""

import random

import pytest

from linefold import catalog
from linefold.functions.dialect import Arrow, Spark
from linefold.operators import pieces
from linefold.plans import lines

SF = "/root/testdata/sf0.001"
ODD = [
    "", "\n", ". ", "a. ", ". . b", "\n\n. \n", ".\n .", "end.", " starts", "x.", None, " \t  ", "a 　b\x1cc", "² ① \U0001d7d7 \U0001f60a", "क" * 39 + " " + "क" * 40, "क" * 41, "Hello. World.\nBye. ",
    "क्ष ०००० नेपाल देश।", "नेपाल सूची-पत्र देश राम्रो", "१ .नेपाल प्रकाश देश", "ऐजन  पृ. नेपाल देश", "यो भाषाबंशावती हो", "क ।।।।", "नेपा ।।।।।।", "नेपाल ---------- !!", "नेपाल | देश", "नेपाल «देश»", "यो उयिकजिम हो", "::१२३:: नेपाल देश राम्रो",
    "कखगघङचछजझ 1101", "कखगघङचछ ***", "कखगघङचछजझञ :::12", "नेपाल ¥¥ देश ''", "é́ combining नेपाल",
]


def texts():
    draw = random.Random(7)
    made = ["".join(draw.choice("aAbkp. .\n 012०९।॥्|[:* क") for _ in range(draw.randrange(90))) for _ in range(400)]
    return [(i, t, f"src{i % 3}", "en") for i, t in enumerate([*ODD, *made, *ODD])]


def both(spark, plan, columns):
    """A plan's rows by kernels and by SQL alone."""
    spark.createDataFrame(texts(), "doc_id long, text string, source string, lang string").repartition(3).createOrReplaceTempView("documents")
    return [sorted(map(repr, made.select(*columns).collect())) for made in (catalog.resolved(spark, plan(Arrow)), spark.sql(plan(Spark)))]


@pytest.mark.parametrize("name", ["scan_lines", "char_class_counts", "clean_reasons", "label_reasons", "label_flags", "dedup_global", "label_rows", "char_freq", "charset_ids", "encode_ids", "roundtrip", "decode_ids"])
def test_kernels_agree_with_sql(spark, name, monkeypatch):
    monkeypatch.setattr(pieces, "SLICE_BYTES", 64)
    plan = lines.PLANS[name] if name in lines.PLANS else catalog.PLANS[name]
    columns = catalog.QUERIES[name](spark, SF).columns
    got, want = both(spark, plan, columns)
    assert got == want and got


def executed(spark, name):
    rows = catalog.QUERIES[name](spark, SF)
    rows.collect()
    return rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["charset_gate", "charset_size", "char_freq"])
def test_characters_are_counted_without_a_row_for_each(spark, name):
    """Nor are labels numbered for it (F1: one row a character, labels made four times)."""
    plan = executed(spark, name)
    assert "explode(split(" not in plan and "line_no#" not in plan.split("MapInArrow", 1)[0]


def test_draws_stop_at_the_first_hit(spark):
    """The same rows as with all draws in SQL, which are not made (F2)."""
    plan = catalog.PLANS["composed_difficulty"]
    columns = catalog.QUERIES["composed_difficulty"](spark, SF).columns
    got, want = both(spark, plan, columns)
    assert got == want and got
    assert "transform(sequence(" not in executed(spark, "composed_difficulty")


def test_draws_of_a_label_are_made_once(spark):
    """Not for each variant, and only those that are asked for (F3, F20)."""
    assert "is_gone" in executed(spark, "manifest_qa")
    plan = executed(spark, "image_names")
    assert "profile_no" not in plan and "score" not in plan


def test_images_stay_in_the_worker(spark):
    """The query's digests are those of the images, which it does not hand over (F4)."""
    import hashlib

    from linefold.operators import raster

    rows = catalog.QUERIES["rendered_lines"](spark, SF)
    assert "sha2(" not in rows._jdf.queryExecution().optimizedPlan().toString()
    texts = {r.line_id: r.t for r in catalog.QUERIES["label_rows"](spark, SF).select("line_id", "t").collect()}
    for r in rows.limit(50).collect():
        image, renderer, reason = raster.render_line(texts[r.line_id], 3)
        assert (r.renderer, r.reason, r.height, r.width, r.pixels) == (renderer, reason, *image.shape, hashlib.sha256(image.tobytes()).hexdigest())


def test_labels_are_written_once_for_all_tags(spark):
    """One write by domain (F8): two branches made the labels twice."""
    rows = catalog.QUERIES["ingest_tagged"](spark, SF)
    want = catalog.QUERIES["label_rows"](spark, SF).where("domain in ('en', 'fr')").select("line_id", "t", "domain")
    assert sorted(map(repr, rows.select("line_id", "t", "domain").collect())) == sorted(map(repr, want.collect()))
    assert all("/all/domain=" in f for f in rows.inputFiles())
