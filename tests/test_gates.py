"""Gates over hand-written rows: what each says, one wrong value at a time."""

import pytest

from linefold.functions.dialect import Spark
from linefold.plans import gates, lines
from linefold.sources import files

GOOD = ("a_000001", "s", "d", "train", "नेपाल राम्रो देश हो।", "20", "true", "false", "false", "true")
COLUMNS = "line_id string, source_id string, domain string, split string, text string, line_length string, has_danda string, has_double_danda string, has_digit string, has_conjunct string"


def row(**changes):
    held = dict(zip([c.split()[0] for c in COLUMNS.split(", ")], GOOD))
    return tuple({**held, **changes}.values())


def asked(spark, gate, rows, columns=COLUMNS):
    spark.createDataFrame(rows, columns).createOrReplaceTempView("given")
    return spark.sql(gate(Spark, "select * from given")).collect()


@pytest.mark.parametrize(
    "changes, problems",
    [({}, ""), ({"has_danda": "TRUE"}, ""), ({"text": "   ", "line_length": "3", "has_danda": "false", "has_conjunct": "false"}, "blank_text,short_text,no_devanagari_chars"),
     ({"text": "नेपाल 7 x_|[देश", "line_length": "15", "has_danda": "false", "has_digit": "true", "has_conjunct": "false"}, "ascii_digits,latin_letters,bad_symbols__|["),
     ({"text": "क" * 161, "line_length": "161", "has_danda": "false", "has_conjunct": "false"}, "long_text"), ({"line_length": "21"}, "line_length_mismatch"),
     ({"has_danda": "false", "has_double_danda": "true", "has_digit": "true", "has_conjunct": ""}, "has_danda_mismatch,has_double_danda_mismatch,has_digit_mismatch,has_conjunct_mismatch"),
     ({"text": "नेपाल राम्रो ² देश।", "line_length": "19", "has_digit": "true"}, "")],
)
def test_row_problems(spark, changes, problems):
    assert [r.problems for r in asked(spark, gates.row_problems, [row(**changes)])] == [problems]


def test_core_gate(spark, tmp_path):
    rows = [row(line_id=f"a_{i}", split=s) for i, s in enumerate(("train", "val", "test"))]
    assert asked(spark, gates.core, rows)[0].verdict == "PASS"
    for wrong in ([*rows, rows[0]], [*rows, row(line_id="b", text=" ")], [*rows, row(line_id="b", text="नेपाल ५ a देश")], rows[:2], [*rows, row(line_id="b", text="नेपाल | देश")]):
        got = asked(spark, gates.core, wrong)[0]
        assert got.verdict == "FAIL" and sum(got[1:-1]) > 0
    done = []
    gate = spark.sql(gates.core(Spark, "select * from given"))
    with pytest.raises(ValueError):
        files.write_if_passed(gate, lambda: done.append(1))
    files.write_if_passed(gate.where("false"), lambda: done.append(2))
    with pytest.raises(ValueError):
        files.write_if_passed(gate.drop("verdict"), lambda: done.append(3))
    assert done == [2]


@pytest.mark.parametrize(
    "rows, counts",
    [([("रू. १ वि. सं। ॥", "रू. १ वि. सं। ॥", "रू. १ वि. सं। ॥")], (0, 0, 0, 0)), ([("रू. वि. सं। ॥", "x", "x")], (0, 0, 0, 4)), ([("a", "", "a"), ("a", None, "a"), (None, "a1", "b")], (3, 0, 0, 0)),
     ([("5", "5", "५")], (0, 1, 1, 0)), ([("।", "क", "क"), ("॥", "॥", "क")], (0, 0, 1, 1))],
)
def test_audit(spark, rows, counts):
    got = asked(spark, gates.audit, rows, "original string, rendered string, text string")[0]
    assert tuple(got)[1:5] == counts and got.errors == sum(counts) and (got.verdict == "PASS") == (sum(counts) == 0)


def test_manifest_gate(spark):
    columns = "line_id string, variant_index int, image_path string, split string, text string, present boolean"
    rows = [("a", 1, "x.png", "Train", "कख", True), ("a", 2, "x.png", "val", "", False), ("a", 2, "y.png", " ", " ", True), ("b", 1, "z.png", "test", "7z_", True)]
    got = asked(spark, gates.manifest, rows, columns)[0].asDict()
    assert got == {"n": 4, "missing_required": 1, "missing_images": 1, "blank": 1, "duplicate_paths": 1, "duplicate_variants": 1, "ascii_digits": 1, "latin_letters": 1, "bad_symbols": 1, "train": 1, "val": 1, "test": 1, "passed": False}
    assert asked(spark, gates.manifest, rows[:2], columns)[0].passed


def test_charset_gate(spark):
    chars = [*"०१२३४५६७८९", "।", "॥", "्", "क", "ष", " "]
    spark.createDataFrame(list(enumerate(chars, 1)), "char_id int, ch string").createOrReplaceTempView("held")

    def got(texts, without=""):
        spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "line_id string, t string").createOrReplaceTempView("texts")
        return spark.sql(gates.charset(Spark, "select line_id, t from texts", f"select char_id, ch from held where ch <> '{without}'")).collect()[0]

    assert got(["क्ष ५।"]).passed and not got(["क्ष ५।"]).anusvara
    for texts, without in ((["क्ष", " "], ""), (["क 5"], ""), (["क x"], ""), (["ख"], ""), (["क"], "५"), (["क"], "॥"), (["क"], "्")):
        assert not got(texts, without).passed
    assert got(["कख"]).unencodable == 1 and got(["कख"]).mismatches == 1


def test_coverage_counters(spark):
    columns = "line_id string, tidx int, text string, split string, line_length string, has_danda string, has_double_danda string, has_digit string, has_conjunct string"
    rows = [("c1", 0, "नेपाल ५ देश", "train", "11", "false", "false", "true", "false"), ("c2", 0, "नेपाल ६ देश", "val", "12", "true", "true", "false", "true"), ("c2", 0, "नेपाल ५ देश", "test", "11", "false", "false", "true", "false")]
    gate = lambda d, source: gates.coverage_counts(d, source, "select 'नेपाल ६ देश' as t", "select 'x' as t")
    got = asked(spark, gate, rows, columns)[0]
    assert (got.total_rows, got.train, got.val, got.test, got.dup_line_ids, got.dup_texts, got.cross_file_duplicates, got.core_merged_duplicates) == (3, 1, 1, 1, 1, 1, 1, 0)
    assert (got.length_mismatch, got.digit_mismatch, got.danda_mismatch, got.double_danda_mismatch, got.conjunct_mismatch) == (1, 1, 1, 1, 1)
    assert got.verdict == "FAIL" and got.failures.startswith("dup_line_ids,dup_texts,length_mismatch,digit_mismatch") and got.failures.endswith("digit_ratio_below_80pct")


@pytest.mark.parametrize("text, heavy", [("नेपाल देश ''", True), ("नेपाल देश ¥¥", True), ("नेपालीय देश '", False), ("नेपाल देश ₹₹", False), ("नेपाल देश ^~", True), ("नेपाल देश []", True), ("नेपाल देश -\\", True)])
def test_label_symbols(spark, text, heavy):
    spark.createDataFrame([(text,)], "t string").createOrReplaceTempView("texts")
    got = spark.sql(f"select n_label_symbols > 0.15 * n as heavy, n_label_symbols from ({lines.counted(Spark, 'select * from texts')})").collect()[0]
    assert got.heavy == heavy and got.n_label_symbols == sum(c in lines.LABEL_SYMBOLS for c in text)


def test_blanks_and_digits_of_every_script(spark):
    texts = ["a b 　c\x1d d", "  x\u0085 ", "ज‌क", "٣", "²", "①", "½", "x", "५", "𝟗", ""]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").createOrReplaceTempView("documents")
    got = [r.text for r in spark.sql(lines.PLANS["ws_collapse"](Spark)).orderBy("doc_id").collect()]
    assert got == [" ".join(t.split()) for t in texts]
    found = [r.d for r in spark.sql(f"select doc_id, {lines.digit(Spark, 'text')} as d from documents order by doc_id").collect()]
    assert found == [any(c.isdigit() for c in t) for t in texts]
