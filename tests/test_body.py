"""Bodies of files by their markers, chunks, inferred domains, and shared shuffles."""

import pytest

from linefold import catalog
from linefold.functions.dialect import Spark
from linefold.plans import lines, rules

SF = "/root/testdata/sf0.001"
CHRONICLE, ESSAYS, GENEALOGY, HISTORY = rules.BODIES


@pytest.mark.parametrize(
    "kind, marked, n, body",
    [(CHRONICLE, {10: "x श्रीगणेशाय नमः"}, 20, (10, 20)), (CHRONICLE, {10: "श्रीणणेशाय नमः", 7: "भाषावंशावली", 6: "भाषावंशावली", 3: "भाषावंशावली"}, 20, (6, 20)), (CHRONICLE, {}, 20, (0, 20)),
     (ESSAYS, {2: "डा. जगदीश चन्द्र रेग्मी", 15: "धन्यवाद ज्ञापन गर्दछु", 17: "धन्यवाद ज्ञापन गर्दछु"}, 20, (0, 18)), (ESSAYS, {9: "डा. जगदीश चन्द्र रेग्मी", 4: "धन्यवाद ज्ञापन गर्दछु"}, 20, (6, 20)),
     (GENEALOGY, {5: "नमो गोरङ्गकालीम्याम्‌ ॥", 5 + 1: "समाप्त भयो"}, 20, (5, 7)), (GENEALOGY, {5: "समाप्त भयो"}, 20, (0, 6)),
     (HISTORY, {3: "नेपालको इतिहास", 5: "सहायक ग्रन्थसूची", 8: "नेपालको इतिहास", 1008: "सहायक ग्रन्थ", 1009: "सहायक ग्रन्थ", 1015: "सहायक ग्रन्थ"}, 1020, (8, 1009)),
     (HISTORY, {50: "नेपालको इतिहासका स्रोतहरू", 120: "नेपालको इतिहासका स्रोतहरू"}, 200, (120, 200)), (HISTORY, {5: "सहायक ग्रन्थसूची"}, 20, (0, 20)), ("another", {5: "समाप्त भयो"}, 20, (0, 20))],
)
def test_bodies(spark, kind, marked, n, body):
    spark.createDataFrame([(1, kind, i, marked.get(i, "line")) for i in range(n)], "doc_id long, kind string, line_no int, t string").createOrReplaceTempView("given")
    got = spark.sql(rules.body_ranges(Spark, "select * from given", rules.BODIES)).collect()
    assert [(r.start_at, r.end_at) for r in got] == [body]


def test_chunks_are_contiguous_and_equal_but_the_last(spark):
    rows = sorted(catalog.QUERIES["chunking"](spark, SF).collect())
    n = sum(r.n for r in rows)
    size = -(-n // rules.WORKERS)
    assert [(r.chunk, r.start_at, r.n) for r in rows] == [(i, i * size, min(size, n - i * size)) for i in range(-(-n // size))]


def test_domain_of_an_id(spark):
    rows = [("en", "src1"), (" ", "src17"), (None, "src2"), ("", "xrc3"), (None, "c"), (None, "zz")]
    spark.createDataFrame(rows, "d string, k string").createOrReplaceTempView("given")
    assert [r[0] for r in spark.sql(f"select {lines.inferred('d', 'k')} from given").collect()] == ["en", "first", "second", "third", "other", "unknown"]


def test_twelve_samples(spark):
    rows = catalog.QUERIES["twelve_samples"](spark, SF).collect()
    assert len({(r.line_id, r.variant_index) for r in rows}) == 12 and len({r.profile for r in rows if not r.filler}) == sum(not r.filler for r in rows) == 12


@pytest.mark.parametrize("name", ["label_rows", "stratified_sample", "encode_ids", "roundtrip", "assign_split"])
def test_labels_are_made_once(spark, name):
    """However often a plan mentions them; the first scan is of the lines, the second, where
    there is one, is reused."""
    got = catalog.QUERIES[name](spark, SF)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")
    final = plan[0] + "".join(p.split("== Final Plan ==")[-1] for p in plan[1:])
    assert final.count("FileScan parquet") <= 1 or "ReusedExchange" in final
