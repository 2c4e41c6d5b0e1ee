"""Every fifth plan against the second engine, and rule tables by hand."""

import duckdb
import pytest

from linefold import catalog
from linefold.functions.dialect import Duck
from linefold.plans import lines

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(catalog.PLANS)[::5])
def test_plan_agrees(spark, name):
    con = duckdb.connect()
    for t in catalog.tables_of(catalog.SQL[name]):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = catalog.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    rows = sorted(repr(tuple(r)) for r in got.select(*cols).collect())
    assert rows == sorted(map(repr, con.sql(f"select {', '.join(cols)} from ({catalog.SQL[name]})").fetchall()))


@pytest.mark.parametrize(
    "text, reason",
    [("कखग", "too_short"), ("hello there", "no_devanagari"), ("क।।।।।", "insufficient_devanagari_letters"), ("कखगघङचछ abcdef", "too_much_latin"), ("कख" + " -" * 9, "insufficient_devanagari_ratio"),
     ("कखगघङचछ ***", "consecutive_junk_symbols"), ("कखगघङचछजझ 1101", "ocr_junk_filter"), ("क" * 41, "ocr_junk_filter"), ("नेपाल राम्रो देश हो।", "keep")],
)
def test_first_pass(text, reason):
    con = duckdb.connect()
    con.execute("create table documents as select 1 as doc_id, ? as text, 'src0' as source, 'en' as lang", [text])
    sql = lines.first_pass(Duck).replace(lines.SRC, "").replace(lines.DST, "")
    assert con.sql(f"select reason from ({sql})").fetchall()[0][0] == reason


def test_seats_add_up(spark):
    rows = catalog.QUERIES["largest_remainder"](spark, SF).groupBy("split").sum("seats").collect()
    assert {r[1] for r in rows} == {120}
