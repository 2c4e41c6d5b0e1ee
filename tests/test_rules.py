"""Rule tables written by hand, in the order of the rules."""

import pytest

from linefold.functions.dialect import Spark
from linefold.plans import lines, rules


def reason(spark, cascade, text):
    spark.createDataFrame([(1, text, "src0", "en")], "doc_id long, text string, source string, lang string").createOrReplaceTempView("documents")
    plain = cascade(Spark).replace(lines.SRC[:26].upper() + lines.SRC, "").replace(lines.SRC, "").replace(lines.DST[:26] + lines.DST, "").replace(lines.DST, "")
    return [r.reason for r in spark.sql(plain.replace("/*spread*/", "")).collect()]


@pytest.mark.parametrize(
    "text, expected",
    [("कखग", "too_short"), ("क " * 81, "too_long"), ("नेपाल 2 देश", "contains_ascii_digit"), ("नेपाल | देश", "bad_ocr_symbols"), ("नेपाल «देश»", "brackets_or_guillemets"),
     ("यो भाषाबंशावती हो", "noisy_header"), ("क ।।।।", "fragment_like_too_few_letters"), ("नेपा ।।।।।।", "fragment_like_mostly_non_letters"), ("नेपाल ---------- !!", "low_devanagari_ratio"),
     ("यो उयिकजिम हो", "ocr_junk_pattern_उयिकजिम"), ("नेपाल ०००० देश", "ocr_junk_repeating_digits"), ("नेपाल देश abc", "ocr_junk_latin_characters"), ("क" * 41, "ocr_junk_long_word_garbage"),
     ("नेपाल देश -----", "symbol_heavy"), ("नेपाल सूची-पत्र देश राम्रो", "reference_or_frontmatter_fragment"), ("१ .नेपाल प्रकाश देश", "reference_or_frontmatter_fragment"), ("नेपाल राम्रो देश हो।", "keep")],
)
def test_label_rules(spark, text, expected):
    assert reason(spark, lines.label_rules, text) == [expected]


@pytest.mark.parametrize(
    "text, expected",
    [("किन? किन?", "multiple_question_marks"), ("नाम ५?", "adjacent_junk_or_digit_or_quote"), ("नाम क ?", "unclear_preceding_word_क"), ("तिमी किन आयौ?", "matched_question_pattern"),
     ("को हो?", "matched_question_pattern"), ("केही राम्रो?", "missing_question_indicators"), ("राम्रो छ?", "matched_ending_pattern"), ("राम्रो छकी ?", "matched_ending_pattern"), ("नेपाल राम्रो?", "missing_question_indicators")],
)
def test_question_rule(spark, text, expected):
    assert reason(spark, rules.question_rule, text) == [expected]


def test_profiles_share_their_bucket():
    assert sum(w for w, _ in rules.PROFILES.values()) == 1000
