"""Lines, rule cascades, labels and what is counted over them."""

from __future__ import annotations

import sys

# Transliteration of the fixture, digits, symbol and keyword lists.
SRC = "abcdefghijklmnopqrstuvwxyz."
DST = "ाबचदेफगहिजकलमनोपखरसतुव्षयं।"
JUNK_WORDS = ["ककाामारााक", "उयिकजिम", "यिकडमिन", "सिनपितििक", "कछ ०", "०200", "2000 %", "कडककहकाट"]
CITING = ["पृ", "संस्थान", "प्रकाश", "ऐजन"]
DATES = ["वि. सं", "वि.सं.", "साल", "संवत्", "संबत्", "इसापूर्व", "शताब्दी"]
DIGITS = "०१२३४५६७८९"
MATRAS = ["ा", "ि", "ी", "ु", "ू", "ृ", "े", "ै", "ो", "ौ", "ं", "ँ"]
PUNCTUATION = r"[?!,()\[\]{}\x22;:।॥-]"
# Characters that count as symbols in the first and in the second cascade,
# and symbols that no label may have.
SYMBOLS = r":.-=_*#@%/\|"
LABEL_SYMBOLS = r""":.-=_*#@%/\|()[]{}<>+`'"$;?,!^&~€£¥“”‘’"""
BAD_SYMBOLS = "_|&%€$£₹«»[]"
# White space of Unicode text.
BLANK = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
REQUIRED = ["।", "॥", "्", *DIGITS]
DOMAINS = {"en": 3, "fr": 2, "de": 1, "es": 0}
KEY = "doc_id, line_no, piece_no"


def within(characters: str) -> str:
    """The characters as the inside of a class, in SQL text of either engine."""
    return "".join(r"\x27" if c == "'" else "\\" + c if c in r"\[]^-" else c for c in characters)


def _digits() -> str:
    """Every code point that counts as a digit in Unicode text, superscripts too, as ranges."""
    held: list[list[int]] = []
    for c in filter(lambda c: chr(c).isdigit(), range(128, sys.maxunicode + 1)):
        if held and held[-1][1] == c - 1:
            held[-1][1] = c
        else:
            held.append([c, c])
    return "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in held)


OTHER_DIGITS = _digits()


def digit(d, t: str = "t") -> str:
    """Whether a text has a digit of any script; the long class is asked only of texts
    beyond ASCII and Devanagari."""
    return f"({d.like(t, f'[0-9{DIGITS[0]}-{DIGITS[-1]}]')} or ({d.like(t, r'[^\x00-\x7fऀ-ॿ]')} and {d.like(t, f'[{OTHER_DIGITS}]')}))"


def lines(d, lower: bool = True) -> str:
    return d.pieces(SRC, DST, lower, BLANK)


def any_of(t: str, words: list[str]) -> str:
    return " or ".join(f"contains({t}, '{w}')" for w in words)


def counted(d, source: str) -> str:
    """Adds the character-class counts that the rules need, each taken once."""
    return d.once(
        source,
        n="length(t)",
        n_dev=d.count_of("t", "ऀ-ॿ"),
        n_letters=d.count_of("t", "ऀ-ॣ॰-ॿ"),
        n_latin=d.count_of("t", "a-zA-Z"),
        n_digits=d.count_of("t", "0-9"),
        n_symbols=d.count_of("t", within(SYMBOLS)),
        n_label_symbols=d.count_of("t", within(LABEL_SYMBOLS)),
    )


def counted_lines(d, lower: bool) -> str:
    """Lines with their counts."""
    if d.kernels:
        return d.pieces(SRC, DST, lower, BLANK, "n", "n_dev", "n_letters", "n_latin", "n_digits", "n_symbols", "n_label_symbols")
    return counted(d, lines(d, lower))


def first_pass(d) -> str:
    """The first cascade: the reason of the first rule that a line fails, else keep."""
    if d.kernels:
        return f"select *, first_reason as reason from ({d.pieces(SRC, DST, False, BLANK, 'n', 'n_dev', 'first_reason')})"
    junk = " or ".join(
        [
            d.like("t", "[0-1]{4,}"), d.like("t", "[0-9]{5,}"), "(n < 25 and n_digits > 2 and n_letters < 6 and n_digits > 0.15 * n)",
            d.like("t", ":{3,}[0-9]+"), d.like("t", ":{2,}[0-9]+:{2,}"), "n_symbols > 0.20 * n", d.like("t", r"\S{40,}"),
        ]
    )
    reason = f"""case when n = 0 then 'blank' when n < 5 then 'too_short' when n_dev = 0 then 'no_devanagari'
      when n_letters < 2 then 'insufficient_devanagari_letters' when n_latin > 0.15 * n then 'too_much_latin'
      when n_dev < 0.40 * n then 'insufficient_devanagari_ratio'
      when {d.like('t', r'[^a-zA-Z0-9ऀ-ॿ\s।॥]{3,}')} then 'consecutive_junk_symbols'
      when {junk} then 'ocr_junk_filter' else 'keep' end"""
    return d.once(counted(d, lines(d, False)), reason=reason)


def label_rules(d, source: str = "") -> str:
    """The second cascade, over lower-cased lines."""
    if d.kernels and not source:
        return d.pieces(SRC, DST, True, BLANK, "reason")
    reference = " or ".join(
        [d.like("t", "अशुद्ध|शुद्ध अशुद्ध|बिषय-सूची|विषय-सूची|सूची-पत्र|सहायक ग्रन्थ"), d.like("t", "(ऐजन|एैजन|एजन)\\s*(पृ|पू)[.]"), d.like("t", "पृष्ठ\\s*[०-९0-9]+"),
         f"({d.like('t', r'^\s*[०-९0-9]+\s*[.]\s*[a-zA-Zऀ-ॿ]')} and ({any_of('t', CITING)}))"]
    )
    junk = " ".join(f"when contains(t, '{w}') then 'ocr_junk_pattern_{w}'" for w in JUNK_WORDS)
    reason = f"""case when n < 5 then 'too_short' when n > 160 then 'too_long' when n_digits > 0 then 'contains_ascii_digit'
      when {d.like('t', f'[{within(BAD_SYMBOLS[:8])}]')} then 'bad_ocr_symbols' when {d.like('t', f'[{within(BAD_SYMBOLS[8:])}]')} then 'brackets_or_guillemets'
      when contains(t, 'भाषाबंशावती') then 'noisy_header' when n_letters < 4 then 'fragment_like_too_few_letters' when n < 12 and n - n_letters > 0.60 * n then 'fragment_like_mostly_non_letters'
      when n_dev < 0.50 * n then 'low_devanagari_ratio' {junk} when contains(t, '००००') then 'ocr_junk_repeating_digits'
      when n_latin > 0 then 'ocr_junk_latin_characters' when {d.like('t', r'\S{40,}')} then 'ocr_junk_long_word_garbage' when n_label_symbols > 0.15 * n then 'symbol_heavy'
      when {reference} then 'reference_or_frontmatter_fragment' else 'keep' end"""
    return d.once(counted(d, source or lines(d)), reason=reason)


def flags(d, t: str = "t", has_digit: str = "") -> str:
    return f"""length({t}) as line_length, {t} like '%।%' as has_danda, {t} like '%॥%' as has_double_danda,
      {has_digit or digit(d, t)} as has_digit, {t} like '%्%' as has_conjunct"""


def padded(n: str) -> str:
    return f"case when {n} > 999999 then cast({n} as varchar(20)) else lpad(cast({n} as varchar(20)), 6, '0') end"


def kept(d, also: str = "") -> str:
    """Kept lines, the first of each text over all sources.

    The rules see the text only, so copies are folded first: each distinct text is
    judged once, after the shuffle and on all its partitions.  The kernels judge faster
    than rows are shuffled, so there the rejected lines go first.
    """
    if d.kernels:
        rows = d.earliest(d.pieces(SRC, DST, True, BLANK, "digit", kept=True), "t", KEY, "source, lang, digit")
        return f"select {KEY}, source, lang, t{also} from ({rows})"
    first = d.earliest(lines(d), "t", KEY, "source, lang")
    return f"select {KEY}, source, lang, t from ({label_rules(d, first)}) where reason = 'keep'"


def labels(d, ids: bool = True) -> str:
    """Kept lines with running ids per source, split by source number, and flags.  What
    does not ask for ids need not pay for the numbering."""
    number = f"cast({d.first('source', '([0-9]+)$')} as int)"
    rows, own = (kept(d, ", digit"), "digit") if d.kernels else (kept(d), "")
    numbered = d.running(rows, "source", KEY) if ids or not d.kernels else rows
    return f"""select {f"concat(source, '_', {padded('k')}) as line_id, " if ids or not d.kernels else ""}source as source_id, doc_id, line_no, piece_no, t, lang as domain,
      case when {number} % 10 <= 7 then 'train' when {number} % 10 = 8 then 'val' else 'test' end as split, {flags(d, has_digit=own)}
      from ({numbered})"""


def domain_rank(x: str) -> str:
    return f"case {x} {' '.join(f'when {chr(39)}{k}{chr(39)} then {v}' for k, v in DOMAINS.items())} else -1 end"


# Fixed values of the fixture: parts of an id and the domain they stand for, first wins.
ID_PARTS = {"src1": "first", "src2": "second", "rc3": "third", "c": "other"}


def inferred(domain: str, key: str) -> str:
    """A domain, where it is blank, by the first part that its row's id contains."""
    return f"case when trim(coalesce({domain}, '')) <> '' then {domain} {' '.join(f'when contains({key}, {chr(39)}{p}{chr(39)}) then {chr(39)}{n}{chr(39)}' for p, n in ID_PARTS.items())} else 'unknown' end"


def ranked(d) -> str:
    """Lines with text; ``low`` is smaller for a domain of more weight."""
    return f"select *, -({domain_rank('lang')}) as low from ({lines(d)}) where t <> ''"


PLANS = {
    "scan_lines": lambda d: lines(d),
    "char_class_counts": lambda d: f"select {KEY}, n, n_dev, n_letters, n_latin, n_digits, n_symbols, n_label_symbols from ({counted_lines(d, False)})",
    "char_ratios": lambda d: f"select {KEY}, round(cast(n_dev as double) / n, 6) as dev_ratio, round(cast(n_latin as double) / n, 6) as latin_ratio, round(cast(n_symbols as double) / n, 6) as symbol_ratio from ({counted_lines(d, False)}) where n > 0",
    "ws_collapse": lambda d: f"select doc_id, trim({d.replace('text', f'[{BLANK}]+', ' ')}) as text from documents",
    "digit_normalize": lambda d: f"select {KEY}, translate(t, '0123456789', '{DIGITS}') as normalized, t <> translate(t, '0123456789', '{DIGITS}') as changed from ({lines(d)})",
    "html_escape": lambda d: "select doc_id, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), chr(39), '&#x27;') as escaped from documents",
    "label_flags": lambda d: f"select {KEY}, {flags(d)} from ({lines(d)})" if not d.kernels else f"select {KEY}, {flags(d, has_digit='digit')} from ({d.pieces(SRC, DST, True, BLANK, 'digit')})",
    "target_hits": lambda d: f"select {KEY}, concat_ws(',', {', '.join(f'case when t like {chr(39)}%{m}%{chr(39)} then {chr(39)}{m}{chr(39)} end' for m in MATRAS)}) as hits from ({lines(d)})",
    "clean_reasons": lambda d: f"select {KEY}, source, t, reason from ({first_pass(d)})",
    "clean_reasons_by_source": lambda d: f"select source, reason, count(*) as n_lines, cast(sum(n) as bigint) as n_chars from ({first_pass(d)}) group by source, reason",
    "label_reasons": lambda d: f"select {KEY}, source, t, reason from ({label_rules(d)})",
    "reject_matrix": lambda d: f"""with c as (select source, reason, count(*) as n from ({label_rules(d)}) group by source, reason), s as (select distinct source from documents),
      k as (select reason from c group by reason having sum(n) > 0)
      select s.source, k.reason, coalesce(c.n, 0) as n from s cross join k left join c on s.source = c.source and k.reason = c.reason""",
    "dedup_file": lambda d: f"select source, {KEY}, t from ({d.earliest(f'select * from ({first_pass(d)}) where reason = {chr(39)}keep{chr(39)}', 'source, t', KEY)})",
    "dedup_global": kept,
    "line_ids": lambda d: f"select line_id, source_id, t from ({labels(d)})",
    "split_lookup": lambda d: f"select split, count(*) as n from ({labels(d, False)}) group by split",
    "label_rows": lambda d: f"select line_id, source_id, t, domain, split, line_length, has_danda, has_double_danda, has_digit, has_conjunct from ({labels(d)})",
    "sort_core": lambda d: f"select line_id, t from ({labels(d)}) order by line_id",
    "sort_final": lambda d: f"select line_id, {domain_rank('domain')} as priority from ({labels(d)}) order by priority desc, line_id",
    "cleaning_stats": lambda d: f"""select source, count(*) as raw_lines, sum(case when reason = 'keep' then 1 else 0 end) as cleaned_lines, sum(case when reason <> 'keep' then 1 else 0 end) as removed_lines,
      cast(sum(n) as bigint) as n_chars, cast(sum(n_dev) as bigint) as n_devanagari from ({first_pass(d)}) group by source""".replace("sum(case", "count(*) filter (where 1 = case"),
    "sum_stats": lambda d: f"select count(*) as raw_lines, cast(sum(case when reason = 'keep' then 1 else 0 end) as bigint) as cleaned_lines from ({first_pass(d)})",
    "len_stats": lambda d: f"select coalesce(min(line_length), 0) as min_length, coalesce(max(line_length), 0) as max_length, round(coalesce(avg(line_length), 0), 6) as avg_length from ({labels(d, False)})",
    "flag_counts": lambda d: f"select domain, count(*) as n, count(*) filter (where has_danda) as danda, count(*) filter (where has_double_danda) as double_danda, count(*) filter (where has_digit) as digit, count(*) filter (where has_conjunct) as conjunct from ({labels(d, False)}) group by domain",
    "domain_split_pivot": lambda d: f"select domain, count(*) filter (where split = 'train') as train, count(*) filter (where split = 'val') as val, count(*) filter (where split = 'test') as test, count(*) as total from ({labels(d, False)}) group by domain",
    "pct_share": lambda d: f"select domain, count(*) as n, round(100.0e0 * count(*) / sum(count(*)) over (), 6) as pct from ({labels(d, False)}) group by domain",
    "split_presence": lambda d: f"select count(distinct split) = 3 as all_present, count(distinct split) as n_splits from ({labels(d, False)}) where split in ('train', 'val', 'test')",
    "validate_text": lambda d: f"""select {KEY}, case when trim(t) = '' then 'blank' when n < 5 then 'too_short' when n > 160 then 'too_long' when n_digits > 0 then 'ascii_digit'
      when n_latin > 0 then 'latin_letter' when {d.like('t', f'[{within(BAD_SYMBOLS)}]')} then 'bad_symbol' when n_dev = 0 then 'no_devanagari' else 'ok' end as verdict from ({counted_lines(d, True)})""",
    "qa_verdict": lambda d: f"select case when count(*) - count(distinct line_id) + count(*) filter (where line_length < 5 or line_length > 160) = 0 then 'PASS' else 'FAIL' end as verdict from ({labels(d)})",
    "success_rate": lambda d: f"select count(*) as attempted, count(*) filter (where reason = 'keep') as passed, round(100.0e0 * count(*) filter (where reason = 'keep') / count(*), 6) as rate from ({label_rules(d)})",
    "priority_dedup_final": lambda d: f"select {KEY}, lang, t from ({d.earliest(ranked(d), 't', f'low, {KEY}', 'lang')})",
    "priority_dedup_core": lambda d: f"select {KEY}, source, t from ({d.earliest(ranked(d), 't', f'low, source, {KEY}')})",
    "dup_pairs": lambda d: f"""select l.doc_id, l.line_no, l.piece_no, k.doc_id as kept_doc, k.line_no as kept_line, k.piece_no as kept_piece from ({ranked(d)}) l
      join ({d.earliest(ranked(d), 't', f'low, {KEY}')}) k on l.t = k.t where l.doc_id <> k.doc_id or l.line_no <> k.line_no or l.piece_no <> k.piece_no""",
    "dup_counts": lambda d: f"select source, count(*) - count(distinct t) as beyond_first, count(distinct t) as n_distinct from ({lines(d)}) group by source",
    "question_totals": lambda d: f"select lang, count(*) filter (where length(q) - length(replace(q, '?', '')) = 1) as single, count(*) filter (where length(q) - length(replace(q, '?', '')) > 1) as multiple_question_marks, cast(sum(length(q) - length(replace(q, '?', ''))) as bigint) as marks from (select *, translate(t, ',', '?') as q from ({lines(d)})) where q like '%?%' group by lang",
    "largest_remainder": lambda d: _seats(f"select split, source_id, count(*) as n from ({labels(d, False)}) group by split, source_id"),
    "stratified_sample": lambda d: f"""with r as ({d.hash_rank(f"select line_id, split, source_id, concat(split, '|', source_id) as stratum from ({labels(d)})", 'stratum', '42')}),
      s as ({_seats('select split, source_id, max(k) as n from r group by split, source_id')})
      select r.line_id, r.split, r.source_id from r join s on r.split = s.split and r.source_id = s.source_id where r.k <= 120 and r.k <= s.seats""",
    "seeded_sample": lambda d: f"select line_id, t from ({labels(d)}) order by md5(concat('42|', line_id)), line_id limit 200",
    "assign_split": lambda d: f"select line_id, case when k <= 0.8 * n then 'train' when k <= 0.9 * n then 'val' else 'test' end as split from ({d.hash_rank(f'select line_id, source_id from ({labels(d)})', 'source_id', '7')})",
    "cross_dups": lambda d: f"select count(*) as n from (select distinct t from ({lines(d)}) where lang = 'en' intersect select distinct t from ({lines(d)}) where lang <> 'en')",
    "text_union": lambda d: f"select t from ({lines(d)}) where lang = 'fr' union select t from ({lines(d)}) where lang = 'es'",
    "anti_missing": lambda d: f"select l.line_id from ({labels(d)}) l left join labels h on l.doc_id = h.doc_id where h.doc_id is null",
    "left_join_helper": lambda d: f"select l.line_id, h.quality, h.toxic, coalesce(h.quality, -1) as quality_or_default from ({labels(d)}) l left join (select doc_id, max(quality) as quality, max(toxic) as toxic from labels group by doc_id) h on l.doc_id = h.doc_id",
    "union_parts": lambda d: "select doc_id, text, 'core' as part, 1 as variant from documents where lang = 'en' union all select doc_id, text, 'extra' as part, 2 as variant from documents where lang <> 'en'",
    "infer_domain": lambda d: f"select doc_id, {inferred('lang', 'source')} as domain from (select doc_id, source, case when doc_id % 3 = 0 then ' ' when doc_id % 3 = 1 then lang end as lang from documents)",
    "priority_score": lambda d: f"select {KEY}, (case when {d.like('t', '[०-९]')} then 10 else 0 end) + (case when {any_of('t', ['रू.', 'रु.'])} then 8 else 0 end) + (case when {any_of('t', DATES)} then 8 else 0 end) + (case when {d.like('t', PUNCTUATION)} then 4 else 0 end) as score from ({lines(d)})",
    "top_priority": lambda d: f"select line_id, line_length from ({labels(d)}) order by line_length desc, line_id limit 12",
    "qa_samples": lambda d: f"select line_id, split from (select *, row_number() over (partition by split order by {KEY}) as rn from ({labels(d)})) where rn <= 5",
    "coverage_below": lambda d: d.rows(f"select {', '.join(f'count(*) filter (where t like {chr(39)}%{m}%{chr(39)}) as n{i}' for i, m in enumerate(MATRAS))} from ({labels(d, False)})",
      "target, n, below", [(f"'{m}'", f"n{i}", f"n{i} < 80") for i, m in enumerate(MATRAS)]),
    "digit_ratio": lambda d: f"select source_id, round(avg(case when has_digit then 1.0e0 else 0.0e0 end), 6) as ratio from ({labels(d, False)}) group by source_id",
    "weighted_choice": lambda d: f"select line_id, case when u < 0.45 * 4294967296 then 'easy' when u < 0.85 * 4294967296 then 'medium' else 'hard' end as difficulty, v < 0.30 * 4294967296 as composed from (select line_id, {d.draw(chr(39) + 'difficulty' + chr(39), 'line_id')} as u, {d.draw(chr(39) + 'composed' + chr(39), 'line_id')} as v from ({labels(d)}))",
    "param_draws": lambda d: f"select line_id, 28 + {d.draw(chr(39) + 'font' + chr(39), 'line_id')} % 25 as font_size, 15 + {d.draw(chr(39) + 'pad' + chr(39), 'line_id')} % 21 as padding from ({labels(d)})",
    "rounding": lambda d: f"select l_orderkey, l_linenumber, {d.half_even('l_quantity * 0.3e0', 0)} as third, {d.half_even('l_quantity / 8', 2)} as eighth from lineitem",
    "props_json": lambda d: f"select event_id, cast({d.json('props', '$.k')} as bigint) as k, coalesce({d.json('props', '$.missing')}, 'default') as missing from events",
    "char_freq": lambda d: d.frequencies(labels(d, False)),
    "topk_chars": lambda d: f"select ch, freq from ({d.frequencies(labels(d, False))}) order by freq desc, ch limit 50",
    "bottomk_chars": lambda d: f"select ch, freq from ({d.frequencies(labels(d, False))}) order by freq, ch limit 50",
    "codepoint_hex": lambda d: f"select ch, {d.hexcode('ch')} as code from ({distinct_chars(d, labels(d, False))})",
    "charset_ids": lambda d: _charset(d),
    "charset_size": lambda d: f"select count(*) as num_characters, count(*) + 1 as num_classes from ({_charset(d)})",
    "presence": lambda d: d.rows(f"select {', '.join(f'count(*) filter (where ch = {chr(39)}{c}{chr(39)}) > 0 as p{i}' for i, c in enumerate(REQUIRED))} from ({_charset(d)})",
      "ch, present", [(f"'{c}'", f"p{i}") for i, c in enumerate(REQUIRED)]),
    "encode_ids": lambda d: d.encoded(labels(d), _charset(d)),
    "roundtrip": lambda d: d.decoded(labels(d), _charset(d)) if not d.kernels else f"select line_id, same from ({d.decoded(labels(d), _charset(d))})",
}


def distinct_chars(d, source: str) -> str:
    return d.frequencies(source) if d.kernels else f"select distinct ch from ({d.chars('(' + source + ')', 'line_id')})"


def _seats(counts: str) -> str:
    """Largest remainders: 120 seats of each split over its sources, in integers.
    ``counts`` gives split, source_id and n."""
    return f"""select split, source_id, n, base + (case when rk <= 120 - sum(base) over (partition by split) then 1 else 0 end) as seats from (
      select *, row_number() over (partition by split order by rest desc, source_id) as rk from (
        select split, source_id, n, cast((120 * n - (120 * n) % total) / total as bigint) as base, (120 * n) % total as rest from (
          select split, source_id, n, cast(sum(n) over (partition by split) as bigint) as total from ({counts}))))"""


def _charset(d) -> str:
    bucket = f"case when ch = ' ' then 0 when ch in ({', '.join(repr(c) for c in DIGITS)}) then 1 when ch in ('।', '॥') then 2 when {d.like('ch', '^[!-/:-@]$')} then 3 when {d.like('ch', '^[ऀ-ॿ]$')} then 4 else 5 end"
    kinds = f"{bucket} as bucket, {d.codepoint('ch')} as code"
    counts = f"select ch, freq, {kinds} from ({d.frequencies(labels(d, False))})" if d.kernels else f"select ch, count(*) as freq, {kinds} from ({d.chars('(' + labels(d) + ')', 'line_id')}) group by ch"
    return f"select row_number() over (order by bucket, code) as char_id, ch, freq from ({counts})"
