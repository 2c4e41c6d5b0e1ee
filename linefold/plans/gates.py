"""Gates: what decides whether labels, manifests and vocabularies may be written.

Each takes the rows it judges as SQL, so that it can be asked of any source; the plans
ask it of fixture rows in which some stored values are wrong.
"""

from __future__ import annotations

from . import coverage
from . import lines as ln
from .rules import images, named

# Names of the checks of a stored row, and further characters whose
# presence in a vocabulary is reported.
FLAGS = ["has_danda", "has_double_danda", "has_digit", "has_conjunct"]
REPORTED = {"anusvara": "ं", "visarga": "ः", "chandrabindu": "ँ", "avagraha": "ऽ", "vedic_accent_udatta": "॑", "vedic_accent_anudatta": "॒"}
# What must be in a rendered text if it is in the original.
PRESERVED = ["रू.", "वि. सं", "।", "॥"]
DIGIT_RATIO = 0.80
CHARSET_OK = "blank + ascii_digits + latin_letters + unencodable + mismatches = 0 and devanagari_digits and danda and double_danda and halant"


def odd(d, name: str, n: int, key: str = "line_id") -> str:
    """Whether the fixture makes a row's value wrong: one row of ``n``, by a digest."""
    return f"({d.draw(coverage.quoted(name), key)} % {n} = 0)"


def stored(d) -> str:
    """Labels with their metadata as stored text; one of forty values is wrong."""
    text = f"case when {odd(d, 'text', 40)} then concat(t, ' 7a|$') when {odd(d, 'blank', 200)} then ' ' else t end"
    said = ", ".join(f"case when {f} <> {odd(d, f, 40)} then 'True' else 'false' end as {f}" for f in FLAGS)
    return f"""select line_id, source_id, domain, case when {odd(d, 'split', 90)} then '' else split end as split, {text} as text,
      cast(line_length + case when {odd(d, 'length', 40)} then 1 else 0 end as varchar(9)) as line_length, {said} from ({ln.labels(d)})"""


def mismatches(d) -> dict[str, str]:
    own = {"has_danda": "text like '%।%'", "has_double_danda": "text like '%॥%'", "has_digit": ln.digit(d, "text"), "has_conjunct": "text like '%्%'"}
    return {"line_length": "cast(line_length as int) <> length(text)", **{f: f"(lower({f}) = 'true') <> ({x})" for f, x in own.items()}}


def row_problems(d, source: str) -> str:
    """All checks that a stored row fails, comma-joined in their order.  Needs line_id,
    text, line_length and the four flags as text."""
    bad = ln.within(ln.BAD_SYMBOLS)
    checks = [
        ("trim(text) = ''", "'blank_text'"), (d.like("text", "[0-9]"), "'ascii_digits'"), (d.like("text", "[a-zA-Z]"), "'latin_letters'"),
        (d.like("text", f"[{bad}]"), f"concat('bad_symbols_', {d.replace('text', f'[^{bad}]')})"), ("length(text) < 5", "'short_text'"), ("length(text) > 160", "'long_text'"),
        (f"not {d.like('text', '[ऀ-ॿ]')}", "'no_devanagari_chars'"), *((x, f"'{f}_mismatch'") for f, x in mismatches(d).items()),
    ]
    return f"select line_id, concat_ws(',', {', '.join(f'case when {c} then {n} end' for c, n in checks)}) as problems from ({source})"


def core(d, source: str) -> str:
    """Counters of a merged table and its verdict; it must not be written on FAIL."""
    count = {
        "blank": "trim(text) = ''", "short": "length(text) < 5", "long": "length(text) > 160", "ascii_digits": d.like("text", "[0-9]"), "latin_letters": d.like("text", "[a-zA-Z]"),
        "bad_symbols": d.like("text", f"[{ln.within(ln.BAD_SYMBOLS)}]"),
    }
    counts = f"""select count(*) as n, count(*) - count(distinct line_id) as duplicate_ids, {', '.join(f'count(*) filter (where {c}) as {k}' for k, c in count.items())},
      3 - count(distinct case when split in ('train', 'val', 'test') then split end) as missing_splits from ({source})"""
    total = " + ".join(["duplicate_ids", *count, "missing_splits"])
    return f"select *, case when {total} = 0 then 'PASS' else 'FAIL' end as verdict from ({counts})"


def audit(d, source: str) -> str:
    """Counters over (original, rendered, text): fields that are missing, ASCII digits
    left, a rendered text that is not the label, marks that were lost.  A row with a
    missing field is asked nothing else."""
    whole = "coalesce(original, '') <> '' and coalesce(rendered, '') <> '' and coalesce(text, '') <> ''"
    lost = " + ".join(f"case when contains(original, '{m}') and not contains(rendered, '{m}') then 1 else 0 end" for m in PRESERVED)
    counts = f"""select count(*) as n, count(*) filter (where not ({whole})) as missing_fields, count(*) filter (where {whole} and {d.like('rendered', '[0-9]')}) as ascii_digits,
      count(*) filter (where {whole} and rendered <> text) as mismatches, cast(coalesce(sum(case when {whole} then {lost} else 0 end), 0) as bigint) as lost_marks from ({source})"""
    total = "missing_fields + ascii_digits + mismatches + lost_marks"
    return f"select *, {total} as errors, case when {total} = 0 then 'PASS' else 'FAIL' end as verdict from ({counts})"


def audited(d) -> str:
    """Lines as written, as rendered with other digits, and as labelled; some lose a mark,
    differ or are missing."""
    key = f"concat({ln.KEY.replace(', ', ", '|', ")})"
    rendered = f"translate(t, '0123456789', '{ln.DIGITS}')"
    return f"""select original, rendered, case when {odd(d, 'label', 60, 'k')} then concat(rendered, 'क') else rendered end as text from (
      select k, t as original, case when {odd(d, 'none', 90, 'k')} then '' when {odd(d, 'lost', 40, 'k')} then replace({rendered}, '।', '') when {odd(d, 'kept', 70, 'k')} then t else {rendered} end as rendered
      from (select t, {key} as k from ({ln.lines(d)})))"""


def manifest(d, source: str) -> str:
    """Counters of a manifest with ``present`` (whether the image is there).  ``passed``
    is false, and nothing may be written, if a required value is missing; a blank text
    is an empty one, and odd symbols are for information."""
    bad = d.like("text", f"[{ln.within(ln.BAD_SYMBOLS)}]")
    empty = " or ".join(f"trim(coalesce({c}, '')) = ''" for c in ("image_path", "split", "line_id"))
    splits = ", ".join(f"count(*) filter (where lower(trim(split)) = '{s}') as {s}" for s in ("train", "val", "test"))
    return f"""select count(*) as n, count(*) filter (where {empty}) as missing_required, count(*) filter (where not present) as missing_images, count(*) filter (where text = '') as blank,
      count(*) - count(distinct image_path) as duplicate_paths, count(*) - count(distinct concat(line_id, '|', cast(variant_index as varchar(9)))) as duplicate_variants,
      count(*) filter (where {d.like('text', '[0-9]')}) as ascii_digits, count(*) filter (where {d.like('text', '[a-zA-Z]')}) as latin_letters, count(*) filter (where {bad}) as bad_symbols, {splits},
      count(*) filter (where {empty}) = 0 as passed from ({source})"""


def manifest_rows(d) -> str:
    """The fixture's manifest: images listed twice, missing or without a split."""
    wrong = {k: odd(d, k, n) for k, n in {"twice": 50, "split": 900, "empty": 70, "odd": 70, "gone": 30}.items()}
    rows = named(d)
    if d.kernels:
        # What depends on the label alone is drawn once, not for each variant.
        drawn = d.once(ln.labels(d), **{f"is_{k}": x for k, x in wrong.items()})
        wrong = {k: f"is_{k}" for k in wrong}
        rows = images(d, drawn, "".join(f", {x}" for x in wrong.values()))
    path = f"case when {wrong['twice']} then concat(line_id, '.png') else image_path end"
    return f"select line_id, variant_index, {path} as image_path, case when {wrong['split']} then ' ' else split end as split, case when {wrong['empty']} then '' when {wrong['odd']} then concat(t, '5x_') else t end as text, not {wrong['gone']} as present from ({rows})"


def charset(d, labels: str, chars: str) -> str:
    """Counters of texts (line_id, t) under a vocabulary (char_id, ch) and which marks it
    has; ``passed`` asks for the counters and for digits, both dandas and the halant."""
    has = lambda c: f"count(*) filter (where ch = '{c}') > 0"
    digits = f"count(distinct case when ch in ({', '.join(repr(c) for c in ln.DIGITS)}) then ch end) = 10"
    present = {"devanagari_digits": digits, "danda": has("।"), "double_danda": has("॥"), "halant": has("्"), **{k: has(c) for k, c in REPORTED.items()}}
    held = f"select count(*) as num_characters, {', '.join(f'{x} as {k}' for k, x in present.items())} from ({chars})"
    if d.kernels:
        return _charset_at_once(d, labels, chars, present)
    texts = f"select count(*) as n, count(*) filter (where trim(t) = '') as blank, count(*) filter (where {d.like('t', '[0-9]')}) as ascii_digits, count(*) filter (where {d.like('t', '[a-zA-Z]')}) as latin_letters from ({labels})"
    unknown = f"select count(*) as unencodable from ({ln.distinct_chars(d, labels)}) c left join (select ch as known from ({chars})) k on c.ch = k.known where known is null"
    wrong = f"select count(*) filter (where not same) as mismatches from ({d.decoded(labels, chars)})"
    return f"select *, {CHARSET_OK} as passed from ({texts}) join ({held}) on 1 = 1 join ({unknown}) on 1 = 1 join ({wrong}) on 1 = 1"


def _charset_at_once(d, labels: str, chars: str, present: dict[str, str]) -> str:
    """The same from two passes: texts with what decoding gives, and the characters of
    both sides.  ``labels(t)`` needs no ids."""
    texts = f"""select count(*) as n, count(*) filter (where trim(t) = '') as blank, count(*) filter (where {d.like('t', '[0-9]')}) as ascii_digits,
      count(*) filter (where {d.like('t', '[a-zA-Z]')}) as latin_letters, count(*) filter (where not same) as mismatches from ({d.decoded(f"select '' as line_id, t from ({labels})", chars)})"""
    both = f"select k.ch, c.ch as asked from ({d.frequencies(labels)}) c full outer join ({chars}) k on c.ch = k.ch"
    held = f"select count(ch) as num_characters, {', '.join(f'{x} as {k}' for k, x in present.items())}, count(*) filter (where ch is null) as unencodable from ({both})"
    counts = ", ".join(["n, blank, ascii_digits, latin_letters, num_characters", *present, "unencodable, mismatches"])
    return f"select {counts}, {CHARSET_OK} as passed from ({texts}) join ({held}) on 1 = 1"


def generated(d) -> str:
    """Generated lines with ids, splits and stored metadata; three in a hundred are wrong."""
    rows = f"select *, concat('coverage_', {ln.padded('row_number() over (order by t)')}) as line_id from ({coverage.generated(d)})"
    said = ", ".join(f"case when {f} <> {odd(d, f, 33)} then 'true' else 'false' end as {f}" for f in FLAGS)
    flagged = f"select *, {ln.flags(d)} from ({rows})"
    return f"select line_id, tidx, t as text, case when {odd(d, 'val', 10)} then 'val' else 'train' end as split, cast(line_length as varchar(9)) as line_length, {said} from ({flagged})"


def coverage_counts(d, source: str, prior: str, known: str, digits: bool = True) -> str:
    """The counters of generated lines and the names of those that fail.  ``prior`` and
    ``known`` give texts ``t`` of earlier files and of the merged labels, which are
    counted only."""
    wrong = mismatches(d)
    count = {
        "blank_rows": "trim(text) = ''", "length_mismatch": wrong["line_length"], "length_out_of_range": "length(text) < 5 or length(text) > 160", "ascii_digits": d.like("text", "[0-9]"),
        "latin_letters": d.like("text", "[a-zA-Z]"), "bad_symbols": d.like("text", f"[{ln.within(ln.BAD_SYMBOLS)}]"), "no_devanagari": f"not {d.like('text', '[ऀ-ॿ]')}",
        "digit_mismatch": wrong["has_digit"], "danda_mismatch": wrong["has_danda"], "double_danda_mismatch": wrong["has_double_danda"], "conjunct_mismatch": wrong["has_conjunct"],
    }
    below = " + ".join(f"case when count(*) filter (where contains(text, {coverage.quoted(x)})) < {coverage.THRESHOLD} then 1 else 0 end" for x in coverage.TARGETS)
    rows = f"""select r.*, count(*) over (partition by tidx) as m, p.t is not null as in_prior, k.t is not null as in_known from ({source}) r
      left join (select distinct t from ({prior})) p on r.text = p.t left join (select distinct t from ({known})) k on r.text = k.t"""
    counts = f"""select count(*) as total_rows, count(*) filter (where split = 'train') as train, count(*) filter (where split = 'val') as val, count(*) filter (where split = 'test') as test,
      {', '.join(f'count(*) filter (where {c}) as {k}' for k, c in count.items())}, count(*) - count(distinct line_id) as dup_line_ids, count(*) - count(distinct text) as dup_texts,
      count(*) filter (where in_prior) as cross_file_duplicates, count(*) filter (where in_known) as core_merged_duplicates, count(distinct case when m > {coverage.CAP} then tidx end) as template_cap_exceeded,
      cast({below} as bigint) as coverage_below_threshold, round(avg(case when lower(has_digit) = 'true' then 1.0e0 else 0.0e0 end), 6) as digit_ratio from ({rows})"""
    failing = ["blank_rows", "dup_line_ids", "dup_texts", *list(count)[1:], "template_cap_exceeded", "coverage_below_threshold"]
    ratio = f", case when digit_ratio < {DIGIT_RATIO} then 'digit_ratio_below_80pct' end" if digits else ""
    failures = f"concat_ws(',', {', '.join(f'case when {k} > 0 then {coverage.quoted(k)} end' for k in failing)}{ratio})"
    return f"select *, {failures} as failures, case when {failures} = '' then 'PASS' else 'FAIL' end as verdict from ({counts})"


PLANS = {
    "validate_final": lambda d: row_problems(d, stored(d)),
    "validate_flags": lambda d: f"select count(*) as n, {', '.join(f'count(*) filter (where {x}) as bad_{f}' for f, x in mismatches(d).items())} from ({stored(d)})",
    "validate_core": lambda d: core(d, stored(d)),
    "qa_audit": lambda d: audit(d, audited(d)),
    "manifest_qa": lambda d: manifest(d, manifest_rows(d)),
    "charset_gate": lambda d: charset(d, f"select t from ({ln.labels(d, False)})" if d.kernels else f"select line_id, t from ({ln.labels(d)})", f"select char_id, ch from ({ln._charset(d)})"),
    "coverage_checks": lambda d: coverage_counts(d, generated(d), f"select raw as t from ({coverage.filled(d)})", ln.kept(d)),
}
