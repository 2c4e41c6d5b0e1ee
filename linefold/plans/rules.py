"""Question rows, body ranges, fonts, draws with quotas, manifests and gates."""

from __future__ import annotations

from . import lines as ln
from .images import readability

# Boundaries, interrogatives, endings and allowed single characters.
EDGE = r"[।॥,.;:?!\x27\x22“”‘’()\[\]]"
JUNK = r"[0-9०-९\x27\x22“”‘’`«»\[\](){};:,.\-_|&%€$£₹!/\\]"
QUESTIONS = [
    "के(?:को|ले|मा|बाट|विना|का|भो|के|-के|-केमा)?", "(?:कहाँ|काहाँ)(?:बाट|सम्म|को|नेर)?", "कसर[ीि]", "किन", "कहिले(?:काहीँ|देखि)?", "कति(?:-कति)?",
    "कस्त[ोाी](?:लाई|लाइ|को|ले|सँग|सङ्ग)?", "कुन्?(?:-कुन|कुन|बेला|चीज|कुरा)?", "कता(?:बाट|तिर)?",
    r"को(?:-को)?\s+(?:हौ|हुन्|हन्|छ|थिइन्|थियो|हुन्‌|हन्‌|हुनुहुन्छ|हो|छन्|छौ)", "कस(?:को|लाई|ले|बाट|सँग|सङ्ग|का|की)?", "कस्(?:को|लाई|ले|का|की|लाइ|ले)?", "कसो(?:री)?",
    "किम्", "किं", "कथम्", "कथं", "कुत्र", "कदा", "कुतः", "कियत्", "कः",
]
VERBS = "छ|हो|छैन|होइन|हैन|हुन्|छन्|छौ|हुन्छ|हुनुहुन्छ|थियो|थिइन्|भयो|सकिन्छ|सक्छ|गर्छ|भनुँ|भनूँ|पाउन्न थ्यो|सक्दछ र"
PARTICLES = "र|त|पो"
WITH_KI = "हो|छ|छैन|होइन|हैन|हुन्न|हुँदैन|भयो|सकिएला|होला|थियो|थी|सकिन्छ|सक्छ"
ALONE = ["छ", "त", "र"]
# Words of the fixture that stand for question words and endings.
STAND_IN = {"the": "के", "of": "किन", "la": "कथं", "que": "कुत्र", "der": "छ", "die": "हो", "and": "र"}
# Profiles with their weights in thousandths and difficulties.
PROFILES = {
    "D0_clean_print": (85, "easy"), "D1_light_scan": (100, "easy"), "D2_low_contrast_faded_ink": (80, "easy"), "D3_uneven_background": (70, "easy"),
    "D4_broken_strokes": (50, "medium"), "D5_noisy_archive_scan": (50, "medium"), "D6_blurred_scan": (50, "medium"), "D7_old_paper_texture": (50, "medium"),
    "D8_old_scan_soft": (70, "easy"), "D9_faded_gray_ink": (60, "medium"), "D10_noisy_scan_crop": (40, "medium"), "D11_mild_warped_line": (30, "medium"),
    "D12_dark_thick_scan": (30, "easy"), "D13_washed_out_faint_manuscript": (25, "hard"), "D14_low_dpi_compressed_scan": (35, "medium"), "D15_bleedthrough_archival": (25, "hard"),
    "D16_ink_bleed_spread": (25, "hard"), "D17_local_stain_shadow": (25, "hard"), "D18_fold_crease_damage": (20, "hard"), "D19_weak_shirorekha_dropout": (15, "hard"),
    "D20_partial_erosion_thin_strokes": (15, "hard"), "D21_mixed_manuscript_hard": (20, "hard"), "D22_reverse_showthrough_soft": (15, "hard"), "D23_fragmented_scan_crop": (15, "hard"),
}
BUCKETS = {"easy": 45, "medium": 40, "hard": 15}
FONTS = 12


def questions(d) -> str:
    """Lines with a question mark; a few words stand for interrogatives."""
    mapped = str.maketrans(ln.SRC, ln.DST)
    q = "concat(' ', translate(t, ',', '?'), ' ')"
    for word, by in STAND_IN.items():
        for end in " ?":
            q = f"replace({q}, ' {word.translate(mapped)}{end}', ' {by}{end}')"
    return f"select * from ({d.once(ln.lines(d), q=f'trim({q})')}) where q like '%?%'"


def question_rule(d) -> str:
    """Why a row with a question mark stays or goes.

    A boundary must follow every interrogative, so no look-ahead is needed.
    """
    start, end, tail = rf"(?:^|\s|{EDGE})", rf"(?:\s|$|{EDGE})", rf"\s*\?(?:\s|{EDGE})*$"
    packed = d.replace("q", r"\s+")
    asked = rf"{start}(?:{'|'.join(QUESTIONS)}){end}"
    ending = rf"(?:{start}(?:{VERBS}|{PARTICLES}|की?)|(?:{WITH_KI})की?){tail}"
    before = d.first("q", r"(\S+)\s*\?")
    reason = f"""case when length(q) - length(replace(q, '?', '')) > 1 then 'multiple_question_marks'
      when {d.like(packed, JUNK + r'\?')} or {d.like(packed, r'\?' + JUNK)} then 'adjacent_junk_or_digit_or_quote'
      when length({before}) = 1 and {before} not in ({', '.join(repr(c) for c in ALONE)}) then concat('unclear_preceding_word_', {before})
      when {d.like('q', asked)} then 'matched_question_pattern' when {d.like('q', ending)} then 'matched_ending_pattern' else 'missing_question_indicators' end"""
    return d.once(questions(d), reason=reason)


def manifest(d, labels: str = "", also: str = "", only: tuple[str, ...] = ("font", "profile_no", "score")) -> str:
    """Three variants of each label, with drawn font, profile number and names.  ``labels``
    may bring columns ``also``; draws that are not asked for are not made."""
    variants = d.rows(labels or ln.labels(d), "variant_index", [("1",), ("2",), ("3",)], f"line_id, source_id, domain, split, t, line_length, has_digit, has_danda, has_conjunct, doc_id{also}")
    key = "concat(line_id, '|', cast(variant_index as varchar(2)))"
    draws = {"font": f"{d.draw(chr(39) + 'f' + chr(39), key)} % {FONTS}", "profile_no": f"{d.draw(chr(39) + 'p' + chr(39), key)} % {len(PROFILES)}", "score": f"{d.draw(chr(39) + 's' + chr(39), key)} % 10001 / 100.0e0"}
    return d.once(variants, **{k: draws[k] for k in only})


IMAGE_PATH = "concat(split, '_', line_id, '_f', cast(font as varchar(3)), '_', cast(variant_index as varchar(2)), '.png')"


def images(d, labels: str = "", also: str = "") -> str:
    """The variants with their paths alone."""
    return f"select *, {IMAGE_PATH} as image_path from ({manifest(d, labels, also, ('font',))})"


def by_profile(x: str, pick) -> str:
    return f"case {x} {' '.join(f'when {i} then {pick(name)}' for i, name in enumerate(PROFILES))} end"


def named(d) -> str:
    profile = by_profile("profile_no", lambda name: f"'{name}'")
    difficulty = by_profile("profile_no", lambda name: f"'{PROFILES[name][1]}'")
    return f"select *, {profile} as profile, {difficulty} as difficulty, {IMAGE_PATH} as image_path from ({manifest(d)})"


def profiles(d) -> str:
    """Effective probability of each profile: the bucket's, shared by weight."""
    rows = [(f"'{name}'", str(w), f"'{b}'", f"{BUCKETS[b]}") for name, (w, b) in PROFILES.items()]
    return f"select *, round(0.7e0 * bucket_pct / 100 * weight / sum(weight) over (partition by difficulty), 6) as probability from ({d.rows('select 1 as one', 'profile, weight, difficulty, bucket_pct', rows)})"


def font_division(d) -> str:
    """The first font, counted from the drawn one, that has every character of a line.

    The fixture's font f lacks the code points with value mod 12 equal to f, so what
    matters of a line is the set of its code points mod 12, at most 12 flags.
    """
    chars = d.chars("(" + ln.labels(d) + ")", "line_id")
    lacks = f"select line_id, {', '.join(f'max(case when {d.codepoint(chr(99) + chr(104))} % {FONTS} = {f} then 1 else 0 end) as l{f}' for f in range(FONTS))} from ({chars}) where ch not in (' ', '‌', '‍') group by line_id"
    tried = d.rows(f"select *, {d.draw(chr(39) + 'f' + chr(39), 'line_id')} % {FONTS} as wanted from ({lacks})", "font, lack", [(str(f), f"l{f}") for f in range(FONTS)], "line_id, wanted")
    best = f"min(case when lack = 0 then (font - wanted + {FONTS}) % {FONTS} end)"
    return f"select line_id, (wanted + step) % {FONTS} as font, step is null as missing, coalesce(step > 0, false) as fallback from (select line_id, wanted, {best} as step from ({tried}) group by line_id, wanted)"


def top_up(d, pool: str, target: str, order: str = "42") -> str:
    """``target`` picks of a pool in hash order, in rounds when it is too small.

    Row k of n is taken once for each round r with k + r * n <= target.
    """
    ranked = d.hash_rank(f"select line_id, domain from ({pool})", "domain", order)
    return f"select line_id, domain, cast(({target} - k - ({target} - k) % n) / n as bigint) + 1 as times from ({ranked}) where k <= {target}"


# Where the body of a file begins and ends, by kind of book.  ``start``: markers of the first
# line, ``before``: lines kept before it, ``title``: a line up to five before it that is
# kept too, ``after``: markers that must come first, ``otherwise``: the least line number
# where these are absent; ``end``: markers of the last line, ``last``: whether the last
# such line counts and stays, else the first one more than a thousand lines on, which goes.
BODIES = {
    "chronicle": {"start": ["श्रीणणेशाय नमः", "श्रीगणेशाय नमः"], "title": "भाषावंशावली"},
    "essays": {"start": ["डा. जगदीश चन्द्र रेग्मी"], "before": 3, "end": ["धन्यवाद ज्ञापन गर्दछु"], "last": True},
    "genealogy": {"start": ["नमो गोरङ्गकालीम्याम्‌"], "end": ["समाप्त भयो"], "last": True},
    "history": {
        "start": ["नेपालको इतिहासका स्रोतहरू", "नेपालको इतिहास"], "after": ["सहायक ग्रन्थस्‌ची", "सहायक ग्रन्थसूची"], "otherwise": ("नेपालको इतिहासका स्रोतहरू", 100), "end": ["सहायक ग्रन्थ", "सहायक ग्रन्थहरूको सूची", "सहायक ग्रन्थहरूको स्‌ची"],
    },
}
#: The same rules with the fixture's letters, for files by their number.
FIXTURE_BODIES = {"0": {"start": ["क"], "title": "ज"}, "1": {"start": ["क"], "before": 3, "end": ["म"], "last": True}, "2": {"start": ["जा"], "end": ["ख"], "last": True}, "3": {"start": ["ज", "फ"], "after": ["व"], "otherwise": ("ज", 2), "end": ["प"]}}


def body_ranges(d, source: str, bodies: dict) -> str:
    """The body of each file, [start_at, end_at), from rows (doc_id, kind, line_no, t).

    A file of another kind, or without the markers, is kept whole.
    """
    has = lambda words: "(" + (" or ".join(f"contains(t, '{w}')" for w in words) or "1 = 0") + ")"
    pick = lambda of: "case kind " + " ".join(f"when '{f}' then {of(r)}" for f, r in bodies.items()) + " end"
    first = lambda c: f"min(case when {c} then line_no end) over (partition by doc_id)"
    plain, toc = lambda r: "after" not in r, lambda r: "after" in r
    a = f"""select *, max(line_no) over (partition by doc_id) + 1 as n, {first(pick(lambda r: has(r['start']) if plain(r) else '1 = 0'))} as found,
      {first(pick(lambda r: has(r.get('after', []))))} as toc, {first(pick(lambda r: f"contains(t, '{r['otherwise'][0]}') and line_no > {r['otherwise'][1]}" if 'otherwise' in r else '1 = 0'))} as otherwise from ({source})"""
    back, beyond = pick(lambda r: f"contains(t, '{r['title']}')" if r.get("title") else "1 = 0"), pick(lambda r: has(r["start"]) if toc(r) else "1 = 0")
    b = f"""select *, {first(f'line_no >= found - 5 and line_no < found and ({back})')} as title, {first(f'line_no > toc and ({beyond})')} as next from ({a})"""
    start = f"coalesce(title, case when found is not null then greatest(0, found - ({pick(lambda r: r.get('before', 0))})) end, case when toc is null then otherwise else next end, 0)"
    c = f"select *, {start} as start_at from ({b})"
    ends = lambda last: pick(lambda r: has(r.get("end", [])) if bool(r.get("last")) == last else "1 = 0")
    return f"""select doc_id, kind, min(start_at) as start_at, coalesce(max(case when line_no > start_at and ({ends(True)}) then line_no end) + 1,
      min(case when line_no > start_at + 1000 and ({ends(False)}) then line_no end), max(n)) as end_at from ({c}) group by doc_id, kind"""


def fixture_files(d) -> str:
    return f"select doc_id, cast(doc_id % 4 as varchar(1)) as kind, line_no, t from ({ln.lines(d)}) where piece_no = 0"


WORKERS = 8


def chunk_rows(d) -> str:
    """Documents in order with the size of a chunk: as many chunks as workers, at most."""
    total = f"((select count(*) from documents where doc_id is not null) + {WORKERS - 1})"
    rows = d.running("select doc_id, 'all' as everything from documents where doc_id is not null", "everything", "doc_id")
    return f"select k, cast(({total} - {total} % {WORKERS}) / {WORKERS} as bigint) as size from ({rows})"


def twelve(d) -> str:
    """Twelve rows for a sheet: the first of each profile in order, then other rows."""
    first = f"select profile, line_id, variant_index, 0 as filler from ({d.earliest(named(d), 'profile', 'line_id, variant_index')})"
    rest = f"select profile, line_id, variant_index, 1 as filler from ({named(d)})"
    kept = d.earliest(f"{first} union all {rest}", "line_id, variant_index", "filler, profile")
    return f"select line_id, variant_index, profile, filler from ({kept}) order by filler, profile, line_id, variant_index limit 12"


QUOTA = "case domain when 'en' then 7500 when 'fr' then 7500 when 'de' then 5000 else 2500 end"
SUMMARY = "count(*) as n, round(avg(score), 6) as avg_score, count(*) filter (where score < 35) as low, count(*) filter (where score between 35 and 68) as borderline"


PLANS = {
    "question_rule": lambda d: f"select {ln.KEY}, q, reason, reason like 'matched%' as kept from ({question_rule(d)})",
    "question_reasons": lambda d: f"select reason, count(*) as n from ({question_rule(d)}) group by reason",
    "body_range": lambda d: f"select doc_id, start_at as first_line, end_at as end_line from ({body_ranges(d, fixture_files(d), FIXTURE_BODIES)})",
    "image_names": lambda d: f"select line_id, variant_index, image_path from ({images(d) if d.kernels else named(d)})",
    "degradation_level": lambda d: f"select profile, difficulty, cast({d.first('profile', '^D([0-9]+)_')} as int) as level, count(*) as n from ({named(d)}) group by profile, difficulty",
    "profile_probs": profiles,
    "profile_summary": lambda d: f"select profile, {SUMMARY} from ({named(d)}) group by profile",
    "difficulty_summary": lambda d: f"with s as (select difficulty, {SUMMARY} from ({named(d)}) group by difficulty), b as ({d.rows('select 1 as one', 'bucket', [(repr(b),) for b in BUCKETS])}) select bucket, coalesce(n, 0) as n, coalesce(avg_score, 100) as avg_score from b left join s on bucket = difficulty",
    "qa_grouping_sets": lambda d: f"select profile, difficulty, {SUMMARY} from ({named(d)}) group by grouping sets ((), (profile), (difficulty))",
    "dist_font": lambda d: f"select font, count(*) as n from ({named(d)}) group by font",
    "dist_variant": lambda d: f"select variant_index, split, count(*) as n from ({named(d)}) group by variant_index, split order by variant_index",
    "row_filters": lambda d: f"select line_id, variant_index, case when has_digit then 'digit' when score between 35 and 68 then 'borderline' else 'conjunct' end as taken_as from ({named(d)}) where split = 'train' and (has_digit or has_conjunct or score between 35 and 68)",
    "flag_cascade": lambda d: f"select l.line_id, coalesce(nullif(trim(case when l.has_digit then '' else 'false' end), ''), cast(h.quality as varchar(9)), 'computed') as flag from ({ln.labels(d)}) l left join (select doc_id, max(quality) as quality from labels group by doc_id) h on l.doc_id = h.doc_id",
    "charset_order": lambda d: f"select char_id, ch from ({ln._charset(d)}) order by char_id",
    "font_division": font_division,
    "topup_sample": lambda d: top_up(d, ln.labels(d), "5000"),
    "quota_mix": lambda d: top_up(d, ln.labels(d), QUOTA, "9999"),
    "gap_fill": lambda d: f"select line_id, times from ({top_up(d, f'select line_id, {chr(39)}all{chr(39)} as domain from ({ln.labels(d)})', '100000', '8888')}) where times > 1",
    "smoke_sample": lambda d: f"select line_id, split, cast((k - 1 - (k - 1) % 5) / 5 as bigint) as forced from (select line_id, split, row_number() over (partition by split order by md5(concat('42|', line_id)), line_id) as k from ({ln.labels(d)})) where k <= 200 and k <= case split when 'train' then 200 else 50 end",
    "per_profile_rep": lambda d: f"select profile, line_id, variant_index from ({d.earliest(named(d), 'profile', 'line_id, variant_index')})",
    "twelve_samples": twelve,
    "chunking": lambda d: f"select chunk, min(k) - 1 as start_at, count(*) as n from (select k, cast((k - 1 - (k - 1) % size) / size as bigint) as chunk from ({chunk_rows(d)})) group by chunk",
    "skip_examples": lambda d: f"select reason, t from (select reason, t, row_number() over (partition by reason order by {ln.KEY}) as k from ({d.earliest(f'select * from ({ln.first_pass(d)}) where reason <> {chr(39)}keep{chr(39)}', 'reason, t', ln.KEY)})) where k <= 20",
    "check_all": lambda d: f"select count(*) as n, count(*) filter (where score < 10) as risky, min(score) as min_score, max(score) as max_score from ({readability(d)})",
    "params_json": lambda d: "select event_id, " + d.object_of(k=f"cast({d.json('props', '$.k')} as bigint)", event="event_type") + " as params from events",
    "split_text_head": lambda d: f"select {ln.KEY}, case when length(t) > 40 then concat(substr(t, 1, 40), '…') else t end as head from ({ln.lines(d)})",
}
