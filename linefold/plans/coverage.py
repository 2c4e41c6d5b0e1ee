"""Template generation steered by coverage: filling, the space of a bank, targets,
exclusion, generation under caps, and its checks.

A bank is a list of (template, {slot: options}); each occurrence of a slot is filled
on its own.  The space of a bank is enumerated, so it must be of a size one would
enumerate; the number of lines, caps and thresholds are parameters.
"""

from __future__ import annotations

import re
from math import prod

from . import lines as ln

# A small bank in the fixture's script; callers give their own.
YEARS = ["१९९०", "२००७", "२०१५", "२०४६", "२०६२", "२०७२"]
NAMES = ["सीता", "रमेश", "कृष्ण", "पार्वती", "विष्णु"]
PLACES = ["काठमाडौं", "पोखरा", "जनकपुर", "धनकुटा"]
NUMBERS = ["५", "१२", "३४", "८९", "१०८", "६५०"]
BANK = [
    ("वि. सं {year} देखि {year} सम्म {name} {place}मा बसे।", {"year": YEARS, "name": NAMES, "place": PLACES}),
    ("{name} ले {number} रुपैयाँ {place} पठाए।", {"name": NAMES, "number": NUMBERS, "place": PLACES}),
    ("{place}बाट {name} र {name} आए॥", {"name": NAMES, "place": PLACES}),
    ("{number} जना मानिस {year} सालमा {place} पुगे।", {"number": NUMBERS, "year": YEARS, "place": PLACES}),
    ("कृपया {name}लाई बोलाउनुहोस्।", {"name": NAMES}),
    ("{year}", {"year": YEARS[:2]}),
]
TARGETS = ["ृ", "ै", "ु", "ं", "्", "॥", "८", "०"]
#: Lines wanted, share of one template, lines that each target should have.
WANTED, SHARE, THRESHOLD = 300, 0.20, 40
CAP = int(WANTED * SHARE)
SLOT = re.compile(r"\{(\w+)\}")


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def swapped(d, t: str = "t") -> str:
    """The text with the years of its first range in order, compared as strings."""
    pattern = r"वि\. सं (\S+) देखि (\S+) सम्म"
    whole, low, high = (d.first(t, pattern, g) for g in range(3))
    return f"""case when {low} > {high} then concat(substr({t}, 1, instr({t}, {whole}) - 1), 'वि. सं ', {high}, ' देखि ', {low}, ' सम्म',
      substr({t}, instr({t}, {whole}) + length({whole}))) else {t} end"""


def pieces(template: str, slots: dict[str, list[str]]) -> tuple[list[str], list[list[str]]]:
    """The fixed texts around the slots, and the options of each occurrence.  A brace
    whose name is no slot is text."""
    fixed, options, at = [], [], 0
    for m in SLOT.finditer(template):
        if m[1] in slots:
            fixed.append(template[at : m.start()])
            options.append(slots[m[1]])
            at = m.end()
    return [*fixed, template[at:]], options


def woven(fixed: list[str], filled: list[str]) -> str:
    parts = [quoted(fixed[0])]
    for f, x in zip(fixed[1:], filled):
        parts += [x, quoted(f)]
    return f"concat({', '.join(parts)})"


def drawn(d, key: str, bank: list) -> str:
    """One filled template for each key, template and options by digests of the key."""
    def one(i: int) -> str:
        fixed, options = pieces(*bank[i])
        pick = [f"case {d.draw(quoted(f'o{i}.{j}'), key)} % {len(o)} {' '.join(f'when {n} then {quoted(v)}' for n, v in enumerate(o))} end" for j, o in enumerate(options)]
        return woven(fixed, pick)

    return f"case tidx {' '.join(f'when {i} then {one(i)}' for i in range(len(bank)))} end"


def filled(d, bank: list = BANK) -> str:
    key = "cast(doc_id as varchar(20))"
    source = d.once("select doc_id from documents where doc_id is not null", tidx=f"{d.draw(quoted('t'), key)} % {len(bank)}")
    return d.once(source, raw=drawn(d, key, bank))


def space(d, bank: list = BANK) -> str:
    """Every filling of every template."""
    parts = []
    for i, (template, slots) in enumerate(bank):
        fixed, options = pieces(template, slots)
        source = f"select {i} as tidx"
        for j, o in enumerate(options):
            source = d.each(source, f"s{j}", [quoted(v) for v in o])
        parts.append(f"select tidx, {woven(fixed, [f's{j}' for j in range(len(options))])} as raw from ({source})")
    return f"select tidx, raw, {swapped(d, 'raw')} as t from ({' union all '.join(parts)})"


def space_size(bank: list = BANK) -> int:
    return sum(prod(map(len, pieces(*b)[1])) for b in bank)


def sources_of(d, bank: list = BANK, targets: list[str] = TARGETS) -> str:
    """Which templates can give which target: by the template or any of its options."""
    bodies = [(str(i), quoted(" ".join([t, *(o for options in s.values() for o in options)]))) for i, (t, s) in enumerate(bank)]
    return f"select target, tidx from ({d.each(d.rows('select 1 as one', 'tidx, body', bodies), 'target', [quoted(t) for t in targets])}) where contains(body, target)"


def valid(t: str, d) -> str:
    return f"(trim({t}) <> '' and length({t}) between 5 and 160 and not {d.like(t, '[0-9a-zA-Z_|&%€$£₹«»]')} and {d.like(t, '[ऀ-ॿ]')})"


def fresh(d) -> str:
    """Valid fillings, each text once (of the first template), that no label has."""
    first = d.earliest(f"select tidx, t from ({space(d)}) where {valid('t', d)}", "t", "tidx")
    return f"select c.tidx, c.t from ({first}) c left join (select t as known from ({ln.kept(d)})) k on c.t = k.known where k.known is null"


def generated(d) -> str:
    """Lines in digest order: first those that bring each target to its threshold, at
    most ``CAP`` of a template, ``WANTED`` in all.

    The empty target is in every text and keeps those of no target.  The cap counts a template's needed lines first, so it may leave a target below
    its threshold; ``coverage_qa`` says so.
    """
    reach = d.each(f"select tidx, t, md5(concat('42|', t)) as h from ({fresh(d)})", "target", ["''", *(quoted(t) for t in TARGETS)])
    ranked = f"select *, row_number() over (partition by target order by h, t) as r from ({reach}) where contains(t, target)"
    capped = f"select tidx, t, h, max(case when target <> '' and r <= {THRESHOLD} then 1 else 0 end) = 1 as needed from ({ranked}) group by tidx, t, h"
    return f"""select tidx, t, needed from (select tidx, t, needed, h, row_number() over (order by needed desc, h, t) as k from (
      select *, row_number() over (partition by tidx order by needed desc, h, t) as k_of_template from ({capped})) where k_of_template <= {CAP}) where k <= {WANTED}"""


def checks(d) -> str:
    """The counters of generated lines and the verdict."""
    below = " + ".join(f"case when count(*) filter (where contains(t, {quoted(x)})) < {THRESHOLD} then 1 else 0 end" for x in TARGETS)
    counts = f"""select count(*) as n, count(*) filter (where trim(t) = '') as blank, count(*) - count(distinct t) as duplicate_texts,
      count(*) filter (where length(t) < 5 or length(t) > 160) as length_out_of_range, count(*) filter (where {d.like('t', '[0-9]')}) as ascii_digits,
      count(*) filter (where {d.like('t', '[a-zA-Z]')}) as latin_letters, count(*) filter (where {d.like('t', '[_|&%€$£₹«»]')}) as bad_symbols,
      count(*) filter (where not {d.like('t', '[ऀ-ॿ]')}) as no_devanagari, cast({below} as bigint) as targets_below, count(distinct case when m > {CAP} then tidx end) as templates_over_cap
      from (select *, count(*) over (partition by tidx) as m from ({generated(d)}))"""
    total = "blank + duplicate_texts + length_out_of_range + ascii_digits + latin_letters + bad_symbols + no_devanagari + targets_below + templates_over_cap"
    return f"select *, case when {total} = 0 then 'PASS' else 'FAIL' end as verdict from ({counts})"


PLANS = {
    "template_fill": lambda d: f"select doc_id, tidx, raw from ({filled(d)})",
    "range_swap": lambda d: f"select doc_id, raw, {swapped(d, 'raw')} as t from ({filled(d)})",
    "template_targets": sources_of,
    "template_space": space,
    "gen_exclude": fresh,
    "coverage_generate": generated,
    "template_usage": lambda d: f"select tidx, count(*) as n, count(*) > {CAP} as over_cap from ({generated(d)}) group by tidx",
    "coverage_qa": checks,
}
