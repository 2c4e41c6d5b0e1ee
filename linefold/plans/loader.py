"""What training reads: decoded labels, batches, gates, sheets and composed draws."""

from __future__ import annotations

from . import lines as ln
from .images import sizes
from .rules import named

HEIGHT, MAX_WIDTH, MAX_LABEL, BATCH = 64, 2000, 120, 16
# The five stages of a composed degradation; an empty name is no effect.
STAGES = {
    "substrate": ["illumination", "texture", "stains", "bleedthrough", "showthrough", ""],
    "ink": ["fade", "thin", "thick", "broken", "shirorekha", "bleed", ""],
    "scan": ["downsample", "blur", "streaks", ""],
    "damage": ["pepper", "wormholes", "crease", "", "", ""],
    "geometry": ["affine", "warp", "", ""],
}
HARD = {"bleedthrough", "showthrough", "shirorekha", "broken", "wormholes", "crease", "warp"}
TRIES = 50


def part(d, h: str, stage: int) -> str:
    return f"({d.hex_part(h, 1 + 6 * stage)} % {len(list(STAGES.values())[stage])})"


def difficulty(d, h: str) -> str:
    """Of a digest's five draws: hard with a hard effect among three or more, medium
    with two or more, else easy."""
    active, hard = [], []
    for i, names in enumerate(STAGES.values()):
        active.append(f"case when {part(d, h, i)} < {names.index('')} then 1 else 0 end")
        places = [str(k) for k, n in enumerate(names) if n in HARD]
        if places:
            hard.append(f"{part(d, h, i)} in ({', '.join(places)})")
    n = f"({' + '.join(active)})"
    return f"case when ({' or '.join(hard)}) and {n} >= 3 then 'hard' when {n} >= 2 then 'medium' else 'easy' end"


def composed(d) -> str:
    """Each label's drawn target and the first of ``TRIES`` draws that meets it, else
    the last draw.  The effects decide the difficulty, so no pixel is needed, and the
    search stays within the row."""
    target = d.once(ln.labels(d), u=f"{d.draw(repr('d'), 'line_id')} % 100")
    target = d.once(target, wanted="case when u < 45 then 'easy' when u < 85 then 'medium' else 'hard' end")
    if d.kernels:
        return f"select * from {d.kernel('first_draws', f'select line_id, wanted from ({target})')}"
    tried = d.once(target, hit=d.first_try("line_id", TRIES, lambda h: f"{difficulty(d, h)} = wanted"))
    return d.once(tried, h=f"md5(concat(line_id, '|', cast(coalesce(hit, {TRIES - 1}) as varchar(3))))")


def stage_name(d, i: int) -> str:
    names = list(STAGES.values())[i]
    return f"case {part(d, 'h', i)} {' '.join(f'when {k} then {n!r}' for k, n in enumerate(names) if n)} else 'none' end"


def sheet(d, cols: int, cell_w: int, cell_h: int, margin: int, label: int) -> str:
    """Place and size of each image on a sheet of cells: as large as fits, centred."""
    w, h = cell_w - 2 * margin, cell_h - label - 2 * margin
    scaled = f"""select doc_id, doc_id % {cols} as col, cast(floor(doc_id / {cols}.0e0) as bigint) as row_no, cast(floor(w * least({w}.0e0 / w, {h}.0e0 / h)) as bigint) as new_w,
      cast(floor(h * least({w}.0e0 / w, {h}.0e0 / h)) as bigint) as new_h from ({sizes()}) where w > 0"""
    half = lambda x: f"cast(floor(({x}) / 2.0e0) as bigint)"
    return f"select doc_id, row_no, col, new_w, new_h, col * {cell_w} + {half(f'{cell_w} - new_w')} as x, row_no * {cell_h} + {margin} + {half(f'{h} - new_h')} as y from ({scaled})"


def render_failures(d) -> str:
    """The first failed check of a rendered image.

    In the fixture each of 8 by 8 cells is 4 pixels wide inside a margin of
    vec_id % 3 pixels, a cell is ink where x < 0, and each 17th image lacks a glyph.
    """
    box = f"""select vec_id, min(case when x < 0 then pos % 8 end) as c0, max(case when x < 0 then pos % 8 end) as c1, min(case when x < 0 then pos - pos % 8 end) / 8 as r0,
      max(case when x < 0 then pos - pos % 8 end) / 8 as r1 from ({d.cells('embeddings', 'vec_id', 'embedding')}) group by vec_id"""
    edge = "vec_id % 3 = 0 and (c0 = 0 or r0 = 0 or c1 = 7 or r1 = 7)"
    return f"""select v.vec_id, case when v.vec_id % 17 = 0 then 'tofu_missing_glyphs' when c0 is null then 'blank_image' when c1 = c0 or r1 = r0 then 'unreadably_small_output'
      when {edge.replace('vec_id', 'v.vec_id')} then 'clipped_text' else 'ok' end as reason from (select vec_id from embeddings) v left join ({box}) b on v.vec_id = b.vec_id"""


def gate(d) -> str:
    """Counters of the loader's check over all labels, and its verdict; long labels and
    wide images only warn."""
    width = f"greatest(1, cast({d.half_even(f'24.0e0 * line_length * {HEIGHT} / 96', 0)} as bigint))"
    labels = f"""select count(*) as n, count(*) filter (where line_length = 0) as empty_labels, count(*) filter (where line_length > {MAX_LABEL}) as long_labels,
      count(*) filter (where {width} > {MAX_WIDTH}) as wide, min({width}) as min_width, max({width}) as max_width from ({ln.labels(d)})"""
    wrong = f"select count(*) filter (where not same) as w from ({d.decoded(ln.labels(d), ln._charset(d))})"
    finite = f"select count(*) filter (where isnan(x) or isinf(x)) as bad from (select cast(x as double) as x from ({d.cells('embeddings', 'vec_id', 'embedding')}))".replace("isinf(x)", "abs(x) > 1.7976931348623157e308")
    return f"""select n, empty_labels, long_labels, wide, min_width, max_width, w as decode_mismatches, bad as not_finite,
      case when empty_labels + w + bad = 0 and n > 0 then 'PASS' else 'FAIL' end as verdict from ({labels}) join ({wrong}) on 1 = 1 join ({finite}) on 1 = 1"""


def batches(d) -> str:
    """Consecutive labels of a source in batches: the ids in order, as one list, the
    lengths, and the total.  A batch never holds more than ``BATCH`` labels."""
    number = f"(cast({d.first('line_id', '_([0-9]+)$')} as bigint) - 1)"
    numbered = f"select line_id, ids, label_length, {d.first('line_id', '^(.*)_[0-9]+$')} as source_id, cast(({number} - {number} % {BATCH}) / {BATCH} as bigint) as batch from ({d.encoded(ln.labels(d), ln._charset(d))})"
    return f"select source_id, batch, {d.joined('ids', 'line_id')} as ids, {d.joined('cast(label_length as varchar(9))', 'line_id')} as label_lengths, cast(sum(label_length) as bigint) as total from ({numbered}) group by source_id, batch"


PLANS = {
    "decode_ids": lambda d: d.from_ids(ln.labels(d), ln._charset(d)),
    "batch_labels": batches,
    "loader_gate": gate,
    "render_fail": render_failures,
    "contact_sheet": lambda d: sheet(d, 3, 600, 140, 10, 35),
    "sample_grid": lambda d: sheet(d, 4, 400, 60, 6, 0),
    "composed_difficulty": lambda d: f"select line_id, wanted, coalesce(hit, {TRIES - 1}) as attempt, {difficulty(d, 'h')} as difficulty, {', '.join(f'{stage_name(d, i)} as {s}' for i, s in enumerate(STAGES))} from ({composed(d)})",
    "map_core_meta": lambda d: f"""select image_path, line_id, t as rendered, t as original, domain, split, concat('font_', cast(font as varchar(3))) as font_name, profile as degradation_profile, difficulty as difficulty_bucket,
      'core' as generation_round, 95.0e0 as readability_score, false as unreadable_risk from ({named(d)}) where variant_index = 1""",
    "head_dups": lambda d: f"select * from ({ln.PLANS['dup_pairs'](d)}) order by {ln.KEY} limit 20",
}
