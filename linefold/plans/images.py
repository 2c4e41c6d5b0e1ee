"""Pixel measures, sizes, batches and image metadata.

The pixel fixture takes an embedding as an 8 by 8 gray image.
"""

from __future__ import annotations


def pixels(d) -> str:
    value = "greatest(0, least(255, cast(floor(160 + 50 * (1 + vec_id % 8) * cast(x as double)) as int)))"
    explode = "select vec_id, x from embeddings lateral view explode(embedding) as x" if d.name == "spark" else "select vec_id, unnest(embedding) as x from embeddings"
    return f"select vec_id, {value} as v from ({explode})"


def measures(d) -> str:
    """Mean and deviation of all, foreground (< 160) and background pixels."""
    return f"""select vec_id, coalesce(avg(case when v < 160 then v end), 0) as fg, coalesce(avg(case when v >= 160 then v end), 255) as bg,
      avg(v) as mean, stddev_pop(v) as sd, count(*) filter (where v < 160) as n_fg, count(*) as n from ({pixels(d)}) group by vec_id"""


HEIGHT = "8 * (1 + vec_id % 4)"


def readability(d) -> str:
    """Score and risk; the fixture's image is drawn 1 to 4 times as large, which changes
    no other measure than the height."""
    return f"""select vec_id, contrast, sd, round(least(100, greatest(0, least(80, contrast / 150 * 80) + least(20, sd / 50 * 20))), 2) as score,
      contrast < 35 or sd < 10 or {HEIGHT} < 20 as risk, mean, n_fg, n from (select *, bg - fg as contrast from ({measures(d)}))"""


def continuity(d) -> str:
    """Of each image and its faded copy: the copy's score, and its ink as a share of the
    image's (1 where that has none)."""
    faded = f"select vec_id, v as clean, cast(floor(60 + v / 255.0e0 * (240 - 60)) as int) as v from ({pixels(d)})"
    sums = f"""select vec_id, coalesce(avg(case when v < 160 then v end), 0) as fg, coalesce(avg(case when v >= 160 then v end), 255) as bg, stddev_pop(v) as sd,
      count(*) filter (where v < 160) as ink, count(*) filter (where clean < 160) as clean_ink from ({faded}) group by vec_id"""
    score = "least(100, greatest(0, least(80, (bg - fg) / 150 * 80) + least(20, sd / 50 * 20)))"
    return f"select vec_id, round({score}, 6) as score, round(case when clean_ink = 0 then 1.0e0 else 1.0e0 * ink / clean_ink end, 6) as continuity from ({sums})"


def sizes() -> str:
    return "select doc_id, n_chars as w, 40 + doc_id % 100 as h from documents where doc_id is not null"


PLANS = {
    "readability": lambda d: f"select vec_id, round(contrast, 6) as contrast, round(sd, 6) as sd, score, risk from ({readability(d)})",
    "image_qa": lambda d: f"""select vec_id, case when sd < 1.5 or mean > 252 or n_fg < 0.0002 * n then 'blank_image' when contrast < 45 then 'low_contrast' when risk then 'unreadable_risk' else 'passed' end as verdict from ({readability(d)})""",
    "image_qa_counts": lambda d: f"select risk, count(*) as n, round(avg(score), 6) as avg_score, min(score) as min_score, max(score) as max_score from ({readability(d)}) group by risk",
    "gray_fade": lambda d: f"select vec_id, cast(sum(cast(floor(60 + v / 255.0e0 * (240 - 60)) as int)) as bigint) as faded from ({pixels(d)}) group by vec_id",
    "attempt_blend": lambda d: f"select vec_id, cast(sum(cast(floor(0.4e0 * v + 0.6e0 * (60 + v / 255.0e0 * 180)) as int)) as bigint) as blended from ({pixels(d)}) group by vec_id",
    "pixel_scale": lambda d: f"select vec_id, round(sum(v / 255.0e0), 6) as total, round(sum(1 - v / 255.0e0), 6) as inverted from ({pixels(d)}) group by vec_id",
    "continuity": continuity,
    "resize_dims": lambda d: f"select doc_id, greatest(1, cast({d.half_even('w * 64.0e0 / h', 0)} as bigint)) as new_w, 64 as new_h from ({sizes()})",
    "width_cap": lambda d: f"select doc_id, w, w > 2000 as too_wide from ({sizes()})",
    "dimension_bounds": lambda d: f"select doc_id, case when h < 15 or h > 250 then 'unusual_height' when w < 30 or w > 4000 then 'unusual_width' else 'ok' end as verdict from ({sizes()})",
    "dim_stats": lambda d: f"select min(w) as min_w, max(w) as max_w, round(avg(w), 6) as avg_w, min(h) as min_h, max(h) as max_h, round(avg(h), 6) as avg_h from ({sizes()})",
    "batch_pad": lambda d: f"select doc_id, batch, max(w) over (partition by batch) - w as pad from (select *, cast(floor(doc_id / 16.0e0) as bigint) as batch from ({sizes()}))",
    "path_prefix": lambda d: "select page_id, case when url like 'http%' then url else concat('https://', url) end as prefixed from pages",
    "dist_role": lambda d: "select role, count(*) as n, min(turn) as first_turn, max(turn) as last_turn from conversations group by role",
}
