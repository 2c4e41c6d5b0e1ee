"""Odd rows and tables, and brute-force versions of what SQL cannot express."""

import hashlib
import itertools
import random
import unicodedata
from urllib.parse import urlsplit

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import EDGE, corpus, docs

from linefold.llm import bpe, common, langid, lm, secrets, shards, simhash, spotsigs, warc, wrapper

SF = "/root/testdata/sf0.01"


def odd_rows(texts):
    """Ids that are missing, repeated or in no order."""
    return [((None, i, i // 3)[i % 3], t) for i, t in enumerate(texts)]


def test_spotsigs_with_null_and_repeated_ids(spark):
    rows = odd_rows(EDGE[:-2] + corpus(40) + ["same text here"] * 5)
    random.Random(1).shuffle(rows)
    got = spotsigs.with_edited(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    want = []
    for i, (d, t) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1]
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        a, b, c = (set(spotsigs.signatures(x).tolist()) for x in (t, edited, nxt))
        same = lambda x, y: round(len(x & y) / len(x | y), 9) if x | y else 1.0
        want.append((d is None, d or 0, len(t), hashlib.sha256(edited.encode()).hexdigest(), same(a, b), same(a, c)))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == sorted(want)


def test_bounds_below(spark):
    rng = random.Random(2)
    for n in (0, 1, 2, 7, 30):
        bounds = sorted(rng.sample(range(-50, 50), n))
        xs = [-60, *range(-51, 52), 60]
        got = spark.createDataFrame([(x,) for x in xs], "x long").select(spotsigs._smaller(bounds, F.col("x")).alias("n")).collect()
        assert [r.n for r in got] == [sum(b < x for b in bounds) for x in xs]


def test_spotsigs_flags_agree_with_the_measures(spark):
    texts = corpus(40) + [t + " tail" for t in corpus(40)] + EDGE
    for r in spotsigs.with_edited(docs(spark, texts)).collect():
        assert (r.edited_is_near, r.next_is_near) == (r.near_edited >= spotsigs.TAU, r.near_next >= spotsigs.TAU)
        assert r.length_part == spotsigs.partition_of(len(r.fingerprint) // 8, spotsigs.TAU)


def test_spotsigs_large_group_of_near_copies(spark):
    rng = random.Random(12)
    base = [f"the word{i} thing{i}" for i in range(60)]
    texts = corpus(20) + [" ".join([*base[:k], f"the odd{k} item{k}", *base[k + 1 :]]) for k in (rng.randrange(60) for _ in range(150))] + [" ".join(base[:30] + [f"the far{j} away{j}" for j in range(30)])]
    sets = [set(spotsigs.signatures(t).tolist()) for t in texts]
    label = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        if label[i] != label[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            old, new = max(label[i], label[j]), min(label[i], label[j])
            label = [new if x == old else x for x in label]
    assert [r[1] for r in spotsigs.near_duplicates(docs(spark, texts)).orderBy("doc_id").collect()] == label
    assert len(set(label[20:170])) == 1 and label[170] == 170


def test_language_by_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit_documents(table)
    lengths = np.linalg.norm(model.centroids, axis=1)
    assert np.allclose(lengths, 1, atol=1e-4) and max(map(model.languages.count, model.languages)) <= langid.CENTROIDS

    def brute(text):
        letters = [c if unicodedata.category(c)[0] in "LM" else " " for c in (text or "").lower()]
        if not "".join(letters).strip():
            return "und", 0.0
        words = f" {' '.join(''.join(letters).split())} "
        words = (" " if letters[0] == " " else "") + words + (" " if letters[-1] == " " else "")
        counts = np.zeros(langid.DIM)
        for n in (1, 2, 3):
            for i in range(len(words) - n + 1):
                code = ord(words[i]) * 0x9E3779B1 & 0xFFFFFFFF
                for c in words[i + 1 : i + n]:
                    code = (code * 0x01000193 + (ord(c) * 0x9E3779B1 & 0xFFFFFFFF)) & 0xFFFFFFFF
                counts[((code ^ code >> 15) * 0x85EBCA6B & 0xFFFFFFFF) >> 20] += 1
        x = np.log1p(counts) * model.idf
        cosine = model.centroids @ x / np.linalg.norm(x)
        return model.languages[int(cosine.argmax())], float(cosine.max())

    texts = [r.text for r in table.orderBy("doc_id").limit(60).collect()] + [t for t in EDGE if t is None or len(t) < 100] + ["ÀÉ, ñ—ß 12 中文 क्षि"]
    for t, (lang, score, _) in zip(texts, model.predict(texts)):
        want = brute(t)
        assert score == pytest.approx(want[1], abs=1e-4) and (lang == want[0] or want[1] == 0)
    held = langid.query(spark, SF).where("held_out").join(table.select("doc_id", "lang"), "doc_id").where("lang is not null and lang_pred <> 'und'")
    right, n = held.selectExpr("sum(int(lang = lang_pred))", "count(*)").first()
    assert n > 150 and right >= 0.97 * n


def test_simhash_with_null_ids(spark):
    rows = odd_rows(corpus(30)) + [(None, "a copy of it"), (900, "a copy of it"), (901, "a copy of it"), (None, None), (None, "")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(got) == len(rows)
    of = {}
    for r in got:
        of.setdefault(r.fp, set()).add(r.component_id)
    assert all(len(x) == 1 for x in of.values())
    assert [r.component_id for r in got if r.fp == 0] == [None, None]
    assert {r.component_id for r in got if r.doc_id in (900, 901)} == {900}


def test_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    path, pattern = bpe.tokenizer()
    assert bpe.encode(empty, path, pattern).count() == 0 and bpe.decode(bpe.encode(empty, path, pattern), path).count() == 0
    assert spotsigs.near_duplicates(empty).count() == 0 and spotsigs.fingerprints(empty).count() == 0 and langid.predict(empty, langid.fit_documents(empty)).count() == 0
    assert secrets.redact(empty).count() == 0 and shards.shard_documents(empty).count() == 0 and simhash.keep_one(empty).count() == 0 and langid.keep_known(empty).count() == 0
    model, counts = lm.fit(empty)
    assert lm.score(empty, model, counts).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert wrapper.main_text(pages).count() == 0 and warc.round_trip(pages, str(tmp_path / "w")).count() == 0


def site(k, host):
    body = "".join(f"<p>Story {k} of {host}, part {j}</p>" for j in range(2 + k % 3))
    return f"<html><body><div class=top><p>{host}</p></div><div id=story><h1>Title {k}</h1>{body}<div class=box><p>Read more news</p></div></div><footer>{host} {k}</footer></body></html>"


def test_main_text_by_brute_force(spark):
    rows = [(i, f"https://{h}/p/{i}", site(i, h)) for i, h in enumerate(["a.example", "b.example"] * 4)]
    rows += [(20, None, site(20, "none")), (21, "no host at all", site(21, "none")), (22, "https://one.example/", site(22, "one.example")), (23, "https://a.example/x", None), (24, "https://a.example/y", "")]
    rows += [(25, "https://deep.example/", "<div>" * 3000 + "deep text" + "</div>" * 3000), (25, "https://deep.example/", "<div>" * 3000 + "deep text" + "</div>" * 3000), (None, "https://A.example:80/z", site(3, "a.example"))]
    pages = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], "page_id long, url string, html string, host string, wrapper string, text string").repartition(4)
    groups = {}
    for _, url, html in rows:
        groups.setdefault(urlsplit(url or "").hostname or "", []).append(html)
    want = []
    for page, url, html in rows:
        host = urlsplit(url or "").hostname or ""
        given = [h for p, u, h in rows if (urlsplit(u or "").hostname or "") == host and p is not None]
        way = wrapper.induce(given)
        text = wrapper.extract(html, way, *map(frozenset, wrapper.template(given, way)))
        want.append((page is None, page or 0, url or "", text, len(text)))
    got = [(r.page_id is None, r.page_id or 0, r.url or "", r.text, r.n_chars) for r in wrapper.main_text(pages).collect()]
    assert sorted(got) == sorted(want)
    text = {r[1]: r[3] for r in got if not r[0]}
    assert text[0] == "Title 0\nStory 0 of a.example, part 0\nStory 0 of a.example, part 1" and text[25] == "deep text" and text[23] == text[24] == ""
    assert text[22].startswith("Title 22\nStory 22")


def test_word_hashes_do_not_depend_on_the_stretch(monkeypatch):
    texts = corpus(30) + ["x" * 5000 + " " + "y" * 3000, "a\x1cb c", "é 漢字  z"]
    whole = lm.hashes(texts)[0]
    monkeypatch.setattr(common, "STRETCH", 16)
    assert (lm.hashes(texts)[0] == whole).all()
    words = list(itertools.chain.from_iterable([*(t.encode().lower().split()), None] for t in texts))
    of = {}
    for w, h in zip(words, whole):
        assert of.setdefault(w, h) == h
    assert len(set(of.values())) == len(of)


def test_a_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda k, d: d)

    with pytest.raises(RuntimeError):
        common.shared_dir(Session())


def test_wrapper_counts_all_pages_of_a_host(spark):
    """40 pages: blocks on nine tenths are template, one on a third is not, and a marked box
    that differs on one page alone stays there; equal to the functions on all pages."""
    def page(k):
        notice = "<div class=note-x><p>We use your data</p></div>" if k % 20 else ""
        tip = "<div class=tipped><p>Only on a third</p></div>" if k % 3 == 0 else ""
        box = f"<div class='related x'><p>{'Odd part of page 7' if k == 7 else 'Boxed words'}</p></div>"
        return f"<body><div id=story><h1>Title {k} of many</h1><p>{'word ' * (20 + k)}{k}</p>{notice}{tip}{box}</div></body>"

    html = [page(k) for k in range(40)]
    rows = [(i, "https://many.example/%d" % i, h) for i, h in enumerate(html + html[:9])]
    got = {r.page_id: r.text for r in wrapper.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()}
    way = wrapper.induce(html)
    made = list(map(frozenset, wrapper.template(html, way)))
    assert got == {i: wrapper.extract(h, way, *made) for i, _, h in rows}
    assert not any("your data" in t for t in got.values()) and "Only on a third" in got[3] and "Odd part of page 7" in got[7] and "Boxed" not in got[8]
