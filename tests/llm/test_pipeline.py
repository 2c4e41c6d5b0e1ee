"""The corpus pipeline against its stages by brute force, and rows that are odd."""

import itertools
import os
import random
import re

import pyarrow as pa
import pytest
import tiktoken
from test_operators import corpus

import corpus_pipeline
from linefold.llm import bpe, langid, setjoin, simhash


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def written(spark, folder, rows, items):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_pipeline(spark, tmp_path):
    base = corpus(120, 11)
    item = " ".join(f"bench{i}" for i in range(15))
    texts = base + base[:10] + [None, "", "12 34", base[3] + " " + item, f"{base[4]} other words password=abcdefghijklmnop {base[5]}"]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    sf = written(spark, tmp_path, rows, [(1, item), (2, None)])
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}

    kept = {}
    model = langid.fit_documents(spark.read.parquet(f"{sf}/documents.parquet"))
    for (i, t, *_), (_, _, rejected) in zip(rows, model.predict(texts)):
        if not rejected:
            kept[i] = t
    assert not {130, 131, 132} & set(kept) and len(kept) > 120
    prints = {i: simhash.fingerprint(t) for i, t in kept.items()}
    part = {i: i for i in kept}
    for i, j in itertools.combinations(kept, 2):
        if bin(prints[i] ^ prints[j]).count("1") <= 2 and part[i] != part[j]:
            old, new = max(part[i], part[j]), min(part[i], part[j])
            part = {k: new if p == old else p for k, p in part.items()}
    kept = {i: t for i, t in kept.items() if part[i] == i}
    assert not set(range(120, 130)) & set(kept)
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t.lower())
    grams = lambda w: {tuple(w[k : k + 13]) for k in range(len(w) - 12)}
    kept = {i: t for i, t in kept.items() if not grams(words(t)) & grams(words(item))}
    assert 133 not in kept and 134 in kept
    kept[134] = kept[134].replace("password=abcdefghijklmnop", "[SECRET]")
    assert set(got) == set(kept)
    path, pattern = bpe.tokenizer()
    ref = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(open(path, "rb").read()), special_tokens={})
    for i, t in kept.items():
        assert list(got[i].ids) == ref.encode_ordinary(t) and got[i].n_tokens == len(got[i].ids)


def test_intermediate_results_go(spark, tmp_path):
    sf = written(spark, tmp_path, [(i, t, "en", "s", len(t)) for i, t in enumerate(corpus(30))], [(1, "x")])
    result = corpus_pipeline.run(spark, sf)
    folder = os.path.dirname(result.inputFiles()[0].removeprefix("file://").rstrip("/"))
    assert os.listdir(os.path.dirname(folder)) == ["tokens"]


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)], [(1, "lone text", "en", "s", 9)], [(7, "same text", "en", "s", 9)] * 3 + [(None, "same text", None, None, None)] * 2])
def test_odd_tables(spark, tmp_path, rows):
    sf = written(spark, tmp_path, rows, [])
    assert corpus_pipeline.run(spark, sf).count() <= len(rows)


def test_stages_keep_columns_and_clashing_names(spark, tmp_path):
    sf = written(spark, tmp_path, [(i, t, "en", "s", len(t)) for i, t in enumerate(corpus(30))], [(1, "x")])
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("*", "1 as spans", "2 as _text", "3 as fp", "4 as _row", "5 as component_id", "6 as hits", "7 as lang_pred")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf)
        assert kept.columns == docs.columns and {r[5:] for r in kept.collect()} == {(1, 2, 3, 4, 5, 6, 7)}, name


@pytest.mark.parametrize("few, held", [(4, 1 << 20), (1, 0)])
def test_near_duplicates_stage_links_all_similar_texts(spark, monkeypatch, few, held):
    """One row of each component of all pairs at two bits or a five-word Jaccard of 0.8."""
    monkeypatch.setattr(setjoin, "FEW", few)
    monkeypatch.setattr(setjoin, "HELD_BYTES", held)
    monkeypatch.setattr(setjoin, "BLOCK", 3)
    rng = random.Random(5)
    base = [t for t in corpus(60, 12) if len(t.split()) > 60]
    texts = base + base[:3] + ["Twice THE same words here", "twice the  same words here", "a b c d e f g", "a b c d e f", None, "", "one"]
    for t in base[:8]:  # a group each, of which some are alike and some are not
        for k in (1, 1, 2, 2, 3, 4) * 2:
            w = t.split()
            for at in rng.sample(range(len(w)), k):
                w[at] = "edit%d" % rng.randrange(99)
            texts.append(" ".join(w))
    chain = base[-1].split()
    for at in range(0, 40, 2):  # each like the one before, the ends unlike
        chain = chain[:]
        chain[at] = "step%d" % at
        texts.append(" ".join(chain))
    parts = lambda w: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    sets, prints = [parts((t or "").lower().split()) for t in texts], [simhash.fingerprint(t) for t in texts]
    alike = lambda i, j: sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
    pairs = list(itertools.combinations(range(len(texts)), 2))
    wide = [(i, j) for i, j in pairs if bin(prints[i] ^ prints[j]).count("1") > 2 and alike(i, j)]
    assert len(wide) > 50
    part = list(range(len(texts)))
    for i, j in pairs:
        if part[i] != part[j] and (bin(prints[i] ^ prints[j]).count("1") <= 2 or alike(i, j)):
            old, new = max(part[i], part[j]), min(part[i], part[j])
            part = [new if p == old else p for p in part]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in corpus_pipeline.one_of_each(spark, docs, "").collect()}
    assert kept == {i for i, p in enumerate(part) if p == i}


def test_short_batches(spark, tmp_path, monkeypatch):
    """No stage leaves longer batches than it says; ``run`` puts the caller's setting back."""

    def lengths(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    longest = lambda: max(r.n for r in spark.range(0, 2500, 1, 1).mapInArrow(lengths, "n long").collect())
    sf = written(spark, tmp_path, [(i, t, "en", "s", len(t)) for i, t in enumerate(corpus(9, 5))], [(1, "x")])
    docs, setting = spark.read.parquet(f"{sf}/documents.parquet"), corpus_pipeline.BATCH_SETTING
    own, same = spark.conf.get(setting), corpus_pipeline.short_batches(lambda spark, docs, sf_dir: docs)
    try:
        assert longest() == 2500
        same(spark, docs, sf)
        assert longest() == corpus_pipeline.BATCH_ROWS
        assert all(hasattr(stage, "__wrapped__") for _, stage in corpus_pipeline.STAGES)
        spark.conf.set(setting, "2")  # a smaller one is the caller's
        same(spark, docs, sf)
        assert spark.conf.get(setting) == "2"
        spark.conf.set(setting, own)
        prints = lambda: {r.doc_id: r.fp for r in simhash.fingerprints(docs).collect()}
        want = prints()
        spark.conf.set(setting, "2")
        assert prints() == want and len(want) == 9
        monkeypatch.setattr(corpus_pipeline, "STAGES", [("same", same)])
        spark.conf.set(setting, own)
        assert corpus_pipeline.run(spark, sf).count() == 9 and spark.conf.get(setting) == own
    finally:
        spark.conf.set(setting, own)
