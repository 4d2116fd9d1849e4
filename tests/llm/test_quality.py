import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_lm_trie import brute_force

from revlake.llm import quality
from revlake.llm.quality import PRIOR, QUANTILE, classify, drop_low_quality


def held_out(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    return {r.id for r in df.where(F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(5)) == 0).collect()}


def expected(spark, docs, labels, order):
    """{place: (score, threshold, keep)} of (doc_id, lang, text)."""
    good = {i for i, q, t in labels if q == 1 and t == 0 and i is not None}
    held = held_out(spark, good)
    out = {}
    for lang in {d[1] for d in docs}:
        zero = [(d[2] or "").translate(str.maketrans("123456789", "0" * 9)) for d in docs]
        own = [k for k, d in enumerate(docs) if d[1] == lang]
        trusted = [k for k in own if docs[k][0] in good and docs[k][2]] if lang is not None else []
        train = [zero[k] for k in trusted if docs[k][0] not in held]
        rest = [k for k in trusted if docs[k][0] in held]
        if not train or not rest:
            out |= dict.fromkeys(own, (None, None, True))
            continue
        bits = dict(zip(own, brute_force([zero[k] for k in own], order, train), strict=True))
        size = {k: len(zero[k].encode()) for k in own}
        median = np.quantile([bits[k] for k in rest], 0.5)
        score = {k: (bits[k] * size[k] + PRIOR * median) / (size[k] + PRIOR) for k in own if bits[k] is not None}
        limit = np.quantile([score[k] for k in rest], QUANTILE)
        for k in own:
            out[k] = (score.get(k), limit, not (k in score and score[k] > limit))
    return out


def fixture():
    rng = random.Random(4)
    words = {lang: ["".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(60)] for lang, letters in (("en", "abcdefg"), ("fr", "éèstuv"))}
    docs, labels = [], []
    for i in range(260):
        lang = "en" if i % 3 else "fr"
        text = " ".join(rng.choices(words[lang], k=rng.randint(1, 80)))
        bad = i % 7 == 0
        if bad:
            text = " ".join(w + "%%%" for w in text.split())
        docs.append((i, lang, f"{text} {i}"))
        if i % 2 == 0:
            labels.append((i, int(not bad), int(i % 10 == 0)))
    docs += [(900, "xx", "no model"), (901, None, "no language"), (902, "en", ""), (903, "en", None), (904, "en", "zz" * 40_000), (1, "en", docs[1][2]), (None, "en", "aa bb")]
    return docs, labels + [labels[0], (None, 1, 0), (5555, 1, 0), (3, None, None)]


def test_matches_brute_force(spark):
    docs, labels = fixture()
    df = spark.createDataFrame([(t, lang, i, 0, "m") for i, lang, t in docs], "text string, lang string, doc_id long, id int, model string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = classify(df, marks, order=3).collect()
    want = expected(spark, docs, labels, 3)
    key = lambda r: (str(r[0]), str(r[1]), r[2])
    left = sorted((r.doc_id, r.lang, r.n_bytes, r.score, r.threshold, r.keep) for r in got if r.doc_id not in (None, 1))
    right = sorted((docs[k][0], docs[k][1], len((docs[k][2] or "").encode()), *w) for k, w in want.items() if docs[k][0] not in (None, 1))
    assert len(got) == len(docs)
    for a, b in zip(sorted(left, key=key), sorted(right, key=key), strict=True):
        assert a[:3] == b[:3] and a[5] == b[5], (a, b)
        assert (a[3] is None) == (b[3] is None) and (a[3] is None or np.log2(a[3]) == pytest.approx(b[3], abs=1e-3))
    kept = drop_low_quality(df, marks, order=3)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(docs[k][0]) for k, w in want.items() if w[2])
    junk = [k for k in want if docs[k][0] is not None and docs[k][0] < 260 and docs[k][0] % 7 == 0]
    assert sum(not want[k][2] for k in junk) > 0.9 * len(junk)


def test_bounded_sample_and_shuffled_join(spark, monkeypatch):
    docs, labels = fixture()
    df, marks = spark.createDataFrame(docs, "doc_id long, lang string, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    monkeypatch.setattr(quality, "BROADCAST_ROWS", 0)
    n = quality.trusted_texts(df, marks, "doc_id", "text", "lang", 10).groupBy("model").count().collect()
    assert {r.model for r in n} == {"en", "fr"} and all(2 <= r["count"] <= 22 for r in n)


def test_every_trusted_text_is_used(spark):
    """More than 10,000 of one language: model and thresholds are those of all of them."""
    rng = random.Random(5)
    docs = [(i, "en", " ".join(rng.choices(["river", "stone", "old", "evening", "light", f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}"], k=rng.randint(1, 3)))) for i in range(14_000)]
    labels = [(i, 1, 0) for i, *_ in docs]
    df, marks = spark.createDataFrame(docs, "doc_id long, lang string, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert quality.trusted_texts(df, marks, "doc_id", "text", "lang").count() == len(docs)
    limit = quality.fit(df, marks, order=3).threshold["en"]
    assert limit == pytest.approx(expected(spark, docs, labels, 3)[0][1], abs=1e-5)


def test_parts_and_shuffled_join_change_nothing(spark, monkeypatch):
    docs, labels = fixture()
    df, marks = spark.createDataFrame(docs, "doc_id long, lang string, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = lambda: sorted(map(tuple, classify(df, marks, order=3).collect()), key=lambda r: str(r[:3]))
    want = rows()
    monkeypatch.setattr(quality, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(quality, "PART_GRAMS", 50)
    models = quality.write_models(quality.trusted_texts(df, marks, "doc_id", "text", "lang").where("not held"), 3)
    assert models.keys() == {"en", "fr"} and all(len(m["made"]) > 2 for m in models.values()), models
    for a, b in zip(rows(), want, strict=True):
        assert a[:3] + a[6:] == b[:3] + b[6:] and [x or 0 for x in a[3:6]] == pytest.approx([x or 0 for x in b[3:6]], rel=1e-6)


def test_empty_tables(spark):
    docs, labels = fixture()
    df, marks = spark.createDataFrame(docs, "doc_id long, lang string, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert classify(df.limit(0), marks).count() == 0
    assert classify(df, marks.limit(0)).where("keep").count() == len(docs) == drop_low_quality(df, marks.limit(0)).count()
