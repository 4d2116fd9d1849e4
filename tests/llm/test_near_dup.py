import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from revlake.llm import near_dup
from revlake.llm.near_dup import components, drop_near_duplicates, near_duplicates

WORD = re.compile(r"[a-z0-9\u0080-\U0010ffff]+")


def shingles(text, n=3):
    w = WORD.findall((text or "").lower())
    return Counter(zip(*[w[k:] for k in range(n)])) if len(w) >= n else Counter([tuple(w)] if w else [])


def similarity(x, y):
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in x | y) for i in x & y)


def groups(rows, threshold=0.5):
    """{id: least id of its group} by all pairs."""
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = {i: shingles(t) for i, t in rows}
    for (a, ta), (b, tb) in itertools.combinations(rows, 2):
        if ta and tb and (ta == tb or similarity(sets[a], sets[b]) >= threshold):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i, _ in rows}


def corpus(seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(500)]
    texts = []
    for _ in range(25):
        base = rng.choices(words, k=rng.randint(5, 300))
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            copy = list(base)
            for _ in range(len(copy) // rng.choice([12, 25, 60])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    texts += [texts[0]] * 5 + ["one", "one", "One!", "two words", "", "", None, None, "!!!", "!!!", "...", "a a a a a a b " * 50, "long " + "word " * 20000]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_groups_match_brute_force(spark):
    rows = corpus()
    want = {(i, r) for i, r in groups(rows).items() if i != r}
    got = {tuple(r) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(want) > 30
    assert len(got & want) >= 0.95 * len(want)
    assert len(got - want) <= 1


def test_stage_keeps_one_of_each_and_all_columns(spark):
    rows = corpus(5)
    df = spark.createDataFrame([(t, i, "x", i, True) for i, t in rows], "text string, doc_id long, node string, id long, stays boolean")
    gone = {r.doc_id for r in near_duplicates(df).collect()}
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _ in rows if i not in gone]


def test_repeated_rows_null_ids_and_empty_tables(spark):
    text = "a b c d e f g h"
    df = spark.createDataFrame([(1, text), (1, text), (1, "other words are here now"), (None, text), (None, None), (None, None), (2, "")], "doc_id int, text string")
    kept = sorted((r.doc_id is None, r.doc_id, r.text or "") for r in drop_near_duplicates(df).where("text is not null").collect())
    assert kept == [(False, 1, text), (False, 1, "other words are here now"), (False, 2, "")]
    assert drop_near_duplicates(df).count() == 5
    assert sorted(str(r.doc_id) for r in near_duplicates(df).collect()) == ["1", "None"]
    empty = spark.createDataFrame([], "doc_id int, text string")
    assert near_duplicates(empty).count() == 0 and drop_near_duplicates(empty).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(str(rng.randrange(60)).zfill(2), str(rng.randrange(60)).zfill(2)) for _ in range(45)] + [(str(100 + i), str(101 + i)) for i in range(40)]
    root = {x: x for e in edges for x in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {i: find(i) for i in root if find(i) != i}


def templated(n, seed=9):
    """Documents of 55 words that all share and 50 of their own: no two are duplicates, though many fall into one bucket."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    shared = [word() for _ in range(55)]
    return [" ".join(shared + [word() for _ in range(50)]) for _ in range(n)]


def test_templates_make_few_pairs(spark, monkeypatch):
    shipped = []
    verify = near_dup._verify

    def counted(pairs, *rest):
        shipped.append(pairs.count())
        return verify(pairs, *rest)

    monkeypatch.setattr(near_dup, "_verify", counted)
    seen = {}
    for n in (600, 2400):
        texts = templated(n)
        texts[7] = texts[5] + " and some words"  # one true pair among them
        rows = [(t, i) for i, t in enumerate(texts)]
        shipped.clear()
        got = [tuple(r) for r in near_duplicates(spark.createDataFrame(rows, "text string, doc_id long")).collect()]
        assert got == [(7, 5)]
        seen[n] = sum(shipped)
    assert seen[2400] < 10_000 and seen[2400] < 6 * seen[600]


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8])
def test_prefixes_lose_no_pair(threshold):
    rng = random.Random(4)
    for _ in range(400):
        shared = {k: rng.randint(1, 4) for k in range(rng.randint(1, 30))}
        x, y = (Counter({**{k: max(1, n + rng.randint(-1, 1)) for k, n in shared.items()}, **{base + k: rng.randint(1, 4) for k in range(rng.randint(0, 25))}}) for base in (100, 200))
        if similarity(x, y) < threshold:
            continue
        often = {k: rng.randint(1, 9) for k in x | y}
        arrays = [[np.array(a) for a in ([*map(np.uint64, d)], [*d.values()], [often[k] for k in d])] for d in (x, y)]
        weak = [set(a[0][near_dup.prefix(*a, 1 - threshold)].tolist()) for a in arrays]
        strong = [set(a[0][near_dup.prefix(*a, (1 - threshold) / (1 + threshold))].tolist()) for a in arrays]
        assert strong[0] & weak[1] or strong[1] & weak[0]
