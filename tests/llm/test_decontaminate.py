import random
import re

import pytest

from revlake.llm import decontaminate
from revlake.llm.decontaminate import contaminated, drop_contaminated

WORD = re.compile(r"[a-z0-9\u0080-\U0010ffff]+")


def shingles(text, n=4):
    w = WORD.findall((text or "").lower())
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def brute_force(docs, items, threshold=0.5):
    out = set()
    for d, text in docs:
        own = shingles(text)
        for i, item in items:
            q = shingles(item)
            if q and len(q & own) >= threshold * len(q):
                out.add((d, i, round(len(q & own) / len(q), 6)))
    return out


def fixture(seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghijé", k=rng.randint(2, 7))) for _ in range(800)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([2, 3, 4, 5, 14, 15, 30, 31, 60, 200, 900])))) for i in range(80)]
    items += [(80, ""), (81, None), (82, "!?"), (83, items[4][1]), (4, items[5][1])]
    docs = []
    for d in range(250):
        w = rng.choices(words, k=rng.choice([0, 1, 5, 40, 400, 4000]))
        for _ in range(rng.choice([0, 0, 1, 2])):
            own = rng.choice(items)[1] or ""
            own = own.upper().split() if rng.random() < 0.3 else own.split()
            cut = rng.choice([1, 1, 0.7, 0.45])
            own = own[: int(len(own) * cut) + 1]
            at = rng.randint(0, len(w))
            w[at:at] = own
        docs.append((d, ", ".join(w) if d % 7 == 0 else " ".join(w)))
    return docs + [(300, None), (301, ""), (302, items[0][1]), (302, items[0][1]), (303, "x " * 60000 + items[9][1])], items


@pytest.mark.parametrize("shard_bytes", [16 << 20, 2000])
def test_matches_brute_force(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard_bytes)
    docs, items = fixture()
    d = spark.createDataFrame([(t, i, 1) for i, t in docs], "text string, doc_id long, item_id int")
    b = spark.createDataFrame(items, "item_id int, text string")
    want = brute_force(docs, items)
    got = {(r.doc_id, r.item_id, round(r.containment, 6)) for r in contaminated(d, b).collect()}
    assert got == want and len(want) > 50
    kept = drop_contaminated(d, b)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in docs if i not in {x for x, *_ in got})


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(docs, none).count() == 0 and drop_contaminated(docs, none).count() == 1
    items = spark.createDataFrame([(None, "a b c d e")], "item_id long, text string")
    assert [tuple(r) for r in contaminated(docs, items).collect()] == [(1, None, 1.0)]
    assert contaminated(docs.limit(0), items).count() == 0


def test_short_items_are_never_missed(spark):
    """400 items of 4 words whole, and of 5 with half of their shingles, each in a document of 3,000 words."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=5))
    items, docs = [], []
    for i in range(400):
        item = [word() for _ in range(4 + i % 2)]
        w = [word() for _ in range(3000)]
        w[1000:1000] = item[:4]
        items.append((f"mmlu-{i}", " ".join(item)))
        docs.append((f"d{i}", " ".join(w)))
    got = {(r.doc_id, r.item_id, r.containment) for r in contaminated(spark.createDataFrame(docs, "doc_id string, text string"), spark.createDataFrame(items, "item_id string, text string")).collect()}
    assert got == {(f"d{i}", f"mmlu-{i}", 1.0 if i % 2 == 0 else 0.5) for i in range(400)}


def test_shingles_that_many_items_share(spark):
    items = [(i, f"which of the following words is{i} right{i} here{i} now{i}") for i in range(300)]
    docs = [(d, f"which of the following words is{d}" + " x" * (d % 3)) for d in range(40)] + [(99, items[7][1])]
    docs, items = [(d, t) for d, t in docs], items
    got = {(r.doc_id, r.item_id, round(r.containment, 6)) for r in contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string")).collect()}
    assert got == brute_force(docs, items) and (99, 7, 1.0) in got
