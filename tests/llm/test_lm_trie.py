from collections import Counter, defaultdict

import numpy as np
import pytest

from revlake.llm.kneser_ney import GramCache, discounts
from revlake.llm.lm_trie import EliasFano, file_blocks, lm_score, pack, unpack


def brute_force(texts, order, train=None):
    """bits per byte by the textbook recursion over dictionaries; of a model of the same texts or of others."""
    counts = {order: Counter()}
    padded = [b"\0" * (order - 1) + t.encode() for t in (texts if train is None else train) if t]
    for t in padded:
        for i in range(order - 1, len(t)):
            counts[order][t[i - order + 1 : i + 1]] += 1
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    d, total, follow = {}, {}, {}
    for k, table in counts.items():
        of = Counter(table.values())
        d[k] = (0.0, *discounts(*(of[i] for i in (1, 2, 3, 4))))
        total[k], follow[k] = defaultdict(int), defaultdict(float)
        for g, n in table.items():
            total[k][g[:-1]] += n
            follow[k][g[:-1]] += d[k][min(n, 3)]

    def p(gram):
        k = len(gram)
        low = 1 / 256 if k == 1 else p(gram[1:])
        if gram[:-1] not in total[k]:
            return low
        n = counts[k].get(gram, 0)
        return (n - d[k][min(n, 3)] + follow[k][gram[:-1]] * low) / total[k][gram[:-1]]

    out = []
    for t in texts:
        if not t:
            out.append(None)
            continue
        t = b"\0" * (order - 1) + t.encode()
        out.append(-np.mean([np.log2(p(t[i - order + 1 : i + 1])) for i in range(order - 1, len(t))]))
    return out


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, top in ((0, 5), (1, 1), (1, 10**6), (300, 301), (5000, 10**7), (700, 3)):
        v = np.sort(rng.integers(0, top, n))
        e = EliasFano.from_arrays(unpack(np.frombuffer(pack(EliasFano.encode(v).arrays()), np.uint8)))
        assert (e.get(np.arange(n)) == v).all()
        x = np.r_[rng.integers(0, top + 5, 500), top * 100, 0]
        i, value = e.successor(x)
        want = np.searchsorted(v, x)
        assert (i == want).all()
        assert (value == np.r_[v, -1][want]).all()


def test_elias_fano_of_clusters():
    """Thousands of neighbours among numbers far apart: one of the ranges of equal high bits is long."""
    rng = np.random.default_rng(5)
    v = np.unique(np.r_[rng.integers(0, 1 << 42, 300), (7 << 30) + rng.integers(0, 1 << 16, 20_000)])
    e = EliasFano.encode(v)
    x = np.r_[v, v + 1, rng.integers(0, 1 << 42, 1000)]
    i, value = e.successor(x)
    assert (i == np.searchsorted(v, x)).all() and (value == np.r_[v, -1][i]).all()
    assert (e.find(x) == np.where(np.isin(x, v), np.searchsorted(v, x), -1)).all()


def test_segments_of_elias_fano():
    """Sequences of all kinds joined: each look-up names its segment, and places count through all."""
    rng = np.random.default_rng(6)
    vs = [np.sort(rng.integers(0, top, n)) for n, top in ((0, 5), (300, 301), (5000, 10**7), (0, 1), (1, 1), (700, 3), (3, 10**12))]
    vs.append(np.unique(np.r_[rng.integers(0, 1 << 42, 300), (7 << 30) + rng.integers(0, 1 << 16, 20_000)]))
    e = EliasFano.from_arrays(unpack(np.frombuffer(b"".join(file_blocks(EliasFano.joined([EliasFano.encode(v) for v in vs]))), np.uint8)))
    first = np.cumsum([0, *map(len, vs)])
    for k in (*range(len(vs)), *range(len(vs))[::-1]):
        v, own = vs[k], lambda x, k=k: np.full(len(x), k)
        assert (e.get(first[k] + np.arange(len(v)), own(v)) == v).all()
        x = np.r_[v, v + 1, rng.integers(0, 1 << 42, 500), 0, 1 << 45]
        i, value = e.successor(x, own(x))
        want = np.searchsorted(v, x)
        assert (i == first[k] + want).all() and (value == np.r_[v, -1][want]).all()
        assert (e.find(x, own(x)) == np.where(np.isin(x, v), first[k] + want, -1)).all()
        if len(v) > 1:
            assert [c.tolist() for c in e.get_two(first[k] + np.arange(len(v) - 1), own(v[1:]))] == [v[:-1].tolist(), v[1:].tolist()]


def test_cache_is_exact_when_it_overflows():
    cache = GramCache(lambda g: (g % 97).astype(np.float32), bits=6)
    rng = np.random.default_rng(2)
    for _ in range(50):
        g = rng.integers(0, 500, 200)
        assert (cache.get(g) == g % 97).all()


def test_grams_of_texts():
    from revlake.llm.lm_trie import packed, token_grams, unpacked

    tokens, offsets = np.array([5, 6, 7, 9, 8, 4]), np.array([0, 3, 3, 4, 6])
    want = [(0, 0, 5), (5, 0, 6), (6, 5, 7), (0, 0, 9), (0, 0, 8), (8, 0, 4)]
    got = token_grams(tokens, offsets)
    assert [(int(g >> 42), int(g >> 21 & 0x1FFFFF), int(g & 0x1FFFFF)) for g in got] == want
    key, n = np.unique(got, return_counts=True)
    assert all((x == y).all() for x, y in zip(unpacked(packed(key, n), 2), (key, n), strict=True))


def test_empty_table(spark):
    assert lm_score(spark.createDataFrame([], "doc_id int, text string")).collect() == []
    assert lm_score(spark.createDataFrame([(1, None)], "doc_id int, text string")).collect()[0].n_bytes == 0


def test_discounts_by_hand():
    """Chen and Goodman's formulas on counts whose Y is one half, and with too few of them."""
    assert discounts(120, 60, 30, 10) == pytest.approx((1 - 60 / 120, 2 - 1.5 * 30 / 60, 3 - 2 * 10 / 30))
    assert discounts(0, 0, 0, 0) == (0.5, 1.0, 1.5) and all(0 < d < k + 1 for k, d in enumerate(discounts(5, 0, 100, 3)))
