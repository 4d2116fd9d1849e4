"""The language model of tokens: whole texts, exact scores, and levels that grow with the corpus."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from revlake.llm.kneser_ney import discounts
from revlake.llm.lm_trie import STEP, Level, Trie, build_trie, lm_score, score_documents, scorer, token_grams
from revlake.llm.queries import op1_lm_score
from revlake.llm.tokens import Tokens, spans


def split(texts):
    """Tokens by regular expression."""
    import re

    word = re.compile(rb" ?[0-9A-Za-z\x80-\xff]+|.", re.S)
    parts = [[m[0] for m in word.finditer(t.encode())] for t in texts]
    n = Counter(w for p in parts for w in p)
    is_word = lambda w: re.fullmatch(rb" ?[0-9A-Za-z\x80-\xff]+", w)
    known = {w for w, c in n.items() if is_word(w) and c > 1}
    return [[s for w in p for s in ([w] if w in known else [bytes([b]) + b"*" for b in w])] for p in parts], len(known)


def brute_force(texts, order=3):
    """Total bits of each text by the textbook recursion."""
    parts, words = split(texts)
    counts = {order: Counter()}
    padded = [("",) * (order - 1) + tuple(p) for p in parts]
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
        low = 1 / (256 + words) if k == 1 else p(gram[1:])
        if gram[:-1] not in total[k]:
            return low
        n = counts[k].get(gram, 0)
        return (n - d[k][min(n, 3)] + follow[k][gram[:-1]] * low) / total[k][gram[:-1]]

    return [-sum(np.log2(p(t[i - order + 1 : i + 1])) for i in range(order - 1, len(t))) for t in padded], [len(p) for p in parts]


TEXTS = ["the cat sat on the mat", "the cat ate the rat, the rat!", "", "élan für été \0 x", "a", "a", "zq " * 900, " the mat\n the  cat 12 12", "été für the cat"]


@pytest.mark.parametrize("part_tokens", [2_000_000, 40])
def test_scores_match_brute_force(spark, part_tokens):
    df = spark.createDataFrame(list(enumerate([*TEXTS, None])), "doc_id int, text string")
    got = {r.doc_id: r for r in lm_score(df, part_tokens=part_tokens).collect()}
    assert len(got) == len(TEXTS) + 1
    for i, (bits, n) in enumerate(zip(*brute_force(TEXTS), strict=True)):
        assert got[i].n_bytes == len(TEXTS[i].encode())
        if n:
            assert got[i].bits_per_byte * got[i].n_bytes == pytest.approx(bits, abs=n * (4 * STEP + 1e-6)), TEXTS[i]
    assert got[2].bits_per_byte is None and got[len(TEXTS)].bits_per_byte is None


def test_tokens_spell_what_is_no_word():
    data = np.frombuffer("ab ab\nxy".encode() + b"ab", np.uint8)
    offsets = np.array([0, 8, 10])
    starts, ends, hashes = spans(data, offsets)
    assert starts.tolist() == [0, 2, 6, 8] and ends.tolist() == [2, 5, 8, 10] and hashes[0] == hashes[3] != hashes[1]
    symbols, at = Tokens(np.sort(hashes[:2])).split(data, offsets)
    assert at.tolist() == [0, 5, 6] and symbols[0] == symbols[5] > 256 and symbols[1] > 256 and symbols[2:5].tolist() == [11, ord("x") + 1, ord("y") + 1]


def test_query_sees_more_than_one_word(spark, tmp_path):
    """Eight random words in 1,200 texts: what follows two given words is certain, and byte 5-grams can't see it."""
    rng = np.random.default_rng(3)
    words = [f"abcdefgh{c}wxyzuvst" for c in "klmnopqr"]
    texts = []
    for _ in range(1200):
        a, b = rng.integers(0, 8, 2)
        texts.append(" ".join(words[x] for x in (a, b, (a * 3 + b) % 8)))
    spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").write.parquet(str(tmp_path / "documents.parquet"))
    bits = [r.bits_per_byte * r.n_bytes for r in op1_lm_score(spark, str(tmp_path)).collect()]
    assert np.mean(bits) < 7  # two words of 3 bits each, and a certain third
    model = build_trie(spark.read.parquet(str(tmp_path / "documents.parquet")))
    assert model["symbols"] == 256 + 16


def test_look_ups_do_not_grow_with_the_parts(spark, monkeypatch):
    """Hundreds of parts, hot symbols among them, are searched in a few calls, and score as one part does."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.3, 60) % 200) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    calls = []
    look_up = Level.look_up
    monkeypatch.setattr(Level, "look_up", lambda self, *a: calls.append(1) or look_up(self, *a))
    got = []
    for part_tokens in (2_000_000, 12):
        model = build_trie(df, part_tokens=part_tokens)
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        tokens, at = Tokens.of(model["vocabulary"]).split(data, np.r_[0, np.cumsum([len(t) for t in texts])])
        calls.clear()
        got.append(Trie(**{k: v for k, v in model.items() if k != "vocabulary"}).log2(np.unique(token_grams(tokens, at))))
    assert model["parts"] > 400 and model["hot"] and len(calls) < model["parts"] / 4
    assert np.array_equal(*got)


def test_scores_over_several_look_ups(spark, monkeypatch):
    """Texts of one batch that are looked up apart score as those looked up together."""
    df = spark.createDataFrame(list(enumerate([*TEXTS, None] * 3)), "doc_id int, text string")
    model = build_trie(df)
    together = sorted(score_documents(df, model).collect())
    monkeypatch.setattr("revlake.llm.common.text_chunks.__defaults__", (8,))
    monkeypatch.setattr("revlake.llm.lm_trie.SCORED_GRAMS", 5)
    monkeypatch.setattr("revlake.llm.lm_trie.LOOKED_UP", 3)
    data = [r.text or "" for r in df.sort("doc_id").collect()]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(data))), pa.array(data)], ["doc_id", "text"])
    apart = pa.Table.from_batches(list(scorer(model)(iter([batch])))).to_pylist()
    assert [(r["doc_id"], r["bits_per_byte"], r["n_bytes"]) for r in apart] == [(r.doc_id, r.bits_per_byte, r.n_bytes) for r in together]
