import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken

from revlake.llm.bpe_sql import Engine, decode, encode
from revlake.llm.common import text_chunks
from revlake.llm.pretokens import pretokens
from revlake.llm.token_counts import TokenTransducer, token_counts
from revlake.llm.vocabulary import encode_word, load, merges

RANKS = load()
ENCODING = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def texts(n=4000, seed=1):
    rng = random.Random(seed)
    some = "abcdelrvmst' '  \n\t é,.!?12३²'’　\U0001d4b3漢́"
    out = ["".join(rng.choices(some, k=rng.randint(0, 80))) for _ in range(n)]
    out += ["".join(rng.choices("etaoinsrhl ", k=200)) for _ in range(200)]
    return out + ["", "  ", "'ll", "'l", "x'l", "'", "  '", "a  'll 're'r", "<|endoftext|>", "é" * 700, "zq" * 3000, " " * 5000, "ab " * 30000]


def test_pretokens_match_the_pattern():
    pattern, every = regex.compile(public_tokenizers.PATTERN), texts()
    for a, b, data, offsets in text_chunks(pa.array(every), 3000):
        cuts, at = pretokens(data, offsets)
        for i in range(a, b):
            got = [bytes(data[cuts[k] : cuts[k + 1]]).decode() for k in range(at[i - a], at[i - a + 1])]
            assert got == pattern.findall(every[i])


def test_merge_loop_matches_the_library():
    for t in texts(300, 2):
        for word in regex.findall(public_tokenizers.PATTERN, t):
            assert encode_word(word.encode(), RANKS) == ENCODING.encode_ordinary(word)


def test_transducer_may_forget():
    small, large = TokenTransducer(RANKS, states=50, words=20), TokenTransducer(RANKS)
    words = [w.encode() for t in texts(200, 3) for w in regex.findall(public_tokenizers.PATTERN, t)]
    assert (small.counts(words) == large.counts(words)).all()


@pytest.mark.parametrize("seed", [4])
def test_counts_match_the_library(spark, seed):
    rows = list(enumerate(texts(1500, seed))) + [(7, "again"), (7, "again"), (-1, None)]
    df = spark.createDataFrame([(t, 0, i) for i, t in rows], "text string, n_tokens int, doc_id int")
    got = sorted(token_counts(df).collect())
    want = sorted((i, len((t or "").encode()), len(regex.findall(public_tokenizers.PATTERN, t or "")), len(ENCODING.encode_ordinary(t or ""))) for i, t in rows)
    assert [tuple(r) for r in got] == want
    assert token_counts(df.limit(0)).count() == 0


def test_recursive_encoding_matches_the_library_and_decodes(spark):
    rows = list(enumerate(texts(800, 6))) + [(7, "again"), (None, "again"), (-1, None)]
    df = spark.createDataFrame([(t, "x", i) for i, t in rows], "text string, tokens string, doc_id int")
    encoded = encode(df)
    got = encoded.collect()
    assert all(r.round_trip for r in got if r.tokens is not None)
    want = sorted((str(i), None if t is None else ENCODING.encode_ordinary(t)) for i, t in rows if i != 7)
    assert sorted((str(r.doc_id), r.tokens) for r in got if r.doc_id != 7) == want
    assert [r.n_tokens for r in got if r.doc_id == -1] == [None]
    back = sorted((str(r.doc_id), r.text or "") for r in decode(encoded).collect())
    assert back == sorted((str(i), t or "") for i, t in rows)
    assert encode(df.limit(0)).count() == 0 and decode(encode(df.limit(0))).count() == 0


def test_merge_table_reaches_every_token():
    assert len(merges(RANKS)) == len(RANKS) - 256
    engine = Engine(RANKS)
    sample = [t for t, r in RANKS.items() if r % 17 == 0]
    assert engine.encode_words(sample) == [RANKS[t].to_bytes(4, "little") for t in sample]


def test_long_words_are_encoded_by_the_same_query():
    rng, engine = random.Random(5), Engine(RANKS)
    words = [b"a" * 1000, b"=-" * 3000 + b"=", "日本語テスト漢字".encode() * 300, b" " * 777, b"\n \n" * 500, b"x" * 65]
    words += ["".join(rng.choices("etaoinshrdlu", k=n)).encode() for n in (64, 65, 66, 128, 129, 5000)]
    words += [bytes(rng.choices(range(256), k=2000)), "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(3000)).encode()]
    words += ["".join(rng.choices("aabcdethinr", k=rng.randint(65, 300))).encode() for _ in range(200)]
    got = engine.encode_words(words)
    assert all(np.frombuffer(t, np.int32).tolist() == encode_word(w, RANKS) for t, w in zip(got, words, strict=True))


def test_chunks_of_long_words_compose():
    rng, transducer = random.Random(8), TokenTransducer(RANKS)
    words = [b"a" * 5000, b"=-" * 3000 + b"=", "日本語テスト漢字".encode() * 300, b" " * 777, b"ab" * 128, b"ab" * 128 + b"c"]
    words += ["".join(rng.choices("etaoinshrdlu", k=n)).encode() for n in (255, 256, 257, 511, 512, 513, 20_000)] + [bytes(rng.choices(range(256), k=2000))]
    assert transducer.counts(words).tolist() == [len(encode_word(w, RANKS)) for w in words]
