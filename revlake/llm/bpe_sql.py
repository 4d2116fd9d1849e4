"""Byte-level BPE encoding and decoding with DuckDB queries inside each partition.

The distinct pre-tokens of a chunk become rows (word, position, token). A recursive query joins the rows of neighbouring
tokens with the merge table, takes each word's leftmost pair of minimum rank, contracts it, and goes on
with the words that changed until none does. Decoding joins tokens with the vocabulary and aggregates their bytes
in order.

Contracting one pair a step takes as many steps as a word has merges, each over the whole word, which is quadratic in its
length. A sequence of tokens is an encoding exactly if each neighbouring pair encodes as itself, so a word longer than ``LONG``
bytes is encoded in blocks by the same query; the pairs at the seams are then encoded too, and where one doesn't come out as
itself, the tokens around the seam are encoded anew as one word, more of them each time, until all pairs do.

A null text gives null tokens, an empty one an empty list; null tokens decode to null. Tokens outside the vocabulary are an
error. Texts and words may be of any length. Of pairs of equal rank the leftmost is first; rows and ids that repeat are encoded
each time, with the same tokens.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import resident, row_chunks, text_chunks, tidy
from .pretokens import distinct, pretokens
from .vocabulary import VOCABULARY, load, merges

LONG = 64
#: A task remembers the encodings of what it met among this or the last so many distinct pre-tokens.
WORDS = 100_000
#: Most pre-tokens and most tokens in one query, so that its memory doesn't grow with a text's length.
SLICE_WORDS, SLICE_TOKENS = 50_000, 500_000

ENCODE = """
with recursive steps(word, tokens, live) as (
    select word, list(token order by pos), true from words group by word
    union all (
        with positions as (select word, unnest(tokens[:-2]) as a, unnest(tokens[2:]) as b, generate_subscripts(tokens[2:], 1) as pos from steps where live),
             best as (select p.word, min(m.merged::bigint << 32 | p.pos) as best from positions p join merges m using (a, b) group by p.word)
        select word,
               case when best is null then tokens
                    else list_concat(tokens[:(best & 4294967295) - 1], [(best >> 32)::int], tokens[(best & 4294967295) + 2:]) end,
               best is not null
        from steps left join best using (word) where live
    )
)
select tokens from steps where not live order by word
"""

DECODE = """
select t.row, unhex(string_agg(v.hex, '' order by t.pos)) as bytes
from tokens t join vocabulary v on v.token = t.token
group by t.row order by t.row
"""


class Engine:
    """A DuckDB database in memory, of one thread, that holds the merge table and the vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        import duckdb

        self.ranks = ranks
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "600MB", "temp_directory": "", "autoinstall_known_extensions": "false"})
        a, b, merged = (pa.array(c, pa.int32()) for c in zip(*merges(ranks), strict=True))
        self._load("merges", pa.table({"a": a, "b": b, "merged": merged}))
        self._load("vocabulary", pa.table({"token": pa.array(ranks.values(), pa.int32()), "hex": pa.array([t.hex() for t in ranks])}))
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def _load(self, name: str, table: pa.Table) -> None:
        self.db.register("incoming", table)
        self.db.execute(f"create or replace temp table {name} as select * from incoming")
        self.db.unregister("incoming")

    def _table(self, sql: str, **tables: pa.Table) -> pa.Table:
        for name, table in tables.items():
            self.db.register(name, table)
        out = self.db.sql(sql).to_arrow_table()
        for name in tables:
            self.db.unregister(name)
        return out

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Each word's tokens as the bytes of int32."""
        out = list(map(self.known.get, words))
        new = []
        for i, x in enumerate(out):
            if x is None:
                out[i] = x = self.before.get(words[i])
                if x is None:
                    new.append(i)
                else:
                    self.known[words[i]] = x
        for i, tokens in zip(long := [i for i in new if len(words[i]) > LONG], self._long([words[i] for i in long]), strict=True):
            out[i] = np.array(tokens, np.int32).tobytes()
        short = [i for i in new if len(words[i]) <= LONG]
        for first in range(0, len(short), SLICE_WORDS):
            new = short[first : first + SLICE_WORDS]
            if len(self.known) + len(new) > WORDS:
                self.before, self.known = self.known, {}
            for i, tokens in zip(new, self._contracted([words[i] for i in new]), strict=True):
                out[i] = self.known[words[i]] = tokens
        return out

    def _contracted(self, words: list[bytes]) -> Iterator[bytes]:
        """Tokens of words that aren't empty, by one recursive query."""
        lengths = np.array([len(w) for w in words])
        tokens = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum(lengths)
        pos = np.arange(len(tokens), dtype=np.int32) - np.repeat(ends - lengths, lengths).astype(np.int32)
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        got = self._table(ENCODE, words=pa.table({"word": word, "pos": pos, "token": tokens}))
        lists = got.column("tokens").combine_chunks()
        done = np.asarray(lists.flatten(), np.int32).tobytes()
        each = np.r_[0, 4 * np.cumsum(pc.list_value_length(lists).to_numpy())].tolist()
        return (done[a:b] for a, b in zip(each[:-1], each[1:], strict=True))

    def _distinct(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """The tokens of each distinct word."""
        every = list(dict.fromkeys(words))
        out = {}
        for a in range(0, len(every), SLICE_WORDS // 16):
            part = every[a : a + SLICE_WORDS // 16]
            out |= {w: np.frombuffer(t, np.int32).tolist() for w, t in zip(part, self._contracted(part), strict=True)}
        return out

    def _long(self, words: list[bytes]) -> list[list[int]]:
        blocks = [[w[a : a + LONG] for a in range(0, len(w), LONG)] for w in words]
        tokens = self._distinct([b for part in blocks for b in part])
        pieces = [[tokens[b] for b in part] for part in blocks]
        text = lambda part: b"".join(map(self.bytes_of.__getitem__, part))
        fits: dict[tuple[int, int], bool] = {}
        around, open_ = 2, [w for w, part in enumerate(pieces) if len(part) > 1]
        while open_:
            seams = {(x[-1], y[0]) for w in open_ for x, y in itertools.pairwise(pieces[w])} - fits.keys()
            tokens = self._distinct([text(s) for s in seams])
            fits |= {s: tokens[text(s)] == list(s) for s in seams}
            windows: dict[tuple[int, int], bytes] = {}
            for w in open_:
                after = -1
                for k, (x, y) in enumerate(itertools.pairwise(pieces[w])):
                    if k > after and not fits[x[-1], y[0]]:
                        windows[w, k], after = text(x[-around:] + y[:around]), k + 1
            tokens = self._distinct(list(windows.values()))
            for w in open_:
                out, skip = [], False
                for k, x in enumerate(pieces[w]):
                    if skip:
                        skip = False
                    elif (w, k) in windows:
                        y, skip = pieces[w][k + 1], True
                        out += [part for part in (x[:-around], tokens[windows[w, k]], y[around:]) if part]
                    else:
                        out.append(x)
                pieces[w] = out
            around, open_ = 2 * around, sorted({w for w, _ in windows})
        return [list(itertools.chain.from_iterable(part)) for part in pieces]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, places of each row's tokens) of UTF-8 rows."""
        cuts, at = pretokens(data, offsets)
        which, words = distinct(data, cuts)
        if not len(which):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        parts = self.encode_words(words)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) >> 2
        starts = np.cumsum(sizes) - sizes
        n = sizes[which]
        ends = np.cumsum(n)
        take = np.arange(ends[-1]) + np.repeat(starts[which] - (ends - n), n)
        return np.frombuffer(b"".join(parts), np.int32)[take], np.r_[0, ends][at]

    def decode(self, tokens: np.ndarray, at: np.ndarray) -> list[str]:
        """Text of each row of tokens."""
        out = [b""] * (len(at) - 1)
        row = np.repeat(np.arange(len(out), dtype=np.int32), np.diff(at))
        for a in range(0, len(tokens), SLICE_TOKENS):
            part = tokens[a : a + SLICE_TOKENS]
            got = self._table(DECODE, tokens=pa.table({"row": row[a : a + SLICE_TOKENS], "pos": np.arange(len(part), dtype=np.int32), "token": part}))
            for r, piece in zip(got["row"].to_pylist(), got["bytes"].to_pylist(), strict=True):
                out[r] += piece
        return [b.decode() for b in out]


def _lists(tokens: list[np.ndarray], ends: list[np.ndarray], null: np.ndarray) -> pa.Array:
    places = np.concatenate([np.zeros(1, np.int64), *ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(places), pa.array(np.concatenate([np.zeros(0, np.int32), *tokens])), mask=pa.array(null))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, verify: bool = True) -> DataFrame:
    """(doc_id, n_tokens, tokens[, round_trip]) of every row; round_trip: the tokens decode to the text."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    ranks = docs.sparkSession.sparkContext.broadcast(load(vocabulary))
    names = ["doc_id", "n_tokens", "tokens"] + ["round_trip"] * verify

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = resident("bpe", vocabulary, lambda: Engine(ranks.value))
        for batch in batches:
            text = batch.column("text")
            null = np.asarray(text.is_null())
            for a, b, data, offsets in text_chunks(text, 2 << 20):
                tokens, at = engine.encode(data, offsets)
                columns = [batch.column("doc_id").slice(a, b - a), pa.array(np.diff(at), mask=null[a:b]), _lists([tokens], [at[1:]], null[a:b])]
                if verify:
                    same = pa.array(engine.decode(tokens, at), pa.string())
                    columns.append(pc.equal(same, text.slice(a, b - a)))
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, tokens array<int>" + ", round_trip boolean" * verify)


def decode(encoded: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, text) of every row of token lists."""
    rows = encoded.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{tokens_col}`").cast("array<int>").alias("tokens"))
    ranks = encoded.sparkSession.sparkContext.broadcast(load(vocabulary))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = resident("bpe", vocabulary, lambda: Engine(ranks.value))
        for batch in batches:
            lists = batch.column("tokens")
            null = np.asarray(lists.is_null())
            values = np.asarray(lists.flatten(), np.int32)
            if not np.isin(values, np.fromiter(engine.ranks.values(), np.int64)).all():
                raise ValueError("a token is not in the vocabulary")
            sizes = np.where(null, 0, pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
            ends = np.r_[0, np.cumsum(sizes)]
            for a, b in row_chunks(ends, 1 << 20):
                text = engine.decode(values[ends[a] : ends[b]], ends[a : b + 1] - ends[a])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(text, pa.string(), mask=null[a:b])], ["doc_id", "text"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")
