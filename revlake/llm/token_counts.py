"""Token counts by finite-state tokenizer compilation.

Two deterministic transducers give the number of byte-level BPE tokens of a text without building the tokens.
The first cuts a text into pre-tokens (``pretokens``: chunk state maps composed by prefix scan). The second reads
a pre-token's bytes; each transition carries the change of the number of tokens of the prefix's encoding.

A sequence of tokens is an encoding exactly if each neighbouring pair encodes as itself, so the encoding of a prefix
ends in one certain token. A state is what later bytes can still see: the places where an unfinished token
may have begun (its node in the trie of tokens), the last token before each, and how many tokens came since. A
byte advances all nodes; of the tokens that end there, the one that is compatible with the token before it is
the last one. States are determinised as texts reach them, up to ``STATES``, when the automaton begins anew.

A longer pre-token is cut into chunks. A chunk's map takes an entry state to its exit state and the tokens emitted in between; it
is computed for the state that the bytes before the chunk most likely lead to. The maps compose in a parallel prefix scan, and
an entry that a map lacks is run then, so a wrong guess costs time alone.

A null or empty text has 0 tokens. Rows with equal ids stay as they are, equal texts have equal counts, and texts and
pre-tokens may be of any length.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import resident, text_chunks, tidy
from .pretokens import distinct, pretokens
from .vocabulary import VOCABULARY, encode_word, load

#: Most states, remembered pre-tokens and remembered pairs that a task holds: bounds of memory, not of the result.
STATES, WORDS, PAIRS = 400_000, 500_000, 600_000
#: Bytes of a chunk of a long pre-token, and those before it that its entry state is guessed from.
CHUNK, WARM = 256, 64


class TokenTransducer:
    def __init__(self, ranks: dict[bytes, int], states: int = STATES, words: int = WORDS):
        self.ranks, self.most_states, self.most_words = ranks, states, words
        self.tokens = {r: t for t, r in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.token_at = [-1]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                node = self.children[node].setdefault(byte, len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    self.token_at.append(-1)
            self.token_at[node] = rank
        self.compatible: dict[int, bool] = {}
        self.known: dict[bytes, int] = {}
        self.before: dict[bytes, int] = {}
        self.clear()

    def clear(self) -> None:
        """Begin with the start state alone. A state's parts are packed as node, last token + 1 and tokens since."""
        self.states: list[tuple[int, ...]] = []
        self.ids: dict[tuple[int, ...], int] = {}
        self.goes: dict[int, int] = {}
        self._state((0,))

    def _state(self, key: tuple[int, ...]) -> int:
        s = self.ids.setdefault(key, len(self.states))
        if s == len(self.states):
            self.states.append(key)
        return s

    def _pair(self, a: int, b: int) -> bool:
        ok = self.compatible.get(a << 32 | b)
        if ok is None:
            if len(self.compatible) >= PAIRS:
                self.compatible.clear()
            ok = self.compatible[a << 32 | b] = encode_word(self.tokens[a] + self.tokens[b], self.ranks) == [a, b]
        return ok

    def _compile(self, state: int, byte: int) -> int:
        """Add the transition: next state and emitted tokens, packed."""
        still, last, emit, children, token_at = [], -1, 0, self.children, self.token_at
        for part in self.states[state]:
            node = children[part & 0xFFFFFF].get(byte)
            if node is None:
                continue
            token = token_at[node]
            if last < 0 and token >= 0:
                before = (part >> 24 & 0xFFFFFF) - 1
                if before < 0 or self._pair(before, token):
                    last, emit = token, 1 - (part >> 48)
            if children[node]:
                still.append(part >> 24 << 24 | node)
        key = (*(part + (emit << 48) for part in still), last + 1 << 24)
        go = self.goes[state << 8 | byte] = self._state(key) << 12 | emit + 2048
        return go

    def _run(self, state: int, data: bytes) -> tuple[int, int]:
        """(exit state, tokens emitted) from an entry state."""
        n, goes = 0, self.goes
        for byte in data:
            go = goes.get(state << 8 | byte)
            if go is None:
                go = self._compile(state, byte)
            state = go >> 12
            n += go & 4095
        return state, n - 2048 * len(data)

    def count(self, word: bytes) -> int:
        if len(word) <= CHUNK:
            return self._run(0, word)[1]
        parts = [word[a : a + CHUNK] for a in range(0, len(word), CHUNK)]
        maps = [{0: self._run(0, parts[0])}]
        for before, part in itertools.pairwise(parts):
            entry = self._run(0, before[-WARM:])[0]
            maps.append({entry: self._run(entry, part)})
        step = 1
        while step < len(parts):  # maps[k] is that of the chunks from k - step + 1 to k
            maps = maps[:step] + [self._compose(maps[k - step], maps[k], parts[max(0, k - step + 1) : k + 1]) for k in range(step, len(parts))]
            step *= 2
        return maps[-1][0][1]

    def _compose(self, first: dict[int, tuple[int, int]], then: dict[int, tuple[int, int]], chunks: list[bytes]) -> dict[int, tuple[int, int]]:
        """The map of both; ``chunks`` are those of the second."""
        out = {}
        for entry, (state, n) in first.items():
            if state not in then:
                then[state] = self._run(state, b"".join(chunks))
            out[entry] = then[state][0], n + then[state][1]
        return out

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Number of tokens of each word. What was met in this or the last ``WORDS`` distinct words is remembered."""
        out = list(map(self.known.get, words))
        for i, n in enumerate(out):
            if n is None:
                word = words[i]
                n = self.before.get(word)
                if n is None:
                    if len(self.states) > self.most_states:
                        self.clear()
                    n = self.count(word)
                out[i] = n
                if len(word) < 64:
                    if len(self.known) >= self.most_words:
                        self.before, self.known = self.known, {}
                    self.known[word] = n
        return np.array(out, np.int64)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_bytes, n_pretokens, n_tokens) of every row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(load(vocabulary))

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = resident("token counts", vocabulary, lambda: TokenTransducer(shared.value))
        for batch in batches:
            out = np.zeros((3, len(batch)), np.int64)
            for a, b, data, offsets in text_chunks(batch.column("text")):
                cuts, at = pretokens(data, offsets)
                which, words = distinct(data, cuts)
                total = np.r_[0, np.cumsum(transducer.counts(words)[which])]
                out[:, a:b] = np.diff(offsets), np.diff(at), total[at[1:]] - total[at[:-1]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, out)], ["doc_id", "n_bytes", "n_pretokens", "n_tokens"])

    return rows.mapInArrow(count, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_pretokens long, n_tokens long")
