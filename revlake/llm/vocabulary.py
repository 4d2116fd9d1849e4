"""Byte-level BPE vocabularies as ranks, and the plain merge loop that defines their encoding."""

from __future__ import annotations

import base64
import heapq
from pathlib import Path

#: A file of "base64 rank" lines. It is read on the driver and broadcast; its size doesn't depend on the data.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def load(path: str = VOCABULARY) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in Path(path).read_bytes().splitlines() if line.strip())}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the leftmost pair of least rank until none is left, by a heap over a linked list."""
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, e = heapq.heappop(heap)
        j = end[i]
        if not alive[i] or j >= n or end[j] != e:
            continue
        alive[j], end[i] = False, e
        if e < n:
            before[e] = i
            if (r := ranks.get(word[i : end[e]])) is not None:
                heapq.heappush(heap, (r, i, end[e]))
        if (h := before[i]) >= 0 and (r := ranks.get(word[h:e])) is not None:
            heapq.heappush(heap, (r, h, e))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def merges(ranks: dict[bytes, int]) -> list[tuple[int, int, int]]:
    """(left, right, merged): the last merge of each token's own encoding.

    Merges inside a token don't depend on what surrounds it, so no other pair of its parts ever becomes neighbours.
    """
    out = []
    for token, new in ranks.items():
        if len(token) > 1:
            parts = _parts(token, ranks, new)
            if len(parts) == 2:
                out.append((ranks[parts[0]], ranks[parts[1]], new))
    return out


def _parts(token: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """The token's encoding with merges of lower rank alone."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 1:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
        if rank >= below:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts
