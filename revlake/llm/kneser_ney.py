"""Interpolated modified Kneser-Ney smoothing over n-grams of bytes or tokens, as Spark joins between count tables.

A gram is one LONG, the first symbol highest: up to seven bytes, or up to three tokens of ``TOKEN_BITS`` (``tokens.py``).
Every text is preceded by ``order - 1`` zero symbols, so all contexts are whole. The counts of the highest order come
from the texts; a lower order counts the distinct symbols seen before a gram (continuation counts), so all orders derive
from one table. Count tables are sharded by context (a window over ``model, gram >> bits``) and joined to the next
lower order by suffix.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_chunks, tidy, written

ORDER = 5
#: A prime by which contexts are spread over the parts of a model's tables.
SPREAD = 1_000_003


def mask(k: int, bits: int = 8) -> int:
    return (1 << bits * k) - 1


def byte_grams(data: np.ndarray, offsets: np.ndarray, order: int, bits: int = 8) -> np.ndarray:
    """The gram that ends at each byte (or token of ``bits``) of the texts, as int64."""
    lengths, pad = np.diff(offsets), order - 1
    at = np.arange(len(data)) + np.repeat(np.arange(1, len(lengths) + 1) * pad, lengths)
    padded = np.zeros(len(data) + pad * len(lengths), np.int64)
    padded[at] = data
    grams = np.zeros(len(data), np.int64)
    for k in range(order):
        grams <<= bits
        grams |= padded[at - (pad - k)]
    return grams


def gram_counts(df: DataFrame, order: int = ORDER, grams_of: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """(model, gram, n) over all rows of (model STRING, text STRING); combined per task before the shuffle.

    ``grams_of`` gives the grams of (bytes, offsets) if they aren't byte n-grams.
    """
    grams_of = grams_of or (lambda data, offsets: byte_grams(data, offsets, order))

    @tidy
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts):
            grams = np.concatenate([g for g, _ in parts])
            counts = np.concatenate([c for _, c in parts])
            by = np.argsort(grams, kind="stable")
            grams, counts = grams[by], counts[by]
            first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
            return grams[first], np.add.reduceat(counts, first)

        for batch in batches:
            models = batch.column("model").to_pandas().to_numpy(object)
            for model in dict.fromkeys(models):
                part = batch.filter(pa.array(models == model))
                for _, _, data, offsets in text_chunks(part.column("text")):
                    if len(data):
                        parts = held.setdefault(model, [])
                        parts.append(np.unique(grams_of(data, offsets), return_counts=True))
                        if len(parts) > 8:
                            held[model] = [merged(parts)]
        for model, parts in held.items():
            grams, counts = merged(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([model] * len(grams), pa.string()), pa.array(grams, pa.int64()), pa.array(counts, pa.int64())],
                ["model", "gram", "n"],
            )

    return df.select("model", "text").where("model is not null").mapInArrow(partial, "model string, gram long, n long").groupBy("model", "gram").agg(F.sum("n").alias("n"))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Chen and Goodman's D1, D2, D3+, kept inside (0, k] where the counts of counts are too few to give them."""
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    raw = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), k + 0.95) for k, d in enumerate(raw))


def levels(counts: DataFrame, order: int = ORDER, bits: int = 8, symbols: int = 256) -> dict[int, DataFrame]:
    """{k: (model, gram, p, gamma, rank, stored)} for each order, as tables in the shared folder.

    ``p`` is the smoothed probability of the gram's last byte after the others; ``gamma`` the weight that the
    gram's context gives the next lower order; ``rank`` the last byte's place among the context's successors;
    ``stored`` the rank of the gram without its first byte: what a context-relative trie keeps. The base
    distribution is uniform over ``symbols``. A run of zero symbols, the context before a text, is in every order
    but the highest, with a count of 0 where no text has it; that changes no probability.
    """
    spark = counts.sparkSession
    tables, table = {}, written(counts, "grams")
    for k in range(order, 0, -1):
        seen = {
            r["model"]: discounts(r["n1"], r["n2"], r["n3"], r["n4"])
            for r in table.groupBy("model").agg(*[F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2, 3, 4)]).collect()
        }
        flat = [x for m, d in seen.items() for x in (F.lit(m), F.array(F.lit(0.0), *map(F.lit, d)))]
        by_model = F.create_map(*flat) if flat else F.create_map(F.lit(""), F.array(*[F.lit(0.0)] * 4))
        d = F.element_at(F.element_at(by_model, F.col("model")), F.least(F.col("n"), F.lit(3)).cast("int") + 1)
        context = Window.partitionBy("model", F.shiftright("gram", bits))
        total = F.sum("n").over(context)
        tables[k] = table.withColumn("d", d).select(
            "model", "gram", ((F.col("n") - F.col("d")) / total).alias("base"), (F.sum("d").over(context) / total).alias("gamma"),
            F.row_number().over(context.orderBy("gram")).cast("int").alias("rank"),
        )
        if k > 1:
            lower = table.where("n > 0").groupBy("model", F.col("gram").bitwiseAND(mask(k - 1, bits)).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
            before = spark.createDataFrame([(m, 0, 0) for m in seen], "model string, gram long, n long")
            table = written(lower.unionByName(before).groupBy("model", "gram").agg(F.sum("n").alias("n")), "grams")
    out: dict[int, DataFrame] = {}
    for k in range(1, order + 1):
        t = tables[k]
        if k == 1:
            t = t.select("model", "gram", (F.col("base") + F.col("gamma") / symbols).alias("p"), "gamma", "rank", F.col("rank").alias("stored"))
        else:
            low = out[k - 1].select("model", F.col("gram").alias("suffix"), F.col("p").alias("q"), F.col("rank").alias("stored"))
            t = t.withColumn("suffix", F.col("gram").bitwiseAND(mask(k - 1, bits))).join(low, ["model", "suffix"])
            t = t.select("model", "gram", (F.col("base") + F.col("gamma") * F.col("q")).alias("p"), "gamma", "rank", "stored")
        out[k] = written(t, f"level{k}")
    return out


class ProbabilityTables:
    """Sorted arrays of one model, joined to batches of grams by binary search, order by order.

    ``part(i)`` gives the grams, probabilities, contexts and their weights, of each order in turn, of those contexts that
    are ``i`` modulo ``SPREAD`` and ``parts``, or None if there are none; at most ``held`` parts are kept open.
    """

    def __init__(self, part: Callable[[int], list[np.ndarray] | None], parts: int, order: int, held: int | None = None):
        self.part, self.parts, self.order, self.held = part, parts, order, held
        self.open: dict[int, list[np.ndarray] | None] = {}

    def _part(self, i: int) -> list[np.ndarray] | None:
        if i not in self.open:
            if self.held and len(self.open) >= self.held:
                del self.open[next(iter(self.open))]
            self.open[i] = self.part(i)
        return self.open[i]

    def log2(self, grams: np.ndarray) -> np.ndarray:
        """log2 of the smoothed probability of each gram's last byte."""
        p = np.full(len(grams), 1 / 256)
        for k in range(1, self.order + 1):
            x = grams & mask(k)
            of = (x >> 8) % SPREAD % self.parts
            by = np.argsort(of, kind="stable")
            cuts = np.flatnonzero(np.r_[True, np.diff(of[by]) != 0, True]) if len(of) else []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own = by[a:b]
                tables = self._part(int(of[own[0]]))
                if tables is None or not len(tables[4 * k - 4]):
                    continue
                known, prob, contexts, gamma = tables[4 * k - 4 : 4 * k]
                y = x[own]
                i = np.minimum(np.searchsorted(known, y), len(known) - 1)
                j = np.minimum(np.searchsorted(contexts, y >> 8), len(contexts) - 1)
                weight = np.where(contexts[j] == y >> 8, gamma[j], 1.0)
                p[own] = np.where(known[i] == y, prob[i], weight * p[own])
        return np.log2(p)


class GramCache:
    """Open-addressed gram -> score table over a slower lookup; emptied when half full, so its size is fixed."""

    def __init__(self, lookup, bits: int = 21):
        self.lookup, self.size = lookup, 1 << bits
        self.shift = np.uint64(64 - bits)
        self.clear()

    def clear(self) -> None:
        self.keys = np.full(self.size, -1, np.int64)
        self.values = np.zeros(self.size, np.float32)
        self.held = 0

    def _slot(self, grams: np.ndarray) -> np.ndarray:
        return ((grams.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, grams: np.ndarray) -> np.ndarray:
        slot = self._slot(grams)
        out = self.values[slot]
        left = np.flatnonzero(self.keys[slot] != grams)
        if not len(left):
            return out
        missing, back = np.unique(grams[left], return_inverse=True)
        slot = self._slot(missing)
        found = np.empty(len(missing), np.float32)
        open_ = np.arange(len(missing))
        new = np.zeros(len(missing), bool)
        while len(open_):
            keys = self.keys[slot[open_]]
            hit = keys == missing[open_]
            found[open_[hit]] = self.values[slot[open_[hit]]]
            new[open_[keys == -1]] = True
            open_ = open_[~hit & (keys != -1)]
            slot[open_] = (slot[open_] + 1) & (self.size - 1)
        fresh = np.flatnonzero(new)
        if len(fresh):
            found[fresh] = self.lookup(missing[fresh])
            if self.held + len(fresh) > self.size // 2:
                self.clear()
            if len(fresh) <= self.size // 2:
                self._add(missing[fresh], found[fresh])
        out[left] = found[back]
        return out

    def _add(self, grams: np.ndarray, values: np.ndarray) -> None:
        self.held += len(grams)
        slot, open_ = self._slot(grams), np.arange(len(grams))
        while len(open_):
            free = open_[self.keys[slot[open_]] == -1]
            self.keys[slot[free]] = grams[free]  # of several that want a slot, the last stays
            won = self.keys[slot[open_]] == grams[open_]
            self.values[slot[open_[won]]] = values[open_[won]]
            open_ = open_[~won]
            slot[open_] = (slot[open_] + 1) & (self.size - 1)


def text_log2(cache: GramCache, data: np.ndarray, offsets: np.ndarray, order: int, bits: int = 8) -> np.ndarray:
    """Sum of the log2 probabilities of each text's symbols."""
    sums = np.zeros(len(offsets) - 1)
    if len(data):
        total = np.r_[0.0, np.cumsum(cache.get(byte_grams(data, offsets, order, bits)), dtype=np.float64)]
        sums = total[offsets[1:]] - total[offsets[:-1]]
    return sums


__all__ = ["ORDER", "SPREAD", "GramCache", "ProbabilityTables", "byte_grams", "discounts", "gram_counts", "levels", "mask", "text_log2"]
