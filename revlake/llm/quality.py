"""Quality classifier: Kneser-Ney perplexity under models of trusted text, cut at quantiles of each language.

Trusted documents are those labelled of good quality and not toxic. All of them are used: of each language four of five (by
a hash of id) to count n-grams, whose sharded tables are joined order by order into smoothed probabilities, the fifth
to find the quantile of perplexity that trusted text stays below. The score of a text is its perplexity per byte, drawn
towards the language's median as if ``PRIOR`` bytes of median text preceded it, so a few odd words don't condemn a short
text. Digits count as one symbol: numbers are no sign of quality.

The joined tables of a language are files of some ``PART_GRAMS`` grams each, by context; tasks map them into memory.

A document in a language without trusted text (or without a language) has no model: perplexity, score and
threshold are null and it is kept. So is a null or empty text. Rows with equal ids are scored each on its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmap import bitmap, may_hold
from .common import map_file, put_file, resident, shared_dir, text_chunks, tidy, written
from .kneser_ney import ORDER, SPREAD, GramCache, ProbabilityTables, gram_counts, levels, text_log2
from .lm_trie import pack, unpack

QUANTILE = 0.99
PRIOR = 50
#: Bits by which sums over the same text may differ: a trusted text on the threshold is kept.
ROUNDING = 1e-5
#: Most trusted ids that are broadcast to find their texts; beyond, a shuffled join finds them.
BROADCAST_ROWS = 500_000
#: Grams of all orders in one file of a model's tables, about.
PART_GRAMS = 1 << 19
_DIGITS = bytes.maketrans(b"123456789", b"000000000")


def trusted_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, trusted: int | None = None) -> DataFrame:
    """(model, text, held) of all trusted documents, or of some ``trusted`` of each language, in the shared folder."""
    good = labels.where("quality = 1 and toxic = 0").select(F.col("doc_id").alias("id")).distinct()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").alias("model"), F.col(f"`{text_col}`").cast("string").alias("text"))
    known = rows.where("model is not null").select("id", "model").join(good, "id", "left_semi").distinct()
    if trusted is not None:
        known = written(known, "trusted")
        share = known.groupBy("model").agg(F.count("*").cast("double").alias("n"))
        part = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1_000_000
        known = known.join(F.broadcast(share), "model").where(part < F.lit(trusted) / F.col("n")).select("id", "model")
    known = written(known, "known")
    count = known.count()
    rows = rows.where("text != ''")
    if count <= BROADCAST_ROWS:
        known = F.broadcast(known)
    else:  # texts that can't be trusted stay out of the shuffle
        node = F.unhex(F.md5(F.col("id").cast("string")))
        rows = rows.where(may_hold(node, bitmap(known.select(node.alias("node")), count)))
    rows = rows.join(known, ["id", "model"], "left_semi")
    return written(rows.select("model", F.translate("text", "123456789", "0" * 9).alias("text"), (F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(5)) == 0).alias("held")), "texts")


def write_models(texts: DataFrame, order: int) -> dict[str, dict]:
    """{language: what ``_open`` takes}."""
    every = None
    for k, t in levels(gram_counts(texts, order), order).items():
        t = t.select("model", F.lit(k).alias("k"), "gram", "p", "gamma")
        every = t if every is None else every.unionByName(t)
    sizes = {r["model"]: r["count"] for r in every.groupBy("model").count().collect()}
    if not sizes:
        return {}
    folder = shared_dir(texts.sparkSession, "quality")
    models = {m: {"folder": f"{folder}/{i}", "parts": n // PART_GRAMS | 1, "made": [], "order": order} for i, (m, n) in enumerate(sorted(sizes.items()))}
    flat = [x for i, (m, v) in enumerate(models.items()) for x in (F.lit(m), F.array(F.lit(i), F.lit(v["parts"])))]
    place = F.element_at(F.create_map(*flat), F.col("model"))
    part = (F.shiftright("gram", 8) % SPREAD % F.element_at(place, 2)).cast("int")
    placed = every.select(F.element_at(place, 1).alias("number"), part.alias("part"), "k", "gram", "p", "gamma")

    @tidy
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The rows are sorted, so a part is whole when the next one begins.
        held: list[list[np.ndarray]] = []
        name, numbers, parts = None, [], []

        def put() -> None:
            k, gram, p, gamma = (np.concatenate(c) for c in zip(*held, strict=True))
            arrays = []
            cuts = np.searchsorted(k, np.arange(1, order + 2))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                context = gram[a:b] >> 8
                first = np.flatnonzero(np.diff(context, prepend=-1))
                arrays += [gram[a:b], p[a:b].astype(np.float32), context[first], gamma[a:b][first].astype(np.float32)]
            put_file(f"{folder}/{name[0]}/{name[1]}.tables", pack(arrays))
            numbers.append(name[0])
            parts.append(name[1])
            held.clear()

        for batch in batches:
            number, part, *columns = (batch.column(c).to_numpy() for c in ("number", "part", "k", "gram", "p", "gamma"))
            cuts = np.flatnonzero(np.r_[True, (np.diff(number) != 0) | (np.diff(part) != 0), True]) if len(number) else []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if held and name != (number[a], part[a]):
                    put()
                name = number[a], part[a]
                held.append([c[a:b] for c in columns])
        if held:
            put()
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(parts, pa.int32())], ["number", "part"])

    by_number = list(models.values())
    tasks = sum(v["parts"] for v in by_number)
    for r in placed.repartition(tasks, "number", "part").sortWithinPartitions("number", "part", "k", "gram").mapInArrow(write, "number int, part int").collect():
        by_number[r["number"]]["made"].append(r["part"])
    return models


def _open(folder: str, parts: int, made: list[int], order: int) -> GramCache:
    known = frozenset(made)

    def part(i: int) -> list[np.ndarray] | None:
        return unpack(map_file(f"{folder}/{i}.tables")) if i in known else None

    return GramCache(ProbabilityTables(part, parts, order, None if folder.startswith("file:") else 16).log2, bits=19)


def _bits(lang: pa.Array, text: pa.Array, models: dict[str, dict], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, total bits) of each text; NaN bits where there is no model."""
    n, bits = np.zeros(len(text), np.int64), np.full(len(text), np.nan)
    names = np.asarray(lang.to_pylist(), object)
    for name in dict.fromkeys(names.tolist()):
        own = np.flatnonzero([x == name for x in names])
        cache = resident("quality", models[name]["folder"], lambda name=name: _open(**models[name]), 8) if name in models else None
        for a, b, data, offsets in text_chunks(text.take(pa.array(own))):
            n[own[a:b]] = np.diff(offsets)
            if cache:
                plain = np.frombuffer(data.tobytes().translate(_DIGITS), np.uint8)
                bits[own[a:b]] = -text_log2(cache, plain, offsets, order)
    return n, bits


class Classifier:
    """Models and thresholds; both are a few numbers and the place of the tables for each language."""

    def __init__(self, models: dict[str, dict], median: dict[str, float], threshold: dict[str, float], order: int):
        self.models, self.median, self.threshold, self.order = models, median, threshold, order

    def score(self, lang: pa.Array, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, bits per byte, score in bits, threshold in bits); NaN where there is none."""
        n, bits = _bits(lang, text, self.models, self.order)
        names = lang.to_pylist()
        median = np.array([self.median.get(x, np.nan) for x in names])
        limit = np.array([self.threshold.get(x, np.nan) for x in names])
        empty = n == 0
        with np.errstate(invalid="ignore"):
            return n, np.where(empty, np.nan, bits / np.maximum(n, 1)), np.where(empty, np.nan, (bits + PRIOR * median) / (n + PRIOR)), limit

    def keeps(self, lang: pa.Array, text: pa.Array) -> np.ndarray:
        _, _, score, limit = self.score(lang, text)
        return ~(score > limit + ROUNDING)


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", trusted: int | None = None, quantile: float = QUANTILE, order: int = ORDER
) -> Classifier:
    texts = trusted_texts(docs, labels, id_col, text_col, lang_col, trusted)
    models = write_models(texts.where("not held"), order)

    @tidy
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, bits = _bits(batch.column("model"), batch.column("text"), models, order)
            yield pa.RecordBatch.from_arrays([batch.column("model"), pa.array(n), pa.array(bits, mask=np.isnan(bits))], ["model", "n", "bits"])

    scored = written(texts.where("held").mapInArrow(score, "model string, n long, bits double").where("bits is not null"), "held")
    median = {r["model"]: r["m"] for r in scored.groupBy("model").agg(F.expr("percentile(bits / n, 0.5)").alias("m")).collect()}
    flat = [x for m, v in median.items() for x in (F.lit(m), F.lit(v))]
    if not flat:
        return Classifier({}, {}, {}, order)
    drawn = (F.col("bits") + PRIOR * F.element_at(F.create_map(*flat), F.col("model"))) / (F.col("n") + PRIOR)
    limit = {r["model"]: r["t"] for r in scored.groupBy("model").agg(F.percentile(drawn, F.lit(quantile)).alias("t")).collect()}
    return Classifier({m: v for m, v in models.items() if m in limit}, median, limit, order)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """(doc_id, lang, n_bytes, perplexity, score, threshold, keep) of every row."""
    model = fit(docs, labels, id_col, text_col, lang_col, **options)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))

    @tidy
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, bits, drawn, limit = model.score(batch.column("lang"), batch.column("text"))
            values = [pa.array(np.exp2(x), mask=np.isnan(x)) for x in (bits, drawn, limit)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(n), *values, pa.array(~(drawn > limit + ROUNDING))], ["doc_id", "lang", "n_bytes", "perplexity", "score", "threshold", "keep"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, lang string, n_bytes long, perplexity double, score double, threshold double, keep boolean")


def drop_low_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the classifier keeps."""
    model = fit(docs, labels, id_col, text_col, lang_col, **options)
    lang, text = docs.columns.index(lang_col), docs.columns.index(text_col)

    @tidy
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.keeps(batch.column(lang).cast(pa.string()), batch.column(text).cast(pa.string()))))

    return docs.mapInArrow(keep, docs.schema)
