"""Near-duplicate groups by ProbMinHash signatures, banding and exact verification.

A document is the multiset of its word shingles. Each shingle of weight w is a Poisson process of rate w whose
arrivals fall on random components of the signature; a component keeps the shingle that arrives first, and a
shingle stops once its next arrival is later than every component of its document. Two signatures then agree in
a component with the probability Jaccard similarity of the two documents. Equal runs of components (bands)
make candidates, which the exact probability Jaccard of the two texts confirms or rejects.

Equal texts are collapsed before anything else, so the nodes are distinct texts. Buckets are combined before they are
shuffled: of the nodes that a batch has in one bucket only the least is, and the others are its candidates. Each
node is verified against that one, and those against the bucket's least node. Where all of a bucket verify they are
joined through it. In a bucket where some don't, every pair of nodes that aren't joined yet is searched by an exact prefix
filter rather than listed: shingles are ordered by how rare they are. If x and y share shingles of a share P of x and Q of y, their
similarity is at most 1 / (1/P + 1/Q - 1), so at the threshold t both are at least t and one of them is at least 2t / (1 + t).
The rarest shared shingle is therefore among the rarest of one node that make up (1 - t) / (1 + t) of it, and among those of
the other that make up 1 - t. Texts that have only a template in common share no such shingle, and only pairs that do are verified. The
groups are the connected components of all candidate pairs that verify.

A null or empty text is in no group. Texts without words group only when equal. Repeated rows, and rows with
one id and several texts, are told apart by text; of a group the row with the least id stays (a null id comes last, equal
rows stay once).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bitmap import bitmap, may_hold
from .common import map_file, put_file, resident, shared_dir, tidy, written
from .words import distinct_by_row, mix, shingle_hashes, word_chunks

SHINGLE = 3
BANDS, ROWS = 36, 4
THRESHOLD = 0.5
#: Hash values in one file of frequencies of shingles, and most of them.
SLICE, MOST_SLOTS = 1 << 20, 1 << 26
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def prob_minhash(value: np.ndarray, row: np.ndarray, weight: np.ndarray, rows: int, m: int) -> np.ndarray:
    """[rows, m] shingles that arrive first; -1 in rows without shingles."""
    first = np.full(rows * m, np.inf)
    signature = np.full(rows * m, -1, np.int64)
    live, at, k = np.arange(len(value)), np.zeros(len(value)), 0
    seed = mix(value + _GOLD)
    while len(live):
        block = int(np.clip((1 << 17) // len(live), 1, 64))
        z = mix(seed[live, None] + _GOLD * np.arange(k + 1, k + block + 1, dtype=np.uint64))
        k += block
        gap = np.log(((z >> np.uint64(24)).astype(np.float64) + 0.5) * 2.0**-40)
        gap /= -weight[live, None]
        times = np.cumsum(gap, axis=1) + at[:, None]
        slot = row[live, None] * m + ((z & np.uint64(0xFFFFFF)) * np.uint64(m) >> np.uint64(24)).astype(np.int64)
        early = times < first[slot]
        t, s = times[early], slot[early]
        np.minimum.at(first, s, t)
        won = first[s] == t
        signature[s[won]] = np.broadcast_to(value[live, None], slot.shape)[early][won].astype(np.int64)
        own = np.unique(row[live])
        last = np.zeros(rows)
        last[own] = first.reshape(rows, m)[own].max(axis=1)
        at = times[:, -1]
        go = at < last[row[live]]
        live, at = live[go], at[go]
    return signature.reshape(rows, m)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """[documents, bands] keys that are equal where a whole band is, and else differ between bands too."""
    s = signature.view(np.uint64).reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) * _GOLD, s.shape[:2])
    for j in range(rows):
        key = mix(key ^ s[:, :, j]) + _GOLD
    return key.view(np.int64)


def probability_jaccard(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum over shared i of 1 / sum_j max(x_j / x_i, y_j / y_i), for (sorted values, weights)."""
    if not len(x[0]) or not len(y[0]):
        return 0.0
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    xi, yj = x[1][i].astype(np.float64), y[1][j].astype(np.float64)
    only_x, only_y = x[1].sum() - xi.sum(), y[1].sum() - yj.sum()
    ratio = xi / yj
    by = np.argsort(-ratio, kind="stable")
    xi, yj, ratio = xi[by], yj[by], ratio[by]
    upto = np.searchsorted(-ratio, -ratio, "right")
    big = only_x + np.cumsum(xi)[upto - 1]
    small = only_y + yj.sum() - np.cumsum(yj)[upto - 1]
    return float(np.sum(1 / (big / xi + small / yj)))


def _signatures(df: DataFrame, bands: int, rows: int, shingle: int) -> DataFrame:
    """(node, id, row, bands) of (node, id, row, text); bands is null for texts without words."""

    @tidy
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words, at in word_chunks(batch.column("text")):
                value, row, count = distinct_by_row(*shingle_hashes(words, at, shingle), b - a)
                keys = band_keys(prob_minhash(value, row, count, b - a, bands * rows), bands, rows)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1) * bands, pa.int32()), pa.array(keys.ravel()), mask=pa.array(np.diff(at) == 0))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in ("node", "id", "row")), lists], ["node", "id", "row", "bands"])

    kind = df.schema["id"].dataType.simpleString()
    return df.select("node", "id", "row", "text").mapInArrow(sign, f"node binary, id {kind}, row long, bands array<long>")


def _multisets(column: pa.Array, shingle: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(distinct shingles, counts) of each text."""
    for a, b, words, at in word_chunks(column):
        value, row = shingle_hashes(words, at, shingle)
        cut = np.searchsorted(row, np.arange(b - a + 1))
        yield from (np.unique(value[i:j], return_counts=True) for i, j in zip(cut[:-1], cut[1:], strict=True))


def _verify(pairs: DataFrame, texts: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """(a, b, similarity, same) of pairs (a, b); each text travels once for each side it is on."""
    both = pairs.join(texts.withColumnsRenamed({"node": "a", "text": "ta"}), "a").join(texts.withColumnsRenamed({"node": "b", "text": "tb"}), "b")

    @tidy
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = zip(_multisets(batch.column("ta"), shingle), _multisets(batch.column("tb"), shingle), strict=True)
            s = np.array([probability_jaccard(x, y) for x, y in sets])
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(s), pa.array(s >= threshold)], ["a", "b", "similarity", "same"])

    return both.select("a", "b", "ta", "tb").mapInArrow(verify, "a binary, b binary, similarity double, same boolean")


def _banded(nodes: DataFrame) -> DataFrame:
    """(band, node, least) of each node: the least node that its batch has in the band, which alone needs a shuffle."""

    @tidy
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("bands").is_valid())
            batch = batch.take(pc.sort_indices(batch.column("node")))
            lists = batch.column("bands")
            band, row = np.asarray(lists.flatten()), np.asarray(pc.list_parent_indices(lists))
            by = np.argsort(band, kind="stable")
            band, row = band[by], row[by]
            first = np.flatnonzero(np.r_[True, band[1:] != band[:-1]]) if len(band) else np.zeros(0, np.int64)
            least = np.repeat(row[first], np.diff(np.r_[first, len(band)]))
            node = batch.column("node")
            yield pa.RecordBatch.from_arrays([pa.array(band), node.take(pa.array(row)), node.take(pa.array(least))], ["band", "node", "least"])

    return nodes.select("node", "bands").mapInArrow(combine, "band long, node binary, least binary")


def rarity(texts: DataFrame, n: int, shingle: int) -> dict:
    """Files of how many of the ``n`` texts have the shingles of each hash value, up to 255.

    Any order of shingles is right; one by these counts is quick. A shingle whose hash value has a count of 1 is in one text only.
    """
    folder, slots = shared_dir(texts.sparkSession, "rarity"), min(MOST_SLOTS, max(SLICE, 1 << (512 * n).bit_length()))

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, codec = np.zeros(slots, np.uint8), pa.Codec("zstd", compression_level=1)
        for batch in batches:
            for value, _ in _multisets(batch.column("text"), shingle):
                slot, more = np.unique((value % np.uint64(slots)).astype(np.int64), return_counts=True)
                total[slot] = np.minimum(total[slot] + np.minimum(more, 255).astype(np.uint16), 255)
        for s in range(slots // SLICE):
            part = total[s * SLICE : (s + 1) * SLICE]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([codec.compress(part.tobytes(), asbytes=True)], pa.binary())], ["slice", "counts"])

    @tidy
    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        codec = pa.Codec("zstd")
        for batch in batches:
            for s, data in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                more = np.frombuffer(codec.decompress(data, SLICE, asbytes=True), np.uint8)
                held[s] = np.minimum(held.get(s, np.zeros(SLICE, np.uint16)) + more, 255).astype(np.uint16)
        for s, counts in held.items():
            put_file(f"{folder}/{s}.n", counts.astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32())], ["slice"])

    counts = texts.mapInArrow(count, "slice int, counts binary")
    made = [r["slice"] for r in counts.repartition(slots // SLICE, "slice").mapInArrow(put, "slice int").collect()]
    return {"folder": folder, "made": made, "slots": slots}


class Rarity:
    def __init__(self, folder: str, made: list[int], slots: int):
        self.slots, self.slices = slots, {s: map_file(f"{folder}/{s}.n") for s in made}

    def of(self, value: np.ndarray) -> np.ndarray:
        slot, out = (value % np.uint64(self.slots)).astype(np.int64), np.zeros(len(value), np.int64)
        for s in np.unique(slot // SLICE).tolist():
            own = slot // SLICE == s
            if s in self.slices:
                out[own] = self.slices[s][slot[own] % SLICE]
        return out


def prefix(value: np.ndarray, count: np.ndarray, often: np.ndarray, share: float) -> np.ndarray:
    """Places of the rarest values, in order, up to the first that make up more than ``share`` of the counts."""
    by = np.lexsort((value, often))
    before = np.cumsum(count[by]) - count[by]
    return by[before <= share * count.sum() * (1 + 1e-9)]


def _unjoined(members: DataFrame, texts: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """(a, b) of nodes of one band of ``members`` (node, root, bands) with different roots whose similarity may reach the threshold."""
    members = written(members.select(F.monotonically_increasing_id().alias("member"), "node", F.xxhash64("root").alias("root"), "bands"), "numbered")
    counted = rarity(texts.join(members.select("node"), "node", "left_semi").select("text"), members.count(), shingle)

    @tidy
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = resident("rarity", counted["folder"], lambda: Rarity(**counted))
        for batch in batches:
            out, size = [], 0
            for k, ((value, count), bands) in enumerate(zip(_multisets(batch.column("text"), shingle), batch.column("bands"), strict=True)):
                often = held.of(value)
                own = prefix(value, count, often, 1 - threshold)
                strong = np.arange(len(own)) < len(prefix(value, count, often, (1 - threshold) / (1 + threshold)))
                shared = often[own] > 1
                own, strong = mix(value[own[shared]]), strong[shared]
                for band in np.asarray(bands.values).view(np.uint64):
                    out.append((k, mix(own ^ mix(np.array([band])))[: len(own)].view(np.int64), strong))
                    size += len(own)
                if size > 1 << 18 or k == len(batch) - 1:
                    row = np.repeat([k for k, *_ in out], [len(x) for _, x, _ in out]).astype(np.int64)
                    columns = [pa.array(np.concatenate([x for _, x, _ in out])), *(batch.column(c).take(pa.array(row)) for c in ("member", "root")), pa.array(np.concatenate([s for *_, s in out]))]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "member", "root", "strong"])
                    out, size = [], 0

    rows = members.join(texts, "node").select("member", "root", "bands", "text").mapInArrow(keys, "key long, member long, root long, strong boolean")
    rows = written(rows, "prefixes")
    strong = rows.where("strong").select("key", F.col("member").alias("x"), F.col("root").alias("rx"))
    found = strong.join(rows.select("key", F.col("member").alias("y"), F.col("root").alias("ry")), "key").where("rx != ry")
    found = found.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    named = members.select("member", "node")
    both = found.join(named.withColumnsRenamed({"member": "x", "node": "a"}), "x").join(named.withColumnsRenamed({"member": "y", "node": "b"}), "y")
    return both.select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each node's component, by alternating large and small stars."""
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        around = Window.partitionBy("u")
        large = both.withColumn("m", F.least("u", F.min("v").over(around))).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        w = large.withColumn("m", F.min("v").over(around))
        small = w.select("u", F.col("m").alias("v")).union(w.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        edges = written(small, "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64(F.lit(1), "v", "u"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def _nodes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.unhex(F.md5(text)).alias("node"), F.col(f"`{id_col}`").alias("id"), text.alias("text")).where("text != ''")


def _groups(docs: DataFrame, id_col: str, text_col: str, threshold: float, bands: int, rows: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """((node, id, n, kept, kept_node, kept_row) of every text: its least id, its rows, and what stays of its group; (node, id, row) of all rows)."""
    source = _nodes(docs, id_col, text_col)
    signed = written(_signatures(source.withColumn("row", F.monotonically_increasing_id()), bands, rows, shingle), "signatures")
    least = F.min_by("row", F.struct(F.col("id").isNull(), "id", "row"))
    nodes = written(signed.groupBy("node").agg(F.min("id").alias("id"), least.alias("row"), F.count("*").alias("n"), F.first("bands").alias("bands")), "nodes")
    banded = _banded(nodes)
    linked = written(banded.where("node != least"), "linked")
    bucket = Window.partitionBy("band")
    buckets = banded.where("node = least").select("band", "node", F.min("node").over(bucket).alias("least"), F.count("*").over(bucket).alias("size"))
    buckets = written(buckets.where("size > 1").select("band", "node", "least"), "buckets")
    steps = linked.unionByName(buckets.where("node != least"))
    pairs = written(steps.select(F.col("node").alias("a"), F.col("least").alias("b")).distinct(), "pairs")
    wanted = written(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "wanted")
    may = bitmap(wanted, wanted.count())
    once = source.select("node", "text").where(may_hold(F.col("node"), may)).groupBy("node").agg(F.first("text").alias("text"))  # copies meet in their tasks
    texts = written(once.join(wanted, "node", "left_semi"), "texts")
    verified = written(_verify(pairs, texts, threshold, shingle), "verified")
    root = components(verified.where("same").select("a", "b"))
    open_ = written(steps.join(verified.where("not same").select(F.col("a").alias("node"), F.col("b").alias("least")), ["node", "least"], "left_semi").select("band").distinct(), "open")
    if open_.limit(1).count():
        root = written(root, "roots")
        inside = linked.select("band", "node").union(linked.select("band", "least")).union(buckets.select("band", "node")).join(open_, "band", "left_semi").distinct()
        members = inside.groupBy("node").agg(F.collect_list("band").alias("bands")).join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
        members = written(members.select("node", "root", "bands"), "members")
        more = _verify(written(_unjoined(members, texts, threshold, shingle), "more"), texts, threshold, shingle).where("same")
        named = members.select("node", "root")
        between = more.join(named.withColumnsRenamed({"node": "a", "root": "u"}), "a").join(named.withColumnsRenamed({"node": "b", "root": "v"}), "b")
        above = components(between.select(F.col("u").alias("a"), F.col("v").alias("b"))).select(F.col("node").alias("root"), F.col("root").alias("above"))
        # a root is in no row of its own: its component may still have been joined to another
        every = root.union(root.select("root", "root")).union(named).distinct()
        root = every.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
    joined = nodes.select("node", "id", "row", "n").join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = F.struct(F.col("id").isNull(), "id", "node")
    least = joined.groupBy("root").agg(F.min("id").alias("kept"), F.min_by("node", first).alias("kept_node"), F.min_by("row", first).alias("kept_row"))
    return written(joined.join(least, "root").select("node", "id", "n", "kept", "kept_node", "kept_row"), "groups"), signed.select("node", "id", "row")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE
) -> DataFrame:
    """(doc_id, duplicate_of): every row that goes, with the least id of its group."""
    groups, all_rows = _groups(docs, id_col, text_col, threshold, bands, rows, shingle)
    multiple = groups.where("n > 1 or node != kept_node").select("node", "kept", "kept_row")
    return all_rows.join(multiple, "node").where("row != kept_row").select(F.col("id").alias("doc_id"), F.col("kept").alias("duplicate_of"))


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE
) -> DataFrame:
    """The rows that stay: all columns of ``docs``, one row of each group."""
    groups, all_rows = _groups(docs, id_col, text_col, threshold, bands, rows, shingle)
    node = F.unhex(F.md5(F.col(f"`{text_col}`").cast("string")))
    rest = groups.where("n > 1 or node != kept_node").select("node", F.when(F.col("node") == F.col("kept_node"), F.col("id")).alias("keeper"), (F.col("node") == F.col("kept_node")).alias("stays"))
    rest = written(rest, "rest")
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), node.alias("node"), F.col(f"`{id_col}`").alias("id"))
    marked = marked.withColumn("may", may_hold(F.col("node"), bitmap(rest.select("node"), rest.count())))
    alone = marked.where("not may").select("row.*")
    marked = marked.where("may").join(rest, "node", "left")
    if not all_rows.groupBy("node", "id").count().where("count > 1").limit(1).count():
        return alone.union(marked.where("stays is null or (stays and id <=> keeper)").select("row.*"))
    once = marked.where("stays and id <=> keeper").groupBy("node").agg(F.first("row").alias("row"))
    return alone.union(marked.where("stays is null").select("row.*")).union(once.select("row.*"))
