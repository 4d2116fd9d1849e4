"""The engine's operators bound to the driver's tables; ``oracle.sql`` has the SQL that gives the same rows.

``lineitem`` stands in for a multi-vintage log keyed by order and line, ``events`` for a capture log per user, ``orders``
for report and release rows, ``supplier``, ``nation`` and ``region`` for the registry.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlake.functions import scalar as S
from revlake.operators import bitemporal as B
from revlake.operators import capture as C
from revlake.operators import manifest as M
from revlake.operators import quality as Q
from revlake.operators import release as R
from revlake.operators import stitch as T
from revlake.sources import archives, html
from revlake.streaming import ingest as streaming

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {m[1]: m[2].strip() for m in re.finditer(r"^-- (\w+)\n(.*?);$", Path(__file__).with_name("oracle.sql").read_text(), re.S | re.M)}

#: Dates leave as timestamps, which both engines hand over in one form.
DATES = {
    "stitch": "d", "derive_release": "release_date", "report_date_for_release": "report_date", "interval_gaps": "d", "flow_state": "d",
    "tumbling": "d", "first_sighting": "report_date", "dedup_values": "d", "release_precedence": "release_date", "schedule_map": "report_date", "heading_span": "announcement_date",
}
ORACLE |= {name: f"select * replace (cast({c} as timestamp) as {c}) from (\n{ORACLE[name]}\n)" for name, c in DATES.items()}

KEY = ["l_orderkey", "l_linenumber"]
VINTAGE = ["l_shipdate", "l_partkey", "l_suppkey"]


def query(f: Callable[[Callable[..., DataFrame]], DataFrame]):
    """Register a query that is given a reader of the tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = f(lambda name, *columns: spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns or "*"))
        return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c, kind in out.dtypes if kind == "date"})

    QUERIES[f.__name__] = run
    return f


@query
def pit_asof(t):
    return B.asof(t("lineitem", *KEY, *VINTAGE, "l_quantity"), F.expr("timestamp_ntz '1998-06-30 00:00:00'"), KEY, VINTAGE)


@query
def change_only(t):
    return B.change_only(t("lineitem", *KEY, *VINTAGE, "l_returnflag", "l_linestatus"), KEY, VINTAGE, F.concat("l_returnflag", "l_linestatus"))


@query
def field_revisions(t):
    fields = {"quantity": "l_quantity", "discount": "l_discount", "tax": "l_tax"}
    return B.field_revisions(t("lineitem", *KEY, *VINTAGE, *fields.values()), KEY, VINTAGE, fields, 6)


@query
def row_hash(t):
    fields = {"quantity": S.canonical_value(F.col("l_quantity"), "double"), "flag": S.canonical_value(F.col("l_returnflag"), "string")}
    return t("lineitem").select(*KEY, "l_partkey", "l_suppkey", S.row_hash(fields).alias("row_sha256"))


@query
def melt(t):
    values = {"quantity": F.col("l_quantity"), "discount": F.nullif("l_discount", F.lit(0.0)), "tax": F.col("l_tax")}
    return B.melt(t("lineitem"), [*KEY, "l_partkey", "l_suppkey"], {n: {"val": c} for n, c in values.items()})


@query
def coerce_suppressed(t):
    raw = F.when(F.col("event_type") == "error", S.SUPPRESSED).otherwise(F.round("value", 2).cast("string"))
    return t("events").select("event_id", S.to_number(raw).alias("v"))


@query
def standardize_code(t):
    return t("part").select("p_partkey", S.standard_code(F.col("p_partkey")).alias("code"))


@query
def zero_sum(t):
    n = lambda flag: F.when(F.col("l_returnflag") == flag, F.col("l_quantity").cast("long"))
    sides = t("lineitem").select("l_suppkey", n("A").alias("a"), n("R").alias("r"), n("N").alias("n"))
    return Q.zero_sum(sides, ["l_suppkey"], "a", "r", "n", None).drop("oi_gap")


@query
def null_rate(t):
    return Q.null_rate(t("lineitem").withColumnRenamed("l_returnflag", "category"), ["category"], {"null_rate": F.nullif("l_tax", F.lit(0.0))}).withColumn("null_rate", F.round("null_rate", 6))


@query
def dup_keys(t):
    return Q.duplicate_keys(t("lineitem"), KEY)


@query
def vocab_violations(t):
    events = t("events")
    words = events.sparkSession.createDataFrame([("click",), ("view",), ("purchase",)], "event_type string")
    return Q.outside_vocabulary(events, words, ["event_type"]).groupBy("event_type").agg(F.count("*").alias("n"))


@query
def oi_breach(t):
    parts = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice")
    return Q.side_breach(parts, t("orders"), "o_orderkey", "l_extendedprice", "o_totalprice").select("o_orderkey", "o_totalprice", F.round("side_total", 2).alias("side_total"))


@query
def coverage(t):
    return Q.coverage(t("lineitem"), "l_partkey", "l_shipdate", None)


@query
def coverage_changes(t):
    return Q.coverage_changes(t("lineitem").select(F.year("l_shipdate").alias("report_year"), F.col("l_partkey").alias("market_code")))


@query
def latest_name(t):
    return t("supplier").groupBy("s_nationkey").agg(Q.latest_name("s_name", "s_suppkey").alias("latest_name")).where("latest_name is not null")


@query
def stitch(t):
    """Every code: the lower half of the suppliers' range are current, the upper half their predecessors."""
    rows = t("lineitem").groupBy(F.col("l_suppkey").alias("code"), F.col("l_shipdate").cast("date").alias("d")).agg(F.sum(F.col("l_quantity").cast("long")).cast("double").alias("q"))
    half = (t("supplier").count() + 1) // 2
    old = F.array(F.struct((F.col("s_suppkey") + half).alias("code"), F.lit(4.0).alias("scale")))
    registry = t("supplier").where(F.col("s_suppkey") < half).select(F.col("s_suppkey").alias("code"), F.col("s_suppkey").alias("symbol"), old.alias("predecessors"))
    return T.stitch(rows, T.code_names(registry), "code", "d", ["q"]).select(F.col("symbol").alias("sym"), "d", "q", F.col("priority").alias("pri"))


@query
def derive_release(t):
    return t("orders").select("o_orderkey", S.derive_release(F.col("o_orderdate")).alias("release_date"))


@query
def report_date_for_release(t):
    return t("orders").select("o_orderkey", S.report_date_for_release(F.col("o_orderdate")).alias("report_date"))


@query
def release_precedence(t):
    seen = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min(F.col("l_shipdate").cast("date")).alias("first_seen"))
    rows = t("orders").join(seen, "o_orderkey", "left").withColumn("rd", F.col("o_orderdate").cast("date"))
    given = lambda cond, days: F.when(cond, F.date_add("rd", days))
    date, source = S.resolve_release(F.col("rd"), given(F.col("o_orderpriority") == "1-URGENT", 1), S.observed_within(F.col("first_seen"), F.col("rd")), given(F.col("o_orderstatus") == "F", 5), given(F.col("o_orderstatus") == "O", 6))
    return rows.select("o_orderkey", source.alias("src"), date.alias("release_date"))


@query
def schedule_map(t):
    source = F.when(F.col("o_orderstatus") == "P", "published").when(F.col("o_orderstatus") == "F", "announced").otherwise("scheduled")
    rows = t("orders").select(F.col("o_orderdate").cast("date").alias("report_date"), F.date_add(F.lit("1970-01-01").cast("date"), F.col("o_orderkey").cast("int")).alias("release_date"), source.alias("source"), F.col("o_orderdate").alias("ingested_at"))
    return R.best_schedule(rows).select("report_date", "source", F.datediff("release_date", F.lit("1970-01-01")).cast("long").alias("o_orderkey"))


@query
def newest_plan(t):
    return R.newest_plan(t("orders", "o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], "o_orderdate")


@query
def source_counts(t):
    source = F.when(F.col("o_orderstatus") == "P", "published").when(F.col("o_orderstatus") == "F", "announced").otherwise("scheduled")
    return R.source_counts(t("orders").select(source.alias("release_date_source")))


@query
def latest_with_content(t):
    kind = F.col("event_type")
    return C.latest_matching(t("events"), "user_id", "event_id", ["ts"], {"last_any": F.lit(True), "last_content": kind != "error", "last_delivery": kind.isin("click", "purchase")})


@query
def blind_alert(t):
    kind = F.col("event_type")
    return C.blind_alerts(t("events"), "user_id", "ts", kind.isin("click", "purchase"), kind == "view", F.expr("interval 2 day")).select("user_id", "event_id", "ts")


@query
def manifest_summary(t):
    entries = t("events").select(F.col("event_type").alias("domain"), F.col("user_id").alias("n_rows"), F.col("ts").alias("last_date"), F.col("ts").alias("updated_at"))
    return M.summarise(entries).select("domain", "entries", "n_rows", "newest", "oldest")


@query
def lagging(t):
    last = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("m"))
    entries = last.join(t("customer", "c_custkey", "c_mktsegment"), "c_custkey")
    return M.lagging(entries, ["c_mktsegment"], "m", F.expr("interval 300 day")).select("c_custkey", "m")


@query
def ghosts(t):
    return M.ghosts(t("orders", "o_orderkey"), t("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query
def overlay(t):
    counted = t("lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("n")).select("k", F.lit("lines").alias("src"), "n")
    return M.overlay(counted, t("orders").select(F.col("o_orderkey").alias("k"), F.lit("legacy").alias("src"), F.lit(0).cast("long").alias("n")), ["k"])


@query
def replica_diff(t):
    of = lambda status: t("lineitem").where(F.col("l_linestatus") == status).groupBy(F.col("l_partkey").alias("k")).agg(F.min("l_returnflag").alias("f"))
    return M.replica_diff(of("O"), of("F"), ["k"], "f")


@query
def interval_gaps(t):
    return Q.interval_gaps(t("lineitem"), "l_suppkey", "l_shipdate")


@query
def heading_span(t):
    """Each customer's orders as a page of dated headings, cut up again."""
    item = F.concat(F.date_format("o_orderdate", "MMMM d, yyyy"), F.lit(": order "), F.col("o_orderkey"), F.lit(".<br>\n"))
    pages = t("orders").groupBy(F.col("o_custkey").cast("string").alias("url")).agg(F.array_join(F.collect_list(item), "").alias("html"))
    return html.announcements(pages)


@query
def strip_tags(t):
    return t("pages").select("page_id", S.strip_tags(F.col("html")).alias("txt"))


@query
def json_props(t):
    return t("events").select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"))


@query
def registry_resolve(t):
    """Nations by their key as a code, for suppliers, and by name as a symbol."""
    registry = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("symbol"), F.col("n_nationkey").cast("string").alias("code"), "r_name")
    names = t("supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("name")).union(t("nation").select(-1 - F.col("n_nationkey").cast("long"), "n_name"))
    return T.resolve(names, registry).select("s_suppkey", F.col("symbol").alias("n_name"), "r_name")


@query
def registry_passthrough(t):
    registry = t("supplier").select(F.col("s_name").alias("symbol"), F.col("s_suppkey").cast("string").alias("code"))
    got = T.resolve(t("part").select("p_partkey", F.col("p_partkey").cast("string").alias("name")), registry)
    return got.select("p_partkey", F.coalesce("symbol", "name").alias("symbol"))


@query
def key_intersect(t):
    lines = t("lineitem")
    return M.common_keys(lines.where("l_returnflag = 'A'"), lines.where("l_returnflag = 'R' and l_linestatus = 'F'"), ["l_partkey"])


@query
def only_in_source(t):
    lines = t("lineitem")
    return M.only_in(lines.where("l_returnflag = 'A' and l_quantity > 40").select("l_partkey").distinct(), lines.where("l_returnflag = 'N' and l_quantity > 40").select("l_partkey"), ["l_partkey"])


@query
def topk_recent(t):
    return B.recent(t("lineitem", *KEY, *VINTAGE), ["l_shipdate", *KEY, "l_partkey", "l_suppkey"], 20)


@query
def asof_join(t):
    """The event that each order's customer, mapped onto all users, had last when the order fell due."""
    users = t("events").agg(F.max("user_id") + 1).first()[0]
    due = F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(cast(o_orderkey % 30 as int))")
    points = t("orders").select("o_orderkey", (F.col("o_custkey") % users).alias("user_id"), due.alias("due"))
    return B.asof_join(points, t("events", "user_id", "ts", "event_type"), ["user_id"], "due", "ts", ["event_type"]).where("event_type is not null").select("o_orderkey", F.col("event_type").alias("et"))


@query
def flow_state(t):
    daily = t("events").groupBy("user_id", F.col("ts").cast("date").alias("d")).agg(F.count_if(F.col("event_type") == "purchase").alias("lo"), F.count_if(F.col("event_type") == "error").alias("sh"))
    return C.flow_state(daily, ["user_id"], "d", "lo", "sh").drop("days_elapsed")


@query
def tumbling(t):
    counted = streaming.tumbling(t("events"), "ts", ["event_type"])
    return counted.select(F.col("window_start").cast("timestamp_ntz").alias("d"), "event_type", "n", F.round("total", 4).alias("v"))


@query
def first_sighting(t):
    rows = t("lineitem").join(t("orders", "o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return R.first_sightings(rows.select(F.col("l_shipdate").cast("date").alias("report_date"), F.col("o_orderdate").alias("observed_at")))


@query
def union_missing(t):
    lines = t("lineitem")
    return archives.union_years([lines.where("l_returnflag = 'A'").select(*KEY, "l_quantity"), lines.where("l_returnflag = 'R'").select(*KEY, "l_tax")])


@query
def dedup_values(t):
    keys = ["l_returnflag", "l_linestatus", "d"]
    return B.first_by_key(t("lineitem").select(*keys[:2], F.col("l_shipdate").cast("date").alias("d"), "l_orderkey"), keys, [F.col("l_orderkey").asc()]).drop("l_orderkey")


@query
def age_depth(t):
    rows = t("lineitem").join(t("orders", "o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(*KEY, "l_partkey", "l_suppkey", S.age_days(F.col("l_shipdate"), F.col("o_orderdate")).alias("age_days")).where("age_days > 30")


@query
def content_hash(t):
    return t("pages").select("page_id", S.content_sha256(F.col("html")).alias("content_sha256"), F.length("html").cast("long").alias("n_chars"))


@query
def year_counts(t):
    return Q.year_counts(t("orders"), F.year("o_orderdate"), "o_custkey", "o_orderdate")


@query
def tombstones(t):
    lines = t("lineitem", *KEY, "l_returnflag")
    return B.tombstones(lines.where("l_returnflag = 'A'").select(*KEY).distinct(), lines.where("l_returnflag = 'R'").select(*KEY), KEY, ["l_orderkey"])


@query
def revision_stats(t):
    rows = field_revisions(t).withColumnsRenamed({"l_orderkey": "market_code", "l_linenumber": "category", "l_shipdate": "report_date"}).withColumn("age_days", F.lit(1))
    return B.revision_stats(rows, ["field"]).select("field", "n", F.round("mean_share", 6).alias("mean_share"), "max_share")


@query
def row_count_band(t):
    counts = t("orders").groupBy(F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))
    return Q.row_count_band(counts, ["status"], "y", "n", 0.05).select("status", "y", "n", "before", F.round("share", 6).alias("share"))


@query
def late_ingest(t):
    """Lines marked R arrive as one snapshot observed in the middle of 1998, when later lines of their keys are already stored."""
    fields = {"quantity": "l_quantity", "discount": "l_discount"}
    rows = t("lineitem").select(*KEY, *VINTAGE, *[F.col(c).alias(n) for n, c in fields.items()], "l_returnflag", F.col("l_shipdate").cast("date").alias("report_date"))
    rows = rows.withColumn("row_sha256", S.row_hash({n: S.canonical_value(F.col(n), "double") for n in fields}))
    at = F.expr("timestamp_ntz '1998-07-01 00:00:00'")
    snapshot = F.format_string("%09d-%09d", "l_partkey", "l_suppkey")
    stored = rows.where("l_returnflag <> 'R'").withColumns({"observed_at": F.col("l_shipdate"), "snapshot_id": snapshot})
    late = B.latest_by_key(rows.where("l_returnflag = 'R'"), KEY, VINTAGE).withColumns({"observed_at": at, "snapshot_id": F.lit("late")})
    new, revisions = B.diff(late, stored, KEY, ["observed_at", "snapshot_id"], list(fields), at)
    out = new.select(*KEY, F.lit("new row").alias("field"), F.lit(None).cast("double").alias("delta"), F.col("_unexplained").cast("int").alias("odd"))
    return out.union(revisions.select(*KEY, "field", F.round("delta", 6), F.lit(0)))


@query
def category_migration(t):
    """Lines as revisions of an order's week, by line number; what cancels out within an order and flag moved between its lines."""
    sign = F.when(F.col("l_linenumber") % 2 == 0, 1).otherwise(-1)
    rows = t("lineitem").select("l_orderkey", F.col("l_linenumber").alias("category"), F.col("l_returnflag").alias("field"), (F.floor(F.col("l_quantity") / 10) * sign).cast("double").alias("delta"))
    return Q.category_migration(rows, ["l_orderkey"])
