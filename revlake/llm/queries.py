"""The operators over their whole tables, for ``__spark_entry__.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arc import arc_to_warc, pages_to_arc
from .bpe_sql import encode
from .chat import render
from .decontaminate import contaminated
from .lm_trie import lm_score
from .mpeg import pages_to_audio, parse_audio
from .near_dup import near_duplicates
from .pii import pseudonymous
from .quality import classify
from .token_counts import token_counts
from .vocabulary import VOCABULARY


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op4_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, archived in a legacy file and converted: all records of all files."""
    return arc_to_warc(pages_to_arc(_table(spark, sf_dir, "pages"))).withColumn("block", F.decode("block", "UTF-8"))


def op5_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as the payload of a synthetic stream: the tables hold no audio."""
    return parse_audio(pages_to_audio(_table(spark, sf_dir, "pages")), "page_id")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render(_table(spark, sf_dir, "conversations"))


def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymous(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


_SHINGLES = """
select {id}, unnest(case when n >= 4 then list_transform(range(1, n - 2), lambda i: array_to_string(w[i:i + 3], ' ')) when n > 0 then [array_to_string(w, ' ')] else [] end) s
from (select {id}, w, len(w) n from (select {id}, regexp_extract_all(lower(text), '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+') w from {table}))
"""

def _base32(digest: str) -> str:
    return f"""'sha1:' || array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr({digest}, (1 + 5 * (i // 4))::int, 5))::int >> (15 - 5 * (i % 4))::int) & 31) + 1, 1)), '')"""


_WHITE = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Pre-tokens without look-ahead: a mark of private use stands before the last white space of a run that a word follows.
_MARK = chr(0xE000)
_MARKED = f"regexp_replace(text, '([{_WHITE}])([{_WHITE}][^{_WHITE}])', '\\1{_MARK}\\2', 'g')"
_PRETOKEN = f"''s|''t|''re|''ve|''m|''ll|''d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{_WHITE}\\p{{L}}\\p{{N}}{_MARK}]+|[{_WHITE}]+"

ORACLE: dict[str, str] = {
    "op2_token_counts": f"""
with recursive v as (select hex(from_base64(b)) h, r from read_csv('{VOCABULARY}', delim=' ', header=false, quote='', escape='', columns={{'b': 'varchar', 'r': 'bigint'}})),
    d as (select row_number() over () k, doc_id, coalesce(text, '') text from documents),
    p as (select k, unnest(regexp_extract_all({_MARKED}, '{_PRETOKEN}')) w from d),
    words as (select distinct w from p),
    steps(w, t, live) as (
        select w, list_transform(range(0, strlen(w)), lambda i: substr(hex(encode(w)), 2 * i::int + 1, 2)), true from words
        union all (
            with q as (select w, unnest(t[:-2]) || unnest(t[2:]) h, generate_subscripts(t[2:], 1) pos from steps where live),
                 best as (select q.w, min(v.r << 32 | q.pos) b from q join v using (h) group by q.w)
            select w, case when b is null then t else list_concat(t[:(b & 4294967295) - 1], [t[b & 4294967295] || t[(b & 4294967295) + 1]], t[(b & 4294967295) + 2:]) end, b is not null
            from steps left join best using (w) where live)),
    counts as (select p.k, count(*) n_pretokens, sum(len(t))::bigint n_tokens from p join steps using (w) where not live group by p.k)
select doc_id, strlen(text) n_bytes, coalesce(n_pretokens, 0) n_pretokens, coalesce(n_tokens, 0) n_tokens from d left join counts using (k)
""",
    "op4_arc_to_warc": f"""
with n as (select *, 'page-' || page_id || '.arc' name, '1 1 revlake' || chr(10) || 'URL IP-address Archive-date Content-type Archive-length' || chr(10) head from pages),
p as (
    select 'response' warc_type, page_id, name, regexp_replace(url, '\\s', '%20', 'g') target_uri, '10.' || (page_id >> 16) % 256 || '.' || (page_id >> 8) % 256 || '.' || page_id % 256 ip_address,
           'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || chr(13) || chr(10) || html block, html,
           strftime(make_timestamp((820454400 + page_id) * 1000000), '%Y-%m-%dT%H:%M:%SZ') warc_date,
           strlen('filedesc://' || name || ' 0.0.0.0 19960101000000 text/plain ' || strlen(head)) + 1 + strlen(head) + 1 as "offset"
    from n
    union all
    select 'warcinfo', page_id, name, 'filedesc://' || name, '0.0.0.0', head, null, '1996-01-01T00:00:00Z', 0 from n),
d as (select *, {_base32("sha1(block)")} block_digest, {_base32("sha1(html)")} payload_digest from p),
u as (select *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(target_uri || ' ' || warc_date || ' ' || block_digest)) h from d)
select name || case when page_id % 3 = 0 then '.gz' else '' end as path, "offset"::bigint as "offset", case warc_type when 'response' then (1 + page_id % 2)::int else 1 end arc_version, 0::bigint skipped, false truncated, warc_type,
       '<urn:uuid:' || h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || substr('89ab', (('0x' || h[17:17])::int & 3) + 1, 1) || h[18:20] || '-' || h[21:32] || '>' record_id,
       target_uri, ip_address, warc_date, case warc_type when 'response' then 'application/http; msgtype=response' else 'application/warc-fields' end content_type,
       strlen(block) content_length, block_digest, payload_digest, case warc_type when 'response' then 200 end http_status, block
from u
""",
    "op9_chat": """
with t as (select distinct conv_id, turn, role, text from conversations where conv_id is not null),
     c as (select conv_id, list({'role': role, 'text': text} order by turn nulls first, role nulls first, text nulls first) l, count(*) n from t group by conv_id),
     u as (select min(conv_id) conv_id, l, any_value(n) n_turns, count(*) n_copies from c group by l)
select conv_id, n_turns, n_copies,
       array_to_string(list_transform(l, lambda x: '<|im_start|>' || replace(coalesce(x.role, ''), '<|im_', '<| im_') || chr(10) || replace(coalesce(x.text, ''), '<|im_', '<| im_') || '<|im_end|>' || chr(10)), '') as text
from u where not exists (select 1 from c where c.n > u.n_turns and c.l[1] = u.l[1] and c.l[:u.n_turns] = u.l)
""",
    "op7_decontamination": f"""
with q as (select distinct item_id, s from ({_SHINGLES.format(id="item_id", table="benchmark")})),
     n as (select item_id, count(*) n from q group by item_id),
     d as (select distinct doc_id, s from ({_SHINGLES.format(id="doc_id", table="documents")}))
select doc_id, item_id, count(*) / any_value(n)::double containment
from q join d using (s) join n using (item_id) group by doc_id, item_id having count(*) >= 0.5 * any_value(n)
""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
