-- DuckDB SQL that gives the same rows as the driver queries; one statement per name.

-- pit_asof
select l_orderkey,l_linenumber,l_shipdate,l_partkey,l_suppkey,l_quantity from (select *, row_number() over (partition by l_orderkey,l_linenumber order by l_shipdate
desc,l_partkey desc,l_suppkey desc) rn from lineitem where l_shipdate <= cast('1998-06-30' as timestamp)) t where rn=1;

-- change_only
select l_orderkey,l_linenumber,l_shipdate,l_partkey,l_suppkey,l_returnflag,l_linestatus from (select *, lag(concat(l_returnflag,l_linestatus)) over (partition by
l_orderkey,l_linenumber order by l_shipdate,l_partkey,l_suppkey) pv from lineitem) t where pv is null or pv<>concat(l_returnflag,l_linestatus);

-- field_revisions
with v as (select l_orderkey,l_linenumber,l_shipdate,l_quantity q,l_discount d,l_tax x, lag(l_quantity) over w pq, lag(l_discount) over w pd, lag(l_tax) over w px,
lag(l_shipdate) over w ps from lineitem window w as (partition by l_orderkey,l_linenumber order by l_shipdate,l_partkey,l_suppkey)), u as (select
l_orderkey,l_linenumber,l_shipdate,'quantity' field,pq old_value,q new_value,ps from v union all select l_orderkey,l_linenumber,l_shipdate,'discount',pd,d,ps from v union
all select l_orderkey,l_linenumber,l_shipdate,'tax',px,x,ps from v) select l_orderkey,l_linenumber,l_shipdate,field,old_value,new_value,round(new_value-old_value,6)
delta, case when old_value<>0 then round((new_value-old_value)/old_value,6) end pct_delta from u where ps is not null and old_value is distinct from new_value;

-- row_hash
select l_orderkey,l_linenumber,l_partkey,l_suppkey, sha256(concat('quantity=',cast(cast(l_quantity as bigint) as varchar),'|flag=',coalesce(l_returnflag,''))) row_sha256
from lineitem;

-- melt
select l_orderkey,l_linenumber,l_partkey,l_suppkey,'quantity' category, l_quantity val from lineitem union all select
l_orderkey,l_linenumber,l_partkey,l_suppkey,'discount', nullif(l_discount,0.0) from lineitem union all select l_orderkey,l_linenumber,l_partkey,l_suppkey,'tax',l_tax from
lineitem;

-- coerce_suppressed
select event_id, try_cast(case when event_type='error' then '.' else cast(round(value,2) as varchar) end as double) v from events;

-- standardize_code
select p_partkey, case when length(cast(p_partkey as varchar))<6 then lpad(cast(p_partkey as varchar),6,'0') else cast(p_partkey as varchar) end code from part;

-- zero_sum
with s as (select l_suppkey, cast(sum(case when l_returnflag='A' then cast(l_quantity as bigint) else 0 end) as bigint) a, cast(sum(case when l_returnflag='R' then
cast(l_quantity as bigint) else 0 end) as bigint) r, cast(sum(case when l_returnflag='N' then cast(l_quantity as bigint) else 0 end) as bigint) n, count(*) n_rows from
lineitem group by l_suppkey) select l_suppkey, a+n long_total, r+n short_total, n spread_total, n_rows, a-r imbalance, a=r balanced, abs(a-r)<=greatest(1,n_rows)
within_tolerance from s;

-- null_rate
select l_returnflag category, round(avg(case when nullif(l_tax,0.0) is null then 1e0 else 0e0 end),6) null_rate from lineitem group by l_returnflag;

-- dup_keys
select l_orderkey,l_linenumber,count(*) n from lineitem group by l_orderkey,l_linenumber having count(*)>1;

-- vocab_violations
select e.event_type,count(*) n from events e left join (select 'click' c union all select 'view' union all select 'purchase') v on e.event_type=v.c where v.c is null
group by e.event_type;

-- oi_breach
select o_orderkey,o_totalprice,round(s,2) side_total from orders join (select l_orderkey,sum(l_extendedprice) s,count(*) n from lineitem group by l_orderkey) t on
l_orderkey=o_orderkey where s>o_totalprice+greatest(1,n);

-- coverage
select cast(year(l_shipdate) as int) report_year,l_partkey market_code,min(l_shipdate) first_report_date,max(l_shipdate) last_report_date,count(distinct l_shipdate)
n_weeks from lineitem group by year(l_shipdate),l_partkey;

-- coverage_changes
select cast(report_year as int) report_year, change, market_code from (with c as (select distinct year(l_shipdate) y,l_partkey k from lineitem), ys as (select distinct y
from c), p as (select y, lag(y) over (order by y) py from ys) select p.y report_year,'enter' change,c.k market_code from p join c on c.y=p.y left join c c0 on c0.y=p.py
and c0.k=c.k where p.py=p.y-1 and c0.k is null union all select p.y,'exit',c0.k from p join c c0 on c0.y=p.py left join c on c.y=p.y and c.k=c0.k where p.py=p.y-1 and c.k
is null union all select y,'gap',null from p where py is not null and py<>y-1) z;

-- latest_name
select s_nationkey, max_by(s_name,s_suppkey) latest_name from supplier where s_name is not null group by s_nationkey;

-- stitch
with h as (select (count(*)+1)//2 h from supplier), r as (select l_suppkey code,cast(l_shipdate as date) d,sum(cast(l_quantity as bigint)) q from lineitem group by 1,2), f as
(select code sym,d,cast(q as double) q,0 pri from r,h where code<h union all select code-h,d,q*4.0,1 from r,h where code>=h) select sym,d,q,pri from (select *,row_number()
over (partition by sym,d order by pri) rn from f) t where rn=1;

-- derive_release
select o_orderkey, case when isodow(d3)=6 then d3+2 when isodow(d3)=7 then d3+1 else d3 end release_date from (select o_orderkey, cast(o_orderdate as date)+3 d3 from
orders) t;

-- report_date_for_release
select o_orderkey, d - cast((isodow(d)+5)%7 as int) report_date from (select o_orderkey, cast(o_orderdate as date)-3 d from orders) t;

-- release_precedence
with b as (select o_orderkey,cast(o_orderdate as date) rd,o_orderstatus st,o_orderpriority pr from orders), f as (select l_orderkey,min(cast(l_shipdate as date)) fs from
lineitem group by 1), c as (select o_orderkey, rd, fs, case when pr='1-URGENT' then 'published' when date_diff('day',rd,fs) between 0 and 4 then 'observed' when st='F' then
'announced' when st='O' then 'scheduled' else 'derived' end src from b left join f on l_orderkey=o_orderkey) select o_orderkey, src, case src when 'published' then rd+1
when 'observed' then fs when 'announced' then rd+5 when 'scheduled' then rd+6 else rd+3+case isodow(rd+3) when 6 then 2 when 7 then 1 else 0 end end release_date from c;

-- schedule_map
select cast(o_orderdate as date) report_date, case o_orderstatus when 'P' then 'published' when 'F' then 'announced' else 'scheduled' end source, o_orderkey from (select
*,row_number() over (partition by cast(o_orderdate as date) order by case o_orderstatus when 'P' then 3 when 'F' then 2 else 1 end desc,o_orderdate,o_orderkey) rn from
orders) t where rn=1;

-- newest_plan
select o_custkey,o_orderkey,o_orderdate from (select *,max(o_orderdate) over (partition by o_custkey) m from orders) t where o_orderdate=m;

-- source_counts
select release_date_source, count(o_orderkey) n from (values ('published'),('observed'),('announced'),('scheduled'),('derived'),('unknown')) v(release_date_source) left join
orders on release_date_source = case o_orderstatus when 'P' then 'published' when 'F' then 'announced' else 'scheduled' end group by 1;

-- latest_with_content
select user_id,max_by(event_id,ts) last_any, max_by(case when event_type<>'error' then event_id end,case when event_type<>'error' then ts end) last_content, max_by(case
when event_type in ('click','purchase') then event_id end,case when event_type in ('click','purchase') then ts end) last_delivery from events group by user_id;

-- blind_alert
with g as (select *, count(case when event_type in ('click','purchase') then 1 end) over (partition by user_id order by ts rows between unbounded preceding and current
row) grp from events), h as (select *, max(case when event_type in ('click','purchase') then ts end) over (partition by user_id,grp) dts from g), k as (select
user_id,grp,event_id,ts,row_number() over (partition by user_id,grp order by ts) rn from h where event_type='view' and grp>0 and ts>dts+interval '2' day) select
user_id,event_id,ts from k where rn=1;

-- manifest_summary
select event_type domain,count(*) entries,cast(sum(user_id) as bigint) n_rows,max(ts) newest,min(ts) oldest from events group by event_type;

-- lagging
select c_custkey,m from (select o_custkey c_custkey,max(o_orderdate) m,c_mktsegment seg from orders join customer on c_custkey=o_custkey group by o_custkey,c_mktsegment)
a join (select c_mktsegment seg,max(o_orderdate) x from orders join customer on c_custkey=o_custkey group by 1) b on a.seg=b.seg where x>m+interval '300' day;

-- ghosts
select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey=o_orderkey);

-- overlay
select l_orderkey k,'lines' src,count(*) n from lineitem group by 1 union all select o_orderkey,'legacy',0 from orders where not exists (select 1 from lineitem where
l_orderkey=o_orderkey);

-- replica_diff
select a.l_partkey k,a.f sf,b.f df from (select l_partkey,min(l_returnflag) f from lineitem where l_linestatus='O' group by l_partkey) a join (select
l_partkey,min(l_returnflag) f from lineitem where l_linestatus='F' group by l_partkey) b on a.l_partkey=b.l_partkey where a.f<>b.f;

-- interval_gaps
select l_suppkey,d,cast(gap as int) gap from (select l_suppkey,d,date_diff('day',lag(d) over (partition by l_suppkey order by d),d) gap from (select distinct
l_suppkey,cast(l_shipdate as date) d from lineitem) t) u where gap<>7;

-- heading_span
select cast(o_custkey as varchar) url, cast(o_orderdate as date) announcement_date, strftime(o_orderdate, '%B %-d, %Y') || ': order ' || o_orderkey || '.' raw_text from orders;

-- strip_tags
select page_id, trim(regexp_replace(regexp_replace(html,'<[^>]+>',' ','g'),'[ \t\n\r]+',' ','g')) txt from pages;

-- json_props
select event_id, cast(json_extract_string(props,'$.k') as int) k from events;

-- registry_resolve
select s_suppkey,n_name,r_name from supplier join nation on s_nationkey=n_nationkey join region on n_regionkey=r_regionkey union all select -1-n_nationkey,n_name,r_name from
nation join region on n_regionkey=r_regionkey;

-- key_intersect
select l_partkey from lineitem where l_returnflag='A' intersect select l_partkey from lineitem where l_returnflag='R' and l_linestatus='F';

-- topk_recent
select l_orderkey,l_linenumber,l_shipdate,l_partkey,l_suppkey from lineitem order by l_shipdate desc,l_orderkey desc,l_linenumber desc,l_partkey desc,l_suppkey desc limit
20;

-- asof_join
select o_orderkey,event_type et from (select o_orderkey, o_custkey % (select max(user_id)+1 from events) u, cast('2024-01-01' as timestamp)+to_days(cast(o_orderkey%30 as int)) due from
orders) o asof join events e on e.user_id=u and due>=e.ts;

-- flow_state
select user_id,d,case when dl=0 and ds=0 then 'quiet' when abs(dl)>=abs(ds) then case when dl>0 then 'new_longs' else 'long_liquidation' end else case when ds>0 then
'new_shorts' else 'short_covering' end end state from (select user_id,d,lo-lag(lo) over w dl,sh-lag(sh) over w ds from (select user_id,cast(ts as date) d,count(case when
event_type='purchase' then 1 end) lo,count(case when event_type='error' then 1 end) sh from events group by user_id,cast(ts as date)) g window w as (partition by user_id
order by d)) t where dl is not null;

-- tumbling
select cast(ts as date) d,event_type,count(*) n,round(sum(value),4) v from events group by cast(ts as date),event_type;

-- first_sighting
select cast(l_shipdate as date) report_date, min(o_orderdate) first_seen from lineitem join orders on o_orderkey = l_orderkey group by 1;

-- union_missing
select l_orderkey, l_linenumber, l_quantity, null::double l_tax from lineitem where l_returnflag = 'A'
union all select l_orderkey, l_linenumber, null, l_tax from lineitem where l_returnflag = 'R';

-- dedup_values
select distinct l_returnflag, l_linestatus, cast(l_shipdate as date) d from lineitem;

-- only_in_source
select distinct l_partkey from lineitem where l_returnflag = 'A' and l_quantity > 40 except select l_partkey from lineitem where l_returnflag = 'N' and l_quantity > 40;

-- registry_passthrough
select p.p_partkey, coalesce(s.s_name, cast(p.p_partkey as varchar)) symbol from part p left join supplier s on s.s_suppkey = p.p_partkey;

-- age_depth
select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) as int) age_days
from lineitem join orders on o_orderkey = l_orderkey where date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) > 30;

-- content_hash
select page_id, sha256(html) content_sha256, length(html) n_chars from pages;

-- year_counts
select cast(year(o_orderdate) as int) y, count(distinct o_custkey) markets, min(o_orderdate) first_date, max(o_orderdate) last_date from orders group by 1;

-- tombstones
select l_orderkey, l_linenumber from (select distinct l_orderkey, l_linenumber from lineitem where l_returnflag = 'A') a
where exists (select 1 from lineitem r where r.l_returnflag = 'R' and r.l_orderkey = a.l_orderkey)
and not exists (select 1 from lineitem r where r.l_returnflag = 'R' and r.l_orderkey = a.l_orderkey and r.l_linenumber = a.l_linenumber);

-- revision_stats
select field, count(*) n, round(avg(abs(pct_delta)), 6) mean_share, max(abs(pct_delta)) max_share from (
with v as (select l_orderkey,l_linenumber,l_shipdate,l_quantity q,l_discount d,l_tax x, lag(l_quantity) over w pq, lag(l_discount) over w pd, lag(l_tax) over w px,
lag(l_shipdate) over w ps from lineitem window w as (partition by l_orderkey,l_linenumber order by l_shipdate,l_partkey,l_suppkey)), u as (select
l_orderkey,l_linenumber,l_shipdate,'quantity' field,pq old_value,q new_value,ps from v union all select l_orderkey,l_linenumber,l_shipdate,'discount',pd,d,ps from v union
all select l_orderkey,l_linenumber,l_shipdate,'tax',px,x,ps from v) select l_orderkey,l_linenumber,l_shipdate,field,old_value,new_value,round(new_value-old_value,6)
delta, case when old_value<>0 then round((new_value-old_value)/old_value,6) end pct_delta from u where ps is not null and old_value is distinct from new_value
) r group by field;

-- row_count_band
with c as (select o_orderstatus status, cast(year(o_orderdate) as int) y, count(*) n from orders group by all),
b as (select *, lag(n) over (partition by status order by y) "before" from c)
select status, y, n, "before", round(abs(n - "before") / "before", 6) share from b where abs(n - "before") / "before" > 0.05;

-- late_ingest
with r as (select *, sha256(concat('quantity=',cast(l_quantity as varchar),'|discount=',cast(l_discount as varchar))) h from lineitem),
late as (select * from (select *, row_number() over (partition by l_orderkey,l_linenumber order by l_shipdate desc,l_partkey desc,l_suppkey desc) rn from r where l_returnflag='R') where rn=1),
old as (select * from (select *, row_number() over (partition by l_orderkey,l_linenumber order by l_shipdate desc,l_partkey desc,l_suppkey desc) rn from r where l_returnflag<>'R' and
l_shipdate <= timestamp '1998-07-01') where rn=1),
j as (select n.l_orderkey,n.l_linenumber,n.l_quantity q,n.l_discount d,o.l_quantity oq,o.l_discount od,o.l_orderkey is not null known from late n left join old o on
o.l_orderkey=n.l_orderkey and o.l_linenumber=n.l_linenumber where o.l_orderkey is null or o.h<>n.h)
select l_orderkey,l_linenumber,'new row' field,null::double delta,0 odd from j union all select l_orderkey,l_linenumber,'quantity',round(q-oq,6),0 from j where known and q<>oq union all
select l_orderkey,l_linenumber,'discount',round(d-od,6),0 from j where known and d<>od;

-- category_migration
select l_orderkey, l_returnflag field, count(distinct l_linenumber) n, sum(abs(v))/2 moved from (select *, floor(l_quantity/10)*case when l_linenumber%2=0 then 1 else -1 end v from
lineitem) group by 1,2 having count(distinct l_linenumber)>1 and sum(v)=0;
