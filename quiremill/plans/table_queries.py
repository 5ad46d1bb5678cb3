"""Queries over the TPC-H-like tables and events: profiles, headers, retention, answers, ladders, and general analytics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quiremill.operators import fetch, review, select, tables
from quiremill.sources.tables import read

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


@query(
    r"""with c as (select c_custkey as row_no, unnest([{'column': 'c_mktsegment', 'value': c_mktsegment}, {'column': 'c_nationkey', 'value': c_nationkey::varchar}, {'column': 'c_name', 'value': c_name}]) as x from customer),
v as (select x.column as "column", nullif(trim(x.value), '') as value, row_no from c),
l as (select "column", lower(value) as low, arg_min(value, row_no) as value, min(row_no) as first, count(*) as n from v where value is not null group by all),
e as (select "column", count(*) filter (where value is null) as n_empty, count(*) as rows from v group by 1),
m as (select "column", list_sort(list(try_cast(value as double)) filter (where try_cast(value as double) is not null)) as nums from v group by 1)
select "column", case when "column" = 'c_nationkey' then 'number' else 'text' end as dtype, (rows - n_empty)::bigint as n_values, n_empty::bigint as n_empty, count(*)::bigint as n_unique,
  case when "column" = 'c_nationkey' then nums[1] end as min, case when "column" = 'c_nationkey' then nums[-1] end as max, case when "column" = 'c_nationkey' then nums[len(nums) // 2 + 1] end as median,
  array_to_string(list_slice(list(l.value order by first), 1, 5), '|') as firsts
from l join e using ("column") join m using ("column") group by "column", rows, n_empty, nums"""
)
def column_profile(spark, sf_dir):
    """Profiles of customer columns."""
    cells = tables.cells_long(read(spark, sf_dir, "customer"), [], "c_custkey", ["c_mktsegment", "c_nationkey", "c_name"])
    p = tables.profiles(cells, complete=False)
    return p.select("column", "dtype", "n_values", "n_empty", "n_unique", "min", "max", "median", F.array_join("examples", "|").alias("firsts"))


@query(
    r"""with p as (select p_partkey as row_no, unnest([{'column': 'p_brand', 'value': p_brand}, {'column': 'p_size', 'value': p_size::varchar}]) as x from part), v as (select x.column as "column", x.value as value, row_no from p),
l as (select "column", lower(value) as low, arg_min(value, row_no) as value from v group by all)
select "column", case when "column" = 'p_size' then count(*) <= 12 else count(*) <= 25 end as listed, case when count(*) <= 25 and "column" = 'p_brand' then array_to_string(list(value order by lower(value)), '|') end as vals from l group by "column" """
)
def column_values(spark, sf_dir):
    """Which columns list all their values, sorted."""
    cells = tables.cells_long(read(spark, sf_dir, "part"), [], "p_partkey", ["p_brand", "p_size"])
    p = tables.profiles(cells)
    return p.select("column", F.col("values").isNotNull().alias("listed"), F.array_join("values", "|").alias("vals"))


def _sheets(spark):
    rows = "VALUES ('a', 0, array('Table 1', null, null)), ('a', 1, array(null, null, null)), ('a', 2, array('Gene', 'Score', 'Note')), ('a', 3, array('x', '1.5', 'ok')), ('a', 4, array('y', '2', null)), ('b', 0, array('u', 'v', 'w')), ('b', 1, array('p', 'q', 'r')) AS t(sheet, row_no, cells)"
    return spark.sql(f"select 'f' as source_file, * from {rows}")


@query("select * from (values ('a', 2, 'high', 'Gene|Score|Note', 'Table 1'), ('b', 0, 'low', 'u|v|w', '')) t(sheet, header_row, header_confidence, header, captions)")
def header_detect(spark, sf_dir):
    """Header rows of two small sheets."""
    h = tables.detected_headers(_sheets(spark))
    return h.select("sheet", "header_row", "header_confidence", F.array_join("header", "|").alias("header"), F.array_join("captions", "|").alias("captions"))


@query("select * from (values (0, 0, 3), (1, 4, 6)) t(panel, start, \"end\")")
def panel_split(spark, sf_dir):
    """A title row joins the panel below it."""
    rows = spark.sql("select 'f' as source_file, 's' as sheet, * from VALUES (0, array('Panel A', null)), (1, array('h', 'i')), (2, array('1', '2')), (3, array(null, null)), (4, array('h', 'i')), (5, array('3', '4')), (6, array(null, '')), (7, array('end', null)) AS t(row_no, cells)")
    return tables.panels(rows).select("panel", "start", "end")


@query(
    r"""with n as (select n_regionkey, n_nationkey, coalesce(case when n_nationkey % 5 = 0 then null else left(n_name, 1) end, 'column_' || (n_nationkey + 1)) as name from nation)
select n_regionkey, n_nationkey, case when row_number() over (partition by n_regionkey, lower(name) order by n_nationkey) = 1 then name else name || ' (' || row_number() over (partition by n_regionkey, lower(name) order by n_nationkey) || ')' end as unique_name from n"""
)
def unique_names(spark, sf_dir):
    """nations' initials as column names."""
    n = read(spark, sf_dir, "nation").withColumn("name", F.when(F.col("n_nationkey") % 5 != 0, F.left("n_name", F.lit(1))))
    return tables.unique_names(n, ["n_regionkey"], "n_nationkey").select("n_regionkey", "n_nationkey", "unique_name")


@query(
    r"""with o as (select o_custkey, o_orderkey, o_orderdate, floor(o_totalprice)::bigint as bytes, o_orderstatus = 'P' as evicted, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1 as newest from orders),
w as (select *, sum(case when not evicted then bytes else 0 end) over (partition by o_custkey) as total, coalesce(sum(case when not newest and not evicted then bytes else 0 end) over (partition by o_custkey order by o_orderdate, o_orderkey rows between unbounded preceding and 1 preceding), 0) as freed from o)
select o_orderkey, (not newest and not evicted and total - freed > 500000) as evict, freed::bigint as freed_before from w"""
)
def retention_budget(spark, sf_dir):
    """Orders as fetched articles, a budget per customer."""
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", F.floor("o_totalprice").cast("long").alias("bytes"), (F.col("o_orderstatus") == "P").alias("evicted"))
    return fetch.eviction(o, 500_000, "o_orderdate", "o_orderkey", "o_custkey").select("o_orderkey", "evict", "freed_before")


@query(r"""select user_id, event_type, max(event_id) as event_id, arg_max(value, event_id) as value, count(*) - 1 as replaced from events group by all""")
def latest_answer(spark, sf_dir):
    """The last event of each user and type."""
    return review.latest(read(spark, sf_dir, "events"), ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id", "value", "replaced")


@query(
    r"""with e as (select user_id, event_type, event_id % 3 as was, event_id, case when event_id % 5 = 0 then null else event_id % 3 end as then_ from events), f as (select distinct user_id, event_type, case when user_id % 7 = 0 then null else user_id % 3 end as now_ from events)
select event_id, coalesce(then_ <> now_, false) as stale from e join f using (user_id, event_type)"""
)
def stale_join(spark, sf_dir):
    """An answer is stale only if both digests are known and differ."""
    e = read(spark, sf_dir, "events")
    a = e.select(F.col("user_id").alias("slug"), F.col("event_type").alias("path"), "event_id", F.when(F.col("event_id") % 5 != 0, F.col("event_id") % 3).alias("source_sha256"))
    f = e.select(F.col("user_id").alias("slug"), F.col("event_type").alias("path"), F.when(F.col("user_id") % 7 != 0, F.col("user_id") % 3).alias("sha256")).distinct()
    return review.with_staleness(a, f).select("event_id", "stale")


@query(
    r"""with q as (select user_id as slug, event_type as kind, value > 50 as open, value < 1 as stale from events), a as (select slug, count(*) as questions, count(*) filter (where open) as open, bool_or(stale) as stale from q group by slug)
select slug, questions, open, case when stale then 'stale' when open = 0 then 'reviewed' when questions - open > 0 then 'partially_reviewed' else 'queued' end as state from a"""
)
def review_state(spark, sf_dir):
    """Events as questions of users."""
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("slug"), F.col("event_type").alias("kind"), (F.col("value") > 50).alias("open"), (F.col("value") < 1).alias("stale"))
    return review.states(e).select("slug", "questions", "open", "state")


@query(
    r"""with e as (select user_id, event_id, event_type = 'error' or value < 20 as failed from events), r as (select *, sum((not failed)::int) over (partition by user_id order by event_id) as run from e),
s as (select *, sum(failed::int) over (partition by user_id, run order by event_id) as streak from r)
select event_id, streak::bigint as streak, coalesce(max((streak >= 3)::int) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding) = 1, false) as dropped from s"""
)
def streak_breaker(spark, sf_dir):
    """Three failures in a row drop a user."""
    e = read(spark, sf_dir, "events").withColumn("failed", (F.col("event_type") == "error") | (F.col("value") < 20))
    return fetch.breaker(e, "user_id", "event_id", "failed").select("event_id", "streak", "dropped")


@query(
    r"""select o_orderkey, case when o_orderstatus = 'P' then 'not_requested' when o_orderkey % 11 = 0 then 'none_listed' when o_orderkey % 3 > 0 and o_orderpriority = '1-URGENT' then 'fetched' when o_orderkey % 3 > 0 and o_orderpriority = '2-HIGH' then 'fetched_unverified'
 when o_orderkey % 3 > 0 then 'partial_failure' when o_orderkey % 4 = 0 then 'expected_but_missing' when o_orderpriority = '5-LOW' then 'page_not_parsed' else 'unknown_none_found' end as status from orders"""
)
def status_ladder(spark, sf_dir):
    """FL6, FL7: supplement status from order columns."""
    o = read(spark, sf_dir, "orders")
    names = {"1-URGENT": "fetched", "2-HIGH": "fetched_unverified", "5-LOW": "page_not_parsed"}
    reported = F.array_compact(F.array(*(F.when(F.col("o_orderpriority") == k, v) for k, v in names.items())))
    k = F.col("o_orderkey")
    return o.select("o_orderkey", fetch.supplement_status(F.col("o_orderstatus") != "P", fetch.suppl_flag_believable(F.when(k % 11 == 0, False), F.lit(False), F.lit(True), F.lit(True), F.lit(None).cast("boolean")), (k % 3).cast("int"), reported, k % 4 == 0).alias("status"))


@query(
    r"""with r as (select l_orderkey as slug, l_linenumber, case when l_returnflag = 'A' then 'paywalled' when l_returnflag = 'R' then 'not_found' when l_quantity > 49 then 'ok' else 'session_expired' end as status from lineitem)
select slug, coalesce(arg_min(status, l_linenumber) filter (where status = 'ok'), min(status) filter (where status in ('paywalled', 'session_expired')), arg_max(status, l_linenumber)) as status from r group by slug"""
)
def best_failure(spark, sf_dir):
    """FL14: the status of an order's lines that explains most."""
    s = F.when(F.col("l_returnflag") == "A", "paywalled").when(F.col("l_returnflag") == "R", "not_found").when(F.col("l_quantity") > 49, "ok").otherwise("session_expired")
    return fetch.best_failure(read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("slug"), F.col("l_linenumber").alias("tier_ord"), s.alias("status")))


@query(
    r"""with e as (select c_custkey, c_mktsegment as seg, c_nationkey as n from customer), l as (select n_name as label, n_nationkey from nation where n_nationkey % 2 = 0)
select c_custkey::varchar as entry, coalesce((select label from l where n_nationkey = n), (select label from l where n_nationkey = n + 1)) as label from e"""
)
def label_join_priority(spark, sf_dir):
    """A customer's nation by its own key, else the next one's."""
    c, n = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation").where("n_nationkey % 2 = 0")
    e = c.select(F.lit("s").alias("slug"), F.col("c_custkey").cast("string").alias("entry"), F.array("c_nationkey", F.col("c_nationkey") + 1).alias("keys"))
    return fetch.prioritised_labels(e, n.select(F.lit("s").alias("slug"), F.col("n_nationkey").alias("key"), F.col("n_name").alias("label"))).select("entry", "label")


@query(r"""select l_orderkey as slug, l_shipdate::date::varchar as label, count(*) as n from lineitem group by all having count(*) >= 2""")
def shared_labels(spark, sf_dir):
    """Ship dates that two lines of an order share."""
    return fetch.shared_labels(read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("slug"), F.to_date("l_shipdate").cast("string").alias("label")))


@query(r"""select event_id, (props::json->>'k')::bigint as k from events""")
def json_props(spark, sf_dir):
    """A number out of a JSON column under a schema."""
    return read(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query(
    r"""select case when o_orderstatus = 'P' then 'not_fetched' when o_orderkey % 13 = 0 then 'not_extracted' when o_totalprice < 30000 then 'text_unavailable' when o_orderpriority in ('4-NOT SPECIFIED', '5-LOW') then 'ready_with_caveats' else 'ready' end as state,
 count(*) as articles, max((o_orderstatus <> 'P' and o_orderkey % 13 <> 0 and o_totalprice >= 30000)::int) = 1 as trustworthy from orders group by state"""
)
def readiness_rollup(spark, sf_dir):
    """FL5, FL4, A15: orders as articles."""
    o, k = read(spark, sf_dir, "orders"), F.col("o_orderkey")
    a = o.select(
        (F.col("o_orderstatus") != "P").alias("has_manifest"), (k % 13 != 0).alias("has_record"), F.when(F.col("o_totalprice") < 30000, "failed").otherwise("complete").alias("status"), F.lit("ok").alias("main_status"), F.lit(3).alias("main_blocks"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.array(F.lit("supplement_set_unverified"))).alias("caveats"), F.lit(None).cast("array<string>").alias("lost"), F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "low").otherwise("ok").alias("labelling"),
    )
    return select.readiness_rollup(select.readiness(a))


@query(r"""select user_id, row_number() over (partition by user_id order by event_id) as place, event_id, count(*) over (partition by user_id) as considered, greatest(count(*) over (partition by user_id) - 25, 0) as dropped from events qualify place <= 25""")
def capped_rows(spark, sf_dir):
    """S8, SC10: at most 25 events a user, with what is left out."""
    e = tables.capped(read(spark, sf_dir, "events"), ["user_id"], "event_id", 25)
    return e.select("user_id", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).cast("long").alias("place"), "event_id", "considered", "dropped")


@query(r"""select n_regionkey, count(*) as articles, sum(c_acctbal::decimal(18,2))::double as bytes from customer join nation on c_nationkey = n_nationkey group by rollup (n_regionkey)""")
def status_rollup(spark, sf_dir):
    """Counts and sums per region and over all."""
    c = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.rollup("n_regionkey").agg(F.count(F.lit(1)).alias("articles"), F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("bytes"))


@query(
    r"""with f as (select o_orderkey as slug, sha256(o_orderkey::varchar) as sha256, o_custkey from orders), u as (select o_orderkey as slug, sha256((o_orderkey - o_orderkey % 2)::varchar) as sha256 from orders)
select f.slug, u.sha256 is not null as found from f left join u on f.slug = u.slug and f.sha256 = u.sha256"""
)
def digest_match(spark, sf_dir):
    """Files found by digest."""
    o, k = read(spark, sf_dir, "orders"), F.col("o_orderkey")
    e = o.select(k.alias("slug"), F.lit("f").alias("file"), F.sha2(k.cast("string"), 256).alias("sha256"), F.lit(None).cast("array<string>").alias("members"))
    u = o.select(k.alias("slug"), F.sha2((k - k % 2).cast("string"), 256).alias("sha256"))
    return fetch.digest_match(e, u).select("slug", "found")


# General analytics, for breadth.


@query(
    r"""select l_returnflag, l_linestatus, sum(l_quantity::decimal(18,2))::double as sum_qty, sum(l_extendedprice::decimal(18,2))::double as sum_price, sum((l_extendedprice::decimal(18,2) * (1 - l_discount::decimal(18,2)))::decimal(18,4))::double as revenue, count(*) as n
 from lineitem where l_shipdate <= timestamp '1998-09-02' group by all"""
)
def pricing_summary(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    d = lambda c: F.col(c).cast("decimal(18,2)")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum(d("l_quantity")).cast("double").alias("sum_qty"), F.sum(d("l_extendedprice")).cast("double").alias("sum_price"), F.sum((d("l_extendedprice") * (1 - d("l_discount"))).cast("decimal(18,4)")).cast("double").alias("revenue"), F.count(F.lit(1)).alias("n"))


@query(
    r"""select n_name, sum(o_totalprice::decimal(18,2))::double as total, count(*) as orders from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey where r_name = 'ASIA' group by n_name"""
)
def nation_totals(spark, sf_dir):
    o, c, n, r = (read(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region"))
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r.where("r_name = 'ASIA'"), n.n_regionkey == r.r_regionkey)
    return j.groupBy("n_name").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"), F.count(F.lit(1)).alias("orders"))


@query(r"""select o_custkey, o_orderkey, o_totalprice from orders qualify row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) <= 3""")
def top_orders(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return read(spark, sf_dir, "orders").withColumn("n", F.row_number().over(w)).where("n <= 3").select("o_custkey", "o_orderkey", "o_totalprice")


@query(r"""select c_custkey from customer where c_custkey not in (select o_custkey from orders)""")
def without_orders(spark, sf_dir):
    return read(spark, sf_dir, "customer").join(read(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")
