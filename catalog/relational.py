"""Scans, projections, joins, aggregates and scalar functions.

Orders stand in for listings, customers for hosts and order lines for reviews.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.base import query, table
from rillstone.functions import columns as fn
from rillstone.operators import aggregates as agg
from rillstone.operators import incremental as inc
from rillstone.operators import joins, numbering, select
from rillstone.operators.evaluate import mismatches
from rillstone.plans.views import Views

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def uniform_sql(seed, *keys: str) -> str:
    """The hashed uniform number of ``functions.columns.uniform`` in SQL."""
    text = " || '|' || ".join([f"'{seed}'", *[f"cast({k} as varchar)" for k in keys]])
    return f"(cast('0x' || substr(md5({text}), 1, 13) as bigint) / {16 ** 13}.0::double)"


# ---------------------------------------------------------------- scans and projections

@query("scan_parquet", "select o_orderkey, o_custkey, o_totalprice from orders where o_totalprice >= 250000")
def scan_parquet(spark, sf):
    return table(spark, sf, "orders").filter("o_totalprice >= 250000").select("o_orderkey", "o_custkey", "o_totalprice")


@query("inline_rows", """select o_orderkey, p.days from orders
    join (values ('1-URGENT', 1), ('2-HIGH', 3), ('3-MEDIUM', 7)) p(name, days) on o_orderpriority = p.name""")
def inline_rows(spark, sf):
    terms = spark.createDataFrame([("1-URGENT", 1), ("2-HIGH", 3), ("3-MEDIUM", 7)], "o_orderpriority string, days int")
    return table(spark, sf, "orders").join(terms, "o_orderpriority").select("o_orderkey", "days")


@query("delete_where", """select event_id, event_type, value from events
    where not coalesce((event_type = 'click' and value > 50)
      or (case when event_type = 'view' then null else event_type end = 'error' and value < 10), false)""")
def delete_where(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    kind = F.when(F.col("event_type") != "view", F.col("event_type"))
    gone = ((F.col("event_type") == "click") & (F.col("value") > 50)) | ((kind == "error") & (F.col("value") < 10))
    return select.delete_where(events, gone)


@query("stage_rename", """select o_orderkey as listing_id, o_orderpriority as listing_name, o_orderstatus as room_type,
    o_custkey as host_id, o_orderdate as created_at from orders""")
def stage_rename(spark, sf):
    return select.rename(table(spark, sf, "orders"), {
        "o_orderkey": "listing_id", "o_orderpriority": "listing_name", "o_orderstatus": "room_type",
        "o_custkey": "host_id", "o_orderdate": "created_at"})


@query("bulk_rename", """select p_partkey as "P_PARTKEY", p_name as "P_NAME", p_brand as "P_BRAND", p_type as "P_TYPE",
    p_size as "SIZE_CM", p_retailprice as "P_RETAILPRICE" from part""")
def bulk_rename(spark, sf):
    return select.rename_all(table(spark, sf, "part"), {"p_size": "SIZE_CM"})


@query("star_except", "select * exclude (l_tax, l_linestatus), l_extendedprice * (1 - l_discount) as net from lineitem")
def star_except(spark, sf):
    return table(spark, sf, "lineitem").select("*", F.expr("l_extendedprice * (1 - l_discount)").alias("net")).drop(
        "l_tax", "l_linestatus")


@query("case_flag", """select d.doc_id, cast(case when quality = 1 then 1 else 2 end as integer) as sentiment_flag
    from documents d left join labels l on d.doc_id = l.doc_id""")
def case_flag(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return docs.select("doc_id", F.when(F.col("quality") == 1, 1).otherwise(2).alias("sentiment_flag"))


@query("null_default", """select c_custkey, coalesce(case when c_mktsegment <> 'FURNITURE' then c_name end, 'Anonymous')
    as host_name from customer""")
def null_default(spark, sf):
    name = F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_name"))
    return table(spark, sf, "customer").select("c_custkey", F.coalesce(name, F.lit("Anonymous")).alias("host_name"))


@query("filter_bool", """select l_orderkey, l_linenumber, l_partkey from lineitem
    where (l_quantity between 10 and 20 or l_discount > 0.05) and l_returnflag <> 'R'
      and l_shipdate >= timestamp '1996-01-01' and l_shipdate < timestamp '1998-01-01'""")
def filter_bool(spark, sf):
    return table(spark, sf, "lineitem").filter(
        (F.col("l_quantity").between(10, 20) | (F.col("l_discount") > 0.05)) & (F.col("l_returnflag") != "R")
        & (F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
        & (F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    ).select("l_orderkey", "l_linenumber", "l_partkey")


@query("dropna_subset", """select d.doc_id, quality, toxic from documents d left join labels l on d.doc_id = l.doc_id
    where quality is not null""")
def dropna_subset(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return docs.dropna(subset=["quality"]).select("doc_id", "quality", "toxic")


@query("mismatch_rows", "select doc_id, quality, 1 - toxic as predicted from labels where quality <> 1 - toxic")
def mismatch_rows(spark, sf):
    scored = table(spark, sf, "labels").select("doc_id", "quality", (1 - F.col("toxic")).alias("predicted"))
    return mismatches(scored, "quality", "predicted")


@query("clamp_value", """select event_id, case when event_id = 42 then 100.0 when value > 100 then 100.0 else value end as value
    from events""")
def clamp_value(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value")
    fixed = select.correct_value(events, F.col("event_id") == 42, "value", 100.0)
    return fixed.withColumn("value", fn.clamp_max("value", 100.0))


@query("hash_split", f"""select o_orderkey, case when {uniform_sql(82, 'o_orderkey')} < 0.8 then 'train' else 'test' end
    as grp from orders""")
def hash_split(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    return select.with_split(orders, {"train": 0.8, "test": 0.2}, ["o_orderkey"], seed=82)


@query("bernoulli_sample", f"select o_orderkey, o_totalprice from orders where {uniform_sql(7, 'o_orderkey')} < 0.1")
def bernoulli_sample(spark, sf):
    return select.bernoulli_sample(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 0.1, ["o_orderkey"], 7)


@query("distinct_sorted", "select distinct p_brand from part where p_brand is not null order by p_brand")
def distinct_sorted(spark, sf):
    return select.distinct_sorted(table(spark, sf, "part"), "p_brand")


@query("number_rows", "select event_id, row_number() over (order by ts, event_id) as row_number from events")
def number_rows(spark, sf):
    return numbering.number_rows(table(spark, sf, "events").select("event_id", "ts"), ["ts", "event_id"]).drop("ts")


@query("ordinal_sort", """select o_orderpriority, cast(list_position(
      ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'], o_orderpriority) - 1 as bigint) as severity,
    count(*) as n from orders group by all order by severity""")
def ordinal_sort(spark, sf):
    counts = agg.frequency(table(spark, sf, "orders"), "o_orderpriority", name="n")
    return counts.withColumn("severity", fn.ordinal("o_orderpriority", PRIORITIES).cast("long")).orderBy("severity")


# ---------------------------------------------------------------- joins

@query("listing_host_join", """select o_orderkey, o_orderstatus, c_name, c_mktsegment from orders
    join customer on o_custkey = c_custkey""")
def listing_host_join(spark, sf):
    orders, hosts = table(spark, sf, "orders"), table(spark, sf, "customer")
    return orders.join(hosts, orders.o_custkey == hosts.c_custkey).select(
        "o_orderkey", "o_orderstatus", "c_name", "c_mktsegment")


@query("salted_host_join", """select o_orderkey, c_name from orders join customer on o_custkey = c_custkey""")
def salted_host_join(spark, sf):
    """The same join with hot customers spread over several tasks."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    hosts = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return joins.salted_join(orders, hosts, "o_custkey", share=0.001).select("o_orderkey", "c_name")


@query("calendar_shift_join", """with cal as (select distinct cast(o_orderdate as date) as d from orders where day(o_orderdate) = 11)
    select l_orderkey, l_linenumber, l_partkey, case when cal.d is null then 'not full moon' else 'full moon' end as is_full_moon
    from lineitem left join cal on cast(l_shipdate as date) = cal.d + 1""")
def calendar_shift_join(spark, sf):
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("full_moon_date")).filter(
        F.dayofmonth("full_moon_date") == 11)
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return joins.flag_day_after(
        lines, "l_shipdate", days, "full_moon_date", "full moon", "not full moon", "is_full_moon").drop("l_shipdate")


@query("new_keys_anti", """select c_custkey, c_name from customer c
    where not exists (select 1 from orders o where o.o_custkey = c.c_custkey and o_totalprice > 400000)""")
def new_keys_anti(spark, sf):
    loaded = table(spark, sf, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.new_rows(table(spark, sf, "customer").select("c_custkey", "c_name"), loaded, ["c_custkey"])


@query("temporal_violation", """select o_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem
    join orders on o_orderkey = l_orderkey where o_orderdate >= l_shipdate""")
def temporal_violation(spark, sf):
    from rillstone.operators.quality import before_event

    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return before_event(lines, orders, "o_orderkey", "o_orderdate", "l_shipdate").drop("o_orderdate", "l_shipdate")


@query("lookup_map", """select n_nationkey, n_name, case r_name when 'AFRICA' then 'Africa' when 'ASIA' then 'Asia'
      when 'EUROPE' then 'Europe' end as display, case r_name when 'AFRICA' then 'AF' when 'ASIA' then 'AS'
      when 'EUROPE' then 'EU' else '' end || ' ' || n_name as tagged
    from nation join region on n_regionkey = r_regionkey""")
def lookup_map(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    tag = fn.lookup("r_name", {"AFRICA": "AF", "ASIA": "AS", "EUROPE": "EU"})
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name",
        fn.lookup("r_name", {"AFRICA": "Africa", "ASIA": "Asia", "EUROPE": "Europe"}).alias("display"),
        F.concat(F.coalesce(tag, F.lit("")), F.lit(" "), F.col("n_name")).alias("tagged"))


@query("watermark_filter", """select o_orderkey, o_orderdate from orders
    where o_orderdate > (select coalesce(max(l_shipdate), timestamp '1970-01-01') from lineitem where l_shipdate < timestamp '1998-06-01')""")
def watermark_filter(spark, sf):
    target = table(spark, sf, "lineitem").filter(F.col("l_shipdate") < F.lit("1998-06-01").cast("timestamp_ntz")).select(
        F.col("l_shipdate").alias("o_orderdate"))
    return inc.above_watermark(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), target, "o_orderdate")


# ---------------------------------------------------------------- aggregates

@query("count_two_keys", """select l_returnflag, l_linestatus, count(*) as count from lineitem group by all order by 1, 2""")
def count_two_keys(spark, sf):
    return agg.frequency(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus").orderBy("l_returnflag", "l_linestatus")


@query("having_dupes", """select cast(o_orderdate as date) as day, o_custkey, count(*) as cnt from orders
    group by all having count(*) > 1""")
def having_dupes(spark, sf):
    rows = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"), "o_custkey")
    return agg.duplicates(rows, ["day", "o_custkey"])


@query("topn_values", """select o_custkey, count(*) as count from orders group by o_custkey order by count desc, o_custkey limit 5""")
def topn_values(spark, sf):
    return agg.top_values(table(spark, sf, "orders"), "o_custkey", 5)


@query("nunique", """select count(distinct l_partkey) as parts, count(distinct l_suppkey) as suppliers,
    count(distinct l_shipdate) as ship_days from lineitem""")
def nunique(spark, sf):
    return table(spark, sf, "lineitem").agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"),
        F.count_distinct("l_shipdate").alias("ship_days"))


@query("count_all_cols", """select source, count(d.doc_id) as doc_id, count(lang) as lang, count(n_chars) as n_chars,
    count(quality) as quality, count(toxic) as toxic from documents d left join labels l on d.doc_id = l.doc_id group by source""")
def count_all_cols(spark, sf):
    docs = table(spark, sf, "documents").drop("text").join(table(spark, sf, "labels"), "doc_id", "left")
    return agg.count_all_columns(docs, ["source"])


_HOURS = ", ".join(f"nullif(count(*) filter (where hour(ts) = {h}), 0) as h{h}" for h in range(24))


@query("crosstab_dow_hour", f"select strftime(ts, '%a') as day, {_HOURS} from events group by 1")
def crosstab_dow_hour(spark, sf):
    rows = table(spark, sf, "events").select(fn.weekday_name("ts").alias("day"), F.hour("ts").alias("hour"))
    return agg.cross_tab(rows, "day", "hour", list(range(24)), prefix="h")


@query("daily_by_category", "select event_type, cast(ts as date) as day, count(*) as count from events group by all")
def daily_by_category(spark, sf):
    return agg.frequency(table(spark, sf, "events"), "event_type", F.to_date("ts").alias("day"))


@query("group_means", """select l_returnflag, round(avg(l_quantity), 6) as l_quantity, round(avg(l_extendedprice), 4) as l_extendedprice,
    round(avg(l_discount), 6) as l_discount, round(avg(l_tax), 6) as l_tax from lineitem group by l_returnflag""")
def group_means(spark, sf):
    means = agg.group_means(
        table(spark, sf, "lineitem"), "l_returnflag", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return means.select("l_returnflag", *[F.round(c, 4 if c == "l_extendedprice" else 6).alias(c) for c in means.columns[1:]])


_CORR_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_CORR = " union all ".join(
    f"select '{a}' as left_col, '{b}' as right_col, round(corr({a}, {b}), 8) as corr from lineitem"
    for i, a in enumerate(_CORR_COLUMNS) for b in _CORR_COLUMNS[i + 1:])


@query("corr_pairs", _CORR)
def corr_pairs(spark, sf):
    return agg.correlations(table(spark, sf, "lineitem"), _CORR_COLUMNS).withColumn("corr", F.round("corr", 8))


_MEAN_CORR = " union all ".join(
    f"select '{a}' as left_col, '{b}' as right_col, round(corr({a}, {b}), 6) as corr from m"
    for i, a in enumerate(_CORR_COLUMNS) for b in _CORR_COLUMNS[i + 1:])


@query("corr_of_group_means", f"""with m as (select l_suppkey, {', '.join(f'avg({c}) as {c}' for c in _CORR_COLUMNS)}
    from lineitem group by l_suppkey) {_MEAN_CORR}""")
def corr_of_group_means(spark, sf):
    means = agg.group_means(table(spark, sf, "lineitem"), "l_suppkey", _CORR_COLUMNS)
    return agg.correlations(means, _CORR_COLUMNS).withColumn("corr", F.round("corr", 6))


@query("mode_per_group", """select p_brand, p_type as mode from (select p_brand, p_type, row_number() over (
    partition by p_brand order by count(*) desc, p_type) as rn from part group by p_brand, p_type) where rn = 1""")
def mode_per_group(spark, sf):
    return agg.mode(table(spark, sf, "part"), ["p_brand"], "p_type")


def _describe_sql(columns, source, by="", digits=4):
    keys = f"{by}, " if by else ""
    return " union all ".join(
        f"""select {keys}'{c}' as "column", count({c}) as count, round(avg({c}), {digits}) as mean,
        round(stddev_samp({c}), {digits}) as std, min({c})::double as min, round(quantile_cont({c}, 0.25), 6) as q25,
        round(quantile_cont({c}, 0.5), 6) as q50, round(quantile_cont({c}, 0.75), 6) as q75, max({c})::double as max
        from {source} {'group by ' + by if by else ''}""" for c in columns)


def _rounded(df, digits=4):
    return df.withColumns({"mean": F.round("mean", digits), "std": F.round("std", digits),
                           **{q: F.round(q, 6) for q in ("q25", "q50", "q75")}})


@query("describe_cols", _describe_sql(["l_quantity", "l_extendedprice", "l_discount"], "lineitem"))
def describe_cols(spark, sf):
    return _rounded(agg.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]))


@query("describe_grouped", _describe_sql(["n_chars"], "documents", "lang"))
def describe_grouped(spark, sf):
    return _rounded(agg.describe(table(spark, sf, "documents"), ["n_chars"], ["lang"]))


_PROFILE = [("doc_id", "bigint"), ("lang", "string"), ("source", "string"), ("quality", "int"), ("toxic", "int")]


@query("null_profile", "with j as (select d.doc_id, lang, source, quality, toxic from documents d left join labels l on d.doc_id = l.doc_id) "
       + " union all ".join(f"""select '{c}' as "column", '{t}' as type, count({c}) as non_null,
       round(1 - count({c}) / count(*), 8) as null_ratio from j""" for c, t in _PROFILE))
def null_profile(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source").join(table(spark, sf, "labels"), "doc_id", "left")
    return agg.null_profile(docs).withColumn("null_ratio", F.round("null_ratio", 8))


@query("histogram", """with r as (select min(value) as lo, max(value) as hi from events)
    select event_type, cast(least(floor((value - lo) * 30 / (hi - lo)), 29) as integer) as bin,
      round(lo + bin * ((hi - lo) / 30), 6) as bin_start, count(*) as count
    from events, r group by event_type, bin, lo, hi""")
def histogram(spark, sf):
    bins = agg.histogram(table(spark, sf, "events"), "value", 30, ["event_type"])
    return bins.withColumn("bin_start", F.round("bin_start", 6))


@query("hist2d", """with r as (select min(l_quantity) as x0, max(l_quantity) as x1, min(l_extendedprice) as y0,
      max(l_extendedprice) as y1 from lineitem)
    select cast(least(floor((l_quantity - x0) * 12 / (x1 - x0)), 11) as integer) as x_bin,
      cast(least(floor((l_extendedprice - y0) * 12 / (y1 - y0)), 11) as integer) as y_bin, count(*) as count
    from lineitem, r group by all""")
def hist2d(spark, sf):
    return agg.histogram_2d(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 12)


@query("box_summary", """with q as (select event_type, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median,
      quantile_cont(value, 0.75) as q3 from events group by event_type), e as (
      select event_type, q1, median, q3, value, value between q1 - (q3 - q1) * 1.5 and q3 + (q3 - q1) * 1.5 as inside
      from events join q using (event_type))
    select event_type, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3, min(value) filter (where inside) as whisker_low,
      max(value) filter (where inside) as whisker_high, count(*) filter (where not inside) as outliers
    from e group by e.event_type, e.q1, e.median, e.q3""")
def box_summary(spark, sf):
    box = agg.box_summary(table(spark, sf, "events"), "value", "event_type")
    return box.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query("trend_by_group", """select l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) as slope,
    round(regr_intercept(l_extendedprice, l_quantity), 4) as intercept, round(regr_r2(l_extendedprice, l_quantity), 8) as r2,
    cast(regr_count(l_extendedprice, l_quantity) as bigint) as n from lineitem group by l_returnflag""")
def trend_by_group(spark, sf):
    line = agg.trend(table(spark, sf, "lineitem"), "l_extendedprice", "l_quantity", ["l_returnflag"])
    return line.select("l_returnflag", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"),
                       F.round("r2", 8).alias("r2"), "n")


# ---------------------------------------------------------------- scalar functions

@query("clean_token", "select p_partkey, upper(regexp_replace(p_name, '[^a-zA-Z0-9]+', '_', 'g')) as token from part")
def clean_token(spark, sf):
    return table(spark, sf, "part").select("p_partkey", fn.clean_token("p_name").alias("token"))


def _price_text():
    price = F.col("o_totalprice")
    plain = F.concat(F.lit("$"), price.cast("decimal(12,2)").cast("string"))
    return F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("$"), F.format_number(price, 2))).when(
        F.col("o_orderpriority") == "5-LOW", F.lit("N/A")).otherwise(plain)


@query("parse_price", """select o_orderkey, case when o_orderstatus <> 'P' and o_orderpriority = '5-LOW' then null
    else o_totalprice end as price from orders""")
def parse_price(spark, sf):
    """Price text, with and without thousands separators, some of it unreadable."""
    return table(spark, sf, "orders").select("o_orderkey", fn.parse_price(_price_text()).cast("double").alias("price"))


@query("parse_price_rejects", """select count(*) as rows, count(*) filter (
    where o_orderstatus <> 'P' and o_orderpriority = '5-LOW') as rejected from orders""")
def parse_price_rejects(spark, sf):
    texts = table(spark, sf, "orders").select(_price_text().alias("t"))
    return texts.agg(F.count(F.lit(1)).alias("rows"),
                     F.count_if(F.col("t").isNotNull() & fn.parse_price("t").isNull()).alias("rejected"))


@query("split_prefix", "select o_orderkey, split_part(o_orderpriority, '-', 1) as code from orders")
def split_prefix(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", fn.text_before("o_orderpriority", "-").alias("code"))


@query("text_length", "select doc_id, cast(length(text) as integer) as length from documents")
def text_length(spark, sf):
    return table(spark, sf, "documents").select("doc_id", fn.char_length("text").alias("length"))


@query("casts", """select o_orderkey, cast(o_orderkey as varchar) as key_text, cast(cast(o_totalprice as decimal(9,1)) as double) as price,
    cast(o_custkey as double) as customer, o_orderstatus = 'F' as done, cast(o_orderdate as date) as day,
    cast(floor(o_totalprice) as bigint) as whole from orders""")
def casts(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_totalprice").cast("decimal(9,1)").cast("double").alias("price"), F.col("o_custkey").cast("double").alias("customer"),
        F.when(F.col("o_orderstatus") == "F", F.lit("true")).otherwise(F.lit("false")).cast("boolean").alias("done"),
        F.col("o_orderdate").cast("date").alias("day"), F.col("o_totalprice").cast("long").alias("whole"))


def _value_text():
    return F.when(F.col("event_type") == "error", F.lit("NA")).when(F.col("event_type") == "click", F.lit("")).otherwise(
        F.col("value").cast("decimal(12,2)").cast("string"))


@query("try_number", """select event_id, case when event_type not in ('error', 'click') then value end as number,
    case when event_type not in ('error', 'click') then cast(round(cast(value as decimal(12,2))) as double) end as whole
    from events""")
def try_number(spark, sf):
    texts = table(spark, sf, "events").select("event_id", _value_text().alias("t"))
    return texts.select("event_id", fn.parse_number("t").alias("number"), fn.parse_number("t", whole=True).alias("whole"))


@query("try_timestamp", """select event_id, case when event_type <> 'error' then date_trunc('second', ts) end as parsed from events""")
def try_timestamp(spark, sf):
    text = F.when(F.col("event_type") == "error", F.lit("NA")).otherwise(F.date_format("ts", "dd-MM-yyyy HH:mm:ss"))
    return table(spark, sf, "events").select("event_id", fn.parse_timestamp(text).alias("parsed"))


@query("period_start", """select distinct make_date(year(o_orderdate), month(o_orderdate), 1) as month_start,
    make_date(year(o_orderdate), 1, 1) as year_start from orders""")
def period_start(spark, sf):
    y, m = F.year("o_orderdate"), F.month("o_orderdate")
    return table(spark, sf, "orders").select(
        fn.period_start(y, m).alias("month_start"), fn.period_start(y).alias("year_start")).distinct()


@query("calendar_names", """select distinct cast(o_orderdate as date) as day, strftime(o_orderdate, '%b') as mon,
    strftime(o_orderdate, '%B') as month, strftime(o_orderdate, '%a') as weekday from orders""")
def calendar_names(spark, sf):
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        F.to_date(d).alias("day"), fn.month_name(d).alias("mon"), fn.month_name(d, full=True).alias("month"),
        fn.weekday_name(d).alias("weekday")).distinct()


@query("hash_key", """with k as (select case when event_type <> 'view' then user_id end as a, case when event_type = 'view'
      then user_id end as b from events)
    select count(*) as rows, (select count(*) from (select distinct a, b from k)) as keys from k""")
def hash_key(spark, sf):
    """As many hash keys as distinct column pairs, though each pair holds a NULL."""
    view = F.col("event_type") == "view"
    pairs = table(spark, sf, "events").select(F.when(~view, F.col("user_id")).alias("a"), F.when(view, F.col("user_id")).alias("b"))
    return pairs.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(fn.hash_key("a", "b")).alias("keys"))


@query("surrogate_key", """select d.doc_id, md5(cast(d.doc_id as varchar) || '-' || source || '-' ||
      coalesce(cast(quality as varchar), '_dbt_utils_surrogate_key_null_') || '-' || text) as review_id
    from documents d left join labels l on d.doc_id = l.doc_id where text is not null""")
def surrogate_key(spark, sf):
    reviews = table(spark, sf, "documents").filter(F.col("text").isNotNull()).join(
        table(spark, sf, "labels"), "doc_id", "left")
    return reviews.select("doc_id", fn.surrogate_key("doc_id", "source", "quality", "text").alias("review_id"))


@query("greatest_nullstrict", """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
    case when l_returnflag <> 'A' then greatest(l_quantity, l_discount * 100) end as largest from lineitem""")
def greatest_nullstrict(spark, sf):
    other = F.when(F.col("l_returnflag") != "A", F.col("l_discount") * 100)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", fn.greatest_strict("l_quantity", other).alias("largest"))


@query("round_modes", """select distinct l_quantity, round(l_quantity / 2) as half_up, round_even(l_quantity / 2, 0) as half_even,
    cast(trunc(l_quantity / 2) as bigint) as whole, abs(10 - l_quantity) as distance, round(sqrt(l_quantity), 8) as root from lineitem""")
def round_modes(spark, sf):
    q = F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        "l_quantity", F.round(q / 2).alias("half_up"), F.bround(q / 2).alias("half_even"),
        (q / 2).cast("long").alias("whole"), F.abs(10 - q).alias("distance"), F.round(F.sqrt(q), 8).alias("root")).distinct()


@query("json_extract", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_extract(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("row_to_json", """select event_id, cast(to_json({'user_id': user_id, 'event_type': event_type}) as varchar) as record from events""")
def row_to_json(spark, sf):
    return table(spark, sf, "events").select("event_id", F.to_json(F.struct("user_id", "event_type")).alias("record"))


@query("explode_words", r"""select word, count(*) as n from (
      select unnest(string_split_regex(text, '[\s\p{Z}]+')) as word from documents) where word <> '' group by word""")
def explode_words(spark, sf):
    words = table(spark, sf, "documents").select(F.explode(F.split("text", r"[\s\p{Z}]+")).alias("word"))
    return agg.frequency(words.filter("word <> ''"), "word", name="n")


# ---------------------------------------------------------------- set operations

@query("union_blocks", """select o_orderkey, 'high' as block, true as label from orders where o_totalprice >= 300000
    union all select o_orderkey, 'middle', false from orders where o_totalprice >= 100000 and o_totalprice < 300000
    union all select o_orderkey, 'low', false from orders where o_totalprice < 100000""")
def union_blocks(spark, sf):
    orders = table(spark, sf, "orders")

    def block(condition, name, label):
        return orders.filter(condition).select("o_orderkey", F.lit(name).alias("block"), F.lit(label).alias("label"))

    return (block("o_totalprice >= 300000", "high", True)
            .unionByName(block("o_totalprice >= 100000 and o_totalprice < 300000", "middle", False))
            .unionByName(block("o_totalprice < 100000", "low", False)))


# ---------------------------------------------------------------- named views

@query("view_of_views", """with large as (select o_custkey, o_totalprice from orders where o_totalprice >= 200000),
    by_nation as (select c_nationkey, count(*) as n, sum(o_totalprice) as total from large join customer on o_custkey = c_custkey group by c_nationkey)
    select n_name, n, round(total, 2) as total, round(total / (select sum(total) from by_nation), 8) as share
    from by_nation join nation on c_nationkey = n_nationkey""")
def view_of_views(spark, sf):
    """Four views given in the wrong order, one reading two others."""
    views = Views(spark, {
        "shares": "select n_name, n, round(total, 2) as total, round(total / all_total, 8) as share "
                  "from {by_nation} join {everything} join {nation} on c_nationkey = n_nationkey",
        "everything": "select sum(total) as all_total from {by_nation}",
        "by_nation": "select c_nationkey, count(*) as n, sum(o_totalprice) as total from {large} join {customer} on o_custkey = c_custkey group by c_nationkey",
        "large": "select o_custkey, o_totalprice from {orders} where o_totalprice >= 200000",
    }, prefix=f"v{uuid.uuid4().hex[:12]}_")
    for name in ("orders", "customer", "nation"):
        views.add_table(name, table(spark, sf, name))
    views.build()
    return views.read("shares")
