"""Incremental loads, history and data-quality checks."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from catalog.base import query, table
from rillstone.operators import incremental as inc
from rillstone.operators import quality as dq
from rillstone.plans import listings
from rillstone.session import shared_folder
from rillstone.sources.buckets import BucketedTable, HistoryTable


@query("window_backfill", """select o_orderkey, o_orderdate from orders
    where o_orderdate >= timestamp '1997-02-01' and o_orderdate < timestamp '1997-03-01'""")
def window_backfill(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return inc.in_window(orders, "o_orderdate", dt.datetime(1997, 2, 1), dt.datetime(1997, 3, 1))


@query("upsert_latest", """with u as (
      select o_orderkey, o_orderstatus, o_totalprice, o_orderdate, 0 as is_new from orders
      union all
      select o_orderkey, 'X', o_totalprice + 1, case when o_orderpriority = '1-URGENT'
        then o_orderdate - interval 1 day else o_orderdate end, 1 from orders where o_orderstatus = 'P'
      union all
      select o_orderkey + 1000000000, 'N', o_totalprice, o_orderdate, 1 from orders where o_orderpriority = '5-LOW')
    select o_orderkey, o_orderstatus, o_totalprice, o_orderdate from (
      select *, row_number() over (partition by o_orderkey order by o_orderdate desc, is_new desc) as rn from u) where rn = 1""")
def upsert_latest(spark, sf):
    """Corrections (some older than the stored row) and new keys arrive together."""
    target = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    older = F.when(F.col("o_orderpriority") == "1-URGENT", F.expr("o_orderdate - interval 1 day")).otherwise(F.col("o_orderdate"))
    fixes = target.filter("o_orderstatus = 'P'").withColumns(
        {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1, "o_orderdate": older})
    added = target.filter("o_orderpriority = '5-LOW'").withColumns(
        {"o_orderkey": F.col("o_orderkey") + 1000000000, "o_orderstatus": F.lit("N")})
    incoming = fixes.unionByName(added)
    return inc.upsert_latest(
        target.drop("o_orderpriority"), incoming.drop("o_orderpriority"), ["o_orderkey"], "o_orderdate")


_START, _SECOND, _THIRD = "2024-01-01", "2024-02-01", "2024-03-01"


@query("scd2_merge", """select c_custkey, c_mktsegment, c_acctbal, timestamp '2024-01-01' as valid_from,
      case when c_mktsegment = 'BUILDING' then timestamp '2024-02-15'
           when c_acctbal > 5000 then timestamp '2024-02-01' end as valid_to
    from customer where c_nationkey <> 24
    union all select c_custkey, c_mktsegment, c_acctbal + 100, timestamp '2024-02-01', null
    from customer where c_nationkey <> 24 and c_mktsegment <> 'BUILDING' and c_acctbal > 5000
    union all select c_custkey, c_mktsegment, case when c_acctbal > 5000 then c_acctbal + 100 else c_acctbal end,
      case when c_acctbal > 5000 then timestamp '2024-02-01' else timestamp '2024-01-01' end, null
    from customer where c_nationkey = 24 and c_mktsegment <> 'BUILDING'""")
def scd2_merge(spark, sf):
    """Second snapshot: one segment is gone, large balances were updated, one nation is new."""
    stamp = lambda text: F.lit(text).cast("timestamp_ntz")
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey").withColumn(
        "updated_at", stamp(_START))
    first = rows.filter("c_nationkey <> 24").drop("c_nationkey")
    large = F.col("c_acctbal") > 5000
    second = rows.filter("c_mktsegment <> 'BUILDING'").withColumn(
        "updated_at", F.when(large, stamp(_SECOND)).otherwise(F.col("updated_at"))).withColumn(
        "c_acctbal", F.when(large, F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal"))).drop("c_nationkey")
    history = inc.start_history(first, "updated_at")
    merged = inc.scd2_merge(history, second, "c_custkey", "updated_at", dt.datetime(2024, 2, 15))
    return merged.drop("updated_at")


# ---------------------------------------------------------------- listings build

def raw_listings(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select(
        F.col("o_orderkey").alias("id"), F.lit("").alias("listing_url"), F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("room_type"), (F.year("o_orderdate") - 1995).alias("minimum_nights"),
        F.col("o_custkey").alias("host_id"),
        F.concat(F.lit("$"), F.format_number("o_totalprice", 2)).alias("price"),
        F.col("o_orderdate").alias("created_at"), F.col("o_orderdate").alias("updated_at"))


def raw_hosts(spark, sf):
    customer = table(spark, sf, "customer")
    return customer.select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_name")).alias("name"),
        F.when(F.col("c_acctbal") > 5000, F.lit("t")).otherwise(F.lit("f")).alias("is_superhost"),
        F.lit("1995-01-01").cast("timestamp_ntz").alias("created_at"),
        F.when(F.col("c_nationkey") != 3, F.lit("1998-01-01").cast("timestamp_ntz")).alias("updated_at"))


def raw_reviews(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.select(
        F.col("l_orderkey").alias("listing_id"), F.col("l_shipdate").alias("date"),
        F.concat(F.lit("r"), F.col("l_suppkey").cast("string"), F.lit("-"), F.col("l_partkey").cast("string"),
                 F.lit("-"), F.col("l_linenumber").cast("string")).alias("reviewer_name"),
        F.when(F.col("l_linenumber") != 7, F.col("l_returnflag")).alias("comments"),
        F.when(F.col("l_returnflag") == "A", F.lit("positive")).when(F.col("l_returnflag") == "N", F.lit("neutral"))
        .otherwise(F.lit("negative")).alias("sentiment"))


_LISTINGS = """l as (select o_orderkey as listing_id, o_orderpriority as listing_name, o_orderstatus as room_type,
      cast(case when year(o_orderdate) = 1995 then 1 else year(o_orderdate) - 1995 end as integer) as minimum_nights,
      o_custkey as host_id, cast(round(o_totalprice, 2) as decimal(10,2)) as price, o_orderdate as created_at,
      o_orderdate as updated_at from orders)"""
_HOSTS = """h as (select c_custkey as host_id, coalesce(case when c_mktsegment <> 'FURNITURE' then c_name end, 'Anonymous') as host_name,
      case when c_acctbal > 5000 then 't' else 'f' end as is_superhost, timestamp '1995-01-01' as created_at,
      case when c_nationkey <> 3 then timestamp '1998-01-01' end as updated_at from customer)"""
_REVIEWS = """r as (select l_orderkey as listing_id, l_shipdate as review_date, 'r' || l_suppkey || '-' || l_partkey || '-' || l_linenumber as reviewer_name,
      case when l_linenumber <> 7 then l_returnflag end as review_text,
      case l_returnflag when 'A' then 'positive' when 'N' then 'neutral' else 'negative' end as review_sentiment from lineitem)"""
_FACT = """f as (select md5(cast(listing_id as varchar) || '-' || strftime(review_date, '%Y-%m-%d %H:%M:%S') || '-' || reviewer_name || '-' || review_text) as review_id, *
      from r where review_text is not null)"""


@query("clean_listing", f"with {_LISTINGS} select * replace (price::double as price) from l")
def clean_listing(spark, sf):
    clean = listings.clean_listings(raw_listings(spark, sf))
    return clean.withColumn("price", F.col("price").cast("double"))


@query("listings_with_hosts", f"""with {_LISTINGS}, {_HOSTS}
    select l.listing_id, l.listing_name, l.room_type, l.minimum_nights, l.price::double as price, l.host_id, h.host_name,
      h.is_superhost as host_is_superhost, l.created_at,
      case when h.updated_at is not null then greatest(l.updated_at, h.updated_at) end as updated_at
    from l join h on l.host_id = h.host_id""")
def listings_with_hosts(spark, sf):
    joined = listings.listings_with_hosts(
        listings.clean_listings(raw_listings(spark, sf)), listings.clean_hosts(raw_hosts(spark, sf)))
    return joined.withColumn("price", F.col("price").cast("double"))


@query("review_fact", f"with {_REVIEWS}, {_FACT} select * from f")
def review_fact(spark, sf):
    return listings.review_fact(raw_reviews(spark, sf))


@query("full_moon_sentiment", f"""with {_REVIEWS}, {_FACT}, cal as (
      select distinct cast(o_orderdate as date) as d from orders where day(o_orderdate) = 11)
    select case when d is null then 'not full moon' else 'full moon' end as is_full_moon, review_sentiment, count(*) as reviews
    from f left join cal on cast(review_date as date) = d + 1 group by all order by 1, 2""")
def full_moon_sentiment(spark, sf):
    moons = table(spark, sf, "orders").filter(F.dayofmonth("o_orderdate") == 11).select(
        F.to_date("o_orderdate").alias("full_moon_date"))
    marked = listings.full_moon_reviews(listings.review_fact(raw_reviews(spark, sf)), moons)
    return listings.full_moon_sentiment(marked)


# ---------------------------------------------------------------- data quality

def _check_sql(check, column, failures, severity="error"):
    bad = "warn" if severity == "warn" else "fail"
    return f"""(select '{check}' as "check", '{column}' as "column", failures, '{severity}' as severity,
      case when failures = 0 then 'pass' else '{bad}' end as status from (select cast({failures} as bigint) as failures))"""


@query("dq_report", f"with {_LISTINGS}, {_HOSTS}, raw as (select *, year(o_orderdate) - 1995 as n from orders) " + " union all ".join([
    _check_sql("not_null", "host_name", "(select count(*) from h where host_name is null)"),
    _check_sql("not_null", "updated_at", "(select count(*) from h where updated_at is null)"),
    _check_sql("accepted_values", "is_superhost", "(select count(*) from h where is_superhost not in ('t', 'f'))"),
    _check_sql("no_nulls", "*", "(select count(*) from h where updated_at is null or host_name is null)"),
    _check_sql("positive_value", "minimum_nights", "(select count(*) from l where minimum_nights < 1)"),
    _check_sql("distinct_count", "room_type", "(select (count(distinct room_type) <> 4)::int from l)"),
    _check_sql("max_at_most", "price", "(select (max(price) > 5000)::int from l)", "warn"),
    _check_sql("quantile_0.99", "price", "(select (quantile_cont(price::double, 0.99) not between 50 and 500)::int from l)"),
]))
def dq_report(spark, sf):
    clean = listings.clean_listings(raw_listings(spark, sf))
    hosts = listings.clean_hosts(raw_hosts(spark, sf))
    host_checks = dq.report(hosts, [
        dq.not_null("host_name"), dq.not_null("updated_at"), dq.accepted_values("is_superhost", ["t", "f"]), dq.no_nulls(hosts)])
    listing_checks = dq.report(clean, [
        dq.positive_value("minimum_nights"), dq.distinct_count_equals("room_type", 4), dq.max_at_most("price", 5000, "warn")])
    return host_checks.unionByName(listing_checks).unionByName(dq.quantile_between(clean, "price", 0.99, 50, 500))


@query("dq_unique", " union all ".join([
    _check_sql("unique", "o_orderkey", "(select count(*) from (select o_orderkey from orders group by 1 having count(*) > 1))"),
    _check_sql("unique", "l_orderkey,l_linenumber",
               "(select count(*) from (select l_orderkey, l_linenumber from lineitem group by all having count(*) > 1))")]))
def dq_unique(spark, sf):
    return dq.unique(table(spark, sf, "orders"), ["o_orderkey"]).unionByName(
        dq.unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]))


@query("dq_relationship", _check_sql(
    "relationship", "host_id", """(select count(*) from orders where o_custkey is not null
      and not exists (select 1 from customer where c_custkey = o_custkey and c_nationkey <> 3))"""))
def dq_relationship(spark, sf):
    listing = listings.clean_listings(raw_listings(spark, sf))
    hosts = table(spark, sf, "customer").filter("c_nationkey <> 3")
    return dq.relationship(listing, "host_id", hosts, "c_custkey")


@query("dq_accepted", _check_sql("accepted_values", "o_orderpriority",
                                 "(select count(*) from orders where o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM'))"))
def dq_accepted(spark, sf):
    return dq.report(table(spark, sf, "orders"), [dq.accepted_values("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])])


@query("dq_regex", _check_sql("matches_regex", "price", "(select count(*) from orders where o_totalprice >= 1000 or o_totalprice < 10)"))
def dq_regex(spark, sf):
    """The price pattern wants two or more characters after the sign and no thousands separator."""
    return dq.report(raw_listings(spark, sf), [dq.matches("price", r"^\$[0-9][0-9\.]+$")]) 


@query("dq_rowcount", _check_sql("same_row_count", "*", "(select abs((select count(*) from orders) - (select count(*) from customer)))"))
def dq_rowcount(spark, sf):
    return dq.same_row_count(table(spark, sf, "orders"), table(spark, sf, "customer"))


@query("dq_freshness", """select max(ts) as newest, date_diff('microsecond', max(ts), timestamp '2024-01-31') / 3.6e9 as age_hours,
    case when date_diff('microsecond', max(ts), timestamp '2024-01-31') / 3.6e9 <= 1 then 'pass'
      when date_diff('microsecond', max(ts), timestamp '2024-01-31') / 3.6e9 <= 24 then 'warn' else 'error' end as status from events""")
def dq_freshness(spark, sf):
    return dq.freshness(table(spark, sf, "events"), "ts", dt.datetime(2024, 1, 31))


# ---------------------------------------------------------------- merge targets in key buckets

def _place(spark):
    return f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"


_BATCHES = """select o_orderkey, o_orderstatus, o_totalprice, o_orderdate, 0 as batch from orders
    union all select o_orderkey, 'X', o_totalprice + 1, o_orderdate + interval 1 day, 1 from orders where o_custkey % 50 = 7
    union all select o_orderkey + 1000000000, 'N', o_totalprice, o_orderdate, 1 from orders where o_custkey % 50 = 8
    union all select o_orderkey, 'Y', o_totalprice + 2, o_orderdate, 2 from orders where o_custkey % 50 between 7 and 9
    union all select o_orderkey, 'Z', o_totalprice + 3, o_orderdate - interval 1 day, 2 from orders where o_custkey % 50 = 10"""


@query("upsert_two_batches", f"""select o_orderkey, o_orderstatus, o_totalprice, o_orderdate from (
    select *, row_number() over (partition by o_orderkey order by o_orderdate desc, batch desc) as rn from ({_BATCHES})) where rn = 1""")
def upsert_two_batches(spark, sf):
    """A stored target after two batches: corrections and new keys, then newer, equal and stale versions."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_custkey")

    def changed(where, status, add, days=0, shift=0):
        return orders.filter(where).select(
            (F.col("o_orderkey") + shift).alias("o_orderkey"), F.lit(status).alias("o_orderstatus"),
            (F.col("o_totalprice") + add).alias("o_totalprice"),
            (F.col("o_orderdate") + F.expr(f"interval {days} days")).alias("o_orderdate"))

    target = BucketedTable.create(orders.drop("o_custkey"), _place(spark), ["o_orderkey"], buckets=64)
    target.upsert(changed("o_custkey % 50 = 7", "X", 1, days=1).unionByName(
        changed("o_custkey % 50 = 8", "N", 0, shift=1_000_000_000)), "o_orderdate")
    target.upsert(changed("o_custkey % 50 between 7 and 9", "Y", 2).unionByName(
        changed("o_custkey % 50 = 10", "Z", 3, days=-1)), "o_orderdate")
    return target.read()


_CARD = "select c_custkey, c_mktsegment, c_acctbal"


@query("scd2_two_batches", f"""{_CARD}, timestamp '2024-01-01' as valid_from,
      case when c_nationkey = 3 then timestamp '2024-02-01' when c_nationkey = 4 then timestamp '2024-03-15'
           when c_nationkey = 5 then timestamp '2024-03-01' end as valid_to from customer where c_nationkey <> 6
    union all select c_custkey, c_mktsegment, c_acctbal + 10, timestamp '2024-02-01', case when c_acctbal > 0 then timestamp '2024-03-01' end
      from customer where c_nationkey = 3
    union all select c_custkey, c_mktsegment, c_acctbal + 20, timestamp '2024-03-01', null from customer where c_nationkey = 3 and c_acctbal > 0
    union all select c_custkey, c_mktsegment, c_acctbal + 20, timestamp '2024-03-01', null from customer where c_nationkey = 5
    union all {_CARD}, timestamp '2024-02-01', null from customer where c_nationkey = 6""")
def scd2_two_batches(spark, sf):
    """A stored history after a batch of changes and new keys, and a snapshot with changes and keys that are gone."""
    stamp = lambda text: F.lit(text).cast("timestamp_ntz")
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")

    def at(df, text, add=0):
        return df.withColumns({"c_acctbal": F.col("c_acctbal") + add, "updated_at": stamp(text)})

    first = at(rows.filter("c_nationkey <> 6"), "2024-01-01").drop("c_nationkey")
    history = HistoryTable.create(first, _place(spark), "c_custkey", "updated_at", buckets=64)
    history.apply(at(rows.filter("c_nationkey = 3"), "2024-02-01", 10).unionByName(
        at(rows.filter("c_nationkey = 6"), "2024-02-01")).drop("c_nationkey"))
    third, newer = F.col("c_nationkey") == 3, (F.col("c_nationkey") == 5) | ((F.col("c_nationkey") == 3) & (F.col("c_acctbal") > 0))
    now = rows.filter("c_nationkey <> 4").withColumns({
        "updated_at": F.when(newer, stamp("2024-03-01")).when(third | (F.col("c_nationkey") == 6), stamp("2024-02-01")).otherwise(stamp("2024-01-01")),
        "c_acctbal": F.col("c_acctbal") + F.when(newer, 20).when(third, 10).otherwise(0)}).drop("c_nationkey")
    history.snapshot(now, dt.datetime(2024, 3, 15))
    return history.read().drop("updated_at")
