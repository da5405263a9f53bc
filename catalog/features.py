"""Imputers, scalers, encoders and text features."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import query, table
from catalog.relational import PRIORITIES
from rillstone.functions import text as tx
from rillstone.functions.columns import ordinal
from rillstone.operators import features as fe
from rillstone.operators import textvec as tv
from rillstone.session import spread

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_KEY = ", ".join(LINE_KEY)


def gappy_lines(spark, sf):
    """Order lines whose quantity is known for one line status only, and whose flag lacks one value."""
    return table(spark, sf, "lineitem").select(
        *LINE_KEY, "l_returnflag", F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).alias("qty"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"))


_GAPPY = """g as (select *, case when l_linestatus = 'O' then l_quantity end as qty,
    case when l_returnflag <> 'N' then l_returnflag end as flag from lineitem)"""


@query("impute_by_group", f"""with {_GAPPY} select {_KEY}, coalesce(qty, case l_returnflag when 'A' then 37.0
    when 'N' then 29.0 when 'R' then 24.0 end) as qty from g""")
def impute_by_group(spark, sf):
    filled = fe.impute_constant_by_group(gappy_lines(spark, sf), "qty", "l_returnflag", {"A": 37.0, "N": 29.0, "R": 24.0})
    return filled.select(*LINE_KEY, "qty")


@query("impute_group_median", f"""with {_GAPPY}, m as (select l_returnflag, quantile_cont(qty, 0.5) as med from g group by l_returnflag)
    select {_KEY}, coalesce(qty, med) as qty from g join m using (l_returnflag)""")
def impute_group_median(spark, sf):
    return fe.impute_median(gappy_lines(spark, sf), ["qty"], ["l_returnflag"]).select(*LINE_KEY, "qty")


@query("impute_median", f"with {_GAPPY} select {_KEY}, coalesce(qty, (select quantile_cont(qty, 0.5) from g)) as qty from g")
def impute_median(spark, sf):
    return fe.impute_median(gappy_lines(spark, sf), ["qty"]).select(*LINE_KEY, "qty")


@query("impute_mode", f"""with {_GAPPY} select {_KEY}, coalesce(flag, (select flag from g where flag is not null group by flag
    order by count(*) desc, flag limit 1)) as flag from g""")
def impute_mode(spark, sf):
    return fe.impute_mode(gappy_lines(spark, sf), ["flag"]).select(*LINE_KEY, "flag")


@query("zscore", """select p_partkey, round((p_size - avg(p_size) over ()) / stddev_pop(p_size) over (), 6) as p_size_z,
    round((p_retailprice - avg(p_retailprice) over ()) / stddev_pop(p_retailprice) over (), 6) as p_retailprice_z from part""")
def zscore(spark, sf):
    scaled = fe.standard_scale(table(spark, sf, "part"), ["p_size", "p_retailprice"])
    return scaled.select("p_partkey", F.round("p_size_z", 6).alias("p_size_z"), F.round("p_retailprice_z", 6).alias("p_retailprice_z"))


@query("minmax", """select p_partkey, round((p_size - min(p_size) over ()) / (max(p_size) over () - min(p_size) over ())::double, 6) as p_size_norm,
    0.0 as one_norm from part""")
def minmax(spark, sf):
    rows = table(spark, sf, "part").withColumn("one", F.lit(1.0))
    scaled = fe.min_max_scale(rows, ["p_size", "one"])
    return scaled.select("p_partkey", F.round("p_size_norm", 6).alias("p_size_norm"), "one_norm")


_ORDINALS = ", ".join(f"'{p}'" for p in PRIORITIES)


@query("ordinal_given", f"select o_orderkey, nullif(list_position([{_ORDINALS}], o_orderpriority), 0) - 1 as code from orders")
def ordinal_given(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", ordinal("o_orderpriority", PRIORITIES).cast("int").alias("code"))


@query("ordinal_sorted", """select p_partkey, cast(dense_rank() over (order by p_brand) - 1 as double) as p_brand_code,
    cast(dense_rank() over (order by p_type) - 1 as double) as p_type_code from part""")
def ordinal_sorted(spark, sf):
    return fe.ordinal_encode(table(spark, sf, "part"), ["p_brand", "p_type"]).select("p_partkey", "p_brand_code", "p_type_code")


@query("encode_and_scale", """with c as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
      dense_rank() over (order by l_returnflag) - 1 as f, dense_rank() over (order by l_linestatus) - 1 as s from lineitem)
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
      round((l_quantity - min(l_quantity) over ()) / (max(l_quantity) over () - min(l_quantity) over ()), 6) as l_quantity_norm,
      round((l_extendedprice - min(l_extendedprice) over ()) / (max(l_extendedprice) over () - min(l_extendedprice) over ()), 6) as l_extendedprice_norm,
      round(f / (max(f) over ())::double, 6) as l_returnflag_code_norm, round(s / (max(s) over ())::double, 6) as l_linestatus_code_norm from c""")
def encode_and_scale(spark, sf):
    """Two texts ordinal-encoded, then all four columns scaled to 0..1."""
    coded = fe.ordinal_encode(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])
    columns = ["l_quantity", "l_extendedprice", "l_returnflag_code", "l_linestatus_code"]
    scaled = fe.min_max_scale(coded, columns)
    return scaled.select(*LINE_KEY, *[F.round(f"{c}_norm", 6).alias(f"{c}_norm") for c in columns])


@query("one_hot", """select n_nationkey, cast(r_name = 'AFRICA' as integer) as "region_AFRICA", cast(r_name = 'ASIA' as integer) as "region_ASIA"
    from nation join region on n_regionkey = r_regionkey""")
def one_hot(spark, sf):
    """Fitted on two regions; the others are unknown and get zeros."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    rows = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", F.col("r_name").alias("region"))
    fitted = fe.fitted_values(rows.filter(F.col("region").isin("AFRICA", "ASIA")), "region")
    return fe.one_hot(rows, "region", fitted).drop("region")


@query("dummies", f"""select {_KEY}, cast(l_returnflag = 'N' as integer) as "l_returnflag_N", cast(l_returnflag = 'R' as integer) as "l_returnflag_R" from lineitem""")
def dummies(spark, sf):
    return fe.dummies(table(spark, sf, "lineitem").select(*LINE_KEY, "l_returnflag"), "l_returnflag")


# ---------------------------------------------------------------- text

_STOPS = ", ".join("'" + w.replace("'", "''") + "'" for w in tx.ENGLISH_STOP_WORDS)
_PLAIN = rf"""list_filter(string_split_regex(regexp_replace(text, '[!-/:-@\[-`{{-~]', '', 'g'), '[\s\p{{Z}}]+'),
    lambda w: w <> '' and lower(w) not in ({_STOPS}))"""
_TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"


@query("tokenize_stop", f"select doc_id, array_to_string({_PLAIN}, ' ') as words from documents")
def tokenize_stop(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.concat_ws(" ", tx.plain_words("text")).alias("words"))


_BAG = f"bag as (select doc_id, term, count(*) as n from (select doc_id, unnest({_TOKENS}) as term from documents) group by all)"


def _bag(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return tv.bag_of_words(spread(docs), "doc_id", tx.tokens("text")), docs


@query("bow_counts", f"with {_BAG} select * from bag")
def bow_counts(spark, sf):
    return _bag(spark, sf)[0]


@query("bow_stats", f"""with {_BAG} select (select count(*) from documents) as documents, count(distinct term) as vocabulary,
    count(*) as non_zero, round(count(*) * 100.0 / ((select count(*) from documents) * count(distinct term)), 6) as density_pct from bag""")
def bow_stats(spark, sf):
    bag, docs = _bag(spark, sf)
    return tv.bag_statistics(bag, docs, "doc_id").withColumn("density_pct", F.round("density_pct", 6))


@query("ngram_df", r"""with w as (select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_'']+[\p{L}\p{N}_]') as t from documents),
    g as (select doc_id, unnest(list_distinct(list_concat(t, list_transform(range(1, greatest(len(t), 1)), lambda i: t[i] || ' ' || t[i + 1])))) as term from w)
    select term, count(*) as df from g group by term having count(*) <= 0.02 * (select count(*) from documents)""")
def ngram_df(spark, sf):
    terms = tx.with_bigrams(tx.tokens("text", tx.WORDS_WITH_APOSTROPHE))
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return tv.document_frequency(docs, "doc_id", terms, max_share=0.02)


@query("tfidf", f"""with {_BAG}, d as (select term, count(*) as df from bag group by term),
    w as (select doc_id, bag.term, n, df, n * (ln((1.0 + (select count(*) from documents)) / (1.0 + df)) + 1) as w from bag join d on bag.term = d.term)
    select doc_id, term, n, df, round(w / sqrt(sum(w * w) over (partition by doc_id)), 6) as tfidf from w""")
def tfidf(spark, sf):
    bag, docs = _bag(spark, sf)
    return tv.tf_idf(bag, docs, "doc_id").withColumn("tfidf", F.round("tfidf", 6))
