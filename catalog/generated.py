"""Synthetic tables with a row for every key of a given table."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import query, table
from catalog.relational import uniform_sql as u
from rillstone.operators import generate as gen


def int_sql(seed, low, high, key):
    return f"cast(floor({u(seed, key)} * {high - low + 1}) + {low} as bigint)"


def pick_sql(values, seed, key):
    return f"([{', '.join(repr(v) for v in values)}])[{int_sql(seed, 0, len(values) - 1, key)} + 1]"


def normal_sql(seed, key):
    return f"(sqrt(-2.0 * ln(1.0 - {u(f'{seed}.a', key)})) * cos(2.0 * pi() * {u(f'{seed}.b', key)}))"


_FIRST, _LAST = pick_sql(gen.FIRST_NAMES, "3.first", "c_custkey"), pick_sql(gen.LAST_NAMES, "3.last", "c_custkey")


@query("gen_people", f"""select c_custkey, {_FIRST} || ' ' || {_LAST} as name,
    {int_sql('3.number', 1, 999, 'c_custkey')} || ' ' || {pick_sql(gen.STREETS, '3.street', 'c_custkey')} as address,
    {pick_sql(gen.CITIES, '3.city', 'c_custkey')} as city, {pick_sql(gen.STATES, '3.state', 'c_custkey')} as state,
    lower({_FIRST}) || '.' || lower({_LAST}) || c_custkey || '@example.com' as email from customer""")
def gen_people(spark, sf):
    return gen.people(table(spark, sf, "customer"), "c_custkey", seed=3)


_BLOCKS = " union all ".join(
    f"""select c_custkey, cast({int_sql(f'0.{name}.score', *score, 'c_custkey')} as varchar) as user_interest_score,
    {int_sql(f'0.{name}.rating', *rating, 'c_custkey')} as user_rating, {label} as label, '{name}' as class from customer"""
    for name, label, score, rating in [("not_interested", "false", (0, 4), (0, 3)), ("add_to_wishlist", "false", (4, 7), (3, 7)),
                                       ("purchase", "true", (7, 10), (7, 10))])


@query("gen_uniform", _BLOCKS)
def gen_uniform(spark, sf):
    return gen.interest_blocks(table(spark, sf, "customer"), "c_custkey")


@query("gen_regression", f"""select p_partkey, round({normal_sql('0.x1', 'p_partkey')}, 6) as x1, round({normal_sql('0.x2', 'p_partkey')}, 6) as x2,
    round({normal_sql('0.x1', 'p_partkey')} * 30.0 + {normal_sql('0.x2', 'p_partkey')} * 70.0 + {normal_sql('0.noise', 'p_partkey')} * 0.1, 6) as y,
    chr(({int_sql('0.c1.0', 0, 25, 'p_partkey')} + 65)::integer) || chr(({int_sql('0.c1.1', 0, 25, 'p_partkey')} + 65)::integer) as c1 from part""")
def gen_regression(spark, sf):
    rows = gen.regression_table(table(spark, sf, "part"), "p_partkey", [30.0, 70.0], categories=1)
    return rows.withColumns({c: F.round(c, 6) for c in ("x1", "x2", "y")})


@query("gen_classification", f"""select p_partkey, {int_sql('0.y', 0, 1, 'p_partkey')}::integer as y,
    round({normal_sql('0.x1', 'p_partkey')} + case when {int_sql('0.y', 0, 1, 'p_partkey')} = 1 then 1.0 else -1.0 end, 6) as x1,
    round({normal_sql('0.x6', 'p_partkey')} + 0.0, 6) as x6 from part""")
def gen_classification(spark, sf):
    rows = gen.classification_table(table(spark, sf, "part"), "p_partkey")
    return rows.select("p_partkey", "y", F.round("x1", 6).alias("x1"), F.round("x6", 6).alias("x6"))


@query("calendar_cross", f"""with template as (select user_id, event_type, max(value) as base from events group by all),
    hours as (select unnest(range(timestamp '2024-01-01', timestamp '2024-01-03', interval 1 hour)) as record_ts)
    select user_id, event_type, record_ts, greatest(round(base * (1.0 + ({u(0, 'user_id', 'event_type', "strftime(record_ts, '%Y-%m-%d %H')")} * 2.0 - 1.0) * 0.15), 1), 0.0) as reading
    from template, hours""")
def calendar_cross(spark, sf):
    """Two days of hourly readings around the template value of every station and kind."""
    template = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.max("value").alias("base"))
    grid = gen.hourly_readings(template, ["user_id", "event_type"], "base", "2024-01-01", "2024-01-02 23:00:00")
    return grid.drop("base")
