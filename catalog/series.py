"""Forecasts and anomaly flags over daily order totals."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalog.base import query, table
from rillstone.functions.columns import uniform
from rillstone.operators import seasons as sn
from rillstone.operators import series as ts
from rillstone.operators import tablefunctions as tf

CUT = dt.date(2000, 1, 1)
Z95, Z90, Z99 = (ts.z_score(level) for level in (0.95, 0.9, 0.99))


def daily(spark, sf, keys=("o_orderpriority",)):
    orders = table(spark, sf, "orders")
    return orders.groupBy(*keys, F.to_date("o_orderdate").alias("day")).agg(
        F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).alias("n_orders"))


def _daily_sql(key):
    keys = f"{key}, " if key else ""
    return f"""daily as (select {keys}cast(o_orderdate as date) as day, sum(o_totalprice) as total, count(*) as n_orders,
      (cast(o_orderdate as date) - date '1970-01-01')::double as t from orders group by all)"""


def _fit_sql(key, where="true"):
    keys = f"{key}, " if key else ""
    group = f"group by {key}" if key else ""
    return f"""fit as (select {keys}regr_slope(total, t) as slope, regr_intercept(total, t) as intercept, max(day) as last_day,
      sqrt(greatest((regr_syy(total, t) - regr_slope(total, t) * regr_sxy(total, t)) / (count(*) - 2), 0)) as sigma
      from daily where {where} {group})"""


def _ahead_sql(key, periods, z):
    keys = f"{key}, " if key else ""
    value = "intercept + slope * ((last_day + s::integer) - date '1970-01-01')"
    return f"""select {keys}(last_day + s::integer)::date as ts, round({value}, 2) as forecast, round({value} - sigma * {z!r}, 2) as lower_bound,
      round({value} + sigma * {z!r}, 2) as upper_bound from fit, range(1, {periods + 1}) r(s)"""


def _rounded(df):
    return df.withColumns({c: F.round(c, 2) for c in ("forecast", "lower_bound", "upper_bound")})


@query("forecast_single", f"with {_daily_sql('')}, {_fit_sql('')} {_ahead_sql('', 30, Z95)}")
def forecast_single(spark, sf):
    return _rounded(ts.forecast(ts.fit_trend(daily(spark, sf, ()), [], "day", "total"), [], 30))


@query("forecast_multi", f"with {_daily_sql('o_orderpriority')}, {_fit_sql('o_orderpriority')} {_ahead_sql('o_orderpriority', 14, Z95)}")
def forecast_multi(spark, sf):
    keys = ["o_orderpriority"]
    return _rounded(ts.forecast(ts.fit_trend(daily(spark, sf), keys, "day", "total"), keys, 14))


@query("forecast_two_keys", f"with {_daily_sql('o_orderpriority, o_orderstatus')}, {_fit_sql('o_orderpriority, o_orderstatus')} "
       f"{_ahead_sql('o_orderpriority, o_orderstatus', 14, Z95)}")
def forecast_two_keys(spark, sf):
    keys = ["o_orderpriority", "o_orderstatus"]
    return _rounded(ts.forecast(ts.fit_trend(daily(spark, sf, keys), keys, "day", "total"), keys, 14))


@query("forecast_interval", f"with {_daily_sql('o_orderpriority')}, {_fit_sql('o_orderpriority')} {_ahead_sql('o_orderpriority', 30, Z90)}")
def forecast_interval(spark, sf):
    keys = ["o_orderpriority"]
    return _rounded(ts.forecast(ts.fit_trend(daily(spark, sf), keys, "day", "total"), keys, 30, level=0.9))


@query("forecast_weekly", f"""with {_daily_sql('o_orderpriority')}, {_fit_sql('o_orderpriority')},
    season as (select o_orderpriority, isodow(day) as dow, avg(total - intercept - slope * t) as s from daily join fit using (o_orderpriority) group by all)
    select o_orderpriority, (last_day + i::integer)::date as ts,
      round(intercept + slope * ((last_day + i::integer) - date '1970-01-01') + coalesce(s, 0), 2) as forecast
    from fit cross join range(1, 15) r(i) left join season using (o_orderpriority)
    where isodow((last_day + i::integer)::date) = dow""")
def forecast_weekly(spark, sf):
    keys = ["o_orderpriority"]
    ahead = ts.forecast(ts.fit_trend(daily(spark, sf), keys, "day", "total", weekly=True), keys, 14)
    return ahead.select(*keys, "ts", F.round("forecast", 2).alias("forecast"))


@query("forecast_exog", f"""with {_daily_sql('o_orderpriority')}, c as (select o_orderpriority, max(day) as last_day, avg(t) as m1, avg(n_orders) as m2, avg(total) as my,
      var_pop(t) as s11, var_pop(n_orders) as s22, covar_pop(t, n_orders) as s12, covar_pop(t, total) as s1y, covar_pop(n_orders, total) as s2y
      from daily group by o_orderpriority),
    b as (select *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) as b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) as b2 from c)
    select o_orderpriority, (last_day + s::integer)::date as day, s::integer as n_orders,
      round(my + b1 * (((last_day + s::integer) - date '1970-01-01') - m1) + b2 * (s - m2), 1) as forecast from b, range(1, 15) r(s)""")
def forecast_exog(spark, sf):
    """Two weeks ahead, given how many orders each day will bring."""
    keys, rows = ["o_orderpriority"], daily(spark, sf)
    features = {"t": ts.day_number("day"), "n_orders": F.col("n_orders")}
    future = rows.groupBy(*keys).agg(F.max("day").alias("last")).withColumn(
        "n_orders", F.explode(F.sequence(F.lit(1), F.lit(14)))).select(
        *keys, F.date_add("last", F.col("n_orders")).alias("day"), "n_orders")
    scored = ts.predict_linear(ts.fit_linear(rows, keys, features, "total"), future, keys, features)
    return scored.select(*keys, "day", "n_orders", F.round("forecast", 1).alias("forecast"))


_BEFORE = f"day < date '{CUT}'"


@query("forecast_eval", f"""with {_daily_sql('o_orderpriority')}, {_fit_sql('o_orderpriority', _BEFORE)},
    e as (select o_orderpriority, total as y, intercept + slope * t as p from daily join fit using (o_orderpriority) where not ({_BEFORE}))
    select o_orderpriority, count(*) as n, round(avg(abs(y - p)), 2) as mae, round(avg((y - p) ** 2) / 1e6, 3) as mse_millions,
      round(avg(abs(y - p) / abs(y)) filter (where y <> 0), 6) as mape from e group by o_orderpriority""")
def forecast_eval(spark, sf):
    keys = ["o_orderpriority"]
    m = ts.holdout_metrics(daily(spark, sf), keys, "day", "total", F.lit(CUT))
    return m.select(*keys, "n", F.round("mae", 2).alias("mae"), F.round(F.col("mse") / 1e6, 3).alias("mse_millions"),
                    F.round("mape", 6).alias("mape"))


@query("anomaly_flags", f"""with {_daily_sql('o_orderpriority')}, {_fit_sql('o_orderpriority', _BEFORE)}
    select o_orderpriority, day, round(total, 2) as total, round(intercept + slope * t, 2) as forecast,
      total not between intercept + slope * t - sigma * {Z99!r} and intercept + slope * t + sigma * {Z99!r} as is_anomaly
    from daily join fit using (o_orderpriority) where not ({_BEFORE})""")
def anomaly_flags(spark, sf):
    keys = ["o_orderpriority"]
    flags = ts.detect_anomalies(daily(spark, sf), keys, "day", "total", CUT)
    return flags.select(*keys, "day", F.round("total", 2).alias("total"), F.round("forecast", 2).alias("forecast"), "is_anomaly")


@query("anomaly_deviation", f"""with {_daily_sql('o_orderpriority')}, base as (select o_orderpriority, avg(total) as m, stddev_samp(total) as s
      from daily where {_BEFORE} group by o_orderpriority)
    select o_orderpriority, day, round(total, 2) as total, abs(total - m) > s * 2.0 as is_anomaly
    from daily join base using (o_orderpriority) where not ({_BEFORE})""")
def anomaly_deviation(spark, sf):
    flags = ts.deviation_flags(daily(spark, sf), ["o_orderpriority"], "day", "total", CUT, z=2.0)
    return flags.select("o_orderpriority", "day", F.round("total", 2).alias("total"), "is_anomaly")


@query("actual_forecast_union", f"""with {_daily_sql('o_orderpriority')}, {_fit_sql('o_orderpriority')},
    ahead as ({_ahead_sql('o_orderpriority', 30, Z95)})
    select o_orderpriority, day as ts, round(total, 2) as actual, null::double as forecast, null::double as lower_bound, null::double as upper_bound from daily
    union all select o_orderpriority, ts, null, forecast, lower_bound, upper_bound from ahead""")
def actual_forecast_union(spark, sf):
    keys, rows = ["o_orderpriority"], daily(spark, sf)
    ahead = ts.forecast(ts.fit_trend(rows, keys, "day", "total"), keys, 30)
    both = ts.actual_and_forecast(rows, ahead, keys, "day", "total")
    return _rounded(both).withColumn("actual", F.round("actual", 2))


# ---------------------------------------------------------------- seasons, table functions, robust flags

# Days of orders carry values of a known rule, by priority: level, slope a year, seasons' amplitudes, and a little noise.
_RULES = {
    "1-URGENT": (500.0, 20.0, {"year": 60.0}), "2-HIGH": (300.0, -10.0, {"week": 25.0}), "3-MEDIUM": (200.0, 0.0, {"month": 30.0}),
    "4-NOT SPECIFIED": (100.0, 5.0, {}), "5-LOW": (800.0, 15.0, {"week": 40.0, "year": 90.0}),
}


def _rule(day: Column) -> Column:
    """The rule's value for a day number."""
    value = F.lit(None).cast("double")
    for name, (level, slope, waves) in _RULES.items():
        at = F.lit(level) + slope * (day - sn.EPOCH) / sn.YEAR.days
        for season, height in waves.items():
            at = at + height * F.sin((day - sn.EPOCH) * (2 * math.pi / sn.KNOWN[season].days))
        value = F.when(F.col("o_orderpriority") == name, at).otherwise(value)
    return value


def measured(spark, sf):
    """A value for each priority and day that has orders: the rule, and noise below 2."""
    days = table(spark, sf, "orders").select("o_orderpriority", F.to_date("o_orderdate").alias("day")).distinct()
    day = ts.day_number("day")
    noise = 4 * uniform(17, F.unix_date("day")) - 2
    return days.withColumn("value", _rule(day) + noise)


@query("forecast_seasons", " union all ".join(
    f"select '{name}' as o_orderpriority, '{','.join(s for s in ('week', 'month', 'year') if s in waves)}' as seasons, "
    f"{slope}::double as slope_a_year, " + ", ".join(f"{waves.get(s, 0.0)}::double as {s}" for s in ("week", "month", "year"))
    for name, (_, slope, waves) in _RULES.items()))
def forecast_seasons(spark, sf):
    """Which seasons each series has, and how large: weekly, monthly, yearly, two or none."""
    model = sn.fit(measured(spark, sf), ["o_orderpriority"], "day", "value")
    first = {"week": 2, "month": 8, "year": 12}  # where each season's first sine stands among the coefficients
    return model.select(
        "o_orderpriority", F.array_join("seasons", ",").alias("seasons"),
        (F.round(F.try_element_at("coefficients", F.lit(1)) / 5) * 5).alias("slope_a_year"),
        *[(F.round(F.try_element_at("coefficients", F.lit(i)) / 5) * 5).alias(s) for s, i in first.items()])


def _rule_sql(day):
    def at(level, slope, waves):
        return f"{level} + {slope} * ({day} - {sn.EPOCH}) / {sn.YEAR.days}" + "".join(
            f" + {h} * sin(({day} - {sn.EPOCH}) * 2 * pi() / {sn.KNOWN[s].days})" for s, h in waves.items())

    return "case o_orderpriority " + " ".join(f"when '{n}' then {at(*r)}" for n, r in _RULES.items()) + " end"


@query("forecast_a_year_ahead", f"""with e as (select o_orderpriority, max(cast(o_orderdate as date)) as last_day from orders group by all),
    f as (select o_orderpriority, (last_day + s::integer)::date as ts, ((last_day + s::integer) - date '1970-01-01')::double as d from e, range(1, 366) r(s))
    select o_orderpriority, ts, true as near, true as inside from f where {_rule_sql('d')} is not null""")
def forecast_a_year_ahead(spark, sf):
    """A year of days ahead: each forecast lies near the rule that made the data, and the rule inside the interval."""
    keys = ["o_orderpriority"]
    ahead = sn.forecast(sn.fit(measured(spark, sf), keys, "day", "value"), keys, 365, level=0.999)
    rule = _rule(ts.day_number("ts"))
    return ahead.select(*keys, "ts", (F.abs(F.col("forecast") - rule) < 4).alias("near"),
                        rule.between(F.col("lower_bound"), F.col("upper_bound")).alias("inside"))


_WIDE_FIT = """fit as (select o_orderpriority, count(*) as n, avg(t) as mt, var_pop(t) as vt, regr_slope(total, t) as slope,
      regr_intercept(total, t) as intercept, max(day) as last_day,
      sqrt((regr_syy(total, t) - regr_slope(total, t) * regr_sxy(total, t)) / (count(*) - 2)) as sigma
      from daily where {where} group by o_orderpriority)"""


def _wide_sql(day, z):
    value = f"intercept + slope * {day}"
    half = f"sigma * {z!r} * sqrt(1 + (1 + ({day} - mt) ** 2 / vt) / n)"
    return value, f"({value} - {half})", f"({value} + {half})"


_AHEAD = _wide_sql("((last_day + s::integer) - date '1970-01-01')", Z90)


@query("forecast_widening", f"""with {_daily_sql('o_orderpriority')}, {_WIDE_FIT.format(where='true')}
    select o_orderpriority, (last_day + s::integer)::date as ts, round({_AHEAD[0]}, 2) as forecast, round({_AHEAD[1]}, 2) as lower_bound,
      round({_AHEAD[2]}, 2) as upper_bound from fit, range(1, 401) r(s)""")
def forecast_widening(spark, sf):
    """A line's interval widens the further the day lies from the data."""
    keys = ["o_orderpriority"]
    return _rounded(sn.forecast(sn.fit(daily(spark, sf), keys, "day", "total", ()), keys, 400, (), level=0.9))


def _with_view(spark, sf):
    tf.register(spark)
    daily(spark, sf).createOrReplaceTempView("daily_totals")


@query("sql_forecast", f"""with {_daily_sql('o_orderpriority')}, {_WIDE_FIT.format(where='true')}
    select o_orderpriority, (last_day + s::integer)::date as ts, round({_AHEAD[0]}, 2) as forecast, round({_AHEAD[1]}, 2) as lower_bound,
      round({_AHEAD[2]}, 2) as upper_bound from fit, range(1, 15) r(s)""")
def sql_forecast(spark, sf):
    """The same model called as a table function."""
    _with_view(spark, sf)
    return _rounded(spark.sql("""
        SELECT * FROM forecast(input_data => TABLE(daily_totals) PARTITION BY o_orderpriority, series_colname => 'o_orderpriority',
          timestamp_colname => 'day', target_colname => 'total', forecasting_periods => 14, prediction_interval => 0.9)"""))


_HERE = _wide_sql("t", Z99)


@query("sql_detect_anomalies", f"""with {_daily_sql('o_orderpriority')}, {_WIDE_FIT.format(where=_BEFORE)}
    select o_orderpriority, day as ts, round(total, 2) as y, round({_HERE[0]}, 2) as forecast, total not between {_HERE[1]} and {_HERE[2]} as is_anomaly
    from daily join fit using (o_orderpriority) where not ({_BEFORE})""")
def sql_detect_anomalies(spark, sf):
    """Flags of the days from the cut on, called as a table function."""
    _with_view(spark, sf)
    flags = spark.sql(f"""
        SELECT * FROM detect_anomalies(input_data => TABLE(daily_totals) PARTITION BY o_orderpriority ORDER BY day,
          series_colname => 'o_orderpriority', timestamp_colname => 'day', target_colname => 'total', since => '{CUT}')""")
    return flags.select("o_orderpriority", "ts", F.round("y", 2).alias("y"), F.round("forecast", 2).alias("forecast"), "is_anomaly")


def spiked(spark, sf):
    """A known line by priority, noise below 2, and every tenth day far above it, before the cut and after."""
    days = table(spark, sf, "orders").select("o_orderpriority", F.to_date("o_orderdate").alias("day")).distinct()
    no = F.unix_date("day")
    level = F.ascii("o_orderpriority") * 10.0
    spike = F.when(no % 10 == 3, 500.0 + (no % 7) * 100.0).otherwise(0.0)
    return days.withColumn("value", level + 0.01 * no + 4 * uniform(17, no) - 2 + spike)


@query("anomaly_robust", f"""select distinct o_orderpriority, cast(o_orderdate as date) as day,
      (cast(o_orderdate as date) - date '1970-01-01') % 10 = 3 as is_anomaly
    from orders where cast(o_orderdate as date) >= date '{CUT}'""")
def anomaly_robust(spark, sf):
    """Spikes before the cut do not widen the interval, so those after it are all found, and nothing else."""
    flags = ts.detect_anomalies(spiked(spark, sf), ["o_orderpriority"], "day", "value", CUT, level=0.9999, robust=True)
    return flags.select("o_orderpriority", "day", "is_anomaly")
