"""Air-quality build over the event table.

Events stand in for readings: the user is the station, its nation the city and
its region the state; the event type is the kind of reading. Carbon monoxide
and ammonia have no event type, so those measures stay empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.base import query, table
from rillstone.functions import air_index
from rillstone.functions.columns import hash_key, hour_of, lookup
from rillstone.operators import fill
from rillstone.plans import air_quality as aq
from rillstone.plans import loads
from rillstone.session import shared_folder, stage

KIND_OF_EVENT = {"error": "PM2.5", "click": "PM10", "view": "NO2", "signup": "SO2", "purchase": "OZONE"}


def readings(spark, sf):
    events = table(spark, sf, "events").select("ts", "user_id", "event_type", "value")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    places = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    return events.join(places, events.user_id == places.c_custkey).select(
        hour_of("ts").alias("record_ts"),
        F.lit("World").alias("country"), F.col("r_name").alias("state"), F.col("n_name").alias("city"),
        F.col("user_id").cast("string").alias("station"),
        F.col("c_nationkey").cast("decimal(12,7)").alias("latitude"),
        # five whole digits and seven decimals hold any customer's number, so no two share a place
        F.expr("cast(c_custkey % 100000 as decimal(12,7)) + cast(c_custkey div 100000 as decimal(12,0)) * 0.0000001BD")
        .cast("decimal(12,7)").alias("longitude"),
        lookup("event_type", KIND_OF_EVENT).alias("pollutant_id"),
        F.col("value").cast("string").alias("pollutant_avg"),
    )


def star_tables(spark, sf):
    clean = stage(aq.clean_readings(readings(spark, sf)))  # a table of its own: three others read it
    return aq.index_fact(clean), stage(aq.time_dim(clean)), stage(aq.location_dim(clean))


PIVOT = """
readings as (
  select date_trunc('hour', ts) as record_ts, r_name as state, n_name as city,
         cast(user_id as varchar) as station, c_nationkey as lat, c_custkey % 100000 + (c_custkey // 100000) / 10000000.0 as lon, event_type, value
  from events
  join customer on user_id = c_custkey
  join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey
), pivoted as (
  select record_ts, state, city, station, lat, lon,
         max(case when event_type = 'click' then value end) as pm10_avg,
         max(case when event_type = 'error' then value end) as pm25_avg,
         max(case when event_type = 'signup' then value end) as so2_avg,
         max(case when event_type = 'view' then value end) as no2_avg,
         max(case when event_type = 'purchase' then value end) as o3_avg
  from readings group by all
)
"""
PRESENT = ["pm10_avg", "pm25_avg", "so2_avg", "no2_avg", "o3_avg"]


def _fill_sql(measure: str, scopes=("station", "city", "state", "")) -> str:
    parts = [measure]
    for scope in scopes:
        by = f"partition by {scope} " if scope else ""
        order = "order by record_ts, station, lat, lon"
        parts.append(f"last_value({measure} ignore nulls) over ({by}{order} rows between unbounded preceding and current row)")
        parts.append(f"first_value({measure} ignore nulls) over ({by}{order} rows between current row and unbounded following)")
    return "coalesce(" + ", ".join(parts) + f") as {measure}"


CLEAN = PIVOT + ", clean as (select record_ts, state, city, station, lat, lon, " + ", ".join(
    _fill_sql(m) for m in PRESENT) + " from pivoted)\n"

_SQL_KIND = {"PM2.5": "pm25_avg", "PM10": "pm10_avg", "NO2": "no2_avg", "SO2": "so2_avg", "O3": "o3_avg"}
BANDS = "bands(kind, pos, lo, hi, ilo, ihi) as (values " + ", ".join(
    f"('{kind}', {pos}, {lo}.0::double, {hi}.0::double, {ilo}, {ihi})"
    for pos, kind in enumerate(_SQL_KIND) for lo, hi, ilo, ihi in air_index.BANDS[kind]
) + ")\n"


def index_sql(source: str, key: str) -> str:
    """Long form: each measure against the band table, then the largest sub-index per row."""
    union = " union all ".join(
        f"select {key}, '{kind}' as kind, round({col}) as v from {source}" for kind, col in _SQL_KIND.items()
    )
    return f"""subs as (
      select {key}, l.kind, pos, (ihi - ilo) / (hi - lo) * (v - lo) + ilo as sub
      from ({union}) l join bands b on b.kind = l.kind and v between lo and hi
    ), indexed as (
      select {key}, cast(trunc(abs(max(sub))) as integer) as aqi,
             arg_min(kind, pos) filter (where best) as prominent_pollutant
      from (select *, sub = max(sub) over (partition by {key}) as best from subs) group by {key}
    )"""


def category_sql(c: str) -> str:
    return f"""case when {c} is null then 'Unknown' when {c} between 0 and 50 then 'Good'
      when {c} between 51 and 100 then 'Satisfactory' when {c} between 101 and 200 then 'Moderate'
      when {c} between 201 and 300 then 'Poor' when {c} between 301 and 400 then 'Very Poor'
      when {c} between 401 and 500 then 'Severe' else 'Out of Range' end"""


FACT = CLEAN + ", " + BANDS + ", " + index_sql("clean", "record_ts, station") + f""", fact as (
  select c.*, i.aqi, i.prominent_pollutant, {category_sql('i.aqi')} as aqi_category
  from clean c left join indexed i using (record_ts, station)
)
"""

_MEANS = ", ".join(
    f"cast(round(avg(cast({c} as decimal(18,6)))) as double) as {c}" for c in ["aqi", *PRESENT])


def mart_sql(keys: str, label_max: bool = False) -> str:
    if label_max:
        return f"""select {keys}, {_MEANS}, cast(null as double) as co_avg, cast(null as double) as nh3_avg,
          max(prominent_pollutant) as prominent_pollutant, max(aqi_category) as aqi_category
          from dated group by {keys}"""
    return f"""select m.*, cast(null as double) as co_avg, cast(null as double) as nh3_avg,
          p.prominent_pollutant, {category_sql('m.aqi')} as aqi_category
        from (select {keys}, {_MEANS} from dated group by {keys}) m
        left join (
          select {keys}, prominent_pollutant, row_number() over (
            partition by {keys} order by count(*) desc, prominent_pollutant) as rn
          from dated where prominent_pollutant is not null group by {keys}, prominent_pollutant
        ) p on {" and ".join(f"p.{k.strip()} = m.{k.strip()}" for k in keys.split(","))} and p.rn = 1"""


DATED = """, dated as (
  select *, cast(year(record_ts) as integer) as year, cast(month(record_ts) as integer) as month,
         cast(day(record_ts) as integer) as day from fact)
"""
DAILY_KEYS, MONTHLY_KEYS = "state, city, year, month, day", "state, year, month"
# one month of events has one row per state; days stand in for months in the charts over the mart
DAILY_STATE = FACT + DATED + ", mart as (" + mart_sql("state, year, month, day") + ")\n"


def clean_without_empty(df):
    return df.drop("co_avg", "nh3_avg", "country", "latitude", "longitude", "record_pk")


@query("pivot_kinds", f"with {PIVOT} select record_ts, state, city, station, {', '.join(PRESENT)} from pivoted")
def pivot_kinds(spark, sf):
    return clean_without_empty(aq.pivot_readings(readings(spark, sf)))


@query("impute_hierarchy", f"""with {PIVOT} select record_ts, state, city, station,
    {', '.join(_fill_sql(m, ('station', 'city', 'state')) for m in PRESENT)} from pivoted""")
def impute_hierarchy(spark, sf):
    filled = fill.hierarchical_fill(
        aq.pivot_readings(readings(spark, sf)), aq.MEASURES, [["station"], ["city"], ["state"]],
        ["record_ts", "station", "latitude", "longitude"])
    return clean_without_empty(filled)


@query("impute_global", f"with {CLEAN} select record_ts, state, city, station, {', '.join(PRESENT)} from clean")
def impute_global(spark, sf):
    return clean_without_empty(aq.clean_readings(readings(spark, sf)))


_EVENT_ORDER = "partition by user_id order by ts, event_id"


@query("ffill", f"""select event_id, last_value(case when event_type = 'purchase' then value end ignore nulls) over (
    {_EVENT_ORDER} rows between unbounded preceding and current row) as last_purchase from events""")
def ffill(spark, sf):
    """Value of the user's latest purchase up to each event."""
    known = F.when(F.col("event_type") == "purchase", F.col("value"))
    rows = table(spark, sf, "events").select("event_id", "ts", "user_id", known.alias("last_purchase"))
    return fill.forward_fill(rows, ["last_purchase"], ["user_id"], ["ts", "event_id"]).select("event_id", "last_purchase")


@query("bfill", f"""select event_id, first_value(case when event_type = 'purchase' then value end ignore nulls) over (
    {_EVENT_ORDER} rows between current row and unbounded following) as next_purchase from events""")
def bfill(spark, sf):
    """Value of the user's next purchase from each event on."""
    known = F.when(F.col("event_type") == "purchase", F.col("value"))
    rows = table(spark, sf, "events").select("event_id", "ts", "user_id", known.alias("next_purchase"))
    return fill.backward_fill(rows, ["next_purchase"], ["user_id"], ["ts", "event_id"]).select("event_id", "next_purchase")


@query("aqi_index", f"""with {PIVOT}, {BANDS}, {index_sql('pivoted', 'record_ts, station')}
    select p.record_ts, p.station, i.aqi from pivoted p left join indexed i using (record_ts, station)""")
def aqi_index(spark, sf):
    rows = aq.pivot_readings(readings(spark, sf))
    return rows.select("record_ts", "station", air_index.air_quality_index(aq.index_inputs()).alias("aqi"))


@query("aqi_prominent", f"""with {PIVOT}, {BANDS}, {index_sql('pivoted', 'record_ts, station')}
    select p.record_ts, p.station, i.prominent_pollutant
    from pivoted p left join indexed i using (record_ts, station)""")
def aqi_prominent(spark, sf):
    rows = aq.pivot_readings(readings(spark, sf))
    return rows.select("record_ts", "station", air_index.leading_pollutant(aq.index_inputs()).alias("prominent_pollutant"))


@query("aqi_category", f"""select event_id, {category_sql('value')} as aqi_category from events""")
def aqi_category(spark, sf):
    """Label of the raw value: fractions between two bands are out of range."""
    return table(spark, sf, "events").select("event_id", air_index.index_category(F.col("value")).alias("aqi_category"))


@query("dim_location", f"""with {CLEAN}
    select distinct cast(lat as double) as latitude, cast(lon as double) as longitude, state, city, station from clean""")
def dim_location(spark, sf):
    dim = aq.location_dim(aq.clean_readings(readings(spark, sf)))
    return dim.select(
        F.col("latitude").cast("double"), F.col("longitude").cast("double"), "state", "city", "station")


@query("dim_time", """with h as (select distinct date_trunc('hour', ts) as record_ts from events)
    select record_ts, cast(year(record_ts) as integer) as aqi_year, cast(quarter(record_ts) as integer) as aqi_quarter,
      cast(month(record_ts) as integer) as aqi_month, cast(day(record_ts) as integer) as aqi_day,
      cast(dayofweek(record_ts) + 1 as integer) as day_of_week, dayofweek(record_ts) in (0, 6) as is_weekend,
      cast(hour(record_ts) as integer) as aqi_hour from h""")
def dim_time(spark, sf):
    return aq.time_dim(table(spark, sf, "events").select(hour_of("ts").alias("record_ts"))).drop("date_pk")


_FACT_COLUMNS = "aqi, prominent_pollutant, aqi_category, " + ", ".join(PRESENT)


@query("latest_fact_view", f"""with {FACT} select record_ts, state, city, station, {_FACT_COLUMNS} from fact""")
def latest_fact_view(spark, sf):
    view = aq.fact_view(*star_tables(spark, sf))
    return view.select("record_ts", "state", "city", "station", *_FACT_COLUMNS.split(", "))


@query("star_daily", f"with {FACT}{DATED} {mart_sql(DAILY_KEYS)}")
def star_daily(spark, sf):
    return aq.daily_by_city(*star_tables(spark, sf)).drop("record_pk")


@query("star_two_loads", f"with {FACT}{DATED} {mart_sql(DAILY_KEYS)}")
def star_two_loads(spark, sf):
    """The daily mart after two loads, the second with readings of a day the first had stored."""
    rows = readings(spark, sf)
    rows = rows.withColumn("record_id", hash_key("station", "pollutant_id", "record_ts", "pollutant_avg"))
    late = F.expr("day(record_ts) >= 24 or day(record_ts) = 17 and hour(record_ts) % 3 = 0")
    folder = f"{shared_folder(spark)}/warehouse/{uuid.uuid4().hex}"
    loads.load(spark, rows.filter(~late), folder)
    loads.load(spark, rows.filter(late), folder)
    return loads.tables(spark, folder)["daily_by_city"].drop("record_pk")


@query("star_monthly", f"with {FACT}{DATED} {mart_sql(MONTHLY_KEYS)}")
def star_monthly(spark, sf):
    return aq.monthly_by_state(*star_tables(spark, sf)).drop("record_pk")


@query("star_monthly_label_max", f"with {FACT}{DATED} {mart_sql(MONTHLY_KEYS, True)}")
def star_monthly_label_max(spark, sf):
    return aq.monthly_by_state(*star_tables(spark, sf), label_max=True).drop("record_pk")


def state_days(spark, sf):
    """Mart per state and day, used as the mart of the charts (the events span one month)."""
    return aq._mart(*star_tables(spark, sf), ["state", "year", "month", "day"], label_max=False)


@query("mom_change", f"""with {DAILY_STATE} select state, day, aqi,
      lag(aqi) over w as aqi_prev, aqi - lag(aqi) over w as aqi_change,
      round_even((aqi - lag(aqi) over w) / nullif(lag(aqi) over w, 0) * 100, 1) as aqi_pct_change
    from mart window w as (partition by state order by year, month, day)""")
def mom_change(spark, sf):
    from rillstone.operators.aggregates import change_from_previous

    changed = change_from_previous(state_days(spark, sf), "state", ["year", "month", "day"], "aqi")
    return changed.select("state", "day", "aqi", "aqi_prev", "aqi_change", "aqi_pct_change")


@query("winners_losers", f"""with {DAILY_STATE}, changed as (
      select state, day, aqi - lag(aqi) over w as aqi_change
      from mart window w as (partition by state order by year, month, day)
    ), k as (select * from changed where aqi_change is not null)
    select * from (
      select state, day, aqi_change, 'largest' as side from k order by aqi_change desc, state, day limit 5)
    union all select * from (
      select state, day, aqi_change, 'smallest' as side from k order by aqi_change, state, day limit 5)""")
def winners_losers(spark, sf):
    from rillstone.operators.aggregates import change_from_previous, ranked_extremes

    changed = change_from_previous(state_days(spark, sf), "state", ["year", "month", "day"], "aqi")
    rows = changed.select("state", "day", "aqi_change")
    return ranked_extremes(rows, "aqi_change", 5, ["state", "day"])


@query("mode_distribution", f"""with {FACT}, modes as (
      select station, aqi_category, row_number() over (
        partition by station order by count(*) desc, aqi_category) as rn from fact group by station, aqi_category)
    select aqi_category, count(*) as count from modes where rn = 1 group by aqi_category""")
def mode_distribution(spark, sf):
    from rillstone.operators.aggregates import mode_distribution as distribution

    fact, _, places = star_tables(spark, sf)
    rows = fact.join(places, fact.location_fk == places.location_pk).select("station", "aqi_category")
    return distribution(rows, "station", "aqi_category")


@query("leaderboard", f"""with {DAILY_STATE}, cats as (
      select state, aqi_category, row_number() over (
        partition by state order by count(*) desc, aqi_category) as rn from mart group by state, aqi_category)
    select m.state, round(avg(aqi), 6) as aqi, c.aqi_category,
      case c.aqi_category when 'Good' then '🟢' when 'Satisfactory' then '🟢' when 'Moderate' then '🟡'
        when 'Poor' then '🟠' when 'Very Poor' then '🔴' when 'Severe' then '🟣' else '' end
        || ' ' || c.aqi_category as aqi_level
    from mart m join cats c on c.state = m.state and rn = 1 group by m.state, c.aqi_category""")
def leaderboard(spark, sf):
    return aq.severity_board(state_days(spark, sf)).withColumn("aqi", F.round("aqi", 6))


_SUMS = " union all ".join(
    f"select state, '{m}' as pollutant, sum({m}) as avg_value from mart group by state" for m in PRESENT)


@query("stack_share", f"""with {DAILY_STATE}, sums as ({_SUMS})
    select state, pollutant, avg_value, round(avg_value / sum(avg_value) over (partition by state), 6) as share from sums""")
def stack_share(spark, sf):
    shares = aq.composition(state_days(spark, sf)).filter("avg_value is not null")
    return shares.withColumn("share", F.round("share", 6))


_MEAN_ROWS = " union all ".join(
    f"select '{m.upper().replace('_AVG', '')}' as measure, round(avg({m}), 6) as average from mart" for m in PRESENT)


@query("col_means_long", f"with {DAILY_STATE} {_MEAN_ROWS}")
def col_means_long(spark, sf):
    means = aq.national_means(state_days(spark, sf)).filter("average is not null")
    return means.withColumn("average", F.round("average", 6))


@query("rowsum_mean", f"""with {DAILY_STATE}
    select 'Particulate Matter' as category, round(avg(coalesce(pm25_avg, 0) + coalesce(pm10_avg, 0)), 6) as average from mart
    union all
    select 'Gaseous Pollutants', round(avg(coalesce(so2_avg, 0) + coalesce(no2_avg, 0) + coalesce(o3_avg, 0)), 6) from mart""")
def rowsum_mean(spark, sf):
    return aq.particulate_vs_gaseous(state_days(spark, sf)).withColumn("average", F.round("average", 6))


@query("rowsum_modes", f"""with {PIVOT} select record_ts, station,
      round(pm10_avg + pm25_avg, 6) as strict_total,
      round(coalesce(pm10_avg, 0) + coalesce(pm25_avg, 0), 6) as skip_total from pivoted""")
def rowsum_modes(spark, sf):
    from rillstone.functions.columns import row_total

    rows = aq.pivot_readings(readings(spark, sf))
    return rows.select(
        "record_ts", "station",
        F.round(row_total(aq.PARTICULATE, skip_nulls=False), 6).alias("strict_total"),
        F.round(row_total(aq.PARTICULATE, skip_nulls=True), 6).alias("skip_total"))


_LONG = " union all ".join(
    f"select make_date(year, month, 1) as time, state, '{m}' as pollutant, {m} as v from mart" for m in PRESENT)


@query("unpivot_measures", f"""with {DAILY_STATE}, long as ({_LONG})
    select time, state, pollutant, round(avg(v), 6) as concentration from long group by all""")
def unpivot_measures(spark, sf):
    """Monthly trend of each pollutant per state."""
    trend = aq.pollutant_trend(state_days(spark, sf)).filter("concentration is not null")
    return trend.withColumn("concentration", F.round("concentration", 6))


@query("period_trend", f"""with {DAILY_STATE}, long as ({_LONG})
    select make_date(year(time), 1, 1) as time, state, pollutant, round(avg(v), 6) as concentration
    from long group by all""")
def period_trend(spark, sf):
    """Yearly trend: the rows of each year are averaged."""
    trend = aq.pollutant_trend(state_days(spark, sf), yearly=True).filter("concentration is not null")
    return trend.withColumn("concentration", F.round("concentration", 6))


@query("heat_map", f"""with {DAILY_STATE}
    select state, month, strftime(make_date(year, month, 1), '%b') as month_name, pm10_avg
    from mart where year = 2024""")
def heat_map(spark, sf):
    return aq.heat_map(state_days(spark, sf), "pm10_avg", 2024)


@query("pollutant_frequency", f"""with {DAILY_STATE}
    select prominent_pollutant, count(*) as count from mart where prominent_pollutant is not null
    group by prominent_pollutant order by count desc, prominent_pollutant limit 7""")
def pollutant_frequency(spark, sf):
    return aq.pollutant_frequency(state_days(spark, sf))
