"""Air-quality tables: documents -> readings -> clean rows -> star schema -> marts -> chart tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions import air_index
from rillstone.functions.columns import (
    calendar_parts, hash_key, lookup, parse_number, parse_timestamp, period_start, month_name,
)
from rillstone.operators import aggregates as agg
from rillstone.operators.fill import hierarchical_fill
from rillstone.operators.joins import star

# Kind of reading -> measure column, and measure column -> name in the index table.
KIND_COLUMNS = {
    "PM10": "pm10_avg", "PM2.5": "pm25_avg", "SO2": "so2_avg", "NO2": "no2_avg",
    "NH3": "nh3_avg", "CO": "co_avg", "OZONE": "o3_avg",
}
INDEX_NAMES = {
    "pm25_avg": "PM2.5", "pm10_avg": "PM10", "no2_avg": "NO2", "so2_avg": "SO2",
    "co_avg": "CO", "o3_avg": "O3", "nh3_avg": "NH3",
}
MEASURES = list(KIND_COLUMNS.values())
# The measures of each group on the charts.
PARTICULATE = ["pm25_avg", "pm10_avg"]
GASEOUS = ["so2_avg", "no2_avg", "o3_avg", "co_avg", "nh3_avg"]
STATION_KEYS = ["country", "state", "city", "station", "latitude", "longitude"]
# a gap is filled from the first of these that knows a value; the order is unique within each
FILL_LEVELS = [["station"], ["city"], ["state"], []]
CITY_DAY, STATE_MONTH = ["state", "city", "year", "month", "day"], ["state", "year", "month"]
_AVERAGED = ["aqi", *MEASURES]
FILL_ORDER = ["record_ts", "station", "latitude", "longitude", "city", "state", "country"]

# State name in the readings -> name on the map; other names have no match.
STATE_NAMES = {
    "Odisha": "Odisha", "Bihar": "Bihar", "Maharashtra": "Maharashtra", "Chhattisgarh": "Chhattisgarh",
    "Chandigarh": "Chandigarh", "Delhi": "NCT of Delhi", "Rajasthan": "Rajasthan",
    "Uttar_Pradesh": "Uttar Pradesh", "Gujarat": "Gujarat", "Punjab": "Punjab", "Kerala": "Kerala",
    "TamilNadu": "Tamil Nadu", "Telangana": "Telangana", "Himachal Pradesh": "Himachal Pradesh",
    "Karnataka": "Karnataka", "Jammu_and_Kashmir": "Jammu & Kashmir", "Puducherry": "Puducherry",
    "Madhya Pradesh": "Madhya Pradesh", "Nagaland": "Nagaland", "Andhra_Pradesh": "Andhra Pradesh",
    "Jharkhand": "Jharkhand", "Assam": "Assam", "Tripura": "Tripura", "Manipur": "Manipur",
    "West_Bengal": "West Bengal", "Uttarakhand": "Uttarakhand", "Sikkim": "Sikkim", "Haryana": "Haryana",
    "Mizoram": "Mizoram", "Meghalaya": "Meghalaya", "Arunachal_Pradesh": "Arunachal Pradesh",
}


def flatten_documents(docs: DataFrame, file_ts: bool = False) -> DataFrame:
    """One row per record of each document, with file provenance carried along.

    Each record keeps its own timestamp; ``file_ts`` gives the whole file the
    timestamp of its first record instead.
    """
    provenance = [c for c in docs.columns if c.startswith("_")]
    rows = docs.select(*provenance, F.element_at("records", 1).alias("first_record"), F.explode("records").alias("r"))
    ts = parse_timestamp("first_record.last_update" if file_ts else "r.last_update")
    flat = rows.select(
        F.col("r.country").alias("country"), F.col("r.state").alias("state"),
        F.col("r.city").alias("city"), F.col("r.station").alias("station"),
        F.col("r.latitude").try_cast("decimal(12,7)").alias("latitude"),
        F.col("r.longitude").try_cast("decimal(12,7)").alias("longitude"),
        F.col("r.pollutant_id").alias("pollutant_id"),
        F.col("r.max_value").alias("pollutant_max"), F.col("r.min_value").alias("pollutant_min"),
        F.col("r.avg_value").alias("pollutant_avg"),
        *provenance, ts.alias("record_ts"),
    )
    return flat.withColumn("record_id", record_id())


def record_id() -> Column:
    return hash_key("station", "pollutant_id", F.date_format("record_ts", "yyyy-MM-dd HH:mm:ss"))


def pivot_readings(readings: DataFrame, whole: bool = False) -> DataFrame:
    """One row per station and time, one column per kind.

    Values are parsed before the maximum is taken: as text, 'NA' would win over
    every number and '9' over '10'.
    """
    return agg.pivot_max(
        readings, ["record_ts", *STATION_KEYS], "pollutant_id", parse_number("pollutant_avg", whole), KIND_COLUMNS
    )


def clean_readings(readings: DataFrame, whole: bool = False, blocks: int | None = None) -> DataFrame:
    """Pivoted readings with gaps filled from the station, its city, its state, then anywhere."""
    return fill_gaps(pivot_readings(readings, whole).filter(F.col("record_ts").isNotNull()), blocks)


def fill_gaps(pivoted: DataFrame, blocks: int | None = None) -> DataFrame:
    filled = hierarchical_fill(pivoted, MEASURES, levels=FILL_LEVELS, order=FILL_ORDER, blocks=blocks)
    return filled.withColumn("record_pk", hash_key("record_ts", "latitude", "longitude"))


def index_inputs() -> dict[str, str]:
    return {INDEX_NAMES[m]: m for m in MEASURES}


def index_fact(clean: DataFrame, snap: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Measures with their index, leading pollutant and category, keyed to the dimensions.

    ``keep`` names further columns to carry along.
    """
    keyed = clean.select(
        "record_pk", hash_key("record_ts").alias("date_fk"),
        hash_key("latitude", "longitude").alias("location_fk"), *MEASURES, *keep)
    return air_index.with_index(keyed, index_inputs(), snap)


def location_dim(clean: DataFrame) -> DataFrame:
    """One row per coordinate pair, holding the attributes of its latest reading."""
    names = ["country", "state", "city", "station"]
    latest = F.max_by(F.struct(*names), F.struct("record_ts", *names))
    # a time is compared in a hash table, names only by sorting: so these wait until a station is one row
    stations = clean.groupBy("latitude", "longitude", *names).agg(F.max("record_ts").alias("record_ts"))
    return (
        stations.groupBy("latitude", "longitude").agg(latest.alias("a"))
        .select(hash_key("latitude", "longitude").alias("location_pk"), "a.*", "latitude", "longitude")
    )


def time_dim(clean: DataFrame) -> DataFrame:
    parts = calendar_parts("record_ts")
    return clean.select("record_ts").distinct().select(
        hash_key("record_ts").alias("date_pk"), "record_ts",
        *[parts[p].alias(n) for p, n in {
            "year": "aqi_year", "quarter": "aqi_quarter", "month": "aqi_month", "day": "aqi_day",
            "day_of_week": "day_of_week", "is_weekend": "is_weekend", "hour": "aqi_hour"}.items()],
    )


def fact_view(fact: DataFrame, times: DataFrame, locations: DataFrame) -> DataFrame:
    """Fact rows with the attributes of both dimensions; unmatched keys are kept."""
    return star(fact, (locations, "location_fk", "location_pk"), (times, "date_fk", "date_pk"), how="left")


def _mean(column: str) -> Column:
    # decimal sums do not depend on the order in which tasks deliver their parts
    return F.round(F.avg(F.col(column).cast("decimal(18,6)")), 0).cast("double").alias(column)


def _joined(fact: DataFrame, times: DataFrame, locations: DataFrame) -> DataFrame:
    return star(fact, (times, "date_fk", "date_pk"), (locations, "location_fk", "location_pk")).select(
        *MEASURES, "aqi", "prominent_pollutant", "aqi_category", "state", "city",
        F.col("aqi_year").alias("year"), F.col("aqi_month").alias("month"), F.col("aqi_day").alias("day"),
    )


def mart_sums(fact: DataFrame, times: DataFrame, locations: DataFrame, keys: list[str]) -> DataFrame:
    """Sums and counts per key and leading pollutant, exact in any order."""
    return _joined(fact, times, locations).groupBy(*keys, "prominent_pollutant").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(F.col(c).cast("decimal(18,6)")).alias(f"{c}_s") for c in _AVERAGED],
        *[F.count(c).alias(f"{c}_c") for c in _AVERAGED],
    )


def _of_sums(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Means and the most frequent pollutant from sums, of which a key may have several per pollutant."""
    sums = [F.sum(f"{c}_s").cast("decimal(38,6)").alias(f"{c}_s") for c in _AVERAGED]
    parts = parts.groupBy(*keys, "prominent_pollutant").agg(
        F.sum("_n").alias("_n"), *sums, *[F.sum(f"{c}_c").alias(f"{c}_c") for c in _AVERAGED])
    return _voted(parts, keys)


def _mart(fact: DataFrame, times: DataFrame, locations: DataFrame, keys: list[str], label_max: bool) -> DataFrame:
    if label_max:
        means = [_mean("aqi"), *[_mean(m) for m in MEASURES]]
        labels = [F.max("prominent_pollutant").alias("prominent_pollutant"), F.max("aqi_category").alias("aqi_category")]
        return _joined(fact, times, locations).groupBy(*keys).agg(*means, *labels)

    # Sums and counts per (key, pollutant) first: the most frequent pollutant then falls out of
    # the same shuffle as the means, and no group is held in one place.
    return _voted(mart_sums(fact, times, locations, keys), keys)


def _voted(parts: DataFrame, keys: list[str]) -> DataFrame:
    votes = F.when(F.col("prominent_pollutant").isNotNull(), F.struct(-F.col("_n"), F.col("prominent_pollutant")))
    mart = parts.groupBy(*keys).agg(
        *[F.round(F.try_divide(F.sum(f"{c}_s").cast("decimal(38,6)"), F.sum(f"{c}_c")), 0).cast("double").alias(c)
          for c in _AVERAGED],
        F.min_by("prominent_pollutant", votes).alias("prominent_pollutant"),
    )
    return mart.withColumn("aqi_category", air_index.index_category(F.col("aqi")))


def monthly_by_state(fact: DataFrame, times: DataFrame, locations: DataFrame, label_max: bool = False) -> DataFrame:
    """Monthly means per state, with the category of the mean and the most frequent pollutant.

    ``label_max`` takes the alphabetical maximum of both labels instead.
    """
    return _keyed(_mart(fact, times, locations, STATE_MONTH, label_max), STATE_MONTH)


def daily_by_city(fact: DataFrame, times: DataFrame, locations: DataFrame, label_max: bool = False) -> DataFrame:
    """Daily means per city; the key holds the state, so equal city names stay apart."""
    return _keyed(_mart(fact, times, locations, CITY_DAY, label_max), CITY_DAY)


def _keyed(mart: DataFrame, keys: list[str]) -> DataFrame:
    return mart.withColumn("record_pk", hash_key(*keys))


def monthly_of_sums(sums: DataFrame) -> DataFrame:
    """``monthly_by_state`` from the sums by city and day."""
    return _keyed(_of_sums(sums, STATE_MONTH), STATE_MONTH)


def daily_of_sums(sums: DataFrame) -> DataFrame:
    """``daily_by_city`` from the sums by city and day."""
    return _keyed(_voted(sums, CITY_DAY), CITY_DAY)


# ---------------------------------------------------------------- chart tables over the monthly mart

def in_period(mart: DataFrame, year: int, month: int | None = None) -> DataFrame:
    rows = mart.filter(F.col("year") == year)
    return rows if month is None else rows.filter(F.col("month") == month)


def with_map_names(mart: DataFrame) -> DataFrame:
    return mart.withColumn("state_for_map", lookup("state", STATE_NAMES))


def monthly_change(mart: DataFrame) -> DataFrame:
    return agg.change_from_previous(mart, "state", ["year", "month"], "aqi")


def winners_and_losers(mart: DataFrame, year: int, month: int, k: int = 5) -> DataFrame:
    return agg.ranked_extremes(in_period(monthly_change(mart), year, month), "aqi_pct_change", k, ["state"])


def category_distribution(mart: DataFrame) -> DataFrame:
    return agg.mode_distribution(mart, "state", "aqi_category")


def composition(mart: DataFrame) -> DataFrame:
    """Share of each pollutant in the total of its state."""
    long = agg.unpivot(mart, ["state"], MEASURES, "pollutant", "avg_value")
    sums = long.groupBy("state", "pollutant").agg(F.sum("avg_value").alias("avg_value"))
    return agg.share_of_stack(sums, ["state"], "avg_value")


def severity_board(mart: DataFrame) -> DataFrame:
    """Mean index and most frequent category per state, the label prefixed with its icon."""
    board = agg.leaderboard(mart, "state", "aqi", "aqi_category")
    icon = F.coalesce(lookup("aqi_category", air_index.CATEGORY_ICONS), F.lit(""))
    return board.withColumn("aqi_level", F.concat(icon, F.lit(" "), F.col("aqi_category")))


def national_means(mart: DataFrame) -> DataFrame:
    return agg.column_means(mart, MEASURES, strip="_AVG")


def particulate_vs_gaseous(mart: DataFrame) -> DataFrame:
    return agg.group_total_means(mart, {"Particulate Matter": PARTICULATE, "Gaseous Pollutants": GASEOUS})


def pollutant_frequency(mart: DataFrame) -> DataFrame:
    return agg.top_values(mart, "prominent_pollutant", len(KIND_COLUMNS))


def pollutant_trend(mart: DataFrame, yearly: bool = False) -> DataFrame:
    """Mean concentration per period, state and pollutant; years average their months."""
    time = period_start("year") if yearly else period_start("year", "month")
    long = agg.unpivot(mart.withColumn("time", time), ["time", "state"], MEASURES, "pollutant", "concentration")
    return long.groupBy("time", "state", "pollutant").agg(F.avg("concentration").alias("concentration"))


def group_trend(mart: DataFrame, yearly: bool = False) -> DataFrame:
    """Particulate and gaseous totals per period; a missing measure makes its total NULL."""
    time = period_start("year") if yearly else period_start("year", "month")
    totals = mart.select(
        time.alias("time"), "state",
        sum([F.col(c) for c in PARTICULATE[1:]], F.col(PARTICULATE[0])).alias("Particulate Matter"),
        sum([F.col(c) for c in GASEOUS[1:]], F.col(GASEOUS[0])).alias("Gaseous Pollutants"),
    )
    kinds = ["Particulate Matter", "Gaseous Pollutants"]
    long = agg.unpivot(totals, ["time", "state"], kinds, "pollutant_type", "concentration")
    sums = long.groupBy("time", "pollutant_type").agg(F.sum("concentration").alias("concentration"))
    return agg.share_of_stack(sums, ["time"], "concentration")


def heat_map(mart: DataFrame, measure: str, year: int) -> DataFrame:
    """One measure per state and month, months in calendar order."""
    rows = mart.filter((F.col("year") == year) & F.col("state").isNotNull())
    return rows.select(
        "state", "month", month_name(period_start("year", "month")).alias("month_name"), measure
    ).orderBy("state", "month")
