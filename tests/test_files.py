"""Sources, sinks, the layered build and the landing stream on files written by the test."""

import datetime as dt
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from rillstone.plans import air_quality as aq
from rillstone.plans import listings, loads
from rillstone.sources import files, tables
from rillstone.streaming import landing


def reading(station, ts, kind, value, lat="10.5", city="C", state="Delhi"):
    return {"country": "India", "state": state, "city": city, "station": station, "last_update": ts, "latitude": lat,
            "longitude": "70.25", "pollutant_id": kind, "min_value": "1", "max_value": "9", "avg_value": value}


def write_document(path, records, zipped=True):
    text = json.dumps({"index_name": "i", "title": "t", "desc": "d", "org_type": "o", "org": "x", "records": records}, indent=2)
    if zipped:
        with gzip.open(f"{path}.json.gz", "wt", encoding="utf-8") as f:
            f.write(text)
    else:
        with open(f"{path}.json", "w", encoding="utf-8") as f:
            f.write(text)


FIRST = [reading("S1", "01-07-2025 10:00:00", "PM2.5", "35"), reading("S1", "01-07-2025 11:00:00", "PM2.5", "NA"),
         reading("S2", "01-07-2025 10:00:00", "PM10", "80", lat="11.5"), reading("S1", "bad time", "CO", "1")]


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    write_document(folder / "one", FIRST)
    return folder


def test_documents_with_provenance(spark, inbox):
    write_document(inbox / "plain copy", FIRST, zipped=False)
    docs = files.read_documents(spark, str(inbox))
    rows = aq.flatten_documents(docs)
    assert rows.count() == 8  # zipped and plain text differ in their bytes
    assert rows.select("_stg_file_name").distinct().count() == rows.select("_stg_file_md5").distinct().count() == 2
    row = rows.filter("station = 'S2' and _stg_file_name = 'one.json.gz'").first()
    assert len(row["_stg_file_md5"]) == 32 and row["_copy_data_ts"] is not None
    assert row["record_ts"] == dt.datetime(2025, 7, 1, 10) and str(row["latitude"]) == "11.5000000"


def test_equal_and_loaded_files_are_read_once(spark, inbox):
    import shutil

    shutil.copy(inbox / "one.json.gz", inbox / "again.json.gz")
    loaded = aq.flatten_documents(files.read_documents(spark, str(inbox)))
    assert loaded.count() == 4
    assert files.read_documents(spark, str(inbox), loaded) is None
    write_document(inbox / "two", [reading("S3", "01-07-2025 12:00:00", "SO2", "7")])
    assert files.read_documents(spark, str(inbox), loaded).count() == 1


def test_first_record_time_can_stand_for_the_file(spark, inbox):
    docs = files.read_documents(spark, str(inbox))
    assert {r["record_ts"] for r in aq.flatten_documents(docs, file_ts=True).collect()} == {dt.datetime(2025, 7, 1, 10)}


def test_layered_build_and_second_load(spark, inbox, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    out = loads.build(spark, str(inbox), warehouse)
    clean = {(r["station"], r["record_ts"].hour): r for r in out["clean_readings"].collect()}
    assert clean["S1", 11]["pm25_avg"] == 35.0      # own station, earlier hour
    assert clean["S2", 10]["pm25_avg"] == 35.0      # another station of the city
    assert clean["S1", 10]["pm10_avg"] == 80.0 and clean["S1", 10]["co_avg"] is None
    assert out["daily_by_city"].count() == 1 and out["dim_location"].count() == 2

    write_document(inbox / "late", [reading("S1", "01-07-2025 09:00:00", "PM10", "120"), FIRST[0]])
    again = loads.build(spark, str(inbox), warehouse)
    clean = {(r["station"], r["record_ts"].hour): r for r in again["clean_readings"].collect()}
    assert len(clean) == 4 and clean["S1", 10]["pm10_avg"] == 120.0
    assert spark.read.parquet(f"{warehouse}/raw_readings").count() == 5


def _layers(spark, warehouse):
    return {name: sorted(map(str, df.select(sorted(df.columns)).collect())) for name, df in loads.tables(spark, warehouse).items()}


def _files(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def _readings(spark, rows):
    """Rows (station, city, state, day, hour, kind, value); the place follows from the station's number."""
    made = spark.createDataFrame(
        [(f"S{s}" if s is not None else None, c, st, dt.datetime(2025, 6, 28) + dt.timedelta(days=d, hours=h), k, v, s or 0)
         for s, c, st, d, h, k, v in rows],
        "station string, city string, state string, record_ts timestamp_ntz, pollutant_id string, pollutant_avg string, n int")
    return made.select(
        "*", F.lit("India").alias("country"), F.col("n").cast("decimal(12,7)").alias("latitude"),
        F.lit(1).cast("decimal(12,7)").alias("longitude")).drop("n").withColumn("record_id", aq.record_id())


def _random_rows(seed, days):
    import random

    rng = random.Random(seed)
    kinds = list(aq.KIND_COLUMNS)
    # three stations per city, two cities per state; some measures are known at few stations, late, or nowhere
    return [(s, f"C{s // 3}", f"T{s // 6}", d, h, k, str(rng.randint(1, 90)) if rng.random() < 0.5 else "NA")
            for d in days for s in range(9) for h in (3, 15) for i, k in enumerate(kinds[:6])
            if rng.random() < 0.4 and (i < 3 or s % (i + 1) == 1 and d > i)]


@pytest.fixture(scope="module")
def loaded_once(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("once"))
    rows = _random_rows(7, range(6))
    loads.load(spark, _readings(spark, rows), folder)
    return rows, _layers(spark, folder)


def test_two_loads_equal_one(spark, loaded_once, tmp_path):
    rows, once = loaded_once
    # the newest day, and half the stations of the oldest and of a day between
    late = [r for r in rows if r[3] == 5 or r[3] in (0, 2) and r[0] % 2]
    early = [r for r in rows if r not in late]
    twice = str(tmp_path / "twice")
    loads.load(spark, _readings(spark, early), twice)
    loads.load(spark, _readings(spark, late), twice)
    assert _layers(spark, twice) == once
    loads.load(spark, _readings(spark, late), twice)  # as after a failure
    assert _layers(spark, twice) == once


def test_first_value_of_a_measure_reaches_back(spark, tmp_path):
    early = [(1, "C0", "T0", d, 3, "PM10", "40") for d in range(4)] + [(2, "C1", "T0", d, 3, "PM10", "50") for d in range(4)]
    late = [(1, "C0", "T0", 4, 3, "CO", "2"), (None, None, None, 4, 3, "PM10", "9")]
    twice = str(tmp_path / "twice")
    loads.load(spark, _readings(spark, early), twice)
    loads.load(spark, _readings(spark, late), twice)
    assert {r["co_avg"] for r in loads.tables(spark, twice)["clean_readings"].collect()} == {2.0}


def test_moved_place_moves_in_all_its_marts(spark, tmp_path):
    early = [(1, "C0", "T0", d, 3, "PM10", "40") for d in range(4)]
    twice = str(tmp_path / "twice")
    loads.load(spark, _readings(spark, early), twice)
    loads.load(spark, _readings(spark, [(1, "C9", "T0", 4, 3, "PM10", "60")]), twice)
    assert {r["city"] for r in loads.tables(spark, twice)["daily_by_city"].collect()} == {"C9"}


def test_untouched_days_keep_their_files(spark, tmp_path):
    folder = tmp_path / "warehouse"
    steady = [(s, "C0", "T0", d, 3, k, "40") for d in range(6) for s in (1, 2) for k in aq.KIND_COLUMNS]
    loads.load(spark, _readings(spark, [r for r in steady if r[3] < 5]), str(folder))
    before = _files(folder)
    loads.load(spark, _readings(spark, [r for r in steady if r[3] == 5] + [(1, "C0", "T0", 4, 9, "CO", "3")]), str(folder))
    after = _files(folder)
    gone = {p for p in before if after.get(p) != before[p]}
    # day 4 is July 2nd; the mart of July is made anew, that of June is not
    assert gone and all("=2025-07-02" in p or "mart_month=2025-07-01" in p for p in gone)


def test_loads_without_a_time_or_rows(spark, tmp_path):
    folder = str(tmp_path / "warehouse")
    loads.load(spark, _readings(spark, [(1, "C0", "T0", 0, 3, "CO", "3")]), folder)
    before = _layers(spark, folder)
    loads.load(spark, _readings(spark, []), folder)
    loads.load(spark, _readings(spark, [(2, "C0", "T0", 0, 3, "CO", "3")]).withColumn("record_ts", F.lit(None).cast("timestamp_ntz")), folder)
    assert _layers(spark, folder) == before
    assert spark.read.parquet(f"{folder}/raw_readings").count() == 2


def test_loaded_files_are_not_opened_again(spark, inbox, tmp_path):
    import shutil

    first = files.new_files(spark, str(inbox))
    assert first.count() == 1 and files.new_files(spark, str(inbox), first) is None
    shutil.copy(inbox / "one.json.gz", inbox / "again.json.gz")
    second = files.new_files(spark, str(inbox), first)
    assert second.count() == 1 and files.documents_of(spark, second, first) is None
    text = files.new_files(spark, str(inbox), first)._jdf.queryExecution().toString()
    assert "content" not in text  # what is handed on is a stored table, not a scan of the files


def test_only_new_files_are_opened(spark, inbox, monkeypatch):
    known = files.new_files(spark, str(inbox))
    write_document(inbox / "back-dated", [reading("S9", "01-07-2020 12:00:00", "SO2", "7")])
    os.utime(inbox / "back-dated.json.gz", (10**9, 10**9))  # older than all that is known
    before = os.stat(inbox / "one.json.gz")
    with open(inbox / "one.json.gz", "wb") as f:  # a known file that nobody can read any more
        f.write(b"?" * before.st_size)
    os.utime(inbox / "one.json.gz", ns=(before.st_atime_ns, before.st_mtime_ns))
    opened = []
    original = files.literal_path
    monkeypatch.setattr(files, "literal_path", lambda uri: opened.append(uri.rsplit("/", 1)[1]) or original(uri))
    fresh = files.new_files(spark, str(inbox), known)
    rows = aq.flatten_documents(files.documents_of(spark, fresh, known))
    assert [r["station"] for r in rows.collect()] == ["S9"]
    assert opened == ["back-dated.json.gz"] * 2  # once for its contents, once to be parsed


def test_file_names_are_taken_as_they_are(spark, tmp_path):
    for k, name in enumerate(["a b", "c*d", "e[f]g", "h{i,j}k", "100% l", "m?n", "é"]):
        write_document(tmp_path / name, [reading(f"S{k}", "01-07-2025 12:00:00", "SO2", "7")], zipped=False)
    rows = aq.flatten_documents(files.read_documents(spark, str(tmp_path)))
    assert sorted(r["station"] for r in rows.collect()) == [f"S{k}" for k in range(7)]


def test_many_files_are_read_in_lots(spark, tmp_path):
    for k in range(7):
        write_document(tmp_path / f"f{k}", [reading(f"S{k}", "01-07-2025 12:00:00", "SO2", "7")], zipped=False)
    uris, lots = files._binary(spark, str(tmp_path)).select("_uri"), []
    got = files.read_named(uris, lambda paths: lots.append(len(paths)) or spark.read.format("binaryFile").load(paths).select("length"), each=3)
    assert got.count() == 7 and lots == [3, 3, 1]
    assert files.read_named(uris.limit(0), None) is None


def test_chart_tables(spark):
    mart = spark.createDataFrame(
        [("Delhi", 2024, 1, 100.0, 10.0, None, "Satisfactory"), ("Delhi", 2024, 2, 150.0, 30.0, 5.0, "Moderate"),
         ("Atlantis", 2024, 2, 90.0, 20.0, 5.0, "Satisfactory"), ("Atlantis", 2024, 1, 0.0, 20.0, 5.0, "Good")],
        "state string, year int, month int, aqi double, pm10_avg double, pm25_avg double, aqi_category string").withColumns(
        {m: F.lit(1.0) for m in aq.GASEOUS})
    assert {r["state"]: r["state_for_map"] for r in aq.with_map_names(mart).collect()} == {"Delhi": "NCT of Delhi", "Atlantis": None}
    sides = [(r["state"], r["side"]) for r in aq.winners_and_losers(mart, 2024, 2, 1).collect()]
    assert sides == [("Delhi", "largest"), ("Delhi", "smallest")]  # a zero base has no percentage
    trend = {(r["time"].month, r["pollutant_type"]): r["concentration"] for r in aq.group_trend(mart).collect()}
    assert trend[1, "Particulate Matter"] == 25.0  # the row without a value drops out
    shares = aq.composition(mart).filter("state = 'Delhi'").agg(F.sum("share")).first()[0]
    assert shares == pytest.approx(1.0)
    assert {r["state"]: r["aqi_level"] for r in aq.severity_board(mart).collect()}["Delhi"].endswith("Moderate")
    assert [r["month_name"] for r in aq.heat_map(mart, "pm10_avg", 2024).collect()] == ["Jan", "Feb"] * 2


# ---------------------------------------------------------------- delimited text

def test_listings_csv(spark, tmp_path):
    path = tmp_path / "listings.csv"
    path.write_text('id,listing_url,name,room_type,minimum_nights,host_id,price,created_at,updated_at\n'
                    '1,http://x,"Nice, quiet",Private room,0,7,$90.00,2024-01-01 10:00:00,2024-01-02 00:00:00\n'
                    '2,http://y,,Shared room,3,8,"$1,250.00",2024-01-01 10:00:00,2024-01-02 00:00:00\n')
    rows = listings.clean_listings(files.read_csv(spark, str(path), files.LISTINGS_SCHEMA)).orderBy("listing_id").collect()
    assert [(r["listing_name"], r["minimum_nights"], float(r["price"])) for r in rows] == [("Nice, quiet", 1, 90.0), (None, 3, 1250.0)]


def test_dialect_and_strict_mode(spark, tmp_path):
    path = tmp_path / "d.txt"
    path.write_text("a|1;b|\\N;'c|c'|3;")
    got = files.read_csv(spark, str(path), "x string, n int", header=False, sep="|", line_sep=";", quote="'", null="\\N", strict=True)
    assert sorted(map(tuple, got.collect()), key=str) == [("a", 1), ("b", None), ("c|c", 3)]
    bad = tmp_path / "bad.csv"
    bad.write_text("x,n\na,1,extra\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(bad), "x string, n int", strict=True).collect()


def test_inferred_and_named(spark, tmp_path):
    (tmp_path / "i.csv").write_text("a,b\n1,x\n2,y\n")
    assert files.read_csv_inferred(spark, str(tmp_path / "i.csv")).dtypes == [("a", "int"), ("b", "string")]
    (tmp_path / "m.tsv").write_text('ham\tsay "hi\nspam\twin\n')
    rows = files.read_named_tsv(spark, str(tmp_path / "m.tsv"), ["label", "message"]).collect()
    assert [tuple(r) for r in rows] == [("ham", 'say "hi'), ("spam", "win")]


def test_wide_statistical_table(spark, tmp_path):
    path = tmp_path / "p.tsv"
    path.write_text("indic_de,geo\\time\t2008 \t2009 \nPC_Y0,AD\t: \t14.6 b\nPC_Y0,AL\t22.3 \t21.2 ep\n")
    rows = {(r["geo"], r["year"]): (r["value"], r["flag"]) for r in files.read_wide_tsv(spark, str(path)).collect()}
    assert rows == {("AD", 2008): (None, None), ("AD", 2009): (14.6, "b"), ("AL", 2008): (22.3, None), ("AL", 2009): (21.2, "ep")}


def test_peek_numbers_the_lines(spark, tmp_path):
    path = tmp_path / "peek.csv"
    path.write_text("".join(f"{i},x{i}\n" for i in range(50)))
    rows = files.peek(spark, str(path), 2).collect()
    assert sorted((r["file_row_number"], r["c1"]) for r in rows)[:2] == [(1, "0"), (2, "1")] and len(rows) == 50


# ---------------------------------------------------------------- sinks

def day_rows(spark, *specs):
    return spark.createDataFrame([(k, dt.datetime(2024, 1, d, h)) for k, d, h in specs], "k int, ts timestamp_ntz")


def test_append_refuses_another_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.createDataFrame([(1,)], "x int"), path)
    tables.write_table(spark.createDataFrame([(2,)], "x int"), path, "append")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        tables.write_table(spark.createDataFrame([("2",)], "x string"), path, "append")


def test_window_is_replaced_not_repeated(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = day_rows(spark, (1, 1, 0), (2, 2, 5), (3, 2, 6), (4, 3, 0))
    window = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 4)
    for _ in range(2):
        tables.replace_window(rows, path, "ts", *window)
    assert spark.read.parquet(path).count() == 4
    tables.replace_window(rows.filter("k <> 1 and k <> 4"), path, "ts", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3))
    assert {r["k"] for r in spark.read.parquet(path).collect()} == {2, 3, 4}
    with pytest.raises(ValueError):
        tables.replace_window(rows, path, "ts", dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 3))


def test_clustered_files_are_sorted(spark, tmp_path):
    path = str(tmp_path / "clustered")
    rows = spark.createDataFrame([(f"s{i % 5}", dt.datetime(2024, 1, 1 + i % 2, i % 24)) for i in range(100)], "station string, ts timestamp_ntz")
    tables.write_clustered(rows, path, "ts", "station")
    one = [r["station"] for r in spark.read.parquet(path).filter("day = date '2024-01-01'").coalesce(1).collect()]
    assert len(one) == 50 and sum(a > b for a, b in zip(one, one[1:])) <= 8  # sorted within each file


def test_table_is_replaced_by_a_query_that_reads_it(spark, tmp_path):
    table = tables.VersionedTable(spark, str(tmp_path / "v"))
    assert not table.exists()
    table.replace(spark.range(5).toDF("x"))
    table.replace(table.read().filter("x > 1"))
    assert sorted(r["x"] for r in table.read().collect()) == [2, 3, 4]


def test_review_window_and_watermark(spark):
    raw = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, d), f"r{d}", None if d == 4 else "text", "positive") for d in range(1, 7)],
        files.REVIEWS_SCHEMA)
    loaded = listings.review_fact(raw).filter(F.col("review_date") <= F.lit("2024-01-03").cast("timestamp_ntz"))
    assert listings.review_fact(raw).count() == 5
    assert listings.review_fact(raw, loaded).count() == 2
    assert listings.review_fact(raw, start=dt.datetime(2024, 1, 2), end=dt.datetime(2024, 1, 4)).count() == 2


# ---------------------------------------------------------------- streaming

def test_landing_stream_reads_each_reading_once(spark, inbox, tmp_path):
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")

    def run():
        landing.ingest(spark, str(inbox), table, checkpoint).awaitTermination(120)
        return spark.read.parquet(table)

    assert run().count() == 3                         # the reading without a time is left out
    assert run().count() == 3                         # nothing new
    late = [reading("S1", "28-06-2025 10:00:00", "PM2.5", "12"), FIRST[0]]
    write_document(inbox / "late", late)
    rows = run()
    assert rows.count() == 4                          # the late one is stored, the repeated one is not
    assert rows.filter("day = date '2025-06-28'").count() == 1


def test_repeats_within_the_delay_are_dropped(spark, inbox, tmp_path):
    write_document(inbox / "repeat", FIRST)
    stream = landing.distinct_readings(landing.document_stream(spark, str(inbox)).filter("record_ts is not null"))
    query = stream.writeStream.format("memory").queryName("distinct_readings").option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert spark.table("distinct_readings").count() == 3
