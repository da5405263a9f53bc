"""Readers for documents and delimited text, with file provenance and skipping of loaded files."""

from __future__ import annotations

import re
import urllib.parse
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.operators.numbering import number_scan
from rillstone.session import stage

_RECORD = ["country", "state", "city", "station", "last_update", "latitude", "longitude",
           "pollutant_id", "min_value", "max_value", "avg_value"]
# one object per file, readings as text with 'NA' for a missing one
DOCUMENT_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("index_name", "title", "desc", "org_type", "org")]
    + [T.StructField("records", T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in _RECORD])))])

LISTINGS_SCHEMA = (
    "id int, listing_url string, name string, room_type string, minimum_nights int, host_id int, "
    "price string, created_at timestamp_ntz, updated_at timestamp_ntz")
REVIEWS_SCHEMA = (
    "listing_id int, date timestamp_ntz, reviewer_name string, comments string, sentiment string")
HOSTS_SCHEMA = (
    "id int, name string, is_superhost string, created_at timestamp_ntz, updated_at timestamp_ntz")


# ---------------------------------------------------------------- documents

def _binary(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.withColumn("_uri", F.col("_metadata.file_path"))


def literal_path(uri: str) -> str:
    """A file's URI as a path that readers take as it is, whatever signs its name holds."""
    path = urllib.parse.unquote(uri)
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_named(uris: DataFrame, read: Callable[[list[str]], DataFrame], each: int = 5000) -> DataFrame | None:
    """What ``read`` makes of the files that ``_uri`` names, and of no others; None without any.

    The names reach the driver ``each`` at a time, and each lot's result is stored
    before the next one is read.
    """
    parts, lot = [], []
    for row in uris.select("_uri").toLocalIterator():
        lot.append(literal_path(row["_uri"]))
        if len(lot) == each:
            parts.append(stage(read(lot)))
            lot = []
    if lot:
        parts.append(stage(read(lot)))
    return reduce(DataFrame.unionByName, parts) if parts else None


def new_files(spark: SparkSession, path: str, manifest: DataFrame | None = None) -> DataFrame | None:
    """Files the manifest does not hold in their present state, with content MD5; None when there are none.

    A file is known by its place, time and size. Listing opens no file, and only new
    ones are opened for their contents, however old they are. The result has the
    columns of a manifest and is appended to it after the load.
    """
    state = ["_uri", "modificationTime", "length"]
    listed = _binary(spark, path).select(*state)
    if manifest is not None:
        listed = listed.join(manifest.select(*state), state, "left_anti")
    return read_named(stage(listed), lambda paths: spark.read.format("binaryFile").load(paths).select(
        F.col("_metadata.file_path").alias("_uri"), "modificationTime", "length", F.md5("content").alias("_stg_file_md5")))


def documents_of(spark: SparkSession, fresh: DataFrame, loaded: DataFrame | None = None) -> DataFrame | None:
    """Documents of new files with their provenance; None when all contents were loaded before.

    Of equal files only the first path is read; no other file is opened.
    """
    unseen = fresh
    if loaded is not None:
        unseen = unseen.join(loaded.select("_stg_file_md5").distinct(), "_stg_file_md5", "left_anti")
    unseen = stage(unseen.groupBy("_stg_file_md5").agg(F.min("_uri").alias("_uri")))
    docs = read_named(unseen, lambda paths: spark.read.schema(DOCUMENT_SCHEMA).options(multiLine=True).json(paths).select(
        "records", F.col("_metadata.file_path").alias("_uri"), F.col("_metadata.file_name").alias("_stg_file_name"),
        F.col("_metadata.file_modification_time").alias("_stg_file_load_ts")))
    return None if docs is None else docs.join(unseen, "_uri").drop("_uri").withColumn("_copy_data_ts", F.current_timestamp())


def read_documents(spark: SparkSession, path: str, loaded: DataFrame | None = None) -> DataFrame | None:
    """Documents whose content is not among the ``_stg_file_md5`` of ``loaded``; None when there are none."""
    fresh = new_files(spark, path)
    return None if fresh is None else documents_of(spark, fresh, loaded)


# ---------------------------------------------------------------- delimited text

def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, *, header: bool = True, sep: str = ",",
    line_sep: str | None = None, quote: str = '"', escape: str = '"', null: str = "", strict: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """Typed scan. ``strict`` fails on a wrong column count or value; otherwise the cell becomes NULL."""
    reader = spark.read.schema(schema).options(
        header=header, sep=sep, quote=quote, escape=escape, nullValue=null, multiLine=multiline,
        mode="FAILFAST" if strict else "PERMISSIVE", enforceSchema=not (strict and header))
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    return reader.csv(path)


def read_csv_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Scan with a header and guessed types, for exploration: it reads the file twice."""
    return spark.read.options(header=True, inferSchema=True, sep=sep, quote='"', escape='"').csv(path)


def read_named_tsv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Tab-separated text without a header; quotes are ordinary characters."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).options(sep="\t", quote="", header=False).csv(path)


def read_wide_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Statistical table with keys packed into the first column and a column per year, in long form.

    A cell holds a number, ``:`` for none, and letters flagging the number.
    """
    wide = spark.read.options(sep="\t", header=True, quote="").csv(path)
    packed, *years = wide.columns
    names = packed.split("\\")[0].split(",")
    clean = wide.toDF("_packed", *[y.strip() for y in years])
    long = clean.unpivot(["_packed"], clean.columns[1:], "period", "cell")
    parts = F.split(F.trim("_packed"), ",")
    return long.select(
        *[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)],
        F.col("period").cast("int").alias("year"),
        F.regexp_extract("cell", r"-?[0-9]+(?:\.[0-9]+)?", 0).try_cast("double").alias("value"),
        F.nullif(F.regexp_extract("cell", r"([a-z]+)\s*$", 1), F.lit("")).alias("flag"))


def peek(spark: SparkSession, path: str, columns: int, sep: str = ",") -> DataFrame:
    """Raw cells of one file by position, with the row number in the file."""
    names = [f"c{i + 1}" for i in range(columns)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.schema(schema).options(sep=sep, header=False, quote='"', escape='"').csv(path)
    return number_scan(raw, "file_row_number").select("file_row_number", *names)
