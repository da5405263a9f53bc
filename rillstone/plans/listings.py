"""Listings build: staging names -> cleansing views -> host join, review fact -> calendar mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.functions.columns import greatest_strict, parse_price, surrogate_key
from rillstone.operators.aggregates import frequency
from rillstone.operators.incremental import above_watermark, in_window
from rillstone.operators.joins import flag_day_after
from rillstone.operators.select import rename


def stage_listings(raw: DataFrame) -> DataFrame:
    return rename(raw, {
        "id": "listing_id", "name": "listing_name", "listing_url": "listing_url", "room_type": "room_type",
        "minimum_nights": "minimum_nights", "host_id": "host_id", "price": "price_text",
        "created_at": "created_at", "updated_at": "updated_at"})


def stage_hosts(raw: DataFrame) -> DataFrame:
    return rename(raw, {"id": "host_id", "name": "host_name", "is_superhost": "is_superhost",
                        "created_at": "created_at", "updated_at": "updated_at"})


def stage_reviews(raw: DataFrame) -> DataFrame:
    return rename(raw, {"listing_id": "listing_id", "date": "review_date", "reviewer_name": "reviewer_name",
                        "comments": "review_text", "sentiment": "review_sentiment"})


def clean_listings(raw: DataFrame) -> DataFrame:
    """Listings with at least one night and the price as a number."""
    nights = F.col("minimum_nights")
    return stage_listings(raw).select(
        "listing_id", "listing_name", "room_type", F.when(nights == 0, 1).otherwise(nights).alias("minimum_nights"),
        "host_id", parse_price("price_text").alias("price"), "created_at", "updated_at")


def clean_hosts(raw: DataFrame) -> DataFrame:
    return stage_hosts(raw).withColumn("host_name", F.coalesce("host_name", F.lit("Anonymous")))


def listings_with_hosts(listings: DataFrame, hosts: DataFrame) -> DataFrame:
    """Cleansed listings with their host; the later of both updates, NULL if one is unknown."""
    joined = listings.alias("l").join(hosts.alias("h"), F.col("l.host_id") == F.col("h.host_id"))
    return joined.select(
        "l.listing_id", "l.listing_name", "l.room_type", "l.minimum_nights", "l.price", "l.host_id", "h.host_name",
        F.col("h.is_superhost").alias("host_is_superhost"), "l.created_at",
        greatest_strict("l.updated_at", "h.updated_at").alias("updated_at"))


def review_fact(
    raw: DataFrame, loaded: DataFrame | None = None,
    start: dt.datetime | None = None, end: dt.datetime | None = None,
) -> DataFrame:
    """Reviews with text and a surrogate key.

    With a window only that window is built, with ``loaded`` only what is newer
    than it, otherwise everything.
    """
    reviews = stage_reviews(raw).filter(F.col("review_text").isNotNull())
    if start is not None and end is not None:
        reviews = in_window(reviews, "review_date", start, end)
    elif loaded is not None:
        reviews = above_watermark(reviews, loaded, "review_date")
    key = surrogate_key("listing_id", "review_date", "reviewer_name", "review_text")
    return reviews.select(key.alias("review_id"), *reviews.columns)


def full_moon_reviews(reviews: DataFrame, moons: DataFrame) -> DataFrame:
    """Reviews marked when written on the day after a full moon."""
    return flag_day_after(
        reviews, "review_date", moons, "full_moon_date", "full moon", "not full moon", "is_full_moon")


def full_moon_sentiment(marked: DataFrame) -> DataFrame:
    counts = frequency(marked, "is_full_moon", "review_sentiment", name="reviews")
    return counts.orderBy("is_full_moon", "review_sentiment")
