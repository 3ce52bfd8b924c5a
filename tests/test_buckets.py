"""Joins of tables stored by key move neither side."""

import uuid
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from snapledger.operators.history import empty_history, history_step
from snapledger.operators.scd2 import join_valid_version
from snapledger.storage import buckets
from tests.helpers import bag, physical_plan, rows


def at(day):
    return F.lit(f"2026-01-{day} 00:00:00").cast("timestamp")


@contextmanager
def settings(spark, **values):
    """Large tables: no side is small enough to be broadcast."""
    values = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"} | {
        k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.fixture
def store(spark):
    made = []

    def stored(df, keys, n=4, **options):
        made.append(f"t_{uuid.uuid4().hex[:10]}")
        return buckets.store_bucketed(df, made[-1], keys, n, **options)

    yield stored
    for name in made:
        buckets.drop_bucketed(spark, name)


def _exchanges(df):
    return physical_plan(df).count("Exchange")


def _versions(spark):
    return spark.range(60).select(
        F.col("id").cast("string").alias("code"), F.to_date(F.lit("2020-01-01")).alias("valid_from"),
        F.to_date(F.lit("9999-12-31")).alias("valid_to"), (F.col("id") * 7).alias("sk"))


def test_as_of_join_moves_neither_side(spark, store):
    facts = spark.range(300).select(
        (F.col("id") % 70).cast("string").alias("code"), F.col("id").alias("n"),
        F.to_date(F.lit("2021-04-01")).alias("day"))
    versions = _versions(spark)
    plain = join_valid_version(facts, versions, ["code"], F.col("day"))
    expected = bag(plain)
    with settings(spark):
        assert _exchanges(plain) == 2
        joined = join_valid_version(
            store(facts, ["code"]), store(versions, ["code"]), ["code"], F.col("day"))
        assert _exchanges(joined) == 0
        assert bag(joined) == expected


def _snapshot(spark, change):
    return spark.range(80).select(
        F.when(F.col("id") % 2 == 0, "2020-21").otherwise("2021-22").alias("year"),
        F.col("id").cast("string").alias("code"),
        F.when(F.col("id") < 5, F.lit(change)).otherwise("same").alias("name"))


@pytest.mark.parametrize("stored_by", [["year", "code"], ["code"]])
def test_history_step_moves_neither_side(spark, store, stored_by):
    keys = ["year", "code"]
    first = _snapshot(spark, "old")
    history = history_step(
        empty_history(first, keys), first, keys, at("01"), checked=True)
    second = _snapshot(spark, "new").filter("code <> '79'")
    expected = bag(history_step(history, second, keys, at("02"), checked=True))
    with settings(spark, **buckets.SUBSET_JOINS):
        step = history_step(store(history, stored_by), store(second, stored_by), keys, at("02"), checked=True)
        assert _exchanges(step) == 0
        assert bag(step) == expected
        assert step.filter("is_current = 0").count() == 6


def test_sizes_are_those_that_are_written(spark, store):
    df = spark.range(500).select((F.col("id") % 37).alias("k"), F.col("id").alias("k_2"))
    assert rows(buckets.stored_sizes(store(df, ["k"], 8))) == rows(buckets.bucket_sizes(df, ["k"], 8))


def test_a_heavy_key_is_refused_and_nothing_stays(spark):
    df = spark.range(900).select(F.when(F.col("id") < 600, 1).otherwise(F.col("id")).alias("k"))
    name = f"t_{uuid.uuid4().hex[:10]}"
    with pytest.raises(buckets.BucketsSkewed, match="of 900 rows"):
        buckets.store_bucketed(df, name, ["k"], 16, least_rows=100)
    assert not spark.catalog.tableExists(name)


def test_empty_null_and_unknown_keys(spark, store):
    empty = store(spark.createDataFrame([], "k int, v int"), ["k"])
    assert empty.count() == 0
    nulls = store(spark.createDataFrame([(None, 1), (None, 2), (3, 3)], "k int, v int"), ["k"])
    assert rows(nulls, "k", "v") == [(None, 1), (None, 2), (3, 3)]
    with pytest.raises(ValueError, match="absent"):
        store(spark.createDataFrame([(1,)], "k int"), ["absent"])
