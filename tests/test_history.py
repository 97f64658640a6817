"""Dimensions in buckets: results of merges, what they write, and what failures leave behind."""

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tradewind.operators import versions
from tradewind.session import shared_folder
from tradewind.sources.history import History, Merged
from tradewind.sources.publication import restore, retire

SCHEMA = "k string, v int, record_hash string, effective_start_date timestamp_ntz, effective_end_date timestamp_ntz, is_current boolean"
START, END = datetime(2020, 1, 1), datetime(2999, 12, 31)


def _time(year):
    return F.lit(datetime(year, 1, 1)).cast("timestamp_ntz")


def _folder(spark):
    return f"{shared_folder(spark)}/history-{uuid.uuid4().hex}"


def _first(spark, n=400):
    return spark.createDataFrame([(f"k{i}", i, f"h{i}", START, END, True) for i in range(n)], SCHEMA)


def _delivery(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, record_hash string")


def _set(df):
    return sorted(map(tuple, df.collect()))


def test_merges_equal_the_full_join(spark):
    path = _folder(spark)
    stored, plain = History.create(_first(spark), path, "k", buckets=16), _first(spark)
    deliveries = [
        [("k1", -1, "x"), ("k2", 2, "h2"), ("new", 5, "n")],
        [("k1", -2, "y"), ("new", 6, None), ("k399", 0, "z")],
        [("new", 7, None), ("k3", 3, "h3")],
    ]
    for year, rows in zip((2021, 2022, 2023), deliveries):
        plain = versions.scd2_apply(plain, _delivery(spark, rows), "k", _time(year))
        stored.append(_delivery(spark, rows), _time(year))
    again = History.open(spark, path)
    assert _set(again.read()) == _set(plain)
    assert _set(again.current()) == _set(plain.where("is_current"))
    assert {r["v"] for r in again.at(F.lit(datetime(2021, 6, 1)).cast("timestamp_ntz")).where("k = 'k1'").collect()} == {-1}


def test_only_changed_buckets_are_written(spark):
    stored = History.create(_first(spark), _folder(spark), "k", buckets=16)
    before = {v.table: v.path for v in stored._entry().versions if v.layer == "current"}
    whole = [(f"k{i}", i, f"h{i}") for i in range(400)]
    assert stored.append(_delivery(spark, whole), _time(2021)) == Merged(0, 0, 0, None)
    whole[7] = ("k7", 70, "changed")
    done = stored.append(_delivery(spark, whole), _time(2021))
    after = {v.table: v.path for v in stored._entry().versions if v.layer == "current"}
    assert (done.keys, done.buckets) == (1, 1) and done.rows < 400 / 4
    assert sum(before[b] != after[b] for b in before) == 1
    closed = [v for v in stored._entry().versions if v.layer == "closed"]
    assert [v.rows for v in closed] == [1]
    # Closed versions stay where they are while their key changes again.
    stored.append(_delivery(spark, [("k7", 71, "again")]), _time(2022))
    assert closed[0] in stored._entry().versions


def test_type_one_keeps_created_dates(spark):
    rows = spark.createDataFrame([("a", 1, "x", START), ("b", 2, "y", START)], "k string, v int, record_hash string, created_date timestamp_ntz")
    stored = History.create(rows, _folder(spark), "k", buckets=4)
    later = datetime(2024, 5, 5)
    incoming = spark.createDataFrame([("a", 9, "z", later), ("c", 3, "w", later)], rows.schema)
    assert stored.overwrite(incoming).keys == 2
    assert _set(stored.read()) == _set(versions.scd1_apply(rows, incoming, "k")) == [("a", 9, "z", START), ("b", 2, "y", START), ("c", 3, "w", later)]
    with pytest.raises(ValueError):
        stored.append(incoming, _time(2024))


def test_empty_history_extra_columns_and_empty_delivery(spark):
    stored = History.create(_first(spark, 0), _folder(spark), "k", buckets=4)
    assert stored.read().count() == 0
    assert stored.append(_delivery(spark, []), _time(2021)).entry is None
    extra = _delivery(spark, [("a", 1, "x")]).withColumns({"_bucket": F.lit(9), "_state": F.lit("s"), "count": F.lit(1)})
    stored.append(extra, _time(2021))
    assert [r["k"] for r in stored.current().collect()] == ["a"]


@pytest.mark.parametrize("rows", [[("a", 1, "x"), ("a", 1, "x")], [(None, 1, "x")]])
def test_repeated_or_missing_keys_change_nothing(spark, rows):
    stored = History.create(_first(spark, 5), _folder(spark), "k", buckets=4)
    with pytest.raises(ValueError):
        stored.append(_delivery(spark, rows), _time(2021))
    assert stored.read().count() == 5 and stored._entry().number == 1


def test_failed_and_overtaken_merges_leave_the_stored_rows(spark):
    path = _folder(spark)
    stored = History.create(_first(spark, 20), path, "k", buckets=4)
    with pytest.raises(Exception, match="lost"):
        stored.append(_delivery(spark, [("k1", 0, "x")]), F.raise_error(F.lit("lost")).cast("timestamp_ntz"))
    assert _set(History.open(spark, path).read()) == _set(_first(spark, 20))
    overtaken = stored._entry()
    stored.append(_delivery(spark, [("k1", 0, "x")]), _time(2021))
    stored._entry = lambda: overtaken
    with pytest.raises(RuntimeError):
        stored.append(_delivery(spark, [("k2", 0, "x")]), _time(2022))
    del stored._entry
    assert {r["v"] for r in stored.current().where("k IN ('k1', 'k2')").collect()} == {0, 2}
    children = stored.journal.files.listStatus(stored.journal.path.getParent())
    assert sorted(c.getPath().getName()[:12] for c in children if c.getPath().getName()[0] == "0") == ["000000000001", "000000000002"]


def test_earlier_states_come_back_until_they_are_retired(spark):
    path = _folder(spark)
    stored = History.create(_first(spark, 20), path, "k", buckets=4)
    for year in (2021, 2022, 2023):
        stored.append(_delivery(spark, [("k1", year, str(year))]), _time(year))
    before = _set(stored.read())
    assert stored.compact() == 3 and _set(stored.read()) == before
    restore(spark, path, 1)
    assert _set(stored.read()) == _set(_first(spark, 20))
    restore(spark, path, 5)
    assert retire(spark, path, keep=1) > 0
    assert _set(History.open(spark, path).read()) == before
