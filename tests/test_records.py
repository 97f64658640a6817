import csv
import random
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tradewind.sources.files import csv_scan, source_catalog
from tradewind.sources.records import BAD, FILE, RECORD, csv_records, ends_inside

COLUMNS = ["key", "comment", "last"]


def plain_ends_inside(text):
    """Sign by sign: whether the last value of a text is open, for a text that begins outside."""
    state = "start"
    for c in text:
        if state == "start":
            state = "quoted" if c == '"' else "start" if c in ",\n" else "plain"
        elif state == "quoted":
            state = "quote" if c == '"' else "quoted"
        elif state == "quote":
            state = "quoted" if c == '"' else "start" if c in ",\n" else "plain"
        elif c in ",\n":
            state = "start"
    return state == "quoted"


@settings(max_examples=500)
@given(st.lists(st.text('a",', max_size=8), max_size=6))
def test_lines_one_after_another_are_the_whole_text(lines):
    inside = False
    for i, line in enumerate(lines):
        inside = ends_inside(line, inside)
        assert inside == plain_ends_inside("\n".join(lines[: i + 1]))


def written(folder, n, seed, ending="\n"):
    rng = random.Random(seed)
    words = ["plain", 'says ""hi""'.replace('""', '"'), "two\nlines", "a, b", "", "\n\nthree\n", '"', "x" * 300 + "\n" + "y" * 200, 'end"\n"', "5\" pipe"]
    rows = [[str(i), rng.choice(words) if rng.random() < 0.6 else "no break", rng.choice(words)] for i in range(n)]
    for f in range(3):
        with open(f"{folder}/{f}.csv", "w", newline="") as out:
            writer = csv.writer(out, lineterminator=ending)
            writer.writerow(COLUMNS)
            writer.writerows(rows[f::3])
    return [tuple(v or None for v in r) for r in rows]


@pytest.fixture
def split_size(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    old = {n: spark.conf.get(n, None) for n in names}

    def set_size(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], str(size))
        spark.conf.set(names[2], "1")

    yield set_size
    for n, v in old.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


@pytest.mark.parametrize("size", [97, 700, 5000, 1 << 20])
@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_every_split_size_gives_the_same_records(spark, split_size, tmp_path, size, ending):
    rows = written(tmp_path, 120, size, ending)
    split_size(size)
    got = csv_records(spark, str(tmp_path), COLUMNS)
    found = got.collect()
    assert sorted(tuple(r)[:3] for r in found) == sorted(rows, key=lambda r: r)
    assert all(r[BAD] is None for r in found)
    by_file = {}
    for r in found:
        by_file.setdefault(r[FILE].rsplit("/", 1)[1], []).append((r[RECORD], r["key"]))
    for name, records in by_file.items():
        f = int(name[0])
        assert sorted(records) == [(i + 1, rows[f::3][i][0]) for i in range(len(rows[f::3]))]
    if size < 1000:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() >= 20


def test_same_rows_as_one_task_per_file(spark, split_size, tmp_path):
    odd = ['5" pipe,"say ""hi""",z', '"q"x,y,z', ' "sp",y,z', "", '"",b,', "1,2", "1,2,3,4", 'x,"\n\n",y', "é,漢,", 'last,"never closed', "still, open"]
    (tmp_path / "a.csv").write_text("key,comment,last\n" + "\n".join(odd) + "\n", newline="")
    (tmp_path / "b.csv").write_text("key,comment,last")
    (tmp_path / "c.csv").write_text("")
    whole = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    # A value that is never closed ends with the file; there the reader keeps the last line feed.
    want = [tuple(v.rstrip("\n") if v and "never" in v else v for v in r) for r in whole.schema("key string, comment string, last string").csv(str(tmp_path)).collect()]
    for size in (40, 1 << 20):
        split_size(size)
        got = csv_records(spark, str(tmp_path), COLUMNS)
        assert sorted(map(repr, (tuple(r)[:3] for r in got.collect()))) == sorted(map(repr, want))
        bad = {r[RECORD]: r[BAD] for r in got.where(f"{BAD} is not null").collect()}
        assert set(bad.values()) == {"1,2", "1,2,3,4", 'last,"never closed\nstill, open'}


def test_header_and_empty_folder_of_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"first\nname",b\n1,2\n')
    assert csv_scan(spark, str(tmp_path / "a.csv")).collect()[0].asDict() == {"first\nname": "1", "b": "2"}
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.csv").write_text("a,b\n")
    assert csv_scan(spark, str(tmp_path / "d"), ["a", "b"]).collect() == []


def sources(folder, items, orders=None):
    header = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value"
    (folder / "order_items_dataset.csv").write_text("\n".join([header, *items]) + "\n")
    if orders is not None:
        (folder / "orders_dataset.csv").write_bytes(orders)


def test_rows_of_a_file_are_staged_or_rejected_with_their_place(spark, tmp_path):
    items = ["o1,1,p,s,2020-01-01 00:00:00,1.5,2", "o2,1,p,s", "o3,x,p,s,t,2.5,3", "o4,1,p,s,t,ten,twelve", "o5,1,p,s,,,", "o6,1,p,s,t,1,2,3", 'o7,1,"p\n,q",s,t,NaN,1']
    sources(tmp_path, items)
    name = {"stg_order_items": "order_items_dataset.csv"}
    rejected, failed = {}, {}
    loaded = dict(source_catalog(spark, str(tmp_path), files=name, rejected=rejected, failed=failed))
    staged = loaded["stg_order_items"].collect()
    assert sorted((r["order_id"], r["product_id"]) for r in staged) == [("o1", "p"), ("o5", "p"), ("o7", "p\n,q")]
    told = sorted((r["record_number"], r["problem"]) for r in rejected["stg_order_items"].collect())
    assert told == [(2, "ragged"), (3, "unreadable:order_item_id"), (4, "unreadable:price,unreadable:freight_value"), (6, "ragged")]
    assert {r["source_file"].rsplit("/", 1)[1] for r in rejected["stg_order_items"].collect()} == {"order_items_dataset.csv"}
    assert failed["stg_orders"] == "missing" and "stg_order_items" not in failed


def test_a_source_that_can_not_be_read_does_not_stop_the_others(spark, tmp_path):
    sources(tmp_path, ["o1,1,p,s,t,1,2"])
    (tmp_path / "orders.csv.gz").write_bytes(b"this is no gzip file")
    names = {"stg_order_items": "order_items_dataset.csv", "stg_orders": "orders.csv.gz"}
    failed = {}
    loaded = dict(source_catalog(spark, str(tmp_path), files=names, rejected={}, failed=failed))
    assert loaded["stg_orders"] is None and failed["stg_orders"] not in ("", "missing")
    assert loaded["stg_order_items"].count() == 1


def test_damaged_files_keep_their_header_when_read_in_splits(spark, tmp_path):
    from conformance import load_all
    from conformance.registry import QUERIES

    load_all()
    rows = [(i, 1 + i % 4, 7, 9, 10.5, 0.02, datetime(1996, 9, 13)) for i in range(2000)]
    lines = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_tax double, l_shipdate timestamp_ntz"
    spark.createDataFrame(rows, lines).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = {r["problem"]: r["n"] for r in QUERIES["rejected_records"](spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    ragged = sum(i % 7 == 3 for i in range(2000))
    unreadable = sum(i % 7 != 3 and i % 11 == 5 for i in range(2000))
    assert got == {"ragged": ragged, "unreadable:price": unreadable, "staged": 2000 - ragged - unreadable}
