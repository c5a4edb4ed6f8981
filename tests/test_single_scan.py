"""Cleaning reads each source once; ledger and report come from what was written."""

import itertools
import re

import pytest
from pyspark.sql import functions as F

from patronage.config import TESTDATA_PARAMS
from patronage.context import Context
from patronage.operators import clean as CL
from patronage.operators import marts as MT
from patronage.operators import quality as QA
from patronage.operators.clean import Ledger, clean_customers
from patronage.plans import joins as JN
from patronage.registry import csv_root
from patronage.sources.files import load_table
from patronage.sources.specs import TABLES
from patronage.sources.testdata import canonical_tables

SF = "/root/testdata/sf0.001"


def test_each_source_row_is_read_once(spark):
    raw = canonical_tables(spark, SF)
    seen = {name: spark.sparkContext.accumulator(0) for name in raw}

    def counted(name, df):
        def run(batches, total=seen[name]):
            for b in batches:
                total.add(b.num_rows)
                yield b
        return df.mapInArrow(run, df.schema)
    rows = {name: df.count() for name, df in raw.items()}
    ctx = Context(spark, SF, TESTDATA_PARAMS)
    ctx._memo["raw"] = {name: counted(name, df) for name, df in raw.items()}
    ledger = ctx.ledger.frame().collect()
    report = QA.run_all(ctx.clean, ctx.transactions, ctx.orders, ctx.ledger.nulls).collect()
    assert len(ledger) > 20 and len(report) == 31
    for name in raw:
        if name not in ("geolocation", "category_translation"):  # not cleaned; read beside products too
            assert seen[name].value == rows[name], name
    assert {r["table_name"]: r["rows_before"] for r in ledger if r["step_id"] % 100 == 0 and r["step_id"] < 800} == {
        n: rows[n] for n in ("customers", "orders", "order_items", "order_payments", "order_reviews", "products", "sellers")}


def test_observed_nulls_are_those_of_the_written_table(spark):
    ctx = Context(spark, SF, TESTDATA_PARAMS)
    a = [r.asDict() for r in QA.run_all(ctx.clean, ctx.transactions, ctx.orders, ctx.ledger.nulls).collect()]
    b = [r.asDict() for r in QA.run_all(ctx.clean, ctx.transactions, ctx.orders).collect()]
    assert a == b


def test_ledger_of_duplicates_and_nulls(spark):
    rows = [(1, 10, "a"), (1, 10, "a"), (1, 10, "b"), (2, None, "c"), (None, 5, "d"), (3, 30, None), (3, 30, None)]
    df = spark.createDataFrame(rows, "customer_id long, customer_unique_id long, customer_city string")
    led = Ledger()
    assert sorted(clean_customers(df, led).collect(), key=str) == sorted([(1, 10, "a"), (1, 10, "b"), (3, 30, None)], key=str)
    assert [tuple(r)[3:6] for r in led.frame().collect()] == [(7, 5, 2), (5, 3, 2)]
    assert led.nulls["customers"] == {"customer_id": 0, "customer_unique_id": 0}
    led = Ledger()
    assert clean_customers(df.limit(0), led).count() == 0
    assert [tuple(r)[3:] for r in led.frame().collect()] == [(0, 0, 0, 0.0), (0, 0, 0, 0.0)]


def test_raw_tables_are_written_compressed_and_come_back(spark):
    ctx = Context(spark, "made-up", TESTDATA_PARAMS)
    n = {s.name: 40 * (i + 1) for i, s in enumerate(TABLES)}
    ctx._memo["raw"] = {s.name: spark.createDataFrame([(None,) * len(s.schema.fields)] * n[s.name], s.schema) for s in TABLES}
    root = csv_root(ctx)
    for s in TABLES:
        files = [f for f in spark.read.format("binaryFile").load(f"{root}/{s.filename}").select("path").toPandas()["path"]]
        assert files and all(f.endswith(".csv.gz") for f in files), s.name
        assert load_table(spark, s, root, "csv").count() == n[s.name]


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    return [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]


def key_rows():
    """Each line twice, a third row of every fifth line, one key and the null key very often."""
    rows = [(i, 1, x) for i in range(300) for x in (1.0, 1.0, *([0.5] if i % 5 == 0 else []))]
    return rows + [(7, 1, float(i % 9)) for i in range(900)] + [(None, None, float(i % 4)) for i in range(500)] + [(None, 1, None)]


@pytest.mark.parametrize("few", [1, 1 << 14])
def test_duplicates_are_moved_once_by_key_and_frequent_keys_apart(spark, monkeypatch, few):
    monkeypatch.setattr(CL, "FEW", few)
    monkeypatch.setattr(JN, "PART_ROWS", 100)
    df = spark.createDataFrame(key_rows(), "k long, line short, x double")
    got = CL._collapsed(df, ["k", "line"], ["x"])
    assert len(exchanges(got)) == (1 if few > 1 else 3)
    want = {}
    for k, line, x in key_rows():
        want.setdefault((k, line), []).append(x)
    assert {(r["k"], r["line"]): (r["x"], r["__n"], r["__d"]) for r in got.collect()} == {
        key: (min(v, key=lambda x: (x is not None, x)), len(v), len(set(v))) for key, v in want.items()}
    assert got.count() == len(want)
    assert CL._collapsed(df.limit(0), ["k", "line"], ["x"]).count() == 0


def test_parts_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(JN, "PART_ROWS", 100)
    assert JN.parts_of(spark.range(1001)) == 11
    assert JN.parts_of(spark.range(5)) == 4


def test_lines_are_moved_once_to_orders(spark):
    ctx = Context(spark, SF, TESTDATA_PARAMS)
    assert len(exchanges(MT.build_orders(ctx.transactions))) == 1


def test_duplicates_are_counted_in_one_sort(spark, monkeypatch):
    monkeypatch.setattr(JN, "PART_ROWS", 100)
    rows = [(1, 0.0, "b"), (1, -0.0, "b"), (1, None, "z"), (1, 0.0, None), (2, float("nan"), "a"), (2, float("nan"), "a"),
            (2, 9.0, "c"), (None, 3.0, "d"), (None, 3.0, "d"), (3, -0.0, "e")]
    df = spark.createDataFrame(rows, "k long, x double, s string")
    got = CL._collapsed(df, ["k"], ["x"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and "Aggregate" not in plan
    assert {r["k"]: tuple(r)[1:] for r in got.collect()} == {
        1: (None, "z", 4, 3), 2: (9.0, "c", 3, 2), None: (3.0, "d", 2, 1), 3: (0.0, "e", 1, 1)}
    assert sorted(map(str, got.collect())) == sorted(map(str, CL._added_up(df, ["k"], ["x"]).collect()))


def test_lines_are_not_moved_by_customer_nor_dropped_payments_added_up(spark):
    ctx = Context(spark, SF, TESTDATA_PARAMS)
    clean = ctx.clean
    two = clean["customers"].limit(1).withColumn("customer_unique_id", F.lit(-1).cast("long"))   # an order of two customers
    clean = {**clean, "customers": clean["customers"].where(F.col("customer_id") % 3 != 0).unionByName(two)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = MT.build_transactions(clean)
        lines = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].splitlines()
        depth = [re.search(r"[A-Za-z]", x).start() if re.search(r"[A-Za-z]", x) else 0 for x in lines]
        at = next(i for i, x in enumerate(lines) if "SortMergeJoin [customer_id" in x)
        below = list(itertools.takewhile(lambda i: depth[i] > depth[at], range(at + 1, len(lines))))
        assert below and not any("price" in lines[i] for i in below)
        assert any("LeftSemi" in x for x in lines)
        got = made.select("order_id", "order_item_id", "customer_unique_id", "payment_total").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    pays, people = {}, {}
    for r in clean["order_payments"].collect():
        pays[r["order_id"]] = pays.get(r["order_id"], 0.0) + r["payment_value"]
    for r in clean["customers"].collect():
        people.setdefault(r["customer_id"], []).append(r["customer_unique_id"])
    orders = {r["order_id"]: r["customer_id"] for r in clean["orders"].collect()}
    want = [(r["order_id"], r["order_item_id"], c, round(pays[r["order_id"]], 4)) for r in clean["order_items"].collect()
            if r["order_id"] in orders for c in people.get(orders[r["order_id"]], [])]
    assert want and sorted((a, b, c, round(d, 4)) for a, b, c, d in got) == sorted(want)
