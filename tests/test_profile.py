"""Table profile against counts by column, and its plan."""

from datetime import datetime

from patronage.sources.files import profile

SCHEMA = "id long, part long, x double, t string, w timestamp_ntz, a array<int>, b binary, `odd name` string"


def frame(spark):
    long = "y" * 500
    rows = [(1, 1, 0.0, "a", datetime(2020, 1, 1), [1], b"\x00", None), (1, 1, -0.0, "A", datetime(2020, 1, 1), [1], b"\x00", "z"),
            (1, None, float("nan"), long, None, [1, None], b"\x01", "z"), (2, None, float("nan"), long + "z", None, [], None, ""),
            (2, None, None, None, datetime(2020, 1, 1, 0, 0, 0, 1), None, b"", None), (None, 1, 1e-300, long, None, [1], b"", None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_profile_counts_every_column(spark):
    got = {r["column_name"]: r for r in profile({"k": frame(spark)}, {"k": ("id", "part")}).collect()}
    assert list(got) == ["id", "part", "x", "t", "w", "a", "b", "odd name"]
    assert {c: (r["n_null"], r["n_distinct"]) for c, r in got.items()} == {
        "id": (1, 2), "part": (3, 1), "x": (1, 3), "t": (1, 4), "w": (3, 2), "a": (1, 3), "b": (1, 3), "odd name": (3, 2)}
    assert {r["n_rows"] for r in got.values()} == {6} and got["id"]["null_pct"] == 100.0 / 6
    assert {r["pk_duplicates"] for r in got.values()} == {2}      # (1, 1) and (2, null) twice each
    assert got["a"]["dtype"] == "array<int>"


def test_empty_table_keeps_its_columns(spark):
    rows = profile({"k": frame(spark).limit(0)}, {"k": ("id",)}).collect()
    assert len(rows) == 8
    assert all((r["n_rows"], r["n_null"], r["n_distinct"], r["pk_duplicates"], r["null_pct"]) == (0, 0, 0, 0, None) for r in rows)


def test_profile_has_no_expand(spark):
    plan = profile({"k": frame(spark)}, {"k": ("id",)})._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
