import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from basketry.operators import customers, keyed, ledger
from basketry.sources import merge
from basketry.sources.merge import KeyedTable, key_borders, key_range
from basketry.sources.shared import shared_folder
from tests.build import transactions, txn

CELLS = "row_key string, a int, b string, written int"


def files_of(path) -> dict[str, set[str]]:
    """Names of the data files in each folder."""
    return {f.name: {p.name for p in f.glob("*.parquet")} for f in Path(path).iterdir() if "=" in f.name}


def rows_of(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=str)


def test_borders_put_a_key_where_sorting_would(spark):
    keys = [f"u{random.Random(i).randrange(10**6):07d}" for i in range(500)]
    df = spark.createDataFrame([(k,) for k in [*keys, None]], "row_key string")
    borders = key_borders(df, "row_key", 7)
    assert borders == sorted(borders) and len(borders) == 6
    placed = df.withColumn("r", key_range("row_key", borders)).collect()
    for row in placed:
        assert row["r"] == (0 if row["row_key"] is None else sum(b <= row["row_key"] for b in borders))
    assert key_borders(df.limit(0), "row_key", 7) == []


def test_a_batch_rewrites_the_ranges_it_touches_and_no_others(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [(f"k{i:04d}", i, f"b{i}", 0) for i in range(400)]
    table = KeyedTable(spark, path)
    table.create(spark.createDataFrame(rows, CELLS), ranges=8)
    before = files_of(path)
    assert len(before) == 8
    # One cell of a stored key, a later null that changes nothing, and a new key in the same range.
    batch = [("k0003", None, "new", 1), ("k0004", None, None, 1), ("k0003x", 7, None, 1)]
    written = table.merge(spark.createDataFrame(batch, CELLS))
    after = files_of(path)
    assert written == [(0,)]
    assert {f for f in before if before[f] != after[f]} == {"key_range=0"}
    assert not before["key_range=0"] & after["key_range=0"]
    whole = keyed.upsert_latest(spark.createDataFrame(rows + batch, CELLS), "row_key", "written")
    assert rows_of(table.read().select(whole.columns)) == rows_of(whole)
    table.merge(spark.createDataFrame(batch, CELLS))  # again, as after a job that was cut off
    assert rows_of(table.read().select(whole.columns)) == rows_of(whole)
    assert table.merge(spark.createDataFrame([], CELLS)) == []


def test_batches_equal_a_full_rebuild(spark, tmp_path):
    pick = random.Random(3)
    some = lambda: pick.choice([None, pick.randrange(9)])
    writes = [(f"k{pick.randrange(60):03d}", some(), pick.choice([None, "x", "y"]), n) for n in range(600)]
    parts = [[w for w in writes if w[3] // 100 == part] for part in range(6)]
    first = keyed.upsert_latest(spark.createDataFrame(parts[0], CELLS), "row_key", "written")
    table = KeyedTable(spark, str(tmp_path / "table"))
    table.create(first, ranges=5)
    for part in parts[1:]:
        table.merge(spark.createDataFrame(part, CELLS))
    whole = keyed.upsert_latest(spark.createDataFrame(writes, CELLS), "row_key", "written")
    assert rows_of(table.read().select(whole.columns)) == rows_of(whole)


def test_a_key_filter_still_reaches_the_reader(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "table"))
    table.create(spark.createDataFrame([(f"k{i}", i, "", 0) for i in range(50)], CELLS), ranges=4)
    plan = keyed.point_lookup(table.read(), "k7")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(row_key,k7)" in plan


def test_too_many_folders_are_refused(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "table"))
    rows = spark.createDataFrame([(f"k{i:03d}", i, "", 0) for i in range(50)], CELLS)
    table.create(rows, ranges=5)
    monkeypatch.setattr(merge, "NAMED_FOLDERS", 3)
    with pytest.raises(ValueError, match="rebuild"):
        table.merge(rows)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"
        getConf = staticmethod(dict)

    class Session:
        sparkContext = Context

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session)


STATUSES = ["completed", "shipped", "cancelled", None]


def order(pick, number, day=None):
    day = pick.randrange(1, 29) if day is None else day
    return txn(
        number,
        user_id=pick.choice(["u1", "u2", "u3", "u4", None]),
        timestamp=f"2024-{pick.choice(['02', '03'])}-{day:02d}T{pick.randrange(24):02d}:00:00",
        total=pick.choice([None, 0.1, 19.99, 1234.5, 2500.004]),
        discount=pick.choice([0.0, 0.05, 3.5]),
        status=pick.choice(STATUSES),
    )


def same(kept, orders):
    pairs = (
        (ledger.user_monthly_spend(kept), customers.user_monthly_spend(orders)),
        (ledger.ltv_segments(kept, 50.0, 2000.0), customers.ltv_segments(orders, 50.0, 2000.0)),
        (ledger.clv_features(kept), customers.clv_features(orders)),
    )
    for ours, theirs in pairs:
        assert ours.columns == theirs.columns
        assert rows_of(ours) == rows_of(theirs)


def test_thirty_daily_updates_equal_one_full_computation(spark, tmp_path):
    pick = random.Random(9)
    now = {n: order(pick, n) for n in range(120)}
    kept = ledger.Ledger(spark, str(tmp_path / "ledger"))
    kept.create(transactions(spark, *now.values()))
    for day in range(1, 31):
        before, after = [], []
        for n in pick.sample(sorted(now), 4):  # orders that change status or amount, or are taken back
            before.append(now[n])
            now[n] = now[n] | {"status": pick.choice(STATUSES), "total": pick.choice([5.0, 7.25, None])}
            after.append(now[n])
        for n in range(1000 + 10 * day, 1003 + 10 * day):
            now[n] = order(pick, n)
            after.append(now[n])
        kept.apply(transactions(spark, *before), transactions(spark, *after), day)
    same(kept.rows(), transactions(spark, *now.values()))


def test_a_batch_counts_once_and_leaves_other_months_alone(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = [txn(i, timestamp=f"2024-0{1 + i % 4}-05T10:00:00", total=10.0 + i) for i in range(12)]
    kept = ledger.Ledger(spark, path)
    kept.create(transactions(spark, *rows))
    before = files_of(path)
    changed = rows[2] | {"status": "cancelled"}
    batch = (transactions(spark, rows[2]), transactions(spark, changed))
    assert kept.apply(*batch, 1) == [("2024-03",)]
    after = files_of(path)
    assert {f for f in before if before[f] != after[f]} == {"year_month=2024-03"}
    kept.apply(*batch, 1)
    same(kept.rows(), transactions(spark, *rows[:2], changed, *rows[3:]))


def test_all_orders_of_a_month_taken_back(spark, tmp_path):
    rows = [txn(1, timestamp="2024-01-05T10:00:00"), txn(2, timestamp="2024-02-05T10:00:00", user_id=None),
            txn(3, timestamp=None)]
    kept = ledger.Ledger(spark, str(tmp_path / "ledger"))
    kept.create(transactions(spark, *rows))
    same(kept.rows(), transactions(spark, *rows))
    none = transactions(spark, rows[0]).limit(0)
    kept.apply(transactions(spark, rows[0], rows[2]), none, 1)
    same(kept.rows(), transactions(spark, rows[1]))
