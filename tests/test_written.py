"""What writers count and add to the files they write."""

from pyspark.sql import functions as F

from basketry.operators import clean, keyed
from basketry.sources import files
from tests.build import dicts, sessions, transactions, txn


def scanned_rows(df) -> int:
    """Rows that the one file scan of a plan handed on, after row groups were left out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.executedPlan().collectLeaves() if "AdaptiveSparkPlan" in plan.toString()[:20] else plan.collectLeaves()
    return leaves.head().metrics().apply("numOutputRows").value()


def test_quality_is_counted_by_the_job_that_writes(spark, tmp_path):
    rows = [txn(i, session_id=None if i % 3 else f"s{i}", total=-5.0 if i % 7 == 0 else 5.0) for i in range(50)]
    cleaned = transactions(spark, *rows).repartition(5)
    found = files.to_parquet(cleaned, str(tmp_path / "t"), counts=clean.quality_counts())
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert found["rows"] == found["total_transactions"] == stored.count() == 50
    counted = {k: v for k, v in found.items() if k != "rows"}
    told = clean.with_percent(spark.createDataFrame([counted]))
    assert dicts(told.select("total_transactions", "standalone", "suspicious", "standalone_pct")) == dicts(
        clean.transaction_quality_profile(stored)
    )


def test_keyed_rows_are_counted_once(spark, tmp_path):
    """Range partitioning samples its input first; the sample is not counted."""
    visits = [dict(user_id=f"u{i % 7}", start_time=f"2024-03-01T10:{i:02d}:00") for i in range(60)]
    rows = keyed.user_session_rows(sessions(spark, *visits)).repartition(6)
    found = files.to_keyed_parquet(rows, str(tmp_path / "k"))
    assert found == {"rows": 60}
    told = keyed.counted_rows(spark, {"user_sessions": found["rows"]})
    assert dicts(told) == dicts(keyed.row_counts({"user_sessions": spark.read.parquet(str(tmp_path / "k"))}))
    assert files.to_parquet(rows.limit(0), str(tmp_path / "none")) == {"rows": 0}


def test_bloom_filters_leave_row_groups_out(spark, tmp_path):
    """Each of 40 files has values from all over the range, so their bounds say nothing."""
    rows = spark.range(40_000).select(
        F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("row_key"),
        F.struct(F.concat(F.lit("v"), F.xxhash64("id").cast("string")).alias("value")).alias("ev"),
    )
    wanted = rows.filter("row_key = 'k012345'").first()["ev"]["value"]
    many = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in many}
    for key, value in many.items():
        spark.conf.set(key, value)
    read = {}
    for name, bloom in (("plain", ()), ("bloom", ("ev.value",))):
        path = str(tmp_path / name)
        files.to_keyed_parquet(rows.repartition(8), path, bloom=bloom)
        stored = spark.read.parquet(path)
        found = keyed.filter_by_value_limit(stored, "ev.value", wanted)
        assert [r["row_key"] for r in found.collect()] == ["k012345"]
        read[name] = scanned_rows(stored.filter(F.col("ev.value") == wanted))
    for key, value in before.items():
        spark.conf.set(key, value)
    assert read["plain"] == 40_000 and read["bloom"] <= 4_000
