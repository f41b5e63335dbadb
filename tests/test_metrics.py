import pytest
from pyspark.sql import functions as F

from tideline.operators.metrics import (
    BATCH_DURATION_SECONDS,
    bucket_rows,
    count_by_label,
    delivery_stats,
    histogram,
    histogram_quantile,
    rate,
)


def test_bounds_are_inclusive(spark):
    df = spark.createDataFrame([("q", v) for v in (0.1, 0.11, 1.0, 70.0, None)], "query string, seconds double")
    hist = histogram(df, "seconds", BATCH_DURATION_SECONDS, ["query"])
    row = hist.first()
    assert row.buckets == [1, 2, 3, 3, 3, 3, 3, 3]
    assert row["count"] == 4 and row["sum"] == pytest.approx(71.21)
    listed = bucket_rows(hist, BATCH_DURATION_SECONDS, ["query"]).collect()
    assert len(listed) == 9 and listed[-1].le is None and listed[-1].cumulative_count == 4


def test_quantile(spark):
    bounds = (1.0, 2.0, 4.0)
    cases = [([0, 10, 10], 10, 1.5), ([10, 10, 10], 10, 0.5), ([0, 0, 0], 5, 4.0), ([0, 0, 0], 0, None), ([5, 5, 10], 10, 1.0)]
    df = spark.createDataFrame([(i, b, n) for i, (b, n, _) in enumerate(cases)], "id int, buckets array<long>, count long")
    got = df.select("id", histogram_quantile(0.5, bounds).alias("p")).orderBy("id").collect()
    assert [r.p for r in got] == [c[2] for c in cases]


def test_counters_and_rate(spark):
    df = spark.createDataFrame([("a", "success", 5), ("a", "error", 1), ("a", "success", 7)], "t string, status string, n long")
    assert {(r.status, r["count"], r.total) for r in count_by_label(df, ["t", "status"], "n").collect()} == {
        ("success", 2, 12),
        ("error", 1, 1),
    }
    stats = delivery_stats(df).first()
    assert (stats.sent, stats.errors, stats.retried) == (2, 1, 0)
    timed = df.withColumn("ts", F.lit("2024-01-01 00:00:30").cast("timestamp_ntz"))
    assert rate(timed, "ts", "1 minute", []).first().per_second == pytest.approx(3 / 60)
