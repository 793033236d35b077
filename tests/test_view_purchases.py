"""view_purchases publishes a view of the purchases in its own rows."""

from datetime import datetime

from registry.spark_queries import view_purchases


def test_view_purchases_on_own_rows(spark, tmp_path):
    rows = [
        (1, datetime(2024, 1, 1), 10, "purchase", 2.5, None),
        (2, datetime(2024, 1, 2), 11, "view", 1.0, None),
        (3, datetime(2024, 1, 3), None, "purchase", None, "{}"),
        (4, datetime(2024, 1, 4), 12, None, 3.0, None),
    ]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    got = view_purchases(spark, str(tmp_path))
    assert got.columns == ["event_id", "user_id", "ts", "value"]
    assert sorted(got.collect(), key=lambda r: r.event_id) == [
        (1, 10, datetime(2024, 1, 1), 2.5),
        (3, None, datetime(2024, 1, 3), None),
    ]
