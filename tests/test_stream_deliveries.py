"""The deliveries of the registered streams: the source is read once, not once per delivery."""

from pyspark.sql import functions as F

from registry import streams


def test_source_is_read_once(spark, monkeypatch):
    read = spark.sparkContext.accumulator(0)

    def seen(value):
        read.add(1)
        return value

    counted = F.udf(seen, "int")
    rows = spark.createDataFrame([(i, i % 3) for i in range(30)] + [(None, None)], "id long, delivery int")
    monkeypatch.setattr(streams, "rows", lambda *_: rows.withColumn("delivery", counted("delivery")))
    stream, _ = streams.delivered(spark, "unused", "unused", 3)
    query = stream.writeStream.format("memory").queryName("dealt_once").trigger(availableNow=True).start()
    query.awaitTermination()
    assert read.value == 31
    found = spark.table("dealt_once").collect()
    assert sorted(r.id for r in found) == list(range(30))
    assert len(query.recentProgress) == 3  # one batch per delivery
