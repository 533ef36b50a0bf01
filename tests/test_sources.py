"""Generators and Kafka options."""

import pytest
from pyspark.sql import functions as F

from tidewater.sources import kafka
from tidewater.sources.generators import as_kafka_records, generate_complex_records, generate_test_records


def test_generate_complex_records_counts(spark):
    recs = generate_complex_records(spark)
    assert recs.count() == 110_003
    assert recs.select("key").distinct().count() == 100_002
    row = recs.where("copy = 0").orderBy(F.col("key").cast("string")).first()
    assert len(row.name) == 10 and 0 <= row.price < 100 and row.id == 0
    again = generate_complex_records(spark).where("key = cast('77' as binary)").collect()
    assert again == recs.where("key = cast('77' as binary)").collect()


def test_generate_test_records_rule(spark):
    recs = generate_test_records(spark, ["t1", "t2"], 3, 10)
    assert recs.count() == 60
    r = {x.offset: x for x in recs.where("topic = 't2' and partition = 1").collect()}
    assert r[3].key == b"key1-3" and r[3].name == "some_name3" and r[3].somethings == [3, 6, 9]
    assert r[7].somethings == [] and r[4].somethings == [4, 20] and r[5].isOn is False
    assert abs(r[4].price - 1.6) < 1e-12
    kafka_rows = as_kafka_records(recs)
    assert kafka_rows.columns == ["key", "value", "topic", "partition", "offset", "timestamp", "timestampType"]


def test_kafka_options():
    o = kafka.kafka_options("b:9092", ["a", "b"], consumer={"max.poll.records": "2000", "fetch.min.bytes": "8192"})
    assert o["subscribe"] == "a,b" and o["startingOffsets"] == "earliest"
    assert o["kafka.isolation.level"] == "read_committed"
    assert "maxOffsetsPerTrigger" not in o and o["kafka.max.poll.records"] == "2000" and o["kafka.fetch.min.bytes"] == "8192"
    assert kafka.kafka_options("b:9092", "a", max_offsets_per_trigger=5)["maxOffsetsPerTrigger"] == "5"
    with pytest.raises(ValueError):
        kafka.kafka_options("b:9092", "a", consumer={"enable.auto.commit": "false"})
    assert kafka.kafka_options("b:9092", "a", consumer={"group.id": "g"})["kafka.group.id"] == "g"
    t = kafka.kafka_options("b:9092", "a", starting_timestamp_ms=1704067200000)
    assert t["startingTimestamp"] == "1704067200000" and "startingOffsets" not in t
    s = kafka.kafka_sink_options("b:9092", "t")
    assert s["kafka.acks"] == "all"
