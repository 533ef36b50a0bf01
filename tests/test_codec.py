"""Decode, malformed rows, proto3 defaults, annotation and filters."""

import pandas as pd
import pyarrow as pa
from google.protobuf import descriptor_pb2
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidewater.functions import proto
from tidewater.operators import codec
from tidewater.schema import KAFKA_META, output_schema
from tidewater.sources.logs import events_log


def test_roundtrip_events(spark):
    log = codec.encode_events(events_log(spark, SF_SMALL, payload=True))
    dec = codec.decode_proto(log)
    assert dec.where("_corrupt").count() == 0
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    got = dec.select("offset", "id", "name", "price", "isOn", F.col("header.uuid").alias("uuid")).join(
        ev.select(F.col("event_id").alias("offset"), "event_type", "value"), "offset"
    )
    assert got.where("id <> offset or name <> event_type or price <> value or uuid <> cast(offset as string)").count() == 0
    assert got.where("isOn <> (offset % 5 <> 0)").count() == 0


def test_malformed_dropped_and_reported(spark):
    log = codec.encode_events(events_log(spark, SF_SMALL, payload=True), corrupt_every=50)
    dec = codec.decode_proto(log)
    bad = codec.malformed_report(dec).toPandas()
    assert sorted(bad.offset) == list(range(0, 1000, 50))
    assert codec.drop_malformed(dec).count() == 1000 - 20
    counts = codec.malformed_counts(dec).toPandas()
    assert counts.malformed.sum() == 20


def test_empty_null_and_garbage_values(spark):
    df = spark.createDataFrame(
        [(b"", 0), (None, 1), (b"\xff\xff\xff", 2), (codec.CORRUPT_BYTES, 3)], "value binary, offset long"
    )
    rows = {r.offset: r for r in codec.decode_proto(df).collect()}
    assert rows[0]._corrupt is False and rows[0].id == 0 and rows[0].name == "" and rows[0].header is None
    assert rows[0].somethings == []
    assert all(rows[i]._corrupt for i in (1, 2, 3))


def test_unknown_fields_ignored_and_custom_descriptor(spark):
    cls = proto.message_class("messages.Header")
    raw = cls(uuid="u", creation_time=7).SerializeToString() + b"\x48\x01"  # unknown field 9
    df = spark.createDataFrame([(raw, 0)], "value binary, offset long")
    row = codec.decode_proto(df, "messages.Header").collect()[0]
    assert (row.uuid, row.creation_time, row._corrupt) == ("u", 7, False)


def test_annotate_puts_kafka_last_and_filter(spark):
    log = codec.encode_events(events_log(spark, SF_SMALL, payload=True)).withColumn("watermark", F.unix_millis("timestamp"))
    dec = codec.drop_malformed(codec.decode_proto(log))
    ann = codec.annotate_kafka(dec)
    assert ann.columns[-1] == "_kafka" and ann.schema["_kafka"].dataType.fieldNames() == KAFKA_META.fieldNames()
    assert [f.name for f in output_schema().fields] == ann.columns
    kept = codec.filter_records(ann, F.col("price") > 50).count()
    py = codec.filter_records(ann, python_predicate=lambda f: f["price"] > 50).count()
    assert kept == py == ann.where("price > 50").count()


def test_engine_choice(spark):
    # the spark-protobuf package is not in this image: auto falls back to the Arrow path
    assert codec.jvm_protobuf_available(spark) is False
    df = spark.createDataFrame([(b"", 0)], "value binary, offset long")
    plan = codec.decode_proto(df)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan or "PythonMapInArrow" in plan


def test_decode_on_a_stream(spark, scratch):
    log = codec.encode_events(events_log(spark, SF_SMALL, payload=True), corrupt_every=50)
    log.select("key", "value", "topic", "partition", "offset", "timestamp", "timestampType").write.parquet(f"{scratch}/t")
    from tidewater.sources.logs import read_stream_log

    dec = codec.decode_proto(read_stream_log(spark, f"{scratch}/t", streaming=True))
    q = dec.writeStream.format("memory").queryName("dec_stream").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.sql("select count(*) n, sum(cast(_corrupt as int)) bad from dec_stream").first()
    assert (got.n, got.bad) == (1000, 20)


def test_required_kafka_group_is_checked(spark):
    log = codec.encode_events(events_log(spark, SF_SMALL, payload=True)).withColumn("watermark", F.unix_millis("timestamp"))
    ann = codec.annotate_kafka(codec.drop_malformed(codec.decode_proto(log)))
    assert codec.required_violations(ann).count() == 0
    broken = ann.withColumn("_kafka", F.col("_kafka").withField("watermark", F.lit(None).cast("long")))
    assert codec.required_violations(broken).count() == 1000


def test_columns_of_messages_are_those_of_single_messages():
    cls = proto.message_class()
    desc = cls.DESCRIPTOR
    schema = proto.spark_schema(desc)
    none = dict.fromkeys(f.name for f in schema)
    rows = [
        {"header": {"uuid": "a", "original_producer": "é\x00", "recent_producer": None, "creation_time": -(2**63)}, "id": 2**62 + 1, "name": "", "price": float("inf"), "isOn": False, "somethings": [0, -1, 2**31 - 1]},
        None,
        none,
        {**none, "header": dict.fromkeys(["uuid", "original_producer", "recent_producer", "creation_time"])},  # given, though empty
        {**none, "id": 7, "somethings": []},
        {**none, "name": "x", "somethings": [5]},
    ]
    whole = pa.array(rows, type=proto.arrow_type(schema))
    for part in (whole, whole.slice(2, 3), whole.slice(0, 1), whole.slice(0, 0)):
        single = [None if v is None else proto.from_python(cls, v, desc).SerializeToString() for v in part.to_pylist()]
        assert [None if m is None else m.SerializeToString() for m in proto.write_messages(cls, part)] == single
        messages = [None if v is None else cls.FromString(v) for v in single]
        read = proto.compile_reader(desc)
        for at, (f, column) in enumerate(zip(schema, proto.read_columns(desc, messages), strict=True)):
            want = [None if m is None else read(m)[at] for m in messages]
            assert column.type == proto.arrow_type(f.dataType) and column.to_pylist() == want
    # fields that the struct does not have stay unset, others of it are not written
    few = pa.array([{"id": 3, "other": "y"}, {"id": None, "other": None}])
    assert [m.SerializeToString() for m in proto.write_messages(cls, few)] == [cls(id=3).SerializeToString(), b""]


def test_repeated_messages_in_columns():
    fds = descriptor_pb2.FileDescriptorSet.FromString(proto.builtin_descriptor_set())
    many = fds.file[1].message_type.add(name="Many")
    for name, number, repeated in (("all", 1, True), ("one", 2, False)):
        f = many.field.add(name=name, number=number, type=11, type_name=".messages.ComplexType")
        f.label = 3 if repeated else 1
    cls = proto.message_class("messages.Many", fds.SerializeToString())
    desc = cls.DESCRIPTOR
    schema = proto.spark_schema(desc)
    rows = [{"all": [{"id": 1, "header": {"uuid": "u"}, "somethings": [1]}, {}], "one": {"somethings": []}}, {"all": [], "one": None}, {"all": None, "one": {"header": {}}}]
    column = pa.array(rows, type=proto.arrow_type(schema))
    single = [proto.from_python(cls, v, desc).SerializeToString() for v in column.to_pylist()]
    assert [m.SerializeToString() for m in proto.write_messages(cls, column)] == single
    read = proto.compile_reader(desc)
    columns = proto.read_columns(desc, [cls.FromString(v) for v in single])
    assert [list(x) for x in zip(*(c.to_pylist() for c in columns))] == [
        list(read(cls.FromString(v))) for v in single
    ]
