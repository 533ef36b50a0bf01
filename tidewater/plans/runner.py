"""Command-line loader: one batch load, or a streaming load until stopped.

    spark-submit scripts/tidewater_load.py --source parquet --path s3://.../topic \\
        --base s3://.../lake --loader deduplicated --batch-id 7
    ... --source kafka --bootstrap b:9092 --topics a,b --stream --trigger "5 minutes"

One load per call: batch (``--batch-id``) or a stream until stopped (or
``--available-now``).  Settings not given keep the loader's defaults.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ..session import apply_required_conf, ship_package
from ..sources.kafka import read_kafka
from ..sources.logs import read_stream_log
from .loads import LOADERS, LoadSpec, load
from .sink import ParquetOptions

DEDUP_OF = {"plain": None, "deduplicated": "recent", "by_topic_partition": "recent"}


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tidewater-load")
    p.add_argument("--source", choices=["parquet", "kafka"], required=True)
    p.add_argument("--path", help="Kafka-schema Parquet directory (source parquet)")
    p.add_argument("--bootstrap", help="Kafka bootstrap servers (source kafka)")
    p.add_argument("--topics", help="comma-separated topics (source kafka)")
    p.add_argument("--base", required=True, help="lake base directory")
    p.add_argument("--loader", choices=sorted(LOADERS), default="deduplicated")
    p.add_argument("--batch-id", type=int, default=0)
    p.add_argument("--stream", action="store_true")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--trigger", default=None, help="processing-time trigger, e.g. '5 minutes'")
    p.add_argument("--checkpoint", default=None)
    p.add_argument("--key-cache", type=int, default=2000)
    p.add_argument("--scope", choices=["partition", "root"], default="partition")
    p.add_argument("--layout", choices=["hourly", "daily", "topic_partition"], default=None)
    p.add_argument("--roll-records", type=int, default=None)
    p.add_argument("--resume", action="store_true", help="go on from the lake's committed positions (batch)")
    p.add_argument("--report", action="store_true", help="dead letters and drop counts with every batch")
    p.add_argument("--compression", default="SNAPPY")
    p.add_argument("--max-offsets-per-trigger", type=int, default=None)
    return p.parse_args(argv)


def spec_from(args: argparse.Namespace) -> LoadSpec:
    layout = args.layout or ("topic_partition" if args.loader == "by_topic_partition" else "hourly")
    return LoadSpec(
        dedup=DEDUP_OF[args.loader],
        key_cache=args.key_cache,
        scope="root" if args.scope == "root" else None,
        layout=layout,
        roll_records=args.roll_records,
        resume=args.resume,
        report=args.report,
        parquet=ParquetOptions(compression=args.compression),
    )


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = SparkSession.builder.appName("tidewater-load").getOrCreate()
    apply_required_conf(spark)
    ship_package(spark)
    spec = spec_from(args)
    if args.source == "kafka":
        log = read_kafka(spark, streaming=args.stream, bootstrap_servers=args.bootstrap, topics=args.topics,
                         max_offsets_per_trigger=args.max_offsets_per_trigger)
    else:
        log = read_stream_log(spark, args.path, streaming=args.stream)
    if not args.stream:
        print(load(log, args.base, args.batch_id, spec))
        return
    from ..streaming.load import load_stream

    trigger = {"availableNow": True} if args.available_now or not args.trigger else {"processingTime": args.trigger}
    q = load_stream(log, args.base, spec, checkpoint=args.checkpoint, trigger=trigger, query_name=f"tidewater-{args.loader}")
    q.awaitTermination()


if __name__ == "__main__":
    main()
