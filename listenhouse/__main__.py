"""Command line: ``spark-submit`` this file's package with one of the jobs.

    ingest     topics (Kafka or folders of JSON lines) to partitioned Parquet
    load       landed listens to dimensions and fact table
    dims       only the dimensions
    fact       only the fact table
    export     what the topics hold, to CSV
"""

from __future__ import annotations

import argparse
import os

from listenhouse.plans.jobs import landed_listens, load_dimensions, load_fact, load_warehouse
from listenhouse.schemas import TIME_PARTS, TOPICS
from listenhouse.session import get_session
from listenhouse.streaming.export import export_topics, read_kafka_batch
from listenhouse.streaming.ingest import (
    drain, read_file_stream, read_kafka_stream, start_ingest, supervise,
)


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="listenhouse", description=__doc__.splitlines()[0])
    parser.add_argument("--app-name", default=os.getenv("APP_NAME", "listenhouse"))
    parser.add_argument("--master", default=None, help="default: as spark-submit says")
    jobs = parser.add_subparsers(dest="job", required=True)

    ingest = jobs.add_parser("ingest")
    ingest.add_argument("out")
    ingest.add_argument("--address", default=os.getenv("KAFKA_ADDRESS", "localhost"))
    ingest.add_argument("--port", default="9092")
    ingest.add_argument("--files", help="read <files>/<topic> instead of Kafka")
    ingest.add_argument("--trigger", default="120 seconds")
    ingest.add_argument("--once", action="store_true", help="read all there is and stop")
    ingest.add_argument("--on-bad", default="null", choices=["null", "drop", "quarantine"])
    ingest.add_argument("--offsets", default="earliest", help="where a new stream starts")
    ingest.add_argument("--stop-on-loss", action="store_true", help="fail where messages are gone")
    ingest.add_argument("--partition-by", nargs="+", default=None, choices=["year", "month", "day", "hour"])
    ingest.add_argument("--topics", nargs="+", default=list(TOPICS), choices=list(TOPICS))

    for name in ("load", "dims", "fact"):
        job = jobs.add_parser(name)
        job.add_argument("events")
        job.add_argument("warehouse")
        job.add_argument("--detailed", action="store_true", help="fact with duration and parts of the time")

    export = jobs.add_parser("export")
    export.add_argument("out")
    export.add_argument("--address", default=os.getenv("KAFKA_ADDRESS", "localhost"))
    export.add_argument("--port", default="9092")
    export.add_argument("--listens", type=int, default=None, help="stop at this listen event; default: all")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = get_session(args.app_name, args.master)
    if args.job == "ingest":
        if args.files:
            streams = {t: read_file_stream(spark, f"{args.files}/{t}") for t in args.topics}
        else:
            streams = {
                t: read_kafka_stream(spark, args.address, args.port, t, args.offsets, args.stop_on_loss)
                for t in args.topics
            }
        trigger = None if args.once else args.trigger
        queries = start_ingest(streams, args.out, trigger, args.on_bad, args.partition_by or TIME_PARTS)
        if args.once:
            drain(queries)
        else:
            supervise(spark, queries)
    elif args.job == "load":
        print(load_warehouse(spark, args.events, args.warehouse, detailed=args.detailed))
    elif args.job == "dims":
        print(load_dimensions(spark, landed_listens(spark, args.events), args.warehouse, "exact"))
    elif args.job == "fact":
        print(load_fact(spark, landed_listens(spark, args.events), args.warehouse, algo="exact", detailed=args.detailed))
    elif args.job == "export":
        messages = read_kafka_batch(spark, args.address, args.port)
        export_topics(messages, args.out, ["timestamp", "partition", "offset"], args.listens)


if __name__ == "__main__":
    main()
