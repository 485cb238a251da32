"""Run the jobs: python -m dockline JOB --help, or with spark-submit.

Kafka jobs need the Kafka package of the Spark version in use, for instance
--packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2.
"""

from __future__ import annotations

import argparse

from dockline import schemas
from dockline.plans import board, ingest
from dockline.session import build_session
from dockline.sources import lookup, snapshot, topic
from dockline.streaming import jobs


def reading(job: argparse.ArgumentParser) -> None:
    """Options of a topic read."""
    job.add_argument("--starting-offsets", help="earliest, latest or JSON; default: latest")
    job.add_argument("--min-partitions", type=int, help="split topic partitions into so many tasks at least")
    job.add_argument("--max-offsets-per-trigger", type=int, help="bound of a batch when a job catches up")


def read_options(args: argparse.Namespace) -> dict:
    return {c: getattr(args, c) for c in ("starting_offsets", "min_partitions", "max_offsets_per_trigger")}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="dockline", description=__doc__)
    top.add_argument("--master", help="Spark master; default: as configured")
    sub = top.add_subparsers(dest="job", required=True)

    job = sub.add_parser("poll", help="poll a paged API and send each page to a topic")
    job.add_argument("--url", required=True, help="address with {limit} and {offset}")
    job.add_argument("--servers", required=True)
    job.add_argument("--topic", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--seconds", type=int, default=jobs.POLL_SECONDS)
    job.add_argument("--limit", type=int, default=100)
    job.add_argument("--errors", help="folder for JSON rows of pages that failed; default: beside the checkpoint")

    job = sub.add_parser("ingest", help="keep the station rows of a topic as JSON files")
    job.add_argument("--servers", required=True)
    job.add_argument("--topic", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--lookup", help="JSON object of station code to name")
    job.add_argument("--by-date", action="store_true", help="partition the files by ingest day")
    job.add_argument("--seconds", type=int, help="trigger interval; default: as fast as possible")
    reading(job)

    job = sub.add_parser("indicators", help="keep the area measures of every finished poll of a topic")
    job.add_argument("--servers", required=True)
    job.add_argument("--topic", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--delay", default=jobs.PAGE_DELAY, help="how long a poll waits for its pages")
    job.add_argument("--seconds", type=int, help="trigger interval; default: as fast as possible")
    reading(job)

    job = sub.add_parser("mirror", help="copy topics from one cluster to another")
    job.add_argument("--from-servers", required=True)
    job.add_argument("--to-servers", required=True)
    job.add_argument("--source", required=True, help="alias of the cluster read")
    job.add_argument("--target", required=True, help="alias of the cluster written")
    job.add_argument("--topics", default=".*")
    job.add_argument("--checkpoint", required=True)
    reading(job)

    job = sub.add_parser("board", help="write the parts of the station board")
    job.add_argument("--rows", required=True, help="folder of station rows")
    job.add_argument("--out", required=True)
    job.add_argument("--newest-file", action="store_true", help="show the newest file instead of the newest poll")
    job.add_argument("--show", choices=("all", "full", "empty"), default="all")
    job.add_argument("--user", type=float, nargs=2, metavar=("LAT", "LON"))

    job = sub.add_parser("lookup", help="list a lookup file as rows")
    job.add_argument("--path", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--multiline", action="store_true")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"dockline-{args.job}", args.master)
    if args.job == "poll":
        ingest.poll_to_kafka(
            spark, args.url, args.servers, args.topic, args.checkpoint, args.seconds,
            args.errors, limit=args.limit
        ).awaitTermination()
    elif args.job == "ingest":
        names = lookup.read_lookup(spark, args.lookup) if args.lookup else None
        ingest.kafka_to_json(
            spark, args.servers, args.topic, args.out, args.checkpoint, names, args.seconds, args.by_date,
            **read_options(args),
        ).awaitTermination()
    elif args.job == "indicators":
        ingest.kafka_to_indicators(
            spark, args.servers, args.topic, args.out, args.checkpoint, args.seconds, args.delay, **read_options(args)
        ).awaitTermination()
    elif args.job == "mirror":
        log = topic.kafka_stream(spark, servers=args.from_servers, pattern=args.topics, **read_options(args))
        copied = topic.mirror(log, args.source, args.target, args.topics)
        jobs.run(topic.stream_to_kafka(copied, args.to_servers, args.checkpoint)).awaitTermination()
    elif args.job == "board":
        if args.newest_file:
            newest = snapshot.latest_file(snapshot.read_snapshots(spark, args.rows, schemas.SNAPSHOT))
        else:
            newest = snapshot.read_newest(spark, args.rows)
        newest = newest.persist()
        user = tuple(args.user) if args.user else None
        for name, part in board.board(newest, args.show, user).items():
            part.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
    else:
        lookup.read_lookup(spark, args.path, multiline=args.multiline).write.parquet(args.out)


if __name__ == "__main__":
    main()
