"""Command-line entry point: per-batch word count with an offset ledger.

    python -m quillstream.streaming.app <brokers> <topics> <base> [options]
    python -m quillstream.streaming.app - lines <base> --lines host:port

``base`` is a folder (shared storage on a cluster) holding ``ledger/``,
``counts/`` and ``cells/``. With ``--replay-log PATH`` a Parquet topic log
(Kafka columns, partitioned by topic) is replayed instead of reading brokers;
with ``--lines`` or ``--lines-dir`` lines of text from a socket or from files are
counted per batch (no ledger, a batch a second by default).

A restart on the same checkpoint goes on where the stream stopped, with the
sources it was started with. To resume from the ledger instead, start on a new
``--checkpoint``; ``--from-ledger`` makes sure of that: it refuses a checkpoint
that already has offsets. ``--dry-run`` prints the start plan and exits.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict

from quillstream.session import build_session, shared_dir
from quillstream.sources.topiclog import open_sources, parse_topics, topic_log_stream
from quillstream.streaming.batches import BatchOutputs, start_plan, start_word_count_stream
from quillstream.streaming.checkpoints import has_offsets, load_start_plan, save_start_plan
from quillstream.streaming.replay import socket_stream, text_stream


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="quillstream.streaming.app", description=__doc__.split("\n")[0])
    p.add_argument("brokers", help="Kafka bootstrap servers, host:port[,host:port]")
    p.add_argument("topics", help="comma-separated topics")
    p.add_argument("base", help="folder for ledger/, counts/ and cells/")
    p.add_argument("--interval", type=float, help="seconds per micro-batch (default 2; 1 for lines)")
    p.add_argument("--start", choices=["latest", "earliest"], default="latest", help="fresh-start position")
    p.add_argument("--resume", choices=["from", "until"], default="from",
                   help="resume at the last batch's fromOffset (replays it) or untilOffset")
    p.add_argument("--strict-ledger", action="store_true", help="on resume, read exactly the ledger's partitions")
    p.add_argument("--partitions", action="append", default=[], metavar="TOPIC=N",
                   help="number of partitions a topic has now; those the ledger lacks start at their earliest offset")
    p.add_argument("--from-ledger", action="store_true", help="resume from the ledger: refuse a checkpoint with offsets")
    p.add_argument("--no-cells", action="store_true", help="do not write counts as cells")
    p.add_argument("--show", type=int, default=10, help="count rows printed per batch (0: none)")
    p.add_argument("--checkpoint", help="stream checkpoint (default: under spark.checkpoint.dir)")
    p.add_argument("--replay-log", help="replay a Parquet topic log instead of reading brokers")
    p.add_argument("--lines", metavar="HOST:PORT", help="count lines from a text socket (development only)")
    p.add_argument("--lines-dir", help="count lines of the text files that appear in a folder")
    p.add_argument("--max-files-per-trigger", type=int, default=1, help="replay batch size in files")
    p.add_argument("--max-offsets-per-trigger", type=int, default=None,
                   help="Kafka batch size bound in messages (rate limit; default: unbounded)")
    p.add_argument("--available-now", action="store_true",
                   help="process what is available now in micro-batches, then stop (backfill/replay)")
    p.add_argument("--dry-run", action="store_true", help="print the start plan and exit")
    args = p.parse_args(argv)
    args.topic_list = parse_topics(args.topics)
    if args.interval is None:
        args.interval = 1.0 if args.lines or args.lines_dir else 2.0
    if args.interval <= 0:
        p.error("--interval must be positive")
    if sum(map(bool, (args.lines, args.lines_dir, args.replay_log))) > 1:
        p.error("--lines, --lines-dir and --replay-log exclude each other")
    try:
        counts = [part.rsplit("=", 1) for part in args.partitions]
        args.partition_lists = {topic: list(range(int(n))) for topic, n in counts}
        host, _, port = (args.lines or "-:0").rpartition(":")
        args.address = host, int(port)
    except ValueError:
        p.error("--partitions takes TOPIC=N and --lines HOST:PORT")
    return args


def main(argv: list[str] | None = None, spark=None) -> int:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    spark = spark or build_session(app_name="quillstream-word-count")
    base = args.base.rstrip("/")
    of_lines = bool(args.lines or args.lines_dir)
    outputs = BatchOutputs(
        counts=f"{base}/counts",
        ledger=None if of_lines else f"{base}/ledger",
        cells=None if args.no_cells else f"{base}/cells",
        show_rows=args.show or None,
        split_lines=of_lines,
    )
    name = "word-count-" + "-".join(args.topic_list)
    checkpoint = (args.checkpoint or shared_dir(spark, "streams", name)).rstrip("/")
    started = has_offsets(spark, checkpoint)
    if args.from_ledger and started:
        raise SystemExit(f"{checkpoint} has offsets: name a new --checkpoint to resume from the ledger")
    specs = None
    if of_lines:
        plan = [{"lines": args.lines or args.lines_dir}]
    elif args.replay_log:
        plan = [{"replay": args.replay_log, "topics": args.topic_list}]
    else:
        # a checkpoint's offsets belong to the sources the stream was started
        # with, in their order; the ledger may know more by now
        specs = load_start_plan(spark, checkpoint) if started else None
        if started and specs is None:
            raise SystemExit(f"{checkpoint} has offsets but no start plan: name a new --checkpoint")
        if specs is None:
            specs = start_plan(spark, outputs.ledger, args.topic_list, args.start, args.resume,
                               args.strict_ledger, args.partition_lists)
        plan = [asdict(s) for s in specs]
    if args.dry_run:
        print(json.dumps({"sources": plan, "outputs": asdict(outputs)}, sort_keys=True))
        return 0
    if args.lines:
        source = socket_stream(spark, *args.address)
    elif args.lines_dir:
        source = text_stream(spark, args.lines_dir, args.max_files_per_trigger)
    elif args.replay_log:
        source = topic_log_stream(spark, args.replay_log, args.topic_list, args.max_files_per_trigger)
    else:
        if not started:
            save_start_plan(spark, checkpoint, specs)
        source = open_sources(spark, args.brokers, specs, max_offsets_per_trigger=args.max_offsets_per_trigger)
    trigger = {"availableNow": True} if args.available_now else {"processingTime": f"{args.interval} seconds"}
    query = start_word_count_stream(source, outputs, name, checkpoint=checkpoint, trigger=trigger)
    query.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
