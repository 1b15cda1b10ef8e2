"""Command line: ``python -m tidewatch stream | triage | review``; the master comes from the Spark configuration."""

from __future__ import annotations

import argparse

from tidewatch.operators import evidence
from tidewatch.plans.mart_views import triage_store
from tidewatch.session import build_session
from tidewatch.sources.curated import CuratedStore
from tidewatch.sources.evidence_files import load_evidence
from tidewatch.sources.messages import decode_messages, read_kafka_stream
from tidewatch.streaming.pipeline import PipelineConfig, start_pipeline, supervise


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidewatch")
    jobs = parser.add_subparsers(dest="job", required=True)

    stream = jobs.add_parser("stream", help="run the pipeline from a Kafka topic")
    stream.add_argument("--bootstrap-servers", required=True)
    stream.add_argument("--topic", required=True)
    stream.add_argument("--checkpoints", required=True, help="shared folder for the query checkpoints")
    stream.add_argument("--store", help="shared folder of the curated tables; without it metrics go to the console")
    stream.add_argument("--trigger", default="15 seconds")
    stream.add_argument("--watermark-delay", default="10 minutes")

    triage = jobs.add_parser("triage", help="score the newest untriaged threats")
    triage.add_argument("--store", required=True)
    triage.add_argument("--limit", type=int, default=100)

    review = jobs.add_parser("review", help="profile an evidence file")
    review.add_argument("path")
    review.add_argument("--objective", default="evidence review")
    review.add_argument("--format", choices=["csv", "json", "jsonl"])
    review.add_argument("--limit", type=int)
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = build_session(f"tidewatch-{args.job}")
    if args.job == "stream":
        events = decode_messages(read_kafka_stream(spark, args.bootstrap_servers, args.topic))
        config = PipelineConfig(args.checkpoints, {"processingTime": args.trigger}, args.watermark_delay)
        store = CuratedStore(spark, args.store) if args.store else None
        supervise(start_pipeline(events, store, config))
    elif args.job == "triage":
        report = triage_store(CuratedStore(spark, args.store), args.limit)
        print(f"fetched {report.fetched} threats, wrote {report.written} new insights")
    else:
        records = load_evidence(spark, args.path, args.format, args.limit)
        evidence.review(records, args.objective).show(truncate=False, vertical=True)


if __name__ == "__main__":
    main()
