"""Jobs for spark-submit: ``batch`` rebuilds the views, ``days`` the views of some days,
``stream`` runs the speed layer, ``output`` one further output of the same input, ``replay``
computes the batches of a time again, ``risks`` publishes a version of the risk tables, ``maintain`` applies retention and compaction and deletes dead folders."""

from __future__ import annotations

import argparse
from datetime import date, datetime, timedelta, timezone

from riskweave.operators import model
from riskweave.plans import batch, incremental, serve, stream
from riskweave.session import build_session, use_rocksdb_state
from riskweave.settings import Settings
from riskweave.sources.risk_tables import publish_version
from riskweave.streaming import replay, speed
from riskweave.streaming.progress import ProgressTable


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="riskweave", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    b = jobs.add_parser("batch")
    b.add_argument("--input", required=True, help="landing folder with year=/month=/day=")
    b.add_argument("--output", required=True)
    b.add_argument("--no-model", action="store_true")
    b.add_argument("--risks", help="folder of risk versions")
    r = jobs.add_parser("risks")
    r.add_argument("--file", required=True, help="risk tables as JSON")
    r.add_argument("--output", required=True, help="folder of risk versions")
    r.add_argument("--valid-from", required=True, type=datetime.fromisoformat)
    d = jobs.add_parser("days")
    d.add_argument("--input", required=True, help="landing folder with year=/month=/day=")
    d.add_argument("--output", required=True)
    d.add_argument("--first", required=True, type=date.fromisoformat)
    d.add_argument("--last", required=True, type=date.fromisoformat)
    m = jobs.add_parser("maintain")
    m.add_argument("--realtime", help="output of the stream job")
    m.add_argument("--days", help="output of the days job")
    m.add_argument("--keep-hours", type=int, default=24,
                   help="longer than any run and any read of a view")
    y = jobs.add_parser("replay")
    y.add_argument("--output", required=True, help="output of the stream job")
    y.add_argument("--checkpoint", required=True, help="its checkpoint, of a file stream")
    y.add_argument("--start", required=True, type=datetime.fromisoformat)
    y.add_argument("--end", required=True, type=datetime.fromisoformat)
    s = jobs.add_parser("stream")
    s.add_argument("--output", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--input", help="landing folder; the transactions topic when absent")
    s.add_argument("--starting-offsets", default="latest")
    s.add_argument("--risks", help="folder of risk versions, read anew for every micro-batch")
    s.add_argument("--profiles", help="output of the batch job, for its newest profiles")
    s.add_argument("--models", help="output of the batch job, for its newest stream model")
    o = jobs.add_parser("output")
    o.add_argument("name", choices=sorted(stream.JOBS))
    o.add_argument("--output", required=True)
    o.add_argument("--checkpoint", required=True)
    o.add_argument("--input", help="landing folder; the transactions topic when absent")
    o.add_argument("--starting-offsets", default="latest")
    args = parser.parse_args(argv)

    spark, settings = build_session(f"riskweave-{args.job}"), Settings.from_env()
    now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    if args.job == "days":
        print(incremental.run_days(spark, args.input, args.output, args.first, args.last, now,
                                   s=settings))
        return
    if args.job == "replay":
        chosen = replay.between(replay.batches(spark, args.checkpoint), args.start, args.end)
        print(chosen, replay.replay(spark, args.checkpoint, args.output, *chosen, now, settings))
        return
    if args.job == "risks":
        publish_version(spark, args.output, args.file, args.valid_from)
        return
    if args.job == "maintain":
        keep = timedelta(hours=args.keep_hours)
        if args.realtime:
            print(serve.maintain(spark, args.realtime, now, keep=keep))
        if args.days:
            print(incremental.collect(spark, args.days, now, keep))
        return
    if args.job == "batch":
        valid, rejected = batch.read_valid(spark, args.input)
        done = batch.run(spark, valid, args.output, now, settings,
                         train_model=not args.no_model, rejected=rejected, risks=args.risks)
        print(done.summary)
        return
    use_rocksdb_state(spark)
    records = (
        speed.read_landing_stream(spark, args.input) if args.input
        else speed.read_records(spark, settings, args.starting_offsets)
    )
    spark.streams.addListener(ProgressTable(spark, args.output))
    if args.job == "output":
        stream.JOBS[args.name](records, args.output, args.checkpoint, s=settings)
    else:
        path = model.champion(spark, batch.stream_models(args.models)) if args.models else None
        stream.start(records, args.output, args.checkpoint,
                     model.load(path) if path else None, settings, risks=args.risks,
                     profiles=args.profiles)
    # Ends with the first query that fails, so no failure goes unseen.
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
