"""Command line: ``python -m marketlens <command> ...``

consume   stream the feeds into the partitioned fact table
cycle     consume for a bounded time, stop, compact; once, or repeated until a stop file appears
split     part the feed into an archive of on-time rows and a side table of late ones
correct   replace the closed windows that late rows belong to
compact   pack small files of the fact table into files of a target size
analyze   per-symbol analysis of the fact table, written as parquet
"""

from __future__ import annotations

import argparse
import sys

from . import config as C


def _session(args):
    from .session import get_session, shared_dir
    spark = get_session(args.master, app_name=f"marketlens-{args.command}",
                        driver_memory=None if not args.master else "8g", hive=args.hive,
                        profile="local" if args.master and args.master.startswith("local") else "cluster")
    shared_dir(spark)
    return spark


def _feed(spark, args):
    from .streaming import jobs
    if args.source_path:
        return jobs.feed_from_files(spark, args.source_path, args.files_per_trigger)
    if not args.bootstrap:
        sys.exit("--bootstrap or --source-path is required")
    return jobs.feed_from_kafka(spark, args.bootstrap, args.starting_offsets)


def cmd_consume(args) -> None:
    from .streaming import jobs
    spark = _session(args)
    bad = None
    if not args.source_path and args.bootstrap:     # messages that do not decode are kept beside the table
        bad = jobs.write_quarantine(jobs.quarantine_from_kafka(spark, args.bootstrap, args.starting_offsets),
                                    args.quarantine or f"{args.checkpoint.rstrip('/')}/_quarantine",
                                    f"{args.checkpoint.rstrip('/')}/_quarantine_ckpt", args.available_now, args.interval)
    q = jobs.consume(spark, _feed(spark, args), table=args.table, checkpoint=args.checkpoint,
                     mode=args.mode, step=args.step, delay=args.delay,
                     interval_seconds=args.interval, available_now=args.available_now)
    q.awaitTermination(None if args.minutes is None else args.minutes * 60)
    q.stop()
    if bad is not None:
        bad.stop()


def cmd_cycle(args) -> None:
    from .streaming.cycle import run_cycle, supervise
    spark = _session(args)
    if args.repeat or args.cycles:
        supervise(spark, lambda: _feed(spark, args), table=args.table, checkpoint=args.checkpoint, step=args.step, delay=args.delay,
                  minutes=args.minutes, interval_seconds=args.interval, cycles=args.cycles, stop_file=args.stop_file)
        return
    run_cycle(spark, _feed(spark, args), table=args.table, checkpoint=args.checkpoint,
              step=args.step, delay=args.delay, minutes=args.minutes,
              available_now=args.available_now, interval_seconds=args.interval)


def cmd_split(args) -> None:
    from .streaming.late import split_late
    spark = _session(args)
    q = split_late(_feed(spark, args), archive=args.archive, late=args.late, checkpoint=args.checkpoint, step=args.step, delay=args.delay,
                   available_now=args.available_now, interval_seconds=args.interval)
    q.awaitTermination(None if args.minutes is None else args.minutes * 60)
    q.stop()


def cmd_correct(args) -> None:
    import datetime as dt
    from .streaming.late import correct_windows
    correct_windows(_session(args), archive=args.archive, late=args.late, table=args.table, step=args.step,
                    closed_before=dt.datetime.fromisoformat(args.closed_before))


def cmd_compact(args) -> None:
    from .sinks.orc import compact
    compact(_session(args), args.table, target_bytes=args.target_mb << 20)


ANALYSES = ("acf", "pacf", "adf", "qq", "corr", "arima_grid", "arima_likelihood", "arima_mle", "arima_forecast", "split_sorted")


def cmd_analyze(args) -> None:
    from .operators import analysis as A
    from .operators import series as X
    from .operators.arima import arima_forecast, arima_grid, arima_likelihood, arima_mle
    spark = _session(args)
    tv = spark.read.orc(args.path) if args.path else spark.table(args.table)
    if args.symbol:
        tv = A.one_symbol(tv, args.symbol)
    out = {
        "acf": lambda: X.acf(tv, value=args.value, nlags=args.lags),
        "pacf": lambda: X.pacf(X.acf(tv, value=args.value, nlags=args.lags)),
        "adf": lambda: X.adf(tv, value=args.value),
        "qq": lambda: X.qq_points(tv, value=args.value),
        "corr": lambda: A.corr_matrix(tv),
        "arima_grid": lambda: arima_grid(tv, value=args.value),
        "arima_likelihood": lambda: arima_likelihood(tv, value=args.value),
        "arima_mle": lambda: arima_mle(tv, value=args.value),
        "arima_forecast": lambda: arima_forecast(tv, value=args.value, horizon=args.horizon),
        "split_sorted": lambda: A.split_sorted(tv),
    }[args.what]()
    out.write.mode("overwrite").parquet(args.out)


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m marketlens")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    p.add_argument("--hive", action="store_true",
                   help="use the cluster's Hive metastore as the table catalog")
    sub = p.add_subparsers(dest="command", required=True)

    def stream_args(sp):
        sp.add_argument("--table", default=f"{C.DATABASE}.{C.TRADE_VOLUME_TABLE}")
        sp.add_argument("--checkpoint", required=True)
        sp.add_argument("--bootstrap", help="Kafka bootstrap servers")
        sp.add_argument("--starting-offsets", default="latest")
        sp.add_argument("--source-path", help="replay parquet files of the feed schema instead of Kafka")
        sp.add_argument("--files-per-trigger", type=int, default=1)
        sp.add_argument("--step", default="1 day", help="event-time bucket")
        sp.add_argument("--delay", default="1 hour", help="watermark delay")
        sp.add_argument("--interval", type=int, default=C.MICROBATCH_SECONDS)
        sp.add_argument("--minutes", type=float, default=None)
        sp.add_argument("--available-now", action="store_true")

    c = sub.add_parser("consume")
    stream_args(c)
    c.add_argument("--mode", choices=("event", "parity"), default="event")
    c.add_argument("--quarantine", help="folder for messages that do not decode (default: beside the checkpoint)")
    c.set_defaults(fn=cmd_consume)
    cy = sub.add_parser("cycle")
    stream_args(cy)
    cy.add_argument("--repeat", action="store_true", help="repeat cycles until --stop-file exists")
    cy.add_argument("--cycles", type=int, default=None, help="number of cycles to repeat")
    cy.add_argument("--stop-file", default=None)
    cy.set_defaults(fn=cmd_cycle, minutes=C.RUN_CYCLE_MINUTES)
    sp = sub.add_parser("split")
    stream_args(sp)
    sp.add_argument("--archive", required=True)
    sp.add_argument("--late", required=True)
    sp.set_defaults(fn=cmd_split)
    co = sub.add_parser("correct")
    co.add_argument("--table", default=f"{C.DATABASE}.{C.TRADE_VOLUME_TABLE}")
    co.add_argument("--archive", required=True)
    co.add_argument("--late", required=True)
    co.add_argument("--step", default="1 day")
    co.add_argument("--closed-before", required=True, help="instant (ISO) up to which the windows have been emitted")
    co.set_defaults(fn=cmd_correct)
    cp = sub.add_parser("compact")
    cp.add_argument("--table", default=f"{C.DATABASE}.{C.TRADE_VOLUME_TABLE}")
    cp.add_argument("--target-mb", type=int, default=256)
    cp.set_defaults(fn=cmd_compact)
    a = sub.add_parser("analyze")
    a.add_argument("what", choices=ANALYSES)
    a.add_argument("--table", default=f"{C.DATABASE}.{C.TRADE_VOLUME_TABLE}")
    a.add_argument("--path", help="read the fact table's ORC files from this location instead")
    a.add_argument("--symbol")
    a.add_argument("--value", default="first_cost")
    a.add_argument("--lags", type=int, default=30)
    a.add_argument("--horizon", type=int, default=1000)
    a.add_argument("--out", required=True)
    a.set_defaults(fn=cmd_analyze)
    return p


def main(argv=None) -> None:
    args = build_parser().parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main()
