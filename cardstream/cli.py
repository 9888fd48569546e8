"""Command line: run the batch job or start the streaming job.

    spark-submit cardstream/cli.py batch  --input <text lines> --out <dir>
    spark-submit cardstream/cli.py stream --source <drop folder> --out <dir>
    python -m cardstream ...     (same, with a local session)

Reference lists default to the files in ``conf/``; every output is written
under ``--out`` (parquet rows, text lines for alerts/metrics/late rows).
"""

from __future__ import annotations

import argparse
import hashlib
import os
import sys

from pyspark.sql import SparkSession

CONF_DIR = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "conf")
TEXT_OUTPUTS = {"alert_lines", "late_lines"}
ALERT_LOG = {"alerts", "alert_lines"}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cardstream", description=__doc__.splitlines()[0])
    sub = p.add_subparsers(dest="mode", required=True)
    for mode in ("batch", "stream"):
        s = sub.add_parser(mode)
        s.add_argument("--out", required=True, help="output folder")
        s.add_argument("--risky-merchants", default=os.path.join(CONF_DIR, "risky_merchants.txt"))
        s.add_argument("--blacklist", default=os.path.join(CONF_DIR, "country_blacklist.txt"))
    b = sub.choices["batch"]
    b.add_argument("--input", required=True, help="JSON transaction lines (file/folder/glob)")
    b.add_argument("--run-id", help="names this run in the alert log (default: a hash of --input)")
    b.add_argument("--complete", action="store_true",
                   help="count every row (no late-row dropping)")
    b.add_argument("--no-seq", action="store_true",
                   help="lines carry no arrival_seq: order by event time")
    b.add_argument("--number-lines", action="store_true",
                   help="lines carry no arrival_seq: order by file time, path and line")
    s = sub.choices["stream"]
    s.add_argument("--source", required=True, help="drop folder of JSON-line files")
    s.add_argument("--no-seq", action="store_true",
                   help="lines carry no arrival_seq: order by event time")
    s.add_argument("--number-lines", action="store_true",
                   help="lines carry no arrival_seq: order by file time, path and line")
    s.add_argument("--delay-ms", type=int, default=5000, help="out-of-orderness of the feed")
    s.add_argument("--max-files-per-trigger", type=int, default=None)
    s.add_argument("--available-now", action="store_true",
                   help="process what is there, then stop")
    return p


def run(spark: SparkSession, argv: list[str]) -> int:
    from cardstream.plans.job import run_batch_job, start_streaming_job
    from cardstream.sources.json_lines import read_lines, read_numbered_lines
    from cardstream.sources.reference import load_reference_list

    args = _parser().parse_args(argv)
    risky = load_reference_list(spark, args.risky_merchants)
    blacklist = load_reference_list(spark, args.blacklist)
    out = args.out.rstrip("/")
    if args.mode == "batch":
        read = read_numbered_lines if args.number_lines else read_lines
        outputs = run_batch_job(spark, lines=read(spark, args.input),
                                risky_merchants=risky, blacklisted_countries=blacklist,
                                complete=args.complete, lines_carry_seq=not args.no_seq)
        run_id = args.run_id or hashlib.sha256(args.input.encode()).hexdigest()[:16]
        for name, df in outputs.items():
            # the alert log grows from run to run; a run that is retried replaces its own part
            folder = f"{out}/{name}/run={run_id}" if name in ALERT_LOG else f"{out}/{name}"
            writer = df.write.mode("overwrite")
            if name in TEXT_OUTPUTS:
                writer.text(folder)
            else:
                writer.parquet(folder)
        return 0
    trigger = {"availableNow": True} if args.available_now else None
    start_streaming_job(
        spark, args.source, out, risky, blacklist, delay_ms=args.delay_ms, trigger=trigger,
        max_files_per_trigger=args.max_files_per_trigger, lines_carry_seq=not args.no_seq,
        number_file_lines=args.number_lines).awaitTermination()
    return 0


def main(argv: list[str] | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    _parser().parse_args(argv)          # --help and usage errors need no Spark
    active = SparkSession.getActiveSession()
    if active is None:
        from cardstream.session import local_session
        active = local_session()
    return run(active, argv)


if __name__ == "__main__":
    sys.exit(main())
