"""Command line: sanitise a CSV with a report, clean a column by rules, look after a ledger.

``python -m amalgrid.cli sanitise --input in.csv --output_csv out --report report.md [--use_batches --db_path ledger]``
``python -m amalgrid.cli clean --input in.csv --output out [--column record_name] [--rules rules.json]``
``python -m amalgrid.cli ledger --db_path ledger list-failed | reset-failed | stats | reset-db [--yes]``
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amalgrid.functions.cleaning import sanitise
from amalgrid.functions.rules import RULES, clean_frame, load_rules
from amalgrid.operators.learning import PROMPTS, classify_by_rules
from amalgrid.operators.tables import dense_ids
from amalgrid.session import get_spark
from amalgrid.sources.files import read_csv, write_csv
from amalgrid.streaming.ledger import COLUMNS, Ledger, type_counts, write_text


def _names(spark: SparkSession, path: str) -> DataFrame:
    """The CSV with a record_id: its own, or the number of its name among the distinct names."""
    rows = read_csv(spark, path)
    if "record_name" not in rows.columns:
        raise ValueError(f"no column record_name; there are {rows.columns}")
    if "record_id" in rows.columns:
        return rows.withColumn("record_id", F.col("record_id").cast("long"))
    rows = rows.withColumn("record_name", F.coalesce("record_name", F.lit("")))
    return rows.join(dense_ids(rows, "record_name", "record_id", 1), "record_name")


def run_sanitise(spark: SparkSession, args: argparse.Namespace) -> str:
    rows = _names(spark, args.input)

    def work(df: DataFrame) -> DataFrame:
        made = sanitise(df)
        return classify_by_rules(made) if args.use_classifier else made

    if args.use_batches:
        ledger = Ledger(spark, args.db_path)
        ledger.run(rows, args.batch_size, not args.no_resume, work)
        ledger.export(args.output_csv)
        return ledger.report(args.report)
    made = work(rows)
    write_csv(made, args.output_csv)
    counts = type_counts(made).collect()
    text = "\n".join(["# Processing report", "", f"Date: {dt.datetime.now().isoformat(timespec='seconds')}", "", f"Records: {sum(r.n for r in counts)}", "", "## Types", "", "| type | records |", "| --- | --- |", *(f"| {r.type_hint} | {r.n} |" for r in counts), "", "## Columns", "", *(f"- {n}: {w}" for n, w in COLUMNS)]) + "\n"
    write_text(spark, args.report, text)
    return text


def run_clean(spark: SparkSession, args: argparse.Namespace) -> str:
    rows = read_csv(spark, args.input, missing_as_null=True)
    made = clean_frame(rows, args.column, f"{args.column}_clean", load_rules(args.rules) if args.rules else RULES, smart=True)
    if args.use_classifier:
        made = classify_by_rules(made, f"{args.column}_clean")
    write_csv(made, args.output)
    return f"{args.column} cleaned into {args.output}"


def run_ledger(spark: SparkSession, args: argparse.Namespace) -> str:
    ledger = Ledger(spark, args.db_path)
    if args.command == "list-failed":
        rows = ledger.failed().select("batch_id", "start_index", "end_index", "error").collect()  # batches, not records
        return "\n".join(f"batch {r.batch_id} ({r.start_index} to {r.end_index}): {r.error}" for r in rows) or "no failed batches"
    if args.command == "reset-failed":
        return f"{ledger.reset_failed()} batches reset"
    if args.command == "stats":
        return ledger.report()
    if not args.yes and input(f"Delete everything in {args.db_path}? (y/N) ").strip().lower() != "y":
        return "nothing was deleted"
    ledger.reset(confirm=True)
    return "the ledger is empty"


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="amalgrid", description="Clean the names of people and organisations")
    what = top.add_subparsers(dest="what", required=True)
    p = what.add_parser("sanitise", help="types, display names and match keys of a CSV with a record_name column")
    p.add_argument("--input", required=True)
    p.add_argument("--output_csv", required=True)
    p.add_argument("--report", required=True)
    p.add_argument("--use_classifier", action="store_true", help="add types by the classifier's stand-in")
    p.add_argument("--use_batches", action="store_true", help="in batches, with a ledger that a later run resumes")
    p.add_argument("--batch_size", type=int, default=5000)
    p.add_argument("--db_path", default="processing_ledger")
    p.add_argument("--no_resume", action="store_true")
    p.set_defaults(run=run_sanitise)
    p = what.add_parser("clean", help="one column of a CSV by the rule cascade")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--column", default="record_name")
    p.add_argument("--rules", default=None, help="a JSON list of rules in place of the built-in ones")
    p.add_argument("--use_classifier", action="store_true")
    p.add_argument("--context_strategy", default="neutral", choices=sorted(PROMPTS))
    p.set_defaults(run=run_clean)
    p = what.add_parser("ledger", help="look after a ledger")
    p.add_argument("--db_path", default="processing_ledger")
    p.add_argument("command", choices=["list-failed", "reset-failed", "stats", "reset-db"])
    p.add_argument("--yes", action="store_true", help="delete without asking")
    p.set_defaults(run=run_ledger)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> str:
    args = parser().parse_args(argv)
    text = args.run(spark or get_spark("amalgrid"), args)
    print(text)
    return text


if __name__ == "__main__":
    main()
