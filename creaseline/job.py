"""Job entry for spark-submit: `creaseline/job.py MODE --base FOLDER [...]`.

Modes: `batch` loads documents and writes the reports, `reports` only writes them, `streaming` follows the live messages.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from creaseline.plans.batch_run import compute_reports, run_batch
from creaseline.plans.reports import REPORTS
from creaseline.sources.live import read_envelopes
from creaseline.streaming.queries import run_chain


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="creaseline", description="Match reports and live metrics.")
    parser.add_argument("mode", choices=["batch", "reports", "streaming"])
    parser.add_argument("--base", required=True, help="folder of the layer tables")
    parser.add_argument("--documents", help="folder of match documents (batch)")
    parser.add_argument("--json-lines", action="store_true", help="many documents in a file, one per line (batch)")
    parser.add_argument("--variant", default="sql", choices=["sql", "frame", "notebook"], help="reading of the reports")
    parser.add_argument("--messages", help="folder of live messages, or the broker's address (streaming)")
    parser.add_argument("--message-format", default="parquet", help="format of the live messages (streaming)")
    parser.add_argument("--every", help="processing interval, such as '10 seconds'; without it, take what is there and stop (streaming)")
    found = parser.parse_args(argv)
    if found.mode == "batch" and not found.documents:
        parser.error("batch needs --documents")
    if found.mode == "streaming" and not found.messages:
        parser.error("streaming needs --messages")
    return found


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    """0 if all went well, 1 if a report failed."""
    args = arguments(argv)
    spark = spark or SparkSession.builder.appName(f"creaseline-{args.mode}").getOrCreate()
    if args.mode == "streaming":
        queries = run_chain(spark, read_envelopes(spark, args.message_format, args.messages), args.base, args.every)
        for q in queries:
            q.awaitTermination()
        return 0
    failed = run_batch(spark, args.documents, args.base, not args.json_lines) if args.mode == "batch" else compute_reports(spark, args.base, args.variant)
    for name, error in failed:
        print(f"{name}: {error}")
    print(f"{len(REPORTS) - len(failed)} of {len(REPORTS)} reports written")
    return int(bool(failed))


if __name__ == "__main__":
    raise SystemExit(main())
