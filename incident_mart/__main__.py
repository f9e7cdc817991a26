"""Jobs to submit: ``refresh``, ``stream``, ``models`` and ``compact``.

    spark-submit --py-files incident_mart.zip submit.py refresh --root s3a://mart \\
        --pages crashes=s3a://landing/crashes --pages persons=s3a://landing/persons \\
        --load-id 2025-03-12
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .plans import (
    CrashBuckets,
    KeyForm,
    Layout,
    compact_feeds,
    full_refresh,
    publish_catalog,
    publish_models,
)
from .schemas import FEEDS
from .session import build_session, configure
from .sources import read_json_pages, read_sent_fields
from .streaming import start_feed_stream


def _pair(text: str) -> tuple[str, str]:
    name, _, path = text.partition("=")
    if name not in FEEDS or not path:
        raise argparse.ArgumentTypeError(f"want FEED=PATH with FEED one of {', '.join(FEEDS)}")
    return name, path


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="incident_mart")
    jobs = parser.add_subparsers(dest="job", required=True)
    for job in ("refresh", "stream", "models", "compact"):
        sub = jobs.add_parser(job)
        sub.add_argument("--root", required=True, help="folder of the mart")
        if job in ("refresh", "stream"):
            sub.add_argument("--prefix-digits", type=int, default=0, help="of keys, in new tables")
            sub.add_argument("--pages", type=_pair, action="append", required=True)
            sub.add_argument("--page-from", choices=["directory", "file_name"], default="directory")
            sub.add_argument("--layout", choices=["lines", "array"], default="lines")
            sub.add_argument("--on-error", choices=["fail", "prefix"], default="fail")
            sub.add_argument("--first-page", type=int)
            sub.add_argument("--target-filter", help="SQL over the table's rows that can match")
            sub.add_argument("--key-separator", default="")
            sub.add_argument("--timestamp-suffix", default="", help="such as +00")
        if job in ("refresh", "models"):
            sub.add_argument("--sample", type=int, help="rows of persons and crashes to build on")
            sub.add_argument("--buckets", type=int, help="bucket persons and crashes in --database")
        if job == "refresh":
            sub.add_argument("--load-id", required=True)
        if job == "models":
            sub.add_argument("--select", nargs="*", help="models to publish")
        if job != "stream":
            sub.add_argument("--database", help="make the mart's tables and views in this one")
        if job == "compact":
            sub.add_argument("--at-least", type=int, default=2, help="loads worth a rewrite")
            sub.add_argument("--keep-replaced", action="store_true")
        if job == "stream":
            sub.add_argument("--checkpoint", required=True)
            sub.add_argument("--closed", type=_pair, action="append", help="marks of closed pulls")
            sub.add_argument("--every", help="keep looking this often, such as '10 minutes'")
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, int]:
    """Run one job; the rows merged per feed (``refresh`` only)."""
    parser = _arguments()
    args = parser.parse_args(argv)
    spark = configure(spark) if spark else build_session()
    counts: dict[str, int] = {}
    if args.job in ("refresh", "stream"):
        options = {
            "prefix_digits": args.prefix_digits,
            "on_error": args.on_error,
            "first_page": args.first_page,
            "target_filter": F.expr(args.target_filter) if args.target_filter else None,
            "keys": KeyForm(args.key_separator, args.timestamp_suffix),
        }
    buckets = None
    if args.job in ("refresh", "models") and args.buckets:
        if not args.database:
            parser.error("--buckets needs --database")
        buckets = CrashBuckets(args.database, f"{args.root}/buckets", args.buckets)
    if args.job == "refresh":
        pages = {
            name: read_json_pages(
                spark, path, FEEDS[name].column_names, args.page_from, args.layout
            )
            for name, path in args.pages
        }
        sent = {
            name: read_sent_fields(
                spark, path, FEEDS[name].column_names, args.page_from, args.layout
            )
            for name, path in args.pages
        }
        counts, _ = full_refresh(
            spark,
            pages,
            args.root,
            args.load_id,
            sample=args.sample,
            sent=sent,
            buckets=buckets,
            **options,
        )
    elif args.job == "compact":
        compact_feeds(spark, Layout(args.root), args.at_least, args.keep_replaced)
    elif args.job == "models":
        publish_models(spark, Layout(args.root), args.sample, args.select, buckets)
    else:
        closed = dict(args.closed or [])
        running = [
            start_feed_stream(
                spark,
                FEEDS[name],
                path,
                args.root,
                f"{args.checkpoint}/{name}",
                args.page_from,
                args.layout,
                closed=closed.get(name),
                every=args.every,
                **options,
            )
            for name, path in args.pages
        ]
        for query in running:
            query.awaitTermination()
    if args.job != "stream" and args.database:
        publish_catalog(spark, Layout(args.root), args.database)
    return counts


if __name__ == "__main__":
    print(json.dumps(main()))
