"""Command line of the two jobs: `batch` over all landed reports, `ingest` of new ones."""

from __future__ import annotations

import argparse
import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import SparkSession

from reddwatch import params
from reddwatch.operators.exclusion import distinct_tags
from reddwatch.plans.batch import GAUGE, Store, flow_table, run_batch, save_flow
from reddwatch.session import build_session
from reddwatch.sources import dimensions, gauges, reports
from reddwatch.streaming.ingest import ingest_reports, refresh_downstream


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="reddwatch", description=__doc__)
    parser.add_argument("job", choices=["batch", "ingest"])
    parser.add_argument("--reports", required=True, nargs="+", help="landed detection reports")
    parser.add_argument("--downstream", required=True, nargs="+", help="downstream reports")
    parser.add_argument("--sites", required=True, help="site table, Parquet or .csv")
    parser.add_argument("--out", required=True, help="folder of the saved tables")
    parser.add_argument("--groups", help="site group table; the home group if left out")
    cut = parser.add_mutually_exclusive_group()
    cut.add_argument("--split-lines", action="store_true",
                     help="no report field holds a line break: split large files")
    cut.add_argument("--blocks", action="store_true",
                     help="read large files in parallel though their fields may hold line breaks")
    parser.add_argument("--gauge", help="stored gauge readings")
    parser.add_argument("--gauge-feed", help="a feed with a column per parameter, Parquet or .csv, "
                        "landed among the stored readings first")
    parser.add_argument("--gauge-site", default=params.GAUGE_SITE)
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="today if left out")
    parser.add_argument("--shuffle-bytes", type=int, default=0,
                        help="expected size of the largest exchange")
    args = parser.parse_args(argv)
    if args.job == "ingest" and len(args.reports) > 1:
        parser.error("ingest follows one landing folder per set of tables")
    if args.gauge_feed and not args.gauge:
        parser.error("--gauge-feed needs the place of the stored readings, --gauge")
    return args


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session(shuffle_bytes=args.shuffle_bytes)
    store = Store(args.out)
    sites = dimensions.read_sites(spark, args.sites)
    if args.groups:
        groups = dimensions.read_site_groups(spark, args.groups)
    else:
        groups = params.site_group_table(spark, [params.HOME_GROUP])
    as_of = args.as_of or dt.datetime.now(ZoneInfo(params.ZONE)).date()
    line_breaks = reports.BLOCKS if args.blocks else not args.split_lines
    readings = None
    if args.gauge_feed:
        land_feed(spark, args.gauge_feed, args.gauge_site, args.gauge)
    if args.gauge:
        readings = gauges.read_gauge(
            spark, args.gauge, [args.gauge_site], [params.TEMPERATURE, params.DISCHARGE],
            params.GAUGE_HISTORY_START, as_of,
        )
    if args.job == "batch":
        run_batch(
            spark, args.reports, args.downstream, sites, groups, store, readings, as_of,
            line_breaks,
        )
        return
    # Every batch reads this set, so it is parsed once.
    downstream = refresh_downstream(
        spark, store,
        distinct_tags(
            reports.read_downstream(spark, *args.downstream, line_breaks=line_breaks)
        ),
        sites,
    )
    ingest_reports(
        spark, args.reports[0], store, groups, downstream, sites, line_breaks=line_breaks
    )
    if readings is not None:
        save_flow(flow_table(readings, as_of, keys=GAUGE), store)


def land_feed(spark: SparkSession, feed: str, site_no: str, path: str) -> None:
    """Add a feed with one column per parameter to the stored readings."""
    if feed.endswith(".csv"):
        wide = spark.read.options(header=True, nullValue="NA").csv(feed)
        wide = wide.withColumns(
            {c: wide[c].try_cast("double") for c in params.GAUGE_FEED_COLUMNS}
        )
    else:
        wide = spark.read.parquet(feed)
    gauges.write_gauge(gauges.from_wide(wide, site_no, params.GAUGE_FEED_COLUMNS), path)


if __name__ == "__main__":
    main()
