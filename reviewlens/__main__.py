"""Command line: ``python -m reviewlens silver|gold|feeds|report IN OUT``.

Run it with ``spark-submit`` or plain Python; master and memory come from the
deployment.  ``silver`` prints rows and filled values of the columns it has
written; ``--by-month`` stores the fact in a folder for each month.  ``feeds`` reads a
gold folder and writes one table per feed, passing over feeds whose tables are missing;
``report`` reads a folder with ``silver`` and ``gold`` in it and writes the daily
series with the items and keywords of its unusual days.
"""

from __future__ import annotations

import argparse

from reviewlens.plans import medallion
from reviewlens.session import get_session
from reviewlens.sources.writers import write_balanced


def main() -> None:
    parser = argparse.ArgumentParser(prog="reviewlens")
    parser.add_argument("step", choices=["silver", "gold", "feeds", "report"])
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--by-month", action="store_true")
    chosen = parser.parse_args()
    spark = get_session(f"reviewlens-{chosen.step}")
    if chosen.step == "silver":
        medallion.build_silver(spark, chosen.source, chosen.target, chosen.by_month)
        medallion.silver_profile(spark, chosen.target).show(1000, truncate=False)
    elif chosen.step == "gold":
        medallion.build_gold(spark, chosen.source, chosen.target)
    elif chosen.step == "report":
        tables = medallion.load_silver(spark, f"{chosen.source}/silver")
        gold, missing = medallion.load_gold(spark, f"{chosen.source}/gold")
        if "daily_volume" not in gold:
            raise SystemExit("the gold folder has no daily series")
        report = medallion.anomaly_report(tables, gold)
        write_balanced(report, chosen.target, order=[report["review_date"]])
    else:
        gold, missing = medallion.load_gold(spark, chosen.source)
        if missing:
            print(f"missing gold tables: {', '.join(missing)}")
        for name, df in medallion.chart_feeds(gold).items():
            write_balanced(df, f"{chosen.target}/{name}.parquet")
    spark.stop()


if __name__ == "__main__":
    main()
