"""Compare equivalent forms: ``python benchmarks/forms.py [folder]``.

Aggregate before the bridge join against fanning the fact out, and separate
item aggregates against one stored summary.
"""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from reviewlens.catalog import queries as q  # noqa: E402
from reviewlens.catalog.testdata import Tables  # noqa: E402
from tests.conftest import make_session  # noqa: E402


def fan_out(t: Tables):
    """Category sentiment with one row per review and category."""
    return (
        t.reviews()
        .join(t.genre_bridge(), "item_id")
        .join(t.genres(), "genre_id")
        .groupBy("genre_name")
        .agg(
            F.count_if("recommended").alias("positive"),
            F.count_if(~F.col("recommended")).alias("negative"),
            F.count("review_id").alias("total"),
        )
    )


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def item_results(t: Tables, summary=None) -> None:
    for build in (q._contrast, q._negativity, q._ratings, q._volume, q._performance):
        run(build(t, summary))


def median(action, runs: int = 3) -> float:
    action()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 2)


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    t = Tables(make_session(), folder)
    print("sentiment, fan-out of the fact      ", median(lambda: run(fan_out(t))))
    print("sentiment, aggregate before the join", median(lambda: run(q._sentiment(t))))
    print("five item results, each on its own  ", median(lambda: item_results(t)))
    print(
        "five item results, stored summary   ",
        median(lambda: item_results(t, q._stored_summary(t))),
    )


if __name__ == "__main__":
    main()
