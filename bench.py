"""Benchmark: prints one JSON line with the seconds of each headline query.

The change logs are written to files first, so that the timed part is reading, parsing,
folding and merging, not making the test data.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import envelope
from tidemark.functions.convert import Policy
from tidemark.operators import bootstrap, rejects, replay
from tidemark.operators.typed import typed_events, typed_rows
from tidemark.plans import changelogs as logs
from tidemark.plans import queries
from tidemark.session import local_session, shared_dir
from tidemark.sources import changelog
from tidemark.streaming.lake import ReplicaTable

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
LENIENT = Policy(source_zone=logs.SOURCE_ZONE, unknown_columns="ignore")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def drain(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def stage(spark: SparkSession, root: str, name: str, log: DataFrame) -> DataFrame:
    path = f"{root}/{name}"
    changelog.archive(log.repartition(int(CPUS), "key"), path)
    return changelog.read_files(spark, path)


def seconds_of(run: Callable[[], None]) -> float:
    """Median of the repeats, after one run to warm up."""
    run()
    taken = []
    for _ in range(REPEATS):
        start = time.perf_counter()
        run()
        taken.append(time.perf_counter() - start)
    return round(statistics.median(taken), 3)


def small_merge(spark: SparkSession, root: str, orders: DataFrame) -> tuple[Callable[[], None], ReplicaTable]:
    """One micro-batch that touches one percent of the keys of a replica, and the replica."""
    table = ReplicaTable(f"{root}/merge", logs.ORDERS, queries.POLICY, buckets=32)
    table.replace(replay.changes(orders, logs.ORDERS, queries.POLICY))
    some = orders.filter(F.get_json_object("value", "$.O_OrderKey").cast("bigint") % 100 == 0)
    batch = stage(spark, root, "one_percent", some)
    batches = iter(range(1000))

    def run() -> None:
        table.append(replay.changes(batch, logs.ORDERS, queries.POLICY), next(batches))

    return run, table


def main() -> None:
    spark = local_session(CPUS, partitions=int(CPUS))
    # The staged logs are many small files; with Spark's default cost of opening one, a topic's bytes end in one task.
    spark.conf.set("spark.sql.files.openCostInBytes", "65536")
    root = shared_dir(spark, "bench")
    events = stage(spark, root, "events", logs.user_state_log(spark, SF_DIR))
    orders = stage(spark, root, "orders", logs.orders_log(spark, SF_DIR))
    shop = stage(spark, root, "shop", logs.shop_log(spark, SF_DIR))
    n_events, n_orders = events.count(), orders.count()

    def typed_orders() -> DataFrame:
        return typed_rows(typed_events(envelope.parse(orders), logs.ORDERS, queries.POLICY), logs.ORDERS, queries.POLICY)

    merge_one_percent, merged = small_merge(spark, root, orders)
    runs: dict[str, Callable[[], None]] = {
        "parse_envelope": lambda: drain(envelope.parse(shop)),
        "typed_projection": lambda: drain(typed_orders()),
        "rebuild_user_state": lambda: drain(replay.rebuild(events, logs.USER_STATE, queries.POLICY)),
        "rebuild_orders": lambda: drain(replay.rebuild(orders, logs.ORDERS, queries.POLICY)),
        "rejects": lambda: drain(
            rejects.rejected(replay.parsed(shop, logs.EXCLUDED), logs.CATALOG, queries.POLICY)
        ),
        "merge_one_percent": merge_one_percent,
        # With the deltas of the runs before: what reading costs since a merge only appends.
        "read_merged_replica": lambda: drain(merged.read(spark)),
    }
    runs["snapshot_then_stream"] = lambda: drain(
        replay.advance(
            bootstrap.bootstrap(logs.table(spark, SF_DIR, "orders"), queries.ORDERS_SOURCE, LENIENT),
            orders,
            queries.ORDERS_SOURCE,
            LENIENT,
        )
    )
    runs["bootstrap_snapshot"] = lambda: drain(queries.bootstrap_snapshot(spark, SF_DIR))
    runs["stats_processed"] = lambda: drain(queries.processed_in(shop))
    runs["stats_lag"] = lambda: drain(queries.lag_in(shop))
    taken = {name: seconds_of(run) for name, run in runs.items()}
    per_second = {
        "rebuild_user_state": round(n_events / taken["rebuild_user_state"]),
        "rebuild_orders": round(n_orders / taken["rebuild_orders"]),
    }
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(taken.values()), 3),
                "unit": "sec",
                "queries": taken,
                "events_per_second": per_second,
                "events_per_second_and_core": {name: round(n / int(CPUS)) for name, n in per_second.items()},
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
