import contextlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import frames

#: As the check tool holds it, so that no step gets few tasks because Spark joins small partitions.
HELD = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}


def labels_of(links):
    """By plain search: the smallest node reachable, of every node with a link."""
    near = {}
    for a, b in links:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    label = {}
    for node in sorted(near):
        todo = [node]
        while todo:
            if (x := todo.pop()) not in label:
                label[x] = node
                todo += near[x]
    return label


def some_links():
    pick = random.Random(5)
    links = [(pick.randrange(-(2**62), 2**62), 0) for _ in range(20)]
    links += [(1000 + i, 1001 + i) for i in range(150)]  # a path
    links += [(pick.randrange(2000, 2300), pick.randrange(2000, 2300)) for _ in range(200)]
    links += [(7, 7), (8, 8), (3000, 3001), (3001, 3000), (3000, 3001)]
    pick.shuffle(links)
    return links


@contextlib.contextmanager
def held(spark, group):
    """With many partitions held; gives a function that counts the group's jobs and tasks so far."""
    before = {k: spark.conf.get(k) for k in HELD}
    for k, v in HELD.items():
        spark.conf.set(k, v)
    spark.sparkContext.setJobGroup(group, group)
    tracker = spark.sparkContext.statusTracker()

    def so_far():
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
        stages = {s for job in jobs for s in job.stageIds}
        return len(jobs), sum(info.numTasks for s in stages if (info := tracker.getStageInfo(s)))

    try:
        yield so_far
    finally:
        spark.sparkContext.setJobGroup("others", "others")
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("at_once", [frames.LINKS_PER_TASK, 360, 50])
def test_components_in_one_task_and_by_rounds(spark, monkeypatch, at_once):
    """All at once; by rounds until few links are left; by rounds to the end."""
    links = some_links()
    monkeypatch.setattr(frames, "LINKS_PER_TASK", at_once)
    frame = spark.createDataFrame(links, "a long, b long").repartition(6)
    rows = frames.components(frame).collect()
    assert len(rows) == len({r.node for r in rows})
    assert {r.node: r.label for r in rows} == labels_of(links)
    assert frames.components(frame.limit(0)).count() == 0


def test_few_links_are_few_tasks(spark):
    """Labels of 375 links used to take rounds over all shuffle partitions."""
    links = frames.kept(spark.createDataFrame(some_links(), "a long, b long").repartition(4))
    with held(spark, "components") as so_far:
        frames.kept(frames.components(links))
        jobs, tasks = so_far()
    assert jobs <= 4 and tasks <= 20


@pytest.mark.parametrize("per_task", [frames.PARTS_PER_TASK, 1])
def test_a_small_bitmap_is_gathered_by_few_jobs(spark, monkeypatch, per_task):
    """It used to take a job for each shuffle partition."""
    monkeypatch.setattr(frames, "PARTS_PER_TASK", per_task)
    values = frames.kept(spark.range(20_000).select(F.xxhash64("id").alias("h")))
    with held(spark, f"bitmap-{per_task}") as so_far:
        found = frames.bitmap(values, "h")
        jobs, _ = so_far()
    assert found.bits == 19 and jobs <= 16 // per_task + 4
    inside = values.toPandas()["h"].to_numpy()
    others = spark.range(20_000, 40_000).select(F.xxhash64("id").alias("h")).toPandas()["h"].to_numpy()
    assert found.has(inside).all() and found.has(others).mean() < 0.05
