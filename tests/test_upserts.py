import random
import time

import pytest
from pyspark.sql import functions as F

from ledgerfold.operators.upserts import apply_change_feed, chain_places
from ledgerfold.storage import new_path

SCHEMA = "feed_seq bigint, logical_record_key string, observation_id string, operation string, source_datestamp string, supersedes_observation_id string, retract struct<target_observation_id:string>, k string"


def by_hand(rows):
    first = {}
    for r in sorted(rows, key=lambda r: r[0]):
        if r[1] is not None and r[2] is not None:
            first.setdefault(r[2], r)
    undone = {r[6][0] for r in first.values() if r[3] == "producer_retract" and r[6]} | {r[6][0] for r in rows if r[3] == "producer_retract" and r[6]}
    days = {}
    for r in first.values():
        if r[3] != "producer_retract":
            days.setdefault((r[1], r[4] or ""), {})[r[2]] = r
    best = {}
    for (k, d), m in days.items():
        for i, r in m.items():
            n, x = 0, r
            while n < len(m) and x[5] in m and x[5] != x[2]:
                x, n = m[x[5]], n + 1
            n = 0 if n >= len(m) else n
            if i not in undone:
                c = (d, n, -r[0], i, r[3] or "")
                best[k] = max(best.get(k, c), c)
    return {k: (c[3], c[4]) for k, c in best.items()}


def feed(seed, n=300):
    rng = random.Random(seed)
    rows, last = [], {}
    for i in range(n):
        k = "hot" if rng.random() < 0.4 else f"k{rng.randint(0, 20)}"
        day = f"2026-01-{rng.randint(1, 6):02d}"
        prev = last.get((k, day)) if rng.random() < 0.8 else rng.choice([None, "", "gone", f"o{i}"])
        op = rng.choice(["upsert"] * 6 + ["scope_exit", "source_delete"])
        rows.append((i, k, f"o{i}", op, day, prev, None, "x"))
        last[k, day] = f"o{i}"
    for j in range(15):
        rows.append((n + j, "hot", f"r{j}", "producer_retract", "2026-01-09", None, (f"o{rng.randint(0, n - 1)}",), "x"))
    rows += [(5000 + r[0], *r[1:]) for r in rng.sample(rows, 60)]
    rows += [(9000, None, "a", "upsert", "2026-01-01", None, None, "x"), (9001, "kn", None, "upsert", "2026-01-01", None, None, "x"), (9002, "kd", "od", "upsert", None, None, None, "x"), (9003, "ko", "oo", None, "2026-01-01", None, None, "x")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "bucket"), [(1, 100_000), (2, 100_000), (3, 4)])
def test_against_a_fold_by_hand(spark, seed, bucket):
    rows = feed(seed)
    got = apply_change_feed(spark.createDataFrame(rows, SCHEMA), bucket_rows=bucket)
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == by_hand(rows)


def test_one_long_chain_in_a_large_day(spark):
    """The last of a chain wins in a day that is ranked apart, though it arrived last; this draw of ids has a lone longest walk."""
    rng, n = random.Random(1), 3000
    ids = [f"{rng.getrandbits(64):016x}" for _ in range(n)]
    rows = [(i, "hot", ids[i], "upsert", "2026-01-01", ids[i - 1] if i else None, None, "x") for i in range(n)]
    rng.shuffle(rows)
    got = apply_change_feed(spark.createDataFrame(rows, SCHEMA), bucket_rows=500).collect()
    assert [(r[0], r[1]) for r in got] == [("hot", ids[-1])]


def test_one_long_chain_within_a_bucket(spark):
    """90,000 chained changes of one key and day in a bucket; the last of the chain arrived first."""
    n = 90_000
    one = spark.range(n).select(
        (F.lit(n) - F.col("id")).alias("feed_seq"), F.lit("hot").alias("logical_record_key"), F.concat(F.lit("o"), F.col("id")).alias("observation_id"), F.lit("upsert").alias("operation"), F.lit("2026-01-01").alias("source_datestamp"),
        F.when(F.col("id") > 0, F.concat(F.lit("o"), F.col("id") - 1)).alias("supersedes_observation_id"), F.lit(None).cast("struct<target_observation_id:string>").alias("retract"),
    )
    began = time.time()
    assert [(r[0], r[1]) for r in apply_change_feed(one).collect()] == [("hot", f"o{n - 1}")]
    assert time.time() - began < 60


def test_empty_feed_and_publishing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert apply_change_feed(empty).count() == 0
    path = new_path(spark, "published")
    one = spark.createDataFrame([(1, "k", "o", "upsert", "2026-01-01", None, None, "x")], SCHEMA)
    assert apply_change_feed(one, publish_to=path).count() == 1
    with pytest.raises(FileExistsError):
        apply_change_feed(one, publish_to=path)
    assert spark.read.parquet(path).count() == 1


def test_places(spark):
    rows = [("a", "k", "d", None), ("b", "k", "d", "a"), ("c", "k", "d", "b"), ("e", "k", "d2", "c"), ("x", "k", "d", "y"), ("y", "k", "d", "x")]
    got = {r[0]: r[1] for r in chain_places(spark.createDataFrame(rows, "id string, k string, day string, parent string"), "k", "id", "day", "parent").collect()}
    assert (got["a"], got["b"], got["c"], got["e"]) == (0, 1, 2, 0)
