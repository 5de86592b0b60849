import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerfold.operators.hierarchy import LOST, expand_hierarchy, full_paths, resolve_forest, solve_arrays


def by_hand(parent):
    """id -> (root or '', depth, descendants)."""
    up = {k: (p if p and p.strip() and p in parent else None) for k, p in parent.items()}
    out, below = {}, {k: 0 for k in up}
    for k in up:
        seen, x = [], k
        while x is not None and x not in seen:
            seen.append(x)
            x = up[x]
        out[k] = (seen[-1], len(seen) - 1) if x is None else ("", -1)
        if x is None:
            for a in seen[1:]:
                below[a] += 1
    return {k: (r, d, below[k] if r else -1) for k, (r, d) in out.items()}


@given(st.lists(st.integers(-1, 29), min_size=1, max_size=30))
@settings(max_examples=200, deadline=None)
def test_solve_arrays(parents):
    n = len(parents)
    parents = [p if p < n else -1 for p in parents]
    ids = np.arange(n, dtype=np.int64)
    found, root, depth, total = solve_arrays(ids, np.array([p if p >= 0 else -2 for p in parents], np.int64), np.ones(n, np.int64), np.ones(n, np.int64))
    want = by_hand({str(i): (str(p) if p >= 0 else None) for i, p in enumerate(parents)})
    for i in range(n):
        r, d, b = want[str(found[i])]
        if r:
            assert (str(root[i]), depth[i], total[i] - 1) == (r, d, b)
        else:
            assert root[i] == LOST


def rows_of(df):
    return {r["id"]: (r["root_id"], r["depth"], r["n_descendants"]) for r in df.collect()}


def test_random_forest_with_damage(spark):
    rng = random.Random(5)
    ids = [f"sha256:{i:064x}" for i in range(400)] + [f"n{i}" for i in range(20)]
    parent = {}
    for i, x in enumerate(ids):
        k = rng.random()
        parent[x] = None if k < 0.05 else "" if k < 0.07 else " " if k < 0.08 else "gone" if k < 0.1 else x if k < 0.12 else rng.choice(ids) if k < 0.2 else ids[max(0, i - rng.randint(1, 3))]
    rows = [(x, p, 1) for x, p in parent.items()] + [(ids[3], parent[ids[3]], 2), (None, ids[0], 1)]
    df = spark.createDataFrame(rows, "id string, parent string, depth int")  # depth: a name of the result
    assert rows_of(expand_hierarchy(df, "id", "parent")) == by_hand(parent)
    assert rows_of(expand_hierarchy(df, "id", "parent", local_nodes=20, rate=4)) == by_hand(parent)


def test_long_chain_and_star(spark):
    chain = {f"c{i}": f"c{i - 1}" if i else None for i in range(600)}
    star = {"hub": None} | {f"s{i}": "hub" for i in range(500)}
    circle = {f"o{i}": f"o{(i + 1) % 40}" for i in range(40)} | {"tail": "o3"}
    parent = chain | star | circle
    df = spark.createDataFrame(list(parent.items()), "id string, parent string")
    assert rows_of(expand_hierarchy(df, "id", "parent")) == by_hand(parent)


@pytest.mark.parametrize(("n", "first"), [(1_000, 0), (1_000, 7_000_000), (5_000, 1 << 33), (100_000, 1 << 40)])
def test_one_chain_without_damage(spark, n, first):
    """The longest walk is a lone one, whatever ids are drawn; a circle beside it stays lost."""
    nid = F.col("id") + first
    chain = spark.range(n).select(nid.alias("nid"), F.when(F.col("id") > 0, nid - 1).alias("pnid"))
    circle = spark.range(9).select((nid + n).alias("nid"), (first + n + (F.col("id") + 1) % 9).alias("pnid"))
    one = F.lit(1).cast("bigint")
    out = resolve_forest(chain.unionByName(circle).withColumns({"gap": one, "weight": one})).toPandas().sort_values("nid")
    line, round_ = out[:n], out[n:]
    assert len(out) == n + 9 and (line["root"] == first).all()
    assert (line["depth"].to_numpy() == np.arange(n)).all() and (line["total"].to_numpy() == n - np.arange(n)).all()
    assert round_["root"].isna().all()


def test_many_small_circles(spark):
    """100,000 circles of two beside a tree: walks that meet no splitter don't grow on and on."""
    n = 100_000
    began = time.time()
    text = lambda c: c.cast("string")
    circles = spark.range(2 * n).select(text(F.col("id")).alias("id"), text(F.col("id").bitwiseXOR(F.lit(1))).alias("parent"))
    tree = spark.range(1000).select(F.concat(F.lit("t"), "id").alias("id"), F.when(F.col("id") > 0, F.concat(F.lit("t"), text(F.floor((F.col("id") - 1) / 2)))).alias("parent"))
    out = expand_hierarchy(circles.unionByName(tree), "id", "parent").groupBy("root_id").agg(F.count("*").alias("n"), F.max("depth").alias("d"), F.max("n_descendants").alias("b")).collect()
    assert {tuple(r) for r in out} == {("", 2 * n, -1, -1), ("t0", 1000, 9, 999)}
    assert time.time() - began < 120


def test_empty_and_paths(spark):
    empty = spark.createDataFrame([], "id string, parent string")
    assert expand_hierarchy(empty, "id", "parent").count() == 0
    parent = {f"n{i}": f"n{(i - 1) // 2}" if i else None for i in range(60)} | {"x": "y", "y": "x"}
    got = {r["id"]: r["path"] for r in full_paths(spark.createDataFrame(list(parent.items()), "id string, parent string"), "id", "parent").collect()}
    for k in parent:
        if k in "xy":
            assert k not in got
            continue
        path, x = [], k
        while x:
            path.append(x)
            x = parent[x]
        assert got[k] == path[::-1]
