"""Parent-child links of unknown depth: root, depth, number of descendants and exact paths.

Method: a hash of the node chooses splitters; every node walks to its next splitter (by doubling,
so in as many rounds as the logarithm of the longest gap); the reduced graph of splitters is solved
in the same way until it fits one task; then the walked paths are expanded.  Nodes that never meet a
splitter or a root lie on, or lead into, a cycle without splitters and are settled apart.

Only 64-bit numbers travel in the rounds, and no side is broadcast: the tables compress so well that
the size of their files says nothing about their size in memory.  A node with very many children and a chain that holds a
third of the rows both work: walking is a join on the pointer, whose skew AQE splits, and counting
is a sum with partial aggregation.  Nothing is gathered but a reduced graph of at most
``LOCAL_NODES`` rows, in one executor task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.packing_ids import pack_id, unpack_id
from ledgerfold.storage import write_table

#: One node in so many is a splitter; walks are about this long.
SPLITTER_RATE = 8
#: Largest reduced graph that one task solves (about 100 bytes a node while it does).
LOCAL_NODES = 500_000
#: Parent of a node whose walk ends in a cycle.
LOST = -1

_SOLVED = pa.schema([("nid", pa.int64()), ("root", pa.int64()), ("depth", pa.int64()), ("total", pa.int64())])


def _is_splitter(nid: Column, rate: int, level: int) -> Column:
    return F.pmod(F.xxhash64(nid, F.lit(level)), F.lit(rate)) == 0


def solve_arrays(nid: np.ndarray, pnid: np.ndarray, gap: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Root, depth and subtree weight by pointer doubling; root is LOST for nodes that reach none."""
    n = len(nid)
    order = np.argsort(nid)
    ids, parent = nid[order], pnid[order]
    at = np.searchsorted(ids, parent)
    at[at == n] = 0
    known = (parent >= 0) & (ids[at] == parent)
    own = np.arange(n)
    up = np.append(np.where(known, at, n), n)  # place n stands above all tops
    top = np.where(known, at, own)  # highest node met so far; a top meets itself
    dist = np.where(known, gap[order], 0).astype(np.int64)
    total = weight[order].astype(np.int64)
    for _ in range(n.bit_length() + 1):
        # sums in floats are exact below 2**53
        total = total + np.bincount(up[:n], weights=total, minlength=n + 1)[:n].astype(np.int64)
        dist = dist + dist[top]
        top, up = top[top], up[up]
    reached = (up[:n] == n) & (parent[top] != LOST)
    return ids, np.where(reached, ids[top], LOST), dist, total


def _solve_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    t = pa.Table.from_batches(rows)
    col = lambda c, null: t[c].fill_null(null).to_numpy()
    out = solve_arrays(col("nid", 0), col("pnid", -2), col("gap", 0), col("weight", 0))
    yield from pa.table(list(out), schema=_SOLVED).to_batches(max_chunksize=50_000)


def resolve_forest(
    nodes: DataFrame, rate: int = SPLITTER_RATE, local_nodes: int = LOCAL_NODES, level: int = 0, paths: bool = False
) -> DataFrame:
    """``nid, pnid, gap, weight`` (BIGINT >= 0; pnid null for a root, LOST for a dead end) to
    ``nid, root, depth, total`` (root null where none is reached) and, if asked, ``path``.

    ``depth`` sums the gaps to the root, ``total`` the weights of the node and all below it.  ``path``
    lists the ancestors up to the next splitter or root: ancestors of the last are its own path.

    Only splitters that are no roots go to the reduced graph, so it shrinks by the rate at each level
    even if all nodes are roots; a splitter whose walk ends in a root is a root there.
    """
    roots = nodes.filter("pnid is null").select("nid", "weight")
    walkers = nodes.filter("pnid is not null").select(
        "nid", "gap", "weight", F.col("pnid").alias("end"), F.when(F.col("pnid") >= 0, F.array("pnid")).otherwise(F.array().cast("array<bigint>")).alias("walk"),
        (F.col("pnid") == LOST).alias("stopped"), F.lit(False).alias("at_root"),
    )
    active, _ = write_table(walkers, "walk")
    settled = active.filter("stopped")
    active = active.filter("not stopped")
    tops = roots.select(F.col("nid").alias("t_nid"), F.lit(True).alias("t_root"), F.lit(0).cast("bigint").alias("t_gap"), F.lit(LOST).cast("bigint").alias("t_end"), F.array().cast("array<bigint>").alias("t_walk"), F.lit(True).alias("t_stopped"), F.lit(True).alias("t_at_root"))
    t_split = _is_splitter(F.col("t_nid"), rate, level)
    # after r rounds those at 2^r steps or more from their stop are active, and the way of each leads over
    # one at just 2^r, which stops next: a round that stops none leaves only what circles
    left, before = active.count(), None
    while left and left != before:
        others = settled.unionByName(active).select(F.col("nid").alias("t_nid"), F.lit(False).alias("t_root"), *[F.col(c).alias(f"t_{c}") for c in ("gap", "end", "walk", "stopped", "at_root")])
        target = others.unionByName(tops)
        here = F.col("t_root") | t_split  # the walk ends at the target, else it goes on as the target's does
        moved = active.join(target.hint("merge"), F.col("end") == F.col("t_nid")).select(
            "nid", F.when(here, F.col("gap")).otherwise(F.col("gap") + F.col("t_gap")).alias("gap"), "weight", F.when(here, F.col("end")).otherwise(F.col("t_end")).alias("end"),
            F.when(here, F.col("walk")).otherwise(F.concat("walk", "t_walk")).alias("walk"), (here | F.col("t_stopped")).alias("stopped"), F.when(here, F.col("t_root")).otherwise(F.col("t_at_root")).alias("at_root"),
        )
        moved, _ = write_table(moved, "walk")
        settled, active = settled.unionByName(moved.filter("stopped")), moved.filter("not stopped")
        left, before = active.count(), left
    state = settled.unionByName(active)

    # what is left now can only circle among itself: cycles without a splitter, and what leads into them
    splits = _is_splitter(F.col("nid"), rate, level)
    block = state.filter("stopped and not at_root").filter(~splits).groupBy("end").agg(F.sum("weight").alias("block"))
    parent = F.when(~F.col("s.stopped"), F.lit(LOST)).when(~F.col("s.at_root"), F.col("s.end")).cast("bigint")
    reduced = (
        state.filter(splits).alias("s").join(block.alias("b").hint("merge"), F.col("s.nid") == F.col("b.end"), "left")
        .select(F.col("s.nid"), parent.alias("pnid"), F.col("s.gap"), (F.col("s.weight") + F.coalesce(F.col("b.block"), F.lit(0))).alias("weight"), F.when(F.col("s.at_root"), F.col("s.end")).alias("anchor"))
    )
    reduced, _ = write_table(reduced, "reduced")
    if reduced.count() <= local_nodes:
        part = reduced.select("nid", "pnid", "gap", "weight").coalesce(1).mapInArrow(_solve_in_task, "nid bigint, root bigint, depth bigint, total bigint").withColumn("root", F.nullif(F.col("root"), F.lit(LOST)))
    else:
        part = resolve_forest(reduced.select("nid", "pnid", "gap", "weight"), rate, local_nodes, level + 1)
    # a root of the reduced graph hangs on its anchor
    anchors = reduced.filter("anchor is not null").select(F.col("nid").alias("a_nid"), "anchor", F.col("gap").alias("a_gap"))
    solved = part.join(anchors.hint("merge"), F.col("root") == F.col("a_nid"), "left").select("nid", F.col("anchor").alias("root"), (F.col("depth") + F.col("a_gap")).alias("depth"), "total")
    solved, _ = write_table(solved, "solved")

    # sums below a node inside its block: each node, and each splitter with all below it, counts for the walk above it
    s = solved.select(F.col("nid").alias("s_nid"), F.col("root").alias("s_root"), F.col("depth").alias("s_depth"), F.col("total").alias("s_total")).hint("merge")
    passed = F.when(F.col("at_root"), F.col("walk")).otherwise(F.expr("slice(walk, 1, greatest(size(walk) - 1, 0))"))
    below = (
        state.filter("stopped").join(s.select("s_nid", "s_total"), F.col("nid") == F.col("s_nid"), "left")
        .select(F.coalesce("s_total", "weight").alias("w"), F.explode(passed).alias("above")).groupBy("above").agg(F.sum("w").alias("below"))
    )
    below, _ = write_table(below, "below")
    total = (F.col("weight") + F.coalesce("below", F.lit(0))).alias("total")
    inner = (
        state.filter(~splits).join(below.hint("merge"), F.col("nid") == F.col("above"), "left")
        .join(s, F.when(F.col("stopped") & ~F.col("at_root"), F.col("end")) == F.col("s_nid"), "left")
        .select("nid", F.when(F.col("at_root"), F.col("end")).otherwise(F.col("s_root")).alias("root"), F.when(F.col("at_root"), F.col("gap")).otherwise(F.col("s_depth") + F.col("gap")).alias("depth"), total, "walk")
    )
    top = roots.join(below.hint("merge"), F.col("nid") == F.col("above"), "left").select("nid", F.col("nid").alias("root"), F.lit(0).cast("bigint").alias("depth"), total, F.array().cast("array<bigint>").alias("walk"))
    if not paths:
        return inner.drop("walk").unionByName(top.drop("walk")).unionByName(solved)
    split_rows = state.filter(splits).join(s, F.col("nid") == F.col("s_nid")).select("nid", F.col("s_root").alias("root"), F.col("s_depth").alias("depth"), F.col("s_total").alias("total"), "walk")
    return inner.unionByName(top).unionByName(split_rows).withColumnRenamed("walk", "path")


def _numbered(links: DataFrame) -> DataFrame:
    """``id, parent`` (packed) to a written table with a 64-bit number for each id."""
    return write_table(links.withColumn("nid", F.monotonically_increasing_id()), "nodes")[0]


def expand_hierarchy(df: DataFrame, id_col: str = "observation_id", parent_col: str = "supersedes_observation_id", order_col: str | None = None, **options) -> DataFrame:
    """``id, root_id, depth, n_descendants`` for each distinct id.

    A node whose parent is null, blank or no id of the table is a root.  A node that never reaches a
    root has root '' and -1, -1.  Rows without an id are no nodes.  Where an id has several parents,
    the first by ``order_col`` counts (the least parent without it).
    """
    first = F.min_by("parent", "ord") if order_col else F.min("parent")
    links = (
        df.select(F.col(id_col).cast("string").alias("id"), F.when(F.trim(F.col(parent_col)) != "", F.col(parent_col)).cast("string").alias("parent"), (F.col(order_col) if order_col else F.lit(0)).alias("ord"))
        .filter(F.col("id").isNotNull())
        .select(pack_id(F.col("id")).alias("id"), pack_id(F.col("parent")).alias("parent"), "ord")
        .groupBy("id").agg(first.alias("parent"))
    )
    nodes = _numbered(links)
    above = nodes.select(F.col("id").alias("p_id"), F.col("nid").alias("pnid"))
    edges = nodes.join(above.hint("merge"), F.col("parent") == F.col("p_id"), "left").select("nid", "pnid", F.lit(1).cast("bigint").alias("gap"), F.lit(1).cast("bigint").alias("weight"))
    edges, _ = write_table(edges, "edges")
    solved = resolve_forest(edges, **options)
    roots = edges.filter(F.col("pnid").isNull()).select("nid").join(nodes.select("nid", "id").hint("merge"), "nid").select(F.col("nid").alias("root"), F.col("id").alias("root_id"))
    return (
        solved.join(roots.hint("merge"), "root", "left").join(nodes.select("nid", "id").hint("merge"), "nid")
        .select(
            unpack_id(F.col("id")).alias("id"), F.coalesce(unpack_id(F.col("root_id")), F.lit("")).alias("root_id"),
            F.when(F.col("root").isNotNull(), F.col("depth")).otherwise(-1).cast("int").alias("depth"),
            F.when(F.col("root").isNotNull(), F.col("total") - 1).otherwise(-1).cast("int").alias("n_descendants"),
        )
    )


def full_paths(df: DataFrame, id_col: str, parent_col: str, **options) -> DataFrame:
    """``id, path``: every id from the root down to the node, for nodes that reach a root.

    The result is as long as the sum of all depths, so it is meant for trees and not for long chains.
    """
    links = (
        df.select(F.col(id_col).cast("string").alias("id"), F.when(F.trim(F.col(parent_col)) != "", F.col(parent_col)).cast("string").alias("parent"))
        .filter(F.col("id").isNotNull())
        .select(pack_id(F.col("id")).alias("id"), pack_id(F.col("parent")).alias("parent"))
        .groupBy("id").agg(F.min("parent").alias("parent"))
    )
    nodes = _numbered(links)
    above = nodes.select(F.col("id").alias("p_id"), F.col("nid").alias("pnid"))
    edges, _ = write_table(nodes.join(above.hint("merge"), F.col("parent") == F.col("p_id"), "left").select("nid", "pnid", F.lit(1).cast("bigint").alias("gap"), F.lit(1).cast("bigint").alias("weight")), "edges")
    walked, _ = write_table(resolve_forest(edges, paths=True, **options).filter("root is not null"), "walked")
    piece = walked.select(F.col("nid").alias("h_nid"), F.col("path").alias("h_path"))
    done, open_ = None, walked.select("nid", "depth", "path")
    while True:
        part = open_.filter(F.size("path") == F.col("depth"))
        done = part if done is None else done.unionByName(part)
        rest = open_.filter(F.size("path") < F.col("depth")).join(piece, F.element_at("path", -1) == F.col("h_nid")).select("nid", "depth", F.concat("path", "h_path").alias("path"))
        open_, _ = write_table(rest, "paths")
        if open_.isEmpty():
            break
    ids = nodes.select(F.col("nid").alias("a_nid"), F.col("id").alias("a_id"))
    steps = done.select("nid", F.posexplode(F.concat(F.array("nid"), "path")).alias("pos", "a_nid")).join(ids, "a_nid")
    return (
        steps.groupBy("nid").agg(F.reverse(F.transform(F.array_sort(F.collect_list(F.struct("pos", "a_id"))), lambda x: unpack_id(x["a_id"]))).alias("path"))
        .select(F.element_at("path", -1).alias("id"), "path")
    )
