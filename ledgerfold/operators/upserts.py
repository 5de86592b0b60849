"""Applying a feed of inserts, updates and deletes in the right order, however it arrived.

Method: the feed is split into buckets and every bucket is folded by an embedded DuckDB through
conditional upserts: ``ON CONFLICT (key) DO UPDATE ... WHERE excluded.sequence > stored.sequence``.
Deletes stay as tombstones, so a late older insert cannot revive a key.  Buckets export their rows,
a second round of upserts joins them by key, and the result is published in one rename.

Skew: the first buckets are cut by key *and day* and keep one row per key, so a key which holds a
third of the feed is spread over all of its days, and at most one row per bucket is left of it for
the second round.  A single day of a single key that is larger than ``BUCKET_ROWS`` is found by
counting and ranked by the distributed chain operator instead of inside a bucket.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.packing_ids import pack_id, unpack_id
from ledgerfold.operators.hierarchy import LOST, resolve_forest, solve_arrays
from ledgerfold.storage import new_path, publish, write_table

#: Rows aimed at in a bucket; its state is held in memory (about 250 bytes a row).
BUCKET_ROWS = 100_000
#: The counting pass that finds days too large for a bucket: cells at least, and rows aimed at in one.
COUNT_CELLS, CELL_ROWS = 65_536, 10_000

_CHANGE = "k binary, day string, id binary, parent binary, op string, seq bigint, undone boolean, pos bigint"
_STATE = "k binary, day string, pos bigint, seq bigint, id binary, op string"
_STATE_ARROW = pa.schema([("k", pa.binary()), ("day", pa.string()), ("pos", pa.int64()), ("seq", pa.int64()), ("id", pa.binary()), ("op", pa.string())])


def _connect():
    import duckdb

    con = duckdb.connect(":memory:")
    con.execute("SET threads = 1; SET memory_limit = '600MB'; SET temp_directory = ''; SET preserve_insertion_order = false")
    return con


def _tables(batches: Iterable[pa.RecordBatch], rows: int = 50_000) -> Iterator[pa.Table]:
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


_UPSERT = """
INSERT INTO state BY NAME
SELECT k, s.day AS day, s.pos AS pos, s.seq AS seq, s.id AS id, s.op AS op
FROM (SELECT k, max({'day': day, 'pos': pos, 'seq': seq, 'id': id, 'op': op}) AS s FROM %s GROUP BY k)
ON CONFLICT (k) DO UPDATE SET day = excluded.day, pos = excluded.pos, seq = excluded.seq, id = excluded.id, op = excluded.op
WHERE (excluded.day, excluded.pos, excluded.seq, excluded.id) > (state.day, state.pos, state.seq, state.id)
"""
_STATE_DDL = "CREATE TABLE state (k BLOB PRIMARY KEY, day VARCHAR, pos BIGINT, seq BIGINT, id BLOB, op VARCHAR)"


def _export(con) -> Iterator[pa.RecordBatch]:
    out = con.sql("SELECT k, day, pos, seq, id, op FROM state").to_arrow_table().cast(_STATE_ARROW)
    yield from out.to_batches(max_chunksize=20_000)


# The place in a day is the length of the chain of superseded changes of that key and day, undone ones
# included, so that a change still follows what its undone predecessor followed. In a cycle it is 0.
_BUSY = """
CREATE TABLE busy AS SELECT id, k, day, parent, row_number() OVER () - 1 AS n FROM change WHERE pos IS NULL QUALIFY count(*) OVER (PARTITION BY k, day) > 1;
CREATE TABLE link AS SELECT c.n, coalesce(p.n, -2) AS up FROM busy c LEFT JOIN busy p ON c.parent = p.id AND c.k = p.k AND c.day = p.day AND c.id <> p.id
"""


def _set_places(con) -> None:
    """Places of a bucket's changes, chains being followed by pointer doubling: a long one costs its logarithm."""
    con.execute(_BUSY)
    t = con.sql("SELECT n, up FROM link").fetchnumpy()
    if len(t["n"]):
        n, up = (np.asarray(t[c], np.int64) for c in ("n", "up"))
        own, root, steps, _ = solve_arrays(n, up, np.ones(len(n), np.int64), np.zeros(len(n), np.int64))
        con.register("ranked", pa.table({"n": own, "steps": np.where(root == LOST, 0, steps)}))
        con.execute("UPDATE change SET pos = r.steps FROM (SELECT b.id, r.steps FROM ranked r JOIN busy b USING (n)) r WHERE change.id = r.id")
        con.unregister("ranked")
    con.execute("UPDATE change SET pos = 0 WHERE pos IS NULL")


def _fold_days(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket of whole key-days: repeated deliveries, the order within a day, the last change of each key."""
    con = _connect()
    con.execute("CREATE TABLE change (id BLOB PRIMARY KEY, k BLOB, day VARCHAR, parent BLOB, op VARCHAR, seq BIGINT, undone BOOLEAN, pos BIGINT)")
    con.execute(_STATE_DDL)
    for part in _tables(batches):
        con.register("part", part)
        con.execute("""
            INSERT INTO change BY NAME SELECT DISTINCT ON (id) id, k, day, parent, op, seq, undone, pos FROM part ORDER BY id, seq
            ON CONFLICT (id) DO UPDATE SET k = excluded.k, day = excluded.day, parent = excluded.parent, op = excluded.op, seq = excluded.seq
            WHERE excluded.seq < change.seq""")
        con.unregister("part")
    _set_places(con)
    con.execute("CREATE TABLE live AS SELECT k, day, pos, -seq AS seq, id, op FROM change WHERE NOT undone")
    con.execute(_UPSERT % "live")
    yield from _export(con)
    con.close()


def _fold_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    con = _connect()
    con.execute(_STATE_DDL)
    for part in _tables(batches):
        con.register("part", part)
        con.execute(_UPSERT % "part")
        con.unregister("part")
    yield from _export(con)
    con.close()


def _place_days(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    con = _connect()
    con.execute("CREATE TABLE change (id VARCHAR PRIMARY KEY, k VARCHAR, day VARCHAR, parent VARCHAR, pos BIGINT)")
    for part in _tables(batches):
        con.register("part", part)
        con.execute("INSERT INTO change BY NAME SELECT DISTINCT ON (id) id, k, day, parent, NULL AS pos FROM part ORDER BY id, parent ON CONFLICT DO NOTHING")
        con.unregister("part")
    _set_places(con)
    yield from con.sql("SELECT id, pos FROM change").to_arrow_table().cast(pa.schema([("id", pa.string()), ("pos", pa.int64())])).to_batches(max_chunksize=20_000)
    con.close()


def chain_places(changes: DataFrame, key: str, change_id: str, day: str, supersedes: str) -> DataFrame:
    """``change_id, place``: how many changes of its key and day a change follows, one after another.

    Buckets hold whole key-days, as in :func:`apply_change_feed`; ids are distinct, null ones ignored.
    """
    thin = changes.select(F.col(key).alias("k"), F.col(day).alias("day"), F.col(change_id).alias("id"), F.col(supersedes).alias("parent")).filter("id is not null")
    return thin.repartition("k", "day").mapInArrow(_place_days, "id string, pos bigint").select(F.col("id").alias(change_id), F.col("pos").alias("place"))


def _ranked_apart(changes: DataFrame) -> DataFrame:
    """Places within days that are too large for a bucket, by the distributed chain operator."""
    first = changes.groupBy("id").agg(F.min_by(F.struct("k", "day", "parent", "op", "seq", "undone"), F.struct("seq", "parent")).alias("c")).select("id", "c.*")
    nodes, _ = write_table(first.withColumn("nid", F.monotonically_increasing_id()), "days")
    up = nodes.select(F.col("id").alias("p_id"), F.col("k").alias("p_k"), F.col("day").alias("p_day"), F.col("nid").alias("pnid"))
    same = (F.col("parent") == F.col("p_id")) & (F.col("k") == F.col("p_k")) & (F.col("day") == F.col("p_day")) & (F.col("nid") != F.col("pnid"))
    edges, _ = write_table(nodes.join(up, same, "left").select("nid", "pnid", F.lit(1).cast("bigint").alias("gap"), F.lit(1).cast("bigint").alias("weight")), "edges")
    place = resolve_forest(edges).select("nid", F.coalesce("depth", F.lit(0)).alias("pos"))
    return nodes.join(place, "nid").select("k", "day", "id", "parent", "op", "seq", "undone", "pos")


def apply_change_feed(
    feed: DataFrame,
    key: str = "logical_record_key",
    change_id: str = "observation_id",
    operation: str = "operation",
    day: str = "source_datestamp",
    supersedes: str = "supersedes_observation_id",
    arrival: str = "feed_seq",
    undo_operation: str = "producer_retract",
    undo_target: str = "retract.target_observation_id",
    bucket_rows: int = BUCKET_ROWS,
    publish_to: str | None = None,
) -> DataFrame:
    """``key, change_id, operation, day``: the last valid change of every key, tombstones included.

    A change counts once, as first delivered, however often it came.  An undo is no change; its target
    counts as never made.  Changes of a key are ordered by day; within a day each follows the one it
    supersedes (the longest chain wins where pointers are damaged, then the change that arrived
    first).  Rows without key or change id are no changes; a null day sorts before all others.
    """
    spark = feed.sparkSession
    undone = (
        feed.filter(F.col(operation) == undo_operation).select(pack_id(F.col(undo_target)).alias("u_id"))
        .filter("u_id is not null").distinct().withColumn("hit", F.lit(True))
    )
    changes = feed.filter(F.col(key).isNotNull() & F.col(change_id).isNotNull() & ~F.coalesce(F.col(operation) == undo_operation, F.lit(False)))
    # days of keys that are too large for a bucket: counted in cells of about CELL_ROWS rows, so a cell
    # beyond bucket_rows holds such a day; only those cells are kept
    rows = feed.count()
    cell = F.pmod(F.xxhash64(key, day), F.lit(max(COUNT_CELLS, rows // CELL_ROWS)))
    large, _ = write_table(changes.groupBy(cell.alias("ledgerfold_large_cell")).count().filter(F.col("count") > bucket_rows).select("ledgerfold_large_cell", F.lit(True).alias("ledgerfold_large")), "large")
    apart = not large.isEmpty()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // bucket_rows))
    if apart:
        changes = changes.withColumn("ledgerfold_cell", cell).join(large, F.col("ledgerfold_cell") == F.col("ledgerfold_large_cell"), "left")
    changes = (
        changes.withColumn("ledgerfold_large", F.coalesce("ledgerfold_large", F.lit(False)) if apart else F.lit(False))
        .select(
            pack_id(F.col(key)).alias("k"), F.coalesce(F.col(day).cast("string"), F.lit("")).alias("day"), pack_id(F.col(change_id)).alias("id"), pack_id(F.col(supersedes)).alias("parent"),
            F.coalesce(F.col(operation), F.lit("")).alias("op"), F.coalesce(F.col(arrival).cast("bigint"), F.lit(0)).alias("seq"), F.col("ledgerfold_large").alias("large"),
        )
        .join(undone, F.col("id") == F.col("u_id"), "left")
        .withColumn("undone", F.coalesce("hit", F.lit(False)))
        .drop("u_id", "hit")
    )
    plain = changes.filter("not large").select("k", "day", "id", "parent", "op", "seq", "undone", F.lit(None).cast("bigint").alias("pos"))
    states = plain.repartition(buckets, "k", "day").mapInArrow(_fold_days, _STATE)
    if apart:
        ranked = _ranked_apart(changes.filter("large")).filter("not undone")
        last = ranked.groupBy("k").agg(F.max(F.struct("day", "pos", (-F.col("seq")).alias("seq"), "id", "op")).alias("s"))
        states = states.unionByName(last.select("k", "s.*"))
    final = states.repartition(buckets, "k").mapInArrow(_fold_keys, _STATE)
    out = final.select(unpack_id(F.col("k")).alias(key), unpack_id(F.col("id")).alias(change_id), F.col("op").alias(operation), F.col("day").alias(day))
    return publish(out, publish_to or new_path(spark, "state"))
