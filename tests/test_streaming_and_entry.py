import importlib
import pathlib
import sys

from ledgerfold.storage import new_path, work_dir
from ledgerfold.streaming.state import daily_windows, upsert_table


def test_batches_take_effect_once(spark):
    path = new_path(spark, "table")
    apply = upsert_table(spark, path)
    rows = lambda *r: spark.createDataFrame(r, "key string, seq int, v string")
    apply(rows(("a", 1, "x"), ("b", 1, "y"), ("a", 3, "z")), 0)
    apply(rows(("a", 2, "late"), ("c", 1, "w")), 1)
    apply(rows(("a", 9, "replayed with other rows")), 1)
    assert {(r["key"], r["v"]) for r in spark.read.parquet(f"{path}/v1").collect()} == {("a", "z"), ("b", "y"), ("c", "w")}


def test_daily_windows(spark):
    df = spark.sql("SELECT timestamp'2026-01-01 23:59:59' AS ts UNION ALL SELECT timestamp'2026-01-02 00:00:00'")
    assert sorted(r["source_date"] for r in daily_windows(df).collect()) == ["2026-01-01", "2026-01-02"]


def test_work_dir_is_the_sessions_own_only_where_unset(spark):
    from types import SimpleNamespace

    import pytest

    def session(master, named=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: named or default), sparkContext=SimpleNamespace(master=master, applicationId="none"))

    assert work_dir(session("spark://host:7077", "hdfs://shared/work/")) == "hdfs://shared/work"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(session("spark://host:7077"))
    assert work_dir(spark)  # whatever the session names, else a folder of its own


def test_core_stands_alone(monkeypatch):
    """Nothing outside the subpackage imports it, and the entry works without it."""
    root = pathlib.Path(__file__).resolve().parents[1]
    for f in (root / "ledgerfold").rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert "ledgerfold.llm" not in f.read_text(), f
    for name in [m for m in sys.modules if m.startswith("ledgerfold.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "ledgerfold.llm", None)
    monkeypatch.syspath_prepend(str(root))
    import __spark_entry__ as entry

    entry = importlib.reload(entry)
    assert entry.llm is None and "p1_found" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())
    monkeypatch.undo()
    importlib.reload(entry)


def test_hot_key_in_several_files(spark):
    """A key with more events than an Arrow batch, shuffled over files of one micro-batch, loses none."""
    import random

    from ledgerfold.streaming.state import current_state

    rng, n = random.Random(3), 25_000
    hot = [(1, i, rng.random() < 0.6, False) for i in range(n)]
    gone = [(2, i, True, i == 900) for i in range(1_000)]
    rows = hot + gone + rng.sample(hot, 500)
    rng.shuffle(rows)
    source, base = new_path(spark, "events"), new_path(spark, "stream")
    spark.createDataFrame(rows, "key bigint, seq bigint, in_scope boolean, deleted boolean").repartition(4).write.parquet(source)
    events = spark.readStream.schema("key bigint, seq bigint, in_scope boolean, deleted boolean").parquet(source)
    out = []
    q = current_state(events).writeStream.outputMode("update").option("checkpointLocation", base).trigger(availableNow=True).foreachBatch(lambda batch, epoch: out.extend(batch.collect())).start()
    q.awaitTermination()
    first = min(i for _, i, s, _ in hot if s)
    assert {tuple(r) for r in out} == {(1, True, hot[-1][2], False, n - 1, n - first), (2, True, False, True, 900, 901)}
