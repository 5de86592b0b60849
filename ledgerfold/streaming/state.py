"""The state of records as a stream: one keyed state, changed by each batch of events.

``current_state`` keeps membership and head in RocksDB through ``transformWithStateInPandas``;
``upsert_table`` is the same for a table, with a batch written once however often it is replayed.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ledgerfold.storage import _fs

_OUT = "key bigint, ever_in_scope boolean, active_in_scope boolean, source_deleted boolean, head_seq bigint, n_changes bigint"


class MembershipProcessor(StatefulProcessor):
    """Events of a key in order of ``seq``: in scope, out of scope or deleted; a delete is the end."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("membership", "ever boolean, active boolean, gone boolean, seq bigint, n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:  # noqa: ARG002, N802
        ever, active, gone, seq, n = self.state.get() if self.state.exists() else (False, False, False, -1, 0)
        # a key with many events comes in several chunks without order between them: all are sorted as one
        parts = [(p["seq"].to_numpy(np.int64), p["deleted"].to_numpy(bool, na_value=False), p["in_scope"].to_numpy(bool, na_value=False)) for p in rows]
        seqs, deletes, scopes = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, bool))
        for i in np.argsort(seqs, kind="stable"):
            if gone or seqs[i] <= seq:  # repeated and late deliveries
                continue
            if deletes[i]:
                if not ever:
                    continue
                active, gone = False, True
            elif scopes[i]:
                ever, active = True, True
            elif ever:
                active = False
            else:
                continue
            seq, n = int(seqs[i]), n + 1
        self.state.update((bool(ever), bool(active), bool(gone), int(seq), int(n)))
        yield pd.DataFrame({"key": [key[0]], "ever_in_scope": [ever], "active_in_scope": [active], "source_deleted": [gone], "head_seq": [seq], "n_changes": [n]})

    def close(self) -> None:
        pass


def current_state(events: DataFrame) -> DataFrame:
    """Stream of ``key, seq, in_scope, deleted`` to updates of the state; the last of a key counts.

    The session needs the RocksDB state store.  Events of a key must not come before older ones of an
    earlier batch: such late ones are dropped (the batch operators order a whole feed).
    """
    # the processor travels by value: workers of a stream need not have this package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return events.groupBy("key").transformWithStateInPandas(MembershipProcessor(), outputStructType=_OUT, outputMode="Update", timeMode="None")


def upsert_table(spark: SparkSession, path: str):
    """A ``foreachBatch`` function that keeps the last row of each key by ``seq``.

    Every batch makes a new version under its number and moves the pointer to it; a replayed batch
    finds its version and does nothing, so each takes effect once.
    """

    def apply(batch: DataFrame, epoch: int) -> None:
        fs, target = _fs(spark, f"{path}/v{epoch}")
        if fs.exists(_fs(spark, f"{path}/v{epoch}/_SUCCESS")[1]):
            return
        rows = batch
        if epoch > 0 and fs.exists(_fs(spark, f"{path}/v{epoch - 1}/_SUCCESS")[1]):
            rows = spark.read.schema(batch.schema).parquet(f"{path}/v{epoch - 1}").unionByName(batch)
        last = rows.groupBy("key").agg(F.max_by(F.struct(*batch.columns), "seq").alias("r")).select("r.*")
        last.write.mode("overwrite").parquet(f"{path}/v{epoch}")

    return apply


def daily_windows(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Day partitions of a stream of events, as tumbling windows of event time."""
    return events.withColumn("source_date", F.date_format(F.window(ts, "1 day")["start"], "yyyy-MM-dd"))
