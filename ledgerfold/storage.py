"""Shared work tables.

Iterative operators cut their lineage by writing a table to the folder that the cluster names in
``spark.checkpoint.dir`` (reliable storage which every executor sees), so a lost executor costs a
re-read and not a recomputation.  Only a local session without that setting gets a folder of its own.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_used: set[str] = set()


def work_dir(spark: SparkSession) -> str:
    """The shared folder of this session; raises on a cluster that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder which all executors share")
        _own[app] = "file://" + tempfile.mkdtemp(prefix="ledgerfold-")
        spark.sparkContext.setCheckpointDir(_own[app])
        atexit.register(_remove_local, _own[app])
    return _own[app]


def _remove_local(path: str) -> None:
    import shutil

    shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in this application's part of the shared folder, which is removed when Python ends."""
    mine = f"{work_dir(spark)}/ledgerfold/{spark.sparkContext.applicationId}"
    if mine not in _used:
        _used.add(mine)
        atexit.register(_remove, spark, mine)
    return f"{mine}/{name}-{uuid.uuid4().hex}"


def _remove(spark: SparkSession, path: str) -> None:
    if "://" not in path or path.startswith("file:"):
        _remove_local(path)
        return
    try:
        drop_table(spark, path)
    except Exception:  # noqa: BLE001, the session is gone: the folder's own expiry has to do it
        pass


def write_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` once to the shared folder and read it back: the reader and the path."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def drop_table(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def drop_work_tables(spark: SparkSession) -> None:
    """Remove all work tables of this application; results that still read them must be written before."""
    drop_table(spark, f"{work_dir(spark)}/ledgerfold/{spark.sparkContext.applicationId}")


def publish(df: DataFrame, path: str) -> DataFrame:
    """Write to a staging folder, then rename it: readers see all of the result or nothing."""
    spark = df.sparkSession
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(staging)
    fs, src = _fs(spark, staging)
    _, dst = _fs(spark, path)
    if fs.exists(dst):
        raise FileExistsError(path)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not publish {path}")
    return spark.read.schema(df.schema).parquet(path)
