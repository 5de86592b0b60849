"""Sessions: one for local runs, and the package on the workers of any."""

from __future__ import annotations

import atexit
import pathlib
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the package's own code to the workers, once for an application; they need not have it installed."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        root = pathlib.Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="ledgerfold-code-")  # on the driver, which serves the file
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        target = pathlib.Path(folder) / "ledgerfold_code.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(target))
    return spark


def local_session(cpus: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerfold")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)
