"""Session settings that every entry point shares."""

from __future__ import annotations

import os
import sys
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once an application, unless they import it from the same folder.

    Python functions travel by name, so executors need the package wherever the driver was started.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped or any(p and os.path.realpath(p) == _ROOT for p in os.environ.get("PYTHONPATH", "").split(os.pathsep)):
        return
    name = os.path.join(tempfile.mkdtemp(prefix="package-"), "plumbline.zip")
    with zipfile.ZipFile(name, "w") as z:
        for top, _, files in os.walk(os.path.join(_ROOT, "plumbline")):
            for f in files:
                if f.endswith((".py", ".toml")):
                    full = os.path.join(top, f)
                    z.write(full, os.path.relpath(full, _ROOT))
    spark.sparkContext.addPyFile(name)  # the driver serves it to every executor
    sys.path[:] = [p for p in sys.path if p != name]
    _shipped.add(app)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; only where none is named on a single machine (tests) a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return sc.getCheckpointDir()


def local_session(app: str = "plumbline", cpus: str | None = None, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus or os.environ.get('BENCH_CPUS', '8')}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table.  Only Spark's readers open it, so any store that Spark reads will do."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
