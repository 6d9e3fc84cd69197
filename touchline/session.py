"""Session helpers: a tuned builder and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution on.

    Nothing here is needed for right results; a cluster's own settings win
    wherever `master` and `shuffle_partitions` are left out.
    """
    builder = (
        SparkSession.builder.appName("touchline")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Very wide projections: methods the JIT compiles, not the largest ones.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


#: The folder for stored results where spark.checkpoint.dir is left to its owner.
SCRATCH = "spark.touchline.scratch.dir"
_LOCAL: dict[str, str] = {}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder the cluster names: `SCRATCH` if set, else
    `spark.checkpoint.dir`.

    Without either, a session that runs on this machine alone takes a local folder,
    one per application; on a cluster there is no such folder, and it is an error.
    """
    base = spark.conf.get(SCRATCH, None) or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError(f"set {SCRATCH} or spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="run-")
        base = _LOCAL[context.applicationId]
    return f"{base.rstrip('/')}/touchline/{label}-{uuid.uuid4().hex}"


def materialise(df, label: str):
    """Write `df` to the shared folder once and read it back.

    Used where a result feeds several branches: it cuts lineage, and the files
    outlive the executors that wrote them.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete what is stored at `path`, if anything, in whatever store holds it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def compiled_wide(spark: SparkSession) -> None:
    """For plans over a hundred columns: code of over 8,000 bytes a method is left to
    smaller methods, as the JIT compiler takes no larger ones and would run them slowly."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def spread_by(df, *keys: str):
    """Hash `df` by `keys` into the session's number of shuffle partitions.

    For groups that are small in bytes but costly to compute: a stated number is
    kept, where adaptive execution would merge small partitions into few tasks.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        home = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="run-")) / home.name
        context.addPyFile(shutil.make_archive(str(target), "zip", home.parent, home.name))
        _SHIPPED.add(context.applicationId)
