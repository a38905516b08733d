"""Session, shared scratch space and size-checked broadcast.

Everything that touches the cluster's configuration lives here so that the
operators stay pure ``DataFrame -> DataFrame`` functions.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Measured size above which a "small" side is not broadcast but shuffled instead, and
# the rows that are looked at to find that out.
BROADCAST_BYTES = 64 << 20
BROADCAST_ROW_LIMIT = 1_000_000


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "quire") -> SparkSession:
    """Local session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Session settings every job relies on (idempotent)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator of the cluster (HDFS, S3, ...). Only
    a local session without one gets a private folder; on a cluster a folder of
    the driver's machine would be wrong, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        current = sc.getCheckpointDir()
        if current:
            base = current
        else:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="quire-ckpt-")
            sc.setCheckpointDir(base)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared folder."""
    return f"{shared_dir(spark)}/stage/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _bytes_of(name: str, kind: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType, T.MapType)):
        return F.coalesce(F.size(c), F.lit(0)) * 8 + 32
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.octet_length(F.to_json(F.struct(c))) * 2 + 32
    return F.lit(16)


def measured_bytes(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT) -> int | None:
    """About how many bytes the rows of ``df`` take in memory; None beyond ``max_rows``."""
    width = sum((_bytes_of(f.name, f.dataType) for f in df.schema.fields), F.lit(16))
    r = df.limit(max_rows + 1).select(width.cast("long").alias("w")).agg(F.count("w").alias("n"), F.sum("w").alias("b")).first()
    return None if r["n"] > max_rows else int(r["b"] or 0)


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only when its measured size is at most ``max_bytes``.

    The measuring runs on the (small) side only; beyond the bound the frame is
    returned as is and the planner shuffles (AQE may still pick a broadcast
    at run time from real sizes)."""
    size = measured_bytes(df, max_rows)
    return F.broadcast(df) if size is not None and size <= max_bytes else df


def hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def arrow_fs(path: str):
    """``(pyarrow filesystem, inner path)`` for a Spark/Hadoop path (``file:/x``,
    ``file:///x``, ``hdfs://…``, ``s3://…``, or a bare local path)."""
    import pyarrow.fs as pafs

    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    elif "://" not in path:
        path = "file://" + path
    return pafs.FileSystem.from_uri(path)


def spread(df: DataFrame) -> DataFrame:
    """Spread a small-but-CPU-heavy input over all task slots.

    Only when the scan yields fewer partitions than the cluster's default
    parallelism (a few large row groups); a big input already has more
    partitions and is returned unchanged, without a shuffle."""
    sc = df.sparkSession.sparkContext
    if df.rdd.getNumPartitions() < sc.defaultParallelism:
        return df.repartition(sc.defaultParallelism)
    return df
