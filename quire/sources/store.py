"""Sinks (O-11): snapshot tables and framed text files.

Parquet tables cannot be MERGEd in place, so a table is a folder of snapshot
versions ``v=<n>``, each published by a pointer file of its own that is renamed
into place last. Readers take the newest published version: they see either the
old or the new one, never half a merge, and a job that dies at any step leaves
the last version readable. ``vacuum`` drops old versions.
"""

from __future__ import annotations

import hashlib

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import hadoop_fs


_POINTER = "_CURRENT-"


def _pointers(spark: SparkSession, root: str) -> dict[int, object]:
    """Published versions and their pointer files (a name only exists once it is whole)."""
    fs, p = hadoop_fs(spark, root)
    if not fs.exists(p):
        return {}
    names = ((st.getPath(), st.getPath().getName()) for st in fs.listStatus(p))
    return {int(n[len(_POINTER):]): path for path, n in names if n.startswith(_POINTER) and n[len(_POINTER):].isdigit()}


def _read_pointer(spark: SparkSession, root: str) -> tuple[int, str | None, int] | None:
    """``(version, bucket column or None, buckets)`` of the newest published version."""
    found = _pointers(spark, root)
    if not found:
        return None
    version = max(found)
    fs, _ = hadoop_fs(spark, root)
    stream = fs.open(found[version])
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream))
        key, buckets = reader.readLine().rstrip("\n").split("\t")
    finally:
        stream.close()
    return version, key or None, int(buckets)


def _write_pointer(spark: SparkSession, root: str, version: int, key: str | None, buckets: int) -> None:
    """Publish ``version``: a pointer file of its own, written aside and renamed
    into place. Nothing is deleted, so a reader finds a whole version at any time."""
    fs, aside = hadoop_fs(spark, f"{root}/_{version}.tmp")
    out = fs.create(aside, True)
    try:
        out.write(bytearray(f"{key or ''}\t{buckets}\n", "utf-8"))
    finally:
        out.close()
    _, final = hadoop_fs(spark, f"{root}/{_POINTER}{version:010d}")
    if not fs.rename(aside, final):
        raise RuntimeError(f"version {version} of {root} was published by another writer")


def _table_name(root: str, version: int) -> str:
    return f"quire_{hashlib.md5(root.encode()).hexdigest()}_v{version}"


def bucket_count(spark: SparkSession, root: str, least: int = 8, bucket_bytes: int = 256 << 20) -> int:
    """Buckets for the next version: powers of two that follow the stored size."""
    ptr = _read_pointer(spark, root)
    n = least
    if ptr is not None:
        fs, p = hadoop_fs(spark, f"{root}/v={ptr[0]}")
        size = fs.getContentSummary(p).getLength()
        n = max(n, ptr[2])
        while n * bucket_bytes < size:
            n *= 2
    return n


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Drop all but the ``keep`` newest versions; returns the versions dropped.
    Call it when no reader is left on them."""
    found = _pointers(spark, root)
    old = sorted(found)[:-keep] if keep else sorted(found)
    for v in old:
        fs, path = hadoop_fs(spark, f"{root}/v={v}")
        fs.delete(found[v], False)
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(root, v)}")
        fs.delete(path, True)
    return old


# --- tables in hash buckets, of which a run rewrites only those that it touches ----------------

BUCKET_ROWS = 200_000            # rows a bucket when a table is started
BUCKET_BYTES = 256 << 20         # mean size of a bucket beyond which a table gets twice as many


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def layout(spark: SparkSession, root: str) -> int | None:
    """How many buckets the table at ``root`` has (folders ``of=<n>/bucket=<k>``)."""
    fs, p = hadoop_fs(spark, root)
    if not fs.exists(p):
        return None
    names = (st.getPath().getName() for st in fs.listStatus(p))
    return max((int(n[3:]) for n in names if n.startswith("of=")), default=None)


def touched_buckets(keys: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets of the given keys (at most ``buckets`` numbers)."""
    return sorted(r[0] for r in keys.select(bucket_of(key, buckets).alias("b")).distinct().collect())


def read_buckets(spark: SparkSession, root: str, only: Iterable[int] | None = None) -> DataFrame | None:
    """The table in buckets at ``root``, or its buckets ``only``: a partition filter, so that
    no file of another bucket is opened. None when there is no such table."""
    n = layout(spark, root)
    if n is None:
        return None
    fs, p = hadoop_fs(spark, f"{root}/of={n}")
    if not any(st.isDirectory() for st in fs.listStatus(p)):
        return None
    df = spark.read.option("basePath", f"{root}/of={n}").parquet(f"{root}/of={n}")
    if only is not None:
        df = df.where(F.col("bucket").isin(*only))
    return df.drop("bucket")


def replace_buckets(df: DataFrame, root: str, key: str, only: Iterable[int], buckets: int, bloom: tuple[str, ...] = ()) -> None:
    """Write ``df`` as the whole contents of the buckets ``only``; all others stay as they are.

    A dynamic partition overwrite: new files are written aside and take the old
    ones' place when the job commits, so ``df`` may be made from the same table.
    A bucket that has no rows any more is removed."""
    placed = df.withColumn("bucket", bucket_of(key, buckets))
    replace_partitions(placed, f"{root}/of={buckets}", "bucket", only, (key,), bloom)


def replace_partitions(df: DataFrame, path: str, column: str, only: Iterable[int], order: tuple[str, ...],
                       bloom: tuple[str, ...] = (), options: Mapping[str, str] | None = None) -> None:
    """Write ``df`` as the whole contents of the folders ``column=<n>`` named by ``only``, each sorted by ``order``."""
    spark, only = df.sparkSession, list(only)
    if not only:
        return
    fs, p = hadoop_fs(spark, path)
    fs.mkdirs(p)

    def names(b: int) -> set[str]:
        folder = hadoop_fs(spark, f"{path}/{column}={b}")[1]
        return {st.getPath().getName() for st in fs.listStatus(folder)} if fs.exists(folder) else set()
    before = {b: names(b) for b in only}
    placed = df.hint("rebalance", column).sortWithinPartitions(column, *order)
    (_writer(placed, bloom).options(**(options or {})).option("partitionOverwriteMode", "dynamic").mode("overwrite")
     .partitionBy(column).parquet(path))
    for b, old in before.items():
        if old & names(b):          # nothing was written there (file names are never used twice)
            fs.delete(hadoop_fs(spark, f"{path}/{column}={b}")[1], True)


def rebucket(spark: SparkSession, root: str, key: str, buckets: int, bloom: tuple[str, ...] = ()) -> None:
    """Give the table ``buckets`` buckets: written aside, renamed into place, then the old ones go."""
    old = layout(spark, root)
    aside = f"{root}/_next"
    fs, p = hadoop_fs(spark, aside)
    fs.delete(p, True)
    replace_buckets(read_buckets(spark, root), aside, key, range(buckets), buckets, bloom)
    fs.rename(hadoop_fs(spark, f"{aside}/of={buckets}")[1], hadoop_fs(spark, f"{root}/of={buckets}")[1])
    fs.delete(hadoop_fs(spark, f"{root}/of={old}")[1], True)
    fs.delete(p, True)


def open_buckets(spark: SparkSession, root: str, key: str, like: DataFrame, bloom: tuple[str, ...] = ()) -> int:
    """The bucket count of the table at ``root``. A snapshot written by ``write_table`` is
    moved into buckets first, a table that has outgrown its buckets gets more, a missing one is
    planned for the rows of ``like``."""
    n = layout(spark, root)
    if n is None:
        snapshot = read_table(spark, root)
        rows, n = (like if snapshot is None else snapshot).count(), 8
        while n * BUCKET_ROWS < rows:
            n *= 2
        if snapshot is not None:
            replace_buckets(snapshot, root, key, range(n), n, bloom)
            vacuum(spark, root, keep=0)
        return n
    fs, p = hadoop_fs(spark, f"{root}/of={n}")
    size, more = fs.getContentSummary(p).getLength(), n
    while size > more * BUCKET_BYTES:
        more *= 2
    if more > n:
        rebucket(spark, root, key, more, bloom)
    return more


def read_table(spark: SparkSession, root: str, schema=None) -> DataFrame | None:
    """The table in buckets or the current snapshot at ``root`` (None when there is none yet).

    A bucketed snapshot is read through the catalog so Spark knows its hash
    partitioning (joins and aggregates on the key do not shuffle it); a new
    session registers it again from the pointer's bucket spec."""
    held = read_buckets(spark, root)
    if held is not None:
        return held
    ptr = _read_pointer(spark, root)
    if ptr is None:
        return None
    v, key, buckets = ptr
    path = f"{root}/v={v}"
    if key:
        name = _table_name(root, v)
        if not spark.catalog.tableExists(name):
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet CLUSTERED BY ({key}) "
                      f"SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
        return spark.table(name)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def _writer(df: DataFrame, bloom: tuple[str, ...]):
    w = df.write
    for c in bloom:
        if c in df.columns:
            w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    return w


def write_table(df: DataFrame, root: str, bucket_col: str | None = None, buckets: int = 0,
                bloom: tuple[str, ...] = ()) -> int:
    """Write ``df`` as the next snapshot version and publish it.

    With ``bucket_col``/``buckets`` the snapshot is a bucketed table on the
    merge key: the next merge joins it without shuffling it (only the run's
    incoming rows are hashed into the same buckets). ``bloom`` columns get
    Parquet bloom filters, so key lookups (O-97) skip row groups."""
    spark = df.sparkSession
    cur = _read_pointer(spark, root)
    nxt = 0 if cur is None else cur[0] + 1
    path = f"{root}/v={nxt}"
    if bucket_col and buckets:
        name = _table_name(root, nxt)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        w = _writer(df.repartition(buckets, bucket_col), bloom)      # one file a bucket
        (w.bucketBy(buckets, bucket_col).sortBy(bucket_col).option("path", path)
         .mode("overwrite").saveAsTable(name))
    else:
        _writer(df, bloom).mode("overwrite").parquet(path)
    _write_pointer(spark, root, nxt, bucket_col if buckets else None, buckets)
    return nxt


def write_framed_text(lines: DataFrame, path: str, n_files: int, head: list[str] | None = None,
                      tail: list[str] | None = None, file_col: str = "file_no",
                      seq_col: str = "seq", line_col: str = "line") -> None:
    """Write ``lines`` (``file_no``, ``seq``, ``line``) as ``n_files`` text files,
    each framed by ``head`` and ``tail`` lines, body lines in ``seq`` order
    (``seq`` may be any orderable column, e.g. a struct).

    One folder per file (``file_no=<k>``) holding a single part file.
    """
    spark = lines.sparkSession
    seq_type = lines.schema[seq_col].dataType
    files = spark.range(n_files).select(F.col("id").cast("int").alias(file_col))
    body = lines.select(F.col(file_col).cast("int").alias(file_col), F.lit(1).alias("__sec"),
                        F.lit(0).alias("__hpos"), F.col(seq_col), F.col(line_col))
    for sec, frame in ((0, head or []), (2, tail or [])):
        for i, text in enumerate(frame):
            body = body.unionByName(files.select(file_col, F.lit(sec).alias("__sec"), F.lit(i).alias("__hpos"),
                                                 F.lit(None).cast(seq_type).alias(seq_col),
                                                 F.lit(text).alias(line_col)))
    (body.repartition(n_files, file_col).sortWithinPartitions(file_col, "__sec", "__hpos", seq_col)
     .select(file_col, line_col)
     .write.mode("overwrite").partitionBy(file_col).text(path))


def rename_single_parts(spark: SparkSession, path: str, names: dict[str, str], file_col: str = "file_no") -> list[str]:
    """Give each ``<path>/<file_col>=<k>/part-*`` file the name ``names[k]`` in ``path``
    (metadata-only renames on the file system)."""
    out = []
    fs, root = hadoop_fs(spark, path)
    jvm = spark.sparkContext._jvm
    for k, name in names.items():
        d = jvm.org.apache.hadoop.fs.Path(f"{path}/{file_col}={k}")
        if not fs.exists(d):
            continue
        for st in fs.listStatus(d):
            n = st.getPath().getName()
            if n.startswith("part-"):
                dst = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
                fs.rename(st.getPath(), dst)
                out.append(f"{path}/{name}")
        fs.delete(d, True)
    return out


def write_ordered_text(lines: DataFrame, path: str, rows_per_file: int = 20_000, seq_col: str = "seq",
                       line_col: str = "line", start_ms: int = 1_700_000_000_000) -> list[str]:
    """Write ``lines`` as one logical feed split into ordered part files.

    Range partitioning on ``seq`` puts consecutive lines in the same file and
    keeps files in ``seq`` order; each file is written by its own task. The
    files' modification times are then set in name order (a metadata call per
    file), so file order — (mtime, name, position) — equals ``seq`` order."""
    spark = lines.sparkSession
    n = max(1, -(-lines.count() // rows_per_file))
    (lines.repartitionByRange(n, seq_col).sortWithinPartitions(seq_col).select(line_col)
     .write.mode("overwrite").text(path))
    fs, root = hadoop_fs(spark, path)
    parts = sorted((st.getPath() for st in fs.listStatus(root) if st.getPath().getName().startswith("part-")),
                   key=lambda p: p.getName())
    for i, p in enumerate(parts):
        fs.setTimes(p, start_ms + i * 1000, -1)
    return [p.toString() for p in parts]
