"""Table writes: snapshot overwrite, increment append, versioned swap.

Parquet tables have no UPDATE / DELETE / MERGE.  A table that must be rewritten
from itself (SCD-2 expiry) is written as a new version folder and an
append-only version log names the current version, so readers never see a
half-written table and a failed job leaves the old version in place.

The log holds one small file a version, named by its sequence number.  A writer claims the
next number by creating that file exclusively: of two writers one wins, and the other builds
its version anew from what the winner left.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_mart import schemas

def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Select the declared columns by name, in declared order, with declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.struct(ddl).fields])


def write_table(df: DataFrame, path: str, mode: str, ddl: str | None = None, max_records_per_file: int | None = None,
                sort_by: list[str] | None = None) -> None:
    """``mode``: 'overwrite' (snapshot / refresh) or 'append' (increment)."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, got {mode!r}")
    out = conform(df, ddl) if ddl else df
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    w = out.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    with shuffles_freed(df.sparkSession):
        w.parquet(path)


def _log(root: str) -> str:
    return f"{root.rstrip('/')}/_versions"


def _files(spark: SparkSession, path: str):
    """The JVM's path and file system (any that Spark can write)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(sequence number, version folder) of every claim, newest first.  A claim whose writer died
    before it named its version has an empty name."""
    log, fs = _files(spark, _log(root))
    if not fs.exists(log):
        return []
    out = []
    for f in fs.listStatus(log):
        name = f.getPath().getName()
        if name.startswith("seq-"):
            stream = fs.open(f.getPath())
            try:
                out.append((int(name[4:]), spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
            finally:
                stream.close()
    return sorted(out, reverse=True)


def current_version(spark: SparkSession, root: str) -> str | None:
    """Path of the newest complete version (None before the first write)."""
    return next((f"{root.rstrip('/')}/{name}" for _, name in versions(spark, root) if name), None)


def read_versioned(spark: SparkSession, root: str) -> DataFrame | None:
    cur = current_version(spark, root)
    return spark.read.parquet(cur) if cur else None


def claim_version(spark: SparkSession, root: str, seq: int, name: str) -> bool:
    """Whether this writer is the one that gets sequence number ``seq``."""
    path, fs = _files(spark, f"{_log(root)}/seq-{seq:010d}")
    try:
        out = fs.create(path, False)  # fails if it exists
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName() or fs.exists(path):
            return False
        raise
    out.write(bytearray(name.encode("utf-8")))
    out.close()
    return True


def update_versioned(spark: SparkSession, root: str, build: Callable[[DataFrame | None], DataFrame], ddl: str | None = None,
                     tag: str = "", attempts: int = 10) -> str:
    """Write ``build(current table or None)`` as the next version; returns its path.

    If another writer claims the number first, the version is built again from the new state.
    With a ``tag`` (letters, digits, - and _) a run that has already made its version, and is run
    again, makes no other."""
    root = root.rstrip("/")
    for _ in range(attempts):
        known = versions(spark, root)
        done = next((n for _, n in known if tag and n.startswith(f"v-{tag}-")), None)
        if done:
            return f"{root}/{done}"
        cur = next((n for _, n in known if n), None)
        name = f"v-{tag}-{uuid.uuid4().hex}" if tag else f"v-{uuid.uuid4().hex}"
        write_table(build(spark.read.parquet(f"{root}/{cur}") if cur else None), f"{root}/{name}", "overwrite", ddl)
        if claim_version(spark, root, known[0][0] + 1 if known else 0, name):
            return f"{root}/{name}"
    raise RuntimeError(f"{root}: other writers took {attempts} versions in a row")


def write_versioned(df: DataFrame, root: str, ddl: str | None = None) -> str:
    """Write a full new version next to the old one, then claim the next sequence number for
    it.  Readers follow the log, so they see the old version or the new one, never a
    half-written table; a failed write leaves the old version current."""
    return update_versioned(df.sparkSession, root, lambda _: df, ddl)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder of the session (a Hadoop URI
    on a cluster, e.g. ``hdfs://`` or ``s3a://``)."""
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        from civic_mart.session import ensure_checkpoint_dir
        base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/civic_mart/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared checkpoint folder and read it
    back: later uses read the files instead of recomputing the lineage, the files
    survive executor loss, and the planner sees their real size (small tables get
    broadcast, large ones do not)."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: dict[str, list] = {}  # by application: writes under way, and the setting before the first
_freeing_lock = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written inside is read from its files afterwards, so its shuffle files go when it ends,
    not when the driver happens to collect its garbage.  Writes may run side by side."""
    app = spark.sparkContext.applicationId
    with _freeing_lock:
        state = _freeing.setdefault(app, [0, None])
        if not state[0]:
            state[1] = spark.conf.get(_FREE, None)
            spark.conf.set(_FREE, "true")
        state[0] += 1
    try:
        yield
    finally:
        with _freeing_lock:
            state[0] -= 1
            if not state[0]:
                spark.conf.unset(_FREE) if state[1] is None else spark.conf.set(_FREE, state[1])


def discard(*stored: DataFrame) -> None:
    """Delete the folders of tables that ``materialize`` wrote, once nothing reads them any more."""
    for df in stored:
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            if "/civic_mart/" in folder:
                path, fs = _files(df.sparkSession, folder)
                fs.delete(path, True)
