"""Session settings and the shared folder where jobs write tables and checkpoints.

On a cluster the folder is the one named by ``spark.checkpoint.dir`` (shared
storage, visible to every executor).  Only when the session has none, as in
local tests, a fresh local folder is made and set as the checkpoint dir.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library relies on.  Event times are formatted / parsed as wall
# clock values, so the session time zone is pinned to UTC.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming aggregates keep one state row per group (e.g. per order):
    # RocksDB keeps that state off the JVM heap and on local disk.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Checkpoint only the changes of each micro-batch, not a snapshot of all state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, own: Mapping[str, str]) -> Iterator[None]:
    """The session has these settings while this is open.  A streaming query keeps those that it is started under."""
    before = {key: spark.conf.get(key, None) for key in own}
    try:
        for key, value in own.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


_FALLBACK: dict[str, str] = {}


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        return None


def shared_root(spark: SparkSession) -> str:
    """Root of the shared folder (``spark.checkpoint.dir``), set only if unset."""
    sc = _context(spark)
    root = (sc.getCheckpointDir() if sc is not None else None) or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
    if not master.startswith("local"):
        # Executors on other machines cannot see a local folder of the driver.
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage (e.g. HDFS / object store)")
    if sc is None:
        return _FALLBACK.setdefault("root", tempfile.mkdtemp(prefix="topiclake-"))
    root = tempfile.mkdtemp(prefix="topiclake-")  # local mode only, as in tests
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared root (not created)."""
    return "/".join([shared_root(spark).rstrip("/"), *parts])


def fresh_path(spark: SparkSession, kind: str, name: str) -> str:
    """A new, unused path under the shared root for one run of one job."""
    return shared_path(spark, kind, f"{name}-{uuid.uuid4().hex[:12]}")


def estimated_bytes(df) -> int:
    """Spark's estimate of the bytes that ``df`` has; very large where it cannot tell."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of ``path``, any scheme; needs a classic session."""
    sc = _context(spark)
    if sc is None:
        raise RuntimeError("stored tables need a session with a SparkContext (not Spark Connect)")
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(sc._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (any scheme)."""
    fs, jpath = file_system(spark, path)
    return bool(fs.exists(jpath))


def file_stamps(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, modification time) of the files at or under ``path``, in name order; none if it is missing."""
    fs, jpath = file_system(spark, path)
    if not fs.exists(jpath):
        return []
    out, files = [], fs.listFiles(jpath, True)
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool) -> bool:
    """A small text file; without ``overwrite`` False if there is one already (the creation is exclusive)."""
    fs, jpath = file_system(spark, path)
    if not overwrite and fs.exists(jpath):
        return False
    try:
        out = fs.create(jpath, overwrite)
    except Exception:
        if overwrite or not fs.exists(jpath):
            raise
        return False
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file's content; None if it is missing."""
    fs, jpath = file_system(spark, path)
    if not fs.exists(jpath):
        return None
    source = fs.open(jpath)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file put in place whole: written beside it, then renamed."""
    beside = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
    write_text(spark, beside, text, overwrite=True)
    fs, source = file_system(spark, beside)
    target = file_system(spark, path)[1]
    fs.delete(target, False)
    if not fs.rename(source, target):
        raise RuntimeError(f"cannot write {path}")


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a glob pattern finds."""
    fs, jpath = file_system(spark, pattern)
    return [str(f.getPath().toString()) for f in (fs.globStatus(jpath) or [])]


def delete_matching(spark: SparkSession, pattern: str) -> None:
    """Deletes the folders that a glob pattern finds; this library wrote them."""
    for path in matching(spark, pattern):
        delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this library wrote."""
    fs, jpath = file_system(spark, path)
    fs.delete(jpath, True)


def ensure_database(spark: SparkSession, name: str) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` with its folder in the shared root (not the driver's working dir)."""
    location = shared_path(spark, "warehouse", f"{name}.db")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")
