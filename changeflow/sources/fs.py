"""Listings, moves and deletes through the Hadoop FileSystem of the session; row data never goes through here."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _jvm(spark: SparkSession):
    return spark.sparkContext._jvm


def _fs(spark: SparkSession, path: str):
    jvm = _jvm(spark)
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_dir(spark: SparkSession, path: str) -> list[tuple[str, int, int, bool]]:
    """Direct children of ``path`` as (name, size, mtime_ms, is_dir); [] if missing."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [
        (s.getPath().getName(), int(s.getLen()), int(s.getModificationTime()), bool(s.isDirectory()))
        for s in fs.listStatus(p)
    ]


def list_files_recursive(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """All files under ``path`` (including hidden names) as (path, size, mtime_ms)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    it = fs.listFiles(p, True)
    out = []
    while it.hasNext():
        s = it.next()
        out.append((s.getPath().toString(), int(s.getLen()), int(s.getModificationTime())))
    return out


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Move ``src`` to ``dst``; raises if the file system refuses."""
    fs, s = _fs(spark, src)
    d = _jvm(spark).org.apache.hadoop.fs.Path(dst)
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise OSError(f"rename failed: {src} -> {dst}")


def set_mtime(spark: SparkSession, path: str, mtime_ms: int) -> None:
    fs, p = _fs(spark, path)
    fs.setTimes(p, mtime_ms, -1)


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified form of ``path`` (scheme included), as listings report it."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()
