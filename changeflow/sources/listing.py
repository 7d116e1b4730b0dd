"""Table listings: timeline instants and data files (SRC-8/9, AGG-6..13, FN-8..11).

A listing is a DataFrame(path, size, mtime). Spark's file sources hide names
that start with "." or "_", so listings come from the Hadoop FileSystem
(``list_files``) or from an object-store inventory table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.schemas import LISTING_SCHEMA
from changeflow.session import scratch_dir
from changeflow.sources import fs

# Completed action suffixes of the table timeline.
COMPLETED_SUFFIXES = ["deltacommit", "commit", "clean", "rollback", "savepoint", "restore",
                      "replacecommit", "indexing"]


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """All files under ``root`` (hidden names included) as a listing DataFrame."""
    rows = [(p, s, _dt.datetime.fromtimestamp(m / 1000, _dt.timezone.utc))
            for p, s, m in fs.list_files_recursive(spark, root)]
    return spark.createDataFrame(rows, LISTING_SCHEMA)


def _listed(root: str):
    """For ``mapInArrow``: the entries of each folder (``at``, a path below ``root``). Made here so that it travels by value."""
    def run(batches):
        import pyarrow as pa
        from pyarrow import fs as pfs

        scheme, rest = root.split(":", 1) if ":" in root.split("/", 1)[0] else ("file", root)
        uri = f"{scheme.replace('s3a', 's3')}://{rest if rest.startswith('/') and not rest.startswith('//') else rest.lstrip('/')}"
        system, top = pfs.FileSystem.from_uri(uri)
        for b in batches:
            for at in b.column("at").to_pylist():
                infos = system.get_file_info(pfs.FileSelector(top + at, allow_not_found=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{at}/{i.base_name}" for i in infos], pa.string()), pa.array([i.size or 0 for i in infos], pa.int64()),
                     pa.array([i.mtime for i in infos], pa.timestamp("us", "UTC")), pa.array([i.type == pfs.FileType.Directory for i in infos], pa.bool_())],
                    ["at", "size", "mtime", "is_dir"])

    return run


def list_files_by_tasks(spark: SparkSession, root: str, folders_per_task: int = 16) -> DataFrame:
    """``list_files`` of a large tree: tasks list folders, level by level, and no path goes through the driver.

    A level's entries are written to the shared scratch folder, so that later
    steps see one listing and a lost executor costs one level. Hidden names are
    listed like any other, a local file system's checksum files too. A folder
    that is gone when its turn comes is empty.
    """
    top = fs.qualify(spark, root).rstrip("/")
    scratch = scratch_dir(spark, "listing")
    schema = "at string, size bigint, mtime timestamp, is_dir boolean"
    folders, level, waiting = spark.createDataFrame([("",)], "at string"), 0, 1
    while waiting:
        tasks = max(1, min(waiting // folders_per_task, 4096))
        folders.repartition(tasks).mapInArrow(_listed(top), schema).write.parquet(f"{scratch}/level={level}")
        folders = spark.read.schema(schema).parquet(f"{scratch}/level={level}").filter("is_dir").select("at")
        waiting, level = folders.count(), level + 1
    found = spark.read.schema(schema).parquet(*[f"{scratch}/level={i}" for i in range(level)])
    return found.filter("not is_dir").select(F.concat(F.lit(top), "at").alias("path"), "size", "mtime")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parse_timeline(listing: DataFrame, timeline_prefix: str) -> DataFrame:
    """SRC-8: objects directly under the timeline folder → (name, instant, suffix).

    Skips names without a "." and names whose instant is not all digits.
    """
    prefix = timeline_prefix.rstrip("/") + "/"
    rest = F.substring(F.col("path"), len(prefix) + 1, 1 << 30)
    direct = listing.filter(F.col("path").startswith(prefix) & ~rest.contains("/")).select(
        rest.alias("name"), "size", "mtime")
    instant = F.substring_index("name", ".", 1)
    return direct.filter(F.col("name").contains(".") & instant.rlike("^[0-9]+$")).select(
        "name", instant.alias("instant"),
        F.expr("substring(name, length(substring_index(name, '.', 1)) + 2)").alias("suffix"),
        "mtime")


def timeline_counts(timeline: DataFrame) -> DataFrame:
    """AGG-6: completed deltacommits, commits (compactions) and cleans (exact suffix)."""
    return timeline.agg(
        F.count_if(F.col("suffix") == "deltacommit").alias("deltacommit_count"),
        F.count_if(F.col("suffix") == "commit").alias("commit_count"),
        F.count_if(F.col("suffix") == "clean").alias("clean_count"))


def instant_time(instant: Column) -> Column:
    """FN-11: first 14 characters as yyyyMMddHHmmss (UTC); null if not a time."""
    return F.try_to_timestamp(F.substring(instant, 1, 14), F.lit("yyyyMMddHHmmss"))


def commit_age(timeline: DataFrame, now: Column, use_mtime: bool = False) -> DataFrame:
    """AGG-7 / AGG-13: seconds since the newest deltacommit/commit, −1 if none.

    The commit time is parsed from the instant name; ``use_mtime`` takes the
    marker's modification time instead (timelines named by batch number)."""
    t = F.col("mtime") if use_mtime else instant_time(F.col("instant"))
    latest = timeline.filter(F.col("suffix").isin("deltacommit", "commit")).agg(F.max(t).alias("latest"))
    age = ((F.unix_micros(now) - F.unix_micros("latest")) / F.lit(1_000_000)).cast("bigint")
    return latest.select("latest", F.coalesce(age, F.lit(-1).cast("bigint")).alias("commit_age_seconds"))


def timeline_instants(timeline: DataFrame) -> DataFrame:
    """AGG-8 / AGG-9: per instant, is it truly in flight?

    In flight = some suffix ends with ``inflight`` or ``requested`` and no
    suffix is a completed action.
    """
    pending = F.col("suffix").endswith("inflight") | F.col("suffix").endswith("requested")
    completed = F.col("suffix").isin(*COMPLETED_SUFFIXES)
    return timeline.groupBy("instant").agg(
        F.sort_array(F.collect_set("suffix")).alias("suffixes"),
        (F.bool_or(pending) & ~F.bool_or(completed)).alias("truly_inflight"))


def inflight_count(instants: DataFrame) -> DataFrame:
    return instants.agg(F.count_if("truly_inflight").alias("inflight_operations"))


def classify_files(listing: DataFrame, table_prefix: str, timeline_dir: str = ".hoodie",
                   ignore_names: str | None = None) -> DataFrame:
    """SRC-9 / FN-9 / FN-10: data files under the table with kind and file group.

    Excludes the timeline folder (``timeline_dir``), partition metadata and
    names matching ``ignore_names`` (e.g. commit-protocol files of a plain
    parquet table). ``kind``: ``log`` for
    any name starting with "." (reference rule), ``base`` for ``*.parquet``,
    else ``other`` (counted in the total only). File group = text before the
    first "_" (leading "." dropped), null when there is no "_".
    """
    prefix = table_prefix.rstrip("/") + "/"
    files = listing.filter(F.col("path").startswith(prefix)
                           & ~F.col("path").contains(f"/{timeline_dir}/")
                           & ~F.col("path").endswith(".hoodie_partition_metadata"))
    name = base_name(F.col("path"))
    if ignore_names:
        files = files.filter(~name.rlike(ignore_names))
    kind = (F.when(name.startswith("."), F.lit("log"))
            .when(name.endswith(".parquet"), F.lit("base")).otherwise(F.lit("other")))
    group = (F.when(kind == "log", F.nullif(F.regexp_extract(name, r"^\.([^_]+)_", 1), F.lit("")))
             .when(kind == "base", F.nullif(F.regexp_extract(name, r"^([^_]+)_", 1), F.lit(""))))
    return files.select("path", name.alias("name"), "size", kind.alias("kind"), group.alias("file_group"))


def file_inventory(files: DataFrame) -> DataFrame:
    """AGG-10 / AGG-12: file counts and total size."""
    return files.agg(
        F.count(F.lit(1)).alias("data_files_total"),
        F.count_if(F.col("kind") == "base").alias("base_files_total"),
        F.count_if(F.col("kind") == "log").alias("log_files_total"),
        F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("table_size_bytes"))


def file_groups(files: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """AGG-11 / SET-3: distinct file groups over base and log files.

    Exact by default; ``approx_rsd`` switches to a HyperLogLog++ estimate
    (one small sketch per task instead of a shuffle of distinct ids) for
    listings with billions of files."""
    g = files.filter(F.col("kind").isin("base", "log"))
    if approx_rsd is not None:
        return g.agg(F.approx_count_distinct("file_group", approx_rsd).alias("file_groups_total"))
    return g.agg(F.countDistinct("file_group").alias("file_groups_total"))
