"""A merge-on-read table as catalog tables bucketed by key (TBL-1..8, SRC-4/5, SNK-3/4).

A table is two Spark tables with the same buckets::

    <name>_changes   precombined change rows, one partition for each batch that
                     isn't folded in yet      changes/batch_id=N/*.parquet
    <name>_base      compacted rows, one partition for each version, day and
                     bucket                   base/_version=V/dt=.../_bucket=B/*.parquet

Rows of a key are in the same bucket of both, so the newest row of each key is
found without moving the base or the changes (no exchange in the plan), and a
lookup by key reads one bucket of each. Compaction rewrites only the cells (day
and bucket) that changed.

The catalog says what is read, and every reader asks it, in any session. There
is no other record of state, because any set of versions gives the same rows as
long as nothing newer is missing: readers take the newest row of each key, and a
version only holds rows that are newer than, or the same as, those it replaces.
So a compaction adds its partitions, then drops the batches from the catalog,
then the replaced versions; wherever it stops, readers are right and running it
again is harmless, and so is a batch that is replayed. Where the catalog is lost
or another one is used, the folders are attached again as they are.

Latest-wins everywhere uses the same total order: larger ``ts`` wins, ties go
to the larger (kafka_partition, kafka_offset); rows with a null ``ts`` lose.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.operators.key_index import build_index, probe_index
from changeflow.operators.latest import precombine
from changeflow.schemas import NUM_BUCKETS, PARTITION_FIELD, RECORD_KEY
from changeflow.sources import fs

DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # the folder name of a null partition value
DELETE_FLAG = "_is_delete"
BUCKET = "_bucket"
VERSION = "_version"
INTERNAL = (DELETE_FLAG, BUCKET)
SPECS_AT_ONCE = 500  # partitions named in one statement


@dataclass(frozen=True)
class TableSpec:
    root: str
    key: str = RECORD_KEY
    partition: str = PARTITION_FIELD
    order: tuple[str, ...] = ("ts", "kafka_partition", "kafka_offset")
    key_scope: str = "partition"  # "partition": key = (dt, key); "global": key alone
    deletes: str = "ignore"  # "ignore": deletes never reach the table; "apply"
    num_buckets: int = NUM_BUCKETS  # so many that one bucket of a day is a file of a good size
    min_deltas: int = 2  # compact once this many uncompacted batches exist; 0 = never
    name: str | None = None  # in the catalog; from the folder if None

    @property
    def merge_keys(self) -> list[str]:
        return [self.partition, self.key] if self.key_scope == "partition" else [self.key]

    def table(self, kind: str) -> str:
        return f"{self.name or 'mor_' + hashlib.md5(self.root.encode()).hexdigest()[:12]}_{kind}"

    @property
    def bucket(self) -> Column:
        """Spark's own bucket of the key."""
        return F.pmod(F.hash(F.col(self.key)), F.lit(self.num_buckets)).cast("int")


Cell = tuple[int, str | None, int]  # version, day, bucket


@dataclass(frozen=True)
class TableState:
    pending: list[int]   # batches not folded in yet
    cells: list[Cell]    # what the base consists of

    @property
    def version(self) -> int:
        return max((v for v, _, _ in self.cells), default=-1)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ddl(fields: list[T.StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def _on_disk(spark: SparkSession, spec: TableSpec) -> list[T.StructField]:
    """Fields of the files that are already in the folders."""
    fields: dict[str, T.StructField] = {}
    for kind in ("base", "changes"):
        try:
            found = spark.read.option("mergeSchema", "true").parquet(f"{spec.root}/{kind}").schema
        except AnalysisException:  # no folder, or no file in it
            continue
        for f in found:
            fields.setdefault(f.name, f)
    return [f for f in fields.values() if f.name not in (VERSION, "batch_id", BUCKET, spec.partition)]


def _create(spark: SparkSession, spec: TableSpec, fields: list[T.StructField]) -> None:
    data = _ddl([f for f in fields if f.name not in (spec.partition, BUCKET)])
    buckets = f"CLUSTERED BY (`{spec.key}`) SORTED BY (`{spec.key}`) INTO {spec.num_buckets} BUCKETS"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {spec.table('changes')} ({data}, `{spec.partition}` string, {BUCKET} int, batch_id bigint) USING parquet "
              f"PARTITIONED BY (batch_id) {buckets} LOCATION {_quoted(spec.root + '/changes')}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {spec.table('base')} ({data}, {VERSION} bigint, `{spec.partition}` string, {BUCKET} int) USING parquet "
              f"PARTITIONED BY ({VERSION}, `{spec.partition}`, {BUCKET}) {buckets} LOCATION {_quoted(spec.root + '/base')}")
    if spec.key_scope == "global":
        spark.sql(f"CREATE TABLE IF NOT EXISTS {spec.table('keys')} (`{spec.partition}` string, {BUCKET} int, lanes int, lane int, bits binary, {VERSION} bigint) "
                  f"USING parquet PARTITIONED BY ({VERSION}) LOCATION {_quoted(spec.root + '/keys')}")


def _open(spark: SparkSession, spec: TableSpec) -> None:
    """Attach the folders if this catalog doesn't know the table; forget what the session has cached about it."""
    known = [spec.table(k) for k in ("base", "changes", *(["keys"] if spec.key_scope == "global" else []))]
    if not spark.catalog.tableExists(known[0]):
        there = _on_disk(spark, spec)
        if not there:
            raise ValueError(f"table at {spec.root} has no commits")
        _create(spark, spec, there)
        for t in known:
            spark.sql(f"ALTER TABLE {t} RECOVER PARTITIONS")
    for t in known:
        spark.catalog.refreshTable(t)


def _data_fields(spark: SparkSession, spec: TableSpec) -> list[T.StructField]:
    """The base's own columns, then the partition column."""
    schema = spark.table(spec.table("base")).schema
    return [f for f in schema if f.name not in (VERSION, BUCKET, spec.partition)] + [schema[spec.partition]]


def _reconcile(spark: SparkSession, spec: TableSpec, schema: T.StructType) -> None:
    """TBL-6: create the table, or add the columns it doesn't have; a column never changes its type."""
    try:
        _open(spark, spec)
    except ValueError:
        _create(spark, spec, list(schema))
        return
    known = {f.name: f.dataType for f in _data_fields(spark, spec)}
    changed = [f"{f.name}: {known[f.name].simpleString()} -> {f.dataType.simpleString()}"
               for f in schema if f.name in known and known[f.name] != f.dataType]
    if changed:
        raise ValueError(f"columns changed their type: {', '.join(changed)}")
    new = [f for f in schema if f.name not in known]
    if new:
        for kind in ("changes", "base"):
            spark.sql(f"ALTER TABLE {spec.table(kind)} ADD COLUMNS ({_ddl(new)})")
        refresh_views(spark, spec)


def _partitions(spark: SparkSession, table: str) -> list[dict[str, str]]:
    return [dict(part.split("=", 1) for part in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def pending_batches(spark: SparkSession, spec: TableSpec) -> list[int]:
    return sorted(int(p["batch_id"]) for p in _partitions(spark, spec.table("changes")))


def _cells(spark: SparkSession, spec: TableSpec) -> list[Cell]:
    return [(int(p[VERSION]), None if p[spec.partition] in (DEFAULT_PARTITION, "null") else unquote(p[spec.partition]), int(p[BUCKET]))
            for p in _partitions(spark, spec.table("base"))]


def read_state(spark: SparkSession, spec: TableSpec) -> TableState:
    """What the catalog names: batches not folded in, and the cells of the base."""
    _open(spark, spec)
    return TableState(pending_batches(spark, spec), _cells(spark, spec))


def _drop(spark: SparkSession, table: str, specs: list[str]) -> None:
    """Take partitions out of the catalog; the files stay."""
    for i in range(0, len(specs), SPECS_AT_ONCE):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(f'PARTITION ({s})' for s in specs[i:i + SPECS_AT_ONCE])}")


def _insert(rows: DataFrame, table: str, partition: str, columns: list[str]) -> None:
    view = f"rows_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    try:
        rows.sparkSession.sql(f"INSERT INTO {table} PARTITION ({partition}) SELECT {', '.join(f'`{c}`' for c in columns)} FROM {view}")
    finally:
        rows.sparkSession.catalog.dropTempView(view)


def change_batch(rows: DataFrame, deletes: DataFrame | None = None) -> DataFrame:
    """Lake rows of one batch with the delete flag: good rows, plus delete rows."""
    out = rows.withColumn(DELETE_FLAG, F.lit(False))
    if deletes is not None:
        out = out.unionByName(deletes.withColumn(DELETE_FLAG, F.lit(True)))
    return out


def apply_changes(spark: SparkSession, spec: TableSpec, batch: DataFrame, batch_id: int, compact_after: bool = True) -> None:
    """TBL-1 / TBL-5: precombine one batch and publish it as partition ``batch_id`` of the changes.

    A batch that is published is not written again; one that is already folded
    in and comes once more changes no row. A batch with a column of another
    type than the table's is refused before anything is written. ``batch`` holds
    lake rows with position columns and ``_is_delete``. Under
    ``deletes="ignore"`` delete rows are discarded before the write. The
    in-batch precombine is a partial + final aggregate (skew-safe).
    """
    if DELETE_FLAG not in batch.columns:
        batch = batch.withColumn(DELETE_FLAG, F.lit(False))
    if spec.deletes == "ignore":
        batch = batch.filter(~F.col(DELETE_FLAG))
    _reconcile(spark, spec, batch.schema)
    if batch_id not in pending_batches(spark, spec):
        names = [f.name for f in _data_fields(spark, spec)]
        pre = precombine(batch, spec.merge_keys, spec.order)
        missing = {f.name: F.lit(None).cast(f.dataType) for f in _data_fields(spark, spec) if f.name not in pre.columns}
        pre = pre.withColumns({**missing, BUCKET: spec.bucket})  # as many tasks as the batch takes, each with a file of each bucket
        fs.delete(spark, f"{spec.root}/changes/batch_id={batch_id}")  # what an attempt left that wasn't published
        stored = [c for c in spark.table(spec.table("changes")).columns if c != "batch_id"]
        assert set(stored) == {*names, BUCKET}
        _insert(pre, spec.table("changes"), f"batch_id = {batch_id}", stored)
    if compact_after and spec.min_deltas and len(pending_batches(spark, spec)) >= spec.min_deltas:
        compact(spark, spec)


def _in_cells(spec: TableSpec, cells: set[tuple[str | None, int]]) -> Column:
    """A predicate on partition columns alone, so that the scan lists and reads these cells only."""
    name = F.concat_ws("/", F.col(BUCKET).cast("string"), F.coalesce(F.concat(F.lit("="), F.col(spec.partition)), F.lit("null")))
    return name.isin(sorted(f"{b}/{'null' if p is None else '=' + p}" for p, b in cells))


def _both(spark: SparkSession, spec: TableSpec, base: DataFrame, changes: DataFrame) -> DataFrame:
    """Rows of base and changes. The base comes as it is: a projection on it would hide that both are dealt alike."""
    return base.union(changes.select(*[F.col("batch_id") if c == VERSION else F.col(c) for c in base.columns]))


def located(spark: SparkSession, spec: TableSpec, keys: DataFrame, cells: list[Cell] | None = None) -> DataFrame:
    """(key, partition, _bucket): where the base holds ``keys``; reads the key column of cells that the index names.

    Global key scope only. A cell without index rows (a compaction stopped
    before it wrote them) is read too.
    """
    cells = _cells(spark, spec) if cells is None else cells
    asked = keys.select(spec.key).distinct().withColumn(BUCKET, spec.bucket)
    columns = [VERSION, spec.partition, BUCKET]
    live = spark.createDataFrame(cells, f"{VERSION} bigint, `{spec.partition}` string, {BUCKET} int")
    index = spark.table(spec.table("keys")).alias("k").join(
        live.alias("l"), (F.col(f"k.{VERSION}") == F.col(f"l.{VERSION}")) & (F.col(f"k.{BUCKET}") == F.col(f"l.{BUCKET}"))
        & F.col(f"k.{spec.partition}").eqNullSafe(F.col(f"l.{spec.partition}")), "left_semi")
    named = {tuple(r) for r in probe_index(index, asked, spec.key, columns, BUCKET).collect()}  # cells: metadata
    indexed = {tuple(r) for r in index.select(*columns).distinct().collect()}
    read = {(p, b) for v, p, b in cells if (v, p, b) in named or (v, p, b) not in indexed}
    held = spark.table(spec.table("base")).filter(_in_cells(spec, read)).select(spec.key, spec.partition, BUCKET)
    return held.join(asked.select(spec.key), spec.key, "left_semi").distinct()


def compact(spark: SparkSession, spec: TableSpec) -> TableState:
    """TBL-3 / SNK-3: fold the pending batches into a new base version.

    Only cells that the batches touch are read and rewritten. Under the global
    key scope a key that moved to another day leaves its old cell, which the key
    index finds. Delete winners stay in the base as markers so that an older
    late row cannot resurrect the key.
    """
    state = read_state(spark, spec)
    if not state.pending:
        return state
    version = max([state.pending[-1], *(v + 1 for v, _, _ in state.cells)])
    changes = spark.table(spec.table("changes")).filter(F.col("batch_id").isin(state.pending))
    touched = {tuple(r) for r in changes.select(spec.partition, BUCKET).distinct().collect()}
    if spec.key_scope == "global" and touched:
        touched |= {tuple(r) for r in located(spark, spec, changes, state.cells).select(spec.partition, BUCKET).distinct().collect()}
    old = [(v, p, b) for v, p, b in state.cells if (p, b) in touched]
    if touched:
        base = spark.table(spec.table("base")).filter(_in_cells(spec, {(p, b) for _, p, b in old}))
        rows, keys = _both(spark, spec, base, changes), spec.merge_keys
        if spec.key_scope == "partition":
            # Dealt by cell, not by bucket: there are days times as many, and a cell is still written by one task.
            rows, keys = rows.repartition(spec.partition, BUCKET), [spec.partition, BUCKET, spec.key]
        merged = precombine(rows, keys, spec.order)
        names = [f.name for f in _data_fields(spark, spec)]
        fs.delete(spark, f"{spec.root}/base/{VERSION}={version}")  # of an attempt that never reached the catalog
        _insert(merged, spec.table("base"), f"{VERSION} = {version}, `{spec.partition}`, {BUCKET}", [*names, BUCKET])
        if spec.key_scope == "global":
            spark.catalog.refreshTable(spec.table("base"))
            rows = spark.table(spec.table("base")).filter(F.col(VERSION) == version)
            _insert(build_index(rows, spec.key, [spec.partition, BUCKET]), spec.table("keys"), f"{VERSION} = {version}",
                    [spec.partition, BUCKET, "lanes", "lane", "bits"])
    _drop(spark, spec.table("changes"), [f"batch_id = {b}" for b in state.pending])
    _drop(spark, spec.table("base"), [f"{VERSION} = {v}, `{spec.partition}` = {'null' if p is None else _quoted(p)}, {BUCKET} = {b}" for v, p, b in old])
    after = read_state(spark, spec)
    if spec.key_scope == "global":
        gone = {v for v, _, _ in old} - {v for v, _, _ in after.cells}
        _drop(spark, spec.table("keys"), [f"{VERSION} = {v}" for v in sorted(gone)])
    return after


def _latest_sql(spec: TableSpec, names: list[str], rows: str, internal: bool = False) -> str:
    """The newest row of each key, deletes left out, as a query that a view can hold."""
    values = [c for c in [*names, BUCKET] if c not in spec.merge_keys]
    out = [f"`{c}`" if c in spec.merge_keys else f"_w.`{c}` AS `{c}`" for c in ([*names, BUCKET] if internal else [c for c in names if c not in INTERNAL])]
    struct = lambda cols: f"struct({', '.join(f'`{c}`' for c in cols)})"
    keys = ", ".join(f"`{k}`" for k in spec.merge_keys)
    return (f"SELECT {', '.join(out)} FROM (SELECT {keys}, max_by({struct(values)}, {struct(spec.order)}) AS _w FROM ({rows}) GROUP BY {keys}) "
            f"WHERE NOT _w.`{DELETE_FLAG}`")


def _view_sql(spark: SparkSession, spec: TableSpec, snapshot: bool, internal: bool = False) -> str:
    base = spec.table("base")
    rows = f"SELECT * FROM {base}"
    if snapshot:
        columns = [f"batch_id AS {VERSION}" if c == VERSION else f"`{c}`" for c in spark.table(base).columns]
        rows += f" UNION ALL SELECT {', '.join(columns)} FROM {spec.table('changes')}"
    return _latest_sql(spec, [f.name for f in _data_fields(spark, spec)], rows, internal)


def snapshot_view(spark: SparkSession, spec: TableSpec, as_of_batch: int | None = None, internal: bool = False) -> DataFrame:
    """SRC-4 (``_rt``): base ∪ pending changes, latest per key, deletes removed.

    ``as_of_batch`` reads the state after that batch from the files that
    ``clean`` has kept.
    """
    _open(spark, spec)
    if as_of_batch is None:
        return spark.sql(_view_sql(spark, spec, True, internal))
    names = [f.name for f in _data_fields(spark, spec)]
    kept = [kept_rows(spark, spec, kind).filter(F.col(n) <= as_of_batch).select(*names, BUCKET)
            for kind, n in (("base", VERSION), ("changes", "batch_id")) if fs.list_dir(spark, f"{spec.root}/{kind}")]
    rows = kept[0] if len(kept) == 1 else kept[0].unionByName(kept[1])
    out = precombine(rows, spec.merge_keys, spec.order).filter(~F.col(DELETE_FLAG))
    return out if internal else out.drop(*INTERNAL)


def read_optimized_view(spark: SparkSession, spec: TableSpec, internal: bool = False) -> DataFrame:
    """SRC-5 (``_ro``): compacted base only; rows of uncompacted batches are not visible."""
    _open(spark, spec)
    return spark.sql(_view_sql(spark, spec, False, internal))


def kept_rows(spark: SparkSession, spec: TableSpec, kind: str) -> DataFrame:
    """Rows of all versions ("base") or batches ("changes") whose files are still there."""
    schema = spark.table(spec.table(kind)).schema
    return spark.read.schema(schema).parquet(f"{spec.root}/{kind}")


def commit_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """(kind, version, dt): what each commit wrote whose files are still there."""
    _open(spark, spec)
    base = kept_rows(spark, spec, "base").select(F.lit("base").alias("kind"), F.col(VERSION).alias("version"), F.col(spec.partition).alias("dt"))
    delta = kept_rows(spark, spec, "changes").select(F.lit("delta").alias("kind"), F.col("batch_id").alias("version"), F.col(spec.partition).alias("dt"))
    return base.distinct().unionByName(delta.distinct())


def kept_folders(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """(kind, version, dt, bucket, path): folders of versions and batches that are still there, by listing."""
    found = []
    for kind, name in (("base", VERSION), ("changes", "batch_id")):
        for folder, _, _, is_dir in fs.list_dir(spark, f"{spec.root}/{kind}"):
            if is_dir and folder.startswith(f"{name}="):  # not what a writer has not committed yet
                top = f"{spec.root}/{kind}/{folder}"
                found += [(kind, top)] if kind == "changes" else [
                    (kind, path) for path in {f.rsplit("/", 1)[0] for f, _, _ in fs.list_files_recursive(spark, top)}]
    part = lambda name: F.nullif(F.url_decode(F.regexp_extract("path", f"/{name}=([^/]*)", 1)), F.lit(""))
    return spark.createDataFrame(found, "kind string, path string").select(
        F.when(F.col("kind") == "base", F.lit("base")).otherwise(F.lit("delta")).alias("kind"),
        F.coalesce(part(VERSION), part("batch_id")).cast("bigint").alias("version"),
        F.nullif(part(spec.partition), F.lit(DEFAULT_PARTITION)).alias("dt"), part(BUCKET).cast("int").alias("bucket"), "path")


def expired_versions(spark: SparkSession, spec: TableSpec, retain: int = 2) -> DataFrame:
    """TBL-4: folders no longer needed by the last ``retain`` versions, as (kind, version, dt, bucket, path).

    A retained version reads, for each cell, the newest base version up to
    itself; other cells are expired, and so are batches up to the oldest
    retained version. What the catalog names is never expired.
    """
    state = read_state(spark, spec)
    folders = kept_folders(spark, spec)
    base = folders.filter("kind = 'base'")
    kept = sorted(r[0] for r in base.select("version").distinct().collect())[-retain:]
    if not kept:
        return folders.limit(0)
    readers = base.withColumn("reader", F.explode(F.array(*[F.lit(v) for v in kept]))).filter("version <= reader")
    needed = readers.groupBy("reader", "dt", "bucket").agg(F.max("version").alias("version")).select("version", "dt", "bucket")
    live = spark.createDataFrame(state.cells, "version bigint, dt string, bucket int")
    needed = needed.unionByName(live).distinct().alias("n")
    same = (F.col("b.version") == F.col("n.version")) & F.col("b.dt").eqNullSafe(F.col("n.dt")) & (F.col("b.bucket") == F.col("n.bucket"))
    delta = folders.filter((F.col("kind") == "delta") & (F.col("version") <= kept[0]) & ~F.col("version").isin(state.pending or [-1]))
    return base.alias("b").join(needed, same, "left_anti").unionByName(delta)


def clean(spark: SparkSession, spec: TableSpec, retain: int = 2, dry_run: bool = True) -> DataFrame:
    """What ``expired_versions`` lists; deleted unless ``dry_run``. The list is bounded by cells x versions."""
    expired = expired_versions(spark, spec, retain)
    if not dry_run:
        for r in expired.select("path").collect():
            fs.delete(spark, r["path"])
    return expired


def register_table(spark: SparkSession, spec: TableSpec, name: str) -> None:
    """SNK-4 / TBL-8: the catalog views ``<name>_rt`` (snapshot) and ``<name>_ro`` (read-optimised).

    They name the two tables, so a query sees what the catalog names when it
    runs, in every session and application that shares the catalog.
    """
    _open(spark, spec)
    names = {*_views(spark, spec), name}
    spark.sql(f"ALTER TABLE {spec.table('base')} SET TBLPROPERTIES ('views' = '{','.join(sorted(names))}')")
    refresh_views(spark, spec)


def _views(spark: SparkSession, spec: TableSpec) -> list[str]:
    found = [r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {spec.table('base')}").collect() if r["key"] == "views"]
    return found[0].split(",") if found else []


def refresh_views(spark: SparkSession, spec: TableSpec) -> None:
    """Write the table's views anew, for columns that were added."""
    for name in _views(spark, spec):
        spark.sql(f"CREATE OR REPLACE VIEW {name}_rt AS {_view_sql(spark, spec, True)}")
        spark.sql(f"CREATE OR REPLACE VIEW {name}_ro AS {_view_sql(spark, spec, False)}")
