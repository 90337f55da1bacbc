"""Idempotent keyed loads: INSERT ... ON CONFLICT (key) DO NOTHING for a Parquet table.

Within a batch the first row of a key wins, in input order (the order in which Spark reads the batch: within a file,
row by row). The batch is written once to the shared folder with its row numbers, so it is parsed once; the first row
of every key is found by a hash aggregation of the row number (map-side combined, so a key that holds a third of the
batch is reduced in every task). Keys already in the table are skipped with a semi-join and an anti-join, and the new
rows are appended as one new `load_id` partition. All of this is done on keys and row numbers; whole rows are filtered
by the shorter list of numbers, of those that stay or of those that go, and are not moved at all if all stay.

Lookup. Files are sorted by the first key column and carry Parquet bloom filters on it. A batch of up to PUSHED rows
hands its keys to the scan as an IN list, which the reader checks against the bloom filters and the value bounds of
every row group: keys that the table lacks, the usual case, cost the filters (about 4 bytes a stored key) and no data. A
larger batch hands over the bounds of its keys. Either way the semi-join decides.

Recovery. The table itself decides what is loaded; the small table beside it (`<path>__loads`, one row per load) only
saves scans. A load that died after its rows and before its entry is seen by its `load_id` folder: the next load takes
its row count, its load number and the last surrogate id from the data. A micro-batch of a stream is named, the name is
stored with its rows and in the entry: replayed after its entry it does nothing and returns that entry; replayed before,
it adds what is missing under the same load number, so its entry counts every row once. One writer at a time per table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import materialize

LOAD_ID = "load_id"
BATCH = "load_batch"     # the micro-batch that a row came with
POSITION = "__pos"
PUSHED = 10_000          # rows of a batch whose keys become literals of the lookup's scan
SMALL = 500_000          # rows of a batch that are brought together in few files
NDV = 1 << 20            # distinct keys that a row group's bloom filter is sized for, at most
FALSE = "1e-6"           # share of absent keys that a filter lets pass: PUSHED of them pass a row group once in 100
FILTER = 8 << 20         # bytes of a filter, at most (NDV keys take 3.6 MB)
STATS_SCHEMA = "load_id int, attempted long, inserted long, skipped long, rows_before long, rows_after long"
LOADS_SCHEMA = STATS_SCHEMA + ", last_id long, load_batch string"


@dataclass(frozen=True)
class LoadStats:
    load_id: int
    attempted: int
    inserted: int
    skipped: int
    rows_before: int
    rows_after: int


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return fs.exists(p) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def partition_values(spark: SparkSession, path: str, column: str) -> list[int]:
    """Integer values of the table's first partition column, from one directory listing (no data read)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(column + "="))


def counter() -> Observation:
    return Observation(f"rows_{uuid.uuid4().hex}")


def counted(rows: Observation) -> int:
    """The rows counted while they were written. A plan that turns out to be empty is optimised away together with
    its counter, which then has no row to return."""
    try:
        return int(rows.get.get("n", 0) or 0)
    except Py4JJavaError:
        return 0


@dataclass(frozen=True)
class State:
    """Where a table stands: its newest load, its rows, its last surrogate id, and what of that is in the load table."""
    load_id: int
    rows: int
    last_id: int
    logged: int


def loads(spark: SparkSession, path: str) -> DataFrame:
    """The load table, empty if there is none."""
    fs, p = _fs_path(spark, f"{path}__loads")
    if not fs.exists(p):
        return spark.createDataFrame([], LOADS_SCHEMA)
    return spark.read.schema(LOADS_SCHEMA).parquet(f"{path}__loads")


def _stats(row: Row) -> LoadStats:
    return LoadStats(row.load_id, row.attempted, row.inserted, row.skipped, row.rows_before, row.rows_after)


def last_load(spark: SparkSession, path: str) -> LoadStats | None:
    """The newest entry of the load table."""
    row = loads(spark, path).orderBy(F.desc("load_id")).first()
    return _stats(row) if row else None


def _newest_on_disk(spark: SparkSession, path: str) -> int:
    """The largest load number that has a folder (a listing of folders, no data read)."""
    jvm = spark.sparkContext._jvm
    fs, _ = _fs_path(spark, path)
    found = [0]
    for pattern in (f"{path}/{LOAD_ID}=*", f"{path}/*/{LOAD_ID}=*"):
        for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(pattern)) or []:
            found.append(int(status.getPath().getName().split("=", 1)[1]))
    return max(found)


def state(spark: SparkSession, path: str, surrogate: str | None = None) -> State:
    """From the load table; from the data where a load has left rows but no entry."""
    row = loads(spark, path).orderBy(F.desc("load_id")).first()
    logged = row.load_id if row else 0
    newest = _newest_on_disk(spark, path)
    if newest <= logged:
        return State(logged, row.rows_after, row.rows_after if row.last_id is None else row.last_id, logged) if row \
            else State(0, 0, 0, 0)
    last = F.max(surrogate) if surrogate else F.lit(None).cast("bigint")
    columns = f"{LOAD_ID} int" + (f", {surrogate} long" if surrogate else "")
    found = spark.read.schema(columns).parquet(path).agg(F.count(F.lit(1)).alias("n"), last.alias("last")).first()
    return State(newest, found.n, found.n if found["last"] is None else found["last"], logged)


def hits(spark: SparkSession, path: str, batch: DataFrame, look: Sequence[str], key: str, rows: int) -> DataFrame:
    """The keys (columns `look`) of the table at `path` that are in `batch`, which has `rows` rows."""
    stored = spark.read.schema(batch.select(*look).schema).parquet(path)      # the columns of the lookup alone
    if rows <= PUSHED:
        stored = stored.where(F.col(key).isin([r[0] for r in batch.select(key).collect() if r[0] is not None]))
    else:
        low, high = batch.agg(F.min(key), F.max(key)).first()
        stored = stored.where(F.col(key).between(F.lit(low), F.lit(high)))
    return stored.join(batch.select(*look), list(look), "left_semi")


def first_positions(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None,
                    position: str = POSITION, also: str | None = None) -> DataFrame:
    """Keys and position of the first row of every key (and its column `also`): the smallest `position` (a unique number),
    or the first by `order_by` where the input's order is that of columns. Rows of a NULL key are left out."""
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    more = [also] if also and also not in keys else []
    found = rows.groupBy(*keys).agg(F.min(position).alias(position), F.count(F.lit(1)).alias("__n"),
                                    *[F.min_by(c, position).alias(c) for c in more])
    if not order_by:
        return found.drop("__n")
    # only keys that occur repeatedly need their rows compared
    again = rows.join(found.where("__n > 1").select(*keys), list(keys), "left_semi")
    order = F.struct(*order_by, position)
    picked = again.groupBy(*keys).agg(F.min_by(position, order).alias(position),
                                      *[F.min_by(c, order).alias(c) for c in more])
    return found.where("__n = 1").drop("__n").unionByName(picked)


def first_per_key(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None,
                  position: str = POSITION) -> DataFrame:
    """The first row of every key, as `first_positions` says."""
    first = first_positions(rows, keys, order_by, position).select(position)
    return rows.join(first, position, "left_semi")


def _only(staged: DataFrame, kept: DataFrame, total: int) -> tuple[DataFrame, bool]:
    """The rows of `staged` (`total` rows) at the positions of `kept`, and whether these are all. Whole rows are joined with
    the shorter list: the positions kept, or those dropped."""
    rows = counter()
    kept = materialize(kept.select(POSITION).observe(rows, F.count(F.lit(1)).alias("n")), "kept")
    n = counted(rows)
    if n == total:
        return staged, True
    if 2 * n <= total:
        return staged.join(kept, POSITION, "left_semi"), False
    dropped = materialize(staged.select(POSITION).join(kept, POSITION, "left_anti"), "dropped")
    return staged.join(dropped, POSITION, "left_anti"), False


def _numbered(new: DataFrame, offset: int, column: str, whole: bool = False) -> DataFrame:
    """`new` with dense numbers offset + 1, offset + 2, ... as `column`: row numbers within the written partitions, plus
    the partitions' sizes before (a row per partition, a bound that the writing job sets). `whole`: `new` is a written
    batch with all its rows, so their positions are such numbers already; other rows are written for it."""
    mono = F.monotonically_increasing_id()
    rows = new.withColumn("__m", F.col(POSITION)) if whole else materialize(new.withColumn("__m", mono), "new_rows")
    part, inside = F.shiftright("__m", 33), F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = rows.groupBy(part.alias("__p")).agg(F.max(inside + 1).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("__p", F.coalesce(before, F.lit(0)).alias("__before"))
    number = (inside + F.col("__before") + F.lit(offset + 1)).cast("bigint")
    return rows.join(F.broadcast(sizes), part == F.col("__p")).withColumn(column, number).drop("__m", "__p", "__before")


def keyed_append(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    loaded_at: dt.datetime | None = None,
    order_by: Sequence[str] | None = None,
    prune_col: str | None = None,
    surrogate: str | None = None,
    batch_name: str | None = None,
) -> LoadStats:
    """Append the rows of `batch` whose key is not yet in the table at `path`. Rows with a NULL key are not
    loadable (the key columns are NOT NULL) and count as skipped.

    `prune_col` names a column of the batch that is a function of the key (for alerts: the day of the alert, since
    the id hashes the alert's time). The table is then partitioned by it and the existing keys are looked up on
    (prune_col, keys), so dynamic partition pruning reads only the partitions the batch touches. `surrogate` names a
    column that gets dense numbers over all loads (after a load that died, numbers may be left out, never given twice).
    `batch_name` names a micro-batch: given again, it is not loaded again.
    """
    if batch_name:
        done = loads(spark, path).where(F.col(BATCH) == batch_name).first()
        if done:
            return _stats(done)
    at = state(spark, path, surrogate)
    load_id, before, kept = at.load_id + 1, at.rows, 0
    if batch_name and at.load_id > at.logged:          # rows of a load without an entry: are they this batch's?
        mark = spark.read.schema(f"{BATCH} string, {LOAD_ID} int").parquet(path)
        kept = mark.where((F.col(LOAD_ID) == at.load_id) & (F.col(BATCH) == batch_name)).count()
        if kept:
            load_id, before = at.load_id, at.rows - kept
    seen, new = counter(), counter()
    staged = materialize(batch.observe(seen, F.count(F.lit(1)).alias("n"))
                         .withColumn(POSITION, F.monotonically_increasing_id()), "batch")
    attempted = counted(seen)
    kept_rows = first_positions(staged, keys, order_by, also=prune_col)
    if at.rows:
        # The table grows every day, the batch does not: find the batch's keys in the table, then drop them.
        look = list(dict.fromkeys(([prune_col] if prune_col else []) + list(keys)))
        kept_rows = kept_rows.join(hits(spark, path, staged, look, keys[0], attempted), look, "left_anti")
    firsts, whole = _only(staged, kept_rows, attempted)
    if surrogate:
        firsts = _numbered(firsts, at.last_id, surrogate, whole)
    firsts = firsts.drop(POSITION)
    stored = {"loaded_at": F.lit(loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).cast("timestamp"),
              LOAD_ID: F.lit(load_id)}
    if batch_name:
        stored[BATCH] = F.lit(batch_name)
    rows = firsts.observe(new, F.count(F.lit(1)).alias("n")).withColumns(stored)
    # Rebalanced on the partition column (a day's rows come together in few files, a large day is split), each file in
    # the order of the first key, which the bloom filters are on. Without one, a small load's rows come together; a large
    # one's files are those of the written batch.
    folders = ([prune_col] if prune_col else []) + [LOAD_ID]
    if prune_col or attempted <= SMALL:
        rows = rows.hint("rebalance", *([prune_col] if prune_col else []))
    rows = rows.sortWithinPartitions(*folders, *[k for k in keys if k not in folders])
    (rows.write.mode("append").partitionBy(*folders)
     .option(f"parquet.bloom.filter.enabled#{keys[0]}", "true")
     .option(f"parquet.bloom.filter.expected.ndv#{keys[0]}", str(max(1, min(attempted, NDV))))
     .option(f"parquet.bloom.filter.fpp#{keys[0]}", FALSE)
     .option("parquet.bloom.filter.max.bytes", str(FILTER)).parquet(path))
    fresh = counted(new)
    inserted = kept + fresh
    stats = LoadStats(load_id, attempted, inserted, attempted - inserted, before, before + inserted)
    entry = stats_frame(spark, [stats]).withColumns({
        "last_id": F.lit(at.last_id + fresh if surrogate else None).cast("long"), BATCH: F.lit(batch_name).cast("string")})
    entry.coalesce(1).write.mode("append").parquet(f"{path}__loads")
    return stats


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The table; with the declared `schema`, empty if nothing has been loaded yet."""
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path) if table_exists(spark, path) else spark.createDataFrame([], schema)


def table_schema(batch: DataFrame, surrogate: str | None = None) -> StructType:
    """The schema of a table that batches like this one are loaded into."""
    own = batch.withColumn(surrogate, F.lit(None).cast("bigint")) if surrogate else batch
    return own.withColumn("loaded_at", F.lit(None).cast("timestamp")).withColumn(LOAD_ID, F.lit(None).cast("int")).schema


def stats_frame(spark: SparkSession, stats: Sequence[LoadStats]) -> DataFrame:
    return spark.createDataFrame(
        [(s.load_id, s.attempted, s.inserted, s.skipped, s.rows_before, s.rows_after) for s in stats], STATS_SCHEMA)


def attempted_by_source(batch: DataFrame, source: str = "source") -> DataFrame:
    return batch.groupBy(source).agg(F.count(F.lit(1)).alias("rows_attempted"))
