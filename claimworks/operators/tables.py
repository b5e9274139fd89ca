"""Writing managed or external tables of a plain file format.

A table is known by its name in the session catalog; ``location`` makes it external. Writes into
a partitioned table go through a REBALANCE on the partition columns, so adaptive execution merges
small shuffle blocks into files near the advisory size and splits a partition that holds much of
the data over many tasks, which a plain repartition on those columns would not.

Rows that replace others are written once, to a folder of their own, and then put in place through
the catalog: each partition, or an unpartitioned table, gets its new folder as location and the old
files are deleted. A reader finds a partition either old or new. Read tables by name: the catalog
knows where their partitions lie.

The shuffle files of a write go when it has ended, so a job of many writes needs disk for the
largest of them and not for all.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimworks.session import remove_scratch, scratch_path, shuffles_freed

FORMAT = "parquet"


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    location: str | None = None,
    mode: str = "errorifexists",
    rebalance: bool = True,
    max_records_per_file: int | None = None,
) -> None:
    """First load; with ``mode="overwrite"`` a full refresh that may change the schema."""
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(FORMAT).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if location:
        writer = writer.option("path", location)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    with shuffles_freed(df.sparkSession):
        writer.saveAsTable(name)


def overwrite(df: DataFrame, name: str, location: str | None = None) -> None:
    """Full refresh, replacing rows and schema; ``df`` must not read ``name``."""
    create(df, name, location=location, mode="overwrite")


def clone_schema(df: DataFrame, name: str, location: str | None = None) -> None:
    """An empty table with the columns of ``df``."""
    create(df.limit(0), name, location=location, rebalance=False)


def append(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    location: str | None = None,
    rebalance: bool = False,
) -> None:
    """Append; a column new to the table is added to it, a column it lacks is written as NULL."""
    if not table_exists(df.sparkSession, name):
        create(df, name, partition_by, location, rebalance=rebalance)
        return
    aligned = _align(df, name)
    if rebalance:
        aligned = aligned.hint("rebalance", *partition_columns(df.sparkSession, name))
    with shuffles_freed(df.sparkSession):
        aligned.write.insertInto(name)


def replace_partitions(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str],
    location: str | None = None,
    rebalance: bool = False,
    emptied: Sequence[dict] = (),
) -> None:
    """Overwrite just the partitions that occur in ``df``; running it twice changes nothing. Those
    of ``emptied`` that get no row are dropped.

    ``rebalance`` adds a shuffle. Leave it off where the rows of one task belong to one
    partition anyhow, as in a load of one batch.
    """
    spark = df.sparkSession
    if not table_exists(spark, name):
        create(df, name, partition_by, location, rebalance=rebalance)
        return
    aligned = _align(df, name)
    _switch(aligned.hint("rebalance", *partition_by) if rebalance else aligned, name, emptied)


def remove_rows(spark: SparkSession, name: str, test: Column) -> None:
    """Delete the rows of a partitioned table for which ``test`` holds; without any, nothing is
    written. Only partitions with such rows are rewritten."""
    if not table_exists(spark, name):
        return
    spark.catalog.refreshTable(name)
    parts = partition_columns(spark, name)
    touched = [row.asDict() for row in spark.table(name).filter(test).select(*parts).distinct().collect()]
    if touched:
        kept = spark.table(name).filter(in_partitions(parts, touched)).filter(~F.coalesce(test, F.lit(False)))
        _switch(kept.hint("rebalance", *parts), name, touched)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _align(df: DataFrame, name: str) -> DataFrame:
    """Columns in table order. New ones are added to the table; a changed type is an error."""
    spark = df.sparkSession
    have = {f.name: f.dataType.simpleString() for f in spark.table(name).schema}
    changed = [f"{f.name}: {have[f.name]} -> {f.dataType.simpleString()}"
               for f in df.schema if f.name in have and have[f.name] != f.dataType.simpleString()]
    if changed:
        raise TypeError(f"column types of {name} may not change: {', '.join(changed)}")
    new = [f for f in df.schema if f.name not in have]
    if new:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({ddl})")
    return df.select(*[
        F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in spark.table(name).schema
    ])


# ---------------------------------------------------------------------------------------------
# Upsert
# ---------------------------------------------------------------------------------------------

class DuplicateKeyError(ValueError):
    """The source holds several rows for one key, so which one should win is not defined."""


def upsert(
    source: DataFrame,
    name: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    location: str | None = None,
    newer_than: str | None = None,
    unique: bool = False,
    stale: Column | None = None,
    cluster_by: Sequence[str] = (),
    announce: Callable[[list[dict]], None] | None = None,
    key_buckets: int = 0,
) -> list[dict]:
    """Rows with a known key replace the old ones, the others are added.

    Returns the partitions that were rewritten; none for an unpartitioned or new table.

    ``source`` is read several times: pass a table that has been written, not a long plan.
    ``newer_than`` names a column: a source row whose value is smaller than that of the row it
    would replace is left out, so that running an old batch again keeps newer rows. ``unique``
    says that no key occurs twice in the source, which is checked otherwise. ``stale`` is a test
    on target rows that must not outlive this upsert: those for which it holds and whose key the
    source lacks are removed, for example rows an earlier run of the same batch had written.
    ``cluster_by`` sorts rows as ``cluster`` does, interleaved. ``announce`` is told the partitions, those of a
    new table too, before the first one changes. With ``key_buckets`` old copies are looked for in the
    partitions that the key index names (``key_index_of``), and the upsert keeps the index; the table
    must then be changed by such upserts only.

    Plain files have no row-level update, so partitions are rewritten, and only those that hold
    a source row or the old copy of one. Old copies are looked up once, in the key, partition and
    version columns of the target, and kept as a small table of their own. The list of partitions
    comes to the driver, as the catalog's own list does; rows never do. Each row of a touched
    partition is written once. The switch is not atomic across partitions: after a crash between
    two of them the same upsert, run again, finds what is left to do.
    """
    spark = source.sparkSession
    keys = list(keys)
    if not unique:
        _reject_duplicates(source, keys)
    if not table_exists(spark, name):
        if announce and partition_by:
            announce([row.asDict() for row in source.select(*partition_by).distinct().collect()])
        if key_buckets and partition_by:
            _index_keys(source, name, keys, partition_by, key_buckets, location)
        rows = _sorted(source, partition_by, cluster_by, first=interleaved(source, cluster_by)) if cluster_by else source
        create(rows, name, partition_by, location, rebalance=not cluster_by)
        return []
    spark.catalog.refreshTable(name)  # another session may have rewritten files
    source = given = _align(source, name)
    target = spark.table(name)
    parts = partition_columns(spark, name)

    wanted = dict.fromkeys([*keys, *parts, *([newer_than] if newer_than else [])])
    searched = target
    if key_buckets and parts:
        if not table_exists(spark, key_index_of(name)):
            _index_keys(target, name, keys, parts, key_buckets, location)
        places = indexed(source, name, keys, key_buckets).select(*parts).distinct().collect()
        searched = target.filter(in_partitions(parts, [row.asDict() for row in places]))
    if newer_than:
        new = source.select(*keys, F.col(newer_than).alias("_new_version"))
        replaced = F.col(newer_than).isNull() | (F.col("_new_version") >= F.col(newer_than))
        looked_up = staged(searched.select(*wanted).join(new, keys).select(
            *wanted, F.coalesce(replaced, F.lit(False)).alias("_replaced")))
        held = looked_up.filter("_replaced")
        if not looked_up.filter("NOT _replaced").isEmpty():  # else no source row has to be compared
            source = staged(_without_stale(source, looked_up, keys, newer_than))  # a join of whole rows, read as often as the source
    else:
        looked_up = held = staged(searched.select(*wanted).join(source.select(*keys), keys, "left_semi"))
    touched: list[dict] = []
    if parts:
        places = source.select(*parts).distinct().union(held.select(*parts).distinct())
        if stale is not None:
            places = places.union(target.filter(stale).select(*parts).distinct())
        touched = [row.asDict() for row in places.distinct().collect()]
        if not touched:
            release(looked_up, *([source] if source is not given else []))
            return []
        target = target.filter(in_partitions(parts, touched))
        if announce:
            announce(touched)
    if key_buckets and parts:  # before any row moves: an index may name too many places, never too few
        _index_keys(source, name, keys, parts, key_buckets, location)
    kept = target if held.isEmpty() else target.join(held.select(*keys), keys, "left_anti")
    if stale is not None:
        kept = kept.filter(~F.coalesce(stale, F.lit(False)))
    rows = kept.unionByName(source)
    if parts:
        turns = interleaved(given, cluster_by) if cluster_by else None
        rows = _sorted(rows, parts, cluster_by, first=turns) if cluster_by else rows.hint("rebalance", *parts)
    _switch(rows, name, touched)
    release(looked_up, *([source] if source is not given else []))
    return touched


def key_index_of(name: str) -> str:
    """Name of the key index of a table: keys, the partition each may lie in, and the key's bucket, by
    which the index is partitioned."""
    return f"{name}_keys"


_BUCKET = "key_bucket"


def indexed(source: DataFrame, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """The index rows of the keys of ``source``. Only their buckets are read."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(_BUCKET)
    index = source.sparkSession.table(key_index_of(name))
    touched = [row.asDict() for row in source.select(bucket).distinct().collect()]
    return index.filter(in_partitions([_BUCKET], touched)).join(source.select(*keys), list(keys), "left_semi")


def _index_keys(rows: DataFrame, name: str, keys: Sequence[str], parts: Sequence[str], buckets: int, location: str | None) -> None:
    """Add where the keys of ``rows`` lie to the index. What it says already is not written again."""
    index, spark = key_index_of(name), rows.sparkSession
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(_BUCKET)
    places = rows.dropna(subset=list(keys)).select(*dict.fromkeys([*keys, *parts]), bucket)
    if table_exists(spark, index):
        spark.catalog.refreshTable(index)
        known = indexed(rows, name, keys, buckets).select(*[F.col(c).alias(f"_{c}") for c in places.columns])
        same = F.lit(True)
        for c in places.columns:
            same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
        places = places.join(known, same, "left_anti")
    append(places, index, [_BUCKET], f"{location}_keys" if location else None, rebalance=True)


def rebuild_key_index(spark: SparkSession, name: str, keys: Sequence[str], buckets: int) -> None:
    """The index from the table itself: without places that keys have left, or with other buckets."""
    where = _folder(spark, key_index_of(name))
    table, bucket = spark.table(name), F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(_BUCKET)
    places = table.dropna(subset=list(keys)).select(*dict.fromkeys([*keys, *partition_columns(spark, name)]), bucket)
    create(places, key_index_of(name), [_BUCKET], where, mode="overwrite")


def _reject_duplicates(source: DataFrame, keys: list[str]) -> None:
    known = source.dropna(subset=keys)
    with shuffles_freed(source.sparkSession):
        double = known.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if double:
        raise DuplicateKeyError(f"several source rows for {double[0].asDict()}")


def _without_stale(source: DataFrame, held: DataFrame, keys: list[str], version: str) -> DataFrame:
    old = held.select(*keys, F.col(version).alias("_held_version"))
    return (source.join(old, keys, "left")
            .filter(F.col("_held_version").isNull() | (F.col(version) >= F.col("_held_version")))
            .select(*source.columns))


def in_partitions(parts: list[str], values: list) -> Column:
    """Test on the bare partition columns, resolved from the catalog before any file is opened.

    One list of last values per combination of leading ones, joined as a balanced tree: deep
    chains of conditions overflow the stack of the planner.
    """
    *leading, last = parts
    groups: dict[tuple, list] = {}
    for row in values:
        groups.setdefault(tuple(row[p] for p in leading), []).append(row[last])
    tests = []
    for key, found in groups.items():
        known = [v for v in found if v is not None]
        test = F.col(last).isin(known) if known else F.lit(False)
        if len(known) < len(found):
            test = test | F.col(last).isNull()
        for part, value in zip(leading, key):
            test = test & (F.col(part).isNull() if value is None else F.col(part) == F.lit(value))
        tests.append(test)
    return _any(tests)


def _any(tests: list[Column]) -> Column:
    if len(tests) < 2:
        return tests[0] if tests else F.lit(False)
    return _any(tests[:len(tests) // 2]) | _any(tests[len(tests) // 2:])


def staged(df: DataFrame) -> DataFrame:
    """Written to a new path of the shared folder and read back.

    For rows that are read more than once: lineage is cut, nothing is computed twice, and a lost
    executor loses no result. No shuffle is added. The caller owns the files: they stay until it
    removes them (``release``) or the folder is cleared.
    """
    path = scratch_path(df.sparkSession, "stage")
    with shuffles_freed(df.sparkSession):
        df.write.format(FORMAT).save(path)
    return df.sparkSession.read.schema(df.schema).format(FORMAT).load(path)


def local_copy(df: DataFrame) -> DataFrame:
    """The few rows of a log entry, fixed before the tables they were read from change."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema).coalesce(1)


def release(*frames: DataFrame) -> None:
    """Remove the files behind frames that ``staged`` gave, once nothing reads them any more."""
    for df in frames:
        remove_scratch(df.sparkSession, *{f.rsplit("/", 1)[0] for f in df.inputFiles()[:1]})


# ---------------------------------------------------------------------------------------------
# Switch
# ---------------------------------------------------------------------------------------------

_VERSION = "version-"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed: folder of rows without a partition value


def _switch(rows: DataFrame, name: str, touched: Sequence[dict] = ()) -> None:
    """Put ``rows`` in place of the partitions they fall into, or of all rows of an unpartitioned
    table; partitions of ``touched`` that get no row are dropped. ``rows`` may read the table.

    A crash before the end leaves each partition whole, old or new, and files that nothing names.
    """
    spark = rows.sparkSession
    table, parts, root = spark.table(name), partition_columns(spark, name), _folder(spark, name)
    path = f"{root}/{_VERSION}{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        rows.select(*table.columns).write.format(FORMAT).partitionBy(*parts).save(path)
    if parts:
        fields = {f.name: f.dataType for f in table.schema}
        filled = _partition_folders(spark, path, parts)
        new = {_spec(values, fields): folder for values, folder in filled}
        gone = [t for t in touched if _spec(t, fields) not in new]
        changed = [values for values, _ in filled] + gone
        old = table.filter(in_partitions(parts, changed)).inputFiles() if changed else []
        for spec, folder in new.items():
            _place(spark, name, spec, folder)
        for values in gone:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({_spec(values, fields)})")
    else:
        old = table.inputFiles()
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    _delete_files(spark, old, root)


def _place(spark: SparkSession, name: str, spec: str, folder: str) -> None:
    """Make a folder the place of a partition, new or not."""
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION '{folder}'")


def _folder(spark: SparkSession, name: str) -> str:
    """The folder of a table, also when one of its versions is its location."""
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"].rstrip("/")
    above, last = found.rsplit("/", 1)
    return above if last.startswith(_VERSION) else found


def _hadoop(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()


def _partition_folders(spark: SparkSession, path: str, parts: Sequence[str]) -> list[tuple[dict, str]]:
    """Partition values, as text, and folders under a path that was written by partitions."""
    hadoop, conf = _hadoop(spark)
    top = hadoop.Path(path)
    files, found = top.getFileSystem(conf), [({}, top)]
    for part in parts:
        below = [(values, f.getPath()) for values, folder in found for f in files.listStatus(folder) if f.isDirectory()]
        texts = [(values, f, f.getName().split("=", 1)[1]) for values, f in below]
        found = [({**values, part: None if text == _NO_VALUE else unquote(text)}, f) for values, f, text in texts]
    return [(values, f.toString().replace("'", "\\'")) for values, f in found]


def _delete_files(spark: SparkSession, uris: Sequence[str], root: str) -> None:
    """Delete data files of a table, with folders that hold nothing else; nothing outside its folder."""
    hadoop, conf = _hadoop(spark)
    top = hadoop.Path(root)
    files, inside = top.getFileSystem(conf), top.toUri().getPath()
    folders = {}
    for uri in uris:
        file = hadoop.Path(spark.sparkContext._jvm.java.net.URI(uri))
        if file.toUri().getPath().startswith(f"{inside}/"):
            files.delete(file, False)
            folders[file.getParent().toString()] = file.getParent()
    for folder in folders.values():
        while folder.toUri().getPath() != inside and files.exists(folder) and all(
                f.getPath().getName().startswith("_") and f.isFile() for f in files.listStatus(folder)):
            files.delete(folder, True)
            folder = folder.getParent()


def drop_partition(spark: SparkSession, name: str, partition: dict) -> None:
    """Remove a partition and its files, from external tables too."""
    table = spark.table(name)
    old = table.filter(in_partitions(list(partition), [partition])).inputFiles()
    spec = _spec(partition, {f.name: f.dataType for f in table.schema})
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
    spark.catalog.refreshTable(name)
    _delete_files(spark, old, _folder(spark, name))


def _spec(values: dict, fields: dict[str, T.DataType]) -> str:
    return ", ".join(f"`{c}` = {_sql_literal(v, fields[c])}" for c, v in values.items())


def _sql_literal(value, kind: T.DataType) -> str:
    if value is None:
        return "NULL"
    if isinstance(kind, T.NumericType):
        return str(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"DATE '{text}'" if isinstance(kind, T.DateType) else f"'{text}'"


# ---------------------------------------------------------------------------------------------
# File layout
# ---------------------------------------------------------------------------------------------

#: Bytes from which on, in the mean, files are not worth merging.
SMALL_FILE = 8 << 20


def has_small_files(spark: SparkSession, name: str, partition: dict) -> bool:
    """Whether a partition has several files that are small in the mean, so that merging them pays."""
    paths = spark.table(name).filter(in_partitions(list(partition), [partition])).inputFiles()
    hadoop, conf = _hadoop(spark)
    folders = [hadoop.Path(spark.sparkContext._jvm.java.net.URI(f)) for f in {p.rsplit("/", 1)[0] for p in paths}]
    size = sum(f.getFileSystem(conf).getContentSummary(f).getLength() for f in folders)
    return len(paths) > 1 and size < SMALL_FILE * len(paths)


def compact(spark: SparkSession, name: str, where: Sequence[dict] = ()) -> None:
    """Rewrite a table, or the partitions with the given partition values, into fewer files."""
    _rewrite(spark, name, where, lambda df, parts: df.hint("rebalance", *parts))


def cluster(
    spark: SparkSession,
    name: str,
    by: Sequence[str],
    where: Sequence[dict] = (),
    num_ranges: int | None = None,
    interleave: bool = False,
) -> None:
    """Rewrite with rows sorted by ``by``, so file and page statistics prune on those columns.

    Rows are ranged over the partition columns first: one hot partition is cut into many ranges
    and a file holds few partitions. A linear sort helps most on the first column; ``interleave``
    makes statistics prune on each of them.
    """
    def arrange(df: DataFrame, parts: list[str]) -> DataFrame:
        return _sorted(df, parts, by, num_ranges, interleaved(df, by) if interleave else None)

    _rewrite(spark, name, where, arrange)


_TURN = "_interleaved_turn"


def _sorted(df: DataFrame, parts: Sequence[str], by: Sequence[str], num_ranges: int | None = None,
            first: Column | None = None) -> DataFrame:
    keyed = df if first is None else df.withColumn(_TURN, first)  # a sort works an expression out again in each comparison
    order = [*parts, *([_TURN] if first is not None else []), *[c for c in by if c not in parts]]
    ranged = keyed.repartitionByRange(num_ranges, *order) if num_ranges else keyed.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).drop(_TURN)


#: Rows a column's ranges are taken from, at any size of the table, and bits of a range's number.
RANGE_SAMPLE, RANGE_BITS = 20_000, 4


def interleaved(df: DataFrame, by: Sequence[str], bits: int = RANGE_BITS, sample: int = RANGE_SAMPLE) -> Column:
    """A sort key in which the columns take turns, bit by bit.

    Each column counts by the range its value falls into. Ranges hold about equally many rows and
    are taken from a sample of bounded size, which decides on the layout and on no result.
    """
    rows = df.select(*by)
    picked = rows.sample(fraction=min(1.0, 2 * sample / max(1, rows.count())), seed=7).limit(sample).collect()
    ranks = []
    for c in by:
        values = sorted(row[c] for row in picked if row[c] is not None)
        bounds = dict.fromkeys(values[len(values) * i >> bits] for i in range(1, 1 << bits)) if values else {}
        above = [F.coalesce(F.col(c) >= F.lit(b), F.lit(False)).cast("int") for b in bounds]
        ranks.append(sum(above[1:], above[0]) if above else F.lit(0))
    turns = [F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long"), bit * len(by) + len(by) - 1 - i)
             for bit in range(bits) for i, rank in enumerate(ranks)]
    return sum(turns[1:], turns[0])


def _rewrite(spark: SparkSession, name: str, where: Sequence[dict], arrange) -> None:
    parts = partition_columns(spark, name)
    for partition in where:
        if set(partition) - set(parts):
            raise ValueError(f"{sorted(partition)} are not all partition columns of {name}")
    spark.catalog.refreshTable(name)
    df = spark.table(name)
    if where:
        df = df.filter(_any([in_partitions(list(partition), [partition]) for partition in where]))
    _switch(arrange(df, parts), name)
