"""Mart tables on a file system: dimensions in key buckets, facts in months.

Every write leaves a new folder ``data_part=...`` and a version that names the
folders which count (see ``versions``). A dimension's rows lie in buckets of
their key, and an upsert writes only the buckets its keys fall into. A fact lies
by the month of ``time_key``; rows without one form a month of their own.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from martflow.functions.dates import month_key
from martflow.operators import files, versions
from martflow.operators.upsert import CHANGE, change_counts, scd1_changes
from martflow.operators.versions import PART, Table, Version
from martflow.schemas import DIMENSIONS, FACTS, MART_TABLES, PRIMARY_KEYS, conform

MONTH = "month_key"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
BUCKET = "bucket"
#: A dimension gets a bucket for so many rows, in powers of two.
BUCKET_ROWS = 1 << 17


# --- versioned tables -------------------------------------------------------


def current_version(spark: SparkSession, path: str) -> int | None:
    """The number of the version that holds the table at ``path``."""
    store, name = versions.home(spark, path)
    present = versions.last(spark, store)
    return present.number if name in present.tables else None


def publish(df: DataFrame, path: str, after: int | None = None) -> int:
    """Write ``df`` as the table's next version; returns its number.

    ``after`` is the version that ``df`` was made from, by default the present
    one. If another writer has published since, this one fails and what it wrote
    is removed.
    """
    spark = df.sparkSession
    store, name = versions.home(spark, path)
    present = versions.last(spark, store)
    part = versions.new_part()
    df.write.parquet(f"{path}/{part}")

    def change(latest: Version) -> dict[str, Table]:
        if after is not None and latest.number != after:
            raise versions.Conflict(f"{path} has a version {latest.number} already: another writer came first")
        versions.unchanged(present, name)(latest)
        return {name: Table({part: None})}

    try:
        return versions.publish(spark, store, change).number
    except versions.Conflict:
        files.remove(spark, f"{path}/{part}")
        raise


def _read(spark: SparkSession, path: str, folders: list[str], schema: StructType, *by: str) -> DataFrame:
    """The rows of a table's folders, with the columns ``by`` that the folders carry."""
    fields = StructType([*schema.fields])
    for column in by:
        fields = fields.add(column, IntegerType())
    if not folders:
        return spark.createDataFrame([], fields)
    reader = spark.read.schema(StructType([*fields.fields]).add(PART, StringType())).option("basePath", path)
    return reader.parquet(*[f"{path}/{f}" for f in folders]).drop(PART)


def _rows(spark: SparkSession, path: str, table: Table, schema: StructType) -> DataFrame:
    if table.buckets:
        return _read(spark, path, list(table.folders), schema, BUCKET).drop(BUCKET)
    return _read(spark, path, list(table.folders), schema)


def _present(spark: SparkSession, path: str, version: Version | None) -> Table:
    store, name = versions.home(spark, path)
    found = (version or versions.last(spark, store)).tables.get(name)
    if found is None:
        raise FileNotFoundError(f"no committed version of {path}")
    return found


def read_current(spark: SparkSession, path: str, schema: StructType, version: Version | None = None) -> DataFrame:
    """A table in its last version, or in the one given."""
    return _rows(spark, path, _present(spark, path, version), schema)


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove all versions but the last ``keep`` of the store the table belongs to; returns what went."""
    return versions.expire(spark, versions.home(spark, path)[0], keep)


# --- dimensions -------------------------------------------------------------


def read_dimension(spark: SparkSession, mart: str, name: str, version: Version | None = None) -> DataFrame:
    return read_current(spark, f"{mart}/{name}", MART_TABLES[name], version)


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, key: str, buckets: int) -> dict[str, int]:
    """Write rows by the bucket of their key into a new part; returns its folders with their rows."""
    spark, part = df.sparkSession, versions.new_part()
    dealt = df.withColumn(BUCKET, _bucket(key, buckets)).hint("rebalance", BUCKET)
    dealt.write.partitionBy(BUCKET).parquet(f"{path}/{part}")
    folders = [f"{part}/{f}" for f in files.folders(spark, f"{path}/{part}") if f.startswith(f"{BUCKET}=")]
    # Rows are counted in the files' footers.
    counted = _read(spark, path, folders, StructType(), BUCKET).groupBy(BUCKET).count().collect()
    return {f"{part}/{BUCKET}={r[BUCKET]}": r["count"] for r in counted}


def merged_dimension(
    spark: SparkSession,
    path: str,
    name: str,
    table: Table,
    source: DataFrame,
    latest_by: tuple[str, ...] = (),
    bucket_rows: int = BUCKET_ROWS,
) -> tuple[Table, dict[str, int]]:
    """Write what an upsert of ``source`` changes; returns the table as it would be, and the change counts.

    Only the buckets that ``source``'s keys fall into are read and written. The
    number of buckets doubles as the dimension grows, and every bucket is written
    then. The counts are observed in the task that writes the rows: no second
    pass, and a retried task counts once. ``source`` is read for its size, its
    buckets, its keys and its rows, so give a stored table.
    """
    key, schema = PRIMARY_KEYS[name], MART_TABLES[name]
    old = _rows(spark, path, table, schema)
    known, arriving = sum(table.folders.values()) if table.buckets else old.count(), source.count()
    if not arriving and table.buckets:
        return table, {"updated_count": 0, "inserted_count": 0, "kept_count": known}
    buckets = max(table.buckets, 1)
    while buckets * bucket_rows < known + arriving:
        buckets *= 2
    stays: dict[str, int] = {}
    if buckets == table.buckets:
        # At most as many values as buckets.
        touched = {r[0] for r in source.select(_bucket(key, buckets)).distinct().collect()}
        stays = {f: n for f, n in table.folders.items() if int(f.rpartition("=")[2]) not in touched}
        old = _rows(spark, path, Table({f: n for f, n in table.folders.items() if f not in stays}, buckets), schema)
    counts = Observation()
    changes = scd1_changes(old, source, key, latest_by=latest_by).observe(counts, *change_counts())
    written = write_buckets(changes.drop(CHANGE), path, key, buckets)
    found = counts.get
    found["kept_count"] += sum(stays.values())
    return Table({**stays, **written}, buckets), found


def upsert_dimension(
    spark: SparkSession,
    mart: str,
    name: str,
    source: DataFrame,
    latest_by: tuple[str, ...] = (),
    bucket_rows: int = BUCKET_ROWS,
) -> dict[str, int]:
    """Merge ``source`` into a dimension and publish it; returns the change counts."""
    path = f"{mart}/{name}"
    store, own = versions.home(spark, path)
    present = versions.last(spark, store)
    merged, counts = merged_dimension(spark, path, name, _present(spark, path, present), source, latest_by, bucket_rows)

    def change(latest: Version) -> dict[str, Table]:
        versions.unchanged(present, own)(latest)
        return {own: merged}

    versions.publish(spark, store, change)
    return counts


# --- facts ------------------------------------------------------------------


def write_by_month(df: DataFrame, path: str, month: Column, first: int | None = None) -> dict[str, None]:
    """Write rows by month into a new part; returns its folders.

    Rebalancing puts a month in as few files as its size needs and splits a
    month that is too large for one task. A row of a month before ``first``
    fails the write.
    """
    spark, part = df.sparkSession, versions.new_part()
    by_month = df.withColumn(MONTH, month).hint("rebalance", MONTH)
    if first is not None:
        shown = F.col("time_key" if "time_key" in df.columns else MONTH).cast("string")
        message = F.concat(F.lit(f"row before the window from {first}01: time_key "), shown)
        early = F.when(F.col(MONTH) < first, F.raise_error(message).cast("boolean"))
        by_month = by_month.filter(early.otherwise(F.lit(True)))
    by_month.write.partitionBy(MONTH).parquet(f"{path}/{part}")
    return {f"{part}/{f}": None for f in files.folders(spark, f"{path}/{part}") if f.startswith(f"{MONTH}=")}


def write_months(df: DataFrame, path: str, name: str, first: int | None = None) -> dict[str, None]:
    """``write_by_month`` of a fact's rows."""
    return write_by_month(conform(df, MART_TABLES[name]), path, month_key(F.col("time_key")), first)


def read_months(spark: SparkSession, path: str, table: Table, schema: StructType) -> DataFrame:
    """The rows of a table by month, with their month."""
    return _read(spark, path, list(table.folders), schema, MONTH)


def _month(folder: str) -> int | None:
    month = folder.rpartition("=")[2]
    return None if month == NO_MONTH else int(month)


def outside_window(table: Table, first: int) -> dict[str, None]:
    """The folders of a fact that a replacement from the month ``first`` on leaves."""
    return {f: n for f, n in table.folders.items() if (month := _month(f)) is not None and month < first}


def read_fact(
    spark: SparkSession, path: str, name: str, since: date | None = None, version: Version | None = None
) -> DataFrame:
    """A fact table; ``since`` also skips the folders of earlier months."""
    df = read_months(spark, path, _present(spark, path, version), MART_TABLES[name])
    if since is not None:
        first = since.year * 100 + since.month
        df = df.filter((F.col(MONTH) >= first) & (F.col("time_key") >= first * 100 + since.day))
    return df.drop(MONTH)


def append_fact(df: DataFrame, path: str, name: str) -> None:
    """Add rows, in one step for readers. Facts have no key: running it twice doubles them.

    A table that does not exist yet is made. Appends of several writers follow
    each other; none is lost.
    """
    spark = df.sparkSession
    store, own = versions.home(spark, path)
    written = write_months(df, path, name)
    versions.publish(
        spark, store, lambda present: {own: Table({**present.tables.get(own, Table()).folders, **written})}
    )


def month_start(day: date) -> date:
    """First day of the month: windows that are to be replaced start there."""
    return day.replace(day=1)


def replace_window(df: DataFrame, path: str, name: str, since: date) -> None:
    """Make ``df`` the fact's content from ``since`` on, in one step for readers; running it twice changes nothing.

    ``since`` must be the first of a month, because whole months are replaced,
    and ``df`` must be the fact built with that window. Months of the window
    that ``df`` no longer has are emptied. Rows without a time key count as
    part of every window, so the calendar must reach into it: otherwise older
    orders past the calendar would be among them but not in ``df``. Rows that
    another writer appends to the window meanwhile fail this one.
    """
    if since != month_start(since):
        raise ValueError(f"the window must start with a month: use {month_start(since)}")
    spark = df.sparkSession
    store, own = versions.home(spark, path)
    present = versions.last(spark, store)
    first = since.year * 100 + since.month
    written = write_months(df, path, name, first)

    def change(latest: Version) -> dict[str, Table]:
        versions.unchanged(present, own)(latest)
        return {own: Table({**outside_window(latest.tables.get(own, Table()), first), **written})}

    versions.publish(spark, store, change)


def compact_fact(spark: SparkSession, path: str, name: str, most: int = 1) -> list[str]:
    """Write each month that lies in more than ``most`` folders into one; returns these months' folder names.

    Every append leaves a folder of its own in each of its months. Rows stay as
    they are; other months are not read. Appends that come meanwhile stay beside
    the new folder; a replacement that comes meanwhile fails this.
    """
    store, own = versions.home(spark, path)
    table = _present(spark, path, versions.last(spark, store))
    by_month: dict[str, list[str]] = {}
    for folder in table.folders:
        by_month.setdefault(folder.rpartition("/")[2], []).append(folder)
    scattered = sorted(month for month, folders in by_month.items() if len(folders) > most)
    if not scattered:
        return []
    old = [folder for month in scattered for folder in by_month[month]]
    written = write_months(read_months(spark, path, Table(dict.fromkeys(old)), MART_TABLES[name]), path, name)

    def change(latest: Version) -> dict[str, Table]:
        present = latest.tables[own].folders
        if not set(old) <= set(present):
            raise versions.Conflict(f"{path} has lost folders that were to be joined: another writer came first")
        return {own: Table({**{f: n for f, n in present.items() if f not in old}, **written})}

    versions.publish(spark, store, change)
    return scattered


# --- the star schema --------------------------------------------------------


def create_mart(spark: SparkSession, mart: str) -> list[str]:
    """Create the tables that do not exist yet, empty and typed; returns their names.

    Tables that were published on their own below ``mart`` are taken over.
    """
    present = versions.last(spark, mart)
    missing = [name for name in (*DIMENSIONS, *FACTS) if name not in present.tables]
    if not missing:
        return []
    alone = {name: versions.last(spark, f"{mart}/{name}").tables.get(name) for name in missing}
    tables = {name: alone[name] or Table(buckets=int(name in DIMENSIONS)) for name in missing}
    versions.publish(spark, mart, lambda latest: {n: t for n, t in tables.items() if n not in latest.tables})
    return [name for name in missing if alone[name] is None]
