"""Counts kept by day: a window's total from stored days, of which only missing ones are counted.

The store's version says which spans of days it covers. A window is cut into
whole days, which come from the store, and the parts of a day at its ends, which
are counted from the source with a filter on that day alone.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructType

from martflow.operators import versions
from martflow.operators.versions import PART, Table, Version

SPAN = "span"
#: Stands for all days before the first one that is known.
BEGINNING = date.min
DAY = timedelta(days=1)
DAILY = StructType().add("customer_key", LongType()).add("day", DateType()).add("visits", LongType())


def _span(folder: str) -> tuple[date, date]:
    first, last = folder.rpartition("=")[2].split("_")
    return date.fromisoformat(first), date.fromisoformat(last)


def covered(spark: SparkSession, path: str) -> list[tuple[date, date]]:
    """The spans of days, ends included, that the store holds, in order."""
    store, own = versions.home(spark, path)
    return sorted(_span(f) for f in versions.last(spark, store).tables.get(own, Table()).folders)


def missing(spans: list[tuple[date, date]], first: date, last: date) -> list[tuple[date, date]]:
    """The spans of ``first`` to ``last`` that ``spans`` leave out."""
    out = []
    for begin, end in sorted(spans):
        if begin > last:
            break
        if begin > first:
            out.append((first, begin - DAY))
        if end >= first:
            first = end + DAY
    return out + [(first, last)] * (first <= last)


def _between(web_visit: DataFrame, first: date, last: date) -> DataFrame:
    """Visits of whole days; plain comparisons, which reach the scan."""
    kind = web_visit.schema["time_visit"].dataType
    out = web_visit.filter(F.col("time_visit") < F.lit(str(last + DAY)).cast(kind))
    return out if first == BEGINNING else out.filter(F.col("time_visit") >= F.lit(str(first)).cast(kind))


def cover(web_visit: DataFrame, path: str, first: date, last: date) -> list[tuple[date, date]]:
    """Count the days from ``first`` to ``last`` that the store lacks; returns the spans that were counted.

    The days must be over: a visit that is recorded later in a covered day is
    not seen, unless ``forget`` is called for it. If another writer has covered
    a day of the same span meanwhile, its counts stay and these go.
    """
    spark = web_visit.sparkSession
    store, own = versions.home(spark, path)
    spans = missing(covered(spark, path), first, last)
    for begin, end in spans:
        part = f"{versions.new_part()}/{SPAN}={begin.isoformat()}_{end.isoformat()}"
        counted = (
            _between(web_visit, begin, end)
            .groupBy(F.col("customer_id").alias("customer_key"), F.to_date("time_visit").alias("day"))
            .agg(F.count("customer_id").alias("visits"))
        )
        counted.write.parquet(f"{path}/{part}")

        def change(present: Version, begin: date = begin, end: date = end, part: str = part) -> dict[str, Table]:
            held = present.tables.get(own, Table()).folders
            if missing([_span(f) for f in held], begin, end) != [(begin, end)]:
                raise versions.Conflict(f"{path} has days of {begin} to {end} already: another writer came first")
            return {own: Table({**held, part: None})}

        versions.publish(spark, store, change)
    return spans


def forget(spark: SparkSession, path: str, since: date) -> None:
    """Let the store cover no span that reaches ``since`` or a later day."""
    store, own = versions.home(spark, path)
    versions.publish(
        spark,
        store,
        lambda present: {
            own: Table({f: n for f, n in present.tables.get(own, Table()).folders.items() if _span(f)[1] < since})
        },
    )


def _days(spark: SparkSession, path: str, first: date, last: date) -> DataFrame:
    """Stored counts of the days from ``first`` to ``last``, from the spans that have some of them."""
    store, own = versions.home(spark, path)
    held = versions.last(spark, store).tables.get(own, Table()).folders
    folders = [f for f in held if _span(f)[0] <= last and _span(f)[1] >= first]
    if not folders:
        return spark.createDataFrame([], DAILY)
    schema = StructType([*DAILY.fields]).add(PART, StringType()).add(SPAN, StringType())
    rows = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{f}" for f in folders])
    return rows.select(*DAILY.names).filter(F.col("day").between(*[F.lit(d.isoformat()).cast("date") for d in (first, last)]))


def _instant(bound: date | datetime) -> datetime:
    return bound if isinstance(bound, datetime) else datetime.combine(bound, time.min)


def visits_from_days(
    web_visit: DataFrame, path: str, since: date | datetime | None = None, as_of: date | datetime | None = None
) -> DataFrame:
    """What ``facts.visits`` gives for the window, reading only days that the store at ``path`` lacks.

    Bounds are instants; a date stands for its midnight. Whole days of the window
    are counted once and kept. The day of ``as_of`` may still go on, and so, where
    there is no such bound, may the last day with a visit: it is counted anew each
    time. Without any bound, visits without a time count too.
    """
    spark = web_visit.sparkSession
    kind = web_visit.schema["time_visit"].dataType
    at = F.col("time_visit")

    def literal(bound: datetime):
        return F.lit(str(bound)).cast(kind)

    begin = BEGINNING
    if since is not None:
        since = _instant(since)
        begin = since.date() if since.time() == time.min else since.date() + DAY
    if as_of is None:
        # The last day with a visit: looked for after the days that are known.
        known = max((end for _, end in covered(spark, path)), default=None)
        later = web_visit if known is None else web_visit.filter(at >= literal(_instant(known + DAY)))
        newest = later.agg(F.to_date(F.max("time_visit"))).first()[0]
        open_day = newest or (known + DAY if known else None)
    else:
        as_of = _instant(as_of)
        open_day = as_of.date()
    ends = []
    if since is not None and since.time() != time.min:
        ends.append((at >= literal(since)) & (at < literal(_instant(begin))))
    if open_day is not None:
        last_part = at >= literal(_instant(max(open_day, begin)))
        ends.append(last_part if as_of is None else last_part & (at <= literal(as_of)))
    if since is None and as_of is None:
        ends.append(at.isNull())
    # A window inside a day has its own bounds only.
    if since is not None and as_of is not None and since.date() == as_of.date():
        ends = [(at >= literal(since)) & (at <= literal(as_of))]
    parts = []
    if open_day is not None and begin < open_day:
        cover(web_visit, path, begin, open_day - DAY)
        parts.append(_days(spark, path, begin, open_day - DAY).select("customer_key", "visits"))
    for end in ends:
        one = F.col("customer_id").isNotNull().cast("long")
        parts.append(web_visit.filter(end).select(F.col("customer_id").alias("customer_key"), one.alias("visits")))
    if not parts:
        parts.append(spark.createDataFrame([], DAILY).select("customer_key", "visits"))
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    return both.groupBy("customer_key").agg(F.sum("visits").alias("visits"))
