"""The two runs: stage everything from the source, then load it into the mart.

``build_mart`` writes each result once into a folder of its own run and reads it
back where a later step needs it. Written tables cut the lineage: losing an
executor repeats at most the step that is running. The run's manifest is written
last, so a run that died half-way is no run, and ``load_mart`` takes the tables
of one run only. Steps that need nothing of each other are submitted together.

``load_mart`` writes all tables first, audits the mart as it would be, and then
publishes all of them as one version: readers see a load whole or not at all,
and a load that fails the audit leaves nothing but unnamed folders.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date
from typing import Any
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martflow.operators import checks, files, repairs, versions
from martflow.operators.daily import visits_from_days
from martflow.operators.repairs import Rule
from martflow.operators.tables import (
    create_mart,
    merged_dimension,
    month_start,
    outside_window,
    read_dimension,
    read_fact,
    write_months,
)
from martflow.operators.versions import Table, Version
from martflow.plans import dims, facts
from martflow.schemas import DIMENSIONS, FACTS, MART_TABLES, SOURCE_TABLES, VISITS, conform
from martflow.sources.csv import bulk_load
from martflow.sources.model import RetailSource

#: Manifests of complete runs, ``<number>.json``, below the staging folder.
RUNS = "_runs"
SIDE_BY_SIDE = 4


@dataclass
class RunReport:
    """Rows written per staged table; change counts per loaded dimension."""

    run: str = ""
    rows: dict[str, int] = field(default_factory=dict)
    changes: dict[str, dict[str, int]] = field(default_factory=dict)
    orders_outside_calendar: int = 0
    failed_rules: dict[str, dict[str, int]] = field(default_factory=dict)
    repaired_rules: dict[str, dict[str, int]] = field(default_factory=dict)


class AuditFailed(ValueError):
    """A load was not published; ``findings`` are the rows of the audit that did not pass."""

    def __init__(self, run: str, findings: list[Row]):
        self.run, self.findings = run, findings
        named = "; ".join(f"{r.table}.{r.column} {r.check}: {r.failed_rows} of {r.checked_rows} rows" for r in findings)
        super().__init__(f"{run} was not published: {named}")


def _together(*steps: Callable[[], Any]) -> list:
    """Results of steps submitted side by side. A failure is raised after all have ended."""
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        running = [pool.submit(step) for step in steps]
    return [step.result() for step in running]


def _stage(df: DataFrame, path: str, schema: StructType) -> tuple[DataFrame, int]:
    """Write, count on the way, read back."""
    rows = Observation()
    conform(df, schema).observe(rows, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path), rows.get["rows"]


def build_mart(
    source: RetailSource,
    staging: str,
    since: date | None = None,
    as_of: date | None = None,
    visits_as_of: date | None = None,
    calendar_days: int | None = dims.CALENDAR_DAYS,
    registered_after: date | None = None,
    to_replace: bool = False,
    visits_store: str | None = None,
    ratings_store: str | None = None,
    rules: Mapping[str, Sequence[Rule]] | None = None,
) -> RunReport:
    """Extract and shape all tables into a new run in ``staging``.

    ``since`` and ``as_of`` limit the orders behind both facts;
    ``registered_after`` limits the customer and product dimensions, not the
    customers of the facts. Without ``calendar_days`` the calendar reaches the
    last order; else the report counts the orders outside it. Orders are staged
    once and feed both facts.

    ``to_replace`` stages a window for ``load_mart(replace_since=...)``: who has
    no orders is then decided by all orders up to ``as_of``.

    Visits and ratings are computed anew from all their rows in each run, unless
    a folder is named to keep them in: ``visits_store`` keeps counts by day, and
    a run counts the days that are missing; ``ratings_store`` keeps rating totals
    by month, and a run adds its window, or replaces from its start on if it is
    staged ``to_replace``. ``rules`` of a dimension repair its rows or set them
    aside, in the run's folder ``rejected/<dimension>``; the report counts both.
    """
    spark = source.sales.sparkSession
    report = RunReport(run=f"run-{uuid4().hex}")
    root = f"{staging}/{report.run}"

    def stage(name: str, df: DataFrame, schema: StructType) -> DataFrame:
        staged, report.rows[name] = _stage(df, f"{root}/{name}", schema)
        return staged

    def dimension(name: str, df: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
        def build() -> DataFrame:
            if not (rules or {}).get(name):
                return stage(name, df(), MART_TABLES[name])
            judged = repairs.split(conform(df(), MART_TABLES[name]), rules[name], f"{root}/judged/{name}")
            report.failed_rules[name], report.repaired_rules[name] = judged.failed, judged.repaired
            _stage(judged.rejected, f"{root}/rejected/{name}", judged.rejected.schema)
            return stage(name, judged.accepted, MART_TABLES[name])

        return build

    def products() -> DataFrame:
        if ratings_store is None:
            return dims.dim_product(source.product, source.sale_product, registered_after)
        totals = dims.load_ratings(ratings_store, source.sale_product, source.sales, since, as_of, replace=to_replace)
        return dims.dim_product(source.product, None, registered_after, totals=totals)

    def counted_visits() -> DataFrame:
        if visits_store is None:
            return stage("customer_visit", facts.visits(source.web_visit, as_of=visits_as_of), VISITS)
        return stage("customer_visit", visits_from_days(source.web_visit, visits_store, as_of=visits_as_of), VISITS)

    dim_time, sales, visits, *_ = _together(
        lambda: stage("dim_time", dims.dim_time(source.sales, calendar_days), MART_TABLES["dim_time"]),
        lambda: stage("sales_data", facts.sales_window(source.sales, since, as_of), SOURCE_TABLES["sales"]),
        counted_visits,
        dimension("dim_customer", lambda: dims.dim_customer(source.customer, registered_after)),
        dimension("dim_product", products),
        dimension("dim_location", lambda: dims.dim_location(source.locations)),
    )

    def outside_calendar() -> None:
        ends = dim_time.agg(F.min("date").alias("first"), F.max("date").alias("last"))
        outside = sales.join(ends, F.col("order_date").between(F.col("first"), F.col("last")), "left_anti")
        report.orders_outside_calendar = outside.filter("order_date is not null").count()

    customers = dims.dim_customer(source.customer)
    ever = facts.sales_window(source.sales, as_of=as_of) if to_replace else None
    marketing = facts.fct_marketing(customers, sales, visits, dim_time, all_sales=ever)
    _together(
        lambda: stage("fct_sales", facts.fct_sales(sales, source.sale_product, dim_time), MART_TABLES["fct_sales"]),
        lambda: stage("fct_marketing", marketing, MART_TABLES["fct_marketing"]),
        outside_calendar,
    )
    _write_manifest(spark, staging, report, since=since, to_replace=to_replace)
    return report


def _write_manifest(spark: SparkSession, staging: str, report: RunReport, since: date | None, to_replace: bool) -> None:
    """Claim the next run number by creating its manifest, whole, as a file only one run can create."""
    content = {
        "run": report.run,
        "rows": report.rows,
        "since": since.isoformat() if since else None,
        "to_replace": to_replace,
        "orders_outside_calendar": report.orders_outside_calendar,
    }
    number = max(_run_numbers(spark, staging), default=0) + 1
    while not files.create(spark, _manifest_file(staging, number), json.dumps({**content, "number": number}) + "\n"):
        number += 1


def _manifest_file(staging: str, number: int) -> str:
    return f"{staging}/{RUNS}/{number:012d}.json"


def _run_numbers(spark: SparkSession, staging: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in files.names(spark, f"{staging}/{RUNS}") if n[0] != "."]


def _runs(spark: SparkSession, staging: str) -> list[dict]:
    """Manifests of the complete runs, oldest first; one that is just being written does not count yet."""
    texts = [files.read_text(spark, _manifest_file(staging, n)) for n in sorted(_run_numbers(spark, staging))]
    return [json.loads(text) for text in texts if text.endswith("\n")]


def manifest(spark: SparkSession, staging: str, run: str | None = None) -> dict:
    """The manifest of a complete run, by default the last one."""
    found = [m for m in _runs(spark, staging) if run in (None, m["run"])]
    if not found:
        raise FileNotFoundError(f"no complete run {run or ''} in {staging}")
    return found[-1]


def staged_table(spark: SparkSession, staging: str, name: str, run: str | None = None) -> DataFrame:
    run = run or manifest(spark, staging)["run"]
    return spark.read.schema(MART_TABLES[name]).parquet(f"{staging}/{run}/{name}")


def staged_tables(spark: SparkSession, staging: str, run: str | None = None) -> dict[str, DataFrame]:
    run = run or manifest(spark, staging)["run"]
    return {name: staged_table(spark, staging, name, run) for name in MART_TABLES}


def stage_handoffs(
    spark: SparkSession, folder: str, staging: str, renames: dict[str, dict[str, str]] | None = None
) -> RunReport:
    """Stage CSV files ``{folder}/{table}`` of all mart tables as a run, as ``build_mart`` would.

    ``renames`` maps a table's file columns to the table's, for example
    ``{"fct_sales": {"subtotal": "sales"}}``.
    """
    report = RunReport(run=f"run-{uuid4().hex}")

    def stage(name: str) -> None:
        loaded = bulk_load(spark, f"{folder}/{name}", MART_TABLES[name], rename=(renames or {}).get(name))
        _, report.rows[name] = _stage(loaded, f"{staging}/{report.run}/{name}", MART_TABLES[name])

    _together(*[lambda n=name: stage(n) for name in MART_TABLES])
    _write_manifest(spark, staging, report, since=None, to_replace=False)
    return report


def audit_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """The rules a mart's tables are declared with: primary keys are known and unique, foreign keys have parents."""
    return checks.union_all([checks.key_findings(tables), checks.foreign_key_findings(tables)])


def load_mart(
    spark: SparkSession,
    staging: str,
    mart: str,
    replace_since: date | None = None,
    keep_versions: int = 5,
    run: str | None = None,
    audit: Callable[[dict[str, DataFrame]], DataFrame] | None = audit_keys,
) -> RunReport:
    """Upsert a run's dimensions and append its facts, as one version of the mart.

    Takes the given run or the last complete one. A run's facts are appended
    once: the version names the runs it holds, and a second append is refused.
    With ``replace_since`` the facts are replaced from the start of that month
    instead, which may be repeated; such a run is staged with
    ``since=month_start(replace_since)`` and ``to_replace``.

    Before the version is published, ``audit`` is given the dimensions as they
    would be and the facts' rows that the run brings (earlier ones passed when
    they came, and an upsert takes no key away). It returns findings like those
    of ``check_suite``; if one has not passed, nothing changes and
    ``AuditFailed`` is raised with them. If another writer changes one of the
    tables meanwhile, nothing changes either. A load that broke off has left
    nothing that counts and can be run again.
    """
    found = manifest(spark, staging, run)
    run = found["run"]
    first = None
    if replace_since is not None:
        start = month_start(replace_since)
        if found["since"] not in (None, start.isoformat()) or found["since"] and not found["to_replace"]:
            raise ValueError(f"{run} was not staged to replace the facts from {start}")
        last_day = staged_table(spark, staging, "dim_time", run).agg(F.max("date")).first()[0]
        if last_day is None or last_day < start:
            raise ValueError(f"the calendar ends on {last_day}, before the window; stage a longer one")
        first = start.year * 100 + start.month
    create_mart(spark, mart)
    present = versions.last(spark, mart)
    _refuse_repeat(present, run, first)
    report = RunReport(run=run, rows=found["rows"])
    tables: dict[str, Table] = {}

    def upsert(name: str) -> None:
        staged = staged_table(spark, staging, name, run)
        tables[name], report.changes[name] = merged_dimension(spark, f"{mart}/{name}", name, present.tables[name], staged)

    def write(name: str) -> None:
        staged = staged_table(spark, staging, name, run)
        tables[name] = Table(write_months(staged, f"{mart}/{name}", name, first))

    _together(*[lambda n=name: upsert(n) for name in DIMENSIONS], *[lambda n=name: write(n) for name in FACTS])
    if audit is not None:
        candidate = mart_tables(spark, mart, Version(tables=tables))
        failed = audit(candidate).filter("not passed").collect()
        if failed:
            raise AuditFailed(run, failed)

    def change(latest: Version) -> dict[str, Table]:
        _refuse_repeat(latest, run, first)
        versions.unchanged(present, *DIMENSIONS, *(FACTS if first else ()))(latest)
        held = {n: latest.tables[n] for n in FACTS}
        stays = {n: outside_window(t, first) if first else t.folders for n, t in held.items()}
        return {**tables, **{n: Table({**stays[n], **tables[n].folders}) for n in FACTS}}

    versions.publish(spark, mart, change, mark=None if first else run)
    versions.expire(spark, mart, keep_versions)
    return report


def _refuse_repeat(version: Version, run: str, first: int | None) -> None:
    if first is None and run in version.marks:
        raise ValueError(f"{run} was appended already; replace its window instead")


def mart_tables(spark: SparkSession, mart: str, version: Version | None = None) -> dict[str, DataFrame]:
    """All tables of a loaded mart, of one version, ready for checks and reports."""
    version = version or versions.last(spark, mart)
    tables = {name: read_dimension(spark, mart, name, version) for name in DIMENSIONS}
    return tables | {name: read_fact(spark, f"{mart}/{name}", name, version=version) for name in FACTS}
