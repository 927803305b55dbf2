"""Versions of one or several tables, published in one step.

A store is a folder with a list of versions, ``_versions/<number>.json``. A
version names for each table the folders that hold its rows. Folders are written
once under new names and never changed, and a version is a file that one writer
only can create, so readers see the old tables or the new ones, of all tables
together, whatever dies in between. What no version names does not count.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import SparkSession

from martflow.operators import files

LOG = "_versions"
PART = "data_part"
#: How often, and after how many seconds, a version that is just being written is looked at again.
LOOKS, PAUSE = 20, 0.25


@dataclass(frozen=True)
class Table:
    """Folders below the table's own, with their rows where they are known; ``buckets`` if rows lie by key."""

    folders: Mapping[str, int | None] = field(default_factory=dict)
    buckets: int = 0


@dataclass(frozen=True)
class Version:
    number: int = 0
    tables: Mapping[str, Table] = field(default_factory=dict)
    #: Marks left by loads, for example the runs that were appended.
    marks: tuple[str, ...] = ()


class Conflict(RuntimeError):
    """Another writer has changed the same table since."""


def home(spark: SparkSession, path: str) -> tuple[str, str]:
    """The store that the table at ``path`` belongs to, and its name there.

    A table of a mart belongs to the mart's store, any other to its own.
    """
    parent, _, name = path.rstrip("/").rpartition("/")
    return (parent if files.exists(spark, f"{parent}/{LOG}") else path.rstrip("/")), name


def numbers(spark: SparkSession, store: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in files.names(spark, f"{store}/{LOG}") if n[0] != "."]


def _file(store: str, number: int) -> str:
    return f"{store}/{LOG}/{number:012d}.json"


def _read(spark: SparkSession, store: str, number: int) -> Version | None:
    """A version; None while it is being written."""
    text = files.read_text(spark, _file(store, number))
    if not text.endswith("\n"):
        return None
    content = json.loads(text)
    tables = {name: Table(t["folders"], t["buckets"]) for name, t in content["tables"].items()}
    return Version(number, tables, tuple(content["marks"]))


def last(spark: SparkSession, store: str) -> Version:
    """The present version; number 0, without tables, if there is none."""
    for number in reversed(numbers(spark, store)):
        found = _read(spark, store, number)
        if found is not None:
            return found
    return Version()


def publish(
    spark: SparkSession, store: str, change: Callable[[Version], Mapping[str, Table]], mark: str | None = None
) -> Version:
    """Make the next version from the present one; ``change`` gives the tables that become others.

    If another writer publishes in between, ``change`` is asked again with that
    writer's version; it raises ``Conflict`` where its tables may not follow it.
    """
    looks, blocked = LOOKS, None
    while True:
        present = last(spark, store)
        if blocked == present.number:
            looks -= 1
            if not looks:
                raise Conflict(f"{_file(store, blocked + 1)} is unfinished; if its writer has died, remove it")
            time.sleep(PAUSE)
        tables = {**present.tables, **change(present)}
        marks = present.marks + ((mark,) if mark else ())
        content = {
            "tables": {n: {"folders": dict(t.folders), "buckets": t.buckets} for n, t in tables.items()},
            "marks": marks,
        }
        if files.create(spark, _file(store, present.number + 1), json.dumps(content) + "\n"):
            return Version(present.number + 1, tables, marks)
        blocked = present.number


def unchanged(since: Version, *names: str) -> Callable[[Version], None]:
    """Raises ``Conflict`` for a version in which one of the tables is not what it was."""

    def check(present: Version) -> None:
        for name in names:
            if present.tables.get(name) != since.tables.get(name):
                raise Conflict(
                    f"{name} has changed between version {since.number} and {present.number}: another writer came first"
                )

    return check


def new_part() -> str:
    """A folder name of its own for what one write leaves."""
    return f"{PART}={uuid4().hex}"


def _used(version: Version, store: str, single: bool) -> set[str]:
    return {
        f"{store}/{folder}" if single else f"{store}/{name}/{folder}"
        for name, table in version.tables.items()
        for folder in table.folders
    }


def is_single(store: str, version: Version) -> bool:
    """Whether the store is one table's own: its only table has its name."""
    return set(version.tables) == {store.rstrip("/").rpartition("/")[2]}


def expire(spark: SparkSession, store: str, keep: int = 2) -> list[int]:
    """Remove all versions but the last ``keep``, and the folders only they name; returns their numbers."""
    present = numbers(spark, store)
    expired = present[: -max(keep, 1)]
    read = {n: _read(spark, store, n) or Version(n) for n in present}
    single = is_single(store, read[present[-1]]) if present else False
    kept = set().union(*[_used(read[n], store, single) for n in present if n not in expired])
    gone = set().union(*[_used(read[n], store, single) for n in expired]) - kept
    # The versions go first: what they name must not vanish before them.
    for number in expired:
        files.remove(spark, _file(store, number))
    for folder in sorted(gone):
        files.remove(spark, folder)
    return expired


def sweep(spark: SparkSession, path: str, older_than: float = 7 * 24 * 3600) -> list[str]:
    """Remove a table's folders that no version names, left by writers that died; returns their names.

    Folders changed less than ``older_than`` seconds ago stay: their writer may
    be about to publish.
    """
    store, name = home(spark, path)
    named = set()
    for number in numbers(spark, store):
        version = _read(spark, store, number) or Version()
        named |= {folder.split("/")[0] for folder in version.tables.get(name, Table()).folders}
    dead = [
        folder
        for folder in files.folders(spark, path)
        if folder.startswith(f"{PART}=")
        and folder not in named
        and files.changed_at(spark, f"{path}/{folder}") < time.time() - older_than
    ]
    for folder in dead:
        files.remove(spark, f"{path}/{folder}")
    return dead
