"""Versioned snapshots without a transactional table format, in any file system that Hadoop knows.

A version is a manifest: table names and the folders that hold them. A build writes its tables into a folder of its own, its manifest
takes the other tables over from the current version, and one small file, replaced at once, says which version is current.
"""

from __future__ import annotations

import contextlib
import json
from collections.abc import Callable, Iterator
from datetime import date, datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from unitflow.plans.files import Files


class Busy(RuntimeError):
    """Another build holds the lock."""


class Store:
    """A warehouse folder: data/<run>/<table>, versions/<run>.json, rejected/<run>.json, CURRENT, PREVIOUS, run_log/, marks.json."""

    def __init__(self, root: str | Path, spark: SparkSession | None = None):
        self.spark = spark or SparkSession.getActiveSession()
        self.files = Files(self.spark, str(root))
        self.files.make("")

    @contextlib.contextmanager
    def lock(self) -> Iterator[None]:
        """One build at a time. A build that dies leaves the file ``LOCK``; its text says since when, and unlock() removes it."""
        if not self.files.claim("LOCK"):
            raise Busy(f"{self.files.root} is locked since {self.files.read('LOCK') or 'just now'}")
        try:
            self.files.write("LOCK", datetime.now(timezone.utc).isoformat())
            yield
        finally:
            self.unlock()

    def unlock(self) -> None:
        self.files.delete("LOCK")

    def pointer(self, name: str = "CURRENT") -> str | None:
        text = self.files.read(name)
        return text.strip() if text else None

    def tables(self, version: str | None = None, kind: str = "versions") -> dict[str, str]:
        """Table names and their folders, of a version or the current one."""
        version = version or self.pointer()
        text = self.files.read(f"{kind}/{version}.json") if version else None
        return json.loads(text) if text else {}

    def build(self, run: str, tables: dict[str, DataFrame], accept: Callable[[dict[str, DataFrame]], bool] = lambda t: True) -> bool:
        """Write the tables, read them back, judge what was read, and only then move CURRENT; what is refused is kept apart.

        Tables of the current version that are not built anew stay in the new version.
        """
        with self.lock():
            made = {}
            for name, df in tables.items():
                made[name] = f"data/{run}/{name}"
                df.write.mode("overwrite").parquet(self.files.at(made[name]))
            read = {name: self.spark.read.schema(df.schema).parquet(self.files.at(made[name])) for name, df in tables.items()}
            ok = accept(read)
            if not ok:
                self.files.write(f"rejected/{run}.json", json.dumps(made))
                return False
            old = self.pointer()
            self.files.write(f"versions/{run}.json", json.dumps(self.tables(old) | made))
            if old and old != run:
                self.files.write("PREVIOUS", old)
            self.files.write("CURRENT", run)
            return True

    def rollback(self) -> None:
        if not (old := self.pointer("PREVIOUS")):
            raise RuntimeError("there is no previous version")
        self.files.write("CURRENT", old)

    def read(self, spark: SparkSession, table: str, version: str | None = None) -> DataFrame:
        held = self.tables(version)
        if table not in held:
            raise KeyError(f"no table {table} in version {version or self.pointer()}")
        return spark.read.parquet(self.files.at(held[table]))

    def log(self, **row) -> None:
        """One file a run, named by its time, so that writers do not meet."""
        at = datetime.now(timezone.utc)
        self.files.write(f"run_log/{at:%Y%m%dT%H%M%S%f}.json", json.dumps({"logged_at_utc": at.isoformat(), **row}, allow_nan=False) + "\n")

    def run_log(self, spark: SparkSession) -> DataFrame:
        return spark.read.json(self.files.at("run_log"))

    def last_logged(self, **wanted) -> dict | None:
        """The newest entry of the log with these values."""
        for name in reversed(self.files.names("run_log")):
            row = json.loads(self.files.read(f"run_log/{name}"))
            if all(row.get(k) == v for k, v in wanted.items()):
                return row
        return None

    def marks(self) -> dict[str, str | None]:
        return json.loads(self.files.read("marks.json") or "{}")

    def mark(self, source: str, table: str) -> date | None:
        value = self.marks().get(f"{source}/{table}")
        return date.fromisoformat(value) if value else None

    def set_mark(self, source: str, table: str, value: date | None) -> None:
        self.files.write("marks.json", json.dumps(self.marks() | {f"{source}/{table}": value.isoformat() if value else None}))


def load_incrementally(store: Store, spark: SparkSession, source: str, table: str, rows: DataFrame, column: str, keys: list[str], lookback: int, run: str) -> dict:
    """Read from the mark less the lookback, merge by key into a new version, move the pointer, then the mark. Other tables stay.

    A crash between the last two reads the window again, which changes nothing.
    """
    from unitflow.operators.changes import merged, next_mark, select_window, window_from

    old = store.mark(source, table)
    batch = select_window(rows, column, old, lookback)
    target = merged(store.read(spark, table), batch, keys) if table in store.tables() else batch
    store.build(run, {table: target})
    new = next_mark(batch, column, old)
    store.set_mark(source, table, new)
    start = window_from(old, lookback)
    return {"read_from": start.isoformat() if start else None, "rows": batch.count(), "mark": new.isoformat() if new else None}
