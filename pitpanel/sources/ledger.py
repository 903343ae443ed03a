"""Which folders of a panel readers see.

A commit (one or more runs, or the repair after a late run) first records the folders it
is about to write as hidden, writes them, and then records the state in which they are
visible and the folders they replace are hidden.  Each record is a small JSON file
``published/<n>.json``, renamed into place; the newest one counts.  So a reader sees all of a
commit or nothing, whatever write a crash comes after, and a commit that is run again starts
from the same state.

A folder is named by its run stamp, or ``<stamp>~<n>`` where commit ``n`` wrote it anew.
The record grows with the runs of the panel (a few a day), never with its rows.
"""

from __future__ import annotations

import copy
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PRICES, HISTORY, DELTA, INDEX, CURRENT = "prices", "metadata/history", "metadata/index_delta", "metadata/index", "metadata/current"


def stamp_of(folder: str) -> str:
    return folder.split("~")[0]


class Ledger:
    """One record: ``runs`` (published stamp -> exact time), ``deltas`` (stamp -> index rows
    written), ``bases`` (folder of a full index and attribute table -> its keys), ``hidden``
    folders and ``moved`` runs (stamp -> folder) by table."""

    def __init__(self, spark: SparkSession, root: str, n: int = 0, record: dict | None = None):
        self.spark, self.root, self.n = spark, root, n
        record = record or {}
        self.runs: dict[str, str] = record.get("runs", {})
        self.deltas: dict[str, int] = record.get("deltas", {})
        self.bases: dict[str, int] = record.get("bases", {})
        self.hidden: dict[str, list[str]] = record.get("hidden", {})
        self.moved: dict[str, dict[str, str]] = record.get("moved", {})

    # --- files
    @staticmethod
    def _fs(spark: SparkSession, path: str):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    @classmethod
    def read(cls, spark: SparkSession, root: str) -> Ledger | None:
        """The newest record; None where nothing was ever published this way."""
        folder, fs = cls._fs(spark, f"{root}/published")
        if not fs.exists(folder):
            return None
        numbers = [int(name[:-5]) for f in fs.listStatus(folder) if (name := f.getPath().getName()).endswith(".json") and name[:-5].isdigit()]
        if not numbers:
            return None
        p, _ = cls._fs(spark, f"{root}/published/{max(numbers):08d}.json")
        stream = fs.open(p)
        try:
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return cls(spark, root, max(numbers), json.loads(text))

    def _next(self) -> Ledger:
        record = {k: copy.deepcopy(getattr(self, k)) for k in ("runs", "deltas", "bases", "hidden", "moved")}
        return Ledger(self.spark, self.root, self.n + 1, record)

    def write(self) -> Ledger:
        """Put this record in place; a second writer of the same number fails."""
        record = {k: getattr(self, k) for k in ("runs", "deltas", "bases", "hidden", "moved")}
        target, fs = self._fs(self.spark, f"{self.root}/published/{self.n:08d}.json")
        draft, _ = self._fs(self.spark, f"{self.root}/published/{self.n:08d}.draft")
        if fs.exists(target):
            raise RuntimeError(f"another writer published commit {self.n} of {self.root}")
        out = fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(record, sort_keys=True).encode()))
        finally:
            out.close()
        if not fs.rename(draft, target):
            raise RuntimeError(f"commit {self.n} of {self.root} was not published")
        return self

    # --- commits
    def begin(self, tables: dict[str, list[str]], bases: list[str] = ()) -> Ledger:
        """The record in which new folders for these runs exist, hidden.  ``folder`` tells their names."""
        new = self._next()
        for table, runs in tables.items():
            for run in runs:
                old = self.folder(table, run)
                p, fs = self._fs(self.spark, "/".join([self.root, table, *day_folders(run), f"run={old}"]))
                if run in self.runs or fs.exists(p):                # published, or left from a commit that broke off
                    new.moved.setdefault(table, {})[run] = f"{run}~{new.n}"
                new._hide(table, new.folder(table, run))
        for run in bases:
            for table in (INDEX, CURRENT):
                new._hide(table, f"{run}~{new.n}")
        return new

    def publish(self, before: Ledger, tables: dict[str, list[str]], runs: dict[str, str], deltas: dict[str, int],
                base: tuple[str, int] | None = None, drop_bases: list[str] = ()) -> Ledger:
        """The record in which the folders of commit ``self`` are visible, and those they replace are not."""
        new = self._next()
        for table, names in tables.items():
            for run in names:
                new.hidden[table].remove(self.folder(table, run))
                old = before.folder(table, run)
                if run in before.runs and old != self.folder(table, run):
                    new._hide(table, old)
        new.runs.update(runs)
        new.deltas.update(deltas)
        for folder in drop_bases:
            new.bases.pop(folder, None)
            for table in (INDEX, CURRENT):
                new._hide(table, folder)
        for table in (INDEX, CURRENT):                              # the commit's own full tables: written, or never made
            new.hidden[table] = [f for f in new.hidden.get(table, []) if not f.endswith(f"~{self.n}")]
        if base:
            new.bases[base[0]] = base[1]
        return new

    def _hide(self, table: str, folder: str) -> None:
        if folder not in self.hidden.setdefault(table, []):
            self.hidden[table].append(folder)

    # --- readers
    def folder(self, table: str, run: str) -> str:
        return self.moved.get(table, {}).get(run, run)

    def visible(self, df: DataFrame, table: str, column: str = "run") -> DataFrame:
        """The rows of visible folders, ``column`` as plain stamps: a filter on partition values."""
        if self.hidden.get(table):
            df = df.where(F.col(column).isNull() | ~F.col(column).isin(self.hidden[table]))
        return df.withColumn(column, F.substring_index(column, "~", 1)) if self.moved.get(table) else df

    def newest(self, until: str | None = None, before: str | None = None) -> str | None:
        return max((r for r in self.runs if (until is None or r <= until) and (before is None or r < before)), default=None)

    def base(self, at: str) -> str | None:
        """Folder of the newest full table that is not newer than run ``at``."""
        return max((b for b in self.bases if stamp_of(b) <= at), default=None)

    def time(self, run: str) -> Column:
        return F.lit(self.runs[run]).cast("timestamp")

    def outgrown(self, share: float) -> bool:
        """Whether the index rows written since the newest full table are more than ``share`` of it."""
        newest = max(self.bases, default=None)
        since = sum(n for run, n in self.deltas.items() if newest is None or run > stamp_of(newest))
        return since > share * self.bases.get(newest, 0)


def day_folders(run: str) -> list[str]:
    return [f"year={int(run[:4])}", f"month={int(run[5:7])}", f"day={int(run[8:10])}"]
