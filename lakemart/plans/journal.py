"""Write-ahead journal of the periods that a run must still rebuild.

A run writes down, for each table, the periods that it is about to change before it changes
the first of them, and strikes each table out once it is written. A run that dies in between
leaves the rest, and the next one takes it up with its own changes; so a table is never left
behind the table that it is derived from, wherever the run broke off.

The journal is one small JSON file per state: a new state is written under a temporary name
and renamed to the next number, and the highest number counts, so there is no moment without
a readable state. Its size is bounded by tables x calendar periods.
"""

from __future__ import annotations

import datetime as dt
import json
import threading

from pyspark.sql import SparkSession

from lakemart.sources.sinks import Files

WHOLE = "whole"


class Journal:
    """Pending periods by table: a list of dates (NULL as None), or ``WHOLE``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.files, self.folder, self.lock = Files(spark, folder), folder.rstrip("/"), threading.Lock()
        states = self._states()
        self.number = max(states, default=0)
        raw = json.loads(self.files.read(self._path(self.number))) if states else {}
        self.pending = {t: p if p == WHOLE else [d and dt.date.fromisoformat(d) for d in p] for t, p in raw.items()}

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"

    def _states(self) -> list[int]:
        return [int(n[:-5]) for n in self.files.children(self.folder) if n.endswith(".json")]

    def _store(self) -> None:
        text = json.dumps({t: p if p == WHOLE else [d and d.isoformat() for d in p] for t, p in self.pending.items()})
        self.files.write(self._path(self.number + 1), text)
        self.number += 1
        for name in self.files.children(self.folder):
            if name != f"{self.number:012d}.json":
                self.files.delete(f"{self.folder}/{name}")

    def plan(self, tables: dict[str, list | None]) -> None:
        """Add periods to what each table must still rebuild; None stands for the whole table."""
        for table, periods in tables.items():
            held = self.pending.get(table, [])
            if periods is None or held == WHOLE:
                self.pending[table] = WHOLE
            else:
                self.pending[table] = sorted({*held, *periods}, key=lambda d: (d is not None, d or dt.date.min))
        self.pending = {t: p for t, p in self.pending.items() if p}
        self._store()

    def todo(self, table: str) -> tuple[bool, list | None]:
        """Whether the table has anything to rebuild, and which periods (None: all)."""
        held = self.pending.get(table, [])
        return bool(held), None if held == WHOLE else held

    def done(self, table: str) -> None:
        with self.lock:  # tables are rebuilt at the same time
            if self.pending.pop(table, None) is not None:
                self._store()
