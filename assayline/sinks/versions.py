"""Versions of a table's days: a day is replaced by switching to a fresh folder.

`<root>/<partition>=<day>/run=<name>/` holds one version of one day. Names ascend. One run
may write many days in one job; it counts once its marker lies in `<root>/_runs`, which is
made after all of its files. The current version of a day is its last run that counts, so a
run that fails, at whatever point, leaves every day as it was, and one that counts replaces
all its days, whether or not any catalog knows of it yet.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import SparkSession

from assayline.functions import as_day
from assayline.sinks.folders import Folders

RUN = "run"
# Fixed value: how Spark names the folder of the null day.
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _parsed(name: str) -> date | None:
    value = name.split("=", 1)[1]
    return None if value == _NO_DAY else as_day(value)


class Versions:
    def __init__(self, spark: SparkSession, root: str, partition: str):
        self.root, self.partition = root, partition
        self._folders = Folders(spark)

    def start(self) -> str:
        """A name after all runs so far."""
        numbers = [int(name.split("-")[0]) for name in self.counting()]
        return f"{max(numbers, default=0) + 1:010d}-{uuid.uuid4().hex[:8]}"

    def folder(self, day: date | None, run: str) -> str:
        return f"{self._day(day)}/{RUN}={run}"

    def finish(self, run: str, days: Iterable[date | None] | None) -> dict[date | None, str]:
        """Make the run count for the days, or for all there are; days it has no rows for
        become empty. Returns the folders of these days."""
        written = self._written(run)
        if days is None:
            days = {_parsed(p.rsplit("/", 1)[1]) for p in self._folders.matching(self._day("*"))}
        covered = sorted(set(days) | set(written), key=str)
        for day in covered:
            if day not in written:
                self._folders.write(f"{self.folder(day, run)}/_empty")
        self._folders.write(f"{self.root}/_runs/{run}")
        return {day: self.folder(day, run) for day in covered}

    def abandon(self, run: str) -> None:
        """Remove what a failed run has left."""
        for day in self._written(run):
            self._folders.remove(self.folder(day, run))

    def current(self, day: date | None, counting: Iterable[str] | None = None) -> str | None:
        """The folder that holds the day now. `counting` saves reading the markers again."""
        runs = set(self._folders.names(self._day(day)))
        names = self.counting() if counting is None else counting
        found = [name for name in names if f"{RUN}={name}" in runs]
        return self.folder(day, max(found)) if found else None

    def all_current(self) -> dict[date | None, str]:
        counting, last = set(self.counting()), {}
        for path in self._folders.matching(f"{self._day('*')}/{RUN}=*"):
            day, run = _parsed(path.split("/")[-2]), path.rsplit("=", 1)[1]
            if run in counting:
                last[day] = max(run, last.get(day, run))
        return {day: self.folder(day, run) for day, run in last.items()}

    def prune(self, run: str, days: Iterable[date | None]) -> None:
        """Remove the versions of these days from before the run."""
        for day in days:
            for name in self._folders.names(self._day(day)):
                if name.startswith(f"{RUN}=") and name < f"{RUN}={run}":
                    self._folders.remove(f"{self._day(day)}/{name}")

    def _day(self, day: date | str | None) -> str:
        return f"{self.root}/{self.partition}={_NO_DAY if day is None else day}"

    def counting(self) -> list[str]:
        """The runs that count."""
        return [name for name in self._folders.names(f"{self.root}/_runs") if name[:1].isdigit()]

    def _written(self, run: str) -> list[date | None]:
        found = self._folders.matching(f"{self._day('*')}/{RUN}={run}")
        return [_parsed(path.split("/")[-2]) for path in found]
