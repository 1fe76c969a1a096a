"""Which days each landed batch has added records to, for those who keep tables of them.

One small file a batch under `<bronze>/_changed`, a day a line, written before the records:
a batch that fails in between is noted once too often, never too little. Every warehouse
remembers by itself which notes it has followed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import SparkSession

from assayline.functions import as_days
from assayline.sinks.folders import Folders


class ChangedDays:
    def __init__(self, spark: SparkSession, bronze_path: str):
        self.path = f"{bronze_path.rstrip('/')}/_changed"
        self._name = uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex[:12]
        self._folders = Folders(spark)

    def note(self, days: Iterable[date]) -> None:
        """The days are the file's name and content; nothing is noted for none."""
        days = as_days(days)
        if days:
            lines = "\n".join(day.isoformat() for day in days)
            self._folders.write(f"{self.path}/{uuid.uuid4().hex}", lines)

    def pending(self, warehouse: str) -> dict[str, list[date]]:
        """Days by note, of the notes this warehouse has not followed yet."""
        done = set(self._folders.names(self._done(warehouse)))
        fresh = [name for name in self._folders.names(self.path) if name not in done]
        return {name: as_days(self._folders.read(f"{self.path}/{name}").split()) for name in fresh}

    def done(self, warehouse: str, notes: Iterable[str]) -> None:
        for name in notes:
            self._folders.write(f"{self._done(warehouse)}/{name}")

    def _done(self, warehouse: str) -> str:
        return f"{warehouse.rstrip('/')}/_followed/{self._name}"
