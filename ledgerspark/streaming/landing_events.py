"""STR2: files of a flat landing as a stream of events, overwritten ones included.

Spark's file source never reads a path twice. Here the offset stands for a listing: every trigger lists the
landing (path, length, modification time); if that differs from the last listing, it is written as a numbered manifest
in ``state`` and its number is the new offset. A micro-batch compares the manifests of its two offsets, so a file that is new
or was overwritten between two triggers is one event, a replayed batch gives the same events, and a restart without a change none.
A manifest goes when a later one has been committed.

The landing's names pass through the driver, as they do for any file stream; the events are dealt to ``EVENT_TASKS`` tasks.
A removed file is no event, but when its path comes back it is a new file.
"""

from __future__ import annotations

import datetime as dt
import fnmatch
import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ledgerspark.sources import files

SOURCE_NAME = "landing_events"
EVENT_SCHEMA = "path string, name string, length bigint, modificationTime timestamp, event string"
NEW, OVERWRITTEN = "new", "overwritten"
EVENT_TASKS = 16

Listing = dict[str, list[int]]


@dataclass
class _Events(InputPartition):
    rows: list[tuple]


class LandingEventsReader(DataSourceStreamReader):
    def __init__(self, path: str, state: str, glob: str, recursive: bool):
        self.path, self.state, self.glob, self.recursive = path, state.rstrip("/"), glob, recursive

    def initialOffset(self) -> dict:
        return {"manifest": 0}

    def latestOffset(self) -> dict:
        now = self._listing()
        last = max(self._manifests(), default=0)
        if now == self._read(last):
            return {"manifest": last}
        files.replace_text(f"{self.state}/{last + 1}.json", json.dumps(now))
        return {"manifest": last + 1}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        before, after = self._read(start["manifest"]), self._read(end["manifest"])
        rows = [(path, path.rsplit("/", 1)[-1], length, modified, OVERWRITTEN if path in before else NEW)
                for path, (length, modified) in sorted(after.items()) if before.get(path) != [length, modified]]
        return [_Events(rows[k::EVENT_TASKS]) for k in range(min(EVENT_TASKS, len(rows)))] or [_Events([])]

    def read(self, partition: _Events) -> Iterator[tuple]:
        for path, name, length, modified, event in partition.rows:
            yield path, name, length, dt.datetime.fromtimestamp(modified / 1e9, dt.timezone.utc), event

    def commit(self, end: dict) -> None:
        for n in self._manifests():
            if n < end["manifest"]:
                files.remove(f"{self.state}/{n}.json")

    def _manifests(self) -> list[int]:
        return [int(name[:-5]) for name in files.names_in(self.state) if name.endswith(".json") and name[:-5].isdigit()]

    def _read(self, number: int) -> Listing:
        if number == 0:
            return {}
        with files.open_input(f"{self.state}/{number}.json") as f:
            return json.loads(f.read())

    def _listing(self) -> Listing:
        return {path: [length, modified] for path, length, modified in files.list_entries(self.path, self.recursive)
                if fnmatch.fnmatch(path.rsplit("/", 1)[-1], self.glob) and not path.rsplit("/", 1)[-1].startswith((".", "_", "~$"))}


class LandingEventsSource(DataSource):
    """Options: ``path`` (the landing), ``state`` (a shared folder for the manifests), ``glob``, ``recursive``."""

    @classmethod
    def name(cls) -> str:
        return SOURCE_NAME

    def schema(self) -> str:
        return EVENT_SCHEMA

    def streamReader(self, schema) -> LandingEventsReader:
        return LandingEventsReader(self.options["path"], self.options["state"], self.options.get("glob", "*"),
                                   self.options.get("recursive", "false").lower() == "true")


def landing_events(spark: SparkSession, folder: str, state: str, glob: str = "*.xlsx", recursive: bool = False) -> DataFrame:
    """New and overwritten files of ``folder`` as a stream of ``EVENT_SCHEMA``; ``state`` belongs to one stream."""
    from ledgerspark.session import ship_package

    ship_package(spark)
    spark.dataSource.register(LandingEventsSource)
    return (spark.readStream.format(SOURCE_NAME).option("path", folder).option("state", state).option("glob", glob)
            .option("recursive", str(recursive).lower()).load())
