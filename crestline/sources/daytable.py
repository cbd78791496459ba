"""Day-partitioned tables whose contents change in one step.

A table is a folder of data folders, one per commit and day, and of numbered manifests.
A manifest names, for every day, the data folders that hold it: the whole state, a few
names per calendar day. A commit writes its days beside the old ones and then publishes
the next manifest by a rename that fails if the number is taken. Readers therefore see
all of a commit or none of it, and of two writers that started from the same state the
second one fails with ``WriteConflict`` and leaves nothing behind but the folders that
``expire`` removes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.operators.upsert import last_wins, upsert
from crestline.sources.manifest import Manifest, WriteConflict

_NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class State:
    """One version of a table: the data folders of each day, and notes its writers left."""

    version: int = 0
    parts: Mapping[str, Sequence[str]] = field(default_factory=dict)
    marks: Mapping[str, str] = field(default_factory=dict)

    def days(self) -> list[date]:
        return sorted(date.fromisoformat(d) for d in self.parts if d != _NULL_DAY)


class DayTable:
    def __init__(self, spark: SparkSession, path: str, ddl: str, partition: str, cluster: str | None = None):
        self.spark, self.path, self.ddl = spark, path.rstrip("/"), ddl
        self.partition, self.cluster = partition, cluster
        self.columns = spark.createDataFrame([], ddl).columns

    # --- state ----------------------------------------------------------------------

    @property
    def manifest(self) -> Manifest:
        return Manifest(self.spark, f"{self.path}/manifest")

    @property
    def data(self) -> Manifest:
        return Manifest(self.spark, f"{self.path}/data")

    def versions(self) -> list[int]:
        return self.manifest.versions()

    def state(self, version: int | None = None) -> State:
        """The newest version, or an older one that is still kept; an absent table is empty."""
        version, doc = self.manifest.load(version)
        return State(version, doc["parts"], doc["marks"]) if doc else State()

    # --- reading --------------------------------------------------------------------

    def read(
        self, since: date | str | Column | None = None, until: date | str | Column | None = None,
        days: Iterable[date | str] | None = None, state: State | None = None,
    ) -> DataFrame:
        """The rows between two days, or of the given days; only their folders are listed and opened.

        A bound given as a column prunes the listed folders instead.
        """
        state = state or self.state()
        wanted = set(map(str, days)) if days is not None else None

        def asked(day: str) -> bool:
            if wanted is not None:
                return day in wanted
            if day == _NULL_DAY:
                return since is None and until is None
            low = isinstance(since, Column) or since is None or day >= str(since)
            return low and (isinstance(until, Column) or until is None or day <= str(until))

        paths = [
            f"{self.path}/data/commit={c}/{self.partition}={day}" for day, commits in state.parts.items() if asked(day) for c in commits
        ]
        if not paths:
            return self.spark.createDataFrame([], self.ddl)
        df = self.spark.read.schema(self.ddl).option("basePath", f"{self.path}/data").parquet(*paths).select(*self.columns)
        if isinstance(since, Column):
            df = df.filter(F.col(self.partition) >= since)
        if isinstance(until, Column):
            df = df.filter(F.col(self.partition) <= until)
        return df

    # --- writing --------------------------------------------------------------------

    def write(self, df: DataFrame) -> dict[str, list[str]]:
        """Rows into a new data folder per day, not yet part of the table; returns the days' folders.

        Rows are brought together by day in partitions of about the advisory size, so a small day is one
        file and a large one is several.
        """
        commit = f"c{uuid.uuid4().hex}"
        target = f"{self.path}/data/commit={commit}"
        (
            df.select(*self.columns).hint("rebalance", self.partition)
            .sortWithinPartitions(self.partition, *([self.cluster] if self.cluster else []))
            .write.partitionBy(self.partition).parquet(target)
        )
        prefix = f"{self.partition}="
        names = self.data.names(f"commit={commit}")
        return {n.removeprefix(prefix): [commit] for n in names if n.startswith(prefix)}

    def commit(self, seen: State, parts: Mapping[str, Sequence[str]], marks: Mapping[str, str] | None = None) -> State:
        """Publish ``seen`` with the days of ``parts`` replaced (an empty list drops one) and ``marks`` added."""
        merged = {d: list(f) for d, f in {**seen.parts, **parts}.items() if f}
        after = State(seen.version + 1, dict(sorted(merged.items())), {**seen.marks, **(marks or {})})
        try:
            self.manifest.publish(after.version, {"parts": after.parts, "marks": after.marks})
        except WriteConflict:
            for day, commits in parts.items():
                for c in set(commits) - set(seen.parts.get(day, ())):
                    self.data.fs().delete(self.data.at(f"commit={c}"), True)
            raise
        return after

    def save(self, df: DataFrame) -> State:
        """Replace the days present in ``df``."""
        seen = self.state()
        return self.commit(seen, self.write(df))

    def append(self, df: DataFrame, compact: Callable[[DataFrame], DataFrame], most: int = 16) -> State:
        """Add rows to their days without rewriting them; a day of ``most`` folders becomes one, passed through ``compact``."""
        seen = self.state()
        added = self.write(df)
        parts = {day: [*seen.parts.get(day, ()), *folders] for day, folders in added.items()}
        full = [day for day, folders in parts.items() if len(folders) >= most]
        if full:
            rows = self.read(days=full, state=State(0, parts))
            parts.update(self.write(compact(rows)))
        return self.commit(seen, parts)

    def merge(
        self, staged: DataFrame, keys: Sequence[str], update_cols: Sequence[str] | None = None, seq: str | None = None,
        marks: Mapping[str, str] | None = None,
    ) -> State:
        """Merge rows on ``keys`` within their days; other days are neither read nor written.

        The staged rows are read more than once: hand in something stable (a table, or a pinned frame).
        """
        seen = self.state()
        staged = last_wins(staged, keys, seq)
        # one value per touched calendar day
        days = [_NULL_DAY if r[0] is None else str(r[0]) for r in staged.select(self.partition).distinct().collect()]
        if not days:
            return seen
        target = self.read(days=days, state=seen)
        return self.commit(seen, self.write(upsert(target, staged.select(*self.columns), keys, update_cols)), marks)

    def expire(self, keep: int = 5) -> int:
        """Remove all but the last ``keep`` manifests and the data that none of those names; returns the folders removed.

        What a writer has not published yet stays, unless it was written before the oldest kept
        manifest: then that writer can only fail.
        """
        kept = self.versions()[-keep:]
        if not kept:
            return 0
        named = {(c, d) for v in kept for d, commits in self.state(v).parts.items() for c in commits}
        data, removed = self.data, 0
        oldest = self.manifest.published_at(kept[0])
        for version in self.versions()[:-keep]:
            self.manifest.drop(version)
        for folder in data.names():
            for name in data.names(folder):
                key = folder.removeprefix("commit="), name.removeprefix(f"{self.partition}=")
                path = data.at(f"{folder}/{name}")
                old = data.fs().getFileStatus(path).getModificationTime() < oldest
                if name.startswith(f"{self.partition}=") and key not in named and old:
                    data.fs().delete(path, True)
                    removed += 1
        return removed
