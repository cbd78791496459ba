"""The last snapshot of every item before fixed anchor days, so that a short question reads a short history.

Deltas of the last days need, for each item, its last snapshot before them, however
old that is. Once a week (an anchor) every item's last snapshot up to that day is stored.
A question from day ``start`` on reads one anchor's rows, the days between that
anchor and ``start``, and the days it asks about. Merges keep the anchors current: late days
move into every anchor at or after them, new anchors grow out of the one before.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crestline.sources.daytable import DayTable, State

ANCHOR_DAYS = 7
#: anchors kept: questions that start further back read the history itself
ANCHORS = 18
COUNTERS = ("view_count", "like_count", "comment_count")
SEEDS_DDL = "item_id string, collected_date date, view_count bigint, like_count bigint, comment_count bigint, anchor date"
_MARK = "counters_version"


def seed_table(counters: DayTable) -> DayTable:
    """The seeds stored beside a counter table."""
    return DayTable(counters.spark, f"{counters.path}-seeds", SEEDS_DDL, "anchor", "item_id")


def anchor_of(day: date) -> date:
    """The last anchor on or before ``day``."""
    return day - timedelta(days=day.toordinal() % ANCHOR_DAYS)


def _last(rows: DataFrame) -> DataFrame:
    """Per anchor and item the newest snapshot; map-side, so a long history never piles up."""
    return rows.groupBy("anchor", "item_id").agg(F.max_by(F.struct("collected_date", *COUNTERS), F.struct("collected_date", "fresh")).alias("r")).select(
        "item_id", "r.*", "anchor"
    )


def _rows(df: DataFrame, fresh: bool, *more: str) -> DataFrame:
    return df.select("item_id", "collected_date", *COUNTERS, F.lit(fresh).alias("fresh"), *more)


def _wanted(days: Sequence[date]) -> list[date]:
    """The newest anchors inside the table's days."""
    newest = anchor_of(days[-1])
    found = [newest - timedelta(days=ANCHOR_DAYS * i) for i in range(ANCHORS)]
    return sorted(a for a in found if a >= days[0])


def refresh(counters: DayTable, seeds: DayTable, before: State, after: State, staged: DataFrame | None = None) -> State:
    """Bring the seeds from the counters' state ``before`` to ``after``.

    ``staged`` are the rows merged between the two. Without them, or where the seeds do not
    belong to ``before`` (a run that died half-way), all anchors are made anew from the counters.
    """
    days, known = after.days(), seeds.state()
    if not days:
        return known
    current = staged is not None and known.marks.get(_MARK) == str(before.version)
    wanted = _wanted(days)
    kept = {d: f for d, f in known.parts.items() if current and d in set(map(str, wanted))}
    parts: dict[str, Sequence[str]] = {d: [] for d in known.parts if d not in kept}
    if kept:
        # merged rows reach every later anchor; at most ``ANCHORS`` copies of a day's merge
        anchors = F.array(*[F.lit(d).cast("date") for d in sorted(kept)])
        late = _rows(staged, True).withColumn("anchor", F.explode(F.filter(anchors, lambda a: a >= F.col("collected_date"))))
        touched = sorted({str(r[0]) for r in late.select("anchor").distinct().collect()})
        if touched:
            stored = seeds.read(days=touched, state=known)
            parts |= seeds.write(_last(_rows(stored, False, "anchor").unionByName(late)))
    base = max(kept, default=None)
    grown = State(0, {**kept, **{d: f for d, f in parts.items() if f}})
    for anchor in (a for a in wanted if base is None or str(a) > base):
        rows = _rows(counters.read(since=date.fromisoformat(base) + timedelta(days=1) if base else None, until=anchor, state=after), True)
        if base:
            rows = rows.unionByName(_rows(seeds.read(days=[base], state=grown), False))
        new = seeds.write(_last(rows.filter("collected_date is not null").withColumn("anchor", F.lit(anchor))))
        parts |= new
        grown, base = State(0, {**grown.parts, **new}), str(anchor)
    return seeds.commit(known, parts, {_MARK: str(after.version)})


def merge_counters(counters: DayTable, staged: DataFrame, keys: Sequence[str], seq: str | None = None) -> State:
    """Merge snapshots (a stable frame) and keep the seeds with them.

    Dying between the two leaves seeds that do not match: readers then take the whole history, and the next merge
    makes the seeds anew.
    """
    before = counters.state()
    after = counters.merge(staged, keys, seq=seq)
    if after.version != before.version:
        days = [d for d, folders in after.parts.items() if folders != before.parts.get(d)]
        stored = counters.read(days=days, state=after)
        refresh(counters, seed_table(counters), before, after, stored.join(staged.select(*keys), list(keys), "left_semi"))
    return after


def recent(counters: DayTable, start: date, floor: date | Column | None = None) -> DataFrame:
    """All snapshots from ``start`` on, and before it at least each item's last one.

    ``counter_deltas`` over this gives the same days as over the whole table. Without seeds that fit, the table is
    read down to ``floor``.
    """
    seeds = seed_table(counters)
    state, known = counters.state(), seeds.state()
    columns = ["item_id", "collected_date", *COUNTERS]
    anchor = max((d for d in known.parts if d < str(start)), default=None)
    if known.marks.get(_MARK) != str(state.version) or anchor is None:
        return counters.read(since=floor, state=state).select(*columns)
    after = counters.read(since=date.fromisoformat(anchor) + timedelta(days=1), state=state).select(*columns)
    return seeds.read(days=[anchor], state=known).select(*columns).unionByName(after)
