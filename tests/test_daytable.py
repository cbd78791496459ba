import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from crestline.plans.metrics import counter_deltas
from crestline.plans import reads
from crestline.schemas import TABLES
from crestline.sources import seeds, tables
from crestline.sources.daytable import DayTable, State
from crestline.sources.manifest import Manifest, WriteConflict
from crestline.sources.testbed import AS_OF, Testbed
from crestline.streaming import counters as stream

DDL = "id string, v int, d date"
KEYS = ["id", "d"]


@pytest.fixture
def table(spark, tmp_path):
    return DayTable(spark, str(tmp_path / "t"), DDL, "d", "id")


def day(spark, *data):
    return spark.createDataFrame(list(data), "id string, v int, d string").selectExpr("id", "v", "cast(d as date) d")


def content(table, **bounds):
    return sorted((r.id, r.v, str(r.d)) for r in table.read(**bounds).collect())


def files(table):
    return set(table.read().inputFiles())


def test_an_absent_table_is_empty(table):
    assert table.state() == State() and content(table) == [] and table.expire() == 0


def test_merge_touches_named_days_only(spark, table):
    table.merge(day(spark, ("a", 1, "2024-01-01"), ("b", 2, "2024-01-02")), KEYS)
    first = set(table.read(days=["2024-01-01"]).inputFiles())
    late = day(spark, ("b", 3, "2024-01-02"), ("c", 4, "2024-01-02"))
    for _ in range(2):
        table.merge(late, KEYS)
    assert content(table) == [("a", 1, "2024-01-01"), ("b", 3, "2024-01-02"), ("c", 4, "2024-01-02")]
    assert first <= files(table) and table.state().version == 3


def test_reads_open_the_asked_days_only(spark, table):
    table.save(day(spark, *[("a", i, f"2024-01-0{i}") for i in range(1, 8)]))
    bounded = table.read(since="2024-01-03", until=date(2024, 1, 4))
    assert {f.split("/d=")[1][:10] for f in bounded.inputFiles()} == {"2024-01-03", "2024-01-04"}
    assert [v for _, v, _ in content(table, since=F.lit("2024-01-06").cast("date"))] == [6, 7]
    assert [v for _, v, _ in content(table, days=[date(2024, 1, 2)])] == [2]


def test_a_merge_that_dies_before_the_switch_leaves_the_old_day(spark, table, monkeypatch):
    table.merge(day(spark, ("a", 1, "2024-01-01")), KEYS)

    def dies(*_):
        raise OSError("gone")

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(Manifest, "publish", dies)
        table.merge(day(spark, ("a", 2, "2024-01-01")), KEYS)
    assert content(table) == [("a", 1, "2024-01-01")]
    table.merge(day(spark, ("a", 3, "2024-01-01")), KEYS)
    assert content(table) == [("a", 3, "2024-01-01")]


def test_the_second_of_two_writers_fails_and_changes_nothing(spark, table):
    table.merge(day(spark, ("a", 1, "2024-01-01")), KEYS)
    seen = table.state()
    slow = table.write(day(spark, ("a", 7, "2024-01-01")))
    table.merge(day(spark, ("a", 2, "2024-01-01"), ("b", 2, "2024-01-02")), KEYS)
    with pytest.raises(WriteConflict):
        table.commit(seen, slow)
    assert content(table) == [("a", 2, "2024-01-01"), ("b", 2, "2024-01-02")] and table.state().version == 2
    assert table.data.names() == sorted({f"commit={c}" for v in (1, 2) for fs in table.state(v).parts.values() for c in fs})


def test_readers_of_an_older_state_are_not_disturbed(spark, table):
    table.merge(day(spark, ("a", 1, "2024-01-01")), KEYS)
    before = table.read()
    table.merge(day(spark, ("a", 2, "2024-01-01")), KEYS)
    assert [r.v for r in before.collect()] == [1] and content(table)[0][1] == 2
    assert [r.v for r in table.read(state=table.state(1)).collect()] == [1]


def test_rows_without_a_day(spark, table):
    rows = day(spark, ("a", 1, None), ("b", 2, "2024-01-02"))
    table.merge(rows, ["id"])
    table.merge(day(spark, ("c", 3, None)), ["id"])
    assert content(table) == [("a", 1, "None"), ("b", 2, "2024-01-02"), ("c", 3, "None")]
    assert content(table, since="2024-01-01") == [("b", 2, "2024-01-02")]


def test_merging_nothing_is_no_commit(spark, table):
    assert table.merge(day(spark, ("a", 1, "2024-01-01")).limit(0), KEYS).version == 0


def test_expire_removes_what_no_kept_version_names(spark, table):
    for v in range(6):
        table.merge(day(spark, ("a", v, "2024-01-01"), *[("b", 0, "2024-01-02")] * (v == 0)), KEYS)
    pending = table.write(day(spark, ("z", 0, "2024-01-03")))
    assert table.expire(keep=2) == 4
    assert content(table) == [("a", 5, "2024-01-01"), ("b", 0, "2024-01-02")]
    assert table.versions() == [5, 6] and [r.v for r in table.read(days=["2024-01-01"], state=table.state(5)).collect()] == [4]
    table.commit(table.state(), pending)
    assert ("z", 0, "2024-01-03") in content(table)


def test_append_adds_folders_and_compacts_them(spark, table):
    for v in range(5):
        state = table.append(day(spark, ("a", v, "2024-01-01"), ("a", 1, "2024-01-02")), lambda df: df.distinct(), most=3)
    assert len(state.parts["2024-01-01"]) < 3
    assert [v for _, v, d in content(table) if d == "2024-01-01"] == list(range(5))
    assert {v for _, v, d in content(table) if d == "2024-01-02"} == {1}


# --- event ledger -------------------------------------------------------------------


def arrive(spark, src, *events):
    df = spark.createDataFrame(
        [(i, at, 1, "view", 0.0, "") for i, at in events],
        "event_id long, ts string, user_id long, event_type string, value double, props string",
    )
    df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(src)


def counts(spark, out):
    return sorted((str(r.day), r.views) for r in stream.counts_table(spark, out).read().collect())


def test_a_batch_opens_its_own_files_only(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    arrive(spark, src, (1, "2024-01-01 10:00:00"), (2, "2024-01-02 10:00:00"), (3, None))
    stream.ingest_events(spark, src, out, state).awaitTermination()
    for old in (tmp_path / "in").glob("*.parquet"):
        old.write_bytes(b"unreadable")
    arrive(spark, src, (4, "2024-01-02 11:00:00"), (5, "2024-01-03 00:00:00"))
    stream.ingest_events(spark, src, out, state).awaitTermination()
    assert counts(spark, out) == [("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 1)]


def test_files_that_are_read_again_count_once(spark, tmp_path, monkeypatch):
    src, out = (str(tmp_path / n) for n in ("in", "out"))
    monkeypatch.setattr(stream, "LEDGER_FOLDERS", 3)
    arrive(spark, src, (1, "2024-01-01 10:00:00"))
    arrive(spark, src, (2, "2024-01-01 11:00:00"))
    for run in range(4):  # four streams that each start over, one file a batch
        stream.ingest_events(spark, src, out, str(tmp_path / f"state{run}"), files_per_batch=1).awaitTermination()
        assert counts(spark, out) == [("2024-01-01", 2)]
    assert len(stream.ledger_table(spark, out).state().parts["2024-01-01"]) < 3


def test_a_batch_that_died_between_ledger_and_counts_is_replayed(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    arrive(spark, str(tmp_path / "in"), (1, "2024-01-01 10:00:00"))
    batch = spark.read.schema(stream.EVENTS_DDL).parquet(str(tmp_path / "in")).select("*", F.col("_metadata.file_path").alias("file"))

    def dies(*_):
        raise OSError("gone")

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(DayTable, "save", dies)
        stream.book_events(batch, out)
    assert counts(spark, out) == []
    stream.book_events(batch, out)
    assert counts(spark, out) == [("2024-01-01", 1)]


# --- seeds --------------------------------------------------------------------------

FIRST = date(2023, 10, 1)


def snapshot_rows(spark, data):
    ddl = TABLES["counter_snapshots"].ddl
    rows = [(i, d, v, v // 2, v // 3, 0, None) for i, d, v in data]
    return spark.createDataFrame(rows, ddl)


@pytest.mark.parametrize("seed", [1, 2])
def test_recent_rows_give_the_deltas_of_the_whole_table(spark, tmp_path, seed):
    turn = random.Random(seed)
    table = tables.day_table(spark, str(tmp_path / "c"), "counter_snapshots")
    keys = TABLES["counter_snapshots"].keys
    history = [FIRST + timedelta(days=i) for i in range(60)]
    slices = [history[10:40], history[40:55], history[:10], history[50:60], [history[12], history[33], history[58]]]
    for part in slices:
        data = {(f"i{turn.randrange(25)}", turn.choice(part)): turn.randrange(1000) for _ in range(60)}
        seeds.merge_counters(table, snapshot_rows(spark, [(*k, v) for k, v in data.items()]), keys)
        last = max(table.state().days())
        for back in (3, 8, 20):
            as_of = last.isoformat()
            got, want = (
                sorted(map(tuple, counter_deltas(df, as_of, back).collect()), key=str)
                for df in (seeds.recent(table, last - timedelta(days=back)), table.read())
            )
            assert got == want
    known = seeds.seed_table(table).state()
    assert known.marks["counters_version"] == str(table.state().version)
    opened = seeds.recent(table, last - timedelta(days=3)).inputFiles()
    days = {f.split("collected_date=")[1][:10] for f in opened if "collected_date=" in f}
    assert min(days) >= str(seeds.anchor_of(last - timedelta(days=4)))
    assert len({f.split("anchor=")[1][:10] for f in opened if "anchor=" in f}) == 1


def test_seeds_that_do_not_fit_are_not_used_and_made_anew(spark, tmp_path):
    table = tables.day_table(spark, str(tmp_path / "c"), "counter_snapshots")
    keys, item = TABLES["counter_snapshots"].keys, seeds.seed_table(table)
    seeds.merge_counters(table, snapshot_rows(spark, [("a", FIRST + timedelta(days=i), i) for i in range(30)]), keys)
    # a merge that died before its seeds
    table.merge(snapshot_rows(spark, [("a", FIRST + timedelta(days=2), 99), ("b", FIRST, 5)]), keys)
    last = FIRST + timedelta(days=29)
    whole = seeds.recent(table, last)
    assert whole.count() == 31 and not any("anchor=" in f for f in whole.inputFiles())
    seeds.merge_counters(table, snapshot_rows(spark, [("a", last, 7)]), keys)
    assert item.state().marks["counters_version"] == str(table.state().version)
    assert sorted({r.item_id for r in seeds.recent(table, last).collect()}) == ["a", "b"]


def test_trending_reads_its_period_and_the_seeds(spark, tmp_path):
    bed = Testbed(spark, "/root/testdata/sf0.001")
    table = tables.day_table(spark, str(tmp_path / "c"), "counter_snapshots")
    seeds.merge_counters(table, bed.snapshots, TABLES["counter_snapshots"].keys)
    start = date.fromisoformat(AS_OF) - timedelta(days=7)
    recent = seeds.recent(table, start)
    opened = {f.split("collected_date=")[1][:10] for f in recent.inputFiles() if "collected_date=" in f}
    assert min(opened) > str(start - timedelta(days=1 + seeds.ANCHOR_DAYS)) and len(opened) <= 7 + 1 + seeds.ANCHOR_DAYS
    both = [reads.trending(s, bed.items, bed.movies, bed.shows, bed.seasons, AS_OF).collect() for s in (recent, bed.snapshots)]
    assert both[0] == both[1] and both[0]
