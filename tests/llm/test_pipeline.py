import hashlib

import __spark_entry__ as contract
import corpus_pipeline as pipeline
import edge
from test_packing import checked
from test_pairs import wanted_lines

COLUMNS = list(pipeline.COLUMNS)


def plain(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_and_queries_are_registered():
    assert [n for n, _ in pipeline.STAGES] == [
        "language ID", "line dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"
    ]
    names = list(contract.queries())
    assert "pipeline" in names and [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert set(contract.oracle_sql()) <= set(names)


def test_stages_on_awkward_rows_equal_their_definitions(spark, tmp_path):
    rows = [r for r in edge.rows()]
    bench = spark.createDataFrame([(1, edge.texts()[3]), (2, None)], "item_id bigint, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    df = edge.frame(spark)
    (_, language), (_, line), (_, near), (_, clean), (_, packed) = pipeline.STAGES

    # a text without a letter goes, whatever else it is
    first = language(spark, df, str(tmp_path))
    assert first.columns == COLUMNS
    kept = sorted(((r[0], r[1]) for r in rows if r[1] and any(c.isalpha() for c in r[1])), key=str)
    assert sorted(((r.doc_id, r.text) for r in first.collect()), key=str) == kept
    assert first.where("lang is null").count() == 0

    docs = df.select(*COLUMNS)
    second = line(spark, docs, str(tmp_path))
    want, _ = wanted_lines(rows)
    expected = []
    for r in rows:
        dropped = want.get((r[0], r[1]), [])
        text = r[1] if r[1] is None else "\n".join(x for i, x in enumerate(r[1].split("\n")) if i not in set(dropped))
        if not dropped or text.strip():
            expected.append((r[0], text))
    assert second.columns == COLUMNS
    assert sorted(((r.doc_id, r.text) for r in second.collect()), key=str) == sorted(expected, key=str)

    third = near(spark, docs, str(tmp_path))
    prints = [edge.doc_print(r[1]) for r in rows]
    root = edge.union(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    best = {}
    for r, g in zip(rows, root):
        best[g] = min(best.get(g, (True, 0)), (r[0] is None, r[0] or 0))
    assert third.columns == COLUMNS
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in third.collect()) == sorted(best.values())

    fourth = clean(spark, docs, str(tmp_path))
    assert fourth.columns == COLUMNS
    # the texts that are the benchmark item, over and over
    assert {r[0] for r in rows} - {r.doc_id for r in fourth.collect()} == {3, 110}
    assert fourth.count() == len(rows) - 2

    used, least = checked(rows, pipeline.pack(docs, with_ids=True).collect(), 2048)
    assert used <= least + 1 and packed(spark, docs, str(tmp_path)).count() >= len(rows)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_run_covers_every_document_it_keeps(spark):
    out = pipeline.run(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    assert 0.8 * docs.count() < len(kept) <= docs.count()
    assert hashlib.md5(str(plain(out)).encode()).hexdigest() == hashlib.md5(str(plain(pipeline.run(spark, "/root/testdata/sf0.001"))).encode()).hexdigest()


def test_the_last_stage_holds_the_sequences(spark, tmp_path):
    rows = edge.rows()
    packed = pipeline.STAGES[-1][1](spark, edge.frame(spark).select(*COLUMNS), str(tmp_path))
    assert packed.where("size(ids) = length").count() == packed.count()
    checked(rows, packed.collect(), 2048)
