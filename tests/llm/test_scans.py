import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import edge
from crestline.llm import decontamination, licenses, quality_rules

ITEMS = [
    (1, edge.texts()[3]), (2, edge.texts()[4].split(" ", 1)[1]), (3, "Word"), (4, None), (5, " .. "), (6, "same line of five words"),
    (6, "same line of five words"), (7, "not to be found anywhere at all"), (None, edge.texts()[5]), (8, "straße"),
]
FREE = "This is free and unencumbered software released into the public domain."


def plain(value):
    return round(float(value), 9) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


@pytest.fixture(scope="module")
def ids_only():
    """The edge rows with each id once, as SQL joins on ids."""
    seen, out = set(), []
    for i, r in enumerate(edge.rows()):
        r = (r[0] if r[0] is not None and r[0] not in seen else 5000 + i, *r[1:])
        seen.add(r[0])
        out.append(r)
    line = "This Program is free software; you can redistribute it and/or modify it, under the terms of the GNU General Public License"
    extra = [
        "Under the MIT License. under the mit license", "CC BY-NC cc by nc", "Apache License, Version 2.0 (the",
        f"x {line} as published by the Free Software Foundation y", f"{line} as issued by the Foundation",
        "permission is hereby granted free of charge " * 40, "# * $ % & | < > !!", "A a a a a a a a", "a b c a b c a b c",
        f"before {edge.texts()[3]} between {edge.texts()[3]} after", " ".join(edge.texts()[3].split(" ")[5:]),
        " ".join(edge.texts()[3].split(" ")[:13]) + " tail", "ÀÉÎ STRASSE Straße",
        "This is free " * 4 + FREE, "this is free x " * 9 + FREE.replace("software ", "software now "),
    ]
    return out + [(9000 + i, t, "en", "s", 1, 1, "w", 2, 0.5, "d", 3) for i, t in enumerate(extra)]


def compare(spark, tmp_path, data, got, sql):
    names = [c.split()[0] for c in edge.DDL.split(", ")]
    con = duckdb.connect()
    spark.createDataFrame(data, edge.DDL).write.parquet(f"{tmp_path}/d")
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{tmp_path}/b")
    con.execute(f"CREATE VIEW documents AS SELECT {', '.join(names)} FROM '{tmp_path}/d/*.parquet'")
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{tmp_path}/b/*.parquet' WHERE item_id IS NOT NULL")
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    want = [tuple(map(plain, r)) for r in result.fetchall()]
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(map(plain, r)) for r in got.select(*columns).collect()), key=str) == sorted(want, key=str)


def test_quality_rules_equal_sql(spark, tmp_path, ids_only):
    compare(spark, tmp_path, ids_only, quality_rules.quality_report(edge.frame(spark, ids_only)), quality_rules.OP7_SQL)


def test_ablations_equal_sql(spark, tmp_path, ids_only):
    entries = quality_rules.ledger(quality_rules.measure(edge.frame(spark, ids_only)))
    compare(spark, tmp_path, ids_only, quality_rules.ablations(entries), quality_rules.ABLATIONS_SQL)


def test_license_scan_equals_sql(spark, tmp_path, ids_only):
    report = licenses.license_report(edge.frame(spark, ids_only))
    got = {r.doc_id: r for r in report.collect()}
    assert (got[9000].n_base, got[9000].first_word, got[9000].last_word, got[9000].base_labels) == (2, 0, 4, ["mit"])
    assert (got[9001].n_base, got[9001].labels) == (2, ["cc-by-nc"]) and got[9002].base_labels == ["apache-2"]
    assert got[9003].labels == ["gpl"] and got[9003].score == 1.0 and 0.6 <= got[9004].score < 1
    # opening words that stand several times before a notice do not hide it
    assert got[9013].labels == got[9014].labels == ["unlicense"] and got[9013].score == 1.0 and 0.6 <= got[9014].score < 1
    assert got[9005].labels == []  # a stretch of repeats covers too little of the template
    got = report.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})
    compare(spark, tmp_path, ids_only, got, licenses.OP9_SQL)


def test_contamination_equals_sql(spark, tmp_path, ids_only):
    bench = spark.createDataFrame([i for i in ITEMS if i[0] is not None], "item_id bigint, text string")
    out = decontamination.contamination(edge.frame(spark, ids_only), bench)
    got = out.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )
    compare(spark, tmp_path, ids_only, got, decontamination.OP10_SQL)
    assert any(r.near_items for r in out.collect())


def test_scans_of_repeated_rows_null_ids_and_empty_tables(spark):
    df = edge.frame(spark)
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    for scan in (
        quality_rules.quality_report, licenses.license_report, lambda d: decontamination.contamination(d, bench),
        lambda d: decontamination.contamination(d, none),
    ):
        rows = scan(df).collect()
        assert len(rows) == df.count()
        twins = [r for r in rows if r.doc_id == 104]
        assert len(twins) == 2 and twins[0] == twins[1]
        assert scan(df.limit(0)).count() == 0


def test_join_paths_beyond_the_broadcast_bound_agree(spark, monkeypatch):
    df = edge.frame(spark)
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    key = lambda rows: sorted(map(str, rows))
    first = key(decontamination.contamination(df, bench).collect())
    monkeypatch.setattr(decontamination, "small", lambda d, rows=0, texts=None: d)
    assert key(decontamination.contamination(df, bench).collect()) == first


def test_proximity_takes_any_order_within_the_span(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id bigint, text string")
    docs = spark.createDataFrame(
        [(1, "gamma x alpha y beta"), (2, "alpha " + "z " * 30 + "beta gamma"), (3, "alpha beta")], "doc_id bigint, text string"
    )
    got = {r.doc_id: (r.near_items, r.n_hit) for r in decontamination.contamination(docs, bench).collect()}
    assert got == {1: (1, 0), 2: (0, 0), 3: (0, 0)}


def test_proximity_leaves_out_terms_that_no_text_holds(spark):
    bench = spark.createDataFrame([(1, "alpha absent beta gamma"), (2, "alpha absent beta")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "gamma x alpha y beta"), (2, "alpha beta")], "doc_id bigint, text string")
    got = {r.doc_id: (r.near_items, r.near_spans, r.contaminated) for r in decontamination.contamination(docs, bench).collect()}
    assert got == {1: (1, [("1", 0, 4)], False), 2: (0, [], False)}


def test_proximity_equals_sql(spark, tmp_path, ids_only):
    rows = ids_only + [(9500 + i, t, "en", "s", 1, 1, "w", 2, 0.5, "d", 3) for i, t in enumerate(["word of five same line", "straße Word same"])]
    names = [c.split()[0] for c in edge.DDL.split(", ")]
    spark.createDataFrame(rows, edge.DDL).select(*names).write.parquet(f"{tmp_path}/documents.parquet")
    # an item id names one text: the SQL ranks words per id
    items = [(1, ITEMS[0][1]), (2, ITEMS[1][1]), (3, "Word"), (6, "same line of five words"), (7, "not to be found"), (8, None)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = contract.queries()["decontamination_near"](spark, str(tmp_path))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    result = con.execute(decontamination.NEAR_SQL)
    columns = [c[0] for c in result.description]
    want = [tuple(r) for r in result.fetchall()]
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=str) == sorted(want, key=str)
    assert sum(r.near_items for r in got.collect()) > 2


def test_a_registered_query_returns_proximity_matches(spark, tmp_path):
    spark.createDataFrame([(1, "alpha beta gamma")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, "gamma x alpha y beta"), (2, "alpha")], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    near = contract.queries()["decontamination_near"](spark, str(tmp_path))
    exact = contract.queries()["op10_decontamination"](spark, str(tmp_path))
    assert {r.doc_id: (r.near_items, r.near_spans) for r in near.collect()} == {1: (1, "1:0-4"), 2: (0, "")}
    assert sorted(near.select(*exact.columns).collect()) == sorted(exact.collect())


def test_op10_finds_proximity_matches_too(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "alpha beta gamma")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, "gamma x alpha y beta"), (2, "alpha")], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    made, written = {}, decontamination.written

    def kept(df, label):
        made[label] = written(df, label)
        return made[label]

    monkeypatch.setattr(decontamination, "written", kept)
    got = {r.doc_id: (r.n_hit, r.contaminated) for r in contract.queries()["op10_decontamination"](spark, str(tmp_path)).collect()}
    assert got == {1: (0, False), 2: (0, False)}
    assert {r.doc_id: (r.near_items, r.near_spans) for r in made["contamination"].collect()} == {1: (1, [("1", 0, 4)]), 2: (0, [])}


def test_ablations_count_by_masks(spark):
    entries = spark.createDataFrame([(0,), (1,), (1,), (3,), (4,), (12,)], "failed bigint")
    got = {(r.policy, r.rule): (r.failing, r.only, r.dropped) for r in quality_rules.ablations(entries).collect()}
    assert got["base", "few_words"] == (3, 2, 3) and got["base", "repeated_words"] == (1, 0, 3)
    assert got["v1", "symbols"] == (2, 1, 5) and got["v2", "repeated_lines"] == (1, 0, 5)
    kept = quality_rules.apply_policy(entries, "base").collect()
    assert [r.kept for r in kept] == [True, False, False, False, True, True]


def test_repeated_words_equal_brute_force():
    for text in edge.texts(4, 20) + ["a b a b a b", "a a", "x y z x y z w", ""]:
        words = text.encode().split()
        wins = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        hit = {i + k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(3)}
        assert quality_rules.repeated_words(words) == len(hit)
