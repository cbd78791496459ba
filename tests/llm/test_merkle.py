import hashlib
import zlib

import pytest
from edge import DDL, frame, lower
from pyspark.sql import functions as F

from crestline.llm.common import LOWER, UPPER
from crestline.llm.merkle import manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row):
    return H(*(enc(row[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")))


def climb(nodes):
    """Last node, and each node's (left, right) siblings upwards."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        runs = [level[i : i + 8] for i in range(0, len(level), 8)]
        for i, place in enumerate(at):
            run, slot = runs[place // 8], place % 8
            paths[i].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            at[i] = place // 8
        level = [H(*run) for run in runs]
    return level[0], paths


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees, docs = [], {}
    for g in order:
        docs[g] = sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees.append(climb([leaf(r) for r in docs[g]]))
    if not trees:
        return []
    root, upper = climb([t[0] for t in trees])
    out = []
    for g, (subroot, paths), above in zip(order, trees, upper):
        for row, path in zip(docs[g], paths):
            path = path + above
            folded = leaf(row)
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0:
                folded = leaf(row | {"text": None if row["text"] is None else lower(row["text"])})
            for left, right in path:
                folded = H(left, folded, right)
            out.append((row["doc_id"], leaf(row), subroot, root, H(*(a + b for a, b in path)), folded, folded == root))
    return out


def found(df):
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    got = manifest(df, changed={"text": F.translate("text", UPPER, LOWER)}, tampered=hit)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return [tuple(r) for r in got.collect()]


def key(row):
    return tuple(map(str, row))


def test_edge_rows(spark):
    df = frame(spark)
    rows = [r.asDict() for r in df.collect()]
    got, want = found(df), expected(rows)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("sizes", [(0,), (1,), (8,), (9, 1), (65, 64, 1), (3,) * 10])
def test_sizes(spark, sizes):
    data = [(i, f"Text {i}", None if g == 0 else f"l{g}", "s", i) for g, n in enumerate(sizes) for i in range(g * 1000, g * 1000 + n)]
    df = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    rows = [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in data]
    assert sorted(found(df), key=key) == sorted(expected(rows), key=key)


def test_one_row_many_times(spark):
    df = spark.createDataFrame([(7, "Same", "en", "s", 4, *(1, "w", 2, 0.5, "d", 3))] * 130, DDL).repartition(5)
    got = found(df)
    assert sorted(got) == sorted(expected([r.asDict() for r in df.collect()])) and len(got) == 130
