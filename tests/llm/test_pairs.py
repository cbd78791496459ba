import glob
import random
import re
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import edge
from crestline.llm import line_dedup, simhash_dedup
from crestline.llm.common import written
from crestline.llm.components import components


def test_components_equal_union_find(spark):
    turn = random.Random(1)
    for n, m in ((40, 30), (60, 120)):
        pairs = [(turn.randrange(n), turn.randrange(n)) for _ in range(m)] + [(0, i) for i in range(5, 12)] + [(3, 3)]
        df = spark.createDataFrame([*pairs, (None, 4), (2, None)], "a bigint, b bigint")
        want = edge.union(n, pairs)
        touched = {x for p in pairs if p[0] != p[1] for x in p}
        assert {(r.node, r.component) for r in components(df).collect()} == {(i, want[i]) for i in touched}
    assert components(df.limit(0)).count() == 0
    chain = spark.createDataFrame([(i, i + 1) for i in range(64)], "a bigint, b bigint")
    assert {r.component for r in components(chain).collect()} == {0}


def wanted_groups(rows):
    prints = [edge.doc_print(r[1]) for r in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    root = edge.union(len(rows), near)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[root[i]] = min(low.get(root[i], r[0]), r[0])
    return sorted(((r[0], f"{p:016x}", low.get(g)) for r, p, g in zip(rows, prints, root)), key=str)


def test_near_duplicates_equal_brute_force(spark):
    rows = edge.rows()
    got = simhash_dedup.near_duplicates(edge.frame(spark))
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()), key=str) == wanted_groups(rows)
    assert simhash_dedup.near_duplicates(edge.frame(spark).limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [4, 9, 65_536])
def test_links_span_every_group_of_near_fingerprints(spark, chunk):
    turn = random.Random(chunk)
    fps = {turn.getrandbits(64) for _ in range(40)}
    center = turn.getrandbits(64)
    for _ in range(60):  # a dense family, whose files are long
        fps.add(center ^ sum(1 << b for b in turn.sample(range(64), turn.randint(0, 3))))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    place = {s: i for i, s in enumerate(signed)}
    links = [(place[r.a], place[r.b]) for r in simhash_dedup.links(df, chunk=chunk).collect()]
    assert all((fps[a] ^ fps[b]).bit_count() <= 8 for a, b in links)
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    assert edge.union(len(fps), links) == edge.union(len(fps), near)


def test_majority_counts_long_runs():
    turn = np.random.default_rng(0)
    counts = np.array([0, 3, 70_000, 1, 0])
    h = turn.integers(0, 2**63, counts.sum(), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    got = simhash_dedup.majority(h, counts)
    at = np.concatenate([[0], np.cumsum(counts)])
    assert got.tolist() == [edge.majority(h[a:b]) if b > a else 0 for a, b in zip(at, at[1:])]


# --- lines ----------------------------------------------------------------------------


def normal(line):
    return re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", line.lower()).strip(" ").split(" ")


def wanted_lines(rows):
    """Positions dropped per (doc_id, text): plain edit similarity, pair by pair."""
    spots = {}
    for doc_id, text in {(r[0], r[1]) for r in rows}:
        for pos, line in enumerate((text or "").split("\n") if text is not None else []):
            if len(normal(line)) >= 5:
                spots.setdefault(tuple(normal(line)), []).append((doc_id is None, doc_id or 0, pos, (doc_id, text)))
    lines = list(spots)
    near = [
        (i, j) for i in range(len(lines)) for j in range(i)
        if edge.edits(lines[i], lines[j]) <= 0.2 * max(len(lines[i]), len(lines[j])) + 1e-9
    ]
    root, groups = edge.union(len(lines), near), {}
    for i, x in enumerate(lines):
        groups.setdefault(root[i], []).extend(spots[x])
    dropped = {}
    for found in groups.values():
        for *_, pos, key in sorted(found, key=lambda s: s[:3])[1:]:
            dropped.setdefault(key, []).append(pos)
    return {k: sorted(v) for k, v in dropped.items()}, len(near)


def family(n=30):
    """Variants of one line of 60 words, each with a word or two changed."""
    turn = random.Random(5)
    base = " ".join(edge.texts(9, 4)).split(" ")[:60]
    out = []
    for i in range(n):
        words = list(base)
        for k in turn.sample(range(len(words)), turn.randint(1, 2)):
            words[k] = f"v{i}x{k}"
        out.append((200 + i, "alone " + str(i) + "\n" + " ".join(words), "en", "s", 1, 1, "w", 2, 0.5, "d", 3))
    return out


def test_lines_equal_brute_force(spark):
    rows = edge.rows() + family()
    got = line_dedup.dedup_lines(edge.frame(spark, rows), short=4).collect()
    want, near = wanted_lines(rows)
    assert near > 100 and len(got) == len(rows)
    text = {(r[0], r[1]): r[1] for r in rows}
    found = sorted(((r.doc_id, r.text, r.dropped) for r in got), key=str)
    kept = lambda t, d: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in set(d))
    assert found == sorted(
        ((r[0], kept(text[r[0], r[1]], want.get((r[0], r[1]), [])), want.get((r[0], r[1]), [])) for r in rows), key=str
    )
    assert set(got[0].asDict()) == {*[c.split()[0] for c in edge.DDL.split(", ")], "n_lines"}


def test_lines_with_many_words_and_no_rows(spark):
    turn = random.Random(2)
    many = " ".join(f"w{turn.randrange(40_000)}" for _ in range(30_000))
    assert len(many) > 65_535
    df = spark.createDataFrame([(1, many), (2, many.upper()), (3, many + " end"), (4, None)], "doc_id bigint, text string")
    got = {r.doc_id: r.dropped for r in line_dedup.dedup_lines(df).collect()}
    assert got == {1: [], 2: [0], 3: [0], 4: []}
    one = line_dedup.occurrences(df.where("doc_id = 1"), "doc_id", "text").first()
    signed = edge.majority([edge.xxh(w) for w in set(many.split(" "))])
    assert one.fp % (1 << 64) == signed
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def edited(turn, words, edits):
    """``words`` with so many substitutions, deletions and insertions."""
    words = list(words)
    for i in range(edits):
        at, new = turn.randrange(len(words)), f"n{turn.randrange(10**9)}"
        words[at : at + turn.choice((0, 1, 1))] = [new] if turn.random() < 0.8 or len(words) < 6 else []
    return words


def test_every_pair_of_the_similarity_is_linked(spark):
    """Plain edit similarity decides, without any rule of candidates."""
    turn = random.Random(11)
    vocab = [f"w{i}" for i in range(400)]
    lines = []
    for n in [5, 6, 7, 8, 9, 10, 11, 12, 13, 15, 16, 20, 25, 31, 40, 50] * 6:
        base = [turn.choice(vocab) for _ in range(n)]
        lines += [base, edited(turn, base, max(1, n // 5)), edited(turn, base, max(1, n // 10))]
    lines = [x for x in lines if len(x) >= 5]
    near = [
        (i, j) for i in range(len(lines)) for j in range(i)
        if min(len(lines[i]), len(lines[j])) >= 0.8 * max(len(lines[i]), len(lines[j]))
        and edge.edits(lines[i], lines[j]) <= 0.2 * max(len(lines[i]), len(lines[j])) + 1e-9
    ]
    assert len(near) > 150
    root, first, want = edge.union(len(lines), near), {}, {}
    for i, g in enumerate(root):
        want[i] = [0] if g in first else []
        first.setdefault(g, i)
    df = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines)], "doc_id bigint, text string").repartition(5)
    for short in (1, 8):
        assert {r.doc_id: r.dropped for r in line_dedup.dedup_lines(df, short=short).collect()} == want


def test_line_tables_go_when_they_are_read(spark):
    """Of all the tables of a run the dropped positions alone are kept, whether or not there are long files."""
    from crestline.session import shared_dir

    made = lambda: {p.name for p in Path(shared_dir(spark).removeprefix("file:")).glob("line*")}
    rows, before = edge.rows() + family(), made()
    for short in (4, 1000):
        line_dedup.dedup_lines(edge.frame(spark, rows), short=short).collect()
    kept = made() - before
    assert len(kept) == 2 and all(name.startswith("line-dropped-") for name in kept)


def test_grams_are_dealt_once_a_turn(spark):
    """``line-grams`` has every file of two lines or more: a pair as one row, longer ones by member."""
    texts = ["a b c d e f g h i j k l", "x b c d e f g h i j k l", "a b c d e f g h i j k z", "q r s t u v w"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    files, tokens = line_dedup.gram_files(df, "doc_id", "text", 0.8)
    assert len(files) == line_dedup.TURNS
    bits = F.from_json(F.lit(str([0] * (line_dedup.COMMON_BITS // 64))), "array<bigint>")
    want = {}
    for r in line_dedup.gram_keys(tokens, bits, 0.8).collect():
        want.setdefault(r.file, set()).add(r.line)
    got = [r for f in files for r in f.collect()]
    pairs = sorted((r.line, r.mate) for r in got if r.mate is not None)
    assert pairs == sorted(tuple(sorted(v)) for v in want.values() if len(v) == 2)
    longer = {}
    for r in got:
        if r.mate is None:
            longer.setdefault(r.file, set()).add(r.line)
    assert longer == {k: v for k, v in want.items() if len(v) > 2} and longer


@pytest.mark.parametrize("similarity", [0.6, 0.7, 0.8, 0.9, 0.95])
def test_grams_suffice_at_every_length(similarity):
    ranges = line_dedup.gram_ranges(similarity)
    for m in range(5, 400):
        (q,) = [q for q, low, high in ranges if low <= m and (high is None or m <= high)]
        edits = int((1 - similarity) * m + 1e-9)
        assert all(n - q + 1 >= q * edits + 1 for n in range(5, m + 1) if n >= similarity * m - 1e-9)


@pytest.mark.parametrize("similarity", [0.6, 0.8, 0.9])
def test_near_lines_share_one_of_few_first_grams(spark, similarity):
    turn = random.Random(7)
    vocab = [f"w{i}" for i in range(60)]
    lines = []
    for n in [5, 6, 8, 10, 13, 16, 21, 26, 40, 48] * 4:
        base = [turn.choice(vocab) for _ in range(n)]
        lines += [base, edited(turn, base, int(n * (1 - similarity) + 1e-9)), base + [f"e{i}" for i in range(int(n / similarity + 1e-9) - n)]]
    lines = [x for x in lines if len(x) >= 5]
    df = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines)], "doc_id bigint, text string")
    tokens = line_dedup.tokens_of(df, "doc_id", "text")
    bits = F.from_json(F.lit(str(line_dedup.common_grams(tokens))), "array<bigint>")
    cut = line_dedup.with_cuts(tokens, bits, similarity).localCheckpoint()
    name = {" ".join(x): i for i, x in enumerate(lines)}
    at = {r.line: name[r.text] for r in df.select("text", F.xxhash64("text").alias("line")).collect()}
    files = {i: [] for i in at.values()}
    for r in line_dedup.gram_keys(cut, bits, similarity).collect():
        files[at[r.line]].append(r.file)
    near = 0
    for i in files:
        for j in files:
            m = max(len(lines[i]), len(lines[j]))
            if i < j and min(len(lines[i]), len(lines[j])) >= similarity * m - 1e-9 and edge.edits(lines[i], lines[j]) <= int((1 - similarity) * m + 1e-9):
                near += 1
                assert set(files[i]) & set(files[j])
    assert near > 40
    if similarity == 0.8:  # 37 before: as if the longest partner's edits all spoiled three grams
        assert max(len(set(files[i])) for i in files if len(lines[i]) == 48) == 29


def test_a_written_table_leaves_no_shuffle_files(spark):
    def shuffled():
        root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return sum(len(glob.glob(f"{d}/**/shuffle_*", recursive=True)) for d in root)

    before = shuffled()
    df = written(spark.range(1000).withColumn("k", F.xxhash64("id")).repartition(7, "k").groupBy("k").count(), "left-over")
    deadline = time.time() + 20
    while shuffled() > before and time.time() < deadline:
        time.sleep(0.2)
    assert shuffled() <= before
    assert df.count() == 1000
