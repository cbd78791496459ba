import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from edge import frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from crestline.llm import curve_packing as cp
from crestline.llm.common import table

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def words():
    return cp.Words(PATH)


@given(st.text(max_size=80) | st.text("abcé'S ,.1<|>\n\t\x1c\x85 ΣİĲ²́", max_size=60))
@settings(max_examples=400, deadline=None)
def test_ids_are_the_library_s(tokenizer, words, text):
    assert words.by_word
    assert words.of(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "x<|startoftext|>y", "It's WE'LL don’t", "ÿ ÿÿ", "日本語 한국어 😀😀", "", "  \r\n "])
def test_ids_of_odd_texts(tokenizer, words, text):
    assert words.of(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_full_memory_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(cp, "REMEMBERED", 2)
    words, text = cp.Words(PATH), "one two, three four five two, one"
    assert words.of(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids and len(words) <= 2


def test_other_files_are_read_as_they_are():
    path = public_tokenizers.path("byte_bpe_50k.json")
    want = Tokenizer.from_file(path).encode(" two  words\n", add_special_tokens=False).ids
    assert cp.Words(path).of(" two  words\n").tolist() == want


@pytest.mark.parametrize(("dims", "bits"), [(2, 5), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
    keys = cp.hilbert(grid, bits)
    assert sorted(keys.tolist()) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1) == 1).all()


@given(st.lists(st.integers(1, 50), max_size=30), st.sampled_from([4, 16]))
def test_cuts_leave_no_gap_and_pad_nothing(sizes, capacity):
    total, first, held = sum(sizes), 0, defaultdict(list)
    for n in sizes:
        pieces = cp.cuts(first, n, total, capacity)
        assert [s for s, *_ in pieces] == [sum(p[1] for p in pieces[:i]) for i in range(len(pieces))]
        assert sum(p[1] for p in pieces) == n
        for _, length, sequence, offset in pieces:
            held[sequence].append((offset, length))
        first += n
    for spans in held.values():
        assert all(a[0] + a[1] == b[0] for a, b in zip([(0, 0), *spans], spans))
        length = sum(x for _, x in spans)
        assert length == capacity or length & (length - 1) == 0
    assert sorted(held) == list(range(len(held)))


def check(rows, texts, tokenizer, capacity):
    """``texts``: (doc_id, text) of every row."""
    held, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    total = 0
    for doc, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        total += len(ids)
        at = 0
        while at < len(ids):  # take this row's pieces out of those of its id
            found = next(
                r for r in pieces[doc]
                if r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            )
            pieces[doc].remove(found)
            at += found["length"]
        assert at == len(ids)
    assert not any(pieces.values())
    for spans in held.values():
        spans.sort()
        assert all(a[0] + a[1] == b[0] for a, b in zip([(0, 0), *spans], spans))
        length = sum(x for _, x in spans)
        assert length == capacity or length & (length - 1) == 0
    assert sum(x for spans in held.values() for _, x in spans) == total
    assert len(held) <= total // capacity + capacity.bit_length()


@pytest.mark.parametrize("capacity", [2048, 32])
def test_edge_rows(spark, tokenizer, capacity):
    df = frame(spark)
    got = cp.curve_pack(df, capacity=capacity)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    check(got.collect(), [(r["doc_id"], r["text"]) for r in df.collect()], tokenizer, capacity)


def test_ids_rebuild_the_texts(spark, tokenizer):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = cp.curve_pack(docs, with_ids=True).collect()
    built = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["start"]):
        built[r["doc_id"]] += r["ids"]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    for r in docs.collect():
        assert built[r["doc_id"]] == [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]


def test_empty_table(spark):
    assert cp.curve_pack(frame(spark, [])).collect() == []


def test_copies_are_neighbours(spark):
    groups = [f"{w} " * 20 for w in ("alpha", "stone river", "le chat noir", "quick brown fox")]
    df = spark.createDataFrame([(i, groups[i % 4]) for i in range(400)], "doc_id bigint, text string").repartition(7)
    rows = cp.curve_pack(df, capacity=256).select("doc_id", "sequence_id").distinct().collect()
    mixed = defaultdict(set)
    for doc, sequence in rows:
        mixed[sequence].add(doc % 4)
    assert sum(len(x) > 1 for x in mixed.values()) <= 3 + 8  # only where two groups meet, and the last short ones
