import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import edge
from crestline.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_keeps_every_item_in_its_place(sizes):
    bins, offsets, fill = packing.best_fit(np.array(sizes, np.int64), 64)
    place = defaultdict(list)
    for size, b, o in zip(sizes, bins.tolist(), offsets.tolist()):
        place[b].append((o, size))
    for b, items in place.items():
        end = 0
        for o, size in sorted(items):
            assert o == end
            end += size
        assert end == fill[b] <= 64
    # no two bins of one half or less: best fit would have joined them
    assert sum(f <= 32 for f in fill.tolist()) <= 1


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_the_tokenizer_file(text):
    reference = Tokenizer.from_file(PATH)
    reference.encode_special_tokens = True
    assert packing.encoder(PATH).encode_ordinary(text) == reference.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_read_as_the_library_does(spark):
    reference = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "a<|endoftext|>", "<|endoftext |>", "a\n\n<|endoftext|>\n b", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.ids for r in packing.pack(df, with_ids=True).collect()}
    assert got == {i: reference.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}


def test_cuts():
    assert packing.cuts(1) == [(0, 1)] and packing.cuts(2048) == [(0, 2048)]
    assert packing.cuts(4100) == [(0, 4), (4, 2048), (2052, 2048)]


def checked(rows, pieces, capacity):
    reference = Tokenizer.from_file(PATH)
    reference.encode_special_tokens = True
    want = []
    for r in rows:
        ids = reference.encode(r[1] or "", add_special_tokens=False).ids + [0]
        want += [(r[0], n, s, size, tuple(ids[s : s + size])) for n, (s, size) in enumerate(packing.cuts(len(ids), capacity))]
    assert sorted(((p.doc_id, p.piece, p.start, p.length, tuple(p.ids)) for p in pieces), key=str) == sorted(want, key=str)
    sequences = defaultdict(list)
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        sequences[p.sequence_id].append((p.offset, p.length))
    for places in sequences.values():
        end = 0
        for offset, size in sorted(places):
            assert offset == end
            end += size
        assert end <= capacity
    total = sum(w[3] for w in want)
    return len(sequences), -(-total // capacity)


def test_pieces_round_trip_through_several_levels(spark):
    rows = edge.rows() + [(1000 + i, t, "en", "s", 1, 1, "w", 2, 0.5, "d", 3) for i, t in enumerate(edge.texts(8, 150))]
    df = edge.frame(spark, rows).repartition(9)
    used, least = checked(rows, packing.pack(df, capacity=256, fan=2, with_ids=True).collect(), 256)
    assert used <= 1.02 * least + 1
    # a bound of one open sequence per node loses no piece
    checked(rows, packing.pack(df, capacity=256, fan=2, max_up=1, with_ids=True).collect(), 256)
    assert packing.pack(df.limit(0)).count() == 0
