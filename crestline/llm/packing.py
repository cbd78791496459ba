"""Best-fit packing of tokenised texts into sequences of fixed length, in a tree.

Level 0 tokenises each partition where it is read and packs its pieces best-fit
decreasing. Sequences that are full but for ``slack`` tokens are final. The rest go
up as items of their own: ``fan`` neighbouring nodes meet in one node of the next
level, which packs those items best-fit again, and so on to a single root. A node
passes on at most ``max_up`` sequences, the emptiest ones; fuller ones become final
as they are, so that the root's work has a bound however many partitions there are.

Every level is written to the shared folder, so a lost executor repeats one task of
one level and never changes a packing that others have read.
"""

from __future__ import annotations

import functools
import json
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.llm.common import table, written

CAPACITY, END_ID = 2048, 0
SLACK, FAN, MAX_UP = 8, 16, 4096

PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint, node bigint, bin bigint, offset bigint, done boolean, at bigint"


@functools.cache
def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a ``tokenizers`` file; its ids are its merge ranks, which makes this the same mapping, faster.

    Strings that spell one of the file's added tokens are that token, as the library reads them.
    """
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    vocab = file["model"]["vocab"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(shown))}
    ranks = {
        bytes(byte_of[c] for c in word): i for word, i in vocab.items() if all(c in byte_of for c in word)
    }
    special = max(ranks.values()) if b"<|endoftext|>" in ranks else None
    ranks = {w: i for w, i in ranks.items() if i != special}
    added = {t["content"]: t["id"] for t in file["added_tokens"]}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; all but the first are full."""
    head = n % capacity or capacity
    return [(0, head), *((s, capacity) for s in range(head, n, capacity))]


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the bins' fill; longest items first, into the fullest bin with room."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fill: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some open bin has room r
    sizes = lengths.tolist()
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = sizes[i]
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, capacity - room
        fill[b] += size
        room -= size
        if room:
            by_room[room].append(b)
            rooms |= 1 << room
    return bins, offsets, np.array(fill, np.int64)


def final_bins(fill: np.ndarray, capacity: int, slack: int, max_up: int, root: bool) -> np.ndarray:
    """Which bins stay as they are: all at the root, else the nearly full and those beyond the emptiest ``max_up``."""
    done = np.full(len(fill), root) | (fill >= capacity - slack)
    open_ = np.flatnonzero(~done)
    if len(open_) > max_up:
        done[open_[np.argsort(fill[open_], kind="stable")[max_up:]]] = True
    return done


def _first_level(path, capacity, end_id, slack, max_up, with_ids):
    def run(batches):
        enc = encoder(path)
        keys, piece, start, length, crc, ids_out = [], [], [], [], [], []
        for batch in batches:
            which = []
            for i, text in enumerate(batch.column(1)):
                ids = np.array(enc.encode(text.as_py() or "", allowed_special="all") + [end_id], "<u4")
                for n, (s, size) in enumerate(cuts(len(ids), capacity)):
                    part = ids[s : s + size]
                    which.append(i)
                    piece.append(n)
                    start.append(s)
                    length.append(size)
                    crc.append(zlib.crc32(part.data))
                    if with_ids:
                        ids_out.append(part.astype(np.int32))
            keys.append(batch.column(0).take(pa.array(which, pa.int32())))
        if not piece:
            return
        node = TaskContext.get().partitionId()
        bins, offsets, fill = best_fit(np.array(length, np.int64), capacity)
        done = final_bins(fill, capacity, slack, max_up, False)[bins]
        cols = [
            pa.concat_arrays(keys), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
            pa.array(crc, pa.int64()), pa.array(np.full(len(piece), node, np.int64)), pa.array(bins), pa.array(offsets),
            pa.array(done), pa.array(np.arange(len(piece), dtype=np.int64) + (node << 32)),
        ]
        if with_ids:
            cols.append(pa.array(ids_out, pa.list_(pa.int32())))
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "node", "bin", "offset", "done", "at", *["ids"] * with_ids]
        whole = pa.Table.from_arrays(cols, names)
        yield from whole.to_batches(max_chunksize=10_000)

    return run


def _merge(capacity, slack, max_up, root):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # node still names the child here; (child, bin) is one item
        pdf = pdf.sort_values(["node", "bin", "offset"], kind="stable").reset_index(drop=True)
        item = pdf.groupby(["node", "bin"], sort=True).ngroup().to_numpy()
        size = np.bincount(item, pdf["length"]).astype(np.int64)
        bins, offsets, fill = best_fit(size, capacity)
        pdf["offset"] += offsets[item]
        pdf["bin"] = bins[item]
        pdf["done"] = final_bins(fill, capacity, slack, max_up, root)[pdf["bin"].to_numpy()]
        pdf["node"] = pdf["parent"]
        return pdf.drop(columns="parent")

    return run


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    slack: int = SLACK,
    fan: int = FAN,
    max_up: int = MAX_UP,
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, one row per piece; ``with_ids`` adds ``ids``.

    A text is its ids and ``end_id``; a null text counts as empty, one token. Only texts
    longer than ``capacity`` are cut; their first piece takes the remainder. Offsets leave
    no gap. Repeated rows and ids are packed like any others; a null id is kept. An empty
    table gives an empty result; columns besides the two named ones are not read.
    """
    spark = docs.sparkSession
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, {PIECES}"
    level = written(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
            _first_level(path, capacity, end_id, slack, max_up, with_ids),
            schema + ", ids array<int>" * with_ids,
        ),
        "packing",
    )
    tokens = level
    nodes = (level.agg(F.max("node")).first()[0] or 0) + 1
    out, number, root = [], 0, False
    while True:
        out.append(
            level.where("done").withColumn(
                "sequence_id", F.lit(number << 58) + F.col("node") * (1 << 28) + F.col("bin")
            )
        )
        if root:
            break
        number, nodes = number + 1, -(-nodes // fan)
        root = nodes == 1
        level = written(
            level.where("not done")
            .drop("ids")
            .withColumn("parent", F.floor(F.col("node") / fan))
            .groupBy("parent")
            .applyInPandas(_merge(capacity, slack, max_up, root), schema),
            "packing",
        )
    if with_ids:  # ids stay where they were made; pieces that went up the tree get theirs back
        ids = tokens.where("not done").select("at", "ids")
        out = [out[0], *[level.join(ids, "at").select(*out[0].columns) for level in out[1:]]]
    packed = functools.reduce(DataFrame.union, out)
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * with_ids
    )


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
