"""Packing along a space-filling curve: similar documents end up in the same sequences.

A document's token ids, hashed and damped, make a sparse vector; a fixed random
projection takes it to ``DIMS`` dimensions, whose Hilbert key places it on a curve.
Rows are range-sorted by that key, each range adds up its tokens, and so every document
gets the place of its first token in one stream along the curve. The stream is cut
every ``capacity`` tokens: neighbours on the curve share sequences, whatever range they
fell into. What is left over at the very end is cut into lengths that are powers of two,
so nothing is padded.

Texts are tokenised once, where they are read; ids are written as a table. Only
key, row number and token count are sorted. Ids are then joined with their places and cut
where they stand. Equal keys are ordered by row number, which spreads copies over ranges.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
import zlib
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from crestline.llm.common import table, written

CAPACITY, END_ID = 2048, 1
DIMS, BITS = 4, 15
BUCKETS, SEED = 1 << 14, 42
#: distinct words a task remembers the ids of; results do not depend on it
REMEMBERED = 400_000
# fixed values of the tokenizer's file: what ends a word, and how it splits texts
WORD_END = "</w>"
PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

#: texts that composing leaves as they are
_LATIN = re.compile("[ -~\\n\\t\\r\u00a1-\u024f]*")
_MARK = b"\xff"


def _pieces() -> re.Pattern:
    """``PIECES`` for lower-cased texts of ``_LATIN``, with the letters and numbers spelled out."""
    reached = {c for n in range(0x250) for c in chr(n).lower()}
    letters, numbers = ("".join(sorted(c for c in reached if unicodedata.category(c)[0] == kind)) for kind in "LN")
    return re.compile(f"[{letters}]+|[{numbers}]|'(?:s|t|re|ve|m|ll|d)|[^\\s{letters}{numbers}]+")


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of integer coordinates below ``2 ** bits`` (Skilling's transform)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for b in reversed(range(1, bits)):
        low = (1 << b) - 1
        for i in range(dims):
            here = (x[i] >> b) & 1 == 1
            swap = np.where(here, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(here, low, swap)
            x[i] ^= swap
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in reversed(range(1, bits)):
        turn ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for b in reversed(range(bits)):
        for i in range(dims):
            key = key << 1 | (x[i] >> b) & 1
    return key


@functools.cache
def projection(ids: int, dims: int = DIMS, buckets: int = BUCKETS, seed: int = SEED) -> np.ndarray:
    """Per token id, what one of it adds to the projected vector: its bucket's fixed random direction, with a hashed sign."""
    mixed = np.arange(ids, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ mixed >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    sign = np.where(mixed >> np.uint64(63) == 1, 1.0, -1.0)
    directions = np.random.default_rng(seed).standard_normal((buckets, dims)) / np.sqrt(dims)
    return directions[(mixed >> np.uint64(20)) % np.uint64(buckets)] * sign[:, None]


def curve_key(ids: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Projected vector of one document: counts damped by their logarithm, length one; zero without ids."""
    seen, counts = np.unique(ids, return_counts=True)
    weights = 1 + np.log(counts)
    return weights @ directions[seen] / max(np.sqrt((weights**2).sum()), 1.0)


def cells(vectors: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Coordinates on the grid; projected unit vectors rarely leave [-2, 2], what does is moved to its edge."""
    return np.clip((vectors + 2) / 4 * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)


class Words(dict):
    """Token ids, as bytes, of the words and other pieces a text is split into; a piece is looked up once.

    A file of this kind drops white space, marks the last character of a word, and has merge ranks for
    ids. With the mark as one more byte, a rank-driven encoder merges a piece as the library
    does. Texts of Latin letters take this way, at a fraction of the CPU; the library takes all other
    texts, and all texts for files of another kind.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.kind = {"H": "<u2", "I": "<u4"}[self.code]
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        split = json.dumps(file["pre_tokenizer"])
        self.by_word = file["model"].get("end_of_word_suffix") == WORD_END and json.dumps(PIECES) in split
        if self.by_word:
            self.added = tuple(t["content"] for t in file["added_tokens"])
            self.pieces = _pieces().findall
            self.encode = self._ranked(file["model"]["vocab"])

    @staticmethod
    def _ranked(vocab: dict[str, int]):
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        byte_of = {chr(b): b for b in shown}
        byte_of |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(shown))}
        ranks = {}
        for word, i in vocab.items():
            ended = word.endswith(WORD_END)
            ranks[bytes(byte_of[c] for c in word.removesuffix(WORD_END)) + _MARK * ended] = i
        ranks[_MARK] = len(vocab) + (1 << 20)  # never left over: it always joins the byte before it
        return tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def __missing__(self, piece: str) -> bytes:
        ids = array(self.code, self.encode(piece.encode() + _MARK)).tobytes()
        if len(self) < REMEMBERED:
            self[piece] = ids
        return ids

    def of(self, text: str) -> np.ndarray:
        if self.by_word and _LATIN.fullmatch(text) and not any(t in text for t in self.added):
            return np.frombuffer(b"".join(map(self.__getitem__, self.pieces(text.lower()))), self.kind)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)


def _tokenised(path, end_id):
    def run(batches):
        words = Words(path)
        directions = projection(words.tokenizer.get_vocab_size())
        place = TaskContext.get().partitionId() << 33
        for whole in batches:
            for start in range(0, len(whole), 500):
                batch = whole.slice(start, 500)
                found = [words.of(t or "") for t in batch.column(1).to_pylist()]
                vectors = np.array([curve_key(ids, directions) for ids in found])
                ended = [np.append(ids, np.array([end_id], ids.dtype)) for ids in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array(np.arange(place, place + len(batch))), pa.array(hilbert(cells(vectors))),
                        pa.array([len(ids) for ids in ended], pa.int64()), pa.array([ids.tobytes() for ids in ended], pa.binary()),
                    ],
                    ["doc_id", "at", "key", "n", "ids"],
                )
                place += len(batch)

    return run


def _running(batches):
    """Tokens before each row within its range."""
    part, total = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column(1).to_numpy()
        upto = np.cumsum(n) + total
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(upto - n), pa.array(n), pa.array(np.full(len(n), part, np.int32))], ["at", "before", "n", "part"]
        )
        total = int(upto[-1]) if len(n) else total


def tail(total: int, capacity: int) -> list[int]:
    """Edges of the last sequences: what the whole ones leave over, in descending powers of two."""
    edges, at = [], total - total % capacity
    for b in reversed(range(capacity.bit_length())):
        if total - at >= 1 << b:
            edges.append(at)
            at += 1 << b
    return [*edges, total]


def cuts(first: int, n: int, total: int, capacity: int) -> list[tuple[int, int, int, int]]:
    """(start, length, sequence, offset) of the pieces of ``n`` tokens that begin at place ``first`` of the stream."""
    full = total - total % capacity
    edges = tail(total, capacity)
    out, at = [], first
    while at < first + n:
        if at < full:
            sequence, begin, end = at // capacity, at - at % capacity, at - at % capacity + capacity
        else:
            k = int(np.searchsorted(edges, at, "right")) - 1
            sequence, begin, end = full // capacity + k, edges[k], edges[k + 1]
        end = min(end, first + n)
        out.append((at - first, end - at, sequence, at - begin))
        at = end
    return out


def _cut(kind, total, capacity, with_ids):
    def run(batches):
        for batch in batches:
            rows, out = [], [[] for _ in range(5)]
            pieces = []
            for i, (first, n, raw) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3))):
                ids = np.frombuffer(raw.as_py(), kind).astype("<u4")
                for start, length, sequence, offset in cuts(first, n, total, capacity):
                    part = ids[start : start + length]
                    rows.append(i)
                    for column, value in zip(out, (start, length, zlib.crc32(part.tobytes()), sequence, offset)):
                        column.append(value)
                    if with_ids:
                        pieces.append(part.astype(np.int32))
            rows = pa.array(rows, pa.int32())
            start, length, crc, sequence, offset = (pa.array(c, pa.int64()) for c in out)
            columns = [batch.column(0).take(rows), start, length, crc, batch.column(2).take(rows), sequence, offset]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                columns, names = [*columns, pa.array(pieces, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def curve_pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
    capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, one row per piece; ``with_ids`` adds ``ids``.

    A text is its ids and ``end_id``; a null text counts as empty, one token, and stands where
    the zero vector does. Sequences hold ``capacity`` tokens, the last ones a power of two. Texts
    of any length are cut where a sequence ends. Repeated rows, ids and null ids are packed like any others, copies
    side by side. An empty table gives an empty result; columns besides the two named are
    not read.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")
    kind = docs.schema[id_col].dataType.simpleString()
    tokens = written(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
            _tokenised(path, end_id), f"doc_id {kind}, at bigint, key bigint, n bigint, ids binary"
        ),
        "curve-tokens",
    )
    ranged = written(
        tokens.select("at", "n", "key").repartitionByRange("key", "at").sortWithinPartitions("key", "at").select("at", "n")
        .mapInArrow(_running, "at bigint, before bigint, n bigint, part int"),
        "curve-places",
    )
    # one row per range: bounded by the number of partitions
    sums = sorted(ranged.groupBy("part").agg(F.sum("n").alias("n")).collect())
    ends = np.cumsum([s["n"] for s in sums], dtype=np.int64).tolist()
    total = ends[-1] if ends else 0
    offsets = docs.sparkSession.createDataFrame(
        [(s["part"], end - s["n"]) for s, end in zip(sums, ends)], "part int, shift bigint"
    )
    places = ranged.join(F.broadcast(offsets), "part").select("at", (F.col("before") + F.col("shift")).alias("first"))
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return (
        tokens.select("doc_id", "at", "n", "ids").join(places, "at").select("doc_id", "first", "n", "ids")
        .mapInArrow(_cut(Words(path).kind, total, capacity, with_ids), schema + ", ids array<int>" * with_ids)
    )


def op11_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_pack(table(spark, sf_dir, "documents"))
