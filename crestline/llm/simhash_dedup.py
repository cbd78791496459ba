"""SimHash near-duplicates over pigeonhole blocks.

A fingerprint has 64 bits. Cut into ``blocks`` pieces, two fingerprints that differ
in at most ``bits`` bits agree on at least ``blocks - bits`` whole pieces, so each
fingerprint is filed once under every choice of that many pieces; whoever shares a
file is compared bit by bit. With 7 pieces and 4 bits a file's key has 27 bits or
more, and the compared pairs stay few up to billions of fingerprints.

Only distinct fingerprints are filed, so exact copies cost nothing. Inside a file
the links are found by a search that drops a fingerprint from the pool as soon as
it is reached: a dense group of near copies is settled in about one pass, and a
spanning forest comes out instead of all its pairs. A file longer than ``CHUNK``
is handled in pieces, whose pairs are dealt to further tasks.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.llm.common import table, written
from crestline.llm.components import components

WORDS, BITS, BLOCKS = 4, 4, 7
CHUNK = 65_536
#: shingles hashed at a time; also the most that one 16-bit counter lane takes
STEP, LANE = 1 << 19, 1 << 15


def shingle_hashes(text: str | None, words: int = WORDS) -> list[int]:
    """XXH64 (seed 42) of each shingle; the whole sequence when it is shorter; none without words."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return []
    flat = b" ".join(parts)
    if len(parts) <= words:
        return [xxhash.xxh64_intdigest(flat, 42)]
    gaps = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32)
    starts = [0, *(gaps[: len(parts) - words] + 1).tolist()]
    ends = [*gaps[words - 1 :].tolist(), len(flat)]
    digest = xxhash.xxh64_intdigest
    return [digest(flat[s:e], 42) for s, e in zip(starts, ends)]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per run of ``counts`` hashes, the bits set in over half of them; runs of zero give 0."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    first = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
    # cuts inside long runs keep the 16-bit lanes from running over
    cuts = [np.arange(0, n, LANE) for n in counts[full]]
    at = np.concatenate([f + c for f, c in zip(first, cuts)]).astype(np.int64)
    owner = np.repeat(np.arange(len(full)), [len(c) for c in cuts])
    lane = np.uint64(0x0001000100010001)
    for j in range(16):
        packed = np.add.reduceat((hashes >> np.uint64(j)) & lane, at)
        for k in range(4):
            part = ((packed >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(np.int64)
            total = np.bincount(owner, part, len(full)).astype(np.int64)
            out[full] |= (2 * total > counts[full]).astype(np.uint64) << np.uint64(16 * k + j)
    return out


def _fingerprint_batches(batches):
    for batch in batches:
        texts = batch.column(1)
        done, hashes, counts = [], [], []
        held = 0
        for i in range(len(texts)):
            h = shingle_hashes(texts[i].as_py())
            hashes.append(np.array(h, np.uint64))
            counts.append(len(h))
            held += len(h)
            if held >= STEP or i == len(texts) - 1:
                done.append(majority(np.concatenate(hashes), np.array(counts, np.int64)))
                hashes, counts, held = [], [], 0
        fp = np.concatenate(done) if done else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long), one row per input row.

    A null or wordless text has fingerprint 0. Other columns are not read.
    """
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _fingerprint_batches, f"doc_id {docs.schema[id_col].dataType.simpleString()}, fp bigint"
    )


def block_keys(fp, blocks: int = BLOCKS, bits: int = BITS):
    """One key per choice of ``blocks - bits`` pieces: the pieces' bits, and which choice it is."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    keys = []
    for n, chosen in enumerate(combinations(range(blocks), blocks - bits)):
        mask = 0
        for i in chosen:
            mask |= ((1 << (edges[i + 1] - edges[i])) - 1) << edges[i]
        signed = mask - (1 << 64) if mask >> 63 else mask
        # hashed together with the choice: a collision only adds a comparison
        keys.append(F.xxhash64(fp.bitwiseAND(F.lit(signed).cast("bigint")), F.lit(n)))
    return F.array(*keys)


def forest(fps: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever is connected at ``bits`` or fewer differing bits."""
    left, right, pool = [], [], fps
    while len(pool):
        root, pool, frontier = pool[0], pool[1:], [pool[0]]
        while frontier and len(pool):
            near = np.bitwise_count(pool ^ frontier.pop()) <= bits
            if near.any():
                hit = pool[near]
                left.append(hit)
                right.append(np.full(len(hit), root, np.uint64))
                frontier.extend(hit)
                pool = pool[~near]
    if not left:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(left), np.concatenate(right)


#: runs up to this length are compared pairwise, all runs of a batch at once
SHORT = 8


def _settle(keys: np.ndarray, fps: np.ndarray, bits: int):
    """Links inside each run of equal keys."""
    cut = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.concatenate([cut, [len(keys)]]))
    left, right = [], []
    short = np.repeat(size <= SHORT, size)
    for d in range(1, SHORT):
        near = (keys[d:] == keys[:-d]) & short[d:] if len(keys) > d else np.zeros(0, bool)
        i = np.flatnonzero(near)
        i = i[np.bitwise_count(fps[i] ^ fps[i + d]) <= bits]
        left.append(fps[i])
        right.append(fps[i + d])
    for c, n in zip(cut[size > SHORT].tolist(), size[size > SHORT].tolist()):
        a, b = forest(fps[c : c + n], bits)
        left.append(a)
        right.append(b)
    return np.concatenate(left), np.concatenate(right)


OUT = "a bigint, b bigint, file bigint, chunk int"


def _rows(a, b):
    return pa.RecordBatch.from_arrays(
        [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int32())],
        ["a", "b", "file", "chunk"],
    )


def _linker(bits: int, chunk: int):
    """Reads (file, fp) in file order; writes links, and the rows of over-long files with their chunk."""

    def run(batches):
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        number = 0  # of the chunk, inside an over-long file

        def left_over():
            return pa.RecordBatch.from_arrays(
                [pa.array(fps.view(np.int64)), pa.nulls(len(fps), pa.int64()), pa.array(keys), pa.array(np.full(len(fps), number, np.int32))],
                ["a", "b", "file", "chunk"],
            )

        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
            while len(keys):
                last = int(np.searchsorted(keys, keys[-1]))  # the last file may go on in the next batch
                if last:
                    if number:  # the first file ends here and had chunks before
                        first = int(np.searchsorted(keys, keys[0], "right"))
                        rest_k, rest_f = keys[first:], fps[first:]
                        keys, fps = keys[:first], fps[:first]
                        yield _rows(*forest(fps, bits))
                        yield left_over()
                        keys, fps, number = rest_k, rest_f, 0
                        continue
                    yield _rows(*_settle(keys[:last], fps[:last], bits))
                    keys, fps = keys[last:], fps[last:]
                if len(keys) < chunk:
                    break
                rest_k, rest_f = keys[chunk:], fps[chunk:]
                keys, fps = keys[:chunk], fps[:chunk]
                yield _rows(*forest(fps, bits))
                yield left_over()
                keys, fps, number = rest_k, rest_f, number + 1
        if len(keys):
            yield _rows(*forest(fps, bits))
            if number:
                yield left_over()

    return run


def links(fps: DataFrame, bits: int = BITS, blocks: int = BLOCKS, chunk: int = CHUNK) -> DataFrame:
    """``a, b``: links that span every group of distinct fingerprints (column ``fp``) within ``bits``."""
    filed = fps.select(F.explode(block_keys(F.col("fp"), blocks, bits)).alias("file"), "fp")
    found = written(
        filed.repartition("file").sortWithinPartitions("file").mapInArrow(_linker(bits, chunk), OUT), "simhash-links"
    )
    over = found.where("chunk is not null").select("file", "chunk", F.col("a").alias("fp"))
    chunks = over.groupBy("file").agg(F.max("chunk").alias("last"))
    # each pair of chunks of an over-long file meets in a task of its own
    met = (
        over.join(chunks, "file")
        .select("file", "chunk", "fp", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other"))
        .where("chunk <> other")
        .select(
            F.xxhash64("file", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("file"), "fp"
        )
    )
    more = met.repartition("file").sortWithinPartitions("file").mapInArrow(_linker(bits, 2 * chunk + 1), OUT)
    return found.where("b is not null").select("a", "b").union(more.where("b is not null").select("a", "b"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, blocks: int = BLOCKS
) -> DataFrame:
    """``doc_id, fingerprint, component_id``: one row per input row.

    ``component_id`` is the smallest id reachable over links of ``bits`` or fewer
    differing bits, the row's own included. Null and wordless texts have fingerprint
    zero and link like others. A repeated id gives one row per input row; a null id
    is kept and never the smallest unless its group has no other. An empty table
    gives an empty result; columns besides the two named ones are not read.
    """
    marked = written(fingerprints(docs, id_col, text_col), "simhash-fp")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("low"))
    groups = components(links(distinct.select("fp"), bits, blocks)).withColumnRenamed("node", "fp")
    rooted = distinct.join(groups, "fp", "left").select("fp", "low", F.coalesce("component", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
