"""Merkle manifest of a dataset, level by level with lag and lead windows.

Rows of a group (a language) are leaves in the order of their id. A run is ``FAN``
consecutive nodes; within a run, fixed-offset ``lag`` and ``lead`` columns hold the
siblings, masked by the node's slot and by the run's length, and the run's first
child hashes them together to the parent. The groups' subroots form one more tree of
the same kind, whose last node is the root.

Windows and joins are keyed by (group, run), at most ``FAN`` rows each, so a group
that holds most rows is spread like any other. Places come from a range sort over
group, id and leaf: each range counts its rows, and a row's place is its place in the
range plus the rows of the group in earlier ranges. Upwards each level is written,
an eighth of the one below; downwards each run is joined with what stands above it,
once per run and not per row. Depth is the logarithm of the largest group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crestline.llm.common import LOWER, UPPER, table, written

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated inputs."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else byte count, colon, value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaves(docs: DataFrame, fields: Sequence[str], changed: dict[str, Column], tampered: Column) -> DataFrame:
    """``g, id, leaf, other, at``: group key, id, the row's digest, and the digest after tampering."""
    whole = digest(*(encoded(F.col(c)) for c in fields))
    other = digest(*(encoded(changed.get(c, F.col(c))) for c in fields))
    return docs.withColumns({"__leaf": whole, "__other": F.when(tampered, other).otherwise(whole)})


def placed(rows: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``rows`` with ``p``, the place within ``g`` from 0, and ``n``, the group's size. ``order`` is total but for equal rows."""
    ranged = written(
        rows.repartitionByRange("g", *order)
        .sortWithinPartitions("g", *order)
        .withColumn("pos", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("pos", 33)),
        label,
    )
    # one row per group and range
    chunks = ranged.groupBy("g", "part").agg(F.min("pos").alias("first"), F.count("*").alias("c"))
    group = Window.partitionBy("g")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.select(
        "g", "part", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("c").over(group).alias("n")
    )
    return ranged.join(offsets, ["g", "part"]).withColumn("p", F.col("pos") + F.col("shift")).drop("pos", "part", "shift")


def siblings(nodes: DataFrame) -> DataFrame:
    """``nodes`` (``g, p, n, h``) with ``run``, and ``left`` and ``right``, the digests of the run's other nodes, joined."""
    run = Window.partitionBy("g", "run").orderBy("p")
    slot = F.col("p") % FAN

    def behind(k):
        return F.when(slot >= k, F.lag("h", k).over(run)).otherwise("")

    def ahead(k):
        return F.when((slot + k < FAN) & (F.col("p") + k < F.col("n")), F.lead("h", k).over(run)).otherwise("")

    steps = range(1, FAN)
    return nodes.withColumn("run", F.expr(f"p div {FAN}")).withColumns(
        {"left": F.concat(*map(behind, reversed(steps))), "right": F.concat(*map(ahead, steps))}
    )


def parents(nodes: DataFrame) -> DataFrame:
    """The next level: the first child of each run hashes the run."""
    first = siblings(nodes).where(F.col("p") % FAN == 0)
    return first.select("g", F.col("run").alias("p"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), digest(F.col("h"), F.col("right")).alias("h"))


def levels(nodes: DataFrame, label: str) -> list[DataFrame]:
    """``nodes`` and the levels above them; a group ends at the level where it has one node."""
    out = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        out.append(written(parents(out[-1].where("n > 1").select("g", "p", "n", "h")), label))
        most = -(-most // FAN)
    return out


def tops(tree: list[DataFrame]) -> DataFrame:
    """``g, h, level`` of each group's last node."""
    return reduce(
        DataFrame.union, [level.where("n = 1").select("g", "h", F.lit(i).alias("level")) for i, level in enumerate(tree)]
    )


def descended(tree: list[DataFrame], above: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The lowest level's nodes with ``path``, their siblings from that level up, and the columns of ``above``.

    ``above`` has ``g, level, path`` and more for each group's last node.
    """
    more = [c for c in above.columns if c not in ("g", "level", "path")]
    down = None
    for i in reversed(range(len(tree))):
        carried = ["g", "p", *(keep if i == 0 else ())]
        own = tree[i].where("n = 1").join(above.where(F.col("level") == i).drop("level"), "g").select(*carried, "path", *more)
        if down is not None:
            step = F.array(F.struct("left", "right"))
            inner = siblings(tree[i].where("n > 1")).join(down.withColumnRenamed("p", "run"), ["g", "run"])
            own = own.union(inner.select(*carried, F.concat(step, "path").alias("path"), *more))
        down = own
    return down


def manifest(
    docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "lang",
    changed: dict[str, Column] | None = None, tampered: Column | None = None,
) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``, one row per input row.

    A leaf is the digest of ``fields``. Where ``tampered`` holds, the leaf that is folded up
    with the original siblings is computed from ``changed`` columns instead. Null fields are
    ``-``; a null group is a group of its own, the first one; null ids come first in their
    group. Repeated ids are ordered by their leaves, and equal rows have a leaf each. A single row is leaf, subroot
    and root at once, with the digest of nothing as its proof. An empty table gives an empty
    result; empty and very long texts are hashed like others; columns besides those named are
    not read.
    """
    marked = leaves(docs.select(*dict.fromkeys([*fields, id_col, group_col])), fields, changed or {}, F.lit(False) if tampered is None else tampered)
    rows = marked.select(
        # sorts null first and other values by their bytes
        F.coalesce(F.concat(F.lit(":"), F.col(group_col).cast("string")), F.lit("")).alias("g"),
        F.col(id_col).alias("id"), F.col("__leaf").alias("h"), F.col("__other").alias("other"),
    )
    rows = written(rows.withColumn("at", F.monotonically_increasing_id()), "merkle-leaves")
    tree = levels(placed(rows, ["id", "h", "at"], "merkle-ranges"), "merkle-level")
    subroots = written(tops(tree), "merkle-subroots")
    upper = levels(
        placed(subroots.select(F.lit("").alias("g"), F.col("g").alias("lang"), "h", "level"), ["lang"], "merkle-ranges"), "merkle-level"
    )
    root = tops(upper).select("g", "level", F.col("h").alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    above = descended(upper, root, ["lang", "h", "level"]).select(F.col("lang").alias("g"), "level", F.col("h").alias("subroot"), "root", "path")
    found = descended(tree, written(above, "merkle-subroot-paths"), ["id", "h", "other"])
    folded = F.aggregate("path", F.col("other"), lambda at, step: digest(step["left"], at, step["right"]))
    proof = F.array_join(F.transform("path", lambda step: F.concat(step["left"], step["right"])), "")
    return found.select(
        F.col("id").alias("doc_id"), F.col("h").alias("leaf"), "subroot", "root", digest(proof).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return manifest(
        table(spark, sf_dir, "documents"), changed={"text": F.translate("text", UPPER, LOWER)}, tampered=F.coalesce(picked, F.lit(False))
    )


def _sql() -> str:
    enc = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: f"sha256({enc('doc_id')} || {enc('source')} || {enc('lang')} || {enc('n_chars')} || {enc(text)})"
    # CRC-32 over the decimal digits, bit by bit
    crc = (
        "xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),"
        " lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),"
        " lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT)"
    )
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(':' || lang, '') AS g, {leaf('text')} AS leaf,
         CASE WHEN {crc} % 3 = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {leaf('text')} END AS other
  FROM documents),
leaf AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY g) AS n FROM d),
tree(l, g, p, n, h) AS (
  SELECT 0, g, p, n, leaf FROM leaf
  UNION ALL
  SELECT l + 1, g, p // {FAN}, (n + {FAN - 1}) // {FAN}, sha256(string_agg(h, '' ORDER BY p)) FROM tree WHERE n > 1 GROUP BY l, g, p // {FAN}, n),
sub AS (SELECT g, l, h, row_number() OVER (ORDER BY g) - 1 AS sp, count(*) OVER () AS sn FROM tree WHERE n = 1),
upper(l, p, n, h) AS (
  SELECT 0, sp, sn, h FROM sub
  UNION ALL
  SELECT l + 1, p // {FAN}, (n + {FAN - 1}) // {FAN}, sha256(string_agg(h, '' ORDER BY p)) FROM upper WHERE n > 1 GROUP BY l, p // {FAN}, n),
steps AS (
  SELECT leaf.g, leaf.p, tree.l, coalesce(string_agg(tree.h, '' ORDER BY tree.p) FILTER (tree.p < leaf.p // CAST({FAN} ** (tree.l) AS BIGINT)), '') AS lo,
         coalesce(string_agg(tree.h, '' ORDER BY tree.p) FILTER (tree.p > leaf.p // CAST({FAN} ** (tree.l) AS BIGINT)), '') AS hi
  FROM leaf JOIN tree ON tree.g = leaf.g AND tree.n > 1 AND tree.p // {FAN} = (leaf.p // CAST({FAN} ** (tree.l + 1) AS BIGINT)) GROUP BY ALL
  UNION ALL
  SELECT leaf.g, leaf.p, sub.l + upper.l, coalesce(string_agg(upper.h, '' ORDER BY upper.p) FILTER (upper.p < sub.sp // CAST({FAN} ** (upper.l) AS BIGINT)), ''),
         coalesce(string_agg(upper.h, '' ORDER BY upper.p) FILTER (upper.p > sub.sp // CAST({FAN} ** (upper.l) AS BIGINT)), '')
  FROM leaf JOIN sub USING (g) JOIN upper ON upper.n > 1 AND upper.p // {FAN} = (sub.sp // CAST({FAN} ** (upper.l + 1) AS BIGINT)) GROUP BY leaf.g, leaf.p, sub.l, upper.l),
fold(g, p, l, h) AS (
  SELECT g, p, 0, other FROM leaf
  UNION ALL
  SELECT g, p, l + 1, sha256(lo || h || hi) FROM fold JOIN steps USING (g, p, l)),
ends AS (SELECT g, p, max_by(h, l) AS folded_root FROM fold GROUP BY g, p),
proof AS (SELECT g, p, sha256(coalesce(string_agg(lo || hi, '' ORDER BY l), '')) AS proof_sha256 FROM steps GROUP BY g, p)
SELECT doc_id, leaf, sub.h AS subroot, (SELECT h FROM upper WHERE n = 1) AS root,
       coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = (SELECT h FROM upper WHERE n = 1) AS verified
FROM leaf JOIN sub USING (g) JOIN ends USING (g, p) LEFT JOIN proof USING (g, p)
"""


OP13_SQL = _sql()
