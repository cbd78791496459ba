"""Keyed merge and patch over plain parquet tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crestline.operators.ordering import latest

# A patch expression sees the staged and the target row: ``lambda s, t: F.coalesce(s("x"), t("x"))``.
Side = Callable[[str], Column]
PatchExpr = Callable[[Side, Side], Column]


def _content(df: DataFrame, keys: Sequence[str]) -> Column:
    """The columns besides the keys as one comparable value."""
    rest = [f for f in df.schema if f.name not in keys]
    return F.struct(F.lit(0), *[F.to_json(f.name) if isinstance(f.dataType, T.MapType) else F.col(f.name) for f in rest])


def last_wins(staged: DataFrame, keys: Sequence[str], seq: str | None) -> DataFrame:
    """One staged row per key: the one with the highest ``seq``, which is dropped.

    Without ``seq``, and among equal ``seq``, the row with the greatest content wins
    (columns compared in their order), so the choice never depends on row order.
    """
    by = [_content(staged, keys).desc()]
    if seq is None:
        return latest(staged, keys, by)
    return latest(staged, keys, [F.col(seq).desc(), *by]).drop(seq)


def _joined(target: DataFrame, staged: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Target columns as they are, staged ones prefixed, a flag per side.

    Keys stay the join's own columns, so a following merge on the same keys
    finds the rows already partitioned.
    """
    t = target.withColumn("_in_t", F.lit(True))
    s = staged.select(
        *keys,
        *[F.col(c).alias(f"_s_{c}") for c in staged.columns if c not in keys],
        F.lit(True).alias("_in_s"),
    )
    return t.join(s, list(keys), how)


def upsert(
    target: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    insert_cols: Sequence[str] | None = None,
    seq: str | None = None,
    within: Column | None = None,
) -> DataFrame:
    """The table after merging ``staged`` into ``target`` on ``keys``.

    Matched rows take ``update_cols`` from the staged row and keep the rest; new
    rows take ``insert_cols`` and leave the rest null. A repeated staged key
    resolves to one row (``last_wins``). Row order never matters. Only target rows
    for which ``within`` holds are matched, so a merge of one day joins that day
    and passes the others through.
    """
    if within is not None:
        inside = F.coalesce(within, F.lit(False))
        merged_part = upsert(target.filter(inside), staged, keys, update_cols, insert_cols, seq)
        return target.filter(~inside).unionByName(merged_part)
    staged = last_wins(staged, keys, seq)
    update = set(staged.columns if update_cols is None else update_cols)
    insert = set(staged.columns if insert_cols is None else insert_cols)
    both = _joined(target, staged, keys, "full_outer")
    is_new, is_staged = F.col("_in_t").isNull(), F.col("_in_s").isNotNull()

    def merged(c: str) -> Column:
        if c in keys:
            return F.col(c)
        new = F.col(f"_s_{c}") if c in staged.columns else F.lit(None)
        on_insert = new if c in insert else F.lit(None)
        on_match = new if c in update else F.col(c)
        return F.when(is_new, on_insert).when(is_staged, on_match).otherwise(F.col(c))

    return both.select(*[merged(f.name).cast(f.dataType.simpleString()).alias(f.name) for f in target.schema])


def patch(
    target: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    exprs: Mapping[str, PatchExpr],
    seq: str | None = None,
) -> DataFrame:
    """Update matched target rows column by column; staged rows without a match are ignored."""
    staged = last_wins(staged, keys, seq)
    both = _joined(target, staged, keys, "left")
    hit = F.col("_in_s").isNotNull()

    def s(c: str) -> Column:
        return F.col(c) if c in keys else F.col(f"_s_{c}")

    def patched(c: str, dtype: str) -> Column:
        if c not in exprs:
            return F.col(c)
        return F.when(hit, exprs[c](s, F.col)).otherwise(F.col(c)).cast(dtype)

    return both.select(*[patched(f.name, f.dataType.simpleString()).alias(f.name) for f in target.schema])


def keep_old_if_null(*cols: str) -> dict[str, PatchExpr]:
    def one(c: str) -> PatchExpr:
        return lambda s, t: F.coalesce(s(c), t(c))

    return {c: one(c) for c in cols}


def keep_old_if_empty(col: str) -> PatchExpr:
    return lambda s, t: F.when(F.coalesce(F.size(s(col)), F.lit(0)) > 0, s(col)).otherwise(t(col))


def missing_ids(requested: DataFrame, returned: DataFrame, key: str) -> DataFrame:
    """Ids asked for that did not come back."""
    return requested.select(key).distinct().join(returned.select(key), key, "left_anti")
