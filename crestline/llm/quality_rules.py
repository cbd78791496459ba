"""Quality rules in a bitmask ledger.

Texts are measured once (``measure``). Every rule is evaluated once on those numbers
and leaves one bit (``ledger``). Policies are named sets of bits: applying one, or
comparing many, reads the ledger only. Ablations count the texts per distinct mask,
at most 2 ** rules of them, and derive each rule's effect from the masks alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.llm.common import table

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_bangs", "n_bars")

#: name, failing condition over the measures; the bit is the place in this list, so rules are only ever added at its end
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "5 * n_symbols > n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    ("shouting", "10 * n_upper > 3 * word_chars"),
    ("bangs", "5 * n_bangs > n_words"),
    ("table_like", "5 * n_bars > n_words"),
)
BASE = ("few_words", "repeated_words")
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "symbols", "repeated_lines"),
    "v2": tuple(name for name, _ in RULES),
}
POLICY = "v2"

_SPACES, _SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DROP_UPPER = str.maketrans("", "", _UPPER)


def repeated_words(words: list[bytes]) -> int:
    """Words covered by 3-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 1 << 20:  # keeps the triple's code inside 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, times = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    twice = times[which] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


def measured(text: str | None) -> tuple[int, ...]:
    """The values of ``MEASURES``; all zero for a null, empty or blank text."""
    text = text or ""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(text) - len(text.translate(_DROP_UPPER)),
        text.count("!"),
        text.count("|"),
    )


def _measure_batches(batches):
    for batch in batches:
        rows = np.array([measured(t.as_py()) for t in batch.column(1)], np.int64).reshape(-1, len(MEASURES))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(rows[:, i].copy()) for i in range(len(MEASURES)))], ["doc_id", *MEASURES]
        )


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``MEASURES``, one row per input row, by one pass over the texts."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _measure_batches, f"doc_id {kind}, " + ", ".join(f"{m} bigint" for m in MEASURES)
    )


def ledger(measures: DataFrame, rules=RULES) -> DataFrame:
    """``measures`` with ``failed``: bit i is set if rule i fails."""
    failed = F.lit(0).cast("bigint")
    for bit, (_, fails) in enumerate(rules):
        failed = failed + F.when(F.expr(fails), F.lit(1 << bit)).otherwise(F.lit(0))
    return measures.withColumn("failed", failed)


def mask(names, rules=RULES) -> int:
    places = {name: i for i, (name, _) in enumerate(rules)}
    return sum(1 << places[name] for name in names)


def apply_policy(entries: DataFrame, policy: str = POLICY, policies=POLICIES, rules=RULES) -> DataFrame:
    """``entries`` with ``kept``: no rule of the policy, and no base rule, fails."""
    base, own = mask(BASE, rules), mask(policies[policy], rules)
    return entries.withColumn("base_failed", F.col("failed").bitwiseAND(base) != 0).withColumn(
        "kept", F.col("failed").bitwiseAND(base | own) == 0
    )


def ablations(entries: DataFrame, policies=POLICIES, rules=RULES) -> DataFrame:
    """``policy, rule, failing, only, dropped``: per policy and rule of it, the texts that fail the rule,
    those that fail nothing else of the policy (they return if the rule goes), and all that the policy drops."""
    masks = entries.groupBy("failed").agg(F.count("*").alias("n"))
    wanted = entries.sparkSession.createDataFrame(
        [(p, r, mask(names, rules), mask([r], rules)) for p, names in policies.items() for r in names],
        "policy string, rule string, own bigint, bit bigint",
    )
    met = masks.join(F.broadcast(wanted), F.col("failed").bitwiseAND(F.col("own")) != 0)  # both sides bounded by the rules
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    return met.groupBy("policy", "rule").agg(
        count(F.col("failed").bitwiseAND(F.col("bit")) != 0).alias("failing"),
        count(F.col("failed").bitwiseAND(F.col("own")) == F.col("bit")).alias("only"), F.sum("n").alias("dropped"),
    )


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", policy: str = POLICY) -> DataFrame:
    """``doc_id, MEASURES, failed, base_failed, kept``: one row per input row.

    Null, empty and blank texts have only zeros and fail ``few_words``. Repeated rows and
    ids get a row each, a null id stays null, an empty table gives an empty result, and
    columns besides the two named are not read.
    """
    return apply_policy(ledger(measure(docs, id_col, text_col)), policy)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy does to the whole table, from the ledger's masks."""
    return ablations(ledger(measure(table(spark, sf_dir, "documents"))))


def _sql(report: str) -> str:
    failed = " + ".join(f"CASE WHEN {fails} THEN {1 << i} ELSE 0 END" for i, (_, fails) in enumerate(RULES))
    count = lambda chars: f"len(text) - len(regexp_replace(text, '[{chars}]', '', 'g'))"
    return rf"""
WITH d AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
                  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
           FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
win AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 3], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(0, len(w) - 2)) AS i FROM d WHERE len(w) >= 3)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, s) >= 2),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY doc_id),
m AS (SELECT doc_id, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars, {count('#*$%&|<>')} AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(lines) AS n_lines,
             {count('A-Z')} AS n_upper, {count('!')} AS n_bangs, {count('|')} AS n_bars
      FROM d LEFT JOIN r USING (doc_id)),
f AS (SELECT *, CAST({failed} AS BIGINT) AS failed FROM m)
{report}
"""


OP7_SQL = _sql(
    f"SELECT *, failed & {mask(BASE)} <> 0 AS base_failed, failed & {mask(BASE) | mask(POLICIES[POLICY])} = 0 AS kept FROM f"
)
_RULES_OF = ", ".join(f"('{p}', '{r}', {mask(names)}, {mask([r])})" for p, names in POLICIES.items() for r in names)
ABLATIONS_SQL = _sql(
    f"""SELECT policy, rule, count(*) FILTER (failed & bit <> 0) AS failing, count(*) FILTER (failed & own = bit) AS "only", count(*) AS dropped
FROM f JOIN (VALUES {_RULES_OF}) AS p(policy, rule, own, bit) ON failed & own <> 0 GROUP BY policy, rule"""
)
