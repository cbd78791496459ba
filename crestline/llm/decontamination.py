"""Benchmark decontamination over a positional inverted index.

The index stores, for the terms that any benchmark item holds, where each stands in
each text (``build_index``). A phrase is looked up from its rarest terms: every
window of an item takes its ``ANCHORS`` rarest positions, their postings are shifted
by the item position, and only where the shifted lists meet is an alignment of text
and item considered. Alignments are then compared word by word, so hashes never
decide. Proximity matches come from the same index: places where an item's rarest
terms stand close together in any order.

All steps are DataFrame expressions. Postings are spread by text, so a passage that
a third of all texts share makes more alignments, not a larger group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crestline.llm.common import ascii_lower, table, written

#: what separates words: ASCII except digits and letters
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, ANCHORS = 13, 2
NEAR_TERMS, NEAR_SPAN = 3, 20
#: rows of item-side tables up to which they are broadcast; larger ones are shuffled
BROADCAST_ROWS = 200_000
#: and with texts, if they hold at most this many words (some 40 MB)
BROADCAST_WORDS = 2_000_000


def plain(text: Column) -> Column:
    """The words with one blank between them. Splitting at it costs half of extracting every match."""
    return F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), GAP, " "))


def count_words(plain_text: str) -> Column:
    """Words in a column made by ``plain``."""
    return F.when(F.col(plain_text) == "", F.lit(0)).otherwise(F.size(F.split(plain_text, " "))).cast("bigint")


def words(text: Column) -> Column:
    """The words as an array. For large tables split a ``plain`` column instead: of no words it makes one empty one."""
    return F.filter(F.split(plain(text), " "), lambda w: w != "")


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcasting if it has at most ``rows`` rows; ``df`` must be cheap to count."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Names a row. Rows that agree in both columns share it, and their results; a collision only adds comparisons."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def items_of(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item, item_id, words, n, span``: one row per distinct item text with words; ``span`` is its window's length."""
    out = benchmark.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("words")).where("size(words) > 0")
    return out.distinct().select(
        F.xxhash64("item_id", "words").alias("item"), "item_id", "words", F.size("words").alias("n"),
        F.least(F.size("words"), F.lit(WINDOW)).alias("span"),
    )


def item_terms(items: DataFrame) -> DataFrame:
    """``item, n, span, ip, word, term``: the positions of the items."""
    return items.select("item", "n", "span", F.posexplode("words").alias("ip", "word")).withColumn("term", F.xxhash64("word"))


def build_index(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, pos, term``: stored postings of every text for the given ``terms``."""
    spread = docs.select(row_key(id_col, text_col).alias("row"), F.posexplode(F.split(plain(F.col(text_col)), " ")).alias("pos", "word"))
    postings = spread.select("row", "pos", F.xxhash64("word").alias("term")).join(small(terms), "term", "left_semi")
    return written(postings, "postings")


def rarity(terms: DataFrame, index: DataFrame) -> DataFrame:
    """``item_terms`` with ``cf``, the postings of each term; positions whose term no text holds have 0."""
    counts = index.groupBy("term").agg(F.count("*").alias("cf"))
    return terms.join(counts, "term", "left").withColumn("cf", F.coalesce("cf", F.lit(0)))


def anchors(ranked: DataFrame, per_window: int = ANCHORS) -> DataFrame:
    """``item, ip, term, need``: the rarest positions of each window that can occur at all."""
    windows = ranked.select(
        "item", "span", "ip", "term", "cf",
        F.explode(F.sequence(F.greatest(F.lit(0), F.col("ip") - F.col("span") + 1), F.least(F.col("ip"), F.col("n") - F.col("span")))).alias("start"),
    )
    window = W.partitionBy("item", "start")
    return (
        windows.withColumn("rank", F.row_number().over(window.orderBy("cf", "ip")))
        .withColumn("least", F.min("cf").over(window))
        .where((F.col("rank") <= per_window) & (F.col("least") > 0))
        .select("item", "ip", "term", F.least("span", F.lit(per_window)).alias("need"))
        .distinct()
    )


def alignments(index: DataFrame, chosen: DataFrame) -> DataFrame:
    """``row, item, shift``: where shifted postings of enough anchors meet (item position 0 falls on ``shift``)."""
    hits = index.join(small(chosen), "term")
    return (
        hits.groupBy("row", "item", (F.col("pos") - F.col("ip")).alias("shift"))
        .agg(F.count("*").alias("met"), F.first("need").alias("need"))
        .where("met >= need")
        .select("row", "item", "shift")
    )


def phrase_matches(docs: DataFrame, items: DataFrame, found: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``doc_id, row, n_words`` of every row, and ``row, item, places``: text positions inside an occurring window."""
    lists = found.join(small(items.select("item", "n")), "item").groupBy("row").agg(
        F.collect_list(F.struct("item", "shift", "n")).alias("found")
    )
    keyed = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    read = keyed.join(lists.hint("shuffle_hash"), "row", "left").withColumn("plain", plain(F.col("text"))).select(
        "doc_id", "row", "found", count_words("plain").alias("n_words"), F.split("plain", " ").alias("words")
    )
    # per alignment the stretch of the text that faces the item
    part = F.transform(
        "found",
        lambda c: F.struct(
            c["item"].alias("item"), c["shift"].alias("shift"), F.greatest(-c["shift"], F.lit(0)).alias("first"),
            F.slice(
                F.col("words"), F.greatest(c["shift"], F.lit(0)) + 1,
                F.greatest(c["n"] - F.greatest(-c["shift"], F.lit(0)), F.lit(0)),
            ).alias("facing"),
        ),
    )
    read = written(read.select("doc_id", "row", "n_words", part.alias("parts")), "facing")
    facing = (
        read.where("parts is not null").dropDuplicates(["row"]).select("row", F.inline("parts"))
        .join(small(items), "item")
    )
    same = F.zip_with("facing", F.slice("words", F.col("first") + 1, F.size("facing")), lambda a, b: a == b)
    full = F.filter(
        F.sequence(F.lit(0), F.size("facing") - F.col("span")),
        lambda s: F.forall(F.slice(F.col("same"), s + 1, F.col("span")), lambda x: x),
    )
    matched = (
        facing.where("size(facing) >= span").withColumn("same", same).withColumn("full", full).where("size(full) > 0")
        .select(
            "row", "item",
            F.array_distinct(F.flatten(F.transform(
                "full", lambda s: F.sequence(s + F.col("shift") + F.col("first"), s + F.col("shift") + F.col("first") + F.col("span") - 1)
            ))).alias("places"),
        )
    )
    return read.select("doc_id", "row", "n_words"), matched


def proximity_matches(index: DataFrame, ranked: DataFrame, terms: int = NEAR_TERMS, span: int = NEAR_SPAN) -> DataFrame:
    """``row, item, first, last``: stretches of at most ``span`` words that hold the item's rarest terms, in any order.

    Ranked are the terms that some text holds; items with fewer of them have none. One row per place where the
    last of the terms falls in.
    """
    by_item = W.partitionBy("item").orderBy("cf", "word")
    rare = (
        ranked.where("cf > 0").groupBy("item", "term").agg(F.min("cf").alias("cf"), F.min("word").alias("word")).withColumn("k", F.row_number().over(by_item))
        .where(F.col("k") <= terms).withColumn("have", F.max("k").over(W.partitionBy("item")))
        .where(F.col("have") == terms).select("item", "term", "k")
    )
    hits = index.join(small(rare), "term")
    before = W.partitionBy("row", "item").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    seen = [F.last(F.when(F.col("k") == i + 1, F.col("pos")), ignorenulls=True).over(before) for i in range(terms)]
    last = hits.select("row", "item", "pos", *[c.alias(f"p{i}") for i, c in enumerate(seen)])
    known = [F.col(f"p{i}") for i in range(terms)]
    first = F.least(*known)
    for c in known:
        last = last.where(c.isNotNull())
    return last.where(F.col("pos") - first < span).select("row", "item", first.alias("first"), F.col("pos").alias("last"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", proximity: bool = True,
) -> DataFrame:
    """``doc_id, row, n_words, n_hit, item_ids`` (sorted, as text), ``near_items, near_spans, contaminated``: one row per row of ``docs``.

    A word is hit inside any occurrence of a window of 13 words of an item, or of a whole
    shorter item. A text is contaminated when a word is hit and hits are a twentieth of
    its words or more. ``near_items`` counts the items with a proximity match and
    ``near_spans`` says where: ``item_id`` (as text), the ``first`` and ``last`` word. Null and
    wordless texts have no words and no hits; null or wordless items occur nowhere; rows
    that repeat an id or a text each get their own result; a null item id is not listed.
    Without documents the result is empty, without items nothing is hit. Other columns
    are not read.
    """
    items = written(items_of(benchmark, item_id_col, item_text_col), "items")
    terms = item_terms(items)
    index = build_index(docs, terms.select("term").distinct(), id_col, text_col)
    ranked = written(rarity(terms, index), "terms")
    found = alignments(index, written(anchors(ranked), "anchors"))
    read, matched = phrase_matches(docs, items, found, id_col, text_col)
    matched = written(matched, "matched")
    hit = (
        matched.select("row", F.explode("places").alias("place")).distinct()
        .groupBy("row").agg(F.count("*").alias("n_hit"))
    )
    named = (
        matched.select("row", "item").distinct().join(small(items.select("item", "item_id")), "item")
        .groupBy("row").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    )
    out = read.join(hit, "row", "left").join(named, "row", "left")
    near, no_spans = F.lit(0), F.array().cast("array<struct<item_id:string,first:int,last:int>>")
    spans = no_spans
    if proximity:
        close = proximity_matches(index, ranked).join(small(items.select("item", "item_id")), "item")
        place = F.struct(F.col("item_id").cast("string").alias("item_id"), "first", "last")
        per_item = close.groupBy("row", "item").agg(F.collect_set(place).alias("places"))
        per_row = per_item.groupBy("row").agg(
            F.count("*").alias("near"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("near_spans")
        )
        out = out.join(per_row, "row", "left")
        near, spans = F.coalesce("near", F.lit(0)), F.coalesce("near_spans", no_spans)
    n_hit = F.coalesce("n_hit", F.lit(0))
    return out.select(
        "doc_id", "row", "n_words", n_hit.alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        near.alias("near_items"), spans.alias("near_spans"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole operator, proximity matches too, is written as table ``contamination``; returned are the columns of its SQL."""
    out = written(contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")), "contamination")
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )


def decontamination_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op10_decontamination`` with the proximity matches: how many items, and where, as ``item:first-last``."""
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    place = lambda s: F.concat(s["item_id"], F.lit(":"), s["first"].cast("string"), F.lit("-"), s["last"].cast("string"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
        F.col("near_items").cast("bigint").alias("near_items"), F.array_join(F.transform("near_spans", place), ",").alias("near_spans"),
    )


_EXACT = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, w, least(len(w), 13) AS k FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, k, array_to_string(w[i + 1:i + k], ' ') AS s
         FROM (SELECT item_id, w, k, unnest(range(0, len(w) - k + 1)) AS i FROM b)),
spans AS (SELECT doc_id, k, i, array_to_string(w[i + 1:i + k], ' ') AS s
          FROM (SELECT doc_id, w, k, unnest(range(0, len(w) - k + 1)) AS i
                FROM d, (SELECT DISTINCT k FROM wins) WHERE len(w) >= k)),
occ AS (SELECT doc_id, item_id, i, spans.k FROM spans JOIN wins ON spans.k = wins.k AND spans.s = wins.s),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY doc_id)"""
_COLUMNS = """SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated"""
_FROM = "FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"
OP10_SQL = f"{_EXACT} {_COLUMNS} {_FROM}"
NEAR_SQL = f"""{_EXACT},
placed AS (SELECT doc_id, w[p + 1] AS word, p FROM (SELECT doc_id, w, unnest(range(0, len(w))) AS p FROM d)),
cf AS (SELECT word, count(*) AS cf FROM placed GROUP BY word),
rare AS (SELECT item_id, word, row_number() OVER (PARTITION BY item_id ORDER BY cf, word) AS k
         FROM (SELECT DISTINCT item_id, unnest(w) AS word FROM b) JOIN cf USING (word) QUALIFY k <= {NEAR_TERMS}),
few AS (SELECT * FROM rare WHERE item_id IN (SELECT item_id FROM rare GROUP BY item_id HAVING count(*) = {NEAR_TERMS})),
near AS (SELECT doc_id, item_id, p, {", ".join(f"max(p) FILTER (k = {i + 1}) OVER up AS p{i}" for i in range(NEAR_TERMS))}
         FROM placed JOIN few USING (word) WINDOW up AS (PARTITION BY doc_id, item_id ORDER BY p)),
met AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item, least({", ".join(f"p{i}" for i in range(NEAR_TERMS))}) AS first, p AS last
        FROM near WHERE {" AND ".join(f"p{i} IS NOT NULL" for i in range(NEAR_TERMS))}),
spots AS (SELECT doc_id, count(DISTINCT item) AS near_items, string_agg(item || ':' || first || '-' || last, ',' ORDER BY item, first, last) AS near_spans
          FROM met WHERE last - first < {NEAR_SPAN} GROUP BY doc_id)
{_COLUMNS}, coalesce(near_items, 0) AS near_items, coalesce(near_spans, '') AS near_spans
{_FROM} LEFT JOIN spots USING (doc_id)"""
