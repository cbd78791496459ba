"""Toxicity: a lexicon found through Levenshtein automata, judged in context.

The lexicon is learned: words that labelled toxic texts hold far more often than
labelled clean ones. It becomes a trie; intersected with the Levenshtein automaton of
each term's distance it gives one deterministic table, run over all words of a batch at
once. A misspelling keeps its first letter; digits and signs that stand for letters
(``1d10t``, ``$cum``) are read as such, and a masked letter costs one edit.

Each hit is scored in a window of words around it: other hits and address in the second
person speak for abuse, quotation marks and reporting words for quotation. A logistic
regression over the per-text sums gives the score. Lexicon and regression are fitted on
a bounded sample of labelled rows, at most ``TOXIC_ROWS`` and ``CLEAN_ROWS``.
"""

from __future__ import annotations

import dataclasses
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.llm.common import remainder, table, written
from crestline.llm.sampling import bounded_sample, class_counts

TOXIC_ROWS, CLEAN_ROWS = 4000, 12_000
#: of the lexicon: texts that hold a term at least, as a count and a share of toxic ones, ratio of shares. The share bounds it:
#: a text of w words holds at most w terms, so there are at most w / LEAST_SHARE
LEAST_TEXTS, LEAST_SHARE, LIFT = 5, 0.003, 60.0
WINDOW, THRESHOLD, FEATURES = 12, 0.7, 6

# Signs read as letters, words of address, words that report speech.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
ADDRESS = frozenset("you your yours yourself u ur du dich dein ihr tu te toi ton vous votre tú ti usted eres".split())
REPORT = frozenset("said says say called calls wrote writes quoted quote reported sagte schrieb nannte dit écrit appelé dijo escribió llamó".split())
QUOTES = "\"“”„«»‘’"
TERM = re.compile(r"[^\W\d_]{4,}")


def allowed(term: str) -> int:
    """Edits granted to a term."""
    return 1 if len(term) < 8 else 2


@dataclasses.dataclass
class Automaton:
    """A table over character classes; state 0 is dead. ``edits`` of an accepting state, else -1."""

    classes: dict[str, int]
    moves: np.ndarray
    edits: np.ndarray
    longest: int
    shortest: int

    def run(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Edits of each word to its closest term, -1 if none is close enough. ``codes`` are character classes."""
        out = np.full(len(starts), -1, np.int8)
        live = np.flatnonzero((sizes >= self.shortest) & (sizes <= self.longest))
        state = np.ones(len(live), np.int64)
        for step in range(self.longest):
            if not len(live):
                break
            state = self.moves[state, codes[starts[live] + step]]
            ended = sizes[live] == step + 1
            out[live[ended]] = self.edits[state[ended]]
            keep = ~ended & (state > 0)
            live, state = live[keep], state[keep]
        return out


def automaton(terms) -> Automaton:
    """The union of the terms' Levenshtein automata, as a product with their trie, made deterministic."""
    terms = sorted({t for t in terms if t})
    alphabet = {c: i + 1 for i, c in enumerate(sorted({c for t in terms for c in t}))}  # class 0: any other character
    children: list[dict[int, int]] = [{}]
    grant, final = [0], [-1]  # per node: the most edits below it; the edits allowed at its own term
    for t in terms:
        node = 0
        grant[0] = max(grant[0], allowed(t))
        for c in t:
            nxt = children[node].get(alphabet[c])
            if nxt is None:
                nxt = len(children)
                children[node][alphabet[c]] = nxt
                children.append({})
                grant.append(0)
                final.append(-1)
            node = nxt
            grant[node] = max(grant[node], allowed(t))
        final[node] = allowed(t)

    def closed(states: dict[int, int]) -> frozenset:
        """With skipped term letters; of each node the fewest edits."""
        best, todo = {}, list(states.items())
        while todo:
            node, e = todo.pop()
            if e > grant[node] or best.get(node, 99) <= e:
                continue
            best[node] = e
            if node:  # the first letter is never skipped
                todo += [(child, e + 1) for child in children[node].values()]
        return frozenset(best.items())

    def step(state: frozenset, c: int) -> frozenset:
        after: dict[int, int] = {}

        def reach(node, e):
            if after.get(node, 99) > e:
                after[node] = e

        for node, e in state:
            for char, child in children[node].items():
                if char == c:
                    reach(child, e)
                elif node:
                    reach(child, e + 1)
            if node:
                reach(node, e + 1)
        return closed(after)

    start = frozenset([(0, 0)])
    number, moves, edits, todo = {frozenset(): 0, start: 1}, [[0] * (len(alphabet) + 1), []], [-1, -1], [start]
    while todo:
        state = todo.pop()
        row = []
        labels = {c for node, _ in state for c in children[node]}
        other = step(state, 0)  # where every character leads that no node here waits for
        for c in range(len(alphabet) + 1):
            nxt = step(state, c) if c in labels else other
            if nxt not in number:
                number[nxt] = len(moves)
                moves.append([])
                fits = [e for node, e in nxt if final[node] >= e]
                edits.append(min(fits) if fits else -1)
                todo.append(nxt)
            row.append(number[nxt])
        moves[number[state]] = row
    longest = max((len(t) + allowed(t) for t in terms), default=0)
    shortest = min((len(t) - allowed(t) for t in terms), default=0)
    return Automaton(alphabet, np.array(moves, np.int32), np.array(edits, np.int8), longest, max(shortest, 1))


class Reader:
    """Words of texts as runs of an array of character classes."""

    def __init__(self, found: Automaton):
        self.found = found
        letters = np.array([chr(i).isalpha() for i in range(sys.maxunicode + 1)])
        self.code = np.zeros(sys.maxunicode + 1, np.int16)
        for c, k in found.classes.items():
            self.code[ord(c)] = k
        for sign, c in SIGNS.items():
            self.code[ord(sign)] = found.classes.get(c, 0)
        self.inner = np.zeros(sys.maxunicode + 1, bool)  # signs that belong to a word between letters only
        self.inner[[ord("@"), ord("$"), ord("*")]] = True
        self.plain = letters
        self.plain[[ord(c) for c in "0123456789"]] = True

    def words(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Classes of the lower-cased text, and where its words start and how long they are."""
        c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        part = self.plain[c]
        bridge = np.flatnonzero(self.inner[c[1:-1]] & part[:-2] & part[2:]) + 1 if len(c) > 2 else np.zeros(0, int)
        lead = np.flatnonzero((c[:-1] == ord("$")) & part[1:]) if len(c) > 1 else np.zeros(0, int)
        part[bridge] = True
        part[lead] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[False], part, [False]]).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        return self.code[c], starts, ends - starts

    def features(self, text: str | None) -> np.ndarray:
        """Sums over the hits of a text; all zero without any."""
        out = np.zeros(FEATURES)
        if not text or not self.found.longest:
            return out
        codes, starts, sizes = self.words(text)
        edits = self.found.run(codes, starts, sizes)
        hits = np.flatnonzero(edits >= 0)
        if not len(hits):
            return out
        low = text.lower() if len(text.lower()) == len(codes) else text
        exact = int((edits[hits] == 0).sum())
        abuse = quoted = 0.0
        for h in hits.tolist():
            a, b = max(0, h - WINDOW), min(len(starts), h + WINDOW + 1)
            others = int(((hits >= a) & (hits < b)).sum()) - 1
            near = {low[starts[i] : starts[i] + sizes[i]] for i in range(a, b)}
            lo, hi = starts[a], starts[b - 1] + sizes[b - 1]
            before, after = low[lo : starts[h]], low[starts[h] + sizes[h] : hi]
            marks = sum(before.count(q) for q in QUOTES)
            in_quotes = marks % 2 == 1 and any(q in after for q in QUOTES)
            reported = bool(near & REPORT)
            quoted += in_quotes + 0.5 * reported
            abuse += (1 + 0.3 * min(others, 5) + 0.5 * bool(near & ADDRESS)) * (0.5 if edits[h] else 1.0) * (0.3 if in_quotes else 1.0)
        return np.array([
            1.0, min(exact, 1), np.log1p(exact), np.log1p(len(hits) - exact), np.log1p(abuse),
            quoted / len(hits),
        ])


@dataclasses.dataclass
class Model:
    terms: list[str]
    found: Automaton
    weights: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -35, 35))))


def lexicon(sample: DataFrame, toxic: int, clean: int, lift: float = LIFT) -> list[str]:
    """The terms: words of enough toxic texts, whose share there is ``lift`` times that in clean ones."""
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]{4,}"), F.lit(0)))
    counts = sample.select("y", F.explode(found).alias("term")).groupBy("term").agg(
        F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good")
    )
    least = max(LEAST_TEXTS, LEAST_SHARE * toxic)
    ratio = ((F.col("bad") + 0.5) / (toxic + 1)) / ((F.col("good") + 0.5) / (clean + 1))
    best = counts.where((F.col("bad") >= least) & (ratio >= min(lift, 0.5 * clean)))
    return sorted(r[0] for r in best.select("term").collect())


def regression(x: np.ndarray, y: np.ndarray, share: float, penalty: float = 0.05, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps, rows weighted so that toxic ones have their true ``share``."""
    rows = np.hstack([x, np.ones((len(x), 1))])
    seen = max(y.mean(), 1e-6)
    weight = np.where(y == 1, share / seen, (1 - share) / max(1 - seen, 1e-6))
    w = np.zeros(rows.shape[1])
    ridge = np.diag([penalty] * x.shape[1] + [1e-3])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -35, 35)))
        grad = rows.T @ (weight * (p - y)) + ridge @ w
        hess = (rows * (weight * p * (1 - p))[:, None]).T @ rows + ridge
        move = np.linalg.solve(hess, grad)
        w = w - move
        if np.abs(move).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _measured(found: Automaton):
    def run(batches):
        reader = Reader(found)
        for batch in batches:
            rows = np.array([reader.features(t.as_py()) for t in batch.column(1)]).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(rows[:, i].copy()) for i in range(FEATURES))], ["key", *(f"f{i}" for i in range(FEATURES))]
            )

    return run


def measure(docs: DataFrame, found: Automaton, key: str, text_col: str = "text") -> DataFrame:
    """``key, f0 ...``: the features of every row. The table is built once and travels with the tasks."""
    read = docs.select(F.col(key).alias("key"), F.col(text_col).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return read.mapInArrow(_measured(found), f"key {kind}, " + ", ".join(f"f{i} double" for i in range(FEATURES)))


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
    toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS,
) -> Model:
    """Lexicon and regression from the 0/1 column ``label``; null labels and texts teach nothing. Without
    labelled rows the lexicon is empty and every score 0.5."""
    known = labels.select(F.col(id_col).alias("key"), F.col(label).cast("int").alias("y")).where("key is not null and y in (0, 1)").distinct()
    sizes = class_counts(known, "y")
    if not sizes:
        return Model([], automaton([]), np.zeros(FEATURES), 0.0)
    most = {1: toxic_rows, 0: clean_rows}
    # at most those rows, so the broadcast has that bound
    picked = F.broadcast(bounded_sample(known, "y", sizes, most, "key"))
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).where("text is not null")
    sample = written(texts.join(picked, "key").select("y", "text"), "toxicity-sample")
    seen = class_counts(sample, "y")
    terms = lexicon(sample, seen.get(1, 0), seen.get(0, 0))
    found = automaton(terms)
    rows = measure(sample, found, "y").toPandas()
    if not len(rows):
        return Model([], automaton([]), np.zeros(FEATURES), 0.0)
    rows = rows.sort_values(list(rows.columns))
    x, y = rows.drop(columns="key").to_numpy(float), rows["key"].to_numpy(float)
    weights, bias = regression(x, y, sizes.get(1, 0) / sum(sizes.values()))
    return Model(terms, found, weights, bias)


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, hits``, one row per input row; ``hits`` says whether a term was found.

    Null and empty texts have no hits and the score of such texts. Repeated rows and ids get
    a row each, a null id stays, columns besides the two named are not read, an empty table
    gives an empty one.
    """
    raw = F.lit(float(model.bias))
    for i, w in enumerate(model.weights):
        raw = raw + F.lit(float(w)) * F.col(f"f{i}")
    return measure(docs, model.found, id_col, text_col).select(
        F.col("key").alias("doc_id"), (1 / (1 + F.exp(-raw))).alias("score"), (F.col("f0") > 0).alias("hits")
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    model = train(docs, labels.where(~held_out))
    return classify(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "hits"
    )
