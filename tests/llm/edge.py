"""A small table with every awkward row, and plain references to compare with."""

import random
import re

import numpy as np
import xxhash

DDL = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint,"
    " row bigint, words string, fp bigint, score double, dropped string, node bigint"
)


def texts(seed=3, n=30):
    turn = random.Random(seed)
    vocab = ["".join(turn.choice("abcdeghilnorstu") for _ in range(turn.randint(2, 8))) for _ in range(120)]
    return [" ".join(turn.choice(vocab) for _ in range(turn.randint(6, 40))) for _ in range(n)]


def rows():
    made = texts()
    base = made[0] + " " + made[1]
    out = [(i, t, "en", "s", len(t)) for i, t in enumerate(made)]
    out += [
        (100, None, None, None, None), (101, "", "en", "s", 0), (102, " \n\t ", "fr", None, 4), (103, base, "en", "s", 9),
        (104, base, None, "s", 9), (104, base, None, "s", 9), (105, base.upper(), "en", "s", None),
        (106, base + " Extra.", "de", "s", 1), (None, made[2], "en", "s", 2), (None, None, None, None, None),
        (107, "word", "en", "s", 4), (108, "ÀÉÎ Straße ÀÉÎ", "fr", "s", 14), (109, "same line of five words\n" * 4, "en", "s", 3),
        (110, (made[3] + "\n") * 300, "en", "s", 3), (111, "x" * 70_000, "en", "s", 1), (112, "!!! ... 12 34", "en", "s", 1),
    ]
    return [(*r, 1, "w", 2, 0.5, "d", 3) for r in out]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, DDL).repartition(3)


def union(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def majority(hashes):
    bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(0, dtype=int) > len(hashes), bitorder="little").view(np.uint64)[0])


def xxh(text):
    return xxhash.xxh64_intdigest(text.encode(), 42)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def doc_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    return majority([xxh(" ".join(words[i : i + 4])) for i in range(max(1, len(words) - 3))])


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]
