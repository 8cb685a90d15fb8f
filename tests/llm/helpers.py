"""Shared fixtures of the training-data tests: brute-force versions and awkward rows."""

import collections
import random
import re

LETTER_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return LETTER_WORD.findall((text or "").translate(LOWER))


def shingles(ws, n=5):
    return [tuple(ws[i:i + n]) for i in range(max(1, len(ws) - n + 1))] if ws else []


def prose(rng, n, vocab=400):
    """n words in sentences and lines."""
    out = []
    for i in range(n):
        w = f"w{rng.randrange(vocab)}x"
        out.append(w + (".\n" if i % 23 == 22 else ". " if i % 9 == 8 else " "))
    return "".join(out).strip()


def edited(rng, text, k):
    ws = text.split(" ")
    for _ in range(k):
        ws[rng.randrange(len(ws))] = f"edit{rng.randrange(10**6)}"
    return " ".join(ws)


#: Columns that bear names operators use inside.
CLASHING = ["row", "found", "node", "marks", "doc", "hash", "words", "n", "band", "item", "a.b"]


def with_clashes(df):
    from pyspark.sql import functions as F

    for c in CLASHING:
        df = df.withColumn(c, F.lit(f"own {c}"))
    return df


def corpus(seed=1):
    """(doc_id, text) rows: prose, copies, near copies, shared passages, nulls, empties, a long text, repeated rows."""
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randrange(30, 300))) for i in range(40)]
    rows += [(100 + i, rows[0][1]) for i in range(12)]                       # exact copies
    rows += [(200 + i, edited(rng, rows[1][1] * 2, 2)) for i in range(12)]   # near copies
    passage = prose(random.Random(99), 60)
    rows += [(300 + i, prose(rng, 50) + " " + passage + " " + prose(rng, 50)) for i in range(6)]
    rows += [(400, None), (401, ""), (402, "?!\n"), (403, "one two"), (404, "One  two"), (405, prose(rng, 20000, 5000))]
    rows += [(406, "again and again"), (406, "again and again"), (407, "an id of two texts here"), (407, prose(rng, 40)), (None, prose(rng, 40)), (None, rows[2][1])]
    return rows


def components(rows):
    """Brute force of near-duplicate linking: {row number: (set size, smallest doc_id)}."""
    sets = [frozenset(shingles(re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)))) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    out = {}
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            out[i] = (len(sets[i]), min(ids) if ids else None)
    return out
