"""Small inputs and plain counterparts for the training-data operators."""

from __future__ import annotations

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars int"
SF = "/root/testdata/sf0.001"
BLANK = " \t\n\x0b\x0c\r"


def docs_of(spark, rows):
    """Rows of (doc_id, text[, source]) as a documents table with all its columns."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def gram_set(text, n):
    w = words(lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


def least_of_group(sets, num, den):
    """Least id reachable over links, for {id: set}."""
    at = {i: i for i in sets}

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root(a), root(b)))
                at[high] = low
    return {i: root(i) for i in ids}


def edit_distance_within(pattern, text):
    """Least edit distance of a list to any part of another, by the plain table."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for symbol in text:
        new = [0]
        for j, p in enumerate(pattern, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (p != symbol)))
        row = new
        best = min(best, row[-1])
    return best
