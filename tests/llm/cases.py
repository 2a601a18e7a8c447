"""Rows that are hard on every operator, and plain brute-force versions."""

from __future__ import annotations

import re

LONG = " ".join(f"word{i * 7919 % 5000}" for i in range(20_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# columns named like the operators' own, whatever their case
CLASHES = ["_h1", "_H2", "fingerprint", "keep", "_text", "lang_pred", "Score", "rejected", "ids", "n_tokens", "block", "pos", "token", "w"]

HARD = [
    (1, None, "en", "s", 0),
    (2, "", "en", "s", 0),
    (None, "a row without id, told apart by its text", None, None, None),
    (None, None, None, None, None),
    (3, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "s", None),
    (3, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "s", None),
    (3, "an other text under the same id as before", "en", "t", 1),
    (4, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "s", 9),
    (5, LONG, "en", "s", len(LONG)),
    (6, LONG + " and a little more", "en", "s", 1),
    (7, "x", None, "s", 1),
    (8, " \t\n\x0b ", "en", "s", 4),
    (9, "ÄÖÜ ß é Straße 中文字 🙂🙂 naïve​", "de", "s", 5),
    (10, "1234567890" * 300, "en", "s", 3000),
]


def hard(spark, clashes: bool = True):
    df = spark.createDataFrame(HARD, SCHEMA)
    if clashes:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit(f"extra {c}") for c in CLASHES})
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def white_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))


def reachable(nodes, linked):
    """Smallest node reached by each, by walking all pairs."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    listed = sorted(nodes)
    for i, a in enumerate(listed):
        for b in listed[:i]:
            if linked(a, b):
                one, two = find(a), find(b)
                root[max(one, two)] = min(one, two)
    return {n: find(n) for n in nodes}
