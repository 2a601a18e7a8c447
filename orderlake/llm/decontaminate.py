"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

A window is ``size`` consecutive words of an item, or all words of a shorter one. All its
tokens must occur, so by the prefix principle the rarest one must: windows are joined to
document words on it alone. The token's place in the window gives the window's start,
which must lie within the document (positional and length bounds), and the words there
are compared one by one.

The windows go to the workers in blocks of a bounded number of bytes, one pass over the
documents for each block; a benchmark of ordinary size is one block.

Null texts have no words. Items without words match nothing; a null item id shows as an
empty string. Repeated documents are judged alike, repeated items count once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import stage, text_key, unused

SIZE = 10
BLOCK_BYTES = 16 << 20
KEY = ["doc_id", "_h1", "_h2"]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words in order, A-Z lower-cased; null for a null text."""
    return F.array_remove(F.split(F.translate(text, _UPPER, _UPPER.lower()), _BETWEEN), "")


def windows(items: DataFrame, size: int = SIZE) -> DataFrame:
    """Columns item_id (string), window (array of words), one row per distinct pair."""
    listed = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words(F.col("text")).alias("w"))
    length = F.least(F.size("w"), F.lit(size))
    starts = listed.filter("size(w) > 0").withColumn("s", F.explode(F.sequence(F.lit(1), F.size("w") - length + 1)))
    return starts.select("item_id", F.slice("w", F.col("s"), length).alias("window")).distinct()


def _token_counts(docs: DataFrame, tokens: DataFrame, small: bool) -> DataFrame:
    """How often each token occurs in all documents; absent tokens have no row."""
    found = docs.select(F.explode_outer(words(F.col("text"))).alias("token"))
    if small:
        return found.join(F.broadcast(tokens), "token", "left_semi").groupBy("token").count()
    return found.groupBy("token").count().join(tokens, "token", "left_semi")


def prefixes(docs: DataFrame, items: DataFrame, size: int = SIZE) -> tuple[DataFrame, DataFrame, int]:
    """(item_id, window id) pairs; each window with its rarest token and that token's place;
    the number of blocks. Windows with a token that no document has cannot occur and go."""
    listed = stage(windows(items, size).withColumn("window_id", F.array_join("window", " ")), "windows")
    distinct = listed.select("window_id", "window").distinct()
    n_bytes = listed.agg(F.sum(F.octet_length("window_id") * 2 + 64)).first()[0] or 0
    token = distinct.select("window_id", F.posexplode("window").alias("place", "token"))
    counts = stage(_token_counts(docs, token.select("token").distinct(), n_bytes <= BLOCK_BYTES), "token-counts")
    rarest = (
        token.join(counts, "token", "left").groupBy("window_id")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token", "place")).alias("r"))
        .filter("r.n > 0")
    )
    n_blocks = max(1, math.ceil(n_bytes / BLOCK_BYTES))
    chosen = distinct.join(rarest, "window_id").select(
        "window_id", "window", "r.token", "r.place", F.pmod(F.xxhash64("window_id"), F.lit(n_blocks)).alias("block")
    )
    return listed.select("item_id", "window_id"), stage(chosen, "prefixes"), n_blocks


def occurrences(docs: DataFrame, chosen: DataFrame, n_blocks: int) -> DataFrame:
    """Columns KEY, start (from 0), length, window_id: every place of a window in a document."""
    listed = docs.select(*KEY, words(F.col("text")).alias("w"))
    listed = listed.select(*KEY, "w", F.posexplode_outer("w").alias("pos", "token"))
    start, length = F.col("pos") - F.col("place"), F.size("window")
    fits = (start >= 0) & (start + length <= F.size("w")) & (F.slice("w", start + 1, length) == F.col("window"))
    found = None
    for block in range(n_blocks):
        part = chosen.filter(F.col("block") == block).drop("block")
        one = listed.join(F.broadcast(part), "token").filter(fits).select(
            *KEY, start.alias("start"), length.alias("length"), "window_id"
        )
        found = one if found is None else found.union(one)
    return found


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(), F.col("text").cast("string").alias("text"))


def hits(docs: DataFrame, items: DataFrame, size: int = SIZE) -> DataFrame:
    """Columns KEY, n_hit, item_ids (sorted strings), one row per contaminated content."""
    docs = _keyed(docs)
    item_windows, chosen, n_blocks = prefixes(docs, items, size)
    found = stage(occurrences(docs, chosen, n_blocks), "occurrences")
    ends = found.groupBy(*KEY, "start").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    before = Window.partitionBy(*KEY).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0)))
    covered = ends.select(*KEY, F.greatest(fresh, F.lit(0)).alias("n")).groupBy(*KEY).agg(F.sum("n").alias("n_hit"))
    named = (
        found.select(*KEY, "window_id").distinct().join(item_windows, "window_id").select(*KEY, "item_id").distinct()
        .groupBy(*KEY).agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    )
    named = named.toDF("_d", "_1", "_2", "item_ids")
    on = covered["doc_id"].eqNullSafe(named["_d"]) & (covered["_h1"] == named["_1"]) & (covered["_h2"] == named["_2"])
    return covered.join(named, on).select(*KEY, "n_hit", "item_ids")


def contamination(docs: DataFrame, items: DataFrame, size: int = SIZE) -> DataFrame:
    """Columns doc_id, n_words, n_hit, item_ids, contaminated, one row per document."""
    found = hits(docs, items, size).toDF("_d", "_1", "_2", "n_hit", "item_ids")
    counted = _keyed(docs).select(*KEY, F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("n_words"))
    on = counted["doc_id"].eqNullSafe(found["_d"]) & (counted["_h1"] == found["_1"]) & (counted["_h2"] == found["_2"])
    return counted.join(found, on, "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, size: int = SIZE) -> DataFrame:
    """The rows of ``docs`` in which no window occurs, columns as they were."""
    h1, h2 = unused(docs, "_h1", "_h2")
    keyed = docs.withColumns(dict(zip((h1, h2), text_key())))
    found = hits(docs, items, size).select(*KEY).toDF("_hit_id", "_hit_1", "_hit_2")
    on = keyed["doc_id"].cast("long").eqNullSafe(found["_hit_id"]) & (keyed[h1] == found["_hit_1"]) & (keyed[h2] == found["_hit_2"])
    return keyed.join(found, on, "left_anti").select(*[keyed[c] for c in docs.columns])
