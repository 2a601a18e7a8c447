"""Language identification by compression with per-language zstandard dictionaries.

Each learned language has a raw-content dictionary of labelled text. A text is cut into
pieces, each piece is compressed with every dictionary, and the language whose sizes sum
to the least wins. Pieces keep the dictionary, and not the text's own repetitions,
decisive in long texts.

A null text or one without any letter is ``und`` and rejected. Ties go to the first
language by name. ``score`` is the share of the runner-up's size that the best one saves,
0 to 1. With fewer than two learned languages there is no runner-up: the score is 1.
Without any learned language every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlake.llm.common import blocks, ready, unused

SAMPLES = 256  # labelled texts sampled per language
SAMPLE_CHARS = 500  # and characters of letters and spaces taken of each, at a place by its hash
LANGUAGES = 1000  # languages learned, those of most rows: with the two above the bound of the training sample
PIECE = 1024  # bytes
SHORT = 200  # bytes: a shorter text is compressed behind a stretch of the dictionary, see Classifier
LEVEL = 3
MIN_MATCH = 3
MARGIN = 0.004  # a smaller share saved over the runner-up is too narrow
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_PLAIN = bytes(c if c > 127 or 97 <= c <= 122 else 32 for c in range(256))


def letters(text: str) -> bytes:
    """Lower case, with all other ASCII characters as single spaces."""
    return b" ".join(text.lower().encode().translate(_PLAIN).split())


def held_out(doc_id: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a document is kept from training; a null id is (it cannot be assigned to a fold)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(True))


def learn(docs: DataFrame) -> dict[str, bytes]:
    """Dictionary content by language from rows with text and lang.

    Every language gives ``SAMPLES`` texts, each the least by hash of its share of the rows
    with a letter anywhere, so map tasks pre-aggregate and the sample does not depend on row
    order. Whole texts are sampled; a stretch is taken of what is left of each when everything
    but letters is a space, so numbers and signs in front leave nothing out.
    """
    h = F.xxhash64(F.lit(11), "text")
    rows = docs.select("lang", "text", F.pmod(h, F.lit(SAMPLES)).alias("share"), h.alias("h")).filter(
        "lang is not null and text rlike '\\\\p{L}'"
    )
    # hashes alone are aggregated; the few texts they name are read again
    sampled = rows.groupBy("lang", "share").agg(F.min("h").alias("h"), F.count("*").alias("n"))
    most = sampled.groupBy("lang").agg(F.sum("n").alias("rows")).orderBy(F.desc("rows"), "lang").limit(LANGUAGES)
    chosen = sampled.join(most, "lang", "left_semi").select("lang", "h")
    named = rows.select("lang", "share", "text", "h").join(F.broadcast(chosen), ["lang", "h"])  # SAMPLES * LANGUAGES rows at most
    spaced = F.trim(F.regexp_replace("text", "[^\\p{L}\\p{M}]+", " "))
    places = F.greatest(F.length("spaced") - SAMPLE_CHARS, F.lit(0)) + 1
    stretch = F.substring(F.col("spaced"), (F.pmod("h", places) + 1).cast("int"), F.lit(SAMPLE_CHARS))
    one = named.groupBy("lang", "share").agg(F.min(F.struct("h", "text")).alias("one")).select("lang", "share", "one.*")
    picked = one.withColumn("spaced", spaced).select("lang", "share", stretch.alias("t")).collect()  # bounded by the sample
    content: dict[str, list[str]] = {}
    for row in sorted(picked):
        content.setdefault(row.lang, []).append(row.t)
    return {lang: letters(" ".join(texts)) for lang, texts in content.items()}


class Classifier:
    """Compressors of one process, by language.

    zstandard stores a block raw that hardly shrinks, so a short text would tie. It
    follows a stretch of the dictionary itself, which costs next to nothing.
    """

    def __init__(self, dictionaries: dict[str, bytes]):
        self.languages = sorted(dictionaries)
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, min_match=MIN_MATCH, write_checksum=False, write_content_size=False
        )
        self.compressors, self.stretches = [], []
        for lang in self.languages:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=settings)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=content, compression_params=settings))
            self.stretches.append(dictionaries[lang][-96:-32] + b" ")

    def sizes(self, text: str) -> np.ndarray:
        data = letters(text)
        if len(data) < SHORT:
            return np.array([len(c.compress(s + data)) for c, s in zip(self.compressors, self.stretches)])
        pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
        return np.array([sum(len(c.compress(p)) for p in pieces) for c in self.compressors])

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score, whether rejected."""
        if text is None or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        sizes = self.sizes(text)
        first, second = np.argsort(sizes, kind="stable")[:2]
        score = float(1 - sizes[first] / sizes[second])
        return self.languages[first], score, score < MARGIN


def identify(docs: DataFrame, dictionaries: dict[str, bytes], keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (doc_id by default) with lang_pred, score and rejected, or these names
    with ``_`` behind where a kept column has them; only text is looked at."""
    spark = docs.sparkSession
    ready(spark)
    kept = docs.select(*[docs[c] for c in keep or ["doc_id"]])
    (text,) = unused(kept, "_text")
    rows = docs.select(*[docs[c] for c in kept.columns], docs["text"].cast("string").alias(text))
    lang_name, score_name, rejected_name = unused(kept, "lang_pred", "score", "rejected")
    schema = StructType(list(kept.schema.fields)).add(lang_name, "string").add(score_name, "double").add(rejected_name, "boolean")
    shared = spark.sparkContext.broadcast(dictionaries)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(shared.value)
        for block in blocks(batches, text):
            found = [classifier.predict(t.as_py()) for t in block.column(text)]
            lang, score, rejected = map(list, zip(*found)) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [block.column(c) for c in block.schema.names if c != text]
                + [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)


def accepted(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """The rows of ``docs`` whose language is told with enough margin, columns as they were."""
    found = identify(docs, dictionaries, docs.columns)
    return found.filter(~F.col(found.columns[-1])).select(*docs.columns)
