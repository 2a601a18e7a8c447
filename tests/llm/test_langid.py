import regex
import zstandard
from pyspark.sql import functions as F

from orderlake.llm import langid
from tests.llm.cases import HARD, empty, hard


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    dictionaries = langid.learn(docs.filter(~langid.held_out()))
    assert sorted(dictionaries) == ["de", "en", "es", "fr"]
    found = langid.identify(docs, dictionaries, ["doc_id", "lang"]).filter(langid.held_out())
    right, n = found.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 30 and right / n > 0.93
    assert found.filter("score < 0 or score > 1").count() == 0


def test_the_sample_does_not_depend_on_row_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert langid.learn(docs) == langid.learn(docs.repartition(7, "doc_id").orderBy(F.desc("doc_id")))


def test_hard_rows(spark):
    found = langid.identify(hard(spark), langid.learn(hard(spark))).collect()
    assert len(found) == len(HARD)
    for (_, text, *_), r in zip(HARD, found):
        letters = text is not None and any(c.isalpha() for c in text)
        assert (r.lang_pred == "und") == (not letters)
        assert r.rejected if not letters else r.lang_pred in ("de", "en")
        assert 0 <= r.score <= 1
    kept = langid.accepted(hard(spark), langid.learn(hard(spark)))
    assert kept.columns == hard(spark).columns


def test_few_languages(spark):
    assert langid.identify(empty(spark), {}).collect() == []
    assert langid.learn(empty(spark)) == {}
    assert {r.lang_pred for r in langid.identify(hard(spark), {}).collect()} == {"und"}
    one = langid.identify(hard(spark), {"xx": b"some words"}).collect()
    assert {r.lang_pred for r in one} == {"und", "xx"}


def test_equal_dictionaries_tie_and_are_rejected():
    use = langid.Classifier({"b": b"the same words here", "a": b"the same words here"})
    assert use.predict("some text with words") == ("a", 0.0, True)


def test_numbers_in_front_leave_nothing_out(spark):
    texts = [("es", "1 " * 600 + "el perro grande corre por la calle " * 9), ("en", "the big dog runs down the street " * 9)]
    docs = spark.createDataFrame(texts * 3, "lang string, text string")
    learned = langid.learn(docs)
    assert sorted(learned) == ["en", "es"] and b"perro grande" in learned["es"]
    found = langid.identify(spark.createDataFrame([(1, "una calle grande para el perro")], "doc_id long, text string"), learned)
    assert found.first().lang_pred == "es"


def test_the_number_of_languages_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    docs = spark.createDataFrame([(c, f"words of {c} {n}") for c, many in (("a", 3), ("b", 1), ("c", 3)) for n in range(many)], "lang string, text string")
    assert sorted(langid.learn(docs)) == ["a", "c"]


def test_equals_a_plain_loop(spark, sf_dir):
    """Sample, sizes, choice and margin, written out over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    h = F.xxhash64(F.lit(11), "text").alias("h")
    rows = docs.select("doc_id", "text", "lang", h, langid.held_out().alias("held")).collect()
    shares = {}
    for r in rows:
        if not r.held and r.lang is not None and any(regex.match(r"\p{L}", c) for c in r.text or ""):
            at = (r.lang, r.h % langid.SAMPLES)
            shares[at] = min(shares.get(at, (r.h, r.text)), (r.h, r.text))
    content = {}
    for (lang, _), (h, text) in sorted(shares.items()):
        spaced = regex.sub(r"[^\p{L}\p{M}]+", " ", text).strip(" ")
        start = h % (max(len(spaced) - langid.SAMPLE_CHARS, 0) + 1)
        content.setdefault(lang, []).append(spaced[start : start + langid.SAMPLE_CHARS])
    dictionaries = {lang: langid.letters(" ".join(texts)) for lang, texts in content.items()}
    assert langid.learn(docs.filter(~langid.held_out())) == dictionaries
    found = {r.doc_id: r for r in langid.identify(docs, dictionaries).collect()}
    settings = zstandard.ZstdCompressionParameters.from_level(3, min_match=3, write_checksum=False, write_content_size=False)
    for r in rows:
        if r.text is None or not regex.search(r"\p{L}", r.text):
            assert found[r.doc_id].lang_pred == "und"
            continue
        data = langid.letters(r.text)
        sizes = {}
        for lang, learned in dictionaries.items():
            raw = zstandard.ZstdCompressionDict(learned, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(compression_params=settings)
            packer = zstandard.ZstdCompressor(dict_data=raw, compression_params=settings)
            pieces = [learned[-96:-32] + b" " + data] if len(data) < 200 else [data[i : i + 1024] for i in range(0, len(data), 1024)]
            sizes[lang] = sum(len(packer.compress(p)) for p in pieces)
        best, second = sorted(sizes, key=lambda k: (sizes[k], k))[:2]
        score = 1 - sizes[best] / sizes[second]
        got = found[r.doc_id]
        assert (got.lang_pred, got.rejected) == (best, score < langid.MARGIN) and abs(got.score - score) < 1e-12
