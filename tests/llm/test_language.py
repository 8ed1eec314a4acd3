import random

import xxhash
from pyspark.sql import functions as F

from tablewright.llm import language
from tablewright.llm.frames import held_out

from .helpers import docs_of

PARTS = {"en": ["the", "ing", "tion", "and", "wh"], "de": ["sch", "ung", "keit", "ver", "ßer"], "es": ["ción", "ado", "lla", "ñas", "que"]}


def text_of(lang, rng, words=60):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def corpus(n=240):
    rng = random.Random(3)
    return [(i, text_of(lang := rng.choice(list(PARTS)), rng), lang) for i in range(n)]


def learned(docs):
    return language.learn_dictionaries(docs, F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))


def judged(docs, dictionaries):
    found = docs.select("doc_id", "lang", "text", language.language_of(F.col("text"), dictionaries).alias("found"))
    return found.select("*", "found.*", held_out(F.col("doc_id")).alias("out"), language.accepted(F.col("found")).alias("ok")).drop("found")


def test_held_out_accuracy(spark):
    docs = docs_of(spark, corpus())
    found = docs.select("doc_id", F.col("lang").alias("true_lang"), "text").join(
        judged(docs, learned(docs)).select("doc_id", F.col("score"), "out", "ok"), "doc_id"
    )
    assert found.count() == 240
    rows = [r for r in docs.select("doc_id", F.col("lang").alias("truth"), language.language_of(F.col("text"), learned(docs)).alias("f"), held_out(F.col("doc_id")).alias("out")).collect() if r.out]
    assert len(rows) > 50 and all(r.f.lang == r.truth and 0 <= r.f.score <= 1 for r in rows)


def test_awkward_texts(spark):
    docs = docs_of(spark, corpus())
    rng = random.Random(4)
    long_one = text_of("de", rng, 60_000)
    rows = [(1, None), (2, ""), (3, "1234 -- !!"), (4, "²³ 五", "zh"), (5, long_one, "en"), (5, long_one, "en"), (None, text_of("es", rng)), (6, text_of("en", rng).upper())]
    found = {(r.doc_id, r.text): r for r in judged(docs_of(spark, rows), learned(docs)).select("doc_id", "text", F.col("score"), "ok", F.col("margin"), F.col("out")).collect()}
    assert len(found) == 7
    for doc, text in ((1, None), (2, ""), (3, "1234 -- !!")):
        assert found[doc, text].score == 0 and not found[doc, text].ok
    again = docs_of(spark, rows).select("doc_id", language.language_of(F.col("text"), learned(docs)).alias("f")).collect()
    by_id = {r.doc_id: r.f.lang for r in again}
    assert (by_id[1], by_id[3], by_id[5], by_id[None], by_id[6]) == ("und", "und", "de", "es", "en")


def test_nothing_is_learned_from_held_out_ids_or_null_languages(spark):
    held = {i for i in range(2000) if __import__("zlib").crc32(str(i).encode()) % 3 == 1}
    rows = [(i, "verboten " * 30, "xx") for i in sorted(held)[:50]] + [(2001, "ohne Sprache " * 30, None), (2002, None, "yy")]
    assert learned(docs_of(spark, rows)) == {}
    assert learned(docs_of(spark, [])) == {}
    found = docs_of(spark, [(1, "some text")]).select(language.language_of(F.col("text"), {}).alias("f")).first().f
    assert (found.lang, found.score) == ("und", 0.0)


def test_one_very_common_text_takes_one_place_in_the_sample(spark):
    rows = [(i, "the same text again and again", "en") for i in range(0, 300)] + [(1000 + i, t, "en") for i, t, _ in corpus(40)]
    found = learned(docs_of(spark, rows))["en"]
    assert found.count(b"the same text again and again") == 1


def test_copies_and_null_texts_do_not_thin_the_sample(spark):
    rows = [(i, f"wort{chr(97 + i % 10)}{chr(97 + i // 10 % 10)}", "de") for i in range(5_000)] + [(5_000 + i, None, "de") for i in range(5_000)]
    found = language.learn_dictionaries(docs_of(spark, rows), F.lit(True))["de"]
    assert set(found.split()) == {t.encode() for _, t, _ in rows if t}


def test_the_sample_is_the_smallest_hashes_of_all_texts(spark):
    texts = [f"wort{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(3_000)]
    docs = docs_of(spark, [(i, t, "de") for i, t in enumerate(texts * 2)])
    found = language.learn_dictionaries(docs, F.lit(True), sample_docs=20)["de"]
    assert found.decode().split() == sorted(texts, key=lambda t: xxhash.xxh64(t.encode(), seed=42).intdigest() ^ (1 << 63))[:20]


def test_one_language_has_the_whole_margin(spark):
    found = docs_of(spark, [(1, "and so on")]).select(language.language_of(F.col("text"), {"en": b"and so on it goes"}).alias("f"))
    assert tuple(found.first().f) == ("en", 1.0, 1.0)
