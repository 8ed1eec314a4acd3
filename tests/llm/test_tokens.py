import hashlib

import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.llm import tokens

from .helpers import docs_of, long_text

PATH = P.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [None, "", " ", "\n\n \t", "It's  a   test\r\n\u0085x y", "naïve ñandú 五十 😀", "<|endoftext|>", "a" * 30_000, " " * 5_000, long_text(), "1" * 999 + "é" * 999]


def test_ids_and_bytes_are_the_library_s(spark):
    plain = tokens.encoding(PATH, P.PATTERN)
    docs = docs_of(spark, [(i, t) for i, t in enumerate(TEXTS)] + [(1, ""), (None, "x y")])
    coded = docs.select("doc_id", "text", tokens.encode(F.col("text"), PATH, P.PATTERN, long_text=500).alias("ids"))
    rows = coded.withColumn("back", tokens.decode(F.col("ids"), PATH, P.PATTERN)).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        assert r.ids == plain.encode_ordinary(r.text or "")
        assert bytes(r.back) == (r.text or "").encode()


def test_empty_table_and_null_ids(spark):
    assert docs_of(spark, []).select(tokens.encode(F.col("text"), PATH, P.PATTERN).alias("ids")).collect() == []
    null = spark.createDataFrame([(None,)], "ids array<int>").select(tokens.decode(F.col("ids"), PATH, P.PATTERN).alias("b"))
    assert bytes(null.first().b) == b""


def test_ids_may_end_inside_a_character(spark):
    ids = tokens.encoding(PATH, P.PATTERN).encode_ordinary("😀")
    cut = spark.createDataFrame([(ids[:1],)], "ids array<int>").select(tokens.decode(F.col("ids"), PATH, P.PATTERN).alias("b"))
    assert "😀".encode().startswith(bytes(cut.first().b))


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab 1\n\t\r.'sé\u0085  \x1c五"), max_size=60), st.integers(1, 9))
def test_cuts_leave_the_ids_as_they_are(text, long):
    plain = tokens.encoding(PATH, P.PATTERN)
    pieces = list(tokens.segments(text, long))
    assert "".join(pieces) == text
    assert [i for p in pieces for i in plain.encode_ordinary(p)] == plain.encode_ordinary(text)


def test_a_run_without_a_safe_place_stays_whole():
    assert list(tokens.segments("x" * 5_000, 100)) == ["x" * 5_000]
    assert hashlib.sha256(b"").hexdigest()[:4] == "e3b0"
