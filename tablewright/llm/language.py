"""Language ID by compression: the language whose dictionary compresses a text best."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .frames import col

UNKNOWN = "und"
NOT_LETTERS = regex.compile(r"\P{L}+")
#: Stands before every piece. It costs all languages the same few bytes, and keeps short pieces
#: from being stored as they are, which would cost all languages exactly the same.
PADDING = b" " * 64
RESULT = "struct<lang:string,score:double,margin:double>"


def words_only(text: str) -> bytes:
    """Lower-cased letters; all else between them is one blank."""
    return NOT_LETTERS.sub(" ", text).strip().lower().encode()


class Encoder:
    """Compressors with one raw-content dictionary per language.

    A text is encoded in pieces of ``piece`` bytes, each on its own, so that the dictionary and
    not the text before it explains the whole of a long text.
    """

    def __init__(self, dictionaries: dict[str, bytes], level: int, piece: int):
        self.piece = piece
        self.compressors = {}
        for lang, content in sorted(dictionaries.items()):
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=level)
            self.compressors[lang] = zstandard.ZstdCompressor(
                level=level, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False
            )

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin): the margin is the part of the second best size saved."""
        plain = words_only(text) if text else b""
        if not plain or not self.compressors:
            return UNKNOWN, 0.0, 0.0
        pieces = [plain[at : at + self.piece] for at in range(0, len(plain), self.piece)]
        sizes = sorted(
            (sum(len(c.compress(PADDING + p)) for p in pieces), lang) for lang, c in self.compressors.items()
        )
        margin = 1 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0
        return sizes[0][1], 0.5 + margin / 2, margin


def learn_dictionaries(
    docs: DataFrame,
    usable: Column,
    *,
    lang: str = "lang",
    text: str = "text",
    sample_docs: int = 400,
    sample_chars: int = 1000,
    dictionary_bytes: int = 131_072,
) -> dict[str, bytes]:
    """One dictionary per language from a bounded sample of the ``usable`` rows.

    Of each language, at most ``sample_docs`` different texts are taken, those with the smallest
    hash, ``sample_chars`` characters of each, and cut to ``dictionary_bytes`` together. Different
    texts, as a language may hold one text very often. A first pass counts the different texts
    of each language, to about two per cent; the second only looks at hashes so small that a few
    times ``sample_docs`` texts are below them. Rows of null texts count for nothing. What is
    collected is bounded by the number of languages.
    """
    labelled = docs.where(usable & col(lang).isNotNull() & col(text).isNotNull()).select(
        col(lang).cast("string").alias("lang"), F.xxhash64(col(text)).alias("hash"), col(text).alias("text")
    )
    most = []
    for row in labelled.groupBy("lang").agg(F.approx_count_distinct("hash", 0.02).alias("n")).collect():
        share = min(1.0, 4 * sample_docs / row.n)
        most += [F.lit(row.lang), F.lit(min(int(share * 2**64) - 2**63, 2**63 - 1))]
    if not most:
        return {}
    first = Window.partitionBy("lang").orderBy("hash")
    chosen = (
        labelled.where(F.col("hash") <= F.create_map(*most)[F.col("lang")])
        .groupBy("lang", "hash")
        .agg(F.first(F.substring("text", 1, sample_chars)).alias("piece"))
        .withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= sample_docs)
        .select("lang", "rank", "piece")
    )
    pieces: dict[str, list[bytes]] = {}
    for row in chosen.orderBy("lang", "rank").collect():
        pieces.setdefault(row.lang, []).append(words_only(row.piece))
    joined = {k: b" ".join(x for x in v if x)[:dictionary_bytes] for k, v in pieces.items()}
    return {k: v for k, v in joined.items() if len(v) >= 8}


def language_of(text: Column, dictionaries: dict[str, bytes], *, level: int = 5, piece: int = 1024) -> Column:
    """Struct (``lang``, ``score``, ``margin``) for a text.

    ``margin`` is the share by which the best size is below the second best, zero to one; the
    score is one half plus half the margin. A text that is null or has no letter is ``und``
    with score and margin zero. With one learned language the margin is one. Equal sizes go to
    the first language by name, with margin zero. The whole text is encoded, in pieces, so
    memory is bounded by the batch.
    """
    cache: list[Encoder] = []

    @F.arrow_udf(RESULT)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if not cache:
            cache.append(Encoder(dictionaries, level, piece))
        for batch in batches:
            found = [cache[0].judge(value.as_py()) for value in batch]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                    pa.array([x[2] for x in found], pa.float64()),
                ],
                ["lang", "score", "margin"],
            )

    return judge(text)


def accepted(result: Column, min_margin: float = 0.001) -> Column:
    """False for what the operator rejects: no letters, or a margin too narrow to tell."""
    return (result["lang"] != UNKNOWN) & (result["margin"] >= min_margin)
