"""Byte-level BPE with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A place before a blank or line feed, after something that is no kind of white space. No match
#: of a pattern whose pieces hold white space only at their start reaches over such a place.
SAFE = regex.compile(r"(?<=[^\s\x1c-\x1f\x85])(?=[ \n])")


@functools.lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, read once per Python worker; no special tokens."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def segments(text: str, long_text: int) -> Iterator[str]:
    """The text in pieces of about ``long_text`` characters, cut at safe boundaries.

    A run without a safe boundary stays whole, however long it is.
    """
    start = 0
    while len(text) - start > long_text:
        cut = SAFE.search(text, start + long_text)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(text: Column, path: str, pattern: str, *, long_text: int = 65_536) -> Column:
    """The token ids of each text as array<int>; null and empty texts have none.

    The ids are those of the tiktoken library for the whole text. Texts above ``long_text``
    characters are encoded piece by piece between safe boundaries, which leaves the ids as they
    are and bounds the memory of a call.
    """

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = encoding(path, pattern)
        for batch in batches:
            parts, ends = [], [0]
            for value in batch:
                size = 0
                for piece in segments(value.as_py() or "", long_text):
                    ids = coder.encode_ordinary(piece)
                    parts.append(np.fromiter(ids, np.int32, len(ids)))
                    size += len(ids)
                ends.append(ends[-1] + size)
            values = np.concatenate(parts) if parts else np.empty(0, np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))

    return ids_of(text)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """The raw bytes the ids stand for; a null list of ids gives no bytes.

    Bytes, not text: a list of ids may end inside a character.
    """

    @F.arrow_udf("binary")
    def bytes_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = encoding(path, pattern)
        for batch in batches:
            yield pa.array([coder.decode_bytes(value.as_py() or []) for value in batch], pa.binary())

    return bytes_of(ids)
