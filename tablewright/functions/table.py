"""Table functions: many rows out of the ordered rows of one group."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


@F.udtf(returnType="key string, pos int, start long, stop long, marker string")
class SegmentSpans:
    """Where the segments of a text lie that comes in pieces ``key, ord, marker, text``.

    The pieces of a key, in order, make up its text, joined by one line feed. A piece with a
    ``marker`` opens a segment, which goes up to the next one or the end: ``start`` and ``stop``
    are its offsets in characters, ``pos`` its number from 0. What comes before the first marker
    belongs to none. The function holds one open segment, never the group.
    """

    def __init__(self):
        self.key, self.at, self.pos, self.open = None, 0, 0, None

    def eval(self, row: Row) -> Iterator[tuple]:
        if row["marker"] is not None:
            yield from self._closed(self.at - 1)
            self.open = (self.at, row["marker"])
        self.key = row["key"]
        self.at += len(row["text"] or "") + 1

    def terminate(self) -> Iterator[tuple]:
        yield from self._closed(self.at - 1)

    def _closed(self, stop: int) -> Iterator[tuple]:
        if self.open is not None:
            start, marker = self.open
            yield self.key, self.pos, start, stop, marker
            self.pos += 1


def register(spark: SparkSession) -> None:
    """Make the table functions known to SQL: ``segment_spans(TABLE(t) PARTITION BY key ORDER BY ord)``."""
    spark.udtf.register("segment_spans", SegmentSpans)


def segment_spans(pieces: DataFrame) -> DataFrame:
    """``SegmentSpans`` over a table ``key, ord, marker, text``."""
    return SegmentSpans(pieces.asTable().partitionBy("key").orderBy("ord"))
