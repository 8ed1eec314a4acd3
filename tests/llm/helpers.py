"""Small tables with the awkward cases every operator has to bear."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Columns whose names an operator might want for itself.
CLASHING = "row string, doc string, txt string, lines string, gone string, found string, print string, digest string, kept string, n_lines string, score string, words string, label string, vector string, host string"


def docs_of(spark, rows):
    """Documents from (doc_id, text) or whole rows, with clashing extra columns."""
    full = [tuple(r) + (None,) * (5 - len(r)) for r in rows]
    names = [c.split()[0] for c in CLASHING.split(", ")]
    return spark.createDataFrame([r + tuple("x" for _ in names) for r in full], f"{DOCS}, {CLASHING}")


def long_text(n=60_000):
    return " ".join(f"word{i % 977}" for i in range(n))
