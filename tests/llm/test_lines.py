import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablewright.llm.lines import dedup_lines

from .helpers import docs_of, long_text

BLANKS = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=20, min_docs=3):
    key = lambda line: line.strip(BLANKS).translate(UPPER)
    low = lambda d: (d is not None, d or 0)
    held = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                held.setdefault(key(line), set()).add(doc)
    keeper = {k: max(v, key=low) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (key(x) in keeper and keeper[key(x)] != doc)]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def ours(spark, rows):
    done = dedup_lines(docs_of(spark, rows)).select("doc", "n_lines", "n_dropped", "kept_text")
    return sorted(map(tuple, done.collect()), key=str)


def test_awkward_rows(spark):
    shared, other = "A line that Many documents Share", "Ünterschiedliche Zeile die ÄHNLICH ist"
    rows = [
        (1, f"{shared}\nown one\n{shared}  "),
        (2, f"\t{shared.upper()}\r\nown two\n\n"),
        (3, f"{shared}"),
        (3, f"{shared}\nthe same id again"),
        (4, f"{other}\n{shared}\nshort"),
        (5, other),
        (6, other.lower()),
        (7, "short"),
        (8, "short"),
        (9, "short"),
        (10, None),
        (11, ""),
        (11, ""),
        (None, f"{shared}\nwithout an id"),
        (None, f"{shared}\nwithout an id"),
        (12, long_text(5_000)),
        (13, "x" * 100_000),
    ]
    assert ours(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert ours(spark, []) == []


def test_the_row_is_carried_whole(spark):
    done = dedup_lines(docs_of(spark, [(1, "a\nb", "en", "src", 3)])).select("row.*").first()
    assert (done.doc_id, done.text, done.lang, done.kept, done.n_lines) == (1, "a\nb", "en", "x", "x")


def test_a_line_in_every_document(spark):
    line = "the same footer under everything"
    rows = [(i, f"text {i}\n{line}\nend {i}") for i in range(300)]
    done = ours(spark, rows)
    assert done == brute(rows)
    assert sum(r[2] for r in done) == 299


LINE = st.sampled_from(["a" * 20, "A" * 20, " " + "a" * 20, "b" * 19, "é" * 20, "É" * 20, "", "\x0bccccc ccccc ccccc ccccc\r"])


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 6), st.lists(LINE, max_size=5).map("\n".join)), max_size=14))
def test_like_brute_force(spark, rows):
    assert ours(spark, rows) == brute(rows)


def test_digest_of_an_emptied_text(spark):
    rows = [(i, "only a shared line, nothing else") for i in range(4)]
    texts = {r[0]: r[3] for r in ours(spark, rows)}
    assert texts[0] == "" and texts[3] != ""
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
