import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewright.llm import divergence as D

from .helpers import docs_of, long_text

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return [m.translate({c: c + 32 for c in range(65, 91)}) for m in TERM.findall(text)]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_terms(text):
    text = text.encode("utf-8", "ignore").decode()
    assert [t.decode() for t in D.terms(text)] == plain_terms(text)


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 300), max_size=40), st.sets(st.integers(0, 300), max_size=200))
def test_gallop(small, large):
    small, large = np.array(sorted(small), np.int64), np.array(sorted(large), np.int64)
    assert D.gallop(small, large).tolist() == np.searchsorted(large, small).tolist()


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**14), st.integers(1, 9 * 10**14))
def test_share_is_exact(count, more):
    total = count + more
    want = 1 + (10**9 * (count + 5)) // (total + 5)
    assert int(D.share(np.array([count], np.int64), 5, np.int64(total + 5))[0]) == want


def brute(rows, least=30, top=50):
    rows = [[r[1] or "", r[2] or "", r[3] or ""] for r in rows]
    df, lang_n, group_n = Counter(), Counter(), defaultdict(Counter)
    for text, lang, source in rows:
        found = plain_terms(text)
        df.update({(lang, t) for t in found})
        lang_n.update((lang, t) for t in found)
        group_n[lang, source].update(found)
    kept = defaultdict(list)
    for (lang, t), n in df.items():
        if n >= least:
            kept[lang].append(t)
    share = lambda counts, terms: {t: 1 + 10**9 * (counts[t] + 5) // (sum(counts[x] for x in terms) + 5 * len(terms)) for t in terms}
    p = {g: share(n, kept[g[0]]) for g, n in group_n.items()}
    q = {lang: share({t: lang_n[lang, t] for t in terms}, terms) for lang, terms in kept.items()}
    out = set()
    for lang, source in group_n:
        mine = p[lang, source]
        found = {"pair": [], "term": []}
        for other in group_n:
            if other[0] == lang and other != (lang, source):
                found["pair"].append((sum(abs(mine[t] - p[other][t]) for t in mine), other[1]))
        for t in mine:
            if group_n[lang, source][t] and mine[t] > q[lang][t]:
                found["term"].append((mine[t] - q[lang][t], t))
        for part, items in found.items():
            items.sort(key=lambda v: (-v[0], v[1].encode()))
            for rank, (value, item) in enumerate(items if part == "pair" else items[:top], 1):
                out.add((lang, source, part, item, value, rank))
    return out


def got(frame):
    assert frame.columns == ["lang", "source", "part", "item", "value", "rank"]
    rows = [tuple(r) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("segment, tile", [(8_192, 8), (3, 1), (5, 2)])
def test_like_brute_force(spark, segment, tile):
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i)}{'É' * (i % 3)}" for i in range(26)] + ["Zwei", "drei", "五", "ñandú", "rare"]
    rows = []
    for i in range(160):
        lang = ["en", "de", None, ""][i % 4 if i % 9 else 0]
        text = " ".join(words[min(30, int(j))] for j in rng.zipf(1.3, rng.integers(0, 30))) + "\x00,1 İ"
        rows.append((i, text, lang, [f"s{i % 5}", None, "", "Å", "s"][i % 5]))
    rows += [(900, None, "en", "no text"), (901, "...", "xx", "a"), (902, None, "xx", "b"), (903, "own", "alone", "only"), (0, rows[0][1], "en", "s0")]
    rows += [(None, long_text(3000), "en", "s0")] * 2
    have = got(D.audit_sources(docs_of(spark, rows), least_docs=12, top=4, segment=segment, tile=tile))
    want = brute(rows, 12, 4)
    assert have == want
    assert {r[4] for r in have if r[0] == "xx"} == {0}


def test_ties_are_by_item(spark):
    rows = [(i, "beta alpha" if i % 2 else "gamma", "en", f"s{i % 2}") for i in range(80)]
    have = got(D.audit_sources(docs_of(spark, rows)))
    assert have == brute(rows)
    assert {(r[3], r[5]) for r in have if r[1] == "s1" and r[2] == "term"} == {("alpha", 1), ("beta", 2)}


def test_many_flushes_of_a_task_add_up(spark):
    rows = [(i, f"common word{i % 7}", "en", f"s{i % 3}") for i in range(300)]
    docs = docs_of(spark, rows)
    named = [docs[c] for c in ("lang", "source", "text")]
    few = D.counted_terms(docs, *named, most=9).groupBy("lang", "source", "term").sum("n", "docs")
    assert {(r.source, r.term): r["sum(docs)"] for r in few.collect() if r.term == "common"} == {(f"s{i}", "common"): 100 for i in range(3)}


def test_empty_table(spark):
    assert got(D.audit_sources(docs_of(spark, []))) == set()
