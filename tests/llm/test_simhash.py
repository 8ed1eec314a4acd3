import random

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.llm import simhash as H
from tablewright.llm.components import stars

from .helpers import docs_of, long_text

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_print(text, words=3):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    parts = [w for w in text.translate(UPPER).split(" ") if w]
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, distance=2):
    root = {p: p for p in prints}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    some = sorted(prints)
    for i, a in enumerate(some):
        for b in some[i + 1 :]:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= distance:
                root[max(top(a), top(b))] = min(top(a), top(b))
    return {p: top(p) for p in some}


@settings(max_examples=120, deadline=None)
@given(st.text(st.sampled_from("aB \tÉé \u0085.\n\x1c"), max_size=60), st.sampled_from([1, 3, 5]))
def test_fingerprints_like_the_definition(text, words):
    assert H.fingerprint(text, words) & (1 << 64) - 1 == plain_print(text, words)


def test_documents_like_brute_force(spark):
    rng = random.Random(2)
    base = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randint(0, 40)) for _ in range(rng.randint(1, 250))) for _ in range(25)]
    rows = [(i + 10, t) for i, t in enumerate(base)]
    for i, t in enumerate(base):
        words = t.split(" ")
        for k in range(3):
            changed = list(words)
            changed[rng.randrange(len(words))] = f"new{k}"
            rows.append((100 + 10 * i + k, " ".join(changed)))
    rows += [(1, None), (2, ""), (3, " \n"), (500, base[0].upper()), (500, base[0]), (None, base[1]), (600, long_text()), (7, long_text())]
    found = H.near_duplicates(docs_of(spark, rows)).collect()
    assert len(found) == len(rows)
    prints = {(d, plain_print(t or "")) for d, t in rows}
    groups = plain_groups({p for _, p in prints})
    least = {}
    for d, p in prints:
        if d is not None:
            least[groups[p]] = min(d, least.get(groups[p], d))
    assert {(r.doc, r.print & (1 << 64) - 1, r.component_id) for r in found} == {(d, p, least.get(groups[p])) for d, p in prints}


def test_spark_s_own_hash_agrees(spark):
    text = "Größe und Maß"
    native = spark.range(1).select(F.xxhash64(F.lit(text.lower()))).first()[0]
    assert native & (1 << 64) - 1 == xxhash.xxh64(text.lower().encode(), seed=42).intdigest()


def test_empty_table(spark):
    assert H.near_duplicates(docs_of(spark, [])).collect() == []


def links(spark, prints, **more):
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    out = H.link_fingerprints(spark.createDataFrame(signed, "print long"), **more)
    return {tuple(sorted((r.a & (1 << 64) - 1, r.b & (1 << 64) - 1))) for r in out.collect()}


def test_short_lists_give_every_close_pair_and_no_other(spark):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(40)} | {0, 1, 3, 7, (1 << 64) - 1, 1 << 63}
    for p in list(prints)[:20]:
        prints |= {p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(4)}
    close = {(a, b) for a in prints for b in prints if a < b and bin(a ^ b).count("1") <= 2}
    assert links(spark, prints) == close


def test_long_lists_lose_no_link(spark):
    """Many prints in one block list: the exact way for lists above the bound gives the same groups."""
    rng = random.Random(6)
    centre = rng.getrandbits(64)
    prints = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(250)}
    found = links(spark, prints, bucket=3)
    assert all(bin(a ^ b).count("1") <= 2 for a, b in found)
    joined = {p: p for p in prints}
    want = plain_groups(prints)
    for _ in range(len(prints)):
        before = dict(joined)
        for a, b in found:
            low = min(joined[a], joined[b])
            joined[a] = joined[b] = low
        if before == joined:
            break
    assert joined == want


def test_components_of_a_long_path_a_star_and_odd_links(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200 + i, 199) for i in range(1, 90)] + [(5, 5), (None, 3), (9, None), (1, 0), (1, 0)]
    found = {r.node: r.root for r in stars(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 61)} | {200 + i: 199 for i in range(1, 90)}
    assert stars(spark.createDataFrame([], "a long, b long")).collect() == []
