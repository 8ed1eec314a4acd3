import re

import pytest
from math import comb

from pyspark.sql import functions as F

from tablewright.operators import resolve as R

CHOICES = "dictionary string, id int, name string, pos int"
ALIASES = "dictionary string, target string, alias string, pos int"
INFLECT = "form string, lemma string, `case` string, inflected string"


def tables(spark, index):
    choices, aliases = [], []
    for name, (names, targets) in index.items():
        choices += [(name, i, n, p) for p, (i, n) in enumerate(names)]
        for target, forms in targets:
            aliases += [(name, target, alias, len(aliases) + p) for p, alias in enumerate(forms)]
    return spark.createDataFrame(choices, CHOICES), spark.createDataFrame(aliases, ALIASES)


def find(spark, index, asked, inflections=None):
    choices, aliases = tables(spark, index)
    mentions = spark.createDataFrame(asked, "dictionary string, mention string")
    inflect = spark.createDataFrame(inflections, INFLECT) if inflections else None
    hits = R.resolve_entities(mentions, choices, aliases, inflect).collect()
    out = {pair: [] for pair in asked}
    for h in hits:
        out[(h.dictionary, h.mention)].append((h.id, h.value, h.hit_dictionary, h.source))
    return {pair: sorted(rows, key=str) for pair, rows in out.items()}


SHOP = {
    "bank": (
        [(1, "Danske"), (2, "DNB"), (3, "SEB"), (4, "Swedbank")],
        [("{bank}", ["{bank} bankas", "{bank} bank", "bankas {bank}", "{bank:lemma} lizingas"])],
    ),
    "company-type": (
        [(1, "UAB"), (2, "IĮ")],
        [("UAB", ["Uždaroji akcinė bendrovė"]), ("IĮ", ["Individuali įmonė"])],
    ),
    "company": (
        [(1, "Danske bankas"), (2, "DNB bankas"), (3, "SEB bankas"), (4, "Swedbank bankas"), (5, "Programuotojų artelė")],
        [
            ("{bank} bankas", ["{bank}"]),
            ("{company}", ["{company-type} {company}"]),
            ("Programuotojų artelė", ["Programmers of Vilnius"]),
        ],
    ),
}


def test_shop(spark):
    expected = {
        ("bank", "unknown"): [],
        ("bank", "dnb"): [(2, "DNB", "bank", "index")],
        ("bank", "danske bank"): [(1, "Danske", "bank", "pattern")],
        ("company", "dnb bankas"): [(2, "DNB bankas", "company", "index"), (2, "DNB bankas", "company", "pattern")],
        ("company", "dnb"): [(2, "DNB bankas", "company", "pattern")],
        ("company", "danske bank"): [(1, "Danske bankas", "company", "pattern")],
        ("company", "bankas swedbank"): [(4, "Swedbank bankas", "company", "pattern")],
        ("company", "dnb lizingas"): [(2, "DNB bankas", "company", "pattern")],
        ("company", "uždaroji akcinė bendrovė programmers of vilnius"): [
            (5, "Programuotojų artelė", "company", "pattern")
        ],
    }
    assert find(spark, SHOP, list(expected)) == expected


def test_alias_without_choice_and_positional(spark):
    index = {
        "a": ([], [("x", ["z"]), ("{a}", ["{a} y"])]),
        "p": ([], [("{0}", ["{b}"])]),
        "b": ([(1, "x")], []),
    }
    assert find(spark, index, [("a", "z"), ("a", "z y"), ("a", "x y"), ("p", "x")]) == {
        ("a", "z"): [(None, "x", "a", "alias")],
        ("a", "z y"): [(None, "x", "a", "pattern")],
        ("a", "x y"): [],
        ("p", "x"): [(None, "x", "p", "pattern")],
    }


def test_extends_chain_and_mutual_templates(spark):
    index = {
        "a": ([], [("(extends)", ["{b}"])]),
        "b": ([], [("(extends)", ["{c}"])]),
        "c": ([], [("(extends)", ["{d}"])]),
        "d": ([(1, "x")], []),
        "m": ([], [("{n}", ["{n}"])]),
        "n": ([], [("{m}", ["{m}"])]),
    }
    assert find(spark, index, [("a", "x"), ("m", "x")]) == {
        ("a", "x"): [(1, "x", "d", "extends")],
        ("m", "x"): [],
    }


def test_inflection_flags(spark):
    inflections = [
        ("vilniaus", "Vilnius", None, None),
        ("graužinienės", "Graužinienė", None, None),
        ("graužinienė", None, "genitive", "Graužinienės"),
        ("šiaulių banko", "šiaulių bankas", None, None),
    ]
    index = {
        "city": ([(1, "Vilnius")], [("{city}", ["{city:lemma}"])]),
        "surname": ([(1, "Graužinienė")], []),
        "enterprise": ([], [("{surname:genitive,title} IĮ", ["{surname:lemma} iį"])]),
        "finance": ([(1, "Šiaulių bankas")], [("{finance}", ["{finance:lemma} lizingas"])]),
    }
    asked = [
        ("city", "Vilniaus"),
        ("city", "Notacity"),
        ("enterprise", "Graužinienės IĮ"),
        ("finance", "ŠIAULIŲ BANKO LIZINGAS"),
    ]
    assert find(spark, index, asked, inflections) == {
        asked[0]: [(1, "Vilnius", "city", "pattern")],
        asked[1]: [],
        asked[2]: [(None, "Graužinienės IĮ", "enterprise", "pattern")],
        asked[3]: [(1, "Šiaulių bankas", "finance", "pattern")],
    }


def test_two_slots_repeat_and_literals_between(spark):
    index = {
        "gov": ([(1, "Taryba"), (2, "Ministerija"), (3, "Taryba prie Ministerija")], [("{0} prie {1}", ["{gov} prie {gov}"])]),
        "person": ([(7, "Jonas Basanavičius")], [("{first} {last}", ["{last}, {first}"])]),
        "first": ([(1, "Jonas")], []),
        "last": ([(1, "Basanavičius")], []),
    }
    assert find(spark, index, [("gov", "Taryba prie ministerija"), ("person", "Basanavičius, Jonas")]) == {
        ("gov", "Taryba prie ministerija"): [
            (3, "Taryba prie Ministerija", "gov", "index"),
            (3, "Taryba prie Ministerija", "gov", "pattern"),
        ],
        ("person", "Basanavičius, Jonas"): [(7, "Jonas Basanavičius", "person", "pattern")],
    }


def test_unresolved_and_unknown(spark):
    choices, aliases = tables(spark, {"a": ([(1, "x")], [("(extends)", ["{nowhere}"])])})
    mentions = spark.createDataFrame([("a", "x"), ("a", "q"), ("a", "q")], "dictionary string, mention string")
    hits = R.resolve_entities(mentions, choices, aliases)
    assert [r.mention for r in R.unresolved(mentions, hits).collect()] == ["q"]
    assert [r.unknown for r in R.unknown_names(aliases, choices).collect()] == ["nowhere"]


@pytest.mark.parametrize("k", [1, 2, 3, 9])
def test_split_counts(spark, k):
    rows = [(n, [str(i) for i in range(n)]) for n in range(1, 15)]
    splits = R.token_splits(spark.createDataFrame(rows, "n int, tokens array<string>"), "tokens", k)
    counts = {r.n: (r.c, r.d) for r in splits.groupBy("n").agg(
        F.count("split").alias("c"), F.count_distinct("split").alias("d")).collect()}
    assert counts == {n: (comb(n - 1, k - 1),) * 2 for n in range(k, 15)}
    for r in splits.where("n < 6").collect():
        assert " ".join(r.split) == " ".join(map(str, range(r.n)))


def test_many_templates_without_a_literal(spark):
    """10,000 templates of slots alone: a state meets only the edge of its own symbol."""
    names = [("left", i, f"l{i}", i) for i in range(100)] + [("right", i, f"r{i}", i) for i in range(100)]
    slots = [(f"a{i}", i, f"l{i}", 0) for i in range(100)] + [(f"b{i}", i, f"r{i}", 0) for i in range(100)]
    pairs = [("pair", f"{i} of {j}", f"{{a{i}}} {{b{j}}}", 100 * i + j) for i in range(100) for j in range(100)]
    choices = spark.createDataFrame(names + slots, CHOICES)
    aliases = spark.createDataFrame(pairs, ALIASES)
    asked = [("pair", f"L{i} r{(7 * i) % 100}") for i in range(100)] + [("pair", "r1 l1"), ("pair", "l1"), ("pair", "l1 r1 l1")]
    mentions = spark.createDataFrame(asked, "dictionary string, mention string")
    hits = R.resolve_entities(mentions, choices, aliases)
    assert {(h.mention, h.value, h.source) for h in hits.collect()} == {(f"L{i} r{(7 * i) % 100}", f"{i} of {(7 * i) % 100}", "pattern") for i in range(100)}
    text = hits._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_parts_combine_to_any_depth_and_ambiguity_is_kept(spark):
    index = {
        "word": ([(1, "a"), (2, "b"), (3, "b c")], []),
        "last": ([(4, "c"), (5, "c d")], []),
        "two": ([], [("{0}+{1}", ["{word} {last}", "{word} {two}"])]),
        "any": ([], [("(extends)", ["{two}"]), ("<{any}>", ["( {any} )", "in {any}"])]),
    }
    assert find(spark, index, [("any", "a b c"), ("two", "b c d"), ("any", "in in a c"), ("word", "!!!")]) == {
        ("any", "a b c"): [(None, "a+b+c", "two", "extends")],
        ("two", "b c d"): [(None, "b+c d", "two", "pattern")],
        ("any", "in in a c"): [(None, "<<a+c>>", "any", "pattern")],
        ("word", "!!!"): [],
    }


def plain_find(index, name, text, path=()):
    """Every template laid over every split, recursively, as the semantics are written down."""
    if (name, text) in path:
        return set()
    norm = lambda t: " ".join("".join(c if c.isalnum() or c == "_" else " " for c in t).lower().split())
    names = lambda d: {norm(n): (i, n) for i, n in index.get(d, ([], []))[0]}
    out = set()
    if text in names(name):
        out.add((*names(name)[text], name, "index"))
    for target, aliases in index.get(name, ([], []))[1]:
        for alias in aliases:
            if "{" not in alias:
                if norm(alias) == text:
                    known = names(name).get(norm(target), (None, target))
                    out.add((*known, name, "alias"))
                continue
            parts = [p for p in re.findall(r"\{[^}]+\}|[^{]+", alias) if p.startswith("{") or norm(p)]
            tokens = text.split()

            def lay(parts, at, parts_path=(*path, (name, text)), tokens=tokens):
                if not parts:
                    if at == len(tokens):
                        yield []
                    return
                for stop in range(at + 1, len(tokens) + 1):
                    piece = " ".join(tokens[at:stop])
                    if not parts[0].startswith("{"):
                        if piece == norm(parts[0]):
                            yield from lay(parts[1:], stop, parts_path, tokens)
                        continue
                    heads = plain_find(index, parts[0][1:-1], piece, parts_path)
                    if heads:
                        for rest in lay(parts[1:], stop, parts_path, tokens):
                            for h in heads:
                                yield [(parts[0][1:-1], h), *rest]

            for filled in lay(parts, 0):
                if target == "(extends)":
                    out.add((*filled[0][1][:3], "extends"))
                    continue
                values = {n: h[1] for n, h in filled} | {str(i): h[1] for i, (_, h) in enumerate(filled)}
                made = re.sub(r"\{([^}]+)\}", lambda m: values[m[1]], target)
                known = names(name).get(norm(made), (None, made))
                out.add((*known, name, "pattern"))
    return out


def test_like_the_recursive_search(spark):
    import random

    rng = random.Random(7)
    letters = "abc"
    for _ in range(3):
        index = {}
        for d in "pqrs":
            names = [(i, " ".join(rng.choice(letters) for _ in range(rng.randint(1, 2)))) for i in range(2)]
            rules = []
            for _ in range(3):
                slots = [rng.choice(["{p}", "{q}", "{r}", "{s}", "x"]) for _ in range(rng.randint(1, 3))]
                used = [s[1:-1] for s in slots if s != "x"]
                if used:
                    rules.append((rng.choice(["(extends)", "{0}", "y {0}", " ".join(f"{{{i}}}" for i in range(len(used)))]), [" ".join(slots)]))
            index[d] = (names, rules)
        asked = sorted({(rng.choice("pqrs"), " ".join(rng.choice("abcx") for _ in range(rng.randint(1, 4)))) for _ in range(40)})
        found = find(spark, index, asked)
        assert found == {(d, t): sorted(plain_find(index, d, t), key=str) for d, t in asked}
