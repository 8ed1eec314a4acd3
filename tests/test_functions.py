import pytest
from pyspark.sql import functions as F

from tablewright.functions import company, dates, geo, html, text, urls
from tablewright.operators import joins


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    "fn, value, expected",
    [
        (text.normalise, "  UAB „Ąžuolas-Žalia“  nr.1 ", "uab ąžuolas žalia nr 1"),
        (text.title_case, "d'arc o-brien JONAITIENĖ", "D'Arc O-Brien Jonaitienė"),
        (text.clean_space, "a­b   c", "ab c"),
        (text.case_split, "Vytautas Jonas LANDSBERGIS - ŽEM", ["Vytautas Jonas", "LANDSBERGIS", "-", "ŽEM"]),
        (text.case_split, "", []),
        (lambda c: text.rsplit_once(c, ",", 0), "a, b, c", "a, b"),
        (lambda c: text.rsplit_once(c, ",", 1), "a, b, c", " c"),
        (lambda c: text.rsplit_once(c, ",", 1), "abc", None),
        (lambda c: text.split_part_safe(c, " – ", 1), "2012 – 2016", "2016"),
        (lambda c: text.split_part_safe(c, " – ", 2), "2012 – 2016", None),
        (lambda c: text.first_group(c, r"(\d{4})"), "none", None),
        (lambda c: text.tagged_title(c)[0], "lt:Vilnius: miestas", "lt"),
        (lambda c: text.tagged_title(c)[1], "lt:Vilnius: miestas", "Vilnius: miestas"),
        (lambda c: text.tagged_title(c)[0], "Vilnius", None),
        (lambda c: text.recode(c, {"fName": "f"}), "fName", "f"),
        (lambda c: text.recode(c, {"fName": "f"}), "other", "other"),
        (text.strip_tone_accents, "Jõnas Ą́žuolas ė̃", "Jonas Ąžuolas ė"),
        (text.emphasis_head, "PIRMININKĖ (R. BAŠKIENĖ", "PIRMININKĖ"),
        (text.emphasis_head, "PIRMININKAS.", "PIRMININKAS."),
        (text.emphasis_head, "PIRMININKAS (V. PAVARDENIS, FRAK).", "PIRMININKAS"),
        (text.emphasis_head, " A. B. C. ŽEMAITIS-KALNAS. Taip", "A. B. C. ŽEMAITIS-KALNAS."),
        (text.emphasis_head, "Svarstome", None),
        (text.clock, "14.05 val.", "14:05"),
        (text.clock, "apie", None),
        (text.bracket_items, "x\n (V. Pavardenis , LSDPF) . Ačiū", ["V. Pavardenis", "LSDPF"]),
        (text.bracket_items, "sako (a, b).", None),
        (text.bracket_rest, " (LSDPF). Ačiū, kolegos.\n", "Ačiū, kolegos."),
        (text.bracket_rest, "Ačiū.", "Ačiū."),
        (text.is_acronym, "TS-LKDF", True),
        (text.is_acronym, "T. LKDF", False),
        (text.is_acronym, "Lietuva", False),
        (dates.long_date_to_iso, "1945 balandžio 10 d.", "1945-04-10"),
        (dates.long_date_to_iso, "1945 m. Balandžio 1 d.", "1945-04-01"),
        (dates.long_date_to_iso, "1945 m. gruodžio mėn 31 d.", "1945-12-31"),
        (dates.long_date_to_iso, "1945 04 10", "1945-04-10"),
        (dates.long_date_to_iso, "1945-04-10", "1945-04-10"),
        (dates.long_date_to_iso, "1945", "1945"),
        (dates.repair_digits, "l95l m. kovo lO d.", "1951 m. kovo 10 d."),
        (dates.repair_digits, "1935m. kovo 3O d.", "1935 m. kovo 30 d."),
        (dates.repair_digits, "Oslo 15d.", "Oslo 15 d."),
        (dates.forecast_time, "2017-01-05-13-00", "2017-01-05T13-00"),
        (dates.forecast_time, "n/a", None),
        (dates.title_place, "Alsėdžių RKB 1820 m.", "Alsėdžių"),
        (urls.redirect_target, "0;URL=https://example.org/index.php", "https://example.org/index.php"),
        (urls.redirect_target, "5", None),
        (lambda c: urls.query_int(c, "p_asm_id"), "http://a.lt/x?p_asm_id=-12&k=1", -12),
        (lambda c: urls.query_int(c, "k"), "http://a.lt/x?p_asm_id=1", None),
        (urls.path, "http://a.lt/x/y?z=1", "/x/y"),
        (lambda c: urls.header_param(c, "filename"), 'attachment; filename="a b.tar.gz"; size=3', "a b.tar.gz"),
        (lambda c: urls.header_param(c, "filename"), "attachment", None),
        (urls.header_value, "text/html; charset=utf-8", "text/html"),
        (urls.extension, "dir.d/file.tar.gz", ".gz"),
        (company.clean_company, 'Uždaroji akcinė bendrovė "Dnb lizingas", Vilniaus skyrius', "DNB BANKAS"),
        (company.clean_company, "LR Ind. įmonė „Ąžuolas“ f-kas", "IND ĮMONĖ ĄŽUOLAS FABRIKAS"),
        (company.clean_company, "Viešoji įstaiga X", "NEVIEŠINAMA"),
        (company.clean_company, None, None),
        (company.lt_to_eur, "345.28", pytest.approx(100.0)),
        (company.lt_to_eur, " ", None),
        (html.decode_entities, "&lt;b&gt; &amp;amp; &#261; &#x17D; &unknown; a & b", "<b> &amp; ą Ž &unknown; a & b"),
        (joins.speaker_key, " A. B.  Žemaitis.", "A B ŽEMAITIS"),
        (joins.speaker_surname, "A.B.Žemaitis-Kalnas.", "ŽEMAITIS-KALNAS"),
        (joins.speaker_surname, " . ", None),
        (joins.code_key, "123.0", "123"),
        (joins.code_key, "x", None),
    ],
)
def test_scalar(spark, fn, value, expected):
    assert one(spark, value, fn) == expected


def test_year_ranges(spark):
    ranges = one(spark, "X RKB 1820-1825 m., 1830 m., 1831--1833 m. ir 1840–1841 m.", dates.title_year_ranges)
    assert [(r.lo, r.hi) for r in ranges] == [(1820, 1825), (1830, 1830), (1831, 1833), (1840, 1841)]


def test_packed_items(spark):
    items = one(spark, "1###<b>Gedimino</b> pr.| |2###Pilies", text.packed_items)
    assert [(i.id, i.name) for i in items] == [("1", "Gedimino pr."), ("2", "Pilies")]


def test_acronym_leaves_list(spark):
    row = spark.createDataFrame([(["a b", "TSF", "LSF"],)], "v array<string>")
    out = row.select(text.first_acronym(F.col("v")), text.without_first_acronym(F.col("v"))).first()
    assert out[0] == "TSF" and out[1] == ["a b", "LSF"]


def test_name_variants(spark):
    row = spark.createDataFrame([("Jonas Petras Kazys", "Žalia")], "f string, s string")
    variants = row.select(joins.name_variants(F.col("f"), F.col("s"))).first()[0]
    assert variants == ["J P K ŽALIA", "J ŽALIA", "J P ŽALIA", "K P J ŽALIA", "ŽALIA"]


def test_mayor_flag(spark):
    rows = spark.createDataFrame([("Jonaitis Jonas (MERAS)", 2015), ("Jonaitis Jonas", 2015), ("J (MERĖ)", 2011)], "n string, t int")
    flag, name = joins.mayor_flag(F.col("n"), F.col("t"))
    assert [tuple(r) for r in rows.select(flag, name).collect()] == [
        (True, "Jonaitis Jonas"), (False, "Jonaitis Jonas"), (None, "J (MERĖ)")]


def test_inside_with_hole_and_edge(spark):
    ring = lambda pts: F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in pts])
    outer, hole = ring([(0, 0), (10, 0), (10, 10), (0, 10)]), ring([(4, 4), (6, 4), (6, 6), (4, 6)])
    edges = F.concat(geo.ring_edges(outer), geo.ring_edges(hole))
    points = spark.createDataFrame([(1.0, 1.0), (5.0, 5.0), (0.0, 5.0), (10.0, 10.0), (11.0, 5.0)], "x double, y double")
    assert [r[0] for r in points.select(geo.inside(edges, F.col("x"), F.col("y"))).collect()] == [True, False, False, False, False]


# The normal and abnormal examples of RFC 3986, section 5.4, against its base.
RFC_BASE = "http://a/b/c/d;p?q"
RFC_TARGETS = {
    "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g",
    "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d;p?q#s", "g#s": "http://a/b/c/g#s",
    "g?y#s": "http://a/b/c/g?y#s", ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x", "": "http://a/b/c/d;p?q",
    ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g",
    "../..": "http://a/", "../../": "http://a/", "../../g": "http://a/g", "../../../g": "http://a/g", "/./g": "http://a/g",
    "/../g": "http://a/g", "g.": "http://a/b/c/g.", ".g": "http://a/b/c/.g", "..g": "http://a/b/c/..g", "./../g": "http://a/b/g",
    "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h", "g?y/../x": "http://a/b/c/g?y/../x",
}


def test_targets_merge_as_the_rfc_says(spark):
    rows = spark.createDataFrame([(k,) for k in RFC_TARGETS], "h string")
    got = rows.select("h", urls.absolute(F.lit(RFC_BASE), F.col("h")).alias("t")).collect()
    assert {r.h: r.t for r in got} == RFC_TARGETS
    bare = rows.limit(1).select(urls.absolute(F.lit("http://a"), F.lit("x")).alias("t"), urls.absolute(F.lit("http://a#f"), F.lit("")).alias("e"))
    assert tuple(bare.first()) == ("http://a/x", "http://a")


def test_references_as_the_standard_library_reads_them(spark):
    import random
    from html import unescape
    from html.entities import html5

    rng = random.Random(9)
    names = sorted(html5)
    texts = [f"&{name}" for name in names]
    texts += [f"x&{name.rstrip(';')} y&{rng.choice(names)}z" for name in rng.sample(names, 300)]
    texts += [f"&#{n};&#x{n:X};&#{n} " for n in [*range(0, 260), 0xD800, 0xDFFF, 0xFDD0, 0xFFFE, 0x1FFFF, 0x10FFFF, 0x110000, 10**12, 10**30]]
    texts += ["&#38;lt;", "&copy 2020", "&scaron;&eacute;", "&", "&&amp;", "&;", "&#;", "&#x;", "a&b", "&notit;", "&AMP", "no reference", "&#0000000065;"]
    rows = spark.createDataFrame([(t,) for t in texts], "c string")
    got = rows.select("c", html.decode_entities(F.col("c")).alias("d")).collect()
    assert {r.c: r.d for r in got} == {t: unescape(t) for t in texts}


def test_blanks_of_any_kind_part_words(spark):
    assert one(spark, "Jonas Petraitis X", text.words) == ["Jonas", "Petraitis", "X"]
    assert one(spark, "J. PETRAITIS.", joins.speaker_key) == "J PETRAITIS"
    assert one(spark, "J. Petraitis", joins.speaker_surname) == "PETRAITIS"
    assert one(spark, "(A. Pirma ,\nKLM).", text.bracket_items) == ["A. Pirma", "KLM"]
