"""Entity resolution of mentions against dictionaries of names, aliases and templates.

``choices``  : dictionary, id, name, pos       (pos: order in the dictionary)
``aliases``  : dictionary, target, alias, pos  (alias may hold ``{dictionary:flags}`` slots)
``mentions`` : dictionary, mention
hits         : dictionary, mention, id, value, hit_dictionary, source

Matching works upwards, like chart parsing over all texts at once. Every run of tokens that is a
name, an alias or a template's literal is marked by one join on its text. Then, round by round,
marks that stand side by side are combined along a trie of the templates' parts, and what a
template makes of them is a mark like any other. A text that is already below on the way up is
not made again, so mutual templates end. Equal mentions are answered once.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalise, title_case, words
from ..session import write_once

EXTENDS = "(extends)"
NO_LIMIT = 1 << 30
_SEP, _EDGE = "\u0001", "\u0002"
_HIT = ["id", "value", "hit_dictionary", "source"]


# ---- dictionaries ---------------------------------------------------------------


def name_index(choices: DataFrame) -> DataFrame:
    """``dictionary, text, id, value`` by normalised name; the last of equal names stands."""
    return (
        choices.withColumn("text", normalise(F.col("name")))
        .groupBy("dictionary", "text")
        .agg(F.max_by(F.struct("id", F.col("name").alias("value")), "pos").alias("c"))
        .select("dictionary", "text", "c.id", "c.value")
    )


def alias_index(aliases: DataFrame, names: DataFrame) -> DataFrame:
    """Literal aliases by normalised text; a target without a choice has a NULL id."""
    plain = (
        aliases.where(F.col("alias").isNotNull() & (F.instr("alias", "{") == 0))
        .withColumn("text", normalise(F.col("alias")))
        .groupBy("dictionary", "text")
        .agg(F.max_by("target", "pos").alias("target"))
    )
    target = names.select("dictionary", F.col("text").alias("__t"), "id", F.col("value").alias("__v"))
    joined = plain.withColumn("__t", normalise(F.col("target"))).join(target, ["dictionary", "__t"], "left")
    return joined.select("dictionary", "text", "id", F.coalesce("__v", "target").alias("value"))


def direct_hits(names: DataFrame, aliases: DataFrame) -> DataFrame:
    """Names and literal aliases as one lookup table."""
    tagged = [
        table.select(
            "dictionary",
            "text",
            F.col("id").cast("bigint").alias("id"),
            "value",
            F.col("dictionary").alias("hit_dictionary"),
            F.lit(source).alias("source"),
        )
        for table, source in ((names, "index"), (alias_index(aliases, names), "alias"))
    ]
    return tagged[0].unionByName(tagged[1])


def parse_template(c: Column) -> Column:
    """Text to parts ``slot, name, flags, literal, tokens``, in order."""
    pieces = F.regexp_extract_all(c, F.lit(r"\{[^}]+\}|[^{]+|\{"), F.lit(0))

    def part(piece: Column) -> Column:
        slot = piece.rlike(r"^\{[^}]+\}$")
        inner = F.regexp_replace(piece, r"^\{|\}$", "")
        flags = F.filter(
            F.transform(F.split(F.regexp_extract(inner, "(?s):(.*)", 1), ","), lambda f: F.trim(f)),
            lambda f: f != "",
        )
        return F.struct(
            slot.alias("slot"),
            F.when(slot, F.substring_index(inner, ":", 1)).alias("name"),
            F.when(slot, flags).otherwise(F.array().cast("array<string>")).alias("flags"),
            F.when(~slot, piece).alias("literal"),
            F.when(slot, F.array().cast("array<string>")).otherwise(words(normalise(piece))).alias("tokens"),
        )

    return F.transform(pieces, part)


def unknown_names(aliases: DataFrame, choices: DataFrame) -> DataFrame:
    """Slots that name a dictionary nobody ships: warnings, as such a slot never matches."""
    known = choices.select("dictionary").unionByName(aliases.select("dictionary")).distinct()
    slot = aliases.where(F.instr("alias", "{") > 0).select(
        "dictionary", "alias", F.explode(parse_template(F.col("alias"))).alias("p")
    )
    return (
        slot.where("p.slot")
        .select("dictionary", "alias", F.col("p.name").alias("unknown"))
        .join(known.withColumnRenamed("dictionary", "unknown"), "unknown", "left_anti")
        .distinct()
    )


def _slot_symbol(name: Column, flags: Column) -> Column:
    return F.concat_ws(_SEP, F.lit("slot"), name, F.array_join(flags, ","))


def _literal_symbol(text: Column) -> Column:
    return F.concat_ws(_SEP, F.lit("literal"), text)


def _templates(aliases: DataFrame) -> DataFrame:
    """Templates ready to match: ``slots`` (name, flags) and the ``symbols`` of all parts.

    Blank literals take part in rendering only. Templates without a slot never match.
    """
    parsed = aliases.where(F.instr("alias", "{") > 0).select(
        "dictionary",
        "target",
        F.filter(parse_template(F.col("alias")), lambda p: p["slot"] | (F.size(p["tokens"]) > 0)).alias("parts"),
        F.transform(
            parse_template(F.col("target")),
            lambda p: F.struct(*[p[f].alias(f) for f in ("slot", "name", "flags", "literal")]),
        ).alias("render"),
    )
    symbol = lambda p: F.when(p["slot"], _slot_symbol(p["name"], p["flags"])).otherwise(
        _literal_symbol(F.array_join(p["tokens"], " "))
    )
    return parsed.select(
        "dictionary",
        "target",
        "render",
        F.transform(F.filter("parts", lambda p: p["slot"]), lambda p: F.struct(p["name"].alias("name"), p["flags"].alias("flags"))).alias("slots"),
        F.transform("parts", symbol).alias("symbols"),
    ).where(F.size("slots") > 0)


def _node(symbols: str, size) -> Column:
    return F.array_join(F.slice(symbols, F.lit(1), size), _EDGE)


def _trie(templates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The templates as a trie: edges (``node``, ``symbol``, ``child``), and where each ends.

    Templates share the beginnings they have in common, and from a node a symbol leads to one
    child, however many templates there are.
    """
    steps = templates.select("symbols", F.posexplode("symbols").alias("i", "symbol"))
    edges = steps.select(_node("symbols", F.col("i")).alias("node"), "symbol", _node("symbols", F.col("i") + 1).alias("child")).distinct()
    ends = templates.withColumn("node", _node("symbols", F.size("symbols"))).drop("symbols")
    return edges, ends


# ---- inflection -------------------------------------------------------------------


def inflection_table(inflections: DataFrame) -> DataFrame:
    """``form, lemma, case, inflected`` as ``form, flag, result`` by normalised form."""
    lemma = inflections.where("lemma IS NOT NULL").select(
        normalise(F.col("form")).alias("form"), F.lit("lemma").alias("flag"), F.col("lemma").alias("result")
    )
    cases = inflections.where("`case` IS NOT NULL AND inflected IS NOT NULL").select(
        normalise(F.col("form")).alias("form"), F.col("case").alias("flag"), F.col("inflected").alias("result")
    )
    return lemma.unionByName(cases).groupBy("form", "flag").agg(F.min("result").alias("result"))


def apply_flags(
    df: DataFrame, col: str, flags: Column, count: int, table: DataFrame | None
) -> DataFrame:
    """Apply up to ``count`` flags in order; a form the table does not know stays as it is."""
    for i in range(count):
        flag = F.get(flags, F.lit(i))
        titled = F.when(flag == "title", title_case(F.col(col)))
        if table is None:
            df = df.withColumn(col, F.coalesce(titled, F.col(col)))
            continue
        asked = df.withColumn("__form", normalise(F.col(col))).withColumn("__flag", flag)
        known = table.select(F.col("form").alias("__form"), F.col("flag").alias("__flag"), "result")
        df = (
            asked.join(known, ["__form", "__flag"], "left")
            .withColumn(col, F.coalesce(titled, F.col("result"), F.col(col)))
            .drop("__form", "__flag", "result")
        )
    return df


# ---- token splits -----------------------------------------------------------------


def _lay_parts(df: DataFrame, kmax: int) -> DataFrame:
    """Every way to lay ``parts`` over ``tokens`` in order: adds ``spans`` (start, stop) of the slots.

    A slot takes one token or more, a literal exactly its own; all tokens are used. Narrow:
    rows multiply in place, and a literal that does not stand where it should drops the row.
    """
    n = F.size("tokens")
    kept = df.columns
    none = F.array().cast("array<int>")
    df = df.select("*", F.array().cast("array<struct<start:int,stop:int>>").alias("spans"), F.lit(0).alias("at"))
    for p in range(kmax):
        part = F.get("parts", F.lit(p))
        width = F.size(part["tokens"])
        stop = F.least(n - part["rest"], F.col("at") + part["most"])
        fits = F.slice("tokens", F.col("at") + 1, width) == part["tokens"]
        last = part["rest"] == 0
        slot_ends = (
            F.when(stop <= F.col("at"), none)
            .when(~last, F.sequence(F.col("at") + 1, stop))
            .when(stop == n, F.array(n))
            .otherwise(none)
        )
        ends = (
            F.when(part.isNull(), F.array(F.col("at")))
            .when(part["slot"], slot_ends)
            .when((F.col("at") + width <= n) & fits, F.array(F.col("at") + width))
            .otherwise(none)
        )
        is_slot = F.coalesce(part["slot"], F.lit(False))
        span = F.array(F.struct(F.col("at").alias("start"), F.col("stop")))
        df = df.select("*", F.explode(ends).alias("stop")).select(
            *kept,
            F.when(is_slot, F.concat("spans", span)).otherwise(F.col("spans")).alias("spans"),
            F.col("stop").alias("at"),
        )
    return df.where(F.col("at") == n).drop("at")


def token_splits(df: DataFrame, tokens: str, k: int) -> DataFrame:
    """All splits of a token array into ``k`` consecutive parts, as ``split``; none when too short."""
    slots = [
        F.struct(
            F.lit(True).alias("slot"),
            F.array().cast("array<string>").alias("tokens"),
            F.lit(k - 1 - p).alias("rest"),
            F.lit(NO_LIMIT).alias("most"),
        )
        for p in range(k)
    ]
    asked = df.withColumnRenamed(tokens, "tokens") if tokens != "tokens" else df
    laid = _lay_parts(asked.where(F.size("tokens") >= k).withColumn("parts", F.array(*slots)), k)
    split = F.transform("spans", lambda s: _span_text("tokens", s))
    return laid.withColumn("split", split).drop("parts", "spans").withColumnRenamed("tokens", tokens)


def _count(text) -> Column:
    """Tokens of a normalised text."""
    return F.size(F.split(text, " "))


def _span_text(tokens: str, span: Column) -> Column:
    return F.array_join(F.slice(tokens, span["start"] + 1, span["stop"] - span["start"]), " ")


# ---- the chart ----------------------------------------------------------------------


class _Plan:
    """The dictionary side of a resolution, written once, with a few facts about its size."""

    def __init__(self, choices, aliases, inflections):
        self.names = name_index(choices)
        self.inflect = inflection_table(inflections) if inflections is not None else None
        self.templates = write_once(_templates(aliases), "templates")
        self.edges, self.ends = _trie(self.templates)
        self.direct = direct_hits(self.names, aliases)
        direct = self.direct.withColumn("symbol", F.lit(None).cast("string"))
        literals = (
            self.templates.select(F.explode("symbols").alias("symbol")).where(F.col("symbol").startswith("literal"))
            .distinct().withColumn("text", F.substring_index("symbol", _SEP, -1))
        )
        self.known = write_once(direct.unionByName(literals, allowMissingColumns=True).where("text <> ''"), "known_texts")

        slot = self.templates.select(F.explode("slots").alias("s")).select("s.name", "s.flags")
        self.asked = write_once(slot.select(F.col("name").alias("dictionary")).distinct(), "asked_dictionaries")
        flagged = slot.where(F.size("flags") > 0).distinct()
        facts = self.templates.agg(
            F.max(F.size("symbols")), F.max(F.size("render")),
            F.max(F.aggregate("render", F.lit(0), lambda n, p: F.greatest(n, F.size(p["flags"])))),
        ).first()
        self.parts, self.renders, self.render_flags = (n or 0 for n in facts)
        # How many tokens a known text can have: at most as many values as the longest has tokens.
        self.lengths = _lengths(self.known, F.col("text"))
        self.flagged = write_once(flagged, "flagged_slots")
        self.flags = [r.flags for r in self.flagged.select("flags").distinct().collect()]  # the lists of flags templates use
        # Texts get shorter on the way down unless an inflection adds words.
        self.grows = self.inflect is not None and not self.inflect.where(
            F.size(words(F.col("result"))) > F.size(words(F.col("form")))
        ).isEmpty()


def _lengths(table: DataFrame, text: Column) -> list[int]:
    return sorted(table.agg(F.collect_set(_count(text))).first()[0])


def _spans(texts: DataFrame, lengths: list[int]) -> DataFrame:
    """``tid, n, start, stop, span`` for every run of tokens as long as one of ``lengths``."""
    n = F.size("tokens")
    fitting = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda k: k <= n)
    cut = texts.withColumn("tokens", F.split("text", " ")).select("tid", "tokens", n.alias("n"), F.explode(fitting).alias("k"))
    cut = cut.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("k"))).alias("start"))
    return cut.select("tid", "n", "start", (F.col("start") + F.col("k")).alias("stop"), F.array_join(F.slice("tokens", F.col("start") + 1, F.col("k")), " ").alias("span"))


def _inflected(texts: DataFrame, plan: _Plan) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(texts, changes, places): texts joined by those that flags of slots make of their parts.

    ``changes`` has ``span, flags, derived`` for parts that a list of flags changes; ``places``
    where such parts stand, with the number of the derived text. Both are None if no slot has a
    flag that can change a text.
    """
    if plan.inflect is None or not plan.flags:
        return texts, None, None
    lengths = _lengths(plan.inflect, F.col("form"))
    seen, new, changes, round_ = texts, texts, None, 0
    while True:
        round_ += 1
        parts = write_once(_spans(new, lengths).select("span").distinct(), "parts")
        found = None
        for flags in plan.flags:
            made = apply_flags(parts.withColumn("made", F.col("span")), "made", F.array(*map(F.lit, flags)), len(flags), plan.inflect)
            made = made.select("span", F.array_join(F.array(*map(F.lit, flags)), ",").alias("flags"), normalise(F.col("made")).alias("derived"))
            found = made if found is None else found.unionByName(made)
        found = write_once(found.where("derived <> span"), "changes")
        changes = found if changes is None else changes.unionByName(found).distinct()
        more = found.select(F.col("derived").alias("text")).where("text <> ''").distinct().join(seen, "text", "left_anti")
        new = _numbered(more, round_)
        if new.isEmpty():
            break
        seen = seen.unionByName(new)
    numbered = seen.select(F.col("tid").alias("derived_tid"), F.col("text").alias("derived"))
    places = _spans(seen, lengths).join(changes, "span").join(numbered, "derived")
    return seen, write_once(changes, "changes"), write_once(places.select("tid", "start", "stop", "span", "flags", "derived_tid"), "places")


def _numbered(texts: DataFrame, round_: int = 0) -> DataFrame:
    """Texts with a number ``tid``, fixed by being written; those of later rounds have others."""
    return write_once(texts.select("text", (F.monotonically_increasing_id() + F.lit(round_ << 55)).alias("tid")), "texts")


def _symbols(hits: DataFrame, plan: _Plan, changes: DataFrame | None, places: DataFrame | None) -> DataFrame:
    """What hits stand for in templates: ``tid, start, stop, symbol`` and the hit.

    A slot without flags takes a hit of its dictionary where it stands. A slot with flags takes
    it too, unless the flags change the text; then it takes the hits of the changed text.
    """
    none = F.array().cast("array<string>")
    out = hits.withColumn("symbol", _slot_symbol(F.col("dictionary"), none))
    if plan.flags:
        uses = plan.flagged.select(F.col("name").alias("dictionary"), F.array_join("flags", ",").alias("flags"), _slot_symbol(F.col("name"), F.col("flags")).alias("symbol"))
        flagged = hits.join(uses, "dictionary")
        if changes is not None:
            here = flagged.join(changes, ["span", "flags"], "left_anti").drop("flags")
            whole = flagged.where((F.col("start") == 0) & (F.col("stop") == F.col("n"))).drop("start", "stop", "span", "n")
            there = whole.withColumnRenamed("tid", "derived_tid").join(places, ["derived_tid", "flags"]).drop("derived_tid", "flags")
            flagged = here.drop("n").unionByName(there)
        out = out.drop("n").unionByName(flagged.drop("n", "flags"))
    # What only ids, sources or the like tell apart is one thing to a template.
    return out.select(
        "tid", F.col("start").alias("from"), F.col("stop").alias("to"), "symbol",
        F.struct("id", "value", "hit_dictionary").alias("hit"), "used", "fresh",
    )


def _combined(symbols: DataFrame, plan: _Plan) -> DataFrame:
    """Templates that are complete: ``tid, start, stop, values, first, used`` and the template.

    States walk the trie: each step joins the state to a symbol that starts where it stands, and
    to the edge of that symbol. Only combinations with a hit of the last round are handed on.
    """
    none = F.array().cast("array<string>")
    symbols = symbols.join(plan.edges.select("symbol").distinct(), "symbol", "left_semi")
    states, done = None, None
    for number in range(plan.parts):
        if states is None:
            met = symbols.select(
                "tid", F.col("from").alias("start"), "to", "symbol", "hit", F.col("used").alias("below"), F.col("fresh").alias("new"),
                F.lit("").alias("node"), none.alias("values"), F.lit(None).cast("struct<id:bigint,value:string,hit_dictionary:string>").alias("first"),
                none.alias("used"), F.lit(False).alias("fresh"),
            )
        else:
            ahead = symbols.withColumnsRenamed({"from": "at", "used": "below", "fresh": "new"})
            met = states.join(ahead, ["tid", "at"])
        stepped = met.join(plan.edges, ["node", "symbol"]).select(
            "tid", "start", F.col("to").alias("at"), F.col("child").alias("node"),
            F.when(F.col("hit").isNull(), F.col("values")).otherwise(F.concat("values", F.array("hit.value"))).alias("values"),
            F.coalesce("first", "hit").alias("first"),
            F.array_union("used", "below").alias("used"),
            (F.col("fresh") | F.col("new")).alias("fresh"),
        )
        states = stepped.distinct()
        done = states if done is None else done.unionByName(states)
    return done.where("fresh").withColumnRenamed("at", "stop").join(plan.ends, "node")


def _made(combined: DataFrame, texts: DataFrame, plan: _Plan) -> DataFrame:
    """Hits of complete templates: targets rendered and looked up, or handed up as they are."""
    tokens = texts.select("tid", F.split("text", " ").alias("tokens"))
    rows = combined.join(tokens, "tid").withColumn("n", F.size("tokens"))
    rows = rows.withColumn("span", _span_text("tokens", F.struct("start", "stop"))).drop("tokens", "node")
    own = F.concat_ws(_SEP, "dictionary", "span")
    rows = rows.where(~F.array_contains("used", own))
    used = F.array_union("used", F.array(own))
    if not plan.grows:  # what is shorter than the text cannot be met again above it
        size = _count("span")
        used = F.filter(used, lambda e: _count(F.substring_index(e, _SEP, -1)) >= size)
    rows = rows.withColumn("used", F.array_sort(used))
    place = ["tid", "n", "start", "stop", "span", "dictionary", "used"]

    passed = rows.where(F.col("target") == EXTENDS).select(*place, "first.*", F.lit("extends").alias("source"))
    made = rows.where(F.col("target") != EXTENDS)
    slot_names = F.transform("slots", lambda s: s["name"])
    for i in range(plan.renders):
        part = F.get("render", F.lit(i))
        last = F.size("slots") - F.array_position(F.reverse(slot_names), part["name"])
        at = F.when(part["name"].rlike("^[0-9]+$"), part["name"].try_cast("int")).otherwise(
            F.when(F.array_contains(slot_names, part["name"]), last)
        )
        made = made.withColumn(
            f"__r{i}", F.when(part["slot"], F.get("values", at.cast("int"))).otherwise(part["literal"])
        )
        made = apply_flags(made, f"__r{i}", part["flags"], plan.render_flags, plan.inflect)
    pieces = [
        F.when(F.size("render") > i, F.col(f"__r{i}")).otherwise(F.lit("")) for i in range(plan.renders)
    ]
    made = made.select(*place, F.concat(*pieces).alias("made")).where("made IS NOT NULL")
    made = made.withColumn("__t", normalise(F.col("made")))
    names = plan.names.select("dictionary", F.col("text").alias("__t"), "id", "value")
    looked = made.join(names, ["dictionary", "__t"], "left").select(
        *place,
        F.col("id").cast("bigint").alias("id"),
        F.coalesce("value", "made").alias("value"),
        F.col("dictionary").alias("hit_dictionary"),
        F.lit("pattern").alias("source"),
    )
    return looked.unionByName(passed)


def resolve_entities(
    mentions: DataFrame,
    choices: DataFrame,
    aliases: DataFrame,
    inflections: DataFrame | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """All distinct hits of every mention, by name, alias, template and taxonomy.

    A round works on all texts and is written once; there are as many rounds as templates nest.
    Joins are by the text of a run of tokens, by (text, position), and by (trie node, symbol):
    none by dictionary, so a dictionary that a third of all mentions ask is no hot key, and the
    work does not grow with the number of templates that do not fit. With ``partitions`` the
    texts are dealt out so far before they are cut.
    """
    plan = _Plan(choices, aliases, inflections)
    asked = write_once(mentions.select("dictionary", "mention").distinct().withColumn("text", normalise(F.col("mention"))), "asked")
    texts = asked.select("text").where("text <> ''").distinct()
    texts, changes, places = _inflected(_numbered(texts.repartition(partitions) if partitions else texts), plan)

    marked = write_once(_spans(texts, plan.lengths).join(plan.known.withColumnRenamed("text", "span"), "span"), "marked")
    literals = marked.where("symbol IS NOT NULL").select(
        "tid", F.col("start").alias("from"), F.col("stop").alias("to"), "symbol",
        F.lit(None).cast("struct<id:bigint,value:string,hit_dictionary:string>").alias("hit"),
        F.array().cast("array<string>").alias("used"), F.lit(False).alias("fresh"),
    ).distinct()
    columns = ["tid", "n", "start", "stop", "span", "dictionary", "used", *_HIT]
    used = F.array(F.concat_ws(_SEP, "dictionary", "span")).alias("used")
    hits = marked.where("symbol IS NULL").select("tid", "n", "start", "stop", "span", "dictionary", used, *_HIT)
    hits = hits.withColumn("round", F.lit(0))
    number = 0
    while plan.parts:
        symbols = _symbols(hits.withColumn("fresh", F.col("round") == number), plan, changes, places)
        found = _made(_combined(symbols.unionByName(literals), plan), texts, plan).select(columns).distinct()
        number += 1
        known = hits.select(*[F.col(c).alias(f"__{c}") for c in columns])
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in columns])
        new = write_once(found.join(known, same, "left_anti").withColumn("round", F.lit(number)), "hits")
        hits = hits.unionByName(new)
        if new.join(plan.asked, "dictionary", "left_semi").isEmpty():  # nothing that a slot could take
            break
    blank = plan.direct.where("text = ''").select("dictionary", "text", *_HIT)  # names of no letters, for mentions alike
    whole = hits.where((F.col("start") == 0) & (F.col("stop") == F.col("n"))).select("dictionary", F.col("span").alias("text"), *_HIT)
    return asked.join(whole.unionByName(blank), ["dictionary", "text"]).select("dictionary", "mention", *_HIT).distinct()


def match_index(mentions: DataFrame, choices: DataFrame) -> DataFrame:
    """Hits by normalised name alone."""
    names = name_index(choices)
    return mentions.withColumn("text", normalise(F.col("mention"))).join(names, ["dictionary", "text"]).select(
        "dictionary",
        "mention",
        F.col("id").cast("bigint").alias("id"),
        "value",
        F.col("dictionary").alias("hit_dictionary"),
        F.lit("index").alias("source"),
    )


def match_alias(mentions: DataFrame, aliases: DataFrame, choices: DataFrame) -> DataFrame:
    """Hits by literal alias alone."""
    table = alias_index(aliases, name_index(choices))
    return mentions.withColumn("text", normalise(F.col("mention"))).join(table, ["dictionary", "text"]).select(
        "dictionary",
        "mention",
        F.col("id").cast("bigint").alias("id"),
        "value",
        F.col("dictionary").alias("hit_dictionary"),
        F.lit("alias").alias("source"),
    )


def match_template(mentions, choices, aliases, inflections=None) -> DataFrame:
    """Hits by template alone."""
    return resolve_entities(mentions, choices, aliases, inflections).where("source = 'pattern'")


def match_extends(mentions, choices, aliases, inflections=None) -> DataFrame:
    """Hits handed up from child dictionaries alone."""
    return resolve_entities(mentions, choices, aliases, inflections).where("source = 'extends'")


def unresolved(mentions: DataFrame, hits: DataFrame) -> DataFrame:
    """Distinct mentions without a hit."""
    found = hits.select("dictionary", "mention").distinct()
    return mentions.select("dictionary", "mention").distinct().join(found, ["dictionary", "mention"], "left_anti")
