"""Queries on entity resolution."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalise, words
from ..operators import resolve as R
from .base import Tables, query


def union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def dictionaries(t: Tables):
    """Shades, things, products and clients, drawn from part and customer names."""
    adjective, noun = F.substring_index("p_name", " ", 1), F.substring_index("p_name", " ", -1)

    def names(dictionary: str, name, df: DataFrame) -> DataFrame:
        return df.select(
            F.lit(dictionary).alias("dictionary"), F.length(name).cast("bigint").alias("id"), name.alias("name"),
            F.lit(0).cast("bigint").alias("pos"),
        ).distinct()

    clients = t.customer.select(
        F.lit("client").alias("dictionary"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_custkey").alias("pos"),
    )
    choices = union(
        names("shade", adjective, t.part),
        names("thing", noun, t.part),
        names("product", F.col("p_name"), t.part),
        clients,
    )
    plural = t.part.select(
        F.lit("thing").alias("dictionary"), noun.alias("target"), F.concat(noun, F.lit("s")).alias("alias"),
        F.lit(0).alias("pos"),
    ).distinct()
    templates = t.spark.createDataFrame(
        [
            ("product", "{shade} {thing}", "{thing}, {shade}", 1),
            ("product", "{product}", "uab {product}", 2),
            ("client", "{client}", "{client} uab", 3),
            ("item", "(extends)", "{product}", 4),
            ("item", "(extends)", "{thing}", 5),
        ],
        "dictionary string, target string, alias string, pos int",
    )
    return choices, union(plural, templates)


def mentions(t: Tables):
    adjective, noun = F.substring_index("p_name", " ", 1), F.substring_index("p_name", " ", -1)
    kind = F.col("p_partkey") % 6
    dictionary = F.when(kind == 3, "item").when(kind == 4, "thing").otherwise("product")
    mention = (
        F.when(kind == 1, F.concat_ws(" ", noun, adjective))
        .when(kind == 2, F.concat(F.lit('UAB "'), "p_name", F.lit('"')))
        .when(kind == 4, F.upper(F.concat(noun, F.lit("s"))))
        .when(kind == 5, F.concat(F.lit("ne "), "p_name"))
        .otherwise(F.col("p_name"))
    )
    parts = t.part.select(dictionary.alias("dictionary"), mention.alias("mention"))
    clients = t.customer.select(
        F.lit("client").alias("dictionary"), F.concat(F.upper("c_name"), F.lit(", UAB")).alias("mention")
    )
    return union(parts, clients)


PARTS_SQL = """
    p AS (SELECT DISTINCT p_partkey % 6 AS kind, p_name, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b
          FROM part),
    m AS (
        SELECT CASE kind WHEN 3 THEN 'item' WHEN 4 THEN 'thing' ELSE 'product' END AS dictionary,
               CASE kind WHEN 1 THEN b || ' ' || a WHEN 2 THEN 'UAB "' || p_name || '"' WHEN 4 THEN upper(b || 's')
                         WHEN 5 THEN 'ne ' || p_name ELSE p_name END AS mention, p.*
        FROM p
    ),
    hits AS (
        SELECT DISTINCT dictionary, mention,
               CASE WHEN kind = 4 THEN length(b) ELSE length(p_name) END::BIGINT AS id,
               CASE WHEN kind = 4 THEN b ELSE p_name END AS value,
               CASE WHEN kind = 4 THEN 'thing' ELSE 'product' END AS hit_dictionary,
               CASE kind WHEN 0 THEN 'index' WHEN 3 THEN 'extends' WHEN 4 THEN 'alias' ELSE 'pattern' END AS source
        FROM m WHERE kind < 5
        UNION ALL
        SELECT 'client', upper(c_name) || ', UAB', c_custkey, c_name, 'client', 'pattern' FROM customer
    )
"""


@query("J6 J7 J8 J9 J10", f"WITH {PARTS_SQL} SELECT * FROM hits")
def resolve_parts(t: Tables):
    return R.resolve_entities(mentions(t), *dictionaries(t), partitions=t.parts)


@query(
    "J11 J10",
    f"""
    WITH {PARTS_SQL}
    SELECT DISTINCT dictionary, mention FROM m WHERE kind = 5
    """,
)
def unresolved_mentions(t: Tables):
    asked = mentions(t)
    return R.unresolved(asked, R.resolve_entities(asked, *dictionaries(t), partitions=t.parts))


@query(
    "J6 X1",
    """
    SELECT 'client' AS dictionary, upper(c_name) AS mention, c_custkey AS id, c_name AS value,
           'client' AS hit_dictionary, 'index' AS source FROM customer
    """,
)
def match_names(t: Tables):
    choices, _ = dictionaries(t)
    asked = t.customer.select(F.lit("client").alias("dictionary"), F.upper("c_name").alias("mention"))
    return R.match_index(asked, choices)


@query(
    "J7",
    """
    SELECT 'thing' AS dictionary, split_part(p_name, ' ', 2) || 'S' AS mention, p_partkey,
           length(split_part(p_name, ' ', 2))::BIGINT AS id, split_part(p_name, ' ', 2) AS value FROM part
    """,
)
def match_aliases(t: Tables):
    choices, aliases = dictionaries(t)
    asked = t.part.select(
        "p_partkey", F.lit("thing").alias("dictionary"),
        F.concat(F.substring_index("p_name", " ", -1), F.lit("S")).alias("mention"),
    )
    hits = R.match_alias(asked.drop("p_partkey").distinct(), aliases, choices)
    return asked.join(hits, ["dictionary", "mention"]).select("dictionary", "mention", "p_partkey", "id", "value")


@query(
    "J8",
    r"""
    WITH t AS (
        SELECT p_partkey, string_split(lower(p_name || ' ' || replace(p_brand, '#', ' ') || ' ' || p_type), ' ') AS w FROM part
    ), a AS (SELECT p_partkey, w, unnest(range(1, len(w))) AS i FROM t),
       b AS (SELECT *, unnest(range(i + 1, len(w))) AS j FROM a)
    SELECT p_partkey, array_to_string(w[:i], ' ') AS first, array_to_string(w[i + 1:j], ' ') AS second,
           array_to_string(w[j + 1:], ' ') AS third
    FROM b
    """,
)
def three_part_splits(t: Tables):
    # Every way to split a part's full name into three.
    full = normalise(F.concat_ws(" ", "p_name", "p_brand", "p_type"))
    splits = R.token_splits(t.part.select("p_partkey", words(full).alias("tokens")), "tokens", 3)
    return splits.select(
        "p_partkey", *[F.col("split")[i].alias(name) for i, name in enumerate(("first", "second", "third"))]
    )
