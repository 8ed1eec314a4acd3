"""URL filters: rules for hosts and paths, and boosted trees for the URLs that no rule fits."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.session import write_once

from .frames import UPPER, col, packed

FEATURES = (
    "length host_length path_length depth labels digit_ratio hyphens entropy "
    "n_params query_length has_fragment suffix_urls suffix_block_rate"
).split()


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (verdict, rule) of the longest rule that fits, or null.

    A rule is ``host/path``; it fits its host and all subdomains when the path starts with the
    rule's. The list is a parameter, evaluated in order of length as one expression.
    """
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        value = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        found = F.when(fits, value).otherwise(found)
    return found


def entropy(text: Column) -> Column:
    """Bits per character of the characters' distribution; zero for an empty text."""
    size = F.char_length(text)

    def bits(total: Column, one: Column) -> Column:
        share = (size - F.char_length(F.replace(text, one))) / size
        return total - share * F.log2(share)

    return F.when(size == 0, 0.0).otherwise(
        F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), bits)
    )


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Numbers read from the URL alone."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    digits = F.char_length(F.regexp_replace(url, "[^0-9]", ""))
    count = lambda text, what: F.char_length(text) - F.char_length(F.replace(text, F.lit(what)))
    return {
        "length": F.char_length(url),
        "host_length": F.char_length(host),
        "path_length": F.char_length(path),
        "depth": F.size(F.filter(F.split(path, "/"), lambda part: part != "")),
        "labels": F.size(F.filter(F.split(host, r"\."), lambda part: part != "")),
        "digit_ratio": F.when(url == "", 0.0).otherwise(digits / F.char_length(url)),
        "hyphens": count(url, "-"),
        "entropy": entropy(url),
        "n_params": F.when(query == "", 0).otherwise(count(query, "&") + 1),
        "query_length": F.char_length(query),
        "has_fragment": F.instr(url, "#") > 0,
    }


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    *,
    page_id: str = "page_id",
    url: str = "url",
    max_labelled: int = 20_000,
    trees: int = 20,
    depth: int = 4,
    prior: float = 10.0,
    seed: int = 7,
) -> DataFrame:
    """Judge every URL: by the longest rule that fits, else by boosted trees.

    The URLs that a rule fits are the labelled ones. Trees are fitted on at most
    ``max_labelled`` of them, taken by the smallest hash of (URL, id); the statistics of each
    suffix (the host's last label) count all rows: how many URLs have it, and the share of
    blocked among its labelled ones, drawn towards one half by ``prior`` rows.

    Returns ``row`` (the input row as a struct), ``page``, ``host``, ``path``, ``rule``,
    ``verdict`` (``allow`` or ``block``) and ``block_score``.

    * A null URL, or one without ``://``, has an empty host and path; no rule fits it.
    * Repeated URLs and ids are judged alike. Rows never change in number.
    * Without labelled rows nothing can be learned and the rest is allowed, with score zero.
    """
    site = col(url)
    base = packed(pages, page=col(page_id), address=F.coalesce(site, F.lit("")), host=host_of(site), path=path_of(site))
    base = base.withColumns(
        {
            "fit": fitting_rule(F.col("host"), F.col("path"), rules),
            "suffix": F.regexp_extract("host", r"([^.:]*)(?::[0-9]*)?$", 1),
        }
    ).withColumn("label", (F.col("fit.verdict") == "block").cast("double"))
    suffixes = base.groupBy("suffix").agg(
        F.log1p(F.count("*")).alias("suffix_urls"),
        ((F.coalesce(F.sum("label"), F.lit(0.0)) + prior / 2) / (F.count("label") + prior)).alias("suffix_block_rate"),
    )
    numbers = lexical_features(F.col("address"), F.col("host"), F.col("path"))
    featured = base.join(suffixes, "suffix").withColumns({k: v.cast("double") for k, v in numbers.items()})
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    labelled = (
        featured.where(F.col("label").isNotNull())
        .orderBy(F.xxhash64("address", "page"), "address", "page")
        .limit(max_labelled)
        .select("label", *FEATURES)
    )
    labelled = write_once(labelled, "labelled")
    sample = assembler.transform(labelled).select("label", "features")
    if sample.isEmpty():
        judged = featured.withColumn("block_score", F.lit(0.0))
    else:
        gbt = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=seed)
        model = gbt.fit(sample)
        scored = model.transform(assembler.transform(featured))
        judged = scored.withColumn("block_score", F.element_at(vector_to_array("probability"), 2))
    by_method = F.when(F.col("block_score") > 0.5, "block").otherwise("allow")
    return judged.select(
        "row",
        "page",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), by_method).alias("verdict"),
        "block_score",
    )

