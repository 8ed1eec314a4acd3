"""Quality by co-training: a classifier of the text and one of the document's metadata."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.session import write_once

from .frames import col, held_out, packed

TEXT, META = "text", "meta"


def shapes(text: Column) -> Column:
    """Words and their shapes: runs of capitals, small letters and digits become one sign each."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\p{Lu}+", "A"), r"\p{Ll}+", "a"), r"[0-9]+", "0")
    return F.concat(
        F.transform(F.split(shape, r"\s+"), lambda w: F.concat(F.lit("shape "), w)), F.split(F.lower(text), r"\s+")
    )


def measures(text: Column) -> dict[str, Column]:
    """A few numbers about the whole text."""
    size = F.greatest(F.char_length(text), F.lit(1))
    without = lambda pattern: F.char_length(F.regexp_replace(text, pattern, ""))
    return {
        "log_size": F.log1p(F.char_length(text)) / 10,
        "letters": 1 - without(r"\p{L}+") / size,
        "blanks": 1 - without(r"\s+") / size,
        "digits": 1 - without(r"[0-9]+") / size,
        "capitals": 1 - without(r"\p{Lu}+") / size,
    }


MEASURES = ["log_size", "letters", "blanks", "digits", "capitals"]


def view_of_text(features: int) -> list:
    return [
        HashingTF(inputCol="words", outputCol="counts", numFeatures=features),
        Normalizer(inputCol="counts", outputCol="shares", p=2.0),
        VectorAssembler(inputCols=["shares", *MEASURES], outputCol="text_features"),
    ]


def view_of_meta(features: int) -> list:
    return [
        HashingTF(inputCol="facts", outputCol="fact_counts", numFeatures=features),
        VectorAssembler(inputCols=["fact_counts", "meta_size"], outputCol="meta_features"),
    ]


@dataclass(frozen=True)
class CoTrained:
    """The two classifiers after the last round, how to calibrate them, and what they reached."""

    views: PipelineModel
    features: DataFrame
    models: dict
    calibration: dict[str, tuple[float, float]]
    prior: float
    exchanged: dict[str, int]


def inputs(rows: DataFrame, text: str, lang: str, source: str, n_chars: str) -> DataFrame:
    """What the two views are made of, next to the columns of ``rows``; ``row`` is the document."""
    body = F.coalesce(F.col("row").getField(text).cast("string"), F.lit(""))
    size = F.greatest(F.coalesce(F.col("row").getField(n_chars).cast("double"), F.lit(0.0)), F.lit(0.0))
    fact = lambda name, field: F.concat(
        F.lit(f"{name} "), F.coalesce(F.col("row").getField(field).cast("string"), F.lit(""))
    )
    return rows.select(
        "*",
        shapes(body).alias("words"),
        *[v.cast("double").alias(k) for k, v in measures(body).items()],
        F.array(
            fact("lang", lang),
            fact("source", source),
            F.concat(F.lit("size "), F.floor(F.log2(size + 1)).cast("string")),
        ).alias("facts"),
        (F.log1p(size) / 10).alias("meta_size"),
    )


def logit(probability: str) -> Column:
    p = F.least(F.greatest(F.element_at(vector_to_array(probability), 2), F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def scored(frame: DataFrame, models: dict) -> DataFrame:
    """Adds the log-odds ``text_logit`` and ``meta_logit``."""
    for view, model in models.items():
        frame = model.transform(frame).withColumn(f"{view}_logit", logit(f"{view}_probability"))
    return frame


def bounded(ids: DataFrame, most: int) -> DataFrame:
    """The ids with the smallest hashes."""
    return ids.orderBy(F.xxhash64("doc"), "doc").limit(most)


def handed_over(scores: DataFrame, judged: DataFrame, giver: str, confident: float, most: int) -> DataFrame:
    """(``doc``, ``label``): up to ``most`` of the ids without a label that ``giver`` is sure of.

    ``scores`` holds the log-odds of every document; only what is handed over is bounded, by the
    smallest hash of the id. Rows that repeat an id are judged by their mean.
    """
    odds = F.log(F.lit(confident / (1 - confident)))
    mean = scores.groupBy("doc").agg(F.avg(f"{giver}_logit").alias("logit"))
    sure = mean.where(F.col("doc").isNotNull() & (F.abs("logit") >= odds)).join(judged, "doc", "left_anti")
    return bounded(sure, most).select("doc", (F.col("logit") > 0).cast("double").alias("label"))


def co_train(
    base: DataFrame,
    fields: tuple,
    judged: DataFrame,
    labelled: DataFrame,
    *,
    rounds: int,
    confident: float,
    text_features: int,
    meta_features: int,
    max_handed: int,
    steps: int = 40,
) -> CoTrained | None:
    """Fit both views; None if the labelled rows are not of two classes.

    Both views' features of all documents are made and written once. Each round fits one
    classifier per view and lets both score all documents from there. Of the documents without a label that one view is ``confident``
    of, up to ``max_handed`` go to the other view's next fit, with that label. A row keeps the
    label of the round that comes last, and none if no view is sure any more.
    """
    views = Pipeline(stages=[*view_of_text(text_features), *view_of_meta(meta_features)])
    if labelled.select("label").distinct().count() < 2:
        return None
    made = views.fit(labelled)
    keep = ["doc", "label", "text_features", "meta_features"]
    gold = write_once(made.transform(labelled).select("fold", *keep), "labelled_views")
    train, check = gold.where("not fold").drop("fold"), gold.where("fold")
    if train.select("label").distinct().count() < 2 or check.select("label").distinct().count() < 2:
        train = check = gold.drop("fold")

    fit = lambda view, rows: LogisticRegression(
        featuresCol=f"{view}_features", probabilityCol=f"{view}_probability", predictionCol=f"{view}_prediction",
        rawPredictionCol=f"{view}_raw", regParam=1e-4, maxIter=steps,
    ).fit(rows)
    every = made.transform(inputs(base, *fields)).select("doc", "text_features", "meta_features")
    every = write_once(every, "features")
    given = {TEXT: train, META: train}
    exchanged = {TEXT: 0, META: 0}
    models: dict = {}
    for number in range(rounds + 1):
        models = {view: fit(view, given[view]) for view in (TEXT, META)}
        if number == rounds:
            break
        now = write_once(scored(every, models).select("doc", "text_logit", "meta_logit"), "scores")
        for taker, giver in ((TEXT, META), (META, TEXT)):
            sure = write_once(handed_over(now, judged, giver, confident, max_handed), "handed_over")
            exchanged[taker] = sure.count()
            rows = every.join(F.broadcast(sure), "doc")  # at most ``max_handed`` ids
            given[taker] = write_once(train.unionByName(rows.select(keep)), "given")
    calibration, judged = {}, write_once(scored(check, models).select("label", "text_logit", "meta_logit"), "checked")
    for view in (TEXT, META):
        platt = LogisticRegression(maxIter=50).fit(
            VectorAssembler(inputCols=[f"{view}_logit"], outputCol="features").transform(judged)
        )
        calibration[view] = (float(platt.coefficients[0]), float(platt.intercept))
    prior = judged.agg((F.sum("label") + 1) / (F.count("*") + 2)).first()[0]
    return CoTrained(made, every, models, calibration, float(prior), exchanged)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    n_chars: str = "n_chars",
    label: str = "quality",
    rounds: int = 2,
    confident: float = 0.95,
    max_labelled: int = 12_000,
    max_handed: int = 12_000,
    text_features: int = 4096,
    meta_features: int = 256,
    with_rows: bool = True,
) -> DataFrame:
    """Score every document with two classifiers that taught each other.

    Returns ``row`` (the input row as a struct), ``doc``, ``held_out`` (a third of the ids, which
    no classifier is fitted on; both are calibrated there), ``text_score``, ``meta_score``
    (calibrated probabilities of good quality), ``score`` (both views together: the sum of their
    log-odds less the prior's, as for views that are independent given the class) and
    ``quality`` (1 if the score is at least one half, else 0).

    Classifiers are fitted on at most ``max_labelled`` labelled rows, taken by the smallest hash
    of the id, and in each round on at most ``max_handed`` rows that the other view labelled.
    Both views score all documents in every round, over their whole texts, and so does the end.
    Without ``with_rows`` there is no ``row``: then the end, too, works on the features written
    once, and texts are read no second time.

    * Null texts count as empty; null metadata is a value of its own; a null or negative size is
      zero.
    * Several labels of an id count by their mean, one half as good. Labels that are null or
      without a document count for nothing; a null id has no label.
    * A score of exactly one half is good.
    * If the labelled rows are not of two classes nothing can be learned: all scores are one half.
    * Rows that repeat an id are scored each. An empty table gives an empty result.
    """
    base, fields = packed(docs, doc=col(doc_id)), (text, lang, source, n_chars)
    judged = labels.groupBy(col(doc_id).alias("doc")).agg((F.avg(col(label)) >= 0.5).cast("double").alias("label"))
    judged = judged.where(F.col("doc").isNotNull() & F.col("label").isNotNull())
    ids = docs.select(col(doc_id).alias("doc")).distinct()
    judged = write_once(judged, "judged")
    chosen = bounded(ids.join(judged, "doc"), max_labelled)
    # Only the ids of the sample are sent to the documents, which are not shuffled.
    sample = inputs(base.join(F.broadcast(chosen), "doc"), *fields).drop("row")
    learned = co_train(
        base, fields, judged, write_once(sample.withColumn("fold", held_out(F.col("doc"))), "labelled"), rounds=rounds,
        confident=confident, text_features=text_features, meta_features=meta_features, max_handed=max_handed,
    )
    named = [*([F.col("row")] if with_rows else []), F.col("doc"), held_out(F.col("doc")).alias("held_out")]
    if learned is None:
        half = [F.lit(0.5).alias(n) for n in ("text_score", "meta_score", "score")]
        return base.select(*named, *half, F.lit(1).alias("quality"))
    frame = learned.views.transform(inputs(base, *fields)) if with_rows else learned.features
    frame = scored(frame, learned.models)
    odds = {v: a * F.col(f"{v}_logit") + b for v, (a, b) in learned.calibration.items()}
    share = lambda x: 1 / (1 + F.exp(-x))
    both = odds[TEXT] + odds[META] - F.log(F.lit(learned.prior / (1 - learned.prior)))
    return frame.select(
        *named, share(odds[TEXT]).alias("text_score"), share(odds[META]).alias("meta_score"), share(both).alias("score")
    ).withColumn("quality", (F.col("score") >= 0.5).cast("int"))
