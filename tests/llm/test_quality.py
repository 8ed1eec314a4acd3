import random

from pyspark.sql import functions as F

from tablewright.llm.quality import handed_over, score_quality

from .helpers import docs_of, long_text

LABELS = "doc_id long, quality int, toxic int, label string, doc string"


def corpus(n=500, seed=1):
    """Text and metadata both tell the class, each of them not always."""
    rng = random.Random(seed)
    docs, truth = [], {}
    for i in range(n):
        good = rng.random() < 0.6
        words = [rng.choice(["fine", "words", "about", "things"]) for _ in range(rng.randint(5, 40))]
        if not good and rng.random() < 0.9:
            words = [w + rng.choice(["%%%", "###"]) for w in words]
        source = rng.choice(["a", "b"] if good == (rng.random() < 0.9) else ["c", "d"])
        text = " ".join(words)
        docs.append((i, text, "en", source, len(text)))
        truth[i] = int(good)
    return docs, truth


def labels_of(spark, rows):
    return spark.createDataFrame([(d, q, 0, "x", "x") for d, q in rows], LABELS)


def test_held_out_accuracy(spark):
    docs, truth = corpus()
    labels = labels_of(spark, [(i, q) for i, q in truth.items() if i % 2])
    done = score_quality(docs_of(spark, docs), labels).collect()
    assert len(done) == len(docs)
    unseen = [r for r in done if r.held_out or r.doc % 2 == 0]
    assert sum(r.quality == truth[r.doc] for r in unseen) / len(unseen) > 0.93
    text_only = sum((r.text_score >= 0.5) == truth[r.doc] for r in unseen)
    assert sum(r.quality == truth[r.doc] for r in unseen) >= text_only - 3
    assert all(0 <= x <= 1 for r in done for x in (r.text_score, r.meta_score, r.score))


def test_awkward_rows(spark):
    docs, truth = corpus(200)
    odd = [(1001, None), (1002, ""), (1003, long_text(), "en", None, None), (None, "no id"), (5, "again", None, "a", -5)]
    labels = [(i, q) for i, q in truth.items()] + [(1, 1 - truth[1]), (None, 1), (7, None), (99_999, 1)]
    done = score_quality(docs_of(spark, docs + odd), labels_of(spark, labels), rounds=1).collect()
    assert len(done) == 205
    assert all(r.score is not None and r.quality in (0, 1) for r in done)
    assert [r.held_out for r in done if r.doc is None] == [False]
    assert done[0].row.kept == "x"


def test_nothing_to_learn(spark):
    docs, _ = corpus(5)
    for labels in ([], [(1, 1), (2, 1)], [(1, None)]):
        done = score_quality(docs_of(spark, docs), labels_of(spark, labels)).select(F.col("score")).collect()
        assert [r.score for r in done] == [0.5] * 5
    assert score_quality(docs_of(spark, []), labels_of(spark, [(1, 1)])).collect() == []


def test_handed_over_are_the_sure_ones_without_a_label(spark):
    scores = spark.createDataFrame([(i, float(i - 50)) for i in range(100)] + [(None, 99.0), (99, 47.0)], "doc long, text_logit double")
    judged = spark.createDataFrame([(0, 1.0), (98, 0.0)], "doc long, label double")
    sure = {i for i in range(100) if abs(i - 50) >= 3} - {0, 98}  # log(0.95 / 0.05) is 2.94
    done = handed_over(scores, judged, "text", 0.95, 1000).collect()
    assert {(r.doc, r.label) for r in done} == {(i, float(i > 50)) for i in sure} and len(done) == len(sure)
    assert {r.doc for r in handed_over(scores, judged, "text", 0.95, 7).collect()} < sure


def test_a_score_of_one_half_is_good(spark):
    docs, _ = corpus(5)
    done = score_quality(docs_of(spark, docs), labels_of(spark, [])).collect()
    assert {(r.score, r.quality) for r in done} == {(0.5, 1)}


def test_scores_are_the_same_without_rows(spark):
    docs, truth = corpus(200)
    args = docs_of(spark, docs), labels_of(spark, list(truth.items()))
    one, other = (score_quality(*args, rounds=1, with_rows=w) for w in (True, False))
    assert "row" in one.columns and "row" not in other.columns
    plain = lambda df: sorted((r.doc, round(r.score, 9), r.quality, r.held_out) for r in df.collect())
    assert plain(one) == plain(other)
