import hashlib
import uuid

from tablewright.llm.exact import DigestIndex

from .helpers import docs_of, long_text


def index(spark):
    return DigestIndex(spark, f"digests_{uuid.uuid4().hex}", buckets=4)


def ours(held, docs):
    return sorted(
        ((r.doc, bytes(r.digest).hex(), r.keep_id, r.group_size, r.kept) for r in held.add(docs).collect()), key=str
    )


def brute(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(text or "", []).append(doc)
    out = []
    for doc, text in rows:
        ids = groups[text or ""]
        keep = max((d for d in ids if d is not None), default=None)
        out.append((doc, hashlib.sha256((text or "").encode()).hexdigest(), keep, len(ids), doc == keep))
    return sorted(out, key=str)


ROWS = [(1, "a"), (2, "b"), (3, "a"), (3, "a"), (4, None), (5, ""), (None, "a"), (None, "alone"), (6, "A"), (7, "a "), (8, "é"), (9, "é")]


def test_awkward_rows(spark):
    rows = [*ROWS, (10, long_text()), (11, long_text())]
    assert ours(index(spark), docs_of(spark, rows)) == brute(rows)


def test_empty_table(spark):
    held = index(spark)
    assert ours(held, docs_of(spark, [])) == []
    assert ours(held, docs_of(spark, ROWS)) == brute(ROWS)


def test_later_batches_meet_the_index(spark):
    held = index(spark)
    ours(held, docs_of(spark, [(1, "a"), (2, "b"), (3, "a")]))
    later = ours(held, docs_of(spark, [(7, "a"), (8, "c"), (9, "c")]))
    assert [(r[0], r[2], r[3], r[4]) for r in later] == [(7, 3, 1, False), (8, 9, 2, False), (9, 9, 2, True)]
    again = ours(held, docs_of(spark, [(10, "c"), (11, "b")]))
    assert [(r[0], r[2], r[4]) for r in again] == [(10, 9, False), (11, 2, False)]
    assert held.rows().count() == 3


def test_the_index_is_read_without_a_shuffle(spark):
    held = index(spark)
    held.add(docs_of(spark, ROWS))
    plan = held.rows().hint("merge").join(spark.range(3).selectExpr("unhex(sha2(string(id), 256)) AS digest"), "digest")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Bucketed: true" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_one_text_in_a_third_of_all_rows(spark):
    rows = [(i, "the same" if i % 3 == 0 else f"text {i}") for i in range(600)]
    assert ours(index(spark), docs_of(spark, rows)) == brute(rows)


def test_every_batch_is_anti_joined_without_a_shuffle_of_the_index(spark):
    held = index(spark)
    for _ in range(2):  # also the first batch, which meets an empty index
        groups = held._groups(docs_of(spark, ROWS), "doc_id", "text")
        text = held.fresh(groups)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "LeftAnti" in text and "Bucketed: true" in text
        assert text.count("Exchange hashpartitioning") == 1  # of the batch's groups
        held.append(docs_of(spark, ROWS))


def test_the_query_fills_the_index_in_two_batches(spark, tmp_path, monkeypatch):
    from tablewright.llm import queries as Q

    rows = [*ROWS, (10, "b"), (0, "é"), (12, None)]
    docs_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    batches = []
    append = DigestIndex.append
    monkeypatch.setattr(DigestIndex, "append", lambda self, docs, **more: (batches.append(docs.count()), append(self, docs, **more)))
    done = Q.op6_exact_dedup(spark, str(tmp_path))
    assert sorted(((r.doc_id, r.text_sha256, r.keep_id, r.group_size, r.kept) for r in done.collect()), key=str) == brute(rows)
    assert len(batches) == 2 and min(batches) > 0 and sum(batches) == len(rows)
