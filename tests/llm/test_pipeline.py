import ast
import os
import shutil
import subprocess
import sys
import zlib

import numpy as np

import corpus_pipeline as C
from tablewright.llm import queries as Q

from . import test_lines, test_packing, test_simhash
from .helpers import docs_of

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def sample():
    words = {"en": "the thing and that with other nation", "de": "der schein und keiten über verschenkt"}
    rows = []
    for i in range(90):
        lang = "en" if i % 2 else "de"
        parts = words[lang].split()
        text = "\n".join(" ".join(parts[(i * k + j) % len(parts)] + str(i % 7) for j in range(8)) for k in range(1, 4))
        if i % 3 == 0:
            text += "\nThis footer line is found in very many documents"
        if i % 10 == 4:
            text += "\napi_key = a1b2c3d4e5f6"
        rows.append((i, text, lang, "s", len(text)))
    rows += [(200, rows[5][1], "en", "s", 1), (201, "", "en", "s", 0), (202, "12345", "en", "s", 5), (203, None, None, None, None)]
    return rows


def written(spark, frame, path):
    frame.write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_each_stage_like_brute_force(spark, tmp_path):
    docs = written(spark, docs_of(spark, sample()).select(*DOCUMENTS), tmp_path / "documents.parquet")
    for number, (name, stage) in enumerate(C.STAGES):
        before = [tuple(r) for r in docs.select(*DOCUMENTS).collect()]
        docs = written(spark, stage(spark, docs, str(tmp_path)), tmp_path / str(number))
        rows = [tuple(r) for r in docs.collect()]
        if number < 4:
            assert docs.columns == DOCUMENTS
        if name == "language_id":
            assert {r[0] for r in before} - {r[0] for r in rows} == {201, 202, 203}
            assert set(rows) <= set(before)
        elif name == "line_dedup":
            want = {(d, t) for d, _, _, t in test_lines.brute([r[:2] for r in before])}
            assert {r[:2] for r in rows} == want and all(r[4] == len(r[1]) for r in rows)
        elif name == "near_dedup":
            prints = {r[0]: test_simhash.plain_print(r[1]) for r in before}
            group = test_simhash.plain_groups(set(prints.values()))
            least = {}
            for d, p in prints.items():
                least[group[p]] = min(d, least.get(group[p], d))
            assert {r[0] for r in rows} == set(least.values()) and set(rows) <= set(before)
        elif name == "secret_scans":
            assert [r[0] for r in sorted(rows)] == [r[0] for r in sorted(before)]
            assert not any("a1b2c3d4e5f6" in r[1] for r in rows) and any("[SECRET]" in r[1] for r in rows)
            clean = {r[:2] for r in before if "api_key" not in r[1]}
            assert clean <= {r[:2] for r in rows}
        else:
            ids = {r[0]: [*test_packing.library_ids(r[1]), 0] for r in before}
            assert {(r.doc_id, r.length, r.ids_crc32) for r in docs.collect()} == {
                (d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in ids.items()
            }


def test_one_row_of_each_group_of_near_duplicates_stays(spark):
    one, other = ("first text of some words " * 20, "wholly different matter here " * 20)
    rows = [(7, one), (7, one), (7, one.upper()), (9, one), (None, one), (None, other), (None, other), (None, other.upper()), (3, "alone"), (3, "apart")]
    left = C.dedup_near(spark, docs_of(spark, rows), "")
    assert left.columns == docs_of(spark, rows).columns
    assert sorted(((r.doc_id, r.text.lower()) for r in left.collect()), key=str) == sorted([(7, one), (None, other), (3, "alone"), (3, "apart")], key=str)


def test_run_is_the_stages_in_turn(spark, tmp_path):
    docs_of(spark, sample()).select(*DOCUMENTS).write.parquet(str(tmp_path / "documents.parquet"))
    done = C.run(spark, str(tmp_path))
    assert done.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert done.count() > 0 and done.select("doc_id").distinct().count() == done.where("piece = 0").count()


def test_stages_bear_empty_tables_and_extra_columns(spark):
    for rows in ([], sample()):
        docs = docs_of(spark, rows)
        for _, stage in C.STAGES[:-1]:
            out = stage(spark, docs, "")
            assert out.columns == docs.columns
            assert (out.count() > 0) == bool(rows)


def test_queries_are_registered_and_native_ones_have_no_python(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert [n for n in names if n.startswith("op")] == list(Q.QUERIES) and "pipeline" in names
    folder = "/root/testdata/sf0.001"
    for name in ("op1_url_filters", "op4_line_dedup", "op6_exact_dedup"):
        plan = names[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin")), name


def test_the_rest_imports_nothing_from_here():
    for folder, _, files in os.walk(os.path.join(ROOT, "tablewright")):
        if os.path.basename(folder) in ("llm", "__pycache__"):
            continue
        for file in files:
            if file.endswith(".py"):
                with open(os.path.join(folder, file), encoding="utf-8") as code:
                    for node in ast.walk(ast.parse(code.read())):
                        if isinstance(node, ast.ImportFrom):
                            assert "llm" not in (node.module or "").split(".") and not any(a.name == "llm" for a in node.names)


def test_the_entry_works_without_this_folder(tmp_path):
    shutil.copytree(os.path.join(ROOT, "tablewright"), tmp_path / "tablewright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()) == len(e.REGISTRY), 'pipeline' in e.queries())"
    own = {**os.environ, "PYTHONPATH": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=False, env=own)
    assert done.stdout.split()[-2:] == ["True", "False"], done.stderr[-800:]
