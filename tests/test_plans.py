"""Every registered query against its SQL, and the shape of the plans."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402

from tablewright.plans import REGISTRY  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_its_sql(spark, con, name):
    query = REGISTRY[name]
    mine = compare.spark_table(query.build(spark, SF))
    assert mine[1], "no rows"
    if query.sql:
        assert compare.difference(mine, compare.sql_table(con, query.sql)) is None


def plan(spark, name):
    return REGISTRY[name].build(spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    "valid_at speaker_variant_join role_attribution points_in_areas nearest_supplier split_names enrich_by_code "
    "kv_runs carry_clock merge_ship_intervals links_by_host lines_with_order".split(),
)
def test_no_join_pairs_all_with_all(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize(
    "name, columns",
    [("first_event_per_user", "event_id event_type user_id value"), ("latest_forecast", "o_custkey o_orderdate o_orderkey o_totalprice"),
     ("retain_recent", "event_id event_type ts user_id"), ("page_text", "html page_id")],
)
def test_scans_read_only_what_is_used(spark, name, columns):
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan(spark, name)).group(1)
    assert sorted(c.split(":")[0] for c in read.split(",")) == columns.split()


def test_filters_reach_the_scan(spark):
    assert "GreaterThanOrEqual(ts" in plan(spark, "retain_recent")


@pytest.mark.parametrize("name", "links_by_host page_text normalise_names clean_companies long_dates text_segments kv_runs".split())
def test_hot_paths_stay_in_the_jvm(spark, name):
    text = plan(spark, name)
    assert "Python" not in text and "InPandas" not in text


def test_hot_groups_are_cut_into_parts(spark):
    # The detail window is partitioned by (group, part), never by the group alone.
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", plan(spark, "carry_clock"))
    assert any("__part" in keys for keys in windows)


@pytest.mark.parametrize("name", ["carry_clock", "merge_ship_intervals", "kv_runs", "turns_with_clock"])
def test_passes_over_a_sequence_do_not_shuffle_its_rows(spark, name):
    """Rows are read where they were placed; of the scan, only border rows are exchanged."""
    text = plan(spark, name)
    assert "Bucketed: true" in text
    rows = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert not any("__part" in keys for keys in rows)


def given_scans(spark, name):
    """The given tables that the plan of a query scans; a path may be cut short."""
    places = re.findall(r"Location: [^\[]*\[([^\]]*)\]", plan(spark, name))
    assert places
    return [p for p in places if "/root/testdata" in p]


@pytest.mark.parametrize("name", "merge_ship_intervals ship_totals kv_runs carry_clock turns_with_clock assemble_turns".split())
def test_facts_are_read_for_the_placing_only(spark, name):
    """All passes over a sequence read what was placed; the plan of the result scans no given table."""
    assert given_scans(spark, name) == []


def test_transcripts_are_cut_once(spark):
    assert not any("conversations" in s for s in given_scans(spark, "transcript_turns"))


def test_quarantine_reads_the_captures_once(spark):
    """The plan of the results reads what was written; the captures were read by the one write."""
    assert given_scans(spark, "quarantined_captures") == []


@pytest.mark.parametrize("whole", [5000, 7])
def test_a_delivery_is_many_files_and_one_batch(spark, whole):
    from tablewright.plans import streams
    from tablewright.plans.base import Tables

    seen = []

    def run(stream):
        def batch(df, number):
            files = df.select(streams.F.input_file_name()).distinct().count()
            seen[-1].append((number, df.count(), files))

        seen.append([])
        streams.S.run_batches(stream, batch, checkpoint)

    checkpoint = streams.scratch_path(spark, "checkpoint")
    rows = spark.range(0, whole, 1, 4)
    streams.deliver(Tables(spark, SF), run, rows, rows.where("id < 3"), rows)
    assert [[n[:2] for n in batches] for batches in seen] == [[(0, whole)], [(1, 3)], [(2, whole)]]
    assert seen[0][0][2] == 4


#: By operator: the functions one of which a query that claims it must reach.
OPERATORS = {
    "S1": "read_log overwrite_table", "S2": "append_log", "S3": "valid_pages split_required quarantine", "S4": "read_keyed_csv",
    "S5": "read_legacy_report", "S6": "load_dictionary", "S7": "export_table", "S8": "flatten export_table", "S9": "export_table export_frame",
    "S10": "export_jsonl", "S11": "seed_urls", "S12": "strformat", "P1": "project", "P2": "extract_links", "P3": "extract_links",
    "P4": "extract_text extract_text_without", "P5": "extract_kv", "P6": "extract_rows", "P7": "explode_children", "P8": "labelled_fields project",
    "P9": "first_complete split_required recode", "P10": "apply_overrides", "P11": "recode", "P12": "conditional_column in_list",
    "P13": "drop_first", "P14": "prefer", "P15": "exclude_pairs", "P16": "sections", "P17": "with_parent explode_children",
    "P18": "follow_redirects", "J1": "valid_at_join period_lookup", "J2": "resolve_speaker attribute_roles", "J3": "attribute_roles",
    "J4": "contains_join", "J5": "nearest_join", "J6": "match_index resolve_entities", "J7": "match_alias resolve_entities",
    "J8": "resolve_entities token_splits", "J9": "resolve_entities", "J10": "resolve_entities", "J11": "unresolved", "J12": "split_names",
    "J13": "unprocessed reachable", "J14": "emphasised classify_segments", "J15": "enrich_by_code", "A1": "dedup dedup_within", "A2": "compact latest_forecast run_latest",
    "A3": "merge_records merge_aggregates", "A4": "union_tagged", "A5": "union_tagged", "A6": "explode_roles", "A7": "pivot_levels", "A8": "merge_intervals interval_totals",
    "A9": "with_group_min", "A10": "series_stats merge_aggregates", "A11": "latest requeue_latest", "A12": "zip_pairs last_wins_map", "A13": "filled",
    "A14": "distinct_values", "W1": "fold_kv_runs", "W2": "segment_text register", "W3": "carry_forward running", "W4": "assemble_turns",
    "W5": "running", "W6": "segment_text assemble_turns", "W7": "case_split", "W8": "latest_forecast", "X1": "normalise", "X2": "title_case",
    "X3": "apply_flags", "X4": "clean_company", "X5": "lt_to_eur", "X6": "long_date_to_iso", "X7": "", "X8": "first_group all_matches regexp_extract",
    "X9": "rsplit_once", "X10": "split_part_strict split_part_safe", "X11": "host query_int path", "X12": "build_url redirect_target absolute",
    "X13": "strip_tone_accents", "X14": "header_param", "X15": "attachment_row", "X16": "packed_items", "X17": "tagged_title",
    "X18": "bracket_items", "X19": "first_acronym", "X20": "clock", "X21": "emphasis_head", "X22": "row_hash", "X23": "script_json from_json",
    "X24": "forecast_time clock date_format", "X25": "cast from_json", "X26": "clean_space extract_links extract_text decode_entities", "X27": "", "X28": "mayor_flag",
    "X29": "", "X30": "mercator_x", "X31": "centroid", "T1": "stream_captures stream_latest", "T2": "stream_latest run_latest", "T3": "stream_dedup dedup_within",
    "T4": "run_incremental run_partials", "T5": "mark_seen skip_to_end", "T6": "retain clean_log", "T7": "reachable extend", "T8": "overwrite_table",
    "U1": "strip_tone_accents", "U2": "register extract_text_without packed_items classify_segments", "U3": "latest run_incremental requeue_latest", "U4": "in_list",
}


def reached():
    """By function of the package: every name it reaches through functions of the package."""
    import ast
    from pathlib import Path

    uses = {}
    for file in Path(compare.__file__).parent.parent.joinpath("tablewright").rglob("*.py"):
        if "llm" in file.parts:
            continue
        for node in ast.walk(ast.parse(file.read_text(encoding="utf-8"))):
            if isinstance(node, ast.FunctionDef):
                named = {n.id for n in ast.walk(node) if isinstance(n, ast.Name)} | {n.attr for n in ast.walk(node) if isinstance(n, ast.Attribute)}
                uses.setdefault((file.parent.name == "plans", node.name), set()).update(named)
    out = {}
    for name in REGISTRY:
        seen, todo = set(), set(uses[True, name])
        while todo:
            one = todo.pop()
            if one not in seen:
                seen.add(one)
                todo |= uses.get((False, one), set()) | uses.get((True, one), set())
        out[name] = seen
    return out


def test_queries_reach_the_operators_they_claim():
    missed = [
        (name, op)
        for name, names in reached().items()
        for op in REGISTRY[name].ops
        if (wanted := OPERATORS[op].split()) and not names & set(wanted)
    ]
    assert missed == []


def test_every_operator_is_claimed():
    assert {op for q in REGISTRY.values() for op in q.ops} == set(OPERATORS)
