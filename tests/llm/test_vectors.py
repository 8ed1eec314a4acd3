import numpy as np
import pytest

from tablewright.llm import vectors as V

SCHEMA = "vec_id long, embedding array<float>, label int, row string, vec string, vector string, node long, n_links long, kept string, least long, dim int, copies long"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x", "x", "x", 0, 0, "x", 0, 0, 0) for i, v in rows], SCHEMA)


def brute(rows, threshold=0.9):
    def direction(v):
        if v is None or any(x is None for x in v):
            return None
        v = np.array(v, np.float32).astype(np.float64)
        return None if not np.isfinite(v).all() or not v.any() else v / np.linalg.norm(v)

    units = [direction(v) for _, v in rows]
    n = len(rows)
    links = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]):
                links[i, j] = units[i] @ units[j] >= threshold - 1e-12
    root = V.least_linked(links)
    ids = [i for i, _ in rows]
    out = []
    for k, (i, _) in enumerate(rows):
        group = [ids[j] for j in range(n) if root[j] == root[k] and ids[j] is not None]
        least = min(group) if group else None
        out.append((i, int(links[k].sum()), least, i == least))
    return out


def ours(spark, rows, **more):
    done = V.near_duplicates(table(spark, rows), **more)
    return [(r.vec, r.n_links, r.component_id, r.kept) for r in done.collect()]


def groups(rng, tight, single, dim=24):
    out = []
    for size in tight:
        centre = rng.normal(size=dim)
        out += [centre + rng.normal(size=dim) * 0.12 for _ in range(size)]
    return [*out, *rng.normal(size=(single, dim))]


def test_awkward_rows(spark):
    a, b = [1, 0, 0, 0.0], [0, 1, 0, 0.0]
    rows = [
        (1, a), (2, a), (2, a), (3, b), (4, [2, 0, 0, 0.01]), (5, None), (6, [0, 0, 0, 0]), (7, [1, None, 0, 0]),
        (8, [float("nan"), 1, 0, 0]), (9, [float("inf"), 1, 0, 0]), (10, [1, 0]), (11, [2, 0.1]), (12, []),
        (13, [-1, 0, 0, 0]), (14, [1e-30, 0, 0, 0]), (15, [-0.0, 3e38, 0.0, 0]), (16, [0.0, 3e38, 0, 0]), (None, None),
    ]
    assert sorted(ours(spark, rows), key=str) == sorted(brute(rows), key=str)


def test_empty_table(spark):
    assert ours(spark, []) == []
    assert ours(spark, [(1, None), (2, [0.0])]) == [(1, 0, 1, True), (2, 0, 2, True)]


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(spark, seed, monkeypatch):
    rng = np.random.default_rng(seed)
    rows = [(1000 - i, v) for i, v in enumerate(groups(rng, [60, 30, 7, 2, 2], 120))]
    rows += [(2000 + i, rows[0][1]) for i in range(40)]
    found, want = sorted(ours(spark, rows)), sorted(brute(rows))
    assert sum(r[1] for r in found) >= 0.99 * sum(r[1] for r in want)
    assert all(f[1] <= w[1] for f, w in zip(found, want, strict=True))
    assert sum(f == w for f, w in zip(found, want, strict=True)) >= 0.98 * len(rows)


def test_shards_and_blocks_lose_nothing(spark, monkeypatch):
    """Tiny shards: several centres, and a tight group far larger than a shard, cut into blocks."""
    monkeypatch.setattr(V, "SHARD_ROWS", 40)
    rng = np.random.default_rng(4)
    rows = list(enumerate(groups(rng, [150, 20, 3], 100)))
    found, want = sorted(ours(spark, rows)), sorted(brute(rows))
    assert sum(r[1] for r in found) >= 0.97 * sum(r[1] for r in want)
    assert sum(f[2] == w[2] for f, w in zip(found, want, strict=True)) >= 0.98 * len(rows)


def test_audit_tells_what_was_found(spark):
    rng = np.random.default_rng(7)
    rows = list(enumerate(groups(rng, [50, 5], 60)))
    recall = V.near_duplicates(table(spark, rows), audit=1000).select("recall").first()[0]
    assert 0.9 <= recall <= 1.0


def test_robust_prune_keeps_near_ones_and_drops_covered_ones():
    points = V.unit(np.array([[1, 0], [1, 0.05], [1, 0.1], [1, -0.3], [-1, 0.0]]))
    graph = V.robust_prune(points, near=4, degree=4)
    assert graph[0, 0] == 1 and 2 not in graph[0] and 3 in graph[0]


def test_range_search_never_goes_below_the_threshold():
    rng = np.random.default_rng(3)
    points = V.unit(np.array(groups(rng, [30, 30], 100)))
    graph = V.with_back_links(V.robust_prune(points))
    hits = V.range_search(points, points, graph, np.full(len(points), -1), 0.9)
    assert (points @ points.T)[hits].min() >= 0.9


def spread(rng, n, intrinsic=3, dim=16):
    return rng.normal(size=(n, intrinsic)) @ rng.normal(size=(intrinsic, dim))


def test_links_over_shard_borders_are_found(spark, monkeypatch):
    """Spread vectors in many small shards: two homes alone lose many of their links."""
    monkeypatch.setattr(V, "SHARD_ROWS", 40)
    rows = list(enumerate(spread(np.random.default_rng(11), 900)))
    nodes = V.distinct_vectors(table(spark, rows), "vec_id", "embedding").cache()
    held = V.fit_centres(nodes, 0.9)
    checked = V.Audit(nodes, held, 0.9, 300)
    units = V.unit(np.array([v for _, v in rows], np.float32))
    assert checked.total.sum() == sum(
        int((units @ V.unit(np.array([r.vector]))[0] >= 0.9).sum()) - 1
        for r in nodes.where(nodes.node.isin(checked.nodes)).collect()
    )
    assert len(next(iter(held.values()))) > 10 and checked.visits(0.98) > V.HOMES
    found, want = sorted(ours(spark, rows)), sorted(brute(rows))
    assert all(f[1] <= w[1] for f, w in zip(found, want, strict=True))
    assert np.mean([f[1] / w[1] for f, w in zip(found, want, strict=True) if w[1]]) >= 0.95
    assert [f[2] for f in found] == [w[2] for w in want]


def test_all_shards_and_whole_cells_find_every_link_once(spark, monkeypatch):
    monkeypatch.setattr(V, "SHARD_ROWS", 30)
    rows = list(enumerate(spread(np.random.default_rng(12), 400))) + [(900, [1.0] * 16), (901, [1.0] * 16)]
    found, want = sorted(ours(spark, rows, reach=1.1, least_recall=1.1)), sorted(brute(rows))
    assert found == want
