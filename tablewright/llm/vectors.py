"""Near-duplicate vectors by a robust-pruned flat graph."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.session import write_once

from .components import stars
from .frames import col, packed

#: Rows a shard is meant to hold, and the most shards there can be: what is broadcast are the
#: shards' centres. Shards that grow beyond are cut into blocks of this many rows.
SHARD_ROWS, MOST_SHARDS = 1500, 4096
#: Rows the centres are fitted on.
SAMPLE_ROWS = 16_384
#: Shards a node is a member of; its list is pruned in each, and the lists are united.
HOMES = 2
#: How many of its nearest shards a node may be searched for in; the last stands for all.
VISITS = (2, 3, 4, 5, 6, 8, 12, 16, 24, 32, 64, 128, 256, 512, 1024, MOST_SHARDS)


def usable(vector: Column) -> Column:
    """True for a vector with a direction: no null or non-finite component, and not all zero."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision; scaled first so that no square overflows."""
    vectors = np.asarray(vectors, np.float64)
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def centres(sample: np.ndarray, most: int, threshold: float, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Unit centres by k-means; of centres closer than ``threshold`` one stays, so that a tight
    group of vectors does not lie in several shards."""
    rng = np.random.default_rng(seed)
    found = sample[rng.choice(len(sample), min(most, len(sample)), replace=False)]
    for _ in range(rounds):
        nearest = (sample @ found.T).argmax(1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        found = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), found)
    stays: list[int] = []
    for i in range(len(found)):
        if not stays or (found[stays] @ found[i]).max() < threshold:
            stays.append(i)
    return found[stays]


def robust_prune(vectors: np.ndarray, near: int = 40, degree: int = 16, alpha: float = 1.2) -> np.ndarray:
    """Out-neighbours of each vector among all of a block, padded with -1.

    Candidates are the nearest ``near``. The closest one is taken, and every candidate that is
    ``alpha`` times closer to it than to the vector itself is dropped, until ``degree`` are taken.
    """
    n = len(vectors)
    near = min(near, n - 1)
    out = np.full((n, degree), -1, np.int64)
    if near <= 0:
        return out
    for at in range(0, n, 256):
        block = vectors[at : at + 256]
        likeness = block @ vectors.T
        likeness[np.arange(len(block)), np.arange(at, at + len(block))] = -np.inf
        pool = np.argpartition(-likeness, near - 1, axis=1)[:, :near]
        score = np.take_along_axis(likeness, pool, 1)
        order = np.lexsort((pool, -score), axis=1)
        pool, score = np.take_along_axis(pool, order, 1), np.take_along_axis(score, order, 1)
        among = np.einsum("qid,qjd->qij", vectors[pool], vectors[pool])
        to_self = np.sqrt(np.maximum(0, 2 - 2 * score))
        to_each = np.sqrt(np.maximum(0, 2 - 2 * among))
        alive = np.ones(pool.shape, bool)
        rows = np.arange(len(block))
        for taken in range(degree):
            left = alive.any(1)
            first = alive.argmax(1)
            out[at + rows[left], taken] = pool[rows[left], first[left]]
            covered = alpha * to_each[rows, first] <= to_self
            alive &= ~covered
            alive[rows, first] = False
    return out


def with_back_links(graph: np.ndarray) -> np.ndarray:
    """Each vector's list, and behind it up to as many of the vectors that list it."""
    n, degree = graph.shape
    order = np.argsort(graph, axis=None, kind="stable")
    to = graph.ravel()[order]
    rank = np.arange(len(to)) - np.searchsorted(to, to)
    take = (to >= 0) & (rank < degree)
    back = np.full((n, degree), -1, np.int64)
    back[to[take], rank[take]] = order[take] // degree
    return np.concatenate([graph, back], 1)


def medoids(vectors: np.ndarray, many: int = 16) -> np.ndarray:
    """Entry points: the vector nearest to the mean, then each time the one least like all so far."""
    chosen = [int((vectors @ vectors.mean(0)).argmax())]
    best = vectors @ vectors[chosen[0]]
    while len(chosen) < min(many, len(vectors)):
        chosen.append(int(best.argmin()))
        best = np.maximum(best, vectors @ vectors[chosen[-1]])
    return np.array(chosen)


def range_search(
    queries: np.ndarray, vectors: np.ndarray, graph: np.ndarray, own: np.ndarray, threshold: float, beam: int = 24
) -> np.ndarray:
    """Which vectors each query finds within ``threshold``, as a boolean matrix.

    Greedy search walks the graph from the medoids, always from the best vector not yet walked
    from, keeping a list of ``beam``; queries that are vectors of the graph themselves (``own``,
    else -1) also start there. Then the search expands over the range: it goes on from every
    vector found within the threshold until none of their neighbours is new. All of that is done
    for a few hundred queries at a time, in one array operation per step.
    """
    n = len(vectors)
    found = np.zeros((len(queries), n), bool)
    entry = medoids(vectors)
    padded = np.vstack([vectors, np.zeros((1, vectors.shape[1]))])  # neighbour -1 is like nothing
    for at in range(0, len(queries), 256):
        q = queries[at : at + 256]
        rows = np.arange(len(q))
        seen = np.zeros((len(q), n + 1), bool)
        seen[:, n] = True
        ids = np.concatenate([np.broadcast_to(entry, (len(q), len(entry))), own[at : at + 256, None]], 1)
        ids = np.where(ids < 0, n, ids)
        ids[:, -1] = np.where((ids[:, :-1] == ids[:, -1:]).any(1), n, ids[:, -1])
        score = np.einsum("qd,qkd->qk", q, padded[ids])
        score[ids == n] = -np.inf
        seen[rows[:, None], ids] = True
        done = ids == n
        hit = found[at : at + len(q)]

        def note(ids: np.ndarray, score: np.ndarray, hit: np.ndarray = hit, rows: np.ndarray = rows) -> None:
            r, k = np.nonzero(score >= threshold)
            hit[rows[r], ids[r, k]] = True

        note(ids, score)
        for _ in range(4 * beam):
            open_score = np.where(done, -np.inf, score)
            best = open_score.argmax(1)
            going = open_score[rows, best] > -np.inf
            if not going.any():
                break
            done[rows, best] = True
            more = np.where(going[:, None], graph[ids[rows, best] % n], n)
            more = np.where(more < 0, n, more)
            more.sort(1)
            more[:, 1:][more[:, 1:] == more[:, :-1]] = n
            more = np.where(seen[rows[:, None], more], n, more)
            seen[rows[:, None], more] = True
            new = np.einsum("qd,qkd->qk", q, padded[more])
            new[more == n] = -np.inf
            note(more, new)
            ids, score = np.concatenate([ids, more], 1), np.concatenate([score, new], 1)
            done = np.concatenate([done, more == n], 1)
            order = np.argsort(-score, axis=1, kind="stable")[:, :beam]
            ids, score, done = (np.take_along_axis(x, order, 1) for x in (ids, score, done))
        _expand(q, vectors, graph, seen, hit, threshold)
    return found


def _expand(q: np.ndarray, vectors: np.ndarray, graph: np.ndarray, seen: np.ndarray, hit: np.ndarray, threshold: float) -> None:
    """Go on from every vector in range until nothing new is met; marks ``hit``."""
    n = len(vectors)
    front = hit.copy()
    while front.any():
        r, v = np.nonzero(front)
        reached = np.zeros((len(q), n + 1), bool)
        reached[r[:, None], np.where(graph[v] < 0, n, graph[v])] = True
        r, v = np.nonzero(reached & ~seen)
        seen[r, v] = True
        front = np.zeros_like(hit)
        for at in range(0, len(r), 1 << 16):
            some = slice(at, at + (1 << 16))
            near = np.einsum("kd,kd->k", q[r[some]], vectors[v[some]]) >= threshold
            front[r[some][near], v[some][near]] = True
        hit |= front


def least_linked(links: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links, the first row of its component."""
    return _first_of_component(*np.nonzero(links), len(links))


def _first_of_component(one: np.ndarray, other: np.ndarray, n: int) -> np.ndarray:
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, one, root[other])
        np.minimum.at(new, other, root[one])
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def _stack(column: pd.Series) -> np.ndarray:
    return unit(np.stack([np.asarray(v, np.float64) for v in column]))


def nearest_shards(vector: Column, held: dict[int, np.ndarray], most: int) -> Column:
    """The ``most`` shards with the nearest centres, nearest first, for a vector of as many components."""

    @F.pandas_udf("array<int>")
    def nearest(vectors: pd.Series) -> pd.Series:
        out = pd.Series([[]] * len(vectors), index=vectors.index, dtype=object)
        for size, rows in vectors.groupby(vectors.map(len)):
            order = _by_likeness(_stack(rows) @ held[size].T)[:, :most] if size in held else np.zeros((len(rows), 1), int)
            for i, o in zip(rows.index, order.tolist(), strict=True):
                out[i] = o
        return out

    return nearest(vector)


def _by_likeness(score: np.ndarray) -> np.ndarray:
    return np.argsort(-score, axis=1, kind="stable")


def fit_centres(nodes: DataFrame, threshold: float) -> dict[int, np.ndarray]:
    """Centres of the shards for each length of vectors, fitted on ``SAMPLE_ROWS`` nodes."""
    total = nodes.count()
    sample = nodes.orderBy(F.xxhash64("vector"), "node").limit(SAMPLE_ROWS).select("dim", "vector").toPandas()
    return {
        int(dim): centres(_stack(rows["vector"]), min(MOST_SHARDS, max(1, -(-2 * total // SHARD_ROWS))), threshold)
        for dim, rows in sample.groupby("dim")
    }


def shard_of(nodes: DataFrame, held: dict[int, np.ndarray], visits: int = HOMES) -> DataFrame:
    """Each node once for each of its ``visits`` nearest shards: ``dim``, ``shard``, ``visited``
    (all of them, nearest first), ``member`` (it is one of the first ``HOMES``), ``block`` and
    ``blocks`` (into how many the shard is cut, so that a block stays small in memory)."""
    laid = (
        nodes.withColumn("visited", nearest_shards(F.col("vector"), held, max(HOMES, visits)))
        .select("node", "dim", "vector", "copies", "visited", F.posexplode("visited").alias("at", "shard"))
        .withColumn("member", F.col("at") < HOMES)
        .drop("at")
    )
    blocks = laid.groupBy("dim", "shard").agg(
        F.greatest(F.ceil(F.count_if("member") / (2 * SHARD_ROWS)), F.ceil(F.count("*") / (8 * SHARD_ROWS)))
        .cast("int")
        .alias("blocks")
    )
    return laid.join(blocks, ["dim", "shard"]).withColumn(
        "block", F.pmod(F.xxhash64("node", "shard"), F.col("blocks")).cast("int")
    )


def build_graph(laid: DataFrame) -> DataFrame:
    """Adjacency lists (``node``, ``near``): one robust-pruned graph per block, lists united."""

    def built(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", ignore_index=True)
        graph = with_back_links(robust_prune(_stack(rows["vector"])))
        names = rows["node"].to_numpy()
        return pd.DataFrame({"node": names, "near": [names[g[g >= 0]] for g in graph]})

    lists = laid.where("member").select("node", "dim", "shard", "block", "vector").groupBy("dim", "shard", "block").applyInPandas(
        built, "node long, near array<long>"
    )
    return lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def _graph_of(names: np.ndarray, near: pd.Series) -> np.ndarray:
    """The lists as row numbers of ``names`` (ascending), padded with -1; others are left out."""
    lists = [np.asarray(x, np.int64) for x in near]
    out = np.full((len(names), max(1, max(map(len, lists), default=1))), -1, np.int64)
    for i, x in enumerate(lists):
        at = np.searchsorted(names, x)
        known = names[np.minimum(at, len(names) - 1)] == x
        out[i, : known.sum()] = at[known]
    return out


def compared_before(visited: list[np.ndarray], shard: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 0/1 matrices, homes and visits, of rows by the shards before ``shard``.

    A pair is also compared in an earlier shard if one of them visits a home of the other there.
    """
    known = sorted({int(t) for v in visited for t in v if t < shard})
    at = {t: i for i, t in enumerate(known)}
    homes = np.zeros((len(visited), len(known)), np.float32)
    visits = np.zeros_like(homes)
    for i, v in enumerate(visited):
        for rank, t in enumerate(v):
            if t < shard:
                visits[i, at[int(t)]] = 1
                homes[i, at[int(t)]] = rank < HOMES
    return homes, visits


def search_cells(laid: DataFrame, graph: DataFrame, threshold: float, *, whole: bool = False) -> DataFrame:
    """Links found, as (``node``, ``links``, ``root``) for each cell: how many other vectors the
    node links with there, and the first node of its component there.

    A cell is a pair of blocks of one shard (mostly a shard is one block). Members and visitors
    are searched for among the members. A pair that several shards compare counts in the first
    of them only, so links are never handed around in pairs. ``whole`` compares the rows of a
    cell with its members one by one instead of walking the graph.
    """
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda b: F.struct(F.least(b, F.col("block")).alias("low"), F.greatest(b, F.col("block")).alias("high")),
    )
    celled = laid.join(graph, "node").withColumn("cell", F.explode(pairs))

    def searched(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", ignore_index=True)
        low, high = rows["low"].iloc[0], rows["high"].iloc[0]
        names, vectors = rows["node"].to_numpy(), _stack(rows["vector"])
        copies, shard = rows["copies"].to_numpy(np.int64), rows["shard"].iloc[0]
        member = rows["member"].to_numpy(bool)
        column = np.cumsum(member) - 1  # where a member lies among the members
        members = np.flatnonzero(member)
        links = np.zeros((len(rows), len(members)), bool)
        for side in {low, high}:
            there = np.flatnonzero((rows["block"] == side) & member)
            asking = np.flatnonzero((rows["block"] != side) | (low == high))
            if not len(there) or not len(asking):
                continue
            if whole:
                for at in range(0, len(asking), 512):
                    some = asking[at : at + 512]
                    links[np.ix_(some, column[there])] = vectors[some] @ vectors[there].T >= threshold
                continue
            graph = _graph_of(names[there], rows["near"].iloc[there])
            own = np.where(member[asking], np.searchsorted(there, asking), -1) if low == high else np.full(len(asking), -1)
            links[np.ix_(asking, column[there])] = range_search(vectors[asking], vectors[there], graph, own, threshold)
        links[members] |= links[members].T
        links[members, np.arange(len(members))] = False
        one, other = np.nonzero(links)
        root = names[_first_of_component(one, members[other], len(rows))]
        homes, visits = compared_before(list(rows["visited"]), shard)
        for at in range(0, len(rows), 512):
            some = slice(at, at + 512)
            links[some] &= (homes[some] @ visits[members].T + visits[some] @ homes[members].T) == 0
        counted = np.concatenate([links[at : at + 512] @ copies[members] for at in range(0, len(rows), 512)])
        guests = np.flatnonzero(~member)
        for at in range(0, len(guests), 512):
            some = guests[at : at + 512]
            counted[members] += copies[some] @ links[some]
        return pd.DataFrame({"node": names, "links": counted, "root": root})

    keep = celled.select(
        "node", "dim", "shard", "visited", "member", "vector", "copies", "block",
        F.when(F.col("member"), F.col("near")).alias("near"),
        F.col("cell.low").alias("low"), F.col("cell.high").alias("high"),
    )
    return keep.groupBy("dim", "shard", "low", "high").applyInPandas(searched, "node long, links long, root long")


def distinct_vectors(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Usable vectors once each, numbered: ``node``, ``dim``, ``vector``, ``copies``, ``least``."""
    named = packed(vectors, vec=col(vec_id), vector=col(vector).cast("array<double>")).drop("row")
    classes = named.where(usable(F.col("vector"))).groupBy("vector").agg(
        F.count("*").alias("copies"), F.min("vec").alias("least")
    )
    return write_once(
        classes.select(F.monotonically_increasing_id().alias("node"), F.size("vector").alias("dim"), "*"), "vectors"
    )


def near_duplicates(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.9,
    audit: int = 1000,
    reach: float = 0.98,
    least_recall: float = 0.9,
) -> DataFrame:
    """Link vectors whose cosine is at least ``threshold``.

    Returns one row per vector: ``row`` (the input row as a struct), ``vec``, ``n_links`` (other
    rows linked directly), ``component_id`` (smallest id reachable), ``kept`` and ``recall`` (see
    :class:`Audit`; null without usable vectors).

    Equal vectors are one node with its number of copies. Nodes are members of the shards of their
    two nearest centres, which are fitted on a bounded sample; each shard's graph is robust-pruned,
    the lists of a node are united, and every node is searched for in the shards it lies in and in
    as many further ones as it takes: ``audit`` nodes are compared with all rows, and the number of
    shards to visit is the least that reaches the share ``reach`` of their links, all shards if
    need be. So the losses over shard borders do not grow with the rows. If the search itself then
    finds less than ``least_recall`` of the audited links, cells are compared row by row instead.
    Links are verified in double precision as they are found, so none is below the threshold.

    * Vectors that are null, zero, or hold null or non-finite components link with nothing and
      are components of their own. Vectors of different length do not link.
    * Rows that repeat an id each link with what their vector links with.
    * A row without an id is linked and counted; it gives no component its name.
    * An empty table gives an empty result.
    """
    nodes = distinct_vectors(vectors, vec_id, vector)
    held = fit_centres(nodes, threshold)
    checked = Audit(nodes, held, threshold, audit)
    laid = write_once(shard_of(nodes, held, checked.visits(reach)), "shards")
    graph = build_graph(laid)
    judged = join_cells(nodes, write_once(search_cells(laid, graph, threshold), "cells"))
    recall = checked.recall(judged)
    if recall is not None and recall < least_recall:
        judged = join_cells(nodes, write_once(search_cells(laid, graph, threshold, whole=True), "cells"))
        recall = checked.recall(judged)
    named = packed(vectors, vec=col(vec_id), vector=col(vector).cast("array<double>"))
    sound = F.when(usable(F.col("vector")), F.col("vector"))
    return (
        named.withColumn("vector", sound)
        .join(judged.drop("node", "others"), "vector", "left")
        .select(
            "row",
            "vec",
            F.coalesce("links", F.lit(0)).alias("n_links"),
            F.coalesce(F.when(F.col("vector").isNotNull(), F.col("component")), F.col("vec")).alias("component_id"),
            F.lit(recall).cast("double").alias("recall"),
        )
        .withColumn("kept", F.col("vec").eqNullSafe(F.col("component_id")))
    )


def join_cells(nodes: DataFrame, cells: DataFrame) -> DataFrame:
    """What the cells found, per node: ``vector``, ``links`` and ``component``."""
    roots = stars(cells.select(F.col("node").alias("a"), F.col("root").alias("b")))
    found = (
        nodes.join(cells.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    least = found.groupBy("root").agg(F.min("least").alias("component"))
    return found.join(least, "root").select(
        "node", "vector", F.col("links").alias("others"),
        (F.col("links") + F.col("copies") - 1).alias("links"), "component",
    )


class Audit:
    """The true links of ``queries`` nodes, those with the smallest hash, by brute force.

    They are compared with all rows in one pass. Only they are sent to the tasks, and what comes
    back is, for each of them, how many links a given number of visited shards reaches.
    """

    def __init__(self, nodes: DataFrame, held: dict[int, np.ndarray], threshold: float, queries: int) -> None:
        chosen = nodes.orderBy(F.xxhash64("vector"), "node").limit(queries).select("node", "dim", "vector").toPandas()
        self.nodes = [int(n) for n in chosen["node"]]
        asked = {int(dim): (rows["node"].to_numpy(), _stack(rows["vector"])) for dim, rows in chosen.groupby("dim")}
        orders = {dim: _by_likeness(v @ held[dim].T) for dim, (_, v) in asked.items()}
        ranks = {dim: np.argsort(order, axis=1) for dim, order in orders.items()}

        def counted(batches):
            for rows in batches:
                out = []
                for dim, (names, queries) in asked.items():
                    at = np.flatnonzero(rows["dim"] == dim)
                    if not len(at):
                        continue
                    here, there = _stack(rows["vector"].iloc[at]), rows["node"].to_numpy()[at]
                    r, q = np.nonzero(here @ queries.T >= threshold)
                    others = there[r] != names[q]
                    r, q = r[others], q[others]
                    linked, r_at = np.unique(r, return_inverse=True)
                    order = _by_likeness(here[linked] @ held[dim].T)
                    rank = np.argsort(order, axis=1)
                    need = np.minimum(
                        ranks[dim][q[:, None], order[r_at][:, :HOMES]].min(1, initial=MOST_SHARDS),
                        np.take_along_axis(rank[r_at], orders[dim][q][:, :HOMES], 1).min(1, initial=MOST_SHARDS),
                    )
                    level = np.searchsorted(VISITS, np.minimum(need + 1, MOST_SHARDS))
                    out.append(pd.DataFrame({"node": names[q], "level": level, "n": rows["copies"].to_numpy()[at][r]}))
                if out:
                    yield pd.concat(out).groupby(["node", "level"], as_index=False)["n"].sum()

        self.true = pd.DataFrame({"node": [], "level": [], "n": []})
        if self.nodes:
            links = nodes.select("node", "dim", "vector", "copies").mapInPandas(counted, "node long, level long, n long")
            self.true = links.groupBy("node", "level").agg(F.sum("n").alias("n")).toPandas()
        self.total = self.true.groupby("node")["n"].sum()

    def visits(self, reach: float) -> int:
        """The least number of visited shards that reaches this share of the links, on average over the nodes."""
        for level, visits in enumerate(VISITS):
            reached = self.true[self.true["level"] <= level].groupby("node")["n"].sum()
            if not len(self.total) or (reached.reindex(self.total.index, fill_value=0) / self.total).mean() >= reach:
                return visits
        return MOST_SHARDS

    def recall(self, judged: DataFrame) -> float | None:
        """The share of its true links that was found, on average over the nodes that have any."""
        if not self.nodes:
            return None
        keys = judged.sparkSession.createDataFrame([(n,) for n in self.nodes], "node long")
        found = judged.join(F.broadcast(keys), "node").select("node", F.col("others").alias("links")).toPandas()
        if not len(self.total):
            return 1.0
        return float((found.set_index("node")["links"].reindex(self.total.index) / self.total).mean())
