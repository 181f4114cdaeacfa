"""Near-duplicate vectors by a robust-pruned graph (operator 8).

Vectors with equal labels are linked where their cosine, in double precision, is at least
``COSINE``. Equal vectors are folded first: a group of copies is one point with a weight.

1. Shards: a label of more than ``SHARD_MOST`` points is clustered (k-means, fitted to a
   bounded sample of it), and so is each cluster that is still as large, level by level, so
   clusters grow in number with the label. A point goes to its nearest cluster and to the
   second one, unless that is so much further that no link can lead there. Centres nearer
   than ``APART`` link angles are made one, as a cut between them would part many links;
   a large cluster without three such centres is dealt into blocks, and every pair of
   blocks is a shard. So a shard is bounded however many points are alike.
2. Graph: each shard's graph grows by search. Points come in batches; a greedy search from
   the shard's medoids and some points drawn, in the graph so far, gives a batch's candidates, robust pruning
   keeps those that no kept one is closer to by ``ALPHA``, and links back are pruned
   likewise; at the end each point takes up to ``DEGREE`` more of those that lead to it, in
   random order. Points of a batch are compared with each other, not with all of the shard.
   The adjacency lists of a point from all its shards are united: a flat graph over
   overlapping shards.
3. Search: each point is searched in its shards: a greedy search with a beam starts at the
   shard's medoids and at the point itself; then the range expands: the neighbours of all
   found points down to ``SLACK`` below the threshold are visited until none is new.
4. Every link's cosine is verified as it is counted. A pair that meets in several shards
   is counted in one. Links are not sent out: a shard returns each point's number and a
   root of its local component; components are then joined by Spark.

``audit`` measures the recall of links against brute force, for all rows whose vec_id is
divisible by 20; the query returns it. Centres and places are tables: the driver sees
neither.

Vectors that are null, empty or zero, hold null or non-finite components, or have no
label link with nothing; vectors of different lengths don't link. A null vec_id counts as
a link but names no component; such a row is not kept unless it is alone, when it has a
null component. Repeated rows are links of each other. Extra columns are ignored; no rows
give no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultloom.llm.common import python_tasks, table
from vaultloom.llm.components import components
from vaultloom.sources.scratch import scratch_folder, written

COSINE = 0.98
SHARD_POINTS = 1000
SHARD_MOST = 3000
OVERLAP = 2
FANOUT = 64
LEVELS = 8
APART = 3
SAMPLED = 2048
DEALT_AT_ONCE = 8192
NEAREST = 40
DEGREE = 24
RANDOM_EDGES = 6
ALPHA = 1.2
BEAM = 32
SLACK = 0.02
MEDOIDS = 4
DRAWN = 24
AT_ONCE = 128
AUDITED = 4_096
_FINITE = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
_VALID = (f"label IS NOT NULL AND embedding IS NOT NULL AND {_FINITE}"
          " AND exists(embedding, x -> x <> 0)")


def _units(vectors) -> np.ndarray:
    """Rows of length one, in double precision, whatever their scale."""
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _centres(clusters: int, x: np.ndarray, apart: float) -> np.ndarray:
    """Centres of k-means by cosine, from a fixed start; none within ``apart`` of another."""
    rng = np.random.default_rng(5)
    centres = x[rng.permutation(len(x))[:clusters]]
    for rounds in (8, 2):
        for _ in range(rounds):
            nearest = (x @ centres.T).argmax(axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, nearest, x)
            size = np.linalg.norm(sums, axis=1, keepdims=True)
            centres = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
        kept: list[int] = []
        for i in range(len(centres)):
            if not kept or (centres[kept] @ centres[i]).max() < np.cos(apart):
                kept.append(i)
        centres = centres[kept]
    return centres


def _points(vectors: DataFrame, folder: str) -> DataFrame:
    """(point, label, dim, embedding, copies, first): distinct vectors that can link."""
    valid = vectors.filter(_VALID).groupBy("label", "embedding").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
    return written(valid.select(
        F.monotonically_increasing_id().alias("point"), "label", F.size("embedding").alias("dim"), "embedding",
        "copies", "first"), folder, "points")


_NODE = ["family", "node"]


def _fitted(members: DataFrame, angle: float) -> DataFrame:
    """(family, node, number, centre): centres of large clusters, each from a sample."""
    hashed = members.withColumn("h", F.xxhash64("point"))
    slots = hashed.groupBy(*_NODE, F.pmod("h", F.lit(SAMPLED)).alias("slot")).agg(F.min("h").alias("h"))
    sample = hashed.select(*_NODE, "n", "h", "embedding").join(slots.drop("slot"), [*_NODE, "h"])

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("h")
        clusters = min(FANOUT, -(-OVERLAP * int(rows["n"].iloc[0]) // SHARD_POINTS))
        centres = _centres(clusters, _units(rows["embedding"]), APART * angle)
        if len(centres) <= OVERLAP:  # a point would go to all of them
            centres = centres[:0]
        return pd.DataFrame({**{c: rows[c].iloc[0] for c in _NODE}, "number": range(len(centres)),
                             "centre": pd.Series(list(centres), dtype=object)})

    return sample.groupBy(*_NODE).applyInPandas(
        fit, "family long, node long, number int, centre array<double>")


def _nearest(points: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
    """The ``OVERLAP`` nearest new clusters of each point, with their angles."""
    if not len(points) or not len(centres):
        return pd.DataFrame({c: [] for c in ("point", "family", "angle", "node")})
    number = centres["number"].to_numpy()
    cos = _units(points["embedding"]) @ np.array(list(centres["centre"])).T
    near = np.argsort(-cos, axis=1, kind="stable")[:, :OVERLAP]
    own = points.iloc[np.repeat(np.arange(len(points)), near.shape[1])]
    angle = np.arccos(np.clip(np.take_along_axis(cos, near, axis=1), -1, 1))
    return pd.DataFrame({"point": own["point"], "family": own["family"], "angle": angle.ravel(),
                         "node": own["node"] * FANOUT + number[near].ravel() + 1})


def _clustered(points: DataFrame, folder: str, least: float) -> tuple[DataFrame, DataFrame]:
    """(point, family, leaves), one or two (angle, node) with the nearest first, and the
    number n of points of each (family, node). A family has one label and length. Each of
    ``LEVELS`` levels cuts the clusters that are still too large and can be cut; the rest is
    left to blocks."""
    link = float(np.arccos(least))
    families = written(points.groupBy("label", "dim").agg(F.min("point").alias("family")), folder, "families")
    places = written(points.select("point", "label", "dim").join(families, ["label", "dim"]).select(
        "point", "family", F.expr("array(named_struct('angle', 0D, 'node', 0L))").alias("leaves")), folder, "places")
    uncut = None
    for level in range(LEVELS + 1):
        each = places.select("point", "family", F.inline("leaves"))
        sizes = written(each.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n")), folder, f"sizes-{level}")
        large = sizes.filter(F.col("n") > SHARD_MOST)
        if uncut is not None:
            large = large.join(uncut, _NODE, "left_anti")
        if level == LEVELS or large.isEmpty():
            return places, sizes
        members = written(each.join(large, _NODE).join(points.select("point", "embedding"), "point"),
                          folder, f"members-{level}")
        centres = written(_fitted(members, link), folder, f"centres-{level}")
        cut = centres.select(*_NODE).distinct()
        left = large.join(cut, _NODE, "left_anti").select(*_NODE)
        uncut = written(left if uncut is None else uncut.unionByName(left), folder, f"uncut-{level}")
        parts = F.ceil(F.col("n") / DEALT_AT_ONCE).cast("int")
        salted = members.withColumn("part", F.pmod(F.xxhash64("point"), parts).cast("int"))
        copied = centres.join(large, _NODE).select(
            *_NODE, "number", "centre", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
        moved = salted.groupBy(*_NODE, "part").cogroup(copied.groupBy(*_NODE, "part")).applyInPandas(
            _nearest, "point long, family long, angle double, node long")
        stay = each.join(cut, _NODE, "left_anti")
        nearest = moved.unionByName(stay).groupBy("point", "family").agg(
            F.slice(F.sort_array(F.collect_list(F.struct("angle", "node"))), 1, OVERLAP).alias("leaves"))
        # a neighbour within the link angle is at most that much further from any centre
        places = written(nearest.withColumn("leaves", F.expr(
            f"filter(leaves, l -> l.angle <= leaves[0].angle + {2 * link + 1e-6}D)")), folder, f"places-{level}")


def _sharded(points: DataFrame, folder: str, least: float) -> DataFrame:
    """Points once for each shard (cluster, lower, upper); ``block`` is the point's block in
    that cluster, ``beside`` its other cluster or -1."""
    places, sizes = _clustered(points, folder, least)
    each = places.select("point", "family", F.expr("leaves.node").alias("nodes"), F.explode("leaves.node").alias("node"))
    beside = F.expr("coalesce(get(filter(nodes, c -> c <> node), 0), -1L)")
    blocked = (
        each.withColumn("beside", beside).join(sizes, _NODE)
        .withColumn("blocks", F.ceil(F.col("n") / SHARD_MOST).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("point"), F.col("blocks")).cast("int"))
        .join(points.select("point", "embedding", "copies"), "point"))
    return blocked.select("*", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other")).select(
        "family", F.col("node").alias("cluster"), F.least("block", "other").alias("lower"),
        F.greatest("block", "other").alias("upper"), "block", "beside", "point", "embedding", "copies")


def _medoids(x: np.ndarray) -> np.ndarray:
    """The point nearest the middle, and points far from those chosen."""
    spread = [int((x @ x.mean(axis=0)).argmax())]
    far = x @ x[spread[0]]
    while len(spread) < min(MEDOIDS, len(x)):
        spread.append(int(far.argmin()))
        far = np.maximum(far, x @ x[spread[-1]])
    return np.unique(spread)


def _robust(x: np.ndarray, rows: np.ndarray, cand: np.ndarray) -> np.ndarray:
    """Robust pruning: at most DEGREE of each row's candidates (-1: none), packed."""
    out = np.full((len(rows), DEGREE), -1, np.int32)
    for at in range(0, len(rows), AT_ONCE):
        c = cand[at:at + AT_ONCE]
        sims = np.where(c >= 0, np.einsum("qd,qcd->qc", x[rows[at:at + AT_ONCE]], x[c]), -2)
        order = np.argsort(-sims, axis=1, kind="stable")[:, :NEAREST]
        c, sims = np.take_along_axis(c, order, axis=1), np.take_along_axis(sims, order, axis=1)
        near, far = x[c], np.sqrt(np.maximum(0, 2 - 2 * sims))
        between = np.sqrt(np.maximum(0, 2 - 2 * (near @ near.transpose(0, 2, 1))))
        alive, degree, every = c >= 0, np.zeros(len(c), np.int64), np.arange(len(c))
        for j in range(c.shape[1]):
            take = alive[:, j] & (degree < DEGREE)
            out[at + every[take], degree[take]] = c[take, j]
            degree += take
            alive &= ~(take[:, None] & (ALPHA * between[:, j] < far))
    return out


def _back(x: np.ndarray, edges: np.ndarray, rows: np.ndarray) -> None:
    """Links from the new points' neighbours back to them, pruned where they are too many."""
    heads, tails = edges[rows, :DEGREE].ravel(), np.repeat(rows, DEGREE)
    heads, tails = heads[heads >= 0], tails[heads >= 0]
    order = np.lexsort((-_cosines(x, heads, tails), heads))
    heads, tails = heads[order], tails[order]
    targets, first = np.unique(heads, return_index=True)
    rank = np.arange(len(heads)) - np.repeat(first, np.diff(np.append(first, len(heads))))
    near = rank < DEGREE
    new = np.full((len(targets), DEGREE), -1, np.int32)
    new[np.searchsorted(targets, heads[near]), rank[near]] = tails[near]
    old = edges[targets, :DEGREE]
    new[(new[:, :, None] == old[:, None, :]).any(axis=2)] = -1
    both = np.concatenate((old, new), axis=1)
    both = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), axis=1)
    full = (both >= 0).sum(axis=1) > DEGREE
    edges[targets[~full], :DEGREE] = both[~full, :DEGREE]
    edges[targets[full], :DEGREE] = _robust(x, targets[full], both[full])


def grown(x: np.ndarray, seed: int = 3) -> list[np.ndarray]:
    """Neighbours of each of the points ``x`` (unit rows), inserted by search in batches."""
    n, rng, entries = len(x), np.random.default_rng(seed), _medoids(x)
    order = np.concatenate((entries, np.setdiff1d(rng.permutation(n), entries, assume_unique=True)))
    edges = np.full((n, DEGREE + RANDOM_EDGES), -1, np.int32)
    for at in range(0, n, AT_ONCE):
        rows = order[at:at + AT_ONCE]
        mates = x[rows] @ x[rows].T
        np.fill_diagonal(mates, -2)
        c = min(NEAREST, len(rows)) - 1
        cand = rows[np.argsort(-mates, axis=1, kind="stable")[:, :c]]
        if at:
            drawn = order[rng.integers(len(entries), at, (len(rows), DRAWN))]
            start = np.concatenate((np.broadcast_to(entries, (len(rows), len(entries))), drawn), axis=1)
            beam = walked(x, edges, x[rows], start)[0]
            cand = np.concatenate((beam, cand), axis=1)
        if cand.shape[1]:
            edges[rows, :DEGREE] = _robust(x, rows, cand)
            _back(x, edges, rows)
        far = order[rng.integers(0, at + len(rows), (len(rows), RANDOM_EDGES))]
        far[far == rows[:, None]] = -1
        edges[rows, DEGREE:] = far
    heads, tails = np.repeat(np.arange(n), edges.shape[1]), edges.ravel().astype(np.int64)
    heads, tails = heads[tails >= 0], tails[tails >= 0]
    order = rng.permutation(len(heads))  # so that points at a tight group's rim are led to as well
    order = order[np.argsort(tails[order], kind="stable")]
    rank = np.arange(len(order)) - np.searchsorted(tails[order], tails[order])
    back = order[rank < DEGREE]
    pairs = np.unique(np.concatenate((heads * n + tails, tails[back] * n + heads[back])))
    return np.split(pairs % n, np.searchsorted(pairs // n, np.arange(1, n)))


def _padded(lists: list[np.ndarray]) -> np.ndarray:
    out = np.full((len(lists), max(1, max(map(len, lists), default=1))), -1, np.int32)
    for i, x in enumerate(lists):
        out[i, :len(x)] = x
    return out


def _cosines(x: np.ndarray, q: np.ndarray, v: np.ndarray) -> np.ndarray:
    out = np.empty(len(q))
    for at in range(0, len(q), 1 << 15):
        part = slice(at, at + (1 << 15))
        out[part] = np.einsum("ij,ij->i", x[q[part]], x[v[part]])
    return out


def walked(x: np.ndarray, edges: np.ndarray, targets: np.ndarray, entries: np.ndarray):
    """Greedy search for ``targets`` from each one's ``entries``: the beams, the cosines of
    all points seen (-2: not seen), and which points were expanded."""
    width, n = len(targets), len(x)
    cos, open_ = np.full((width, n), -2.0), np.zeros((width, n), bool)
    beam = np.full((width, BEAM), -1, np.int64)
    sims, done = np.full((width, BEAM), -2.0), np.ones((width, BEAM), bool)
    e = min(BEAM, entries.shape[1])
    beam[:, :e], done[:, :e] = entries[:, :e], False
    sims[:, :e] = np.einsum("qd,qed->qe", targets, x[entries[:, :e]])
    np.put_along_axis(cos, beam[:, :e], sims[:, :e], axis=1)
    while True:  # expand each target's best open point of its beam
        best = np.where(done, -3, sims).argmax(axis=1)
        going = np.flatnonzero(~done[np.arange(width), best])
        if not len(going):
            return beam, cos, open_
        v = beam[going, best[going]]
        done[going, best[going]], open_[going, v] = True, True
        next_ = edges[v]
        fresh = (next_ >= 0) & (cos[going[:, None], next_] == -2)
        q, at = np.nonzero(fresh)
        found = np.full(next_.shape, -2.0)
        found[q, at] = np.einsum("id,id->i", targets[going[q]], x[next_[q, at]])
        cos[going[q], next_[q, at]] = found[q, at]
        ids = np.concatenate((beam[going], next_), axis=1)
        found = np.concatenate((sims[going], found), axis=1)
        over = np.concatenate((done[going], ~fresh), axis=1)
        top = np.argpartition(-found, BEAM - 1, axis=1)[:, :BEAM]
        sims[going] = np.take_along_axis(found, top, axis=1)
        beam[going] = np.where(sims[going] > -2, np.take_along_axis(ids, top, axis=1), -1)
        done[going] = np.take_along_axis(over, top, axis=1)


def searched(x: np.ndarray, edges: np.ndarray, queries: np.ndarray, entries: np.ndarray, least: float):
    """(query, point) pairs of cosine ``least`` or more that the graph search finds."""
    width, n = len(queries), len(x)
    others = np.broadcast_to(entries, (width, len(entries)))
    start = np.concatenate((np.where(others == queries[:, None], entries[0], others), queries[:, None]), axis=1)
    _, cos, open_ = walked(x, edges, x[queries], start)

    def visit(q: np.ndarray, v: np.ndarray):
        new = np.zeros((width, n), bool)
        new[q, v] = True
        q, v = np.nonzero(new & (cos == -2))
        cos[q, v] = _cosines(x, queries[q], v)

    while True:  # range: expand all points near the threshold or above it
        q, v = np.nonzero((cos >= least - SLACK) & ~open_)
        if not len(q):
            break
        open_[q, v] = True
        for at in range(0, len(q), 1 << 15):
            part = slice(at, at + (1 << 15))
            next_ = edges[v[part]].ravel()
            real = next_ >= 0
            visit(np.repeat(q[part], edges.shape[1])[real], next_[real])
    q, v = np.nonzero(cos >= least)
    other = queries[q] != v
    return q[other], v[other]


_SHARD = ["family", "cluster", "lower", "upper"]


def _build(shard: pd.DataFrame) -> pd.DataFrame:
    shard = shard.sort_values("point")
    ids = shard["point"].to_numpy()
    edges = grown(_units(shard["embedding"]))
    return pd.DataFrame({"point": ids, "near": [ids[e] for e in edges]})


def _search(least: float):
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("point").reset_index(drop=True)
        ids, x = shard["point"].to_numpy(), _units(shard["embedding"])
        cluster, block = int(shard["cluster"].iloc[0]), shard["block"].to_numpy()
        across = shard["lower"].iloc[0] != shard["upper"].iloc[0]
        other = shard["beside"].to_numpy()
        lists = []
        for near in shard["near"]:
            near = np.unique(np.asarray(near, np.int64))
            at = np.minimum(np.searchsorted(ids, near), len(ids) - 1)
            lists.append(at[ids[at] == near])
        edges = _padded(lists)
        entries = _medoids(x)
        met = np.zeros((len(ids), len(ids)), bool)
        for at in range(0, len(ids), AT_ONCE):
            queries = np.arange(at, min(len(ids), at + AT_ONCE))
            q, v = searched(x, edges, queries, entries, least)
            met[queries[q], v] = True
        met |= met.T  # a link found from one end is found
        weight, root, links = shard["copies"].to_numpy(), np.arange(len(ids)), np.zeros(len(ids), np.int64)
        for one in range(len(ids)):
            v = np.flatnonzero(met[one])
            own = ~((other[one] == other[v]) & (other[v] >= 0) & (other[v] < cluster))
            if across:
                own &= block[one] != block[v]
            links[one] = weight[v[own]].sum()
            both = np.unique(root[np.append(v[own], one)])
            if len(both) > 1:
                root[np.isin(root, both)] = both[0]
        return pd.DataFrame({"point": ids, "links": links, "root": ids[root]})

    return run


def linked(vectors: DataFrame, least: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row with vec_id, label, embedding."""
    python_tasks(vectors.sparkSession)
    folder = scratch_folder(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    points = _points(rows, folder)
    shards = written(_sharded(points, folder, least), folder, "shards")
    lists = shards.select(*_SHARD, "point", "embedding").groupBy(*_SHARD).applyInPandas(
        _build, "point long, near array<long>")
    graph = written(lists.groupBy("point").agg(
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), folder, "graph")
    found = written(
        shards.join(graph, "point").groupBy(*_SHARD).applyInPandas(_search(least), "point long, links long, root long"),
        folder, "found")
    roots = components(found.filter("point <> root").selectExpr("point AS a", "root AS b"))
    totals = found.groupBy("point").agg(F.sum("links").alias("links"))
    named = written(
        points.join(totals, "point").join(roots.withColumnRenamed("node", "point"), "point", "left").select(
            "label", "embedding", "first", (F.col("links") + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "point").alias("root")), folder, "named")
    firsts = written(named.groupBy("root").agg(F.min("first").alias("component_id")), folder, "firsts")
    classes = named.join(firsts, "root").select("label", "embedding", "n_links", "component_id")
    good = rows.filter(_VALID).join(classes, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    bad = rows.filter(f"NOT coalesce({_VALID}, false)").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def audit(vectors: DataFrame, result: DataFrame, least: float = COSINE, block: int = AUDITED) -> float:
    """Recall of links: those in ``result`` over those by brute force, of all rows whose
    vec_id is divisible by 20, against all rows. Blocks of about ``block`` such rows are
    sent to the tasks, one after the other; 1 where there is no link to find."""
    python_tasks(vectors.sparkSession)
    rows = vectors.filter(_VALID).select("vec_id", "label", "embedding")
    asked = rows.filter("vec_id % 20 = 0")
    blocks = max(1, -(-asked.count() // block))
    found = [_true_links(rows, asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == at), least) for at in range(blocks)]
    true = written(reduce(DataFrame.unionByName, filter(None, found), rows.limit(0).selectExpr("vec_id", "0L AS n")),
                   scratch_folder(vectors.sparkSession), "true")
    got = result.filter("vec_id % 20 = 0").groupBy("vec_id").agg(F.max("n_links").alias("got"))
    total = true.join(got, "vec_id").agg(F.sum(F.least("n", "got")), F.sum("n")).first()
    return total[0] / total[1] if total[1] else 1.0


def _true_links(rows: DataFrame, asked: DataFrame, least: float) -> DataFrame | None:
    """(vec_id, n) for a block of asked rows, by all cosines with the rows of their label."""
    asked = asked.toPandas()
    if not len(asked):
        return None
    ids, own = asked["vec_id"].to_numpy(), {}
    for (label, dim), at in asked.groupby(["label", asked["embedding"].map(len)]).indices.items():
        own[label, dim] = (at, _units(asked["embedding"].iloc[at]))

    def count(batches):
        for part in batches:
            n = np.zeros(len(ids), np.int64)
            for key, at in part.groupby(["label", part["embedding"].map(len)]).indices.items():
                if key in own:
                    n[own[key][0]] += (own[key][1] @ _units(part["embedding"].iloc[at]).T >= least).sum(axis=1)
            yield pd.DataFrame({"vec_id": ids, "n": n})[n > 0]

    return rows.mapInPandas(count, "vec_id long, n long").groupBy("vec_id").agg((F.sum("n") - 1).alias("n"))


def op8_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """With ``link_recall``, the audit's share of true links found, in every row."""
    vectors = table(spark, folder, "embeddings")
    found = written(linked(vectors), scratch_folder(spark), "linked")
    return found.withColumn("link_recall", F.lit(float(audit(vectors, found))))
