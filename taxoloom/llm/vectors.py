"""Near-duplicate vectors by a robust-pruned flat graph, built on overlapping cluster shards.

Vectors equal in every component are one class; classes are indexed. Each class joins the shards of its nearest
centres. A shard builds a graph (near and far candidates, robust pruning, reverse edges); the adjacency lists of a
class are united over its shards; a shard then searches the united graph from its medoids, first greedily
towards each member, then outwards as long as links are found. Links are verified in double precision.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from taxoloom.llm.common import connected_components, forget, materialize
from taxoloom.llm.simhash import cut, forest


@dataclass(frozen=True)
class Index:
    """``sample``: classes on which centres are fitted, in all and again in each first-level cluster; ``audit``: a share of 1 in so
    many classes is asked for its links by brute force; ``centres``: clusters of one level at most (there are two levels beyond)."""

    sample: int = 8192
    audit: int = 50
    enough: int = 30
    centres: int = 2048
    shard: int = 1000
    most: int = 4000
    overlap: int = 3
    near: int = 40
    far: int = 24
    degree: int = 20
    alpha: float = 1.2
    beam: int = 24
    medoids: int = 8


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def matrix(c: pa.Array) -> np.ndarray:
    c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
    return c.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(c), -1)


def centres(x: np.ndarray, k: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """Spherical k-means."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 1e-9, total / np.maximum(size, 1e-9), c)
    return c


def prune(x: np.ndarray, pool: np.ndarray, sim: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Robust pruning of each row's ``pool`` (indices, nearest first; ``sim`` their cosines), to ``degree`` or fewer; -1 pads.

    The nearest candidate left is kept, and those that it is nearer to by the factor ``alpha`` are struck out.
    """
    n, width = pool.shape
    alive = np.ones((n, width), bool)
    out = np.full((n, degree), -1, np.int64)
    rows = np.arange(n)
    far = 1 - sim
    for d in range(degree):
        pick = np.argmax(alive, axis=1)
        some = alive[rows, pick]
        if not some.any():
            break
        kept = pool[rows, pick]
        out[some, d] = kept[some]
        for lo in range(0, n, 512):
            r = slice(lo, lo + 512)
            between = 1 - np.einsum("nwd,nd->nw", x[pool[r]], x[kept[r]])
            alive[r] &= alpha * between > far[r]
        alive[rows, pick] = False
    return out


def build(x: np.ndarray, p: Index, seed: int = 0) -> list[np.ndarray]:
    """The adjacency of a shard's unit vectors (float32)."""
    n = len(x)
    if n < 2:
        return [np.zeros(0, np.int64)] * n
    rng = np.random.default_rng(seed)
    near = min(p.near, n - 1)
    tops = []
    for lo in range(0, n, 1024):
        s = x[lo : lo + 1024] @ x.T
        s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -2
        tops.append(np.argpartition(-s, near - 1, axis=1)[:, :near])
    edges = []
    for pool in (np.concatenate(tops), rng.integers(0, n, (n, min(p.far, n)))):
        sim = np.einsum("nwd,nd->nw", x[pool], x)
        order = np.argsort(-sim, axis=1)
        kept = prune(x, np.take_along_axis(pool, order, 1), np.take_along_axis(sim, order, 1), p.degree, p.alpha)
        a, slot = np.nonzero(kept >= 0)
        edges.append(np.stack([a, kept[a, slot]], 1))
    e = np.concatenate(edges)
    e = np.concatenate([e, e[:, ::-1]])
    e = np.unique(e[e[:, 0] != e[:, 1]], axis=0)
    return np.split(e[:, 1], np.searchsorted(e[:, 0], np.arange(1, n)))


def medoids(x: np.ndarray, k: int) -> np.ndarray:
    """The member nearest to the mean, then each time the one farthest from those chosen."""
    out = [int(np.argmax(x @ x.mean(axis=0)))]
    best = x @ x[out[0]]
    while len(out) < min(k, len(x)):
        out.append(int(np.argmin(best)))
        best = np.maximum(best, x @ x[out[-1]])
    return np.array(out)


def search(x: np.ndarray, adjacency: list[np.ndarray], threshold: float, p: Index) -> tuple[np.ndarray, np.ndarray]:
    """Pairs a < b of members with cosine >= threshold that the search finds, each member being a query."""
    n = len(x)
    width = max(1, max(map(len, adjacency)))
    nbr = np.full((n, width), -1, np.int64)
    for i, a in enumerate(adjacency):
        nbr[i, : len(a)] = a
    seen = np.zeros((n, n), bool)
    near = np.zeros((n, n), bool)
    low = np.float32(threshold - 1e-4)
    start = medoids(x, p.medoids)
    beam = min(max(p.beam, len(start)), n)
    ids = np.full((n, beam), -1, np.int64)
    sim = np.full((n, beam), -3, np.float32)
    done = np.ones((n, beam), bool)
    ids[:, : len(start)], sim[:, : len(start)], done[:, : len(start)] = start, x @ x[start].T, False
    seen[:, start] = True
    near[:, start] = sim[:, : len(start)] >= low
    active = np.arange(n)
    while len(active):
        for part in np.array_split(active, -(-len(active) * width // 40_000)):
            pick = np.argmax(np.where(done[part], -4, sim[part]), axis=1)
            done[part, pick] = True
            cand = nbr[ids[part, pick]]
            ok = cand >= 0
            ok[ok] = ~seen[np.repeat(part, width).reshape(ok.shape)[ok], cand[ok]]
            s = np.where(ok, np.einsum("nwd,nd->nw", x[np.maximum(cand, 0)], x[part]), np.float32(-3))
            q, w = np.nonzero(ok)
            seen[part[q], cand[q, w]] = True
            hit = s[q, w] >= low
            near[part[q[hit]], cand[q[hit], w[hit]]] = True
            all_sim = np.concatenate([sim[part], s], axis=1)
            top = np.argpartition(-all_sim, beam - 1, axis=1)[:, :beam]
            ids[part] = np.take_along_axis(np.concatenate([ids[part], cand], 1), top, 1)
            done[part] = np.take_along_axis(np.concatenate([done[part], ~ok], 1), top, 1)
            sim[part] = np.take_along_axis(all_sim, top, 1)
        active = active[~done[active].all(axis=1)]
    todo = np.flatnonzero(near)
    while len(todo):
        fresh = []
        for part in np.array_split(todo, -(-len(todo) * width // 400_000)):
            q, node = np.divmod(part, n)
            cand = nbr[node]
            ok = cand >= 0
            key = np.unique((q[:, None] * n + cand)[ok])
            key = key[~seen.ravel()[key]]
            seen.ravel()[key] = True
            a, b = np.divmod(key, n)
            hit = key[np.einsum("nd,nd->n", x[a], x[b]) >= low]
            near.ravel()[hit] = True
            fresh.append(hit)
        todo = np.concatenate(fresh)
    return np.nonzero(np.triu(near | near.T, 1))


def verified(v: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    norm = np.sqrt(np.einsum("nd,nd->n", v, v))
    out = np.zeros(len(a), bool)
    for lo in range(0, len(a), 1 << 16):
        i, j = a[lo : lo + (1 << 16)], b[lo : lo + (1 << 16)]
        out[lo : lo + (1 << 16)] = np.einsum("nd,nd->n", v[i], v[j]) / (norm[i] * norm[j]) >= threshold
    return out


def owned(shards: np.ndarray, part: np.ndarray, a: np.ndarray, b: np.ndarray, cluster: int, i: int, j: int) -> np.ndarray:
    """Whether this cell counts the pair: that of the least common cluster; in a divided cluster, for two of one part, that with the first other part."""
    out = np.zeros(len(a), bool)
    for lo in range(0, len(a), 1 << 16):
        x, y = shards[a[lo : lo + (1 << 16)]], shards[b[lo : lo + (1 << 16)]]
        common = (x[:, :, None] == y[:, None, :]).any(axis=2) & (x >= 0)
        out[lo : lo + (1 << 16)] = np.where(common, x, np.iinfo(np.int64).max).min(axis=1) == cluster
    if i != j:
        p, q = part[a], part[b]
        other = np.where(p == i, j, i)
        out &= (p != q) | (other == np.where(p == 0, 1, 0))
    return out


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, h, v)`` of the vectors that can link: ``v`` in double precision, ``h`` its hash."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    # Negative zeros are zeros.
    rows = vectors.select(F.col("vec_id").cast("long"), v.alias("embedding")).where(F.coalesce(fine, F.lit(False)))
    return rows.select("vec_id", F.transform("embedding", lambda x: x + F.lit(0.0)).alias("v")).withColumn("h", F.xxhash64("v"))


def classes(vectors: DataFrame) -> DataFrame:
    """``vectors(vec_id, embedding)`` -> ``(cid, h, v, dim, rep, n)`` of distinct usable vectors, as a table.

    ``cid`` is a number given on writing, so that no two classes share one, whatever their hashes.
    """
    grouped = usable(vectors).groupBy("h", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")).withColumn("dim", F.size("v"))
    return materialize(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")


def sampled(points: DataFrame, n: int) -> np.ndarray:
    return unit(matrix(points.orderBy("h", "v").select("v").limit(n).toArrow().column("v")))


def nearest(rows: DataFrame, c: np.ndarray, overlap: int) -> DataFrame:
    """Adds ``shards``: the ``overlap`` nearest of the centres ``c``."""
    c, own = c.astype(np.float32), rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                s = unit(matrix(b.column("v"))).astype(np.float32) @ c.T
                top = np.sort(np.argpartition(-s, min(overlap, len(c)) - 1, axis=1)[:, : min(overlap, len(c))], axis=1)
                yield pa.RecordBatch.from_arrays([*(b.column(x) for x in own), pa.array(top.astype(np.int64).tolist(), pa.list_(pa.int64()))], [*own, "shards"])

    return rows.mapInArrow(run, "cid long, h long, v array<double>, n long, shards array<long>")


def nearest_of_two_levels(points: DataFrame, k: int, p: Index, overlap: int) -> DataFrame:
    """As :func:`nearest`, with up to ``centres`` first-level clusters, each of which has centres of its own, fitted on a sample of its members.

    A vector is compared with the centres of its two nearest first-level clusters; the nearest ``overlap`` of all of these are its shards.
    """
    top = min(p.centres, int(np.ceil(np.sqrt(k))))
    inner = -(-k // top)
    first = materialize(nearest(points.select("cid", "h", "v", "n"), centres(sampled(points, p.sample), top), 2), "first")
    members = first.select(F.explode("shards").alias("t"), "cid", "h", "v", "n")
    order = Window.partitionBy("t").orderBy("h", "cid")
    drawn = members.withColumn("r", F.row_number().over(order)).where(F.col("r") <= min(p.sample, 8 * inner))

    def fit(key, t):
        c = centres(unit(matrix(t.sort_by([("h", "ascending"), ("cid", "ascending")]).column("v"))), inner)
        return pa.table({"t": pa.array([key[0].as_py()]), "centres": pa.array([c.ravel().tolist()], pa.list_(pa.float64()))})

    fitted = drawn.groupBy("t").applyInArrow(fit, "t long, centres array<double>")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, t = [], b.column("t").to_numpy()
            v = unit(matrix(b.column("v"))) if b.num_rows else np.zeros((0, 1))
            for i, j in zip(s := [0, *(np.flatnonzero(np.diff(t)) + 1).tolist()], [*s[1:], len(t)], strict=True):
                if i < j:
                    c = np.array(b.column("centres")[i].as_py()).reshape(-1, v.shape[1])
                    near = v[i:j] @ c.T
                    pick = np.argsort(-near, axis=1, kind="stable")[:, :overlap]
                    out += [[{"s": -float(near[r, x]), "k": int(t[i]) * inner + int(x)} for x in row] for r, row in enumerate(pick)]
            yield pa.RecordBatch.from_arrays([b.column("cid"), pa.array(out, pa.list_(pa.struct([("s", pa.float64()), ("k", pa.int64())])))], ["cid", "near"])

    seen = members.select("t", "cid", "v").join(fitted, "t").sortWithinPartitions("t").mapInArrow(best, "cid long, near array<struct<s: double, k: long>>")
    picked = seen.groupBy("cid").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, overlap).alias("near"))
    own = F.transform("near", lambda x: x["k"])
    return first.drop("shards").join(picked.select("cid", F.concat(own, F.array_repeat(F.lit(-1).cast("long"), overlap - F.size(own))).alias("shards")), "cid")


def shards(points: DataFrame, p: Index, overlap: int) -> DataFrame:
    """``(cluster, i, j, part, cid, v, n, shards)``: rows of a cell share the first three.

    There are as many clusters as make ``shard`` members each. A cluster of over ``most`` rows is cut into parts by hash; each two
    parts make a cell.
    """
    n = points.count()
    k = max(1, -(-n * overlap // p.shard))
    if k <= p.centres:
        near = nearest(points.select("cid", "h", "v", "n"), centres(sampled(points, p.sample), k), overlap)
    else:
        near = nearest_of_two_levels(points, k, p, overlap)
    return in_cells(materialize(near, "near"), p)


def in_cells(near: DataFrame, p: Index) -> DataFrame:
    members = near.select(F.explode("shards").alias("cluster"), "cid", "h", "v", "n", "shards").where("cluster >= 0")
    return cut(members, ["cluster"], F.xxhash64("h", "cid"), p.most).drop("h")


KEY = ["cluster", "i", "j"]


def linked(cells: DataFrame, threshold: float, find: Callable[[np.ndarray, pa.Table], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """``(cid, links, root)`` a class and cell; ``links`` counts other vectors, ``root`` is a class that links reach.

    ``find`` gives the pairs of a cell's unit vectors that may be links; they are verified, and counted in one cell each.
    """

    def look(key, t):
        t = t.sort_by("cid")
        ids, v = t.column("cid").to_numpy(), matrix(t.column("v"))
        a, b = find(unit(v).astype(np.float32), t)
        good = verified(v, a, b, threshold)
        a, b = a[good], b[good]
        own, part = matrix(t.column("shards")).astype(np.int64), t.column("part").to_numpy()
        good = owned(own, part, a, b, *(k.as_py() for k in key))
        a, b = a[good], b[good]
        n = t.column("n").to_numpy()
        count = np.zeros(len(ids), np.int64)
        np.add.at(count, a, n[b])
        np.add.at(count, b, n[a])
        some = np.flatnonzero(count)
        return pa.table({"cid": ids[some], "links": count[some], "root": ids[forest(a, b, len(ids))][some]})

    return cells.groupBy(*KEY).applyInArrow(look, "cid long, links long, root long")


def links(cells: DataFrame, threshold: float, p: Index) -> DataFrame:
    """Links found by searching the united graph of the cells' graphs."""

    def graph(key, t):
        t = t.sort_by("cid")
        ids = t.column("cid").to_numpy()
        near = build(unit(matrix(t.column("v"))).astype(np.float32), p)
        return pa.table({"cid": pa.array(ids), "nbrs": pa.array([ids[a].tolist() for a in near], pa.list_(pa.int64()))})

    def find(x: np.ndarray, t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids, lists = t.column("cid").to_numpy(), t.column("nbrs").combine_chunks()
        flat, size = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
        at = np.minimum(np.searchsorted(ids, flat), len(ids) - 1)
        mine = ids[at] == flat
        adjacency = np.split(at[mine], np.cumsum(np.bincount(np.repeat(np.arange(len(ids)), size)[mine], minlength=len(ids)))[:-1])
        return search(x, adjacency, threshold, p)

    lists = cells.groupBy(*KEY).applyInArrow(graph, "cid long, nbrs array<long>")
    united = lists.groupBy("cid").agg(F.array_distinct(F.flatten(F.collect_list("nbrs"))).alias("nbrs"))
    return linked(cells.join(united, "cid"), threshold, find)


def all_links(points: DataFrame, threshold: float, p: Index) -> DataFrame:
    """Links of all pairs, in cells of bounded size: the exact way where the index falls short."""

    def find(x: np.ndarray, t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        out = [np.zeros((2, 0), np.int64)]
        for lo in range(0, len(x), 256):
            a, b = np.nonzero(x[lo : lo + 256] @ x.T >= np.float32(threshold - 1e-4))
            out.append(np.stack([a + lo, b])[:, a + lo < b])
        return tuple(np.concatenate(out, axis=1))

    every = points.select("cid", "h", "v", "n", F.array(F.col("dim").cast("long")).alias("shards"))
    return linked(in_cells(every, p), threshold, find)


#: Bytes of query vectors that go to every task at once.
QUERY_BYTES = 32 << 20


def audit(points: DataFrame, found: DataFrame, threshold: float, p: Index) -> float | None:
    """The lesser of the recall of links and of the mean recall of the classes that have some, by comparing 1 class in ``audit`` with
    all classes by brute force, in blocks of queries. While few of these have links four times as many are asked; None if none has any.
    """
    share, n = p.audit, points.count()
    while True:
        asked = points.where(F.pmod(F.xxhash64(F.lit(1), "h", "cid"), F.lit(share)) == 0)
        width = asked.agg(F.count("*") * F.max("dim")).first()[0] or 0
        blocks = max(1, -(-8 * width // QUERY_BYTES))
        parts = [answers(points, asked.where(F.pmod(F.xxhash64(F.lit(2), "h", "cid"), F.lit(blocks)) == i), threshold) for i in range(blocks)]
        true = parts[0]
        for x in parts[1:]:
            true = true.unionAll(x)
        true = true.groupBy("cid").agg(F.sum("links").alias("real")).where("real > 0")
        got = found.groupBy("cid").agg(F.sum("links").alias("got"))
        had = F.coalesce("got", F.lit(0))
        row = true.join(got, "cid", "left").agg(F.sum("real"), F.sum(had), F.avg(had / F.col("real")), F.count("*")).first()
        if share == 1 or not n or row[3] >= p.enough:
            return min(row[1] / row[0], row[2]) if row[0] else None
        share = max(1, share // 4)


def answers(points: DataFrame, asked: DataFrame, threshold: float) -> DataFrame:
    """``(cid, links)``: of the asked classes, links with the classes of each batch."""
    ask = asked.select("cid", "dim", "v").toArrow()
    known = {}
    for d in set(ask.column("dim").to_pylist()):
        own = ask.filter(pc.equal(ask.column("dim"), d))
        known[d] = unit(matrix(own.column("v"))), own.column("cid").to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d in set(b.column("dim").to_pylist()) & set(known):
                own, (q, ids) = b.filter(pc.equal(b.column("dim"), d)), known[d]
                x, cid, n = unit(matrix(own.column("v"))), own.column("cid").to_numpy(), own.column("n").to_numpy()
                for lo in range(0, len(q), 256):
                    some = ids[lo : lo + 256]
                    near = (q[lo : lo + 256] @ x.T >= threshold) & (cid[None, :] != some[:, None])
                    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(near @ n)], ["cid", "links"])

    return points.select("cid", "dim", "v", "n").mapInArrow(run, "cid long, links long")


def found_links(points: DataFrame, threshold: float, p: Index, recall: float, one: bool) -> DataFrame:
    """Links of the classes, by the index while its audit holds. ``one``: each dimension is a cluster, else there is one dimension."""
    overlap = p.overlap
    while overlap <= 8 * p.overlap:
        near = in_cells(points.select("cid", "h", "v", "n", F.array(F.col("dim").cast("long")).alias("shards")), p) if one else shards(points, p, overlap)
        cells = materialize(near, "cells")
        found = materialize(links(cells, threshold, p), "links")
        forget(cells)
        seen = audit(points, found, threshold, p)
        if seen is None or seen >= recall:
            return found
        forget(found)
        if one:
            break
        overlap *= 2
    return materialize(all_links(points, threshold, p), "links")


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, p: Index = Index(), recall: float = 0.95) -> DataFrame:
    """``vectors(vec_id, embedding, ...)`` -> ``(vec_id, n_links, component_id, kept)``, a row a row.

    Vectors of different lengths don't link. Unusable vectors (null, empty, zero, or with null or non-finite
    components) link with nothing. A null vec_id is no component's name. Repeated rows are vectors that link. The index is built
    again with twice the overlap while the audit finds less than ``recall``, then all pairs are compared. Other columns are not read.
    """
    known = classes(vectors)
    sizes = known.groupBy("dim").count()
    # As many lengths as one likes that have a shard's classes or fewer; the driver sees those with more.
    large = [r[0] for r in sizes.where(F.col("count") > p.shard).select("dim").orderBy("dim").collect()]
    parts = [found_links(known.where(F.col("dim") == d), threshold, p, recall, False) for d in large]
    rest = known.where(~F.col("dim").isin(large))
    parts.append(found_links(rest, threshold, p, recall, True))
    found = parts[0]
    for f in parts[1:]:
        found = found.unionByName(f)
    comp = connected_components(found.select(F.col("cid").alias("src"), F.col("root").alias("dst")))
    total = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = known.select("cid", "rep", "n").join(comp.withColumnRenamed("node", "cid"), "cid", "left").join(total, "cid", "left")
    named = named.withColumn("component", F.coalesce("component", "cid"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    done = named.join(least, "component").select("cid", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "component_id")
    done = known.select("cid", "h", "v").join(done, "cid").drop("cid")
    every = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("e"))
    every = every.select("vec_id", F.transform("e", lambda x: x + F.lit(0.0)).alias("v")).withColumn("h", F.xxhash64("v"))
    out = every.join(done, ["h", "v"], "left").withColumn("component_id", F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
