"""Exact inner-product top-k: ball-tree branch and bound over shards of candidates.

Queries go to the tasks in blocks of at most QUERY_BYTES, one pass over the candidates a
block, so what is sent at once is bounded. A task builds a ball tree over each SHARD_ROWS
of its candidates. A ball with centre c and radius r can hold no score above q.c + |q| r;
a query keeps a frontier of balls, opens the one with the highest bound, and stops when
that falls below its current k-th score: what is left on the frontier is cut with all that
lies below it, and no bound of it is ever computed. All queries of a block step together.
The k-th score is shared: from shard to shard within a task, and, from a first search of
one SEED_SHARE-th of the candidates, among all tasks. The first search only sets bounds;
every candidate is then searched or excluded by a bound.

Components become floor(1024 * x). Scores are integers: products are summed in doubles
where they stay exact, else in 64-bit integers, else in unbounded ones; a score beyond 64
bits is shown as the nearest 64-bit number.

Defined cases: vectors null or with null or non-finite components, and null vec_ids, take
no part; vectors of different lengths aren't compared; every row is a row of its own, so
one that repeats a query's vec_id is a candidate to it, and a query that stands twice is
answered twice; fewer candidates than k are all returned.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.llm.common import stored

K = 10
SCALE = 1024.0
#: Bytes of the queries of one block, and most queries that step together.
QUERY_BYTES, STEP_ROWS = 32_000_000, 2048
SHARD_ROWS, LEAF = 8192, 64
SEED_SHARE = 32
_LEAST = np.iinfo(np.int64).min


def whole(vectors: list[np.ndarray]) -> np.ndarray:
    """Rows of floor(SCALE * x): doubles, which hold them exactly below 2**53, else Python's integers."""
    out = np.floor(np.asarray(vectors, dtype=np.float64) * SCALE)
    return out if np.abs(out).max(initial=0) < 2**53 else np.array([[int(x) for x in v] for v in out], dtype=object).reshape(out.shape)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of a with all of b, as 64-bit integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    full = np.array([[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a], dtype=object).reshape(len(a), len(b))
    return np.clip(full, _LEAST + 1, np.iinfo(np.int64).max).astype(np.int64)


class BallTree:
    """Balls over rows of vectors, split at the median between two far points; node 0 holds all."""

    def __init__(self, vectors: np.ndarray):
        near = vectors.astype(np.float64)
        self.most = float(np.sqrt((near**2).sum(axis=1)).max(initial=0))
        centres, radii, self.children, self.rows = [], [], [], []
        open_ = [(np.arange(len(vectors)), -1)]
        while open_:
            rows, parent = open_.pop()
            x, me = near[rows], len(centres)
            centre = x.mean(axis=0)
            away = np.sqrt(((x - centre) ** 2).sum(axis=1))
            centres.append(centre)
            radii.append(float(away.max()))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(me)
            if len(rows) <= LEAF or away.max() == 0:
                self.rows.append(rows)
                continue
            self.rows.append(None)
            one = x[away.argmax()]
            two = x[((x - one) ** 2).sum(axis=1).argmax()]
            order = np.argsort(x @ (two - one), kind="stable")
            half = len(rows) // 2
            open_ += [(rows[order[:half]], me), (rows[order[half:]], me)]
        self.centres, self.radii = np.array(centres), np.array(radii)

    def bounds(self, node: int, queries: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores that each query can have in a node, with room for rounding."""
        return queries @ self.centres[node] + norms * self.radii[node] + 1 + 1e-9 * norms * self.most


class Best:
    """The k best (score, id) of each query so far, and lower bounds from elsewhere."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, floor: np.ndarray, k: int):
        self.ids, self.vectors, self.floor, self.k = ids, vectors, floor.copy(), k
        self.near = vectors.astype(np.float64)
        self.norms = np.sqrt((self.near**2).sum(axis=1))
        self.score = np.full((len(ids), k), _LEAST)
        self.row = np.zeros((len(ids), k), np.int64)
        self.opened = self.bounded = 0

    def search(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Take in a shard of candidates."""
        tree = BallTree(vectors)
        for lo in range(0, len(self.ids), STEP_ROWS):
            self._descend(tree, np.arange(lo, min(lo + STEP_ROWS, len(self.ids))), ids, vectors)

    def _descend(self, tree: BallTree, qs: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Best-first search of some queries: each opens the ball of its frontier with the highest bound."""
        frontier = np.full((len(qs), len(tree.radii)), -np.inf)
        frontier[:, 0] = tree.bounds(0, self.near[qs], self.norms[qs])
        active = np.arange(len(qs))
        while True:
            best = frontier[active].argmax(axis=1)
            go = frontier[active, best] >= self.floor[qs[active]]
            active, best = active[go], best[go]
            if not len(active):
                return
            upper = frontier[active, best]
            frontier[active, best] = -np.inf
            self.opened += len(active)
            order = np.argsort(best, kind="stable")
            edge = np.concatenate([[0], np.flatnonzero(np.diff(best[order])) + 1, [len(order)]])
            for a, b in zip(edge[:-1], edge[1:]):
                node, at = int(best[order[a]]), order[a:b]
                who = qs[active[at]]
                if tree.rows[node] is not None:
                    rows = tree.rows[node]
                    self._merge(who, ids[rows], vectors[rows])
                for child in tree.children[node]:
                    # a ball lies in its parent's, whatever its own centre and radius say
                    frontier[active[at], child] = np.minimum(tree.bounds(child, self.near[who], self.norms[who]), upper[at])
                    self.bounded += len(at)

    def _merge(self, qs: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        score = products(self.vectors[qs], vectors)
        hidden = score < self.floor[qs][:, None]
        for q, c in zip(*np.nonzero(ids[None, :] == self.ids[qs][:, None])):
            hidden[q, c] |= bool((vectors[c] == self.vectors[qs[q]]).all())  # the query's own row; top_k() adds those like it
        score = np.where(hidden, _LEAST, score)
        better = (score > _LEAST).any(axis=1)
        qs, score = qs[better], score[better]
        if not len(qs):
            return
        score = np.concatenate([self.score[qs], score], axis=1)
        row = np.concatenate([self.row[qs], np.broadcast_to(ids, (len(qs), len(ids)))], axis=1)
        order = np.lexsort((row, ~score), axis=1)[:, : self.k]  # ~: downwards, without overflow
        self.score[qs], self.row[qs] = np.take_along_axis(score, order, 1), np.take_along_axis(row, order, 1)
        self.floor[qs] = np.maximum(self.floor[qs], self.score[qs, -1])


def usable(vectors: DataFrame) -> DataFrame:
    """The rows (vec_id, embedding) that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)


def _searched(candidates: DataFrame, queries: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], floor: dict[int, int], k: int) -> DataFrame:
    """(query, vec_id, score) of each task's best; queries by vector length: their numbers, vec_ids and vectors."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = {n: Best(ids, v, np.array([floor.get(int(i), int(_LEAST) + 1) for i in numbers]), k) for n, (numbers, ids, v) in queries.items()}
        held: dict[int, list] = defaultdict(list)

        def take(n: int) -> None:
            ids, vectors = zip(*held.pop(n))
            best[n].search(np.array(ids, dtype=np.int64), whole(list(vectors)))

        for batch in batches:
            for i, v in zip(batch.vec_id, batch.embedding):
                if len(v) in best:
                    held[len(v)].append((i, v))
                    if len(held[len(v)]) >= SHARD_ROWS:
                        take(len(v))
        for n in list(held):
            take(n)
        for n, b in best.items():
            q, r = np.nonzero(b.score > _LEAST)
            yield pd.DataFrame({"query": queries[n][0][q], "vec_id": b.row[q, r], "score": b.score[q, r]})

    return candidates.mapInPandas(search, "query long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """For each row of vectors (vec_id, embedding) for which the condition is_query holds: query_id, rank from 1, vec_id, score."""
    spark, rows = vectors.sparkSession, usable(vectors)
    # queries that differ in vec_id or whole numbers, and how often each stands; read once, dealt into blocks
    floor_of = lambda x: F.when(F.abs(x * SCALE) < 2.0**53, F.floor(x * SCALE).cast("double")).otherwise(x * SCALE)
    whole_numbers = F.transform("embedding", floor_of)
    asked = stored(rows.filter(is_query).groupBy("vec_id", whole_numbers.alias("numbers")).agg(F.count("*").alias("times"), F.min("embedding").alias("embedding")), "top-k-queries")
    total = asked.agg(F.sum(F.size("numbers") * 8 + 64)).first()[0] or 0
    n_blocks = max(1, math.ceil(total / QUERY_BYTES))
    place = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = lambda df: df.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    out = None
    for block in range(n_blocks):
        queries: dict[int, list] = defaultdict(list)
        known = sorted(asked.filter(F.pmod(F.xxhash64("vec_id", "numbers"), F.lit(n_blocks)) == block).select("vec_id", "embedding", "times").collect())  # about QUERY_BYTES
        for number, r in enumerate(known):
            queries[len(r.embedding)].append((number, r))
        packed = {n: (np.array([i for i, _ in rs]), np.array([r.vec_id for _, r in rs], dtype=np.int64), whole([r.embedding for _, r in rs])) for n, rs in queries.items()}
        # rows equal to a query but its own
        own = {i: int(products(v[j : j + 1], v[j : j + 1])[0, 0]) for numbers, _, v in packed.values() for j, i in enumerate(numbers.tolist()) if known[i].times > 1}
        like = [(i, known[i].vec_id, own[i]) for i in own for _ in range(min(k, known[i].times - 1))]
        first = best(_searched(rows.filter(F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(SEED_SHARE)) == 0), packed, {}, k))
        floor = {r["query"]: r.score for r in first.filter(F.col("rank") == k).select("query", "score").collect()}
        found = _searched(rows, packed, floor, k)
        if like:
            found = found.unionByName(spark.createDataFrame(like, "query long, vec_id long, score long"))
        names = spark.createDataFrame([(i, r.vec_id, r.times) for i, r in enumerate(known)], "query long, query_id long, times long")
        found = best(found).join(F.broadcast(names), "query")
        found = found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("col")
        out = found if n_blocks == 1 else stored(found, "top-k") if out is None else out.unionByName(stored(found, "top-k"))
    return out
