"""Approximate nearest neighbours by cosine: balanced posting lists.

Index: centroids from balanced k-means over a bounded sample (`sample` vectors, the first by a hash of
the id); every vector is put into the list of its nearest centroid and, at a boundary, replicated into
further lists whose centroids are nearly as near and not nearer to one chosen before than to the
vector.  Search: a best-first walk over an in-memory graph of the centroids finds a query's nearest ones; the lists
within a ratio of the nearest one's distance are searched, and the next ones until they hold `LEAST` (k + 1) vectors, so
no query is left with fewer than k answers while there are candidates.  The ratio follows from the index: the exact
neighbours of at most `tuning` queries are found, and it is the least one whose lists hold `recall` of them.  Lists and their queries meet by list number; a list longer than `list_rows` is dealt into parts that are searched apart,
so no task holds an unbounded list, and each part sends on its best few only.

Equal vectors: of those, only the k + 1 smallest ids can be among k nearest, so only they are indexed,
and an equal query is searched once; no answer is lost by it.  Scores are cosines in double precision on
the original vectors.  Ties go to the smaller id.

Vectors that are null, zero, or hold null or non-finite components, null ids, and vectors whose length is not
the most common one take no part.  Repeated ids: the smallest vector of an id stays.  Fewer candidates than k: all
that were found.  Empty tables: an empty result.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docledger.llm.shared import written

#: The lists of a query hold at least so many times k + 1 vectors, each counted in its nearest list only.
LEAST = 4


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component to about one: no square over- or underflows, and no digit changes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, initial=0.0))[1][:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 1))


@dataclass
class Index:
    centroids: np.ndarray
    graph: np.ndarray  # each centroid's nearest centroids

    def nearest(self, x: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Centroids nearest to each row and their squared distances, in order, by dense products in blocks."""
        count = min(count, len(self.centroids))
        d = np.maximum(2 - 2 * x @ self.centroids.T, 0)
        at = np.argpartition(d, count - 1, axis=1)[:, :count] if count < d.shape[1] else np.broadcast_to(np.arange(d.shape[1]), d.shape)
        dist = np.take_along_axis(d, at, 1)
        order = np.lexsort((at, dist), axis=1)
        return np.take_along_axis(at, order, 1), np.take_along_axis(dist, order, 1)

    def walk(self, query: np.ndarray, width: int) -> list[tuple[float, int]]:
        """Best-first search over the graph, keeping the `width` nearest seen, from spread-out entries."""
        n = len(self.centroids)
        entries = np.unique(np.linspace(0, n - 1, min(n, 8)).astype(int))
        seen = np.zeros(n, bool)
        seen[entries] = True
        dist = np.maximum(2 - 2 * self.centroids[entries] @ query, 0)
        open_ = list(zip(dist.tolist(), entries.tolist()))
        heapq.heapify(open_)
        best = [(-d, -at) for d, at in heapq.nsmallest(width, open_)]
        heapq.heapify(best)  # the farthest of the nearest comes first
        while open_:
            d, at = heapq.heappop(open_)
            if len(best) >= width and d > -best[0][0]:
                break
            new = self.graph[at][~seen[self.graph[at]]]
            if not len(new):
                continue
            new = np.unique(new)
            seen[new] = True
            dist = np.maximum(2 - 2 * self.centroids[new] @ query, 0)
            for x in zip(dist.tolist(), new.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (-x[0], -x[1]))
                elif x[0] < -best[0][0]:
                    heapq.heapreplace(best, (-x[0], -x[1]))
                else:
                    continue
                heapq.heappush(open_, x)
        return sorted((-d, -at) for d, at in best)

    def lists_of(self, x: np.ndarray, replicas: int, replica_ratio: float) -> list[list[int]]:
        """The lists each row is put into, the nearest centroid's first."""
        at, dist = self.nearest(x, 4 * replicas)
        out = []
        for near, far in zip(at, dist):
            chosen: list[int] = []
            for c, d in zip(near, far):
                if len(chosen) == replicas or d > replica_ratio**2 * max(far[0], 1e-12):
                    break
                if all(2 - 2 * float(self.centroids[c] @ self.centroids[o]) > 0.5 * d for o in chosen):
                    chosen.append(int(c))
            out.append(chosen)
        return out

    def selected(self, query: np.ndarray, ratio: float, floor: float, held: np.ndarray, least: int) -> list[int]:
        """The lists whose distance is within `ratio` of the nearest one's (or of `floor`, where that is larger), and
        then the next ones until they hold `least` vectors or are all."""
        width = 16
        while True:
            found = self.walk(query, width)
            reach = ratio**2 * max(found[0][0], floor)
            near = sum(d <= reach for d, _ in found)
            total = np.cumsum(held[[c for _, c in found]])
            if len(found) == len(self.centroids) or (near < len(found) and total[-1] >= least):
                return [c for _, c in found[: max(near, int(np.searchsorted(total, least)) + 1)]]
            width *= 2


def build_index(sample: np.ndarray, lists: int, degree: int = 24, rounds: int = 12, seed: int = 7) -> Index:
    """Balanced k-means: a centroid that has more than its share pays for it in the next assignment."""
    x = _unit(sample)
    rng = np.random.default_rng(seed)
    lists = max(1, min(lists, len(x)))
    centroids = x[np.sort(rng.choice(len(x), lists, replace=False))]
    price = np.zeros(lists)
    share = len(x) / lists
    for _ in range(rounds):
        owner = np.concatenate([np.argmin(2 - 2 * part @ centroids.T + price, axis=1) for part in np.array_split(x, max(1, len(x) // 4096))])
        counts = np.bincount(owner, minlength=lists)
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, x)
        centroids = np.where((counts > 0)[:, None] & (np.linalg.norm(sums, axis=1) > 1e-12)[:, None], _unit(sums), centroids)
        price = 0.7 * price + 0.02 * np.clip(np.log((counts + 0.5) / (share + 0.5)), -2, 2)
    near = np.argsort(2 - 2 * centroids @ centroids.T, axis=1, kind="stable")[:, 1 : degree + 1]
    # Edges lead both ways, a few more than `degree` each, so that the walk can get anywhere.
    back: list[list[int]] = [list(r) for r in near]
    for a, row in enumerate(near):
        for b in row:
            if len(back[b]) < 2 * degree:
                back[b].append(a)
    ring = [[(i + 1) % lists, (i - 1) % lists] for i in range(lists)]
    merged = [np.unique(r + s) for r, s in zip(back, ring)]
    widest = max(map(len, merged))
    return Index(centroids, np.array([np.pad(r, (0, widest - len(r)), mode="edge") for r in merged]))


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, v: the vectors that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where("id is not null and v is not null")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (sizes.n if sizes else 0))


def nearest_of_some(cand: DataFrame, ids: np.ndarray, asked: np.ndarray, k: int) -> DataFrame:
    """q, v: the exact k nearest candidates of a few vectors, each batch of candidates sending on its best."""
    shared = cand.sparkSession.sparkContext.broadcast((ids, _unit(asked)))
    kind = cand.schema["v"].dataType.simpleString()

    def compared(batches):
        own, unit = shared.value
        kept: list = [[] for _ in own]
        for b in batches:
            x = _unit(_matrix(b.column("v")))
            at = b.column("id").to_numpy()
            for start in range(0, len(x), 4096):
                part, name = x[start : start + 4096], at[start : start + 4096]
                score = np.where(name[None, :] == own[:, None], -9.0, unit @ part.T)
                take = np.argpartition(-score, k - 1, axis=1)[:, :k] if k < len(part) else np.broadcast_to(np.arange(len(part)), score.shape)
                for q, row in enumerate(take):
                    new = [(-float(score[q, j]), int(name[j]), part[j]) for j in row if score[q, j] > -9]
                    kept[q] = sorted(kept[q] + new, key=lambda r: r[:2])[:k]
        flat = [(q, -d, i, v.tolist()) for q, rows in enumerate(kept) for d, i, v in rows]
        cols = list(zip(*flat)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.list_(pa.float64()))], ["q", "score", "id", "v"])

    found = cand.select("id", "v").mapInArrow(compared, "q int, score double, id long, v array<double>")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    return found.withColumn("r", place).where(F.col("r") <= k).select("q", "v")


def tuned_ratio(index: Index, asked: np.ndarray, q: np.ndarray, neighbours: np.ndarray, replicas: int, replica_ratio: float, recall: float) -> tuple[float, float]:
    """(ratio, floor): how far, in terms of its nearest list's distance, a query must look to find a share `recall` of the
    true neighbours of the asking vectors in some list of theirs; the floor is the usual distance of a nearest list."""
    if not len(neighbours):
        return 1.0, 0.0
    far = np.maximum(2 - 2 * _unit(asked) @ index.centroids.T, 0)
    floor = float(np.median(far.min(1)))
    need = [far[i, lists].min() / max(far[i].min(), floor, 1e-12) for i, lists in zip(q, index.lists_of(_unit(neighbours), replicas, replica_ratio))]
    return max(1.0, math.sqrt(np.quantile(need, recall, method="higher")) * (1 + 1e-9)), floor


def search(vectors: DataFrame, id_col="vec_id", vector_col="embedding", every=50, k=5, sample=32_768, rows_per_list=64, max_lists=4096, replicas=4, replica_ratio=1.25, recall=0.95, tuning=256, list_rows=4096) -> DataFrame:
    """query_id, rank, id, score: the k nearest found of each row whose id is divisible by `every`."""
    spark = vectors.sparkSession
    rows = valid_vectors(vectors, id_col, vector_col)
    key = [F.xxhash64("v").alias("k1"), F.xxhash64("v", F.lit(1)).alias("k2")]
    rows = rows.select("id", "v", *key)
    first = Window.partitionBy("k1", "k2").orderBy("id")
    cand = written(rows.groupBy("id").agg(F.min(F.struct("v", "k1", "k2")).alias("s")).select("id", "s.*").withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1), "candidates")
    asking = rows.where(F.col("id") % every == 0).select("k1", "k2").distinct()
    queries = cand.where("place = 1").join(asking, ["k1", "k2"], "left_semi").select("id", "k1", "k2", "v")
    total = cand.count()
    some = cand.where("place = 1").orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toArrow()
    if not total:
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    index = build_index(_matrix(some["v"]), min(max_lists, math.ceil(total / rows_per_list)))
    shared = spark.sparkContext.broadcast((index.centroids, index.graph))  # at most max_lists centroids
    few = queries.orderBy(F.xxhash64("id", F.lit(2)), "id").limit(tuning).select("id", "v").toArrow()
    ratio, floor = 1.0, 0.0
    if len(few):
        asked_few = _matrix(few["v"])
        true = nearest_of_some(cand, few["id"].to_numpy(), asked_few, k).toArrow()  # at most tuning * k rows
        ratio, floor = tuned_ratio(index, asked_few, true["q"].to_numpy(), _matrix(true["v"]), replicas, replica_ratio, recall)
    kind = f"array<{vectors.schema[vector_col].dataType.elementType.simpleString()}>"

    def placed(batches):
        index = Index(*shared.value)
        for b in batches:
            x = _unit(_matrix(b.column("v")))
            for start in range(0, len(x), 2048):
                part = x[start : start + 2048]
                which, lists, first = [], [], []
                for i, chosen in enumerate(index.lists_of(part, replicas, replica_ratio)):
                    which += [start + i] * len(chosen)
                    lists += chosen
                    first += [1] + [0] * (len(chosen) - 1)
                yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int32()), pa.array(first, pa.int32()), *b.take(pa.array(which)).columns], ["list", "first", *b.schema.names])

    def routed(batches):
        index = Index(*shared.value)
        for b in batches:
            which, lists = [], []
            for i, q in enumerate(_unit(_matrix(b.column("v")))):
                near = index.selected(q, ratio, floor, held.value, LEAST * (k + 1))
                which += [i] * len(near)
                lists += near
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int32()), *b.take(pa.array(which)).columns], ["list", *b.schema.names])

    posts = written(cand.select("id", "v").mapInArrow(placed, f"list int, first int, id long, v {kind}"), "posts")
    parts = written(posts.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / list_rows).cast("int").alias("parts"), F.sum("first").alias("held")), "parts")
    sizes = np.zeros(len(index.centroids), np.int64)
    for r in parts.select("list", "held").collect():  # at most max_lists rows
        sizes[r.list] = r.held
    held = spark.sparkContext.broadcast(sizes)
    parts = parts.select("list", "parts")
    posts = posts.join(F.broadcast(parts), "list").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))  # at most max_lists rows
    asked = queries.select("k1", "k2", "v").mapInArrow(routed, f"list int, k1 long, k2 long, v {kind}").join(F.broadcast(parts), "list")
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def compared(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list = []
        if len(left) and len(right):
            y = _scaled(_matrix(right["v"]))
            ids, unit = right["id"].to_numpy(), _unit(y)
            k1, k2 = left["k1"].to_numpy(), left["k2"].to_numpy()
            q = _scaled(_matrix(left["v"]))
            for start in range(0, len(q), 512):
                block = q[start : start + 512]
                rough = _unit(block) @ unit.T
                take = min(k + 1, len(y))
                floor = np.partition(rough, len(y) - take, axis=1)[:, len(y) - take] - 1e-9
                for i, x in enumerate(block):
                    at = np.flatnonzero(rough[i] >= floor[i])
                    exact = (y[at] * x).sum(1) / (np.sqrt((y[at] * y[at]).sum(1)) * math.sqrt((x * x).sum()))
                    best = np.lexsort((ids[at], -exact))[: k + 1]
                    out.append((k1[start + i], k2[start + i], ids[at][best].tolist(), exact[best].tolist()))
        cols = list(zip(*out)) or [(), (), (), ()]
        return pa.table({"k1": pa.array(cols[0], pa.int64()), "k2": pa.array(cols[1], pa.int64()), "ids": pa.array(cols[2], pa.list_(pa.int64())), "scores": pa.array(cols[3], pa.list_(pa.float64()))})

    spread = lambda df: df.groupBy("list", "part")
    found = spread(asked.select("list", "part", "k1", "k2", "v")).cogroup(spread(posts.select("list", "part", "id", "v"))).applyInArrow(compared, "k1 long, k2 long, ids array<long>, scores array<double>")
    # A vector in several lists has the same score in each.
    pairs = found.select("k1", "k2", F.explode(F.arrays_zip("ids", "scores")).alias("s")).groupBy("k1", "k2", F.col("s.ids").alias("other")).agg(F.max("s.scores").alias("score"))
    best = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), "other")
    top = pairs.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    ids = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("v", "k1", "k2")).alias("s")).select(F.col("id").alias("query_id"), "s.k1", "s.k2")
    own = ids.join(top, ["k1", "k2"]).where("other <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "other")).cast("int")
    return own.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("other").alias(id_col), "score")
