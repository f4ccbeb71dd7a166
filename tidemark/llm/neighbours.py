"""Approximate nearest neighbours with learned partitions.

1. On a sample of bounded size a neighbour graph is built and cut into balanced parts by repeated
   bisection: vertices are ordered by a smooth function on the graph (power iteration), split at the
   median, and pairs are swapped while that saves edges.
2. A small network (one hidden layer) learns in which parts a vector's neighbours lie. It assigns every
   row of the table to its most probable part, and routes a query to its most probable parts until
   they hold enough probability together. How much is enough is measured on vectors of the sample that
   the network was not fitted on: the least that finds RECALL of their neighbours in the sample.
3. In those parts distances are exact, in double precision on the original vectors. Rows of a part, and
   the queries routed to it, are dealt to blocks of bounded size by hash, so that neither a part that
   gathers a third of all rows nor many equal vectors land in one task; a block gives its best `k` for
   a query, and these are merged.

The driver holds the sample and the network only. Defined cases: vectors that are null, all zero, or
hold null or non-finite components take no part, nor do those whose length is not the table's most
frequent one. Equal distances go to the smaller id; rows that repeat an id are candidates each, and no
query meets a row with its own id. A query without candidates gives no row, as does an empty table.
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scratch import store

#: Vectors that the parts and the network are fitted on, at most.
SAMPLE = 6_000

#: Share of true neighbours aimed at, and of the sample that is kept back to measure it.
RECALL, KEPT_BACK = 0.97, 0.2

#: Rows of the table for each part, and the most parts the network tells apart.
PART_ROWS, MOST_PARTS = 1_000, 256

#: Rows, and queries, of one part that meet in one task.
BLOCK = 4_096

GRAPH_DEGREE = 10
HIDDEN = 128


@dataclass
class Router:
    """The network: standardised input, one hidden layer, a probability for each part."""

    mean: np.ndarray
    spread: np.ndarray
    first: np.ndarray
    second: np.ndarray
    enough: float = 1.0

    def hidden(self, x: np.ndarray) -> np.ndarray:
        x = (x - self.mean) / self.spread
        return np.hstack([np.tanh(np.hstack([x, np.ones((len(x), 1))]) @ self.first), x, np.ones((len(x), 1))])

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = self.hidden(x) @ self.second
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def ranked(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts by falling probability, and the probability of those before each."""
        p = self.probabilities(x)
        order = np.argsort(-p, axis=1, kind="stable")
        ranked = np.take_along_axis(p, order, axis=1)
        return order, np.cumsum(ranked, axis=1) - ranked


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    """The nearest other vectors of each, by blocks."""
    norms = (x * x).sum(axis=1)
    out = np.empty((len(x), degree), np.int64)
    for begin in range(0, len(x), 512):
        d = norms[None, :] - 2 * (x[begin : begin + 512] @ x.T)
        d[np.arange(len(d)), np.arange(begin, begin + len(d))] = np.inf
        out[begin : begin + 512] = np.argpartition(d, degree - 1, axis=1)[:, :degree]
    return out


def bisect(nodes: np.ndarray, graph: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of some vertices, with few edges between them."""
    place = np.full(len(graph), -1)
    place[nodes] = np.arange(len(nodes))
    near = place[graph[nodes]]
    a, b = np.repeat(np.arange(len(nodes)), graph.shape[1]), near.ravel()
    a, b = a[b >= 0], b[b >= 0]
    a, b = np.r_[a, b], np.r_[b, a]
    degree = np.bincount(a, minlength=len(nodes)) + 1e-9
    value = rng.standard_normal(len(nodes))
    for _ in range(60):
        value = 0.5 * value + 0.5 * np.bincount(a, value[b], len(nodes)) / degree
        value -= (value * degree).sum() / degree.sum()
        value /= np.abs(value).max() + 1e-30
    side = np.zeros(len(nodes), bool)
    side[np.argsort(value, kind="stable")[len(nodes) // 2 :]] = True
    for _ in range(20):  # swap equal numbers of vertices that would rather be on the other side
        other = np.bincount(a, side[a] != side[b], len(nodes))
        gain = 2 * other - np.bincount(a, minlength=len(nodes))
        up = np.flatnonzero(~side & (gain > 0))
        down = np.flatnonzero(side & (gain > 0))
        n = min(len(up), len(down)) // 2
        if not n:
            break
        side[up[np.argsort(-gain[up], kind="stable")[:n]]] = True
        side[down[np.argsort(-gain[down], kind="stable")[:n]]] = False
    return nodes[~side], nodes[side]


def balanced_parts(x: np.ndarray, parts: int, seed: int = 0) -> np.ndarray:
    """A part for each vector, all of about the same size."""
    rng = np.random.default_rng(seed)
    graph = neighbour_graph(x, min(GRAPH_DEGREE, len(x) - 1))
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        groups.sort(key=len)
        groups += bisect(groups.pop(), graph, rng)
    out = np.empty(len(x), np.int64)
    for i, nodes in enumerate(groups):
        out[nodes] = i
    return out


def learn_router(x: np.ndarray, parts: int, seed: int = 0, steps: int = 300) -> Router:
    """Fits the parts and the network on a sample of vectors."""
    rng = np.random.default_rng(seed)
    part = balanced_parts(x, parts, seed) if parts > 1 else np.zeros(len(x), np.int64)
    router = Router(
        x.mean(axis=0),
        x.std(axis=0) + 1e-9,
        rng.standard_normal((x.shape[1] + 1, HIDDEN)) / x.shape[1] ** 0.5,
        np.zeros((HIDDEN + x.shape[1] + 1, parts)),
    )
    if parts == 1:
        return router
    graph = neighbour_graph(x, min(GRAPH_DEGREE, len(x) - 1))
    goal = np.zeros((len(x), parts))
    np.add.at(goal, (np.arange(len(x))[:, None], part[graph]), 1)
    goal[np.arange(len(x)), part] += 1
    goal /= goal.sum(axis=1, keepdims=True)
    shuffled = rng.permutation(len(x))
    back, use = np.split(shuffled, [int(KEPT_BACK * len(x))])
    inputs = (x - router.mean) / router.spread
    inputs = np.hstack([inputs, np.ones((len(x), 1))])
    weights = [router.first, router.second]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    for step in range(1, steps + 1):
        rows = rng.choice(use, min(1024, len(use)), replace=False)
        hidden = np.tanh(inputs[rows] @ weights[0])
        full = np.hstack([hidden, inputs[rows]])
        z = full @ weights[1]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        error = (p - goal[rows]) / len(rows)
        inner = (error @ weights[1][:HIDDEN].T) * (1 - hidden * hidden)
        for i, grad in enumerate((inputs[rows].T @ inner, full.T @ error)):
            one, two = moments[i]
            grad = grad + 1e-3 * weights[i]
            one += 0.1 * (grad - one)
            two += 0.001 * (grad * grad - two)
            weights[i] -= 0.01 * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.999**step)) + 1e-8)
    order, before = router.ranked(x)
    place = np.argsort(order, axis=1)  # rank of each part for each vector
    home = order[:, 0]
    needed = np.sort(before[back[:, None], place[back[:, None], home[graph[back]]]].ravel())
    router.enough = float(needed[int(RECALL * len(needed))]) + 1e-12 if len(needed) else 1.0
    return router


def usable(vector: Column) -> Column:
    """Whether a vector takes part at all."""
    finite = F.forall(vector, lambda v: v.isNotNull() & (F.abs(v) < float("inf")) & ~F.isnan(v))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(vector, lambda v: v != 0), F.lit(False))


def vectors_of(batch: pa.RecordBatch, name: str = "vector") -> np.ndarray:
    column = batch.column(name)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def route(
    batches: Iterator[pa.RecordBatch], router: Router, held: np.ndarray | None = None, least: int = 0
) -> Iterator[pa.RecordBatch]:
    """(id, vector) with the part, or for queries, which give the rows `held` by each part, a row for every
    part they go to: as many as are probable enough, and as many as hold `least` rows together."""
    for batch in batches:
        if not batch.num_rows:
            continue
        order, before = router.ranked(vectors_of(batch))
        if held is not None:
            rows_before = np.cumsum(held[order], axis=1) - held[order]
            row, column = np.nonzero((before <= router.enough) | (rows_before < least))
            part = order[row, column]
        else:
            row, part = np.arange(len(order)), order[:, 0]
        taken = batch.take(pa.array(row))
        yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(part.astype(np.int32))], names=["id", "vector", "part"])


def nearest(queries: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """The best k rows of one block for each query of one block."""
    q, x = vectors_of(queries), vectors_of(rows)
    query_ids, ids = queries.column("id").to_numpy(), rows.column("id").to_numpy()
    out: tuple[list, list, list] = ([], [], [])
    norms = (x * x).sum(axis=1)
    scale = 1e-9 * (norms.max(initial=0) + 1)
    for i, query in enumerate(q):
        rough = norms - 2 * (x @ query)
        rough[ids == query_ids[i]] = np.inf
        if len(x) > k:
            edge = np.partition(rough, k - 1)[k - 1]
            near = np.flatnonzero((rough <= edge + scale) & np.isfinite(rough))
        else:
            near = np.flatnonzero(np.isfinite(rough))
        exact = np.sqrt(((x[near] - query) ** 2).sum(axis=1))
        best = np.lexsort((ids[near], exact))[:k]
        out[0].extend([query_ids[i]] * len(best))
        out[1].extend(ids[near[best]].tolist())
        out[2].extend(exact[best].tolist())
    return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})


def nearest_neighbours(
    table: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The k nearest found for each row that `queries` selects: query_id, rank, vec_id, score."""
    spark = table.sparkSession
    good = table.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
    rows = good.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), queries.alias("query"))
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), "size").first()
    size, n = most if most else (0, 0)
    rows = rows.where(F.size("vector") == size)
    sample = rows.select("vector").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    parts = max(1, min(MOST_PARTS, n // PART_ROWS, sample.num_rows // 24))
    x = vectors_of(sample) if sample.num_rows else np.zeros((1, max(size, 1)))
    shared = spark.sparkContext.broadcast(learn_router(x, parts))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return route(batches, shared.value)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return route(batches, shared.value, held, least)

    def search(asked: pa.Table, found: pa.Table) -> pa.Table:
        return nearest(asked, found, k)

    kind = f"id long, vector {rows.schema['vector'].dataType.simpleString()}, part int"
    indexed, _ = store(rows.select("id", "vector").mapInArrow(index, kind), "index")
    held = np.zeros(parts, np.int64)
    for row in indexed.groupBy("part").agg(F.count("*").alias("n")).collect():
        held[row.part] = row.n
    # a query finds no row with its own id, of which there may be several
    own = indexed.groupBy("id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    least = k + own
    asked, _ = store(rows.where("query").select("id", "vector").mapInArrow(ask, kind), "asked")
    in_blocks = lambda df, name: df.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))
    blocks, _ = store(in_blocks(indexed, "row_blocks").join(in_blocks(asked, "query_blocks"), "part"), "blocks")
    each = lambda name, other: F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(name)
    of = lambda name: F.pmod(F.xxhash64("id"), F.col(name)).cast("int")
    found_in = indexed.join(F.broadcast(blocks), "part").select(
        "id", "vector", "part", of("row_blocks").alias("r"), each("q", "query_blocks")
    )
    asked_in = asked.join(F.broadcast(blocks), "part").select(
        "id", "vector", "part", of("query_blocks").alias("q"), each("r", "row_blocks")
    )
    key = ("part", "q", "r")
    best = asked_in.groupBy(*key).cogroup(found_in.groupBy(*key)).applyInArrow(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
