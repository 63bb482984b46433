"""Exact top-k by inner product: a ball tree per shard, branch and bound, a shared kth score.

Vectors are dealt into shards of a fixed size by hash; a task builds a shard's
ball tree (median splits along the line between two far points) and packs it into
one row. Queries are packed into blocks. Every block meets every shard, which is
the work the question asks for; a shard stays in its task and only the packed
blocks are sent to it.

Search in a shard: no vector x of a ball with centre c and radius r scores above
q.c + |q| r. The bounds go down the tree level by level and drop subtrees below a
query's kth best score so far; the leaves that remain are visited in order of
their bounds, best first, and a query stops when its next bound is below its kth
score. A first pass over one shard per block gives every query a kth score, which
is shared with all shards before the second pass begins.

Defined results: null vectors and vectors with null or non-finite components
take no part, nor do rows without an id, or with a component that is no 64-bit
integer after scaling; scores are exact, and stand at the limit of 64 bits where
they pass it; vectors are compared with those of their own length; all rows
with the query's id are its own; an id that is repeated among the queries is
asked once, with the smallest of its vectors; repeated candidates each count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.session import stored

_SAFE = float(1 << 53)
_LIMIT = (1 << 63) - 1


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component as 64-bit integers; null unless all are finite and fit."""
    wide = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    whole = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * scale < float(1 << 63))
    )
    return F.when(vector.isNotNull() & whole, wide)


def build_tree(points: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order of the points, nodes (start, stop, left, right), centres, radii); children follow parents."""
    order = np.arange(len(points))
    nodes: list[list[int]] = []
    centres, radii = [], []
    todo = [(0, len(points), -1, 0)]
    while todo:
        start, stop, parent, side = todo.pop()
        own = points[order[start:stop]]
        centre = own.mean(0)
        away = ((own - centre) ** 2).sum(1)
        number = len(nodes)
        nodes.append([start, stop, -1, -1])
        centres.append(centre)
        radii.append(float(np.sqrt(away.max())))
        if parent >= 0:
            nodes[parent][2 + side] = number
        if stop - start > leaf and radii[-1] > 0:
            a = own[away.argmax()]
            b = own[((own - a) ** 2).sum(1).argmax()]
            middle = (stop - start) // 2
            place = np.argpartition(own @ (b - a), middle)
            order[start:stop] = order[start:stop][place]
            todo += [(start, start + middle, number, 0), (start + middle, stop, number, 1)]
    return order, np.array(nodes), np.array(centres), np.array(radii)


class Shard:
    """A packed ball tree, ready to be searched."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int):
        order, self.nodes, self.centres, self.radii = build_tree(points.astype(float), leaf)
        self.ids, self.points = ids[order], points[order]
        self.reach = float(np.abs(points.astype(float)).max(initial=0))
        self.far = np.sqrt((self.centres**2).sum(1))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int):
        """Best scores and ids per query, best first; -1 stands for no candidate's place, see `found`."""
        q = queries.astype(float)
        most = self.reach * np.abs(q).max(initial=0) * max(1, q.shape[1])
        exact = most < _SAFE
        kind = float if exact else np.int64 if most < _SAFE * 512 else object
        points, asked = self.points.astype(kind), queries.astype(kind)
        length = np.sqrt((q * q).sum(1))
        n = len(q)
        low = np.iinfo(np.int64).min
        scores = np.full((n, k), low)
        ids = np.full((n, k), np.iinfo(np.int64).max)
        kth = floors.copy() if exact else np.nextafter(floors, -np.inf)
        bounds = np.full((n, len(self.nodes)), -np.inf)
        alive = {0: np.arange(n)}
        for node, (start, stop, left, right) in enumerate(self.nodes):  # parents come before children
            rows = alive.pop(node, None)
            if rows is None or not len(rows):
                continue
            bound = q[rows] @ self.centres[node] + length[rows] * self.radii[node]
            bound += 1e-9 * (np.abs(bound) + length[rows] * (self.radii[node] + 1)) + 1e-6
            bound += 1e-12 * length[rows] * self.far[node]
            near = bound >= kth[rows]
            rows = rows[near]
            if left < 0:
                bounds[rows, node] = bound[near]
            else:
                alive[left] = alive[right] = rows
        leaves = np.flatnonzero(self.nodes[:, 2] < 0)
        bounds = bounds[:, leaves]
        ranking = np.argsort(-bounds, axis=1)
        active = np.arange(n)
        for turn in range(len(leaves)):
            choice = ranking[active, turn]
            on = bounds[active, choice] >= np.maximum(kth[active], -np.inf)
            on &= np.isfinite(bounds[active, choice])
            active, choice = active[on], choice[on]
            if not len(active):
                break
            for leaf in np.unique(choice):
                rows = active[choice == leaf]
                start, stop = self.nodes[leaves[leaf], :2]
                got = asked[rows] @ points[start:stop].T
                got = (np.clip(got, -_LIMIT, _LIMIT) if kind is object else got).astype(np.int64)
                there = np.broadcast_to(self.ids[start:stop], got.shape)
                own = there == query_ids[rows, None]
                got = np.where(own, low, got)
                there = np.where(own, np.iinfo(np.int64).max, there)
                better = got.max(1) >= kth[rows]
                rows = rows[better]
                all_scores = np.concatenate((scores[rows], got[better]), axis=1)
                all_ids = np.concatenate((ids[rows], there[better]), axis=1)
                best = np.lexsort((all_ids, -all_scores.astype(float) if exact else ~all_scores), axis=1)[:, :k]
                scores[rows] = np.take_along_axis(all_scores, best, 1)
                ids[rows] = np.take_along_axis(all_ids, best, 1)
                worst = scores[rows, -1].astype(float)
                worst = worst if exact else np.nextafter(worst, -np.inf)
                kth[rows] = np.maximum(kth[rows], np.where(scores[rows, -1] == low, -np.inf, worst))
        return scores, ids, scores != low


def _small(values: np.ndarray) -> np.ndarray:
    """Four bytes a component where they do, else eight."""
    fits = len(values) == 0 or (values.min() >= -(1 << 31) and values.max() < 1 << 31)
    return values.astype(np.int32 if fits else np.int64)


def _packed(rows: DataFrame, place: str, parts: int) -> DataFrame:
    """One row per (place, dimension): ids and vectors of its rows, and floors if there are any."""
    schema = pa.schema(
        [(place, pa.int32()), ("dim", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary()), ("floors", pa.binary())]
    )

    def pack(table: pa.Table) -> pa.Table:
        ids = table["vec_id"].to_numpy()
        vectors = table["v"].combine_chunks()
        floors = table["floor"].to_numpy()
        return pa.Table.from_pydict(
            {
                place: table[place][:1],
                "dim": table["dim"][:1],
                "ids": [ids.astype(np.int64).tobytes()],
                "vectors": [_small(vectors.flatten().to_numpy()).tobytes()],
                "floors": [floors.astype(float).tobytes()],
            },
            schema,
        )

    return rows.groupBy(place, "dim").applyInArrow(
        pack, f"{place} int, dim int, ids binary, vectors binary, floors binary"
    )


def _search(shards: DataFrame, blocks: DataFrame, k: int, leaf: int) -> DataFrame:
    """Rows (query_id, vec_id, score): a block's best in each shard it is sent to (column shard)."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, trees = None, {}
        for batch in batches:
            for shard, kind, dim, ids, vectors, floors in zip(*(batch.column(i) for i in range(6))):
                if shard.as_py() != at:
                    at, trees = shard.as_py(), {}
                own_ids = np.frombuffer(ids.as_buffer(), np.int64)
                size = dim.as_py()
                raw = vectors.as_buffer()
                own = np.frombuffer(raw, np.int32 if len(raw) == 4 * len(own_ids) * size else np.int64)
                own = own.reshape(len(own_ids), size)
                if kind.as_py() == 0:
                    trees[size] = Shard(own_ids, own, leaf)
                elif size in trees:
                    scores, found, real = trees[size].search(
                        own_ids, own, np.frombuffer(floors.as_buffer(), float), k
                    )
                    asked = np.broadcast_to(own_ids[:, None], found.shape)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(asked[real]), pa.array(found[real]), pa.array(scores[real])], schema=schema
                    )

    columns = ["shard", "kind", "dim", "ids", "vectors", "floors"]
    met = shards.withColumn("kind", F.lit(0)).select(columns).unionByName(
        blocks.withColumn("kind", F.lit(1)).select(columns)
    )
    dealt = met.repartition("shard").sortWithinPartitions("shard", "kind")
    return dealt.mapInArrow(work, "query_id long, vec_id long, score long")


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    shard_rows: int = 4096,
    block_rows: int = 1024,
    leaf: int = 256,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k best rows for each query, ties to the smaller id."""
    points = stored(
        vectors.filter(F.col(key).isNotNull())
        .select(F.col(key).cast("long").alias("vec_id"), quantised(F.col(vector), scale).alias("v"), is_query.alias("asked"))
        .filter("v IS NOT NULL")
        .withColumn("dim", F.size("v"))
    )
    count = points.count()
    n_shards = max(1, -(-count // shard_rows))
    # Equal rows go to shards of their own choice, too.
    seat = F.monotonically_increasing_id()
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v", seat), F.lit(n_shards)).cast("int"))
    shards = stored(_packed(dealt.withColumn("floor", F.lit(0.0)), "shard", n_shards))
    asked = points.filter("asked").groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("q"))
    asked = stored(asked.select("vec_id", F.col("q.dim").alias("dim"), F.col("q.v").alias("v")))
    n_blocks = max(1, -(-asked.count() // block_rows))

    def blocks(queries: DataFrame) -> DataFrame:
        placed = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int"))
        return _packed(placed, "block", n_blocks)

    none = F.lit(float("-inf"))
    floors = asked.withColumn("floor", none)
    if n_shards > 1:
        home = blocks(floors).withColumn("shard", F.pmod("block", F.lit(n_shards)).cast("int"))
        first = _search(shards, home, k, leaf)
        shared = first.groupBy("query_id").agg(
            F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).otherwise(none).alias("least")
        )
        floors = stored(
            asked.join(shared, F.col("vec_id") == F.col("query_id"), "left").select(
                "vec_id", "dim", "v", F.coalesce("least", none).alias("floor")
            )
        )
    everywhere = blocks(floors).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    found = _search(shards, everywhere, k, leaf)
    place = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(place))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def op2_topk_search(vectors: DataFrame) -> DataFrame:
    """The five best rows for every row whose id is divisible by 50."""
    return top_k(vectors.select("vec_id", "embedding"), F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False)))


OP2_SQL = (
    "WITH e AS (SELECT row_number() OVER () AS rid, vec_id, embedding FROM embeddings "
    "WHERE vec_id IS NOT NULL AND embedding IS NOT NULL), "
    "c AS (SELECT rid, vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM e), "
    "ok AS (SELECT rid FROM c GROUP BY rid HAVING bool_and(coalesce(isfinite(x), false))), "
    "f AS (SELECT rid, vec_id, i, floor(256 * x::DOUBLE)::BIGINT AS v FROM c SEMI JOIN ok USING (rid)), "
    "s AS (SELECT q.vec_id AS query_id, p.vec_id, p.rid, sum(q.v * p.v)::BIGINT AS score FROM f q JOIN f p ON q.i = p.i "
    "WHERE q.vec_id % 50 = 0 AND p.vec_id <> q.vec_id GROUP BY q.vec_id, p.vec_id, p.rid), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s) "
    "SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"
)
