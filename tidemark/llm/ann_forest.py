"""Nearest neighbours by a forest of random-projection trees with one priority queue, and exact reranking.

The trees are grown on a bounded sample; every vector is indexed. A node splits its part of the sample at the median of the
projection on the line through two of its vectors. A query walks all trees at once: of all open nodes the one whose worst
margin on the way is best comes next, until enough leaves are open. Its candidates are the vectors of those leaves; their
distances are computed exactly, in double precision, where the leaves are, and only the best go on.

Equal vectors are one point with its smallest ids, so a hot vector is indexed once. Leaves are dealt to buckets by a hash,
and a leaf that outgrows a bucket is split in chunks; queries are dealt too, and a bucket goes to each deal of them, so no
group grows with the data.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, batch_of, saved


@dataclass(frozen=True)
class Forest:
    """Complete binary trees: normals (trees, nodes, width) and thresholds (trees, nodes); the children of k are 2k+1, 2k+2."""

    normals: np.ndarray
    thresholds: np.ndarray
    depth: int

    @property
    def leaves(self) -> int:
        """Leaves of all trees."""
        return len(self.normals) << self.depth

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree, numbered over all trees: (vectors, trees)."""
        out = np.empty((len(vectors), len(self.normals)), np.int64)
        for t, (normals, thresholds) in enumerate(zip(self.normals, self.thresholds, strict=True)):
            node = np.zeros(len(vectors), np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", vectors, normals[node]) > thresholds[node]
                node = 2 * node + 1 + side
            out[:, t] = node - ((1 << self.depth) - 1) + (t << self.depth)
        return out

    def nearest_cells(self, vector: np.ndarray, wanted: int) -> list[int]:
        """The `wanted` leaves that one priority queue over all trees opens first for a vector."""
        inner = (1 << self.depth) - 1
        margins = self.normals @ vector - self.thresholds if inner else np.zeros((len(self.normals), 0))
        margins = margins.tolist()
        heap = [(-np.inf, t, 0) for t in range(len(margins))]
        found: list[int] = []
        while heap and len(found) < wanted:
            worst, t, node = heapq.heappop(heap)
            while node < inner:
                margin = margins[t][node]
                near, far = (2 * node + 2, 2 * node + 1) if margin > 0 else (2 * node + 1, 2 * node + 2)
                heapq.heappush(heap, (max(worst, abs(margin)), t, far))
                node = near
            found.append(node - inner + (t << self.depth))
        return found


def grow(sample: np.ndarray, trees: int, depth: int, seed: int = 7) -> Forest:
    """A forest on a sample of vectors. Nodes without two different vectors split by a random direction."""
    rng = np.random.default_rng(seed)
    inner, width = (1 << depth) - 1, sample.shape[1]
    normals, thresholds = np.zeros((trees, inner, width)), np.zeros((trees, inner))
    for t in range(trees):
        node = np.zeros(len(sample), np.int64)
        for k in range(inner):
            own = np.flatnonzero(node == k)
            pick = rng.choice(own, 2, replace=False) if len(own) > 1 else own
            line = sample[pick[0]] - sample[pick[1]] if len(pick) > 1 else np.zeros(width)
            if not line.any():
                line = rng.normal(size=width)
            line = line / np.linalg.norm(line)
            along = sample[own] @ line
            normals[t, k], thresholds[t, k] = line, np.median(along) if len(own) else 0.0
            node[own] = 2 * k + 1 + (along > thresholds[t, k])
    return Forest(normals, thresholds, depth)


def _best(query: np.ndarray, rows: np.ndarray, first: np.ndarray, best: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance) of the `best` nearest rows of each query, ties to the smaller first id.

    A fast estimate leaves out what is certainly farther; distances of the rest are exact.
    """
    squares = (query**2).sum(1)[:, None] + (rows**2).sum(1)[None, :]
    near = squares - 2 * query @ rows.T
    if near.shape[1] > best:
        bar = np.partition(near, best - 1, axis=1)[:, best - 1 : best]
        q, r = np.nonzero(near <= bar + 1e-9 * squares)
    else:
        q, r = np.divmod(np.arange(near.size), near.shape[1])
    distance = np.sqrt(((query[q] - rows[r]) ** 2).sum(1))
    order = np.lexsort((first[r], distance, q))
    q, r, distance = q[order], r[order], distance[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    kept = place < best
    return q[kept], r[kept], distance[kept]


def dealt(index: DataFrame, sought: DataFrame, deals: int) -> tuple[DataFrame, DataFrame]:
    """Both with a column `deal`: each query is in one of `deals`, each row of the index in all of them."""
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(deals - 1)))
    return index.withColumn("deal", everywhere), sought.withColumn("deal", F.pmod(F.xxhash64("query"), F.lit(deals)).cast("int"))


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, trees: int = 8, sample_rows: int = 16384, leaf_rows: int = 100,
    search_share: float = 0.12, bucket_rows: int = 20_000, query_rows: int = 4096,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest found of `vectors` for each row of `queries`, both (vec_id, vector).

    Nearness is Euclidean distance, ties to the smaller vec_id; score is the distance. Queries are rows of `vectors`: a row
    is not its own neighbour. The forest is grown on at most `sample_rows` vectors, picked by hash, with leaves of about
    `leaf_rows` vectors as long as that sample allows eight each; all vectors are indexed. `search_share` of the leaves of
    all trees are searched per query: 0.12 finds over nine in ten neighbours where vectors have no structure at all, which
    is the worst case; clustered vectors need far less. A group compares about `bucket_rows` index rows with about
    `query_rows` queries.

    Rows with a null id take no part, nor do vectors that are null, zero, or hold a null or non-finite component. Vectors of
    different lengths have no distance: each length has a forest of its own, one after the other, and few lengths are
    expected. An id stands for one vector: rows that repeat it count once, with the least of its vectors. Other columns are
    ignored. Empty tables give no rows; a query with fewer than `k` candidates gets them all.
    """
    numbers = F.col("vector").cast("array<double>")
    whole = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), numbers.alias("vector")).where(
        "vec_id is not null and vector is not null and exists(vector, x -> x != 0)"
        " and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    )
    # adding zero makes both zeros one
    whole = whole.withColumn("vector", F.transform("vector", lambda x: x + 0.0))
    whole = saved(whole.groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")
    widths = sorted(r.width for r in whole.select(F.size("vector").alias("width")).distinct().collect())
    found = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for width in widths:
        same = whole.where(F.size("vector") == width)
        part = _nearest(same, queries, width, k, trees, sample_rows, leaf_rows, search_share, bucket_rows, query_rows)
        found = part if len(widths) == 1 else found.unionByName(part)
    return found


def _nearest(
    whole: DataFrame, queries: DataFrame, width: int, k: int, trees: int, sample_rows: int, leaf_rows: int,
    search_share: float, bucket_rows: int, query_rows: int,
) -> DataFrame:
    """`nearest` among distinct ids with finite vectors of `width` numbers."""
    first = max(k + 1, 2)
    by_vector = Window.partitionBy("vector").orderBy("vec_id")
    points = saved(
        whole.withColumn("n", F.row_number().over(by_vector))
        .where(F.col("n") <= first)
        .groupBy("vector")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .withColumn("point", F.monotonically_increasing_id()),
        "points",
    )
    asked = queries.select(F.col("vec_id").cast("long").alias("query_id")).where("query_id is not null").distinct()
    asked = whole.join(asked, whole["vec_id"] == asked["query_id"]).select("query_id", "vector")
    asked = saved(asked.join(points.select("vector", "point"), "vector").select("query_id", F.col("point").alias("query")), "asked")

    n = points.count()
    sample = points.select("vector", F.xxhash64("vector").alias("h")).orderBy("h").limit(sample_rows).toPandas()
    sample = np.array(sorted(map(list, sample["vector"])), float).reshape(-1, width)
    depth = max(0, min(int(np.log2(max(1, n / leaf_rows))), int(np.log2(max(1, len(sample) / 8)))))
    forest = grow(sample, trees, depth)
    # a leaf is larger than the share of a bucket only where the sample bounds the depth
    chunks = max(1, -(-(n >> depth) // bucket_rows))
    buckets = max(1, -(-n * trees // bucket_rows))
    wanted = max(trees, int(np.ceil(search_share * forest.leaves)))

    def bucket_of(cell: np.ndarray) -> np.ndarray:
        return ((cell.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)).astype(np.int64) % buckets

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy().reshape(len(column), -1)

    placed_schema = arrow_schema("bucket long,cell long,point long,first_id long,vector binary")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                values, point = matrix(part.column("vector")), part.column("point").to_numpy()
                cell = forest.cells(values) * chunks + (point % chunks)[:, None]
                rows = np.repeat(np.arange(len(values)), trees)
                packed = [v.tobytes() for v in values]
                yield batch_of(
                    {
                        "bucket": bucket_of(cell.reshape(-1)), "cell": cell.reshape(-1), "point": point[rows],
                        "first_id": part.column("first_id").to_numpy()[rows], "vector": [packed[i] for i in rows],
                    },
                    placed_schema,
                )

    sought_schema = arrow_schema("bucket long,query long,vector binary,cells array<long>")

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in sought_schema}
            for query, vector in zip(batch.column("point").to_pylist(), matrix(batch.column("vector")), strict=True):
                cells = np.array(forest.nearest_cells(vector, wanted), np.int64)
                cells = (cells[:, None] * chunks + np.arange(chunks)[None, :]).reshape(-1)
                of = bucket_of(cells)
                for b in np.unique(of).tolist():
                    row = (b, query, vector.tobytes(), cells[of == b].tolist())
                    for name, value in zip(out, row, strict=True):
                        out[name].append(value)
            yield batch_of(out, sought_schema)

    found_schema = arrow_schema("query long,point long,first_id long,score double")

    def compare(index: pa.Table, sought: pa.Table) -> pa.Table:
        if not index.num_rows or not sought.num_rows:
            return pa.Table.from_batches([], found_schema)
        cell = index.column("cell").to_numpy()
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        point, ids = index.column("point").to_numpy()[order], index.column("first_id").to_numpy()[order]
        rows = np.frombuffer(b"".join(index.column("vector").to_pylist()), float).reshape(len(order), -1)[order]
        asked = sought.column("query").to_numpy()
        vectors = np.frombuffer(b"".join(sought.column("vector").to_pylist()), float).reshape(len(asked), -1)
        cells = sought.column("cells").combine_chunks()
        wanted_cell = cells.flatten().to_numpy()
        of = np.repeat(np.arange(len(asked)), cells.value_lengths().to_numpy())
        by_cell = np.argsort(wanted_cell, kind="stable")
        wanted_cell, of = wanted_cell[by_cell], of[by_cell]
        cuts = np.flatnonzero(np.r_[True, wanted_cell[1:] != wanted_cell[:-1], True])
        q, r, d = [], [], []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            low, high = np.searchsorted(cell, wanted_cell[a]), np.searchsorted(cell, wanted_cell[a], side="right")
            if low < high:
                for at in range(a, b, 1000):
                    own = of[at : min(at + 1000, b)]
                    x, y, z = _best(vectors[own], rows[low:high], ids[low:high], first)
                    q.append(own[x])
                    r.append(y + low)
                    d.append(z)
        if not q:
            return pa.Table.from_batches([], found_schema)
        q, r, d = map(np.concatenate, (q, r, d))
        order = np.lexsort((point[r], ids[r], d, q))
        q, r, d = q[order], r[order], d[order]
        # a point of several trees counts once
        new = np.r_[True, (q[1:] != q[:-1]) | (point[r[1:]] != point[r[:-1]])]
        q, r, d = q[new], r[new], d[new]
        kept = np.arange(len(q)) - np.searchsorted(q, q) < first
        q, r, d = q[kept], r[kept], d[kept]
        return pa.Table.from_batches([batch_of({"query": asked[q], "point": point[r], "first_id": ids[r], "score": d}, found_schema)])

    index = points.select("point", F.col("ids")[0].alias("first_id"), "vector").mapInArrow(
        place, "bucket long, cell long, point long, first_id long, vector binary"
    )
    searched = points.join(asked.select(F.col("query").alias("point")).distinct(), "point").select("point", "vector")
    sought = searched.repartition("point").mapInArrow(seek, "bucket long, query long, vector binary, cells array<long>")
    index, sought = dealt(index, sought, max(1, -(-asked.select("query").distinct().count() // query_rows)))
    found = index.groupBy("bucket", "deal").cogroup(sought.groupBy("bucket", "deal")).applyInArrow(
        compare, "query long, point long, first_id long, score double"
    )
    best = found.groupBy("query", "point").agg(F.min("first_id").alias("first_id"), F.min("score").alias("score"))
    near = Window.partitionBy("query").orderBy("score", "first_id", "point")
    best = best.withColumn("n", F.row_number().over(near)).where(F.col("n") <= first).drop("n", "first_id")
    named = best.join(points.select("point", "ids"), "point").select("query", "score", F.explode("ids").alias("vec_id"), "point")
    own = asked.withColumnRenamed("query", "own")
    pairs = own.join(named, own["own"] == named["query"]).where(
        (F.col("vec_id") != F.col("query_id")) | (F.col("point") != F.col("own"))
    )
    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        pairs.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
