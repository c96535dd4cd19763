"""Approximate nearest neighbours through a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample; every vector of the table is then sent down it to a leaf. A query walks
the tree with a priority queue: the nearest unopened node is opened next, and leaves come out in the order in
which they are reached. How many leaves are visited is calibrated: visits widen until queries from the sample
find the wanted share of their true neighbours. Visited leaves are compared whole, in double precision.

Leaves are dealt into blocks of about ``BLOCK`` vectors by a hash of the id, so a leaf with a third of all
vectors is many blocks; a task compares one block with the queries that visit it, ``CHUNK`` at a time.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kalends.storage import Scratch

#: Most vectors the tree is fitted on, children of a node, and sampled vectors of a leaf.
SAMPLE, CHILDREN, LEAF = 16_384, 16, 48
ROUNDS = 8
#: Recall that calibration asks of the sample, and queries it uses.
RECALL, CALIBRATION = 0.96, 256
BLOCK, CHUNK = 2048, 256
NEIGHBOURS = 10


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(1), 0)


def k_means(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """At most k centres by Lloyd's rounds; fewer where clusters run empty."""
    x_distinct = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    centres = x_distinct[rng.permutation(len(x_distinct))[:k]]
    for _ in range(ROUNDS):
        nearest = _squared(x, centres).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        centres = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


@dataclass
class Tree:
    """Nodes with their children's centres; a leaf has no entry in ``centres``. The root is node 0."""

    centres: dict[int, np.ndarray] = field(default_factory=dict)
    children: dict[int, list[int]] = field(default_factory=dict)
    nodes: int = 1

    @classmethod
    def fitted(cls, x: np.ndarray) -> "Tree":
        tree = cls()
        waiting = [(0, x)]
        while waiting:
            node, part = waiting.pop()
            if len(part) <= LEAF:
                continue
            centres = k_means(part, min(CHILDREN, -(-len(part) // LEAF) + 1), node)
            if len(centres) < 2:
                continue
            tree.centres[node] = centres
            tree.children[node] = list(range(tree.nodes, tree.nodes + len(centres)))
            tree.nodes += len(centres)
            nearest = _squared(part, centres).argmin(axis=1)
            waiting += [(child, part[nearest == i]) for i, child in enumerate(tree.children[node])]
        return tree

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        leaf = np.zeros(len(x), np.int32)
        waiting = [(0, np.arange(len(x)))]
        while waiting:
            node, rows = waiting.pop()
            if node not in self.centres or not len(rows):
                leaf[rows] = node
                continue
            nearest = _squared(x[rows], self.centres[node]).argmin(axis=1)
            waiting += [(child, rows[nearest == i]) for i, child in enumerate(self.children[node])]
        return leaf

    def best_bins(self, query: np.ndarray) -> Iterator[int]:
        """Leaves in the order of a best-bin-first walk."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if node not in self.centres:
                yield node
                continue
            for distance, child in zip(_squared(query[None], self.centres[node])[0].tolist(), self.children[node]):
                heapq.heappush(queue, (distance, child))


def calibrated_visits(tree: Tree, x: np.ndarray, recall: float = RECALL) -> int:
    """The least number of leaves by which sampled queries find the wanted share of their nearest in the sample."""
    leaf = tree.leaves_of(x)
    queries = np.linspace(0, len(x) - 1, min(CALIBRATION, len(x))).astype(int)
    found: list[int] = []
    for q in queries.tolist():
        distance = _squared(x[q: q + 1], x)[0]
        distance[q] = np.inf
        nearest = np.argsort(distance, kind="stable")[: min(NEIGHBOURS, len(x) - 1)]
        place = {bin_: i for i, bin_ in enumerate(tree.best_bins(x[q]), 1)}
        found += [place[b] for b in leaf[nearest].tolist()]
    visits = 1
    while found and sum(v <= visits for v in found) < recall * len(found):
        visits += 1
    return visits


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the vectors that take part."""
    vector = F.col("embedding").cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return embeddings.select(F.col("vec_id").cast("long"), vector.alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))
    )


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def nearest(embeddings: DataFrame, step: int = 100, neighbours: int = NEIGHBOURS) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest found for every row whose id is divisible by ``step``.

    Defined cases: a null id and a vector that is null, empty, zero or holds null or non-finite components
    take no part, nor does one whose length is not the most frequent one; a query that comes twice is asked once, and
    rows with the query's own id are no candidates of it; other repeated rows are candidates each; ties go to the smaller id;
    with fewer candidates than neighbours all are returned; an empty table gives no rows; extra columns are ignored.
    """
    spark, scratch = embeddings.sparkSession, Scratch(embeddings.sparkSession)
    rows = usable(embeddings)
    sizes = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.where(F.size("embedding") == (sizes.d if sizes else 0))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    x = np.array([r.embedding for r in sample]) if sample else np.empty((0, 1))
    tree = Tree.fitted(x)
    visits = calibrated_visits(tree, x)
    shared = spark.sparkContext.broadcast(tree)  # at most SAMPLE centres and their parents

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.leaves_of(_matrix(batch.column(1)))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(leaf)], ["vec_id", "embedding", "leaf"])

    indexed = scratch.keep(rows.mapInArrow(assign, "vec_id long, embedding array<double>, leaf int"), "indexed")
    counts = {r.leaf: r["count"] for r in indexed.groupBy("leaf").count().collect()}  # a row per leaf
    blocks_of = {leaf: -(-n // BLOCK) for leaf, n in counts.items()}
    block_table = spark.createDataFrame(list(blocks_of.items()), "leaf int, blocks int")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, leaves = [], []
            for n, query in enumerate(_matrix(batch.column(1))):
                seen = 0
                for k, leaf in enumerate(shared.value.best_bins(query)):
                    # Past the calibrated visits, go on until there are enough candidates.
                    if k >= visits and seen > 2 * neighbours:
                        break
                    seen += counts.get(leaf, 0)
                    if leaf in counts:
                        ids.append(n)
                        leaves.append(leaf)
            picked = batch.take(pa.array(ids, pa.int64()))
            yield pa.record_batch([picked.column(0), picked.column(1), pa.array(leaves, pa.int32())], ["query_id", "query", "leaf"])

    block = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    small = F.broadcast(block_table)  # a row per leaf
    candidates = indexed.join(small, "leaf").select("leaf", block.alias("block"), "vec_id", "embedding").groupBy("leaf", "block").agg(
        F.collect_list("vec_id").alias("ids"), F.flatten(F.collect_list("embedding")).alias("vectors")
    )
    asked = rows.where(F.col("vec_id") % step == 0).dropDuplicates(["vec_id"]).mapInArrow(probe, "query_id long, query array<double>, leaf int")
    per_leaf = asked.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    chunk = F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int")
    questions = asked.join(F.broadcast(per_leaf), "leaf").groupBy("leaf", chunk.alias("chunk")).agg(  # a row per leaf
        F.collect_list("query_id").alias("query_ids"), F.flatten(F.collect_list("query")).alias("queries")
    ).join(small, "leaf").select("leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "query_ids", "queries")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                query_ids, queries, ids, vectors = (batch.column(c)[r].values.to_numpy(zero_copy_only=False) for c in range(4))
                queries, vectors = queries.reshape(len(query_ids), -1), vectors.reshape(len(ids), -1)
                out = []
                for query_id, query in zip(query_ids.tolist(), queries):
                    difference = vectors - query
                    score = np.sqrt((difference * difference).sum(axis=1))
                    other = np.flatnonzero(ids != query_id)
                    best = other[np.lexsort((ids[other], score[other]))[:neighbours]]
                    out.append((np.full(len(best), query_id), ids[best], score[best]))
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out)], ["query_id", "vec_id", "score"])

    found = questions.join(candidates, ["leaf", "block"]).select("query_ids", "queries", "ids", "vectors").mapInArrow(
        compare, "query_id long, vec_id long, score double"
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")
