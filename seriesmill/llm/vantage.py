"""Operator 3: approximate nearest neighbours with vantage-point trees per shard.

Vectors are dealt into shards of bounded size; each shard gets a vantage-point tree, stored as one row
of arrays. A block of queries walks a tree together: at each node a query first enters the side its
distance to the vantage point says, then the other one if the triangle inequality cannot rule it out.
The ruling-out radius is divided by ``relax``: with 1 the search is exact, larger values prune more. In many
dimensions distances differ little, so only values well above 1 prune at all; measure recall when choosing one.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor
do rows without an id; only vectors of the same length are compared; fewer candidates than ``k``: all of
them; ties go to the smaller id; repeated ids are separate candidates, but never of a query with that id;
a query row that is there several times is asked once; queries of one id with different vectors have ranks of their own;
no query or no candidate: no row; other columns are not carried.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesmill.llm.common import stored

LEAF = 64
SHARD_ROWS = 8192
QUERY_ROWS = 1024


def usable(vec: Column) -> Column:
    """Not null, not zero, all components finite."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vec, lambda x: x != 0)


def vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec double[]) of the rows that take part."""
    own = table.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return own.where(F.col("vec_id").isNotNull() & usable(F.col("vec")))


# --- one tree ----------------------------------------------------------------------------------


def distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """(points, others) Euclidean distances in double precision, from differences."""
    out = np.empty((len(points), len(others)))
    for i in range(len(points)):
        gap = others - points[i]
        out[i] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    return out


class Tree:
    """Arrays of a vantage-point tree: rows of a node lie between ``lo`` and ``hi``; inner nodes have a vantage row, the
    median distance and the distance ranges of both sides; children follow in depth-first order."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, seed: int = 0, leaf: int = LEAF):
        order = np.lexsort((np.arange(len(ids)), ids))
        self.ids, self.points = ids[order], points[order]
        rng = np.random.default_rng(seed)
        nodes: list[list[float]] = []
        place = np.arange(len(ids))
        todo = [(0, len(ids), -1, 0)]
        while todo:
            lo, hi, parent, side = todo.pop()
            me = len(nodes)
            nodes.append([lo, hi, -1, 0, 0, 0, 0, 0, -1, -1])
            if parent >= 0:
                nodes[parent][8 + side] = me
            if hi - lo <= leaf:
                continue
            vantage = place[lo + rng.integers(hi - lo)]
            d = distances(self.points[vantage][None], self.points[place[lo:hi]])[0]
            if d.max() == 0:
                continue  # all equal: a leaf, whatever its size
            median = np.partition(d, (hi - lo) // 2)[(hi - lo) // 2]
            near = d <= median if (d > median).any() else d < median
            nodes[me][2:8] = [vantage, median, d[near].min(), d[near].max(), d[~near].min(), d[~near].max()]
            place[lo:hi] = np.concatenate([place[lo:hi][near], place[lo:hi][~near]])
            middle = lo + int(near.sum())
            todo += [(middle, hi, me, 1), (lo, middle, me, 0)]
        self.nodes, self.place = np.array(nodes, float), place

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, ids=self.ids, points=self.points, nodes=self.nodes, place=self.place)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Tree:
        tree = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as held:
            tree.ids, tree.points, tree.nodes, tree.place = (held[n] for n in ("ids", "points", "nodes", "place"))
        return tree

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, relax: float) -> tuple[np.ndarray, np.ndarray]:
        """(queries, k) ids and distances, padded with -1 and infinity; ties to smaller ids."""
        best_d = np.full((len(queries), k), np.inf)
        best_i = np.full((len(queries), k), np.iinfo("i8").max)

        def leaf(lo: int, hi: int, who: np.ndarray) -> None:
            rows = self.place[lo:hi]
            ids = self.ids[rows]
            d = distances(queries[who], self.points[rows])
            d[query_ids[who][:, None] == ids] = np.inf
            all_d = np.concatenate([best_d[who], d], axis=1)
            all_i = np.concatenate([best_i[who], np.broadcast_to(ids, d.shape)], axis=1)
            all_i[np.isinf(all_d)] = np.iinfo("i8").max
            order = np.lexsort((all_i, all_d), axis=1)[:, :k]
            best_d[who] = np.take_along_axis(all_d, order, 1)
            best_i[who] = np.take_along_axis(all_i, order, 1)

        def visit(node: int, who: np.ndarray) -> None:
            lo, hi, vantage, median, *ranges, near, far = self.nodes[node]
            if near < 0:
                leaf(int(lo), int(hi), who)
                return
            d = distances(self.points[int(vantage)][None], queries[who])[0]
            sides = [(int(near), *ranges[:2]), (int(far), *ranges[2:])]
            first = d > median
            for side in (0, 1):  # own side first
                if (own := first == side).any():
                    visit(sides[side][0], who[own])
            for side in (0, 1):  # then the other one, where it may hold something nearer
                child, low, high = sides[side]
                gap = np.maximum(low - d, d - high)
                other = (first != side) & (gap * relax <= best_d[who, -1])
                if other.any():
                    visit(child, who[other])

        if len(self.ids) and len(queries):
            visit(0, np.arange(len(queries)))
        return np.where(np.isinf(best_d), -1, best_i), best_d


# --- on Spark ----------------------------------------------------------------------------------


def build_index(candidates: DataFrame, shard_rows: int = SHARD_ROWS, leaf: int = LEAF) -> DataFrame:
    """(shard, dim, tree): every vector in one shard, a tree per shard. Shard sizes are even whatever the vectors are."""
    shards = max(1, -(-candidates.count() // shard_rows))
    dealt = candidates.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(shards))).withColumn("dim", F.size("vec"))

    def build(key, pdf: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(pdf["vec_id"].to_numpy("i8"), np.array(pdf["vec"].tolist(), float), seed=int(key[0]), leaf=leaf)
        return pd.DataFrame({"shard": [key[0]], "dim": [key[1]], "tree": [tree.dump()]})

    return dealt.groupBy("shard", "dim").applyInPandas(build, "shard bigint, dim int, tree binary")


def search(index: DataFrame, queries: DataFrame, k: int = 10, relax: float = 1.0, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query, over all shards of a stored index.

    Queries are put into blocks of bounded size; each block goes to each shard and brings back ``k`` rows per query.
    """
    # A query that is there twice is asked once; queries of one id with different vectors are told apart by their vectors.
    queries = queries.dropDuplicates(["vec_id", "vec"]).withColumn("q", F.xxhash64("vec"))
    blocks = max(1, -(-queries.count() // query_rows))

    def gather(key, pdf: pd.DataFrame) -> pd.DataFrame:
        held = io.BytesIO()
        np.savez(held, ids=pdf["vec_id"].to_numpy("i8"), points=np.array(pdf["vec"].tolist(), float), q=pdf["q"].to_numpy("i8"))
        return pd.DataFrame({"dim": [key[1]], "block": [key[0]], "queries": [held.getvalue()]})

    grouped = (
        queries.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(11)), F.lit(blocks)))
        .groupBy("block", F.size("vec").alias("dim"))
        .applyInPandas(gather, "dim int, block bigint, queries binary")
    )
    # The small blocks are repeated, once per shard; a tree is sent once, to the task of its shard.
    last = index.agg(F.max("shard")).first()[0]
    grouped = grouped.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last or 0).cast("bigint"))))
    work = index.join(grouped, ["shard", "dim"]).select("tree", "queries")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for tree, block in zip(pdf["tree"], pdf["queries"]):
                with np.load(io.BytesIO(block)) as held:
                    ids, points, q = held["ids"], held["points"], held["q"]
                found, d = Tree.load(tree).search(ids, points, k, relax)
                keep = np.isfinite(d)
                yield pd.DataFrame({"query_id": np.repeat(ids, keep.sum(1)), "q": np.repeat(q, keep.sum(1)), "vec_id": found[keep], "score": d[keep]})

    hits = work.mapInPandas(run, "query_id bigint, q bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id", "q").orderBy("score", "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(table: DataFrame, queries: DataFrame, k: int = 10, relax: float = 1.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Index all of ``table``, store the index, search it with all of ``queries``."""
    index = stored(build_index(vectors(table, id_col, vec_col)), "vantage")
    return search(index, vectors(queries, id_col, vec_col), k, relax)
