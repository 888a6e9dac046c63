"""Approximate nearest neighbours by an inverted multi-index.

Both halves of the vectors are quantised separately; a cell is a pair of centroids. A query walks the pairs in
falling order of its summed inner products with them, with a heap, until the cells hold enough entries, and
these entries are ranked by their exact inner product. How many are enough is measured while fitting: the
smallest share of all entries that reaches ``RECALL`` on a sample, against brute force over the sample.

Equal vectors are one entry with the ids that could be in any result (the ``k`` + 1 smallest), so a vector that
many rows share costs no more than another. Cells are gathered into blocks of entries of a bounded size and a
large cell is spread over several blocks; a block meets its queries in groups of bounded size.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from breathline.llm.base import kept

RECALL = 0.97
SAMPLE = 16_384
PROBES = 256
BLOCK = 4096
QUERIES_AT_ONCE = 1024
RESULT = "query_id long, rank int, vec_id long, score double"


@dataclass
class Index:
    left: np.ndarray
    right: np.ndarray
    share: float

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return vectors[:, : self.left.shape[1]], vectors[:, self.left.shape[1]:]

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        one, two = self.halves(vectors)
        return nearest(one, self.left) * len(self.right) + nearest(two, self.right)

    def walk(self, query: np.ndarray, counts: np.ndarray, wanted: float) -> list[int]:
        """Cells by falling sum, until they hold ``wanted`` entries; empty cells are passed over."""
        one, two = self.left @ query[: self.left.shape[1]], self.right @ query[self.left.shape[1]:]
        first, second = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
        a, b = one[first].tolist(), two[second].tolist()
        first, second, width = first.tolist(), second.tolist(), len(b)
        heap, seen, found, visited = [(-(a[0] + b[0]), 0, 0)], {(0, 0)}, 0, []
        while heap and found < wanted:
            _, i, j = heapq.heappop(heap)
            cell = first[i] * width + second[j]
            if counts[cell]:
                visited.append(cell)
                found += counts[cell]
            for ni, nj in ((i + 1, j), (i, j + 1)):
                if ni < len(a) and nj < width and (ni, nj) not in seen:
                    seen.add((ni, nj))
                    heapq.heappush(heap, (-(a[ni] + b[nj]), ni, nj))
        return visited


def nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    if not len(points) or not points.shape[1]:
        return np.zeros(len(points), dtype=np.int64)
    return np.argmin((centroids ** 2).sum(axis=1) - 2 * points @ centroids.T, axis=1)


def quantised(points: np.ndarray, count: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's centroids of a bounded sample; a centroid that loses its points keeps its place."""
    centroids = points[np.linspace(0, len(points) - 1, count).astype(int)].copy()
    for _ in range(rounds):
        owner = nearest(points, centroids)
        sizes = np.bincount(owner, minlength=count)
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, points)
        centroids[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centroids


def fit(sample: np.ndarray, rows: int, k: int) -> Index:
    """Centroids and the share of entries to visit, from a bounded sample of the entries. The nearest ``k`` of
    the sample lie further out than those of all rows, so the share errs on the safe side."""
    count = int(min(256, len(sample), max(2, 2 ** round(math.log2(max(4, math.sqrt(rows / 50)))))))
    half = sample.shape[1] // 2
    index = Index(quantised(sample[:, :half], count), quantised(sample[:, half:], count), 1.0)
    cells = index.cells(sample)
    counts = np.bincount(cells, minlength=count * count)
    reached = []
    for probe in np.linspace(0, len(sample) - 1, min(PROBES, len(sample))).astype(int):
        scores = sample @ sample[probe]
        scores[probe] = -np.inf
        best = np.argsort(-scores, kind="stable")[: min(k, len(sample) - 1)]
        visited = np.array(index.walk(sample[probe], counts, len(sample)))
        at = np.zeros(count * count)
        at[visited] = np.cumsum(counts[visited]) / len(sample)
        reached.append(at[cells[best]])
    needed = np.sort(np.concatenate(reached)) if reached else np.array([])
    if len(needed):
        index.share = float(needed[min(len(needed) - 1, math.ceil(RECALL * len(needed)))])
    return index


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vectors(rows: DataFrame, id_name: str, vector_name: str) -> DataFrame:
    """Rows that take part: finite, not zero, of the most common length (the smaller of two as common)."""
    chosen = rows.select(
        F.col(id_name).cast("long").alias("vec_id"), F.col(vector_name).cast(ArrayType(DoubleType())).alias("vector")
    ).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    lengths = chosen.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    return chosen.where(F.size("vector") == (lengths["length"] if lengths else 0))


def search(
    rows: DataFrame, queries: Column, k: int = 20, id_name: str = "vec_id", vector_name: str = "embedding"
) -> DataFrame:
    """The ``k`` nearest other rows, by largest inner product, of every row that ``queries`` (a condition on
    vec_id) selects: query_id, rank, vec_id, score; ties go to the smaller id.

    Null, zero and non-finite vectors, vectors of an odd length and null ids take no part. Rows that repeat an
    id with the same vector count once. With fewer than ``k`` candidates all that were found are returned; an
    empty table gives no rows. Other columns are ignored.
    """
    spark = rows.sparkSession
    taking = vectors(rows, id_name, vector_name)
    same = Window.partitionBy("vector").orderBy("vec_id")
    entries = (
        taking.withColumn("place", F.dense_rank().over(same)).where(F.col("place") <= k + 1)
        .groupBy("vector").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
        .withColumn("entry", F.col("ids")[0])
    )
    entries = kept(entries, "ann-entries")
    total = entries.count()
    if total == 0:
        return spark.createDataFrame([], RESULT)
    drawn = entries.select("vector", "entry").orderBy(F.xxhash64("entry"), "entry").limit(SAMPLE).collect()
    index = fit(np.array([row["vector"] for row in drawn]), total, k)
    placed = kept(entries.mapInPandas(_placing(index), "entry long, ids array<long>, vector array<double>, cell int"),
                  "ann-cells")
    counts = np.zeros(len(index.left) * len(index.right), dtype=np.int64)
    for row in placed.groupBy("cell").count().collect():
        counts[row["cell"]] = row["count"]
    first, spread = _blocks(counts)

    asked = taking.where(queries)
    probes = asked.groupBy("vector").agg(F.min("vec_id").alias("probe"))
    wanted = max(index.share * total, min(total, 4 * k))
    visits = probes.mapInPandas(
        _visiting(index, counts, wanted, first, spread), "block long, lot int, probe long, vector array<double>, cells array<int>"
    )
    lots = max(1, math.ceil(probes.count() / (4 * QUERIES_AT_ONCE)))
    visits = visits.withColumn("lot", F.pmod(F.xxhash64("probe"), F.lit(lots)).cast("int"))
    offered = _in_blocks(placed, first, spread).withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))))
    ranked = (
        visits.groupBy("block", "lot").cogroup(offered.groupBy("block", "lot"))
        .applyInPandas(_ranking(k + 1), "probe long, ids array<long>, score double")
    )
    by_score = Window.partitionBy("probe").orderBy(F.desc("score"), "vec_id")
    best = (
        ranked.select("probe", "score", F.explode("ids").alias("vec_id"))
        .withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= k + 1)
        .groupBy("probe").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    )
    return (
        asked.select(F.col("vec_id").alias("query_id"), "vector").distinct()
        .join(probes, "vector").join(best, "probe")
        .select("query_id", F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, k).alias("found"))
        .select("query_id", F.posexplode("found").alias("at", "one"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "one.vec_id", "one.score")
    )


def _placing(index: Index):
    def place(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                cell = index.cells(np.stack(batch["vector"].to_numpy())).astype(np.int32)
                yield batch.assign(cell=cell)[["entry", "ids", "vector", "cell"]]

    return place


def _blocks(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of each cell. Small cells share a block of about ``BLOCK`` entries, a
    larger one has blocks of its own."""
    spread = np.maximum(1, -(-counts // BLOCK))
    first, block, filled = np.zeros_like(counts), 0, 0
    for cell, count in enumerate(counts.tolist()):
        if filled and filled + count > BLOCK:
            block, filled = block + 1, 0
        first[cell] = block
        filled += count
        if spread[cell] > 1:
            block, filled = block + int(spread[cell]), 0
    return first, spread


def _in_blocks(placed: DataFrame, first: np.ndarray, spread: np.ndarray) -> DataFrame:
    def assign(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cell = batch["cell"].to_numpy()
            block = first[cell] + batch["entry"].to_numpy() % spread[cell]
            yield batch.assign(block=block)[["block", "entry", "ids", "vector", "cell"]]

    return placed.mapInPandas(assign, "block long, entry long, ids array<long>, vector array<double>, cell int")


def _visiting(index: Index, counts: np.ndarray, wanted: float, first: np.ndarray, spread: np.ndarray):
    """One row per query and block that holds any of its cells."""

    def visit(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for probe, vector in zip(batch["probe"], batch["vector"]):
                blocks: dict[int, list[int]] = {}
                for cell in index.walk(np.asarray(vector), counts, wanted):
                    for block in range(first[cell], first[cell] + spread[cell]):
                        blocks.setdefault(int(block), []).append(cell)
                rows += [(block, 0, probe, vector, cells) for block, cells in blocks.items()]
            yield pd.DataFrame(rows, columns=["block", "lot", "probe", "vector", "cells"])

    return visit


def _ranking(count: int):
    """The best entries of one block for each query that visits it, cell by cell."""

    def rank(asked: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        made: list[tuple] = []
        if len(asked) and len(offered):
            offered = offered.sort_values(["cell", "entry"], kind="stable")
            points, cell = np.stack(offered["vector"].to_numpy()), offered["cell"].to_numpy()
            ids, entry = offered["ids"].to_numpy(), offered["entry"].to_numpy()
            names, starts = np.unique(cell, return_index=True)
            ends = np.append(starts[1:], len(cell))
            for at in range(0, len(asked), QUERIES_AT_ONCE):
                part = asked.iloc[at:at + QUERIES_AT_ONCE]
                vectors = np.stack(part["vector"].to_numpy())
                visiting: dict[int, list[int]] = {}
                for row, cells in enumerate(part["cells"]):
                    for name in cells:
                        visiting.setdefault(int(name), []).append(row)
                scores = np.full((len(part), len(points)), -np.inf)
                for name, start, end in zip(names.tolist(), starts, ends):
                    if name in visiting:
                        chosen = np.array(visiting[name])
                        scores[chosen, start:end] = vectors[chosen] @ points[start:end].T
                for probe, line in zip(part["probe"].to_numpy(), scores):
                    top = _top(line, entry, count)
                    made += [(probe, ids[i], line[i]) for i in top]
        return pd.DataFrame(made, columns=["probe", "ids", "score"])

    return rank


def _top(line: np.ndarray, entry: np.ndarray, count: int) -> np.ndarray:
    """Places of the highest finite scores, ties to the smaller entry."""
    if len(line) > count:
        bound = np.partition(line, len(line) - count)[len(line) - count]
        places = np.flatnonzero(line >= bound)
    else:
        places = np.arange(len(line))
    places = places[line[places] > -np.inf]
    return places[np.lexsort((entry[places], -line[places]))][:count]
