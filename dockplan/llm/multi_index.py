"""Approximate nearest neighbours by an inverted multi-index (operator 13).

A vector is cut into two halves and each half is quantised by its own centroids, so K centroids a half give K x K cells; a vector
is entered in the cell of its two nearest centroids. A query visits cells by the sum of its two centroid distances: both lists are
sorted, and a heap holds the next pair of each row, so pairs come out in order without forming all of them. It stops once the
visited cells hold ``budget`` entries, and these are reranked by their true distance.

* Centroids are fitted on a sample of about ``SAMPLE_ROWS`` vectors, those whose hash is below a threshold; every vector is entered.
  The number of centroids follows the number of entries up to ``MAX_CENTROIDS``; beyond, cells get fuller and are read in parts.
* ``budget`` is not guessed. For about ``TUNING_QUERIES`` vectors the true neighbours are found against all entries, and the
  budget is what covers the cells of a ``COVERAGE`` share of them. So it follows the data, whatever their size or shape.
* Equal vectors are one entry that keeps its k + 1 smallest ids, all that a result can show; the rank that finds them limits groups
  before the shuffle, so one vector that a third of all rows hold is a few rows a task.
* Entries are dealt to blocks of about ``BLOCK_ROWS``: small cells share a block, large ones are split by a hash. A query is sent once
  to each block that it visits, with its list of cells there, and queries of a block are dealt in parts of ``BLOCK_QUERIES``. Every
  task holds one block and one part; each returns at most k + ties a query, and a rank per query (again limited before the shuffle)
  keeps the k nearest.

What the driver holds: the centroids, the sample (bounded), the counts of at most MAX_CENTROIDS^2 cells, and the tuning queries.

Defined cases. Vectors that are null, empty, zero or hold nulls, NaN or infinity take no part, and neither do rows without an id, which no
result could name. Shorter vectors are read as if padded with zeros. Rows that repeat id and vector count once; an id with several vectors has
a row, and where it is asked for a query, for each of them. A query never finds its own row. Ties go to the smaller id. With fewer than k candidates all are returned. An empty table
gives an empty result. Other columns take no part, whatever their names.
"""

from __future__ import annotations

import heapq
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockplan.llm.common import by_hash, ship, stored, table

SAMPLE_ROWS, MAX_CENTROIDS = 20_000, 256
TUNING_QUERIES, COVERAGE = 64, 0.97
BLOCK_ROWS, BLOCK_QUERIES = 4_096, 2_048


def usable(vector: Column) -> Column:
    """Whether a vector of doubles has only finite components, of which one at least is not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def clean_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows that take part, each once."""
    out = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    # Minus zero and zero are one value.
    out = out.where(F.col("id").isNotNull() & usable(F.col("vector")))
    return out.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0))).distinct()


def distinct_entries(vectors: DataFrame, keep: int) -> DataFrame:
    """(vector, ids): every different vector once, with the smallest ``keep`` ids that hold it."""
    by_vector = Window.partitionBy("vector").orderBy("id")
    few = vectors.withColumn("_rank", F.row_number().over(by_vector)).where(F.col("_rank") <= keep)
    return few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def as_matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` from all rows of ``b``, good enough to compare centroids."""
    return np.maximum((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T, 0)


def lloyd(points: np.ndarray, k: int, rounds: int = 15, seed: int = 0) -> np.ndarray:
    """At most k centroids of ``points``; empty ones restart at the point farthest from its own."""
    rng = np.random.default_rng(seed)
    different = np.unique(points, axis=0)
    centroids = different[rng.choice(len(different), min(k, len(different)), replace=False)]
    for _ in range(rounds):
        d = squared(points, centroids)
        nearest = d.argmin(axis=1)
        members = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        moved = np.where(members[:, None] > 0, sums / np.maximum(members, 1)[:, None], centroids)
        far = np.argsort(-d[np.arange(len(points)), nearest])
        for spare, row in zip(np.flatnonzero(members == 0), far):
            moved[spare] = points[row]
        if np.array_equal(moved, centroids):
            break
        centroids = moved
    return centroids


class MultiIndex:
    """Centroids of both halves and the entries' counts by cell; entries themselves stay in Spark."""

    def __init__(self, sample: np.ndarray, k: int):
        self.width = sample.shape[1]
        self.cut = max(1, self.width // 2)
        self.halves = [lloyd(h, k) if h.shape[1] else np.zeros((1, 0)) for h in self.split(sample)]
        self.counts = np.zeros(0)

    def split(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return m[:, : self.cut], m[:, self.cut :]

    @property
    def cells(self) -> int:
        return len(self.halves[0]) * len(self.halves[1])

    def cell_of(self, m: np.ndarray) -> np.ndarray:
        first, second = (squared(h, c).argmin(axis=1) for h, c in zip(self.split(m), self.halves))
        return first * len(self.halves[1]) + second

    def visits(self, query: np.ndarray):
        """Cells by ascending sum of the two centroid distances."""
        first, second = (squared(h, c)[0] for h, c in zip(self.split(query[None, :]), self.halves))
        by_first, by_second = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        a, b = first[by_first].tolist(), second[by_second].tolist()
        wide, by_first, by_second = len(b), by_first.tolist(), by_second.tolist()
        # The pair (i, j) brings in (i, j + 1), and the first of a row also the next row's first.
        heap = [(a[0] + b[0], 0, 0)]
        while heap:
            _, i, j = heapq.heappop(heap)
            yield by_first[i] * wide + by_second[j]
            if j + 1 < wide:
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))

    def probed(self, query: np.ndarray, budget: int) -> list[int]:
        """The non-empty cells to read for at least ``budget`` entries."""
        out, held, counts = [], 0, self.counts
        for cell in self.visits(query):
            if counts[cell]:
                out.append(cell)
                held += counts[cell]
                if held >= budget:
                    break
        return out

    def costs(self, query: np.ndarray, cells: list[int]) -> list[int]:
        """How many entries a query has read when it has read each of ``cells`` (repeats count again)."""
        sought, out, held = Counter(cells), [], 0
        for cell in self.visits(query):
            held += int(self.counts[cell])
            out += [held] * sought.pop(cell, 0)
            if not sought:
                break
        return out


def nearest_rows(query: np.ndarray, matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``matrix`` up to the k-th distance, ties included, and their distances in double precision."""
    d = np.sqrt(((matrix - query) ** 2).sum(axis=1))
    if len(d) > k:
        rows = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
        return rows, d[rows]
    return np.arange(len(d)), d


def build(entries: DataFrame, rows: int, width: int) -> tuple[MultiIndex, DataFrame]:
    """The index of the ``entries`` (vector, ids), and these written with their cell."""
    sample = by_hash(entries.select("vector"), "vector", SAMPLE_ROWS / rows).collect()
    index = MultiIndex(as_matrix([r[0] for r in sample], width), min(MAX_CENTROIDS, max(1, round(rows**0.5 / 1.5))))

    def enter(batches):
        for batch in batches:
            yield batch.assign(cell=index.cell_of(as_matrix(batch["vector"].to_list(), width)))

    entered = stored(entries.mapInPandas(enter, "vector array<double>, ids array<long>, cell long"))
    counts = np.zeros(index.cells, dtype=np.int64)
    for r in entered.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():  # at most MAX_CENTROIDS squared
        counts[r["cell"]] = r["n"]
    index.counts = counts
    return index, entered


def budget_for(index: MultiIndex, entered: DataFrame, k: int) -> int:
    """Entries a query has to read so that a ``COVERAGE`` share of the true neighbours of the tuning queries is among them."""
    queries = by_hash(entered.select("vector"), "vector", TUNING_QUERIES / max(1, index.counts.sum())).collect()
    if not queries:
        return int(index.counts.sum())
    tuning = as_matrix([r[0] for r in queries], index.width)

    def near(batches):
        best = [(np.empty(0), np.empty(0, dtype=np.int64))] * len(tuning)
        for batch in batches:
            matrix = as_matrix(batch["vector"].to_list(), index.width)
            cells = batch["cell"].to_numpy()
            for q, query in enumerate(tuning):
                rows, d = nearest_rows(query, matrix, k + 1)
                d, held = np.concatenate([best[q][0], d]), np.concatenate([best[q][1], cells[rows]])
                first = np.argsort(d, kind="stable")[: k + 1]
                best[q] = d[first], held[first]
        yield pd.concat([pd.DataFrame({"q": q, "cell": cells, "d": d}) for q, (d, cells) in enumerate(best)])

    found = entered.select("vector", "cell").mapInPandas(near, "q int, cell long, d double")
    rank = F.row_number().over(Window.partitionBy("q").orderBy("d", "cell"))
    found = found.withColumn("_rank", rank).where(F.col("_rank") <= k + 1)
    costs = []
    for q, part in found.toPandas().groupby("q"):  # at most k + 1 rows a tuning query
        costs += index.costs(tuning[q], part["cell"].tolist())
    costs = np.sort(np.array(costs))
    return max(k + 1, int(costs[min(len(costs) - 1, int(np.ceil(COVERAGE * len(costs))) - 1)]))


def nearest(rows: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            budget: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for the rows where ``queries`` (over ``id``) holds.

    ``budget`` is the number of entries to read for a query; None measures it.
    """
    spark = rows.sparkSession
    ship(spark)
    result = "query_id long, rank int, vec_id long, score double"
    vectors = stored(clean_vectors(rows, id_col, vector_col))
    asked = vectors.where(queries)
    shape = vectors.agg(F.max(F.size("vector")).alias("width"), F.count_if(queries).alias("asked")).first()
    if not shape["asked"]:
        return spark.createDataFrame([], result)
    width = shape["width"]
    entries = stored(distinct_entries(vectors, k + 1))
    n = entries.count()
    index, entered = build(entries, n, width)
    read = min(n, budget_for(index, entered, k) if budget is None else max(budget, k + 1))

    parts = np.maximum(1, -(-index.counts // BLOCK_ROWS))
    # Cells of less than a block share one: a cell's block is where the running total of its entries falls.
    total = np.cumsum(np.where(parts == 1, index.counts, 0))
    shared = np.maximum(total - 1, 0) // BLOCK_ROWS
    own = shared[-1] + 1 + np.cumsum(np.where(parts > 1, parts, 0)) - parts
    first_block = np.where(parts > 1, own, shared)
    query_parts = max(1, -(-shape["asked"] // BLOCK_QUERIES))

    def place(batches):
        for batch in batches:
            cell, h = batch["cell"].to_numpy(), batch["h"].to_numpy()
            yield batch.assign(block=first_block[cell] + h % parts[cell]).drop(columns="h")

    def probe(batches):
        for batch in batches:
            out = []
            for i, query in zip(batch["id"], as_matrix(batch["vector"].to_list(), width)):
                cells = np.array(index.probed(query, read))
                blocks = np.concatenate([np.arange(first_block[c], first_block[c] + parts[c]) for c in cells])
                cells = np.repeat(cells, parts[cells])
                for block in np.unique(blocks):
                    out.append((block, i, query, cells[blocks == block]))
                if len(out) >= 500:
                    yield pd.DataFrame(out, columns=["block", "id", "vector", "cells"])
                    out = []
            if out:
                yield pd.DataFrame(out, columns=["block", "id", "vector", "cells"])

    h = F.pmod(F.xxhash64("vector"), F.lit(1 << 30)).alias("h")
    blocks = entered.select("vector", "ids", "cell", h).mapInPandas(place, "vector array<double>, ids array<long>, cell long, block long")
    blocks = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1))))
    probes = asked.mapInPandas(probe, "block long, id long, vector array<double>, cells array<long>")
    probes = probes.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(query_parts)).cast("int"))

    def rerank(probes: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        matrix = as_matrix(held["vector"].to_list(), width)
        cells, ids = held["cell"].to_numpy(), held["ids"].to_list()
        out = []
        for i, query, visited in zip(probes["id"], as_matrix(probes["vector"].to_list(), width), probes["cells"]):
            inside = np.flatnonzero(np.isin(cells, visited))
            # The query's own entry may be one of these, hence one more; every entry has all ids that can count.
            rows, d = nearest_rows(query, matrix[inside], k + 1)
            met = sorted((s, j) for row, s in zip(inside[rows], d) for j in ids[row] if j != i or s > 0)[:k]
            out += [(i, query.tobytes(), j, s) for s, j in met]
        return pd.DataFrame(out, columns=["query_id", "asked", "vec_id", "score"])

    found = probes.groupBy("block", "part").cogroup(blocks.groupBy("block", "part")).applyInPandas(
        rerank, "query_id long, asked binary, vec_id long, score double")
    by_query = Window.partitionBy("query_id", "asked").orderBy("score", "vec_id")
    out = found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")


def op13_multi_index_neighbours(spark, sf_dir: str) -> DataFrame:
    """The 10 nearest of every hundredth vector of ``embeddings``, among all of them."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)
