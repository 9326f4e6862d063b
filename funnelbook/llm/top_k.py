"""Exact top-k search by columnar branch and bound over vertically stored blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of one block of candidates and of one block of queries; a task holds one of each.
CANDIDATES = 1024
QUERIES = 2048
#: Dimensions whose products are added before candidates are compared with the bounds again.
STEP = 8
#: Products up to this sum are exact in 64-bit floats; beyond it whole numbers of any size are used.
EXACT = float(1 << 52)
LONG = (1 << 63) - 1


def _columns(vectors: pa.ListArray, scale: float) -> np.ndarray:
    """Whole numbers in vertical layout: one row of the array for each dimension. Shorter vectors are filled with zeros."""
    flat, ends = vectors.values.to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()
    sizes = np.diff(ends)
    out = np.zeros((sizes.max(initial=0), len(sizes)))
    place = np.arange(ends[0], ends[-1]) - np.repeat(ends[:-1], sizes)
    out[place, np.repeat(np.arange(len(sizes)), sizes)] = np.floor(scale * flat[ends[0] : ends[-1]])
    return out


def _mass(columns: np.ndarray, cuts: list[int]) -> np.ndarray:
    """Length of each vector's remaining dimensions at each cut, rounded up."""
    squares = np.vstack([np.square(columns[a:b]).sum(axis=0) for a, b in zip(cuts, cuts[1:])] or [np.zeros((0, columns.shape[1]))])
    rest = np.vstack([np.cumsum(squares[::-1], axis=0)[::-1], np.zeros((1, columns.shape[1]))])
    return np.sqrt(rest) * (1 + 1e-12)


def best(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(number of the query, candidate id, score) of each query's k best in one block, ties to the smaller id.

    All products of the first dimensions are added at once. After each step a candidate's score lies within the product of
    the remaining masses; candidates whose upper bound is below the k-th best lower bound go, the others move together.
    """
    width = max(queries.shape[0], rows.shape[0])
    queries, rows = (np.vstack([x, np.zeros((width - x.shape[0], x.shape[1]))]) for x in (queries, rows))
    if np.sqrt(np.square(queries).sum(axis=0)).max(initial=0) * np.sqrt(np.square(rows).sum(axis=0)).max(initial=0) >= EXACT:
        yield from _unbounded(queries, query_ids, rows, ids, k)
        return
    order = np.argsort(-np.square(rows).sum(axis=1), kind="stable")  # the heaviest dimensions first
    queries, rows = np.ascontiguousarray(queries[order]), np.ascontiguousarray(rows[order])
    cuts = [*range(0, width, STEP), width]
    mass, own = _mass(rows, cuts), _mass(queries, cuts)
    first = queries[:STEP].T @ rows[:STEP]
    for q in range(queries.shape[1]):
        at = np.flatnonzero(ids != query_ids[q])
        score = first[q, at]
        for c in range(1, len(cuts) - 1):
            if len(at) > k:
                slack = own[c, q] * mass[c, at]
                floor = np.partition(score - slack, len(at) - k)[len(at) - k]
                stay = np.flatnonzero(score + slack >= floor - 1e-6 * (1 + abs(floor)))
                at, score = at[stay], score[stay]
            a, b = cuts[c], cuts[c + 1]
            score = score + queries[a:b, q] @ rows[a:b, at]
        top = np.lexsort((ids[at], -score))[:k]
        for t in top:
            yield q, int(ids[at[t]]), int(score[t])


def _unbounded(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    whole = [[int(x) for x in v] for v in rows.T]
    for q in range(queries.shape[1]):
        own = [int(x) for x in queries[:, q]]
        scores = [(max(-LONG - 1, min(LONG, sum(a * b for a, b in zip(own, v)))), i) for v, i in zip(whole, ids.tolist()) if i != query_ids[q]]
        for s, i in sorted(scores, key=lambda x: (-x[0], x[1]))[:k]:
            yield q, i, s


def top_k(
    vectors: DataFrame, queries: DataFrame, *, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """For each query the ``k`` candidates of highest inner product: ``query_id``, ``rank`` (from 1), id, ``score``.

    Components are floor(``scale`` * x), x as double, so scores are whole numbers and exact; scores beyond 64 bits are
    held at the end of the range. Ties go to the smaller id; a row with the query's id is no candidate. Vectors that are
    null or hold null or non-finite components take no part, nor do null ids; of vectors of different length the shorter one counts as
    filled with zeros. A row that is repeated is a candidate and a query of its own each time. Empty tables give no rows. Other
    columns are ignored.

    Queries and candidates are dealt to blocks of about fixed size, and each pair of blocks is one unit of work, so memory
    does not grow with the tables; blocks travel as often as there are blocks on the other side, which costs about a tenth of
    the multiplications. The k best of each pair are cut again for each query before the shuffle that merges them.
    """
    finite = F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    taken = lambda df: df.select(F.col(id_col).cast("long").alias("i"), F.col(vector_col).cast("array<double>").alias("v")).where(
        F.col("i").isNotNull() & F.col("v").isNotNull() & finite & ~F.exists("v", F.isnan)
    )
    rows, asked = taken(vectors), taken(queries)
    n_rows, n_asked = (max(1, -(-df.count() // size)) for df, size in ((rows, CANDIDATES), (asked, QUERIES)))
    deal = lambda n: F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")
    others = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = rows.withColumn("r", deal(n_rows)).withColumn("a", others(n_asked))
    asked = asked.withColumn("n", F.monotonically_increasing_id()).withColumn("a", deal(n_asked)).withColumn("r", others(n_rows))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, asked = (_columns(t.column("v").combine_chunks(), scale) for t in (left, right))
        number, own = right.column("n").to_numpy(), right.column("i").to_numpy()
        found = list(best(asked, own, rows, left.column("i").to_numpy(), k)) if len(own) and left.num_rows else []
        at = [q for q, _, _ in found]
        return pa.table(
            {
                "n": pa.array(number[at], pa.int64()),
                "query_id": pa.array(own[at], pa.int64()),
                id_col: pa.array([i for _, i, _ in found], pa.int64()),
                "score": pa.array([x for _, _, x in found], pa.int64()),
            }
        )

    met = rows.groupBy("a", "r").cogroup(asked.groupBy("a", "r")).applyInArrow(cell, f"n long, query_id long, `{id_col}` long, score long")
    order = Window.partitionBy("n").orderBy(F.col("score").desc(), id_col)
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", id_col, "score")
