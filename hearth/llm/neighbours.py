"""Nearest neighbours by cosine with randomly rotated one-bit codes.

A unit vector is turned by a random rotation and only the sign of each component
is kept, packed into bits, with one correction scalar: the inner product of the
vector with its own code. Dividing a query's inner product with the code by that
scalar estimates the cosine without bias, and the scalar gives a bound on the
error. In a block of candidates, the k-th highest lower bound is a value that a
result must reach; every candidate whose upper bound does is scored exactly, in
double precision, on the original vectors. Nothing is left out of the index, and
no number of candidates is fixed.

Queries and candidates are packed into blocks of a fixed number of vectors, in 32 bits where these hold them exactly. Candidate blocks are
numbered, stay in one piece, and are dealt over the tasks in groups; the query blocks, far fewer vectors, are sent to
every group by an equality join on its number, one after the other. Neither side passes the driver. Every
meeting gives the best k of each query, which are ranked by query. Work grows with queries times
rows, as the stated query set does.

Vectors that are null, empty or zero, or that hold a null or a number that is not
finite, take no part, nor do rows without an id. Rows of the query's own id are
the query's own. Vectors of different length are not compared. Ties go to the smaller id. A row that
repeats, id and vector, counts once. Only the named columns are read, so other columns cannot clash. An empty table has no neighbours.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import map_batches, materialize

BLOCK = 4096
QUERIES = 1024
#: Standard deviations of the estimate's error that bounds allow for: such that they hold, and those of a search, which rescores a third of all candidates with them.
DEVIATIONS = 4.0
SEARCH_DEVIATIONS = 2.0
SEED = 11
MOST_TASKS = 10_000
#: Candidate blocks that the query blocks are sent to together, at most, and groups of them, if there are as many blocks.
GROUP, LEAST_GROUPS = 16, 32


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def codes(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits of the turned vectors, and each one's inner product with its code."""
    turned = unit @ turn
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(unit.shape[1])


def estimates(bits: np.ndarray, own: np.ndarray, queries: np.ndarray, turn: np.ndarray, deviations: float = DEVIATIONS) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines (query by candidate) and each candidate's error bound."""
    dim = queries.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    with_code = (queries @ turn).astype(np.float32) @ signs.T / np.float32(np.sqrt(dim))
    error = deviations * np.sqrt(np.maximum(0, 1 - own**2)) / own / np.sqrt(max(1, dim - 1)) + 1e-6
    return with_code / own.astype(np.float32), error.astype(np.float32)


def nearest(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, bits: np.ndarray, own: np.ndarray, k: int, deviations: float = SEARCH_DEVIATIONS):
    """(query, id, cosine) of each query's k nearest among the candidates ``v``."""
    turn = rotation(q.shape[1])
    q_norm, norm = np.sqrt((q * q).sum(axis=1)), np.sqrt((v * v).sum(axis=1))
    est, err = estimates(bits, own, q / q_norm[:, None], turn, deviations)
    mine = q_ids[:, None] == ids[None, :]
    low = np.where(mine, -np.inf, est - err)
    k_here = min(k, len(ids))
    floor = np.partition(low, len(ids) - k_here, axis=1)[:, len(ids) - k_here]
    i, j = np.nonzero((est + err >= floor[:, None]) & ~mine)
    score = np.empty(len(i))
    for at in range(0, len(i), 1 << 16):
        a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        score[at : at + (1 << 16)] = np.einsum("ij,ij->i", q[a], v[b]) / (q_norm[a] * norm[b])
    order = np.lexsort((ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    rank = np.arange(len(i)) - np.searchsorted(i, i)
    keep = rank < k
    return q_ids[i[keep]], ids[j[keep]], score[keep]


def _packed(v: np.ndarray) -> bytes:
    """The numbers in 32 bits each if all of them fit exactly, else in 64."""
    short = v.astype(np.float32)
    return (short if (short == v).all() else v).tobytes()


def _unpacked(data: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, np.float32 if len(data) == 4 * n * dim else np.float64).reshape(n, dim).astype(np.float64)


def _blocks(df: DataFrame, rows: int, coded: bool) -> DataFrame:
    """Rows (dim, n, ids, vectors, bits, own): up to ``rows`` vectors of one length in each."""
    schema = "dim int, n int, ids binary, vectors binary, bits binary, own binary"

    def run(batches):
        held: dict[int, tuple[list, list]] = {}
        seen: dict[int, set[tuple[int, bytes]]] = {}  # of the blocks held; a block has a repeated row once

        def emit(dim: int) -> pa.RecordBatch:
            ids, vectors = held.pop(dim)
            seen.pop(dim)
            v = np.array(vectors, np.float64)
            v = np.ldexp(v, -np.frexp(np.abs(v).max(axis=1))[1][:, None])  # a power of two leaves the cosine as it is and keeps squares finite
            bits, own = codes(v / np.sqrt((v * v).sum(axis=1))[:, None], rotation(dim)) if coded else (np.empty(0, np.uint8), np.empty(0))
            cols = [pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32()), *(pa.array([x], pa.binary()) for x in (np.array(ids, np.int64).tobytes(), _packed(v), bits.tobytes(), own.tobytes()))]
            return pa.RecordBatch.from_arrays(cols, names=["dim", "n", "ids", "vectors", "bits", "own"])

        for b in batches:
            for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids, vectors = held.setdefault(len(x), ([], []))
                row, rows_seen = (i, (np.array(x, np.float64) + 0.0).tobytes()), seen.setdefault(len(x), set())
                if row in rows_seen:
                    continue
                rows_seen.add(row)
                ids.append(i)
                vectors.append(x)
                if len(ids) == rows:
                    yield emit(len(x))
        for dim in list(held):
            yield emit(dim)

    return df.mapInArrow(run, schema)


def _met(queries: DataFrame, held: DataFrame) -> DataFrame:
    """Every block of ``queries`` (dim, n, ids, vectors) beside every one of ``held`` (besides: bits, own, key) of its length."""
    # one small row for each block is numbered, and written, so that Spark knows how small they are; ids and vectors stay where they are
    number = F.row_number().over(Window.partitionBy("dim").orderBy("key")) - 1
    numbers = materialize(held.select("dim", "key").withColumn("number", number), "nearest-numbers")
    total = numbers.count()
    each = min(GROUP, max(1, total // max(LEAST_GROUPS, 4 * held.sparkSession.sparkContext.defaultParallelism)))
    group = F.floor(F.col("number") / each).cast("int")
    candidates = held.join(numbers.select("dim", "key", group.alias("group")), ["dim", "key"]).drop("key")
    groups = numbers.groupBy("dim").agg(F.max(group).alias("last"))  # one row for each length of vectors
    asked = queries.join(F.broadcast(groups), "dim").select("dim", F.explode(F.sequence(F.lit(0), "last")).alias("group"), F.col("n").alias("qn"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q"))
    # more tasks than groups: by their bytes they would be merged, but each has much to compute
    asked = asked.repartition(min(4 * max(1, -(-total // each)), MOST_TASKS), "dim", "group")
    # Spark sizes the asked blocks as the queries before they were sent to every group, and would broadcast them; so this join sorts
    return asked.join(candidates.hint("merge"), ["dim", "group"])


def search(vectors: DataFrame, is_query: Column, k: int, id_col: str, vector_col: str, deviations: float = SEARCH_DEVIATIONS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of every query row, nearest first."""
    x = F.col("v")
    good = vectors.withColumn("__q", is_query).select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"), "__q")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    good = good.where(F.col("id").isNotNull() & (F.size(x) > 0) & finite & F.exists(x, lambda c: c != 0))
    queries = materialize(_blocks(good.where("__q").dropDuplicates(["id", "v"]).select("id", "v"), QUERIES, False), "nearest-queries")
    held = materialize(_blocks(good.select("id", "v"), BLOCK, True).withColumn("key", F.monotonically_increasing_id()), "nearest-candidates")  # the keys are fixed from here on
    met = _met(queries, held)

    def make():
        def step(b: pa.RecordBatch):
            for r in b.to_pylist():
                n, qn, dim = r["n"], r["qn"], r["dim"]
                got = nearest(
                    np.frombuffer(r["q_ids"], np.int64), _unpacked(r["q"], qn, dim), np.frombuffer(r["ids"], np.int64), _unpacked(r["vectors"], n, dim),
                    np.frombuffer(r["bits"], np.uint8).reshape(n, -1), np.frombuffer(r["own"], np.float64), k, deviations,
                )
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in got], names=["query_id", "vec_id", "score"])

        return step

    best = map_batches(met, make, "query_id bigint, vec_id bigint, score double").dropDuplicates()
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
