"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Vectors are centred, turned by a random rotation and kept as the signs of their parts:
one bit each, packed into 64-bit words, with three numbers a vector. The product of a
turned query with these signs, corrected by the numbers, estimates an inner product;
the estimate comes with an error bound. The vectors with the highest estimates are
compared on the original vectors, and after them only those whose upper bound reaches the
k-th best found so.

The index holds every vector, in blocks. Queries meet all blocks, so the work is the
number of queries times the number of vectors, as the task states; what is sent is one
copy of the packed queries for each block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wayside.llm.batches import by_batch
from wayside.shipping import ship_package
from wayside.storage import settle

#: Vectors of a block of the index, and queries sent together.
BLOCK, QUERIES = 8192, 512
#: Standard deviations of the estimate that the error bound allows for.
EPSILON = 3.0
#: Times k, how many of the highest estimates are compared first.
FIRST = 5
SEED = 7

_INDEX = "g int, ids binary, codes binary, scalars binary, vectors binary"
_QUERIES = "qb int, query_ids binary, query_vectors binary"
_FOUND = "query_id long, vec_id long, score double"


def usable(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Ids and vectors that take part: with an id, not null, not zero, all parts finite numbers.

    Of rows that repeat an id the smallest vector counts.
    """
    parts = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), parts.alias("v")).where("vec_id is not null and size(v) > 0")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = rows.where(F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def _rotation(d: int) -> np.ndarray:
    """A random rotation of vectors padded to whole 64-bit words."""
    padded = -(-d // 64) * 64
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((padded, padded)))
    return (q * np.sign(np.diag(r)))[:d]


def _matrix(column, d: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _statistics(rows: DataFrame) -> tuple[int, int, np.ndarray] | None:
    """Length, count and mean of the vectors: one driver row of the vectors' length."""
    first = rows.agg(F.min_by(F.size("v"), "vec_id")).first()[0]
    if first is None:
        return None
    d = int(first)

    def sums(batches):
        total, n = np.zeros(d), 0
        for batch in batches:
            m = _matrix(batch.column(0), d)
            total, n = total + m.sum(0), n + len(m)
        yield pa.RecordBatch.from_pydict({"n": [n], "total": pa.array([total], pa.list_(pa.float64()))})

    parts = by_batch(rows.where(F.size("v") == d).select("v"), sums, "n long, total array<double>")
    each = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(d)]
    row = parts.agg(F.sum("n").alias("n"), *each).first()
    n = int(row["n"])
    return d, n, np.array([row[f"s{i}"] for i in range(d)]) / n


def build_index(rows: DataFrame, block: int = BLOCK) -> tuple[DataFrame, int, np.ndarray, int] | None:
    """Every usable vector as codes in blocks: (index, length, centre, blocks); None without vectors."""
    known = _statistics(rows)
    if known is None:
        return None
    d, n, centre = known
    blocks = max(1, math.ceil(n / block))
    ship_package(rows.sparkSession)

    def pack(key, held):
        m = _matrix(held.column("v"), d)
        turned = (m - centre) @ _rotation(d)
        norm = np.linalg.norm(turned, axis=1)
        unit = turned / np.where(norm, norm, 1)[:, None]
        bits = unit > 0
        # Part of a code along its vector; a vector in the centre has no direction and no error.
        along = np.where(norm, np.abs(unit).sum(1) / math.sqrt(unit.shape[1]), 1)
        codes = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
        scalars = np.stack([norm, along, m @ centre])
        ids = held.column("vec_id").to_numpy()
        return pa.Table.from_pydict(
            {"g": pa.array([key[0].as_py()], pa.int32()), "ids": [ids.tobytes()], "codes": [codes.tobytes()],
             "scalars": [scalars.tobytes()], "vectors": [m.tobytes()]},
            schema=pa.schema([("g", pa.int32()), *((c, pa.binary()) for c in ("ids", "codes", "scalars", "vectors"))]),
        )

    dealt = rows.where(F.size("v") == d).withColumn("g", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    return settle(dealt.groupBy("g").applyInArrow(pack, _INDEX), "one-bit"), d, centre, blocks


def _packed_queries(rows: DataFrame, d: int, per_block: int) -> DataFrame:
    n = rows.count()

    def pack(key, held):
        return pa.Table.from_pydict(
            {"qb": pa.array([key[0].as_py()], pa.int32()), "query_ids": [held.column("vec_id").to_numpy().tobytes()],
             "query_vectors": [_matrix(held.column("v"), d).tobytes()]},
            schema=pa.schema([("qb", pa.int32()), ("query_ids", pa.binary()), ("query_vectors", pa.binary())]),
        )

    dealt = rows.withColumn("qb", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(max(1, math.ceil(n / per_block)))).cast("int"))
    return dealt.groupBy("qb").applyInArrow(pack, _QUERIES)


def estimates(q: np.ndarray, centre: np.ndarray, codes: np.ndarray, scalars: np.ndarray, epsilon: float = EPSILON):
    """Estimated inner products of queries (rows) and coded vectors (columns), and their error bounds."""
    norm, along, with_centre = scalars
    v = (q - centre) @ _rotation(q.shape[1])
    d = v.shape[1]
    length = np.linalg.norm(v, axis=1)
    signs = np.unpackbits(codes.view(np.uint8), axis=1, bitorder="little").astype(np.float32) * 2 - 1
    scale = norm / (along * math.sqrt(d))
    estimate = v.astype(np.float32) @ (signs * scale[:, None].astype(np.float32)).T
    estimate += with_centre.astype(np.float32)
    estimate += (q @ centre - centre @ centre)[:, None].astype(np.float32)
    spread = np.sqrt(np.maximum(1 - along**2, 0)) / along * epsilon / math.sqrt(max(d - 1, 1))
    # Single precision is allowed for on top.
    rounding = 1e-5 * (length[:, None].max(initial=0) + np.linalg.norm(q, axis=1).max(initial=0) + np.linalg.norm(centre))
    error = np.outer(length, norm * (spread + 1e-5)).astype(np.float32) + np.float32(rounding * (norm.max(initial=0) + 1))
    return estimate, error


def in_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of row pairs, added part by part in double precision."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def _best(q_ids, q, ids, codes, scalars, vectors, centre, k, epsilon):
    """The k nearest of a block for each of some queries: (query index, block index, score)."""
    estimate, error = estimates(q, centre, codes, scalars, epsilon)
    own = np.flatnonzero(np.isin(ids, q_ids))
    for i, j in zip(*np.nonzero(q_ids[:, None] == ids[None, own])):
        estimate[i, own[j]] = -np.inf
    rows, columns = [], []
    probe = min(FIRST * k, len(ids))
    for i in range(len(q)):
        # The k-th best of the highest estimates, compared exactly, is what upper bounds must reach.
        first = np.argpartition(estimate[i], len(ids) - probe)[len(ids) - probe :]
        near = np.where(np.isneginf(estimate[i, first]), -np.inf, vectors[first] @ q[i])
        least = np.sort(near)[-k] if probe >= k else -np.inf
        slack = 1e-9 * (1 + abs(least)) if least > -np.inf else 0.0
        reach = estimate[i] + error[i] >= least - slack
        reach[first] = True
        reach[np.isneginf(estimate[i])] = False
        chosen = np.flatnonzero(reach)
        near = vectors[chosen] @ q[i]
        if len(near) > k:
            last = np.partition(near, len(near) - k)[len(near) - k]
            chosen = chosen[near >= last - 1e-9 * (1 + abs(last))]
        rows.append(np.full(len(chosen), i))
        columns.append(chosen)
    qi, ci = np.concatenate(rows), np.concatenate(columns)
    score = in_order(q[qi], vectors[ci])
    order = np.lexsort((ids[ci], -score, qi))
    qi, ci, score = qi[order], ci[order], score[order]
    rank = np.arange(len(qi)) - np.searchsorted(qi, qi)
    top = rank < k
    return qi[top], ci[top], score[top]


def nearest(
    df: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    block: int = BLOCK, per_block: int = QUERIES, epsilon: float = EPSILON,
) -> DataFrame:
    """The k vectors of df nearest to each query, by inner product, without the query's own id.

    Returns query_id, rank (from 1), vec_id, score; nearest first, ties to the smaller id;
    all candidates if there are fewer. The score is the inner product of the original
    vectors in double precision. Which rows take part: see `usable`; an empty table or no
    usable query gives no rows. Many equal vectors tie within the bounds and are all
    compared, in the task of their block. A query meets the vectors of its own length: every
    length that occurs among the queries has an index of its own, one after the other.
    """
    rows = settle(usable(df, id_col, vector_col), "vectors")
    asked = settle(usable(queries, id_col, vector_col), "queries")
    lengths = [r[0] for r in asked.select(F.size("v")).distinct().collect()]
    found = None
    for d in sorted(lengths):
        same = F.size("v") == d
        of_length = _found(rows.where(same), asked.where(same), k, block, per_block, epsilon)
        if of_length is not None:
            found = of_length if found is None else found.unionByName(of_length)
    if found is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _found(rows: DataFrame, asked: DataFrame, k: int, block: int, per_block: int, epsilon: float) -> DataFrame | None:
    """(query_id, vec_id, score): the nearest of each block, of vectors and queries of one length."""
    built = build_index(rows, block)
    if built is None:
        return None
    index, d, centre, blocks = built
    packed = _packed_queries(asked, d, per_block).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(batches):
        for batch in batches:
            for row in range(len(batch)):
                get = lambda name, kind: np.frombuffer(batch.column(name)[row].as_buffer(), kind)  # noqa: B023, E731
                ids, vectors = get("ids", np.int64), get("vectors", np.float64).reshape(-1, d)
                codes, scalars = get("codes", np.uint64).reshape(len(ids), -1), get("scalars", np.float64).reshape(3, -1)
                q_ids, q = get("query_ids", np.int64), get("query_vectors", np.float64).reshape(-1, d)
                for at in range(0, len(q_ids), 32):
                    some = q_ids[at : at + 32]
                    qi, ci, score = _best(some, q[at : at + 32], ids, codes, scalars, vectors, centre, k, epsilon)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some[qi]), pa.array(ids[ci]), pa.array(score)], ["query_id", "vec_id", "score"]
                    )

    pairs = index.join(packed, "g").select("ids", "codes", "scalars", "vectors", "query_ids", "query_vectors")
    return by_batch(pairs, search, _FOUND)
