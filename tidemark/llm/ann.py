"""Nearest neighbours from randomly rotated one-bit codes.

A unit vector is padded, rotated by one random orthogonal matrix and kept as the signs of its coordinates. The inner
product of a code with the rotated query, divided by the code's inner product with its own vector, estimates the
cosine; its error has a bound that shrinks with the number of bits. A vector is compared exactly only if its upper
bound reaches the k-th best inner product known so far, which the vectors of the highest estimates give.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import kept, ship

# Bits of a code: the dimension, doubled and rounded up to a multiple of 64.
BITS_PER_DIMENSION = 2
# Width of the error bound in standard deviations.
BOUND = 2.6
# Queries that are sent to all tasks together (rows, by hash of their id).
QUERY_BLOCK = 4096
# Vectors that a task compares with all queries of a block at once.
CODE_BLOCK = 4096

CODES = "vec_id bigint, bits binary, norm double, fit double, vector array<{}>"


def rotation(dimension: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix of the padded dimension, first ``dimension`` columns."""
    padded = -(-dimension * BITS_PER_DIMENSION // 64) * 64
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((padded, padded)))
    return (q * np.sign(np.diag(r)))[:, :dimension]


def usable(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """Id and vector of rows that take part: not null, not zero, all components finite.

    Components stay floats where the column has floats; others become doubles.
    """
    kind = "float" if df.schema[vector_column].dataType.elementType.typeName() == "float" else "double"
    rows = (df.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast(f"array<{kind}>").alias("vector"))
            .where("vec_id is not null and vector is not null")
            .where("forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
            .where("exists(vector, x -> x <> 0)"))
    return rows


def common_dimension(rows: DataFrame) -> int:
    found = (rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first())
    return found.d if found else 0


def build_index(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
                dimension: int | None = None) -> tuple[DataFrame, int]:
    """Codes of every usable row of one dimension (the commonest), with the vector for reranking, and that dimension.

    Nothing is fitted.
    """
    rows = usable(df, id_column, vector_column)
    kind = rows.schema["vector"].dataType.elementType.typeName()
    dimension = common_dimension(rows) if dimension is None else dimension
    rows = rows.where(F.size("vector") == dimension)
    turn = rotation(dimension) if dimension else None

    def encode(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.asarray(batch.column("vector").flatten(), np.float64).reshape(batch.num_rows, dimension)
            scale = np.abs(x).max(axis=1)
            norm = np.sqrt(((x / scale[:, None]) ** 2).sum(axis=1)) * scale
            turned = (x / norm[:, None]) @ turn.T
            fit = np.abs(turned).sum(axis=1) / math.sqrt(turn.shape[0])
            bits = np.packbits(turned > 0, axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(norm),
                 pa.array(fit), batch.column("vector")],
                names=["vec_id", "bits", "norm", "fit", "vector"])

    return kept(rows.mapInArrow(encode, CODES.format(kind)), "ann-codes"), dimension


def bounds(codes: np.ndarray, norm: np.ndarray, fit: np.ndarray, queries: np.ndarray, turn: np.ndarray):
    """Lower and upper bounds of the inner products, one row a query."""
    signs = np.where(np.unpackbits(codes, axis=1, count=turn.shape[0]), 1.0, -1.0).astype(np.float32)
    largest = np.abs(queries).max(axis=1)
    size = np.sqrt(((queries / largest[:, None]) ** 2).sum(axis=1)) * largest
    turned = ((queries / size[:, None]) @ turn.T / math.sqrt(turn.shape[0])).astype(np.float32)
    estimate = (turned @ signs.T) / fit
    error = BOUND * np.sqrt(np.maximum(0, 1 - fit ** 2)) / fit / math.sqrt(turn.shape[0] - 1)
    scale = size[:, None] * norm
    return (estimate - error) * scale, (estimate + error) * scale


def nearest(df: DataFrame, wanted: str, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``search`` of the rows of ``df`` that ``wanted`` (SQL on ``vec_id``) names, among all rows of their dimension.

    Vectors of different dimensions have no inner product, so each dimension has an index of its own. A query whose
    id repeats in several dimensions has a list in each.
    """
    sizes = usable(df, id_column, vector_column).groupBy(F.size("vector").alias("d")).count().orderBy("d").collect()
    found = []
    for dimension in [r.d for r in sizes] or [0]:  # one row a dimension
        index, _ = build_index(df, id_column, vector_column, dimension)
        found.append(search(index, dimension, index.where(wanted).select("vec_id", "vector"), k))
    return reduce(DataFrame.unionAll, found)


def search(index: DataFrame, dimension: int, queries: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest of every query row (vec_id, vector).

    Nearness is the inner product in double precision, ties go to the smaller vec_id, the query's own id is left out.
    Repeated query ids count once, with their smallest vector; repeated rows of the index are candidates each.
    Queries go out in blocks of bounded size; each block is compared with all codes.
    """
    spark = index.sparkSession
    queries = queries.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    n = queries.count()
    n_blocks = max(1, -(-n // QUERY_BLOCK))
    turn = rotation(dimension) if dimension else None
    schema = "query_id bigint, vec_id bigint, score double"
    parts = []
    for b in range(n_blocks):
        chosen = (queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == b).orderBy("vec_id").collect()
                  if n else [])  # bounded: QUERY_BLOCK rows by hash
        ids = np.array([r.vec_id for r in chosen], np.int64)
        vectors = np.array([r.vector for r in chosen], np.float64).reshape(len(chosen), dimension)
        sent = spark.sparkContext.broadcast((ids, vectors))

        def scan(batches, sent=sent):
            ids, vectors = sent.value
            best = [(np.zeros(0), np.zeros(0, np.int64))] * len(ids)
            held = []

            def flush():
                table = pa.Table.from_batches(held)
                held.clear()
                own = table.column("vec_id").to_numpy()
                codes = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint8).reshape(len(own), -1)
                x = table.column("vector").combine_chunks().flatten().to_numpy().astype(np.float64)
                x = x.reshape(len(own), dimension)
                for a in range(0, len(ids), 512):  # bounds the matrix of estimates
                    low, high = bounds(codes, table.column("norm").to_numpy(), table.column("fit").to_numpy(),
                                       vectors[a:a + 512], turn)
                    for j in range(len(low)):
                        q = a + j
                        low[j][own == ids[q]] = high[j][own == ids[q]] = -np.inf
                        kth = best[q][0][-1] if len(best[q][0]) == k else -np.inf
                        first = np.zeros(0, np.int64)
                        if len(own) > 4 * k:
                            # The likeliest are compared exactly first; the k-th of them is what others must reach.
                            middle = low[j] + high[j]
                            first = np.argpartition(middle, len(own) - 2 * k)[-2 * k:]
                            first = first[high[j][first] >= kth]
                            exact = (x[first] * vectors[q]).sum(axis=1)
                            if len(exact) >= k:
                                kth = max(kth, np.partition(exact, len(exact) - k)[len(exact) - k])
                            high[j][first] = -np.inf
                        pick = np.flatnonzero((high[j] >= kth) & (high[j] > -np.inf))
                        pick = np.concatenate([first, pick])
                        if not len(pick):
                            continue
                        scores = np.concatenate([best[q][0], (x[pick] * vectors[q]).sum(axis=1)])
                        seen = np.concatenate([best[q][1], own[pick]])
                        order = np.lexsort((seen, -scores))[:k]
                        best[q] = scores[order], seen[order]

            rows = 0
            for batch in batches:
                if len(ids) and batch.num_rows:
                    held.append(batch)
                    rows += batch.num_rows
                    if rows >= CODE_BLOCK:
                        flush()
                        rows = 0
            if held:
                flush()
            for a in range(0, len(ids), 512):
                some = [(i, s, v) for i, (s, v) in zip(ids[a:a + 512], best[a:a + 512], strict=True) if len(s)]
                if some:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat([i for i, _, _ in some], [len(s) for _, s, _ in some]), pa.int64()),
                         pa.array(np.concatenate([v for _, _, v in some]), pa.int64()),
                         pa.array(np.concatenate([s for _, s, _ in some]))], names=["query_id", "vec_id", "score"])

        parts.append(index.mapInArrow(scan, schema))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionAll(more)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # k rows a task and query
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ship(__name__)
