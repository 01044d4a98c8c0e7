"""Whitening of vectors by their leading principal components, found by Jacobi-Davidson without a covariance matrix.

The covariance enters only as a product with a few vectors at once, ``sum of (x - mean) ((x - mean) . v) / n``, which is
one Spark job over the fit list: each task sums its blocks, and the driver adds the sums of the tasks. A search space
grows by solutions of the correction equations ``(1 - QQ') (A - theta) (1 - QQ') t = -r``, solved for all open pairs in
step by some rounds of MINRES, so that a round is one job. Rayleigh-Ritz on the space gives the next pairs; those whose
residual is as small as double precision lets it be are locked and projected out of all later work.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept, ship

# Pairs beyond the wanted ones that are followed, so that none of the wanted is overlooked.
GUARDS = 2
# Vectors of the search space before it is cut down to the best ones.
SPACE = 48
# Rounds of MINRES for one expansion, and how far it reduces the residual.
ROUNDS, REDUCTION = 5, 1e-2
# Expansions after which something must be wrong.
STEPS = 500
# Entries of one block of the fit list, and bytes of partial sums that the driver takes at once.
BLOCK_ENTRIES, PARTIAL_BYTES = 1 << 19, 64 << 20
# An entry has to be a whole number that a double holds.
LARGEST = 2.0 ** 53


def grid(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``vec_id, x``: entries times 256, rounded down, of rows whose vector is whole and finite."""
    rows = df.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    return (rows.where("v is not null")
            .where(f"forall(v, c -> c is not null and not isnan(c) and abs(c) * 256 < {LARGEST:.0f}D)")
            .select("vec_id", F.transform("v", lambda c: F.floor(c * 256).cast("long")).alias("x")))


def fit_blocks(rows: DataFrame) -> DataFrame:
    """``dimension, data``: each different vector once, packed by dimension into blocks of 64-bit integers."""

    def pack(batches):
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            lists = batch.column("x")
            values, bounds = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            sizes = np.diff(bounds)
            for d in np.unique(sizes).tolist():
                at = bounds[:-1][sizes == d]
                mine = held.setdefault(d, [])
                mine.append(values[at[:, None] + np.arange(d)])
                if sum(map(np.size, mine)) >= BLOCK_ENTRIES:
                    yield _packed(d, held.pop(d))
        for d, mine in held.items():
            yield _packed(d, mine)

    return rows.select("x").where("size(x) > 0").distinct().mapInArrow(pack, "dimension int, data binary")


def _packed(d: int, parts: list[np.ndarray]) -> pa.RecordBatch:
    data = np.ascontiguousarray(np.concatenate(parts), "<i8").tobytes()
    return pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([data], pa.binary())], names=["dimension", "data"])


class FitList:
    """Distinct vectors of one dimension on the cluster; what is asked of them is a sum over all of them."""

    def __init__(self, blocks: DataFrame, dimension: int) -> None:
        self.dimension = dimension
        self.blocks = blocks.where(F.col("dimension") == dimension).select("data")
        self.jobs = 0
        low, high, self.n = 0, 0, 0
        for part in self._sum(lambda x: np.concatenate([(x & 0x3FFFFFF).sum(0), (x >> 26).sum(0), [len(x)]]), 2, np.int64):
            low, high, self.n = low + part[:dimension].astype(object), high + part[dimension:-1].astype(object), self.n + int(part[-1])
        self.sums = [int(a) + (int(b) << 26) for a, b in zip(low, high, strict=True)]
        # The mean as a whole number and a fraction, so that centring rounds once.
        self.whole = np.array([s // self.n for s in self.sums], np.int64)
        self.fraction = np.array([(s - self.n * int(w)) / self.n for s, w in zip(self.sums, self.whole, strict=True)])
        self.trace = float(self.total(lambda y: np.array([(y * y).sum()]), 1)[0]) / self.n

    def _sum(self, work: Callable[[np.ndarray], np.ndarray], width: int, kind=np.float64):
        d = self.dimension

        def run(batches):
            total = None
            for batch in batches:
                for data in batch.column("data"):
                    part = work(np.frombuffer(data.as_buffer(), "<i8").reshape(-1, d))
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.astype(kind).tobytes()], pa.binary())], names=["part"])

        tasks = max(64, PARTIAL_BYTES // (8 * d * max(1, width)))
        self.jobs += 1
        sums = self.blocks.coalesce(tasks).mapInArrow(run, "part binary").toArrow()
        return [np.frombuffer(p.as_buffer(), kind) for p in sums.column("part")]

    def total(self, work: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
        """Sum of ``work`` over blocks of centred rows."""
        whole, fraction = self.whole, self.fraction
        return np.sum(self._sum(lambda x: work((x - whole).astype(float) - fraction), width), axis=0)

    def product(self, vectors: np.ndarray) -> np.ndarray:
        """The covariance times the columns of ``vectors``, by one job."""
        k = vectors.shape[1]
        return self.total(lambda y: (y.T @ (y @ vectors)).ravel(), k).reshape(self.dimension, k) / self.n


def minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, rounds: int, reduction: float) -> np.ndarray:
    """Solutions of symmetric systems, a column each, in step; columns that are done wait for the others."""
    first = np.linalg.norm(right, axis=0)
    x = np.zeros_like(right)
    before, v = np.zeros_like(right), right / np.where(first > 0, first, 1)
    w_before, w = np.zeros_like(right), np.zeros_like(right)
    beta, eta = np.zeros(len(first)), first.copy()
    c, c_before, s, s_before = np.ones(len(first)), np.ones(len(first)), np.zeros(len(first)), np.zeros(len(first))
    going = first > 0
    for _ in range(rounds):
        if not going.any():
            break
        p = apply(v)
        alpha = (v * p).sum(0)
        p = p - alpha * v - beta * before
        following = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_before * s * beta
        rho1 = np.hypot(delta, following)
        rho2, rho3 = s * alpha + c_before * c * beta, s_before * beta
        safe = np.where(rho1 > 0, rho1, 1)
        c_before, s_before = c, s
        c, s = delta / safe, following / safe
        w, w_before = (v - rho3 * w_before - rho2 * w) / safe, w
        step = going & (rho1 > 0)
        x = np.where(step, x + c * eta * w, x)
        eta = np.where(step, -s * eta, eta)
        going = step & (np.abs(eta) > reduction * first) & (following > 1e-14 * np.abs(alpha))
        before, v, beta = v, p / np.where(following > 0, following, 1), following
    return x


def _against(vectors: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what ``vectors`` add to ``basis``."""
    out = []
    for column in vectors.T:
        size = np.linalg.norm(column)
        if not size > 0:
            continue
        column = column / size
        for _ in range(2):
            column = column - basis @ (basis.T @ column)
            for other in out:
                column = column - other * (other @ column)
        left = np.linalg.norm(column)
        if left > 1e-10:
            column = column / left
            column = column - basis @ (basis.T @ column)
            out.append(column / np.linalg.norm(column))
    return np.stack(out, 1) if out else np.zeros((len(vectors), 0))


@dataclass
class Pairs:
    """Eigenvalues, falling, with unit eigenvectors as columns and the norms of their residuals."""

    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], dimension: int, wanted: int, seed: int = 5) -> Pairs:
    """The ``wanted`` largest pairs of a symmetric, positive semidefinite operator.

    A pair is locked when its residual is below ``64 eps`` of the largest value times the root of the dimension, or is
    below 1e-11 of it and has stopped shrinking: then rounding in the products is all that is left of it.
    """
    wanted = min(wanted, dimension)
    follow = min(wanted + GUARDS, dimension)
    locked = np.zeros((dimension, 0))
    space = _against(np.random.default_rng(seed).standard_normal((dimension, follow)), locked)
    image = product(space)
    last: dict[int, float] = {}
    top = 0.0
    for _ in range(STEPS):
        h = space.T @ image
        theta, turn = np.linalg.eigh((h + h.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        ritz, moved = space @ turn, image @ turn
        top = max(top, float(theta[0]) if len(theta) else 0.0)
        count = min(follow - locked.shape[1], len(theta))
        gap = moved[:, :count] - theta[:count] * ritz[:, :count]
        gap = gap - locked @ (locked.T @ gap)
        size = np.linalg.norm(gap, axis=0)
        limit = 64 * np.finfo(float).eps * top * np.sqrt(dimension)
        open_pairs = wanted - locked.shape[1]
        done = 0
        while done < min(open_pairs, count) and (size[done] <= limit or (
                size[done] <= 1e-11 * top and size[done] > 0.5 * last.get(locked.shape[1] + done, np.inf))):
            done += 1
        last = {locked.shape[1] + i: float(s) for i, s in enumerate(size)}
        # A guard must not reach the last wanted value, as far as its residual tells.
        whole = locked.shape[1] + len(theta) >= dimension
        least = theta[open_pairs - 1] if open_pairs <= len(theta) else 0.0
        clear = whole or (theta[open_pairs:count] + size[open_pairs:count] < least + limit).all()
        if done == open_pairs and (clear or size.max() <= 1e-6 * top):
            locked = np.concatenate([locked, ritz[:, :done]], 1)
            break
        if done and done < open_pairs:
            locked = np.concatenate([locked, ritz[:, :done]], 1)
            space, image = ritz[:, done:], moved[:, done:]
            space = space - locked @ (locked.T @ space)
            theta, ritz, moved, gap, size, count = theta[done:], space, image, gap[:, done:], size[done:], count - done
        if space.shape[1] + count > SPACE:
            space, image = ritz[:, :SPACE // 2], moved[:, :SPACE // 2]
        todo = np.flatnonzero(size[:count] > limit)
        held = np.concatenate([locked, ritz[:, :count]], 1)
        shift = theta[todo]

        def corrected(v, held=held, shift=shift):
            v = v - held @ (held.T @ v)
            out = product(v) - shift * v
            return out - held @ (held.T @ out)

        rounds = min(ROUNDS, dimension - held.shape[1])
        extra = minres(corrected, -gap[:, todo], rounds, REDUCTION) if rounds > 0 else np.zeros((dimension, 0))
        fresh = _against(extra, np.concatenate([locked, space], 1))
        if not fresh.shape[1]:
            fresh = _against(gap[:, todo], np.concatenate([locked, space], 1))
        if not fresh.shape[1] and locked.shape[1] + space.shape[1] < dimension:
            start = np.random.default_rng(seed + space.shape[1]).standard_normal((dimension, 1))
            fresh = _against(start, np.concatenate([locked, space], 1))
        if fresh.shape[1]:
            space, image = np.concatenate([space, fresh], 1), np.concatenate([image, product(fresh)], 1)
        else:  # the space is whole: what is left is rounding, and fresh products remove what has gathered
            space = _against(space, locked)
            image = product(space)
    else:
        raise ArithmeticError(f"no convergence in {STEPS} expansions")
    image = product(locked)
    h = locked.T @ image
    values, turn = np.linalg.eigh((h + h.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    vectors, image = locked @ turn, image @ turn
    return Pairs(values, vectors, np.linalg.norm(image - values * vectors, axis=0))


@dataclass
class Whitening:
    """Components of one dimension: what a row needs to be whitened, and how good the fit is."""

    fit: FitList
    pairs: Pairs
    identity_error: float

    @property
    def explained(self) -> np.ndarray:
        return self.pairs.values / self.fit.trace


def fit(blocks: DataFrame, dimension: int, components: int) -> Whitening:
    """Leading components of the vectors of one dimension; those without variance are left out."""
    held = FitList(blocks, dimension)
    if held.trace <= 0:
        return Whitening(held, Pairs(np.zeros(0), np.zeros((dimension, 0)), np.zeros(0)), 0.0)
    pairs = jacobi_davidson(held.product, dimension, components)
    some = pairs.values > 1e-12 * held.trace
    pairs = Pairs(pairs.values[some], pairs.vectors[:, some], pairs.residuals[some])
    scale, k = pairs.vectors / np.sqrt(pairs.values), int(some.sum())

    def moments(y):
        white = y @ scale
        return np.concatenate([(white.T @ white).ravel(), white.sum(0)])

    sums = held.total(moments, k)
    mean = sums[k * k:] / held.n
    covariance = sums[:k * k].reshape(k, k) / held.n - np.outer(mean, mean)
    return Whitening(held, pairs, float(np.abs(covariance - np.eye(k)).max()))


def whiten(df: DataFrame, components: int = 4, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error, eigenvalue, residual`` for each row and component.

    Rows whose vector is null, or holds null or non-finite entries, or entries beyond 2^45, are dropped; ids may be null
    or repeat, every row counts; repeated vectors count once in the fit. Vectors of several dimensions are fitted apart,
    each dimension with its own ``n``. Components without variance do not come out, so equal vectors, empty ones and
    empty tables give no rows; of equal eigenvalues any basis serves. ``deviation`` is exact, and null where it does not
    fit into 64 bits. Other columns are left alone.
    """
    rows = kept(grid(df, id_column, vector_column), "grid")
    blocks = kept(fit_blocks(rows), "fit-list", compression="zstd")
    dimensions = sorted(r.dimension for r in blocks.select("dimension").distinct().collect())
    schema = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double, eigenvalue double, residual double")
    out = [_whitened(rows, fit(blocks, d, components), schema) for d in dimensions]
    return reduce(DataFrame.unionAll, out) if out else df.sparkSession.createDataFrame([], schema)


def _whitened(rows: DataFrame, model: Whitening, schema: str) -> DataFrame:
    d, n, sums = model.fit.dimension, model.fit.n, model.fit.sums
    whole, fraction = model.fit.whole, model.fit.fraction
    pairs, explained, error = model.pairs, model.explained, model.identity_error
    k = len(pairs.values)
    scale = pairs.vectors / np.sqrt(pairs.values)
    names = [field.split(" ")[0] for field in schema.split(", ")]

    def deviations(x: np.ndarray) -> pa.Array:
        reach = n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, sums))
        if reach * reach * d < 1 << 63:
            off = n * x - np.array(sums, np.int64)
            return pa.array((off * off).sum(1))
        off = n * x.astype(object) - np.array(sums, object)
        return pa.array([v if v < 1 << 63 else None for v in (off * off).sum(1).tolist()], pa.int64())

    def run(batches):
        for batch in batches:
            rows_in = batch.num_rows
            if not rows_in or not k:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(rows_in, d)
            white = ((x - whole).astype(float) - fraction) @ scale
            take = pa.array(np.repeat(np.arange(rows_in), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(take), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows_in)),
                 pa.array(np.full(rows_in * k, n, np.int64)), deviations(x).take(take), pa.array(white.ravel()),
                 pa.array(np.tile(explained, rows_in)), pa.array(np.full(rows_in * k, error)),
                 pa.array(np.tile(pairs.values, rows_in)), pa.array(np.tile(pairs.residuals, rows_in))], names=names)

    return rows.where(F.size("x") == d).mapInArrow(run, schema)


ship(__name__)
