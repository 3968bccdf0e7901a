"""Whitening of embeddings: the leading eigenvectors of their covariance by Jacobi-Davidson.

The covariance is never formed. It is applied to a few directions at a time by a pass over the
vectors: each task multiplies its centred vectors by the directions and back, and Spark sums what
the tasks give, a row per dimension. On the driver there are only matrices of dimensions by
directions.

A round takes the Ritz pairs of a small subspace, locks the leading ones whose residual is down to
rounding, and widens the subspace by corrections of the others: approximate solutions, by a few
steps of MINRES, of the equation that is projected against the locked vectors and the Ritz vectors.
The equations of all wanted pairs take their steps together, so that a step is one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.common import exact_columns, slices
from dayfold.sinks.shared import write_aside

# What makes an entry a whole number.
SCALE = 1024
SHIFT = 100_000

COMPONENTS = 8
# Entries from this size on have no whole number as a long.
TOO_LARGE = 2.0**62 / SCALE
# Vectors in a block.
BLOCK = 1024
# Residual, as a share of the largest eigenvalue, that counts as rounding.
ROUNDING = 2.0**-43
# Steps of an inner solution, directions of the subspace, and rounds before it is an error.
INNER = 6
SUBSPACE = 64
ROUNDS = 300
SEED = 17

Product = Callable[[np.ndarray], np.ndarray]

OUTPUT = (
    "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, "
    "explained double, identity_error double"
)


def _whole(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, whole numbers) of the vectors that can be used, per number of dimensions."""
    column = column.cast(pa.large_list(pa.float64()))
    lengths = np.asarray(column.value_lengths().fill_null(0))
    entries = column.flatten()  # without those of null vectors
    numbers = np.asarray(entries.fill_null(np.nan))
    with np.errstate(invalid="ignore"):
        bad = ~(np.abs(numbers) < TOO_LARGE)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    bad_before = np.concatenate([[0], np.cumsum(bad)])
    usable = (bad_before[ends] == bad_before[starts]) & (lengths > 0)
    for length in np.unique(lengths[usable]).tolist():
        places = np.flatnonzero(usable & (lengths == length))
        taken = numbers[starts[places][:, None] + np.arange(length)]
        yield places, np.floor(taken * SCALE).astype(np.int64) + SHIFT


def blocks_of(embeddings: DataFrame) -> DataFrame:
    """(dims, ids, numbers): the whole numbers of usable vectors in blocks, written aside."""

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BLOCK):
            ids = batch.column("vec_id").cast(pa.int64())
            for places, numbers in _whole(batch.column("embedding")):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([numbers.shape[1]], pa.int32()),
                        pa.array([ids.take(pa.array(places)).to_pylist()], pa.list_(pa.int64())),
                        pa.array([numbers.astype("<i8").tobytes()], pa.binary()),
                    ],
                    names=["dims", "ids", "numbers"],
                )

    plain = exact_columns(embeddings, "vec_id", "embedding")
    return write_aside(
        plain.mapInArrow(block, "dims int, ids array<bigint>, numbers binary"), "whitening-blocks"
    )


def _numbers(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for dims, data in zip(batch.column("dims").to_pylist(), batch.column("numbers")):
        yield np.frombuffer(data.as_buffer(), "<i8").reshape(-1, dims)


def summed(
    blocks: DataFrame,
    width: int,
    partial: Callable[[np.ndarray], np.ndarray],
    kind: str = "double",
) -> np.ndarray:
    """The sum over all blocks of the matrix that ``partial`` gives for one, ``width`` columns wide.

    A task adds up its own blocks and gives the rows of that sum, which Spark sums row by row:
    doubles, or with ``kind`` "bigint" whole numbers exactly.
    """
    names = [f"v{i}" for i in range(width)]

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for numbers in _numbers(batch):
                part = partial(numbers)
                total = part if total is None else total + part
        if total is not None:
            rows = pa.array(np.arange(len(total), dtype=np.int32))
            columns = [pa.array(np.ascontiguousarray(total[:, i])) for i in range(width)]
            yield pa.RecordBatch.from_arrays([rows, *columns], names=["row", *names])

    rows = blocks.mapInArrow(add, ", ".join(["row int", *[f"{name} {kind}" for name in names]]))
    if kind == "bigint":
        rows = rows.select("row", *[F.col(name).cast("decimal(20,0)").alias(name) for name in names])
    # As many rows as there are dimensions.
    found = rows.groupBy("row").agg(*[F.sum(name).alias(name) for name in names]).collect()
    found = sorted(found, key=lambda row: row["row"])
    exact = object if kind == "bigint" else np.float64
    return np.array([[row[name] for name in names] for row in found], exact)


@dataclass(frozen=True)
class Centre:
    """The mean of n whole vectors, exactly: ``base + rest / n`` with 0 <= rest < n."""

    n: int
    base: np.ndarray
    rest: np.ndarray

    def offsets(self, numbers: np.ndarray) -> np.ndarray:
        return numbers - self.base

    def centred(self, numbers: np.ndarray) -> np.ndarray:
        return self.offsets(numbers) - self.rest / self.n

    def deviations(self, numbers: np.ndarray) -> list[int]:
        """Per vector the sum over dimensions of (n * x - S)^2, exactly."""
        offsets = self.offsets(numbers)
        large = int(np.abs(offsets).max(initial=0))
        if large**2 * len(self.base) >= 2**63 or self.n * large * len(self.base) >= 2**63:
            offsets = offsets.astype(object)
        squares = (offsets * offsets).sum(1).tolist()
        mixed = (offsets * self.rest).sum(1).tolist()
        rests = sum(r * r for r in self.rest.tolist())
        n = self.n
        return [n * n * a - 2 * n * b + rests for a, b in zip(squares, mixed)]


def centre_of(blocks: DataFrame, n: int) -> Centre:
    def halves(numbers: np.ndarray) -> np.ndarray:
        # Sums of halves cannot overflow where sums of whole numbers could.
        return np.stack([(numbers >> 32).sum(0), (numbers & 0xFFFFFFFF).sum(0)], 1)

    high, low = summed(blocks, 2, halves, "bigint").T
    sums = [(int(h) << 32) + int(v) for h, v in zip(high, low)]
    return Centre(
        n, np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)
    )


def _orthonormal(new: np.ndarray, against: np.ndarray) -> np.ndarray:
    """The part of ``new`` beyond the orthonormal ``against``, orthonormal; may have fewer columns."""
    kept = against
    for column in new.T:
        size = np.linalg.norm(column)
        if not size > 0:
            continue
        column = column / size
        for _ in range(3):
            column = column - kept @ (kept.T @ column)
            left = np.linalg.norm(column)
            if left < 1e-10:
                break
            column = column / left
        else:
            kept = np.column_stack([kept, column])
    return kept[:, against.shape[1] :]


def minres(
    apply: Callable[[np.ndarray, np.ndarray], np.ndarray],
    right: np.ndarray,
    steps: int,
    tolerance: float,
) -> np.ndarray:
    """Approximate solutions of symmetric equations, one per column, that take steps together.

    ``apply(vectors, which)`` multiplies each column by the matrix of the equation ``which``. A
    column stops when its residual has gone down to ``tolerance`` of what it was.
    """
    solution = np.zeros_like(right)
    first = np.linalg.norm(right, axis=0)
    active = np.flatnonzero(first > 0)
    current, previous = right[:, active] / first[active], np.zeros_like(right[:, active])
    beta = np.zeros(len(active))
    left = first[active].copy()
    cosine, sine = -np.ones(len(active)), np.zeros(len(active))
    slope, epsilon = np.zeros(len(active)), np.zeros(len(active))
    old, older = np.zeros_like(current), np.zeros_like(current)
    for _ in range(steps):
        if not len(active):
            break
        image = apply(current, active) - previous * beta
        alpha = (image * current).sum(0)
        image = image - current * alpha
        previous, beta = current, np.linalg.norm(image, axis=0)
        # The last rotation, then a new one that clears beta.
        delta = cosine * slope + sine * alpha
        gamma_bar = sine * slope - cosine * alpha
        last_epsilon, epsilon, slope = epsilon, sine * beta, -cosine * beta
        gamma = np.maximum(np.hypot(gamma_bar, beta), np.finfo(float).tiny)
        cosine, sine = gamma_bar / gamma, beta / gamma
        move = cosine * left
        left = sine * left
        direction = (previous - old * delta - older * last_epsilon) / gamma
        older, old = old, direction
        solution[:, active] += direction * move
        going = (np.abs(left) > tolerance * first[active]) & (beta > 1e-14 * np.abs(alpha) + 1e-300)
        current = image[:, going] / beta[going]
        active, left, beta = active[going], left[going], beta[going]
        previous, old, older = previous[:, going], old[:, going], older[:, going]
        cosine, sine, slope, epsilon = cosine[going], sine[going], slope[going], epsilon[going]
    return solution


def leading_pairs(product: Product, dims: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of the ``wanted`` largest eigenvalues, falling, by Jacobi-Davidson."""
    wanted = min(wanted, dims)
    draw = np.random.default_rng(SEED)
    locked = np.zeros((dims, 0))
    basis = _orthonormal(draw.standard_normal((dims, min(dims, wanted + 2))), locked)
    image = product(basis)
    for round_ in range(ROUNDS):
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        turn, values = turn[:, ::-1], values[::-1]
        basis, image = basis @ turn, image @ turn
        open_ = min(wanted - locked.shape[1], basis.shape[1])
        residual = image - basis * values
        residual -= locked @ (locked.T @ residual)
        sizes = np.linalg.norm(residual, axis=0)
        if round_ == 0:
            scale = float(np.abs(values).max(initial=0))
        scale = max(scale, float(np.abs(values).max(initial=0)))
        whole = basis.shape[1] + locked.shape[1] >= dims
        done = 0
        while done < open_ and (whole or sizes[done] <= ROUNDING * scale):
            done += 1
        if done:
            locked = np.column_stack([locked, basis[:, :done]])
            basis, image, residual = basis[:, done:], image[:, done:], residual[:, done:]
            values, open_ = values[done:], open_ - done
        if locked.shape[1] >= wanted:
            break
        if basis.shape[1] + open_ > SUBSPACE:
            keep = max(2 * open_, SUBSPACE // 2)
            basis, image = basis[:, :keep], image[:, :keep]
        targets = basis[:, :open_]
        shut = np.column_stack([locked, targets])

        def apply(vectors, which, shut=shut, values=values):
            inside = vectors - shut @ (shut.T @ vectors)
            out = product(inside) - inside * values[which]
            return out - shut @ (shut.T @ out)

        right = -residual[:, :open_]
        right = right - shut @ (shut.T @ right)
        corrections = minres(apply, right, INNER, 2.0 ** -(round_ + 2))
        new = _orthonormal(corrections, np.column_stack([locked, basis]))
        if not new.shape[1]:
            new = _orthonormal(
                draw.standard_normal((dims, open_)), np.column_stack([locked, basis])
            )
        basis, image = np.column_stack([basis, new]), np.column_stack([image, product(new)])
    else:
        raise ArithmeticError(f"residuals above rounding after {ROUNDS} rounds")
    # Rayleigh-Ritz among the locked vectors, whose order may not be that of their values.
    small = locked.T @ product(locked)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    vectors = locked @ turn[:, ::-1]
    largest = np.abs(vectors).argmax(0)
    return values[::-1], vectors * np.sign(vectors[largest, np.arange(vectors.shape[1])])


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per vector and component.

    Each entry c of a vector becomes the whole number floor(1024 * c) + 100000. ``whitened`` is the
    centred vector's coordinate along an eigenvector of the covariance of all vectors, over the
    root of the eigenvalue; ``explained`` the eigenvalue's share of the total variance;
    ``deviation`` the exact sum of (n * x - S)^2; ``identity_error`` how far the covariance of the
    whitened coordinates is from the identity at most.

    Components are numbered from 1 by falling eigenvalue, at most as many as there are dimensions;
    the largest entry of an eigenvector is positive. Directions without variance cannot be
    whitened and have no rows: none are left for an empty table, one vector, or equal vectors.
    Left out are vectors that are null or empty or hold null or non-finite entries or entries whose
    whole number is no long, and those with another number of dimensions than most (of equally
    frequent ones the larger). Rows that repeat count as often as they come; a null vec_id stays.
    Other columns are ignored. A deviation beyond 38 digits is null.
    """
    spark = embeddings.sparkSession
    blocks = blocks_of(embeddings)
    most = (
        blocks.groupBy("dims")
        .agg(F.sum(F.size("ids").cast("long")).alias("n"))
        .orderBy(F.desc("n"), F.desc("dims"))
        .first()
    )
    if most is None:
        return spark.createDataFrame([], OUTPUT)
    dims, n = int(most["dims"]), int(most["n"])
    blocks = blocks.where(F.col("dims") == dims)
    centre = centre_of(blocks, n)

    def product(directions: np.ndarray) -> np.ndarray:
        def partial(numbers):
            rows = centre.centred(numbers)
            return rows.T @ (rows @ directions)

        if not directions.shape[1]:
            return directions
        return summed(blocks, directions.shape[1], partial) / n

    def squares(numbers):
        return (centre.centred(numbers) ** 2).sum(0)[:, None]

    trace = float(summed(blocks, 1, squares).sum()) / n
    if not trace > 0:
        return spark.createDataFrame([], OUTPUT)
    values, vectors = leading_pairs(product, dims, components)
    real = values > dims * np.finfo(float).eps * trace
    values, vectors = values[real], vectors[:, real]
    axes = vectors / np.sqrt(values)
    error = _identity_error(blocks, centre, axes)
    explained = (values / trace).tolist()
    number = len(explained)

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, numbers in zip(batch.column("ids"), _numbers(batch)):
                rows = len(numbers)
                whitened = centre.centred(numbers) @ axes
                deviations = [v if v < 10**38 else None for v in centre.deviations(numbers)]
                place = pa.array(np.repeat(np.arange(rows), number))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values.take(place),
                        pa.array(np.tile(np.arange(1, number + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * number, n, np.int64)),
                        _decimals(deviations).take(place),
                        pa.array(whitened.ravel()),
                        pa.array(np.tile(explained, rows)),
                        pa.array(np.full(rows * number, error)),
                    ],
                    names=[field.split()[0] for field in OUTPUT.split(", ")],
                )

    return blocks.mapInArrow(project, OUTPUT)


def _decimals(values: list[int | None]) -> pa.Array:
    if all(value is not None and value < 2**63 for value in values):
        # Digits of a long, widened.
        return pa.array(values, pa.int64()).cast(pa.decimal128(38, 0))
    from decimal import Context, Decimal

    context = Context(prec=40)
    exact = [None if v is None else context.create_decimal(Decimal(v)) for v in values]
    return pa.array(exact, pa.decimal128(38, 0))


def _identity_error(blocks: DataFrame, centre: Centre, axes: np.ndarray) -> float:
    """The largest entry of the whitened coordinates' covariance minus the identity."""
    number = axes.shape[1]

    def sums(numbers):
        return (centre.centred(numbers) @ axes).sum(0)[:, None]

    means = summed(blocks, 1, sums)[:, 0] / centre.n

    def products(numbers):
        rows = centre.centred(numbers) @ axes - means
        return rows.T @ rows

    covariance = summed(blocks, number, products) / centre.n
    return float(np.abs(covariance - np.eye(number)).max())
