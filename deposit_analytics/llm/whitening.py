"""Whitening of embeddings from exact, bit-sliced cross-products.

Vectors are rounded down to multiples of 1/256, so they are whole numbers, and
each distinct vector counts once. A block of vectors is shifted by the least
value of each dimension and cut into bit planes: one bit of one dimension across
all rows of the block, 64 rows to a word. The planes of two dimensions are joined
by AND, and their bits counted; the counts, weighted by the planes' powers of two,
are the exact sum of products. Sums of blocks and of tasks are added as whole
numbers, the shifts are taken back and the sums centred as whole numbers, and only
then the covariance is rounded, for eigh on the driver. What comes to the driver
grows with the square of the dimensions, not with the rows.

Vectors of different lengths have no common covariance: every length is fitted
for itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deposit_analytics.llm.common import stored

SCALE = 256
COMPONENTS = 4
BLOCK_ROWS = 4096
LIMB_BITS = 24
PART_BITS = 60
GOOD_IDENTITY = 1e-9


def scaled(embedding: Column) -> Column:
    """The vector in whole multiples of 1/256; NULL if an entry is NULL, no number, or too large for a long."""
    doubles = embedding.cast("array<double>")
    fits = F.forall(doubles, lambda one: one.isNotNull() & ~F.isnan(one) & (F.abs(one) < float(2**63 // SCALE)))
    return F.when(fits, F.transform(doubles, lambda one: F.floor(one * F.lit(float(SCALE))).cast("long")))


def cross_products(x: np.ndarray) -> list[list[int]]:
    """Exact sums of products of every two columns of whole numbers."""
    rows, size = x.shape
    low = x.min(axis=0)
    with np.errstate(over="ignore"):
        shifted = x.astype(np.uint64) - low.astype(np.uint64)
    planes, columns, starts, weights = [], [], [], []
    for one in range(size):
        bits = max(1, int(shifted[:, one].max()).bit_length())
        for bit in range(bits):
            if bit % LIMB_BITS == 0:
                # A limb's products, summed over a block, fit into 64 bits.
                columns.append((one, bit))
                starts.append(len(weights))
            weights.append(1 << bit % LIMB_BITS)
            planes.append(np.packbits((shifted[:, one] >> np.uint64(bit) & np.uint64(1)).astype(np.uint8)))
    packed = np.stack(planes)
    words = np.zeros((len(planes), -(-packed.shape[1] // 8) * 8), np.uint8)
    words[:, : packed.shape[1]] = packed
    words = words.view(np.uint64)
    weight = np.array(weights, np.int64)
    by_limb = np.zeros((len(planes), len(columns)), np.int64)
    for plane, own in enumerate(words):
        counts = np.bitwise_count(own & words).sum(axis=1, dtype=np.int64)
        by_limb[plane] = np.add.reduceat(counts * weight, starts)
    sums = np.add.reduceat(by_limb * weight[:, None], starts, axis=0)
    total = [[0] * size for _ in range(size)]
    for (i, a), row in zip(columns, sums.tolist(), strict=True):
        for (j, b), value in zip(columns, row, strict=True):
            total[i][j] += value << a + b
    least = low.tolist()
    plain = [sum(shifted[:, one].tolist()) for one in range(size)]
    return [
        [total[i][j] + least[i] * plain[j] + least[j] * plain[i] + rows * least[i] * least[j] for j in range(size)]
        for i in range(size)
    ]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """size, i, j, three parts of a sum: of products; of dimension j for i = -1; the rows for j = -1 too."""
    totals: dict[int, np.ndarray] = {}
    for whole in batches:
        for start in range(0, whole.num_rows, BLOCK_ROWS):
            column = whole.column("x").slice(start, BLOCK_ROWS)
            lengths = column.value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(lengths[lengths > 0]).tolist():
                chosen = column.filter(pa.array(lengths == size))
                x = chosen.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                block = np.zeros((size + 1, size + 1), object)
                block[:size, :size] = np.array(cross_products(x), object)
                block[size, :size] = np.array([sum(values) for values in x.T.tolist()], object)
                block[size, size] = len(x)
                totals[size] = totals[size] + block if size in totals else block
    for size, total in totals.items():
        rows = [(i, j) for i in range(size) for j in range(i + 1)] + [(size, j) for j in range(size + 1)]
        parts: list[list[int]] = [[], [], []]
        for i, j in rows:
            rest = total[i, j]
            for part in parts[:2]:
                rest, low = divmod(rest, 1 << PART_BITS)
                part.append(low)
            parts[2].append(rest)
        place = [[-1 if at == size else at for at in side] for side in zip(*rows, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([size] * len(rows), pa.int32()), *[pa.array(side, pa.int32()) for side in place], *[pa.array(part, pa.int64()) for part in parts]],
            ["size", "i", "j", "part0", "part1", "part2"],
        )


@dataclass(frozen=True)
class Model:
    """What the distinct vectors of one length have in common, and their whitening."""

    n: int
    sums: tuple[int, ...]
    weights: np.ndarray
    explained: tuple[float, ...]


def _jacobi(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors by rotations, which keep small ones precise beside very large ones."""
    a, vectors = matrix.copy(), np.eye(len(matrix))
    for _ in range(30):
        moved = False
        for i in range(len(a) - 1):
            for j in range(i + 1, len(a)):
                if abs(a[i, j]) <= 1e-15 * math.sqrt(abs(a[i, i] * a[j, j])):
                    continue
                moved = True
                slope = (a[j, j] - a[i, i]) / (2 * a[i, j])
                t = math.copysign(1 / (abs(slope) + math.hypot(1, slope)), slope)
                c = 1 / math.hypot(1, t)
                turn = np.array([[c, t * c], [-t * c, c]])
                a[:, [i, j]] = a[:, [i, j]] @ turn
                a[[i, j], :] = turn.T @ a[[i, j], :]
                vectors[:, [i, j]] = vectors[:, [i, j]] @ turn
        if not moved:
            break
    return np.diag(a).copy(), vectors


def _chosen(values: np.ndarray, vectors: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues that are more than rounding, and their vectors."""
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > 0]
    return values[order], vectors[:, order]


def fitted(n: int, sums: list[int], products: list[list[int]], components: int = COMPONENTS) -> Model:
    """The model of exact sums: n vectors, their sums and their sums of products."""
    size = len(sums)
    # n times the products, less the products of the sums, is n squared times the covariance.
    centred = [[n * products[i][j] - sums[i] * sums[j] for j in range(size)] for i in range(size)]
    square = n * n
    covariance = np.array([[one / square for one in row] for row in centred])
    trace = sum(centred[i][i] for i in range(size)) / square
    # The rank is that of the whole numbers, which rounding cannot hide.
    rank = _rank(centred, components)
    values, vectors = _chosen(*np.linalg.eigh(covariance), rank)
    weights = vectors / np.sqrt(values)
    if len(values) < rank or np.abs(weights.T @ covariance @ weights - np.eye(len(values))).max(initial=0) > GOOD_IDENTITY:
        values, vectors = _chosen(*_jacobi(covariance), rank)
        weights = vectors / np.sqrt(values)
    return Model(n, tuple(sums), weights, tuple((values / trace).tolist()))


def _rank(matrix: list[list[int]], most: int) -> int:
    """The rank of a whole-number matrix, at most ``most``, modulo a large prime."""
    prime = (1 << 61) - 1
    rows = [[one % prime for one in row] for row in matrix]
    rank = 0
    for column in range(len(rows)):
        pivot = next((k for k in range(rank, len(rows)) if rows[k][column]), None)
        if pivot is None:
            continue
        rows[rank], rows[pivot] = rows[pivot], rows[rank]
        inverse = pow(rows[rank][column], -1, prime)
        for k in range(rank + 1, len(rows)):
            if factor := rows[k][column] * inverse % prime:
                rows[k] = [(a - factor * b) % prime for a, b in zip(rows[k], rows[rank], strict=True)]
        rank += 1
        if rank == most:
            break
    return rank


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """Models by length from the distinct vectors ``x``, whole numbers, of ``vectors``."""
    parts = [F.sum(F.col(f"part{k}").cast("decimal(20,0)")).alias(f"part{k}") for k in range(3)]
    sums = vectors.select("x").mapInArrow(_sums, "size int, i int, j int, part0 long, part1 long, part2 long")
    by_size: dict[int, dict] = {}
    for row in sums.groupBy("size", "i", "j").agg(*parts).collect():
        value = sum(int(row[f"part{k}"]) << PART_BITS * k for k in range(3))
        by_size.setdefault(row["size"], {})[row["i"], row["j"]] = value
    return {
        size: fitted(
            found[-1, -1],
            [found[-1, j] for j in range(size)],
            [[found[max(i, j), min(i, j)] for j in range(size)] for i in range(size)],
            components,
        )
        for size, found in by_size.items()
    }


def _projected(batches: Iterator[pa.RecordBatch], models: dict[int, Model], kept: list[str]) -> Iterator[pa.RecordBatch]:
    """The columns of ``kept``, size, deviation, whitened (one value a component) of every vector."""
    for whole in batches:
        for start in range(0, whole.num_rows, BLOCK_ROWS):
            batch = whole.slice(start, BLOCK_ROWS)
            lengths = batch.column("x").value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(lengths[lengths > 0]).tolist():
                model, part = models[size], batch.filter(pa.array(lengths == size))
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                most = max(model.n * int(np.abs(x.astype(np.float64)).max() + 1) + abs(max(model.sums, key=abs)), 1)
                exact = np.int64 if size * most * most < 1 << 63 else object
                centred = x.astype(exact) * model.n - np.array(model.sums, exact)
                deviation = (centred * centred).sum(axis=1).tolist()
                whitened = (centred / model.n).astype(np.float64) @ model.weights
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(name) for name in kept],
                        pa.array([size] * len(x), pa.int32()),
                        pa.array([one if one < 1 << 63 else None for one in deviation], pa.int64()),
                        pa.array(list(whitened), pa.list_(pa.float64())),
                    ],
                    [*kept, "size", "deviation", "whitened"],
                )


def _identity_error(vectors: DataFrame, models: dict[int, Model]) -> float:
    """The largest entry of the whitened vectors' covariance less the identity."""
    most = max(len(model.explained) for model in models.values())
    projected = vectors.select("x").mapInArrow(
        lambda batches: _projected(batches, models, []), "size int, deviation long, whitened array<double>"
    )
    value = [F.get("whitened", F.lit(k)) for k in range(most)]
    pairs = [(a, b) for a in range(most) for b in range(a, most)]
    rows = projected.groupBy("size").agg(*[F.covar_pop(value[a], value[b]).alias(f"c{a}_{b}") for a, b in pairs]).collect()
    errors = [
        abs(row[f"c{a}_{b}"] - (a == b)) for row in rows for a, b in pairs if b < len(models[row["size"]].explained)
    ]
    return max(errors, default=0.0)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Returns vec_id, component, n, deviation, whitened, explained, identity_error.

    ``vectors`` has vec_id and embedding. Rows whose vector is NULL or holds a NULL
    or non-finite entry, or one beyond 2**55, whose multiple of 256 a long cannot
    hold, are dropped. The others have a row for each of the ``components`` first
    components. A component without variance does not exist, so vectors that are
    all equal, and empty ones, have no rows. Rows that repeat a vec_id, and those
    without one, are rows of their own. A deviation beyond a long is NULL. The
    identity error is the largest over all lengths. An empty table gives no rows.
    Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("embedding")).alias("x"))
    rows = stored(rows.where(F.col("x").isNotNull()), "scaled")
    distinct = stored(rows.select("x").distinct(), "fit_list")
    models = fit(distinct, components)
    columns = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not any(model.explained for model in models.values()):
        return spark.createDataFrame([], columns)
    error = _identity_error(distinct, models)
    projected = rows.mapInArrow(
        lambda batches: _projected(batches, models, ["vec_id"]),
        "vec_id long, size int, deviation long, whitened array<double>",
    )
    n = F.create_map(*[F.lit(one) for size, model in models.items() for one in (size, model.n)])
    shares = F.create_map(
        *[one for size, model in models.items() for one in (F.lit(size), F.array(*map(F.lit, model.explained)).cast("array<double>"))]
    )
    spread = projected.select("vec_id", "size", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return spread.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        n[F.col("size")].cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares[F.col("size")], F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
