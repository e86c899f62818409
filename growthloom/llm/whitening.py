"""Whitening of embeddings from exact, bit-sliced scatter matrices.

Entries become integers (floor of ``scale`` times the entry). Per dimension
they are shifted to start at zero and cut into bit planes; a plane holds one
bit of 64 rows in a word. The sum over all rows of the product of two
dimensions is then the sum, over pairs of their planes, of 2^(i+j) times the
number of set bits of one plane AND the other: exact integers, added up over
tasks in any order. The centred scatter n * sum(x y) - sum(x) * sum(y) is
exact too; only after that does a matrix of doubles, as wide as a vector, go
to ``eigh`` on the driver.

Each distinct integer vector counts once in the fit, however many rows hold
it; copies are folded before the shuffle. What reaches the driver is bounded
by the vector's width (its square), never by rows.

Rows without a vector, or whose vector holds a null or a non-finite entry, are
dropped. So are vectors of another length than the most common one among the
distinct vectors (ties: the longer), empty ones included. Integers beyond 64
bits stop at its ends. Null and repeated ids stay. Components without variance
(more vectors alike than dimensions, a single vector) have null ``whitened``;
a fit without any variance has null ``explained`` and ``identity_error`` too.
An empty table gives an empty result. Other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthloom.llm.common import picked, scratch_table

SCALE = 256
COMPONENTS = 4
#: Rows of a block of bit planes at most, and its size before packing, in cells.
BLOCK_ROWS = 4096
BLOCK_CELLS = 1 << 22
#: Exact numbers beyond 64 bits travel in two parts, of this many bits the lower.
LIMB = 60
DIGITS = 10**18


def integers(column: pa.Array, scale: int = SCALE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors as longs) of a batch's valid vectors, length by length."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    there = pc.is_valid(column).to_numpy(zero_copy_only=False)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: not a number
    begin = np.cumsum(size) - size
    bad = np.append(0, np.cumsum(~np.isfinite(values)))
    good = there & (size > 0) & (bad[begin + size] == bad[begin])
    for width in np.unique(size[good]).tolist():
        rows = np.flatnonzero(good & (size == width))
        with np.errstate(over="ignore"):
            floor = np.floor(values[begin[rows, None] + np.arange(width)] * scale)
        high, low = floor >= 2.0**63, floor <= -(2.0**63)
        x = np.where(high | low, 0, floor).astype(np.int64)
        x[high], x[low] = np.iinfo(np.int64).max, np.iinfo(np.int64).min
        yield rows, x


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of a batch of binary values, ``width`` longs each."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, width)


def _limbs(value: int) -> tuple[int, int]:
    return value >> LIMB, value & ((1 << LIMB) - 1)


class BitSlices:
    """Cross-products of integer dimensions by AND and population count.

    ``low`` and ``high`` bound each dimension; products are of the entries
    less ``low``.
    """

    def __init__(self, low: list[int], high: list[int]):
        bits = np.array([(h - l).bit_length() for l, h in zip(low, high)], np.int64)
        self.low = np.array(low, np.int64).astype(np.uint64)
        self.dims = np.flatnonzero(bits)  # constant dimensions have no planes
        self.owner = np.repeat(np.arange(len(bits)), bits)
        self.first = (np.cumsum(bits) - bits)[self.dims]
        self.shift = np.concatenate([np.arange(b) for b in bits]).astype(np.uint64) if bits.any() else np.zeros(0, np.uint64)
        self.rows = max(64, min(BLOCK_ROWS, BLOCK_CELLS // max(1, len(self.owner))) // 64 * 64)
        # A block's products fit in a long, or are counted with Python's integers.
        small = 2 * int(bits.max(initial=0)) + self.rows.bit_length() <= 62
        self.weight = np.array([1 << int(s) for s in self.shift], np.int64 if small else object)
        self.products = np.zeros((len(bits), len(bits)), object)

    def planes(self, x: np.ndarray) -> np.ndarray:
        """Planes by words: bit ``shift`` of dimension ``owner``, 64 rows a word."""
        y = x.astype(np.uint64) - self.low  # modulo 2^64, so right for any pair of longs
        padded = np.zeros((-(-len(y) // 64) * 64, y.shape[1]), np.uint64)
        padded[: len(y)] = y
        bit = (padded.T[self.owner] >> self.shift[:, None]) & np.uint64(1)
        return np.packbits(bit.astype(np.uint8), axis=1).view(np.uint64)

    def add(self, x: np.ndarray) -> None:
        """Count the rows of ``x`` (at most ``rows``)."""
        if not len(self.owner):
            return
        planes = self.planes(x)
        block = np.zeros((len(self.dims), len(self.dims)), self.weight.dtype)
        for d, begin in enumerate(self.first):
            later = planes[begin:]
            end = self.first[d + 1] if d + 1 < len(self.first) else len(planes)
            for p in range(begin, end):
                common = np.bitwise_count(planes[p] & later).sum(axis=1, dtype=np.int64) * self.weight[begin:]
                block[d, d:] += np.add.reduceat(common, self.first[d:] - begin) * self.weight[p]
        self.products[np.ix_(self.dims, self.dims)] += block

    def pairs(self) -> Iterator[tuple[int, int, int]]:
        for i in range(len(self.products)):
            for j in range(i, len(self.products)):
                yield i, j, int(self.products[i, j])


@dataclass(frozen=True)
class Whitening:
    """A fit: n vectors, their sums, unit components (rows, by falling
    variance), the components' variances, the total variance."""

    n: int
    sums: tuple[int, ...]
    low: tuple[int, ...]
    high: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    scale: int

    @property
    def matrix(self) -> np.ndarray:
        """Components over the roots of their variances; not a number without variance."""
        floor = max(self.variances.max(initial=0), 0) * len(self.sums) * np.finfo(float).eps
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where((self.variances > floor)[:, None], self.components / np.sqrt(np.abs(self.variances))[:, None], np.nan)

    def _fits(self, bits: int) -> bool:
        return max(max(abs(l), abs(h)) for l, h in zip(self.low, self.high)) * self.n < 1 << bits

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact: longs, or Python's integers where those don't hold it."""
        if self._fits(61):
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def deviations(self, centred: np.ndarray) -> list[int]:
        if centred.dtype != object:
            most = int(np.abs(centred).max(initial=0))
            if most * most * len(self.sums) < 1 << 63:
                return (centred * centred).sum(axis=1).tolist()
        wide = centred.astype(object)
        return (wide * wide).sum(axis=1).tolist()

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(np.float64) / self.n) @ self.matrix.T


def distinct_vectors(vectors: DataFrame, vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Each distinct valid integer vector once: ``x``, binary, little-endian longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in integers(batch.column(0), scale):
                yield pa.RecordBatch.from_arrays([pa.array([row.tobytes() for row in x.astype("<i8")], pa.binary())], names=["x"])

    return picked(vectors, vec=vec_col).mapInArrow(run, "x binary").distinct()


def _dimension_sums(fit: DataFrame) -> DataFrame:
    """(width, dim, n, low, high, sum) of the fit list, by vector length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            column = batch.column(0)
            sizes = pc.binary_length(column).to_numpy(zero_copy_only=False) // 8
            for width in np.unique(sizes).tolist():
                x = _matrix(column.filter(pa.array(sizes == width)), width)
                new = [len(x), x.min(axis=0), x.max(axis=0), (x >> 32).sum(axis=0).astype(object), (x & 0xFFFFFFFF).sum(axis=0).astype(object)]
                old = found.get(width)
                found[width] = new if old is None else [old[0] + new[0], np.minimum(old[1], new[1]), np.maximum(old[2], new[2]), old[3] + new[3], old[4] + new[4]]
        for width, (n, low, high, upper, lower) in found.items():
            whole = [_limbs((int(u) << 32) + int(v)) for u, v in zip(upper, lower)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([width] * width, pa.int32()), pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64())]
                + [pa.array([w[k] for w in whole], pa.int64()) for k in (0, 1)],
                names=["width", "dim", "n", "low", "high", "upper", "lower"],
            )

    rows = fit.mapInArrow(run, "width int, dim int, n long, low long, high long, upper long, lower long")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("upper", "lower")]
    return rows.groupBy("width", "dim").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), *exact)


def _whole(upper: Decimal, lower: Decimal) -> int:
    return (int(upper) << LIMB) + int(lower)


def _products(fit: DataFrame, low: list[int], high: list[int]) -> dict[tuple[int, int], int]:
    """Sums over the fit list of products of dimensions i <= j, less ``low``."""
    width = len(low)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = BitSlices(low, high)
        held = np.zeros((0, width), np.int64)
        for batch in batches:
            x = np.concatenate([held, _matrix(batch.column(0), width)])
            whole = len(x) // slices.rows * slices.rows
            for at in range(0, whole, slices.rows):
                slices.add(x[at : at + slices.rows])
            held = x[whole:]
        if len(held):
            slices.add(held)
        i, j, value = zip(*slices.pairs())
        limbs = [_limbs(v) for v in value]
        # The upper limb of a product may be more than a long.
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(u) for u, _ in limbs]), pa.array([v for _, v in limbs], pa.int64())], names=["i", "j", "upper", "lower"])

    rows = fit.mapInArrow(run, "i int, j int, upper string, lower long")
    summed = rows.groupBy("i", "j").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("upper", "lower")])
    return {(r.i, r.j): _whole(r.upper, r.lower) for r in summed.collect()}  # as many as the width's square


def fitted(fit: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> Whitening | None:
    """The whitening of a list of distinct vectors; None without any."""
    sums = scratch_table(_dimension_sums(fit), "dimensions")
    common = sums.where("dim = 0").orderBy(F.desc("n"), F.desc("width")).first()
    if common is None:
        return None
    width, n = common.width, common.n
    rows = sorted(sums.where(F.col("width") == width).collect(), key=lambda r: r.dim)  # as many as the width
    low, high = [r.low for r in rows], [r.high for r in rows]
    total = [_whole(r.upper, r.lower) for r in rows]
    found = _products(fit.where(F.octet_length("x") == 8 * width), low, high)
    shifted = [s - n * l for s, l in zip(total, low)]
    covariance = np.zeros((width, width))
    scatter_trace = 0
    for (i, j), product in found.items():
        centred = n * product - shifted[i] * shifted[j]
        covariance[i, j] = covariance[j, i] = centred / (n * n)  # of integers: rounded once
        scatter_trace += centred if i == j else 0
    values, columns = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[: min(components, width)]
    return Whitening(n, tuple(total), tuple(low), tuple(high), columns.T[order], values[order], scatter_trace / (n * n), scale)


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    width, k = len(model.sums), int((~np.isnan(model.matrix).any(axis=1)).sum())
    if not k:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = model.whitened(model.centred(_matrix(batch.column(0), width)))
            yield pa.RecordBatch.from_arrays([pa.array(w[:, c]) for c in range(k)], names=[f"w{c}" for c in range(k)])

    rows = fit.where(F.octet_length("x") == 8 * width).mapInArrow(run, ", ".join(f"w{c} double" for c in range(k)))
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    found = rows.agg(*[F.covar_pop(f"w{a}", f"w{b}").alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(v - (a == b)) for v, (a, b) in zip(found, pairs))


def transformed(vectors: DataFrame, model: Whitening, error: float | None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """A row for each valid vector and component; ``deviation`` is decimal(38,0), null beyond it."""
    width, k, scale = len(model.sums), len(model.variances), model.scale
    explained = [float(v) / model.trace if model.trace > 0 else None for v in model.variances]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in integers(batch.column(1), scale):
                if x.shape[1] != width:
                    continue
                centred = model.centred(x)
                split = [divmod(d, DIGITS) for d in model.deviations(centred)]
                split = [s if s[0] < DIGITS else (None, None) for s in split]
                white = model.whitened(centred).ravel()
                each = pa.array(np.repeat(np.arange(len(rows)), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows)).take(each),
                        pa.array(np.tile(np.arange(1, k + 1), len(rows)), pa.int32()),
                        *[pa.array([s[i] for s in split], pa.int64()).take(each) for i in (0, 1)],
                        pa.array(white, mask=np.isnan(white)),
                        pa.array(explained * len(rows), pa.float64()),
                    ],
                    names=["id", "component", "upper", "lower", "whitened", "explained"],
                )

    rows = picked(vectors, id=id_col, vec=vec_col)
    id_type = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {id_type}, component int, upper long, lower long, whitened double, explained double")
    deviation = F.col("upper").cast("decimal(18,0)") * F.lit(Decimal(DIGITS)).cast("decimal(19,0)") + F.col("lower")
    return out.select(
        F.col("id").alias(id_col), "component", F.lit(model.n).cast("long").alias("n"), deviation.cast("decimal(38,0)").alias("deviation"),
        "whitened", "explained", F.lit(error).cast("double").alias("identity_error"),
    )


def whitened(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Fit on the distinct vectors of ``vectors`` and transform all of them."""
    fit = scratch_table(distinct_vectors(vectors, vec_col, scale), "vectors")
    model = fitted(fit, components, scale)
    if model is None:
        empty = picked(vectors, id=id_col).limit(0)
        types = {"component": "int", "n": "long", "deviation": "decimal(38,0)", "whitened": "double", "explained": "double", "identity_error": "double"}
        return empty.select(F.col("id").alias(id_col), *[F.lit(None).cast(t).alias(c) for c, t in types.items()])
    return transformed(vectors, model, identity_error(fit, model), id_col, vec_col)
