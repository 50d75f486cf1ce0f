"""Whitening of embeddings by a bit-sliced scatter matrix.

1. Every usable vector becomes whole numbers x = floor(256 * c), packed into bytes that
   are equal just where the vectors are.  The fit list is each packed vector once; the
   distinct combines in its tasks first, so a vector held by many rows costs one row a
   task.  It is written once, since it is read twice.
2. Tasks take the fit list block by block.  A block's dimensions are shifted by their
   least value, and bit plane p of dimension i is packed across the rows into 64-bit
   words.  The sum of u_i * u_j is then the sum over planes of 2^(p+q) times the number
   of ones in (plane p of i AND plane q of j).  The shift is undone with the sums, all in
   whole numbers of any size.  A task hands on one row per pair of dimensions, in limbs
   of 32 bits, which Spark adds up exactly.
3. The driver holds one matrix of dimensions by dimensions per length of vector: bounded
   by the width of the vectors, not by their number.  It is centred in whole numbers,
   n * sum(x_i x_j) - S_i * S_j, divided by n^2 once, and given to ``eigh``.
4. Rows are projected in a second look at the table; ``identity_error`` is measured on
   the fit list by Spark's own population covariance.

Defined cases: a row whose vector is null, or holds a null, NaN or infinite entry, goes;
entries beyond the range of a 64-bit number after scaling take its ends; vectors of
another length are a space of their own, with its own n and components; an empty vector
has no component, so no row; repeated vectors count once in the fit and have a row
each, null vec_ids too; a component without variance (as with one distinct vector) has
``whitened`` null, and ``explained`` is null where nothing varies; a ``deviation`` beyond
a 64-bit number is null; an empty table gives an empty result; further columns are
dropped.  The vector is the column ``embedding``, or the one named.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirebind.session import settle

SCALE = 256
COMPONENTS = 4
BLOCK_ROWS, BLOCK_ENTRIES = 8192, 1 << 22
LIMB, LIMBS = 32, 6
_LONG = np.iinfo(np.int64)


class Space(NamedTuple):
    """What is fitted for vectors of one length."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling, COMPONENTS at most
    vectors: np.ndarray  # a row per component
    trace: float


# --- vectors as whole numbers ---------------------------------------------------

def _packed(x: np.ndarray) -> bytes:
    """Equal bytes for equal vectors: four bytes an entry if all fit, else eight."""
    narrow = x.astype("<i4")
    if (narrow == x).all():
        return b"\x04" + narrow.tobytes()
    return b"\x08" + x.astype("<i8").tobytes()


def _unpacked(packed: list[bytes]) -> np.ndarray:
    """Rows of x of packed vectors of one length."""
    return np.stack([
        np.frombuffer(p, "<i4" if p[0] == 4 else "<i8", offset=1).astype(np.int64) for p in packed
    ])


def _whole(entries: np.ndarray) -> np.ndarray:
    scaled = np.floor(SCALE * entries.astype(np.float64))
    low, high = scaled <= _LONG.min, scaled >= 2.0**63
    x = np.where(low | high, 0.0, scaled).astype(np.int64)
    x[low], x[high] = _LONG.min, _LONG.max
    return x


def whole_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, dims, packed of the rows with a usable vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            ends = lists.offsets.to_numpy()
            entries = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            fine = np.concatenate(([0], np.cumsum(~np.isfinite(entries))))
            usable = lists.is_valid().to_numpy(zero_copy_only=False)
            usable &= fine[ends[1:]] == fine[ends[:-1]]
            kept = np.flatnonzero(usable)
            with np.errstate(invalid="ignore"):
                x = _whole(np.nan_to_num(entries, nan=0.0, posinf=0.0, neginf=0.0))
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(kept)),
                pa.array((ends[1:] - ends[:-1])[kept].astype(np.int32)),
                pa.array([_packed(x[ends[i] : ends[i + 1]]) for i in kept], pa.binary()),
            ], names=["vec_id", "dims", "packed"])

    given = rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("v"),
    )
    return given.mapInArrow(run, "vec_id bigint, dims int, packed binary")


# --- scatter --------------------------------------------------------------------

def planes(x: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, int]:
    """Bit planes of x - least: (dimensions * width, words), and the width in bits."""
    shifted = x.view(np.uint64) - least.view(np.uint64)  # modulo 2^64: right at any range
    width = max(1, int(shifted.max()).bit_length())
    bits = (shifted.T[:, None, :] >> np.arange(width, dtype=np.uint64)[None, :, None]) & np.uint64(1)
    packed = np.packbits(bits.astype(np.uint8), axis=-1)
    spare = -packed.shape[-1] % 8
    packed = np.pad(packed, ((0, 0), (0, 0), (0, spare)))
    return np.ascontiguousarray(packed).view(np.uint64).reshape(x.shape[1] * width, -1), width


def products(x: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Sums of x_i, and of x_i * x_j for j >= i, exact."""
    rows, dims = x.shape
    least = x.min(axis=0)
    sliced, width = planes(x, least)
    exact = 2 * width + rows.bit_length() <= 62
    weight = np.array([1 << q for q in range(width)], np.int64 if exact else object)
    ones = np.bitwise_count(sliced).sum(axis=1, dtype=np.int64).reshape(dims, width)
    moved = [int(v) for v in (ones if exact else ones.astype(object)) @ weight]
    low = [int(v) for v in least]
    sums = [m + rows * a for m, a in zip(moved, low)]
    out = []
    for i in range(dims):
        rest = sliced[i * width :]
        both = np.zeros(dims - i, np.int64 if exact else object)
        for p in range(width):
            count = np.bitwise_count(rest & sliced[i * width + p]).sum(axis=1, dtype=np.int64)
            count = count.reshape(dims - i, width)
            both = both + (count if exact else count.astype(object)) @ weight * weight[p]
        out.append([
            int(b) + low[i] * moved[j] + low[j] * moved[i] + rows * low[i] * low[j]
            for j, b in zip(range(i, dims), both)
        ])
    return sums, out


def _limbs(value: int) -> list[int]:
    """Parts of 32 bits, the last one signed."""
    parts = [value >> LIMB * k & (1 << LIMB) - 1 for k in range(LIMBS - 1)]
    return [*parts, value >> LIMB * (LIMBS - 1)]


class _Sums:
    """A task's sums for vectors of one length."""

    def __init__(self, dims: int) -> None:
        self.dims, self.n, self.waiting = dims, 0, []
        self.at = max(64, min(BLOCK_ROWS, BLOCK_ENTRIES // max(1, dims)))
        self.sums = [0] * dims
        self.products = [[0] * (dims - i) for i in range(dims)]

    def add(self, packed: bytes) -> None:
        self.waiting.append(packed)
        if len(self.waiting) >= self.at:
            self.flush()

    def flush(self) -> None:
        if self.waiting:
            sums, both = products(_unpacked(self.waiting))
            self.n += len(self.waiting)
            self.waiting = []
            self.sums = [a + b for a, b in zip(self.sums, sums)]
            self.products = [[a + b for a, b in zip(x, y)] for x, y in zip(self.products, both)]

    def rows(self) -> Iterator[tuple]:
        yield (self.dims, -1, -1, *_limbs(self.n))
        for i, s in enumerate(self.sums):
            yield (self.dims, -1, i, *_limbs(s))
            for j, v in enumerate(self.products[i]):
                yield (self.dims, i, i + j, *_limbs(v))


def scatter(fit: DataFrame) -> DataFrame:
    """dims, i, j and limbs of the sum of x_i * x_j; i = -1 has the sum of x_j, and
    i = j = -1 the number of vectors."""
    names = ["dims", "i", "j", *[f"l{k}" for k in range(LIMBS)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Sums] = {}
        for batch in batches:
            for d, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if d not in held:
                    held[d] = _Sums(d)
                held[d].add(p)
        for one in held.values():
            one.flush()
            rows = list(one.rows())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows)], names=names
            )

    parts = fit.select("dims", "packed").mapInArrow(run, ", ".join(f"{c} bigint" for c in names))
    return parts.groupBy("dims", "i", "j").agg(*[F.sum(c).alias(c) for c in names[3:]])


def fitted(sums: list) -> dict[int, Space]:
    """The spaces of ``scatter``'s rows."""
    exact: dict[int, dict[tuple[int, int], int]] = {}
    for row in sums:
        d, i, j, *limbs = row
        exact.setdefault(d, {})[i, j] = sum(v << LIMB * k for k, v in enumerate(limbs))
    spaces = {}
    for d, sums_of in exact.items():
        n = sums_of[-1, -1]
        s = [sums_of[-1, i] for i in range(d)]
        v = np.empty((d, d))
        for i in range(d):
            for j in range(i, d):
                v[i, j] = v[j, i] = (n * sums_of[i, j] - s[i] * s[j]) / (n * n)
        values, vectors = np.linalg.eigh(v)
        top = np.argsort(values)[::-1][:COMPONENTS]
        trace = float(sum(v[i, i] for i in range(d)))
        floor = values[-1] * d * np.finfo(float).eps
        kept = np.where(values[top] > floor, values[top], 0.0)
        spaces[d] = Space(n, s, kept, vectors[:, top].T, trace)
    return spaces


# --- projection -----------------------------------------------------------------

def _projected(vectors: DataFrame, spaces: dict[int, Space]) -> DataFrame:
    """Add n, deviation, whitened (an array over the components) to packed vectors."""
    kept = [c for c in vectors.columns if c != "packed"]

    def of(space: Space, x: np.ndarray) -> tuple[list, list]:
        n, sums = space.n, np.array(space.sums, object)
        reach = max(map(abs, space.sums), default=0) + n * (abs(int(x.max())) + abs(int(x.min())))
        if reach**2 * x.shape[1] < _LONG.max:
            away = n * x - sums.astype(np.int64)
            deviation = (away * away).sum(axis=1).tolist()
        else:
            away = n * x.astype(object) - sums
            total = [int(v) for v in (away * away).sum(axis=1)]
            deviation = [v if v <= _LONG.max else None for v in total]
        centred = (away / n).astype(np.float64)
        scale = [e**-0.5 if e > 0 else np.nan for e in space.values]
        w = centred @ (space.vectors.T * scale)
        return deviation, [[None if np.isnan(c) else c for c in row] for row in w.tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array(batch.column("dims"))
            packed = batch.column("packed").to_pylist()
            for d in np.unique(dims):
                if not d:
                    continue
                at = np.flatnonzero(dims == d)
                deviation, w = of(spaces[int(d)], _unpacked([packed[i] for i in at]))
                taken = batch.select(kept).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([
                    *taken.columns, pa.array(deviation, pa.int64()),
                    pa.array(w, pa.list_(pa.float64())),
                ], names=[*kept, "deviation", "whitened"])

    fields = ", ".join(f"{c} {t}" for c, t in vectors.dtypes if c != "packed")
    return vectors.mapInArrow(run, f"{fields}, deviation bigint, whitened array<double>")


def identity_errors(fit: DataFrame, spaces: dict[int, Space]) -> dict[int, float | None]:
    """Per length: how far the covariance of the whitened fit list is from the identity."""
    w = _projected(fit.select("dims", "packed"), spaces)
    pairs = [(a, b) for a in range(COMPONENTS) for b in range(a, COMPONENTS)]
    at = lambda k: F.get("whitened", F.lit(k))
    aggs = [F.covar_pop(at(a), at(b)).alias(f"c{a}_{b}") for a, b in pairs]
    out: dict[int, float | None] = {}
    for row in w.groupBy("dims").agg(*aggs).collect():  # a row per length
        own = spaces[row["dims"]].values
        off = [
            abs(row[f"c{a}_{b}"] - (a == b)) for a, b in pairs
            if b < len(own) and own[a] > 0 and own[b] > 0
        ]
        out[row["dims"]] = max(off) if off else None
    return out


def whitened(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened,
    explained, identity_error."""
    vectors = whole_vectors(rows, vector)
    fit = settle(vectors.filter("dims > 0").select("dims", "packed").distinct())
    spaces = fitted([tuple(r) for r in scatter(fit).collect()])  # dimensions^2 rows a length
    errors = identity_errors(fit, spaces) if spaces else {}
    spark = rows.sparkSession
    known = spark.createDataFrame(
        [
            (d, k, s.n, float(e / s.trace) if s.trace else None, errors.get(d))
            for d, s in spaces.items() for k, e in enumerate(s.values)
        ],
        "d int, k int, n bigint, explained double, identity_error double",
    )
    placed = _projected(vectors, spaces).select(
        "vec_id", "dims", "deviation", F.posexplode("whitened").alias("pos", "whitened")
    )
    same = (placed["dims"] == known["d"]) & (placed["pos"] == known["k"])
    return placed.join(known, same).select(
        "vec_id", (F.col("pos") + 1).alias("component"), "n", "deviation", "whitened",
        "explained", "identity_error",
    )
