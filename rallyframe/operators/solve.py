"""Many ridge fits at once by conjugate gradients: all penalties, folds and halves in one pass an iteration.

Rows hold their indicator columns as an array, a weight, a label and a mask. A problem is a penalty and the
rows whose mask has (or lacks) a bit. Rows are packed into blocks of arrays once. An iteration multiplies the design
of every problem with its direction in one scan of the blocks: each task adds up its part as arrays, chunks of columns are added
up again in Spark, and the driver sees as many numbers as there are columns and problems. No Gram matrix is ever
made, so driver memory and the broadcast are linear in the columns; ``LARGEST`` checks them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rallyframe.sources.stored import written

#: Columns of a partial sum that travel together.
CHUNK = 1024
#: Most numbers that the driver holds for one vector of all problems.
LARGEST = 100_000_000


@dataclass(frozen=True)
class Problem:
    """A fit: its penalty, and the rows whose mask has bit ``bit`` equal to ``want``; all rows if bit is negative."""

    alpha: float
    bit: int = -1
    want: int = 1

    def weights(self, w: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return w if self.bit < 0 else w * (((mask >> self.bit) & 1) == self.want)


class Rows:
    """A block of packed rows as arrays; ``sums`` and ``spread`` are the design and its transpose."""

    def __init__(self, block: dict[str, bytes]):
        self.sizes = np.frombuffer(block["sizes"], np.int32)
        self.some = self.sizes > 0
        self.w, self.y, self.mask = (np.frombuffer(block[c], k) if block.get(c) is not None else None for c, k in (("w", float), ("y", float), ("mask", np.int64)))
        self.seen, self.local = np.frombuffer(block["seen"], np.int32), np.frombuffer(block["local"], np.int32)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes, dtype=np.int64)[:-1]])[self.some]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """For each row the sum of its columns' ``values`` (columns, problems)."""
        out = np.zeros((len(self.sizes), values.shape[1]))
        if len(self.local):
            out[self.some] = np.add.reduceat(values[self.seen][self.local], self.starts, axis=0)
        return out

    def spread(self, values: np.ndarray, into: np.ndarray) -> None:
        """Adds each row's ``values`` (rows, problems) to all its columns."""
        for k in range(values.shape[1] if len(self.local) else 0):
            into[self.seen, k] += np.bincount(self.local, np.repeat(values[:, k], self.sizes), len(self.seen))


_PACKED = {"w": np.float64, "y": np.float64, "mask": np.int64}


def packed(rows: DataFrame, columns: np.ndarray) -> DataFrame:
    """Blocks of rows (w, y, mask, cols) with columns as places in ``columns``, looked up once for all iterations."""
    shared = rows.sparkSession.sparkContext.broadcast(columns)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                held = batch.column("cols")
                seen, local = np.unique(held.flatten().to_numpy(), return_inverse=True)
                parts = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(k).tobytes() for c, k in _PACKED.items()}
                parts |= {"sizes": np.diff(held.offsets.to_numpy()).astype(np.int32).tobytes(), "seen": np.searchsorted(shared.value, seen).astype(np.int32).tobytes(), "local": local.astype(np.int32).tobytes()}
                yield pa.RecordBatch.from_pydict({c: pa.array([v], pa.binary()) for c, v in parts.items()})

    return rows.select("w", "y", "mask", "cols").mapInArrow(task, ", ".join(f"{c} binary" for c in (*_PACKED, "sizes", "seen", "local")))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Rows]:
    for batch in batches:
        for block in batch.to_pylist():
            yield Rows(block)


def added_up(blocks: DataFrame, many: int, wide: int, part: Callable[[Rows, np.ndarray], None]) -> np.ndarray:
    """(many, wide): what ``part`` adds to the columns for each block, over all ``packed`` rows.

    No more tasks than there are cores, each with one vector of sums, of which it hands on the chunks that aren't zero:
    what is shuffled grows with the columns and not with columns times pieces of the table.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((many, wide))
        for block in _blocks(batches):
            part(block, total)
        for at in range(0, many, CHUNK):
            piece = total[at : at + CHUNK]
            if piece.any():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([piece.tobytes()], pa.binary())], ["at", "sums"])

    def together(held: pa.Table) -> pa.Table:
        total = np.zeros(len(held["sums"][0].as_buffer()) // 8)
        for s in held["sums"]:
            total += np.frombuffer(s.as_buffer())
        return pa.table({"at": pa.array([held["at"][0].as_py()], pa.int64()), "sums": pa.array([total.tobytes()], pa.binary())})

    few = blocks.coalesce(blocks.sparkSession.sparkContext.defaultParallelism)
    found = few.mapInArrow(task, "at long, sums binary").groupBy("at").applyInArrow(together, "at long, sums binary").toArrow()
    out = np.zeros((many, wide))
    for at, sums in zip(found["at"].to_pylist(), found["sums"].to_pylist()):
        piece = np.frombuffer(sums).reshape(-1, wide)
        out[at : at + len(piece)] = piece
    return out


def _checked(columns: np.ndarray, problems: list[Problem]) -> None:
    if len(columns) * len(problems) > LARGEST:
        raise ValueError(f"{len(columns)} columns and {len(problems)} problems are more than {LARGEST} numbers; solve fewer problems at a time")


def column_ids(rows: DataFrame) -> np.ndarray:
    """The distinct columns of rows (cols), sorted."""
    return np.sort(rows.select(F.explode("cols").alias("c")).distinct().toArrow()["c"].to_numpy())


def scalars(rows: DataFrame, problems: list[Problem]) -> np.ndarray:
    """(problems, 2): weight and weighted label of each problem's rows."""
    chosen = lambda p: F.lit(True) if p.bit < 0 else F.shiftright("mask", p.bit).bitwiseAND(F.lit(1)) == p.want
    each = [F.coalesce(F.sum(F.when(chosen(p), v)), F.lit(0.0)) for p in problems for v in (F.col("w"), F.col("w") * F.col("y"))]
    return np.array(rows.agg(*each).first(), dtype=float).reshape(-1, 2)


@dataclass
class Fits:
    """columns; beta (columns, problems); the weighted mean that each problem's labels were centred by; iterations; the packed rows."""

    columns: np.ndarray
    beta: np.ndarray
    means: np.ndarray
    iterations: int
    blocks: DataFrame


def ridges(rows: DataFrame, problems: list[Problem], tolerance: float = 1e-10, most: int = 1000) -> Fits:
    """All ``problems`` over ``rows`` (w, y, mask, cols), as ``models.ridge`` would fit each.

    A row's columns are indicators and may not repeat; labels are centred by their weighted mean. A problem without
    rows has coefficients 0. Raises if ``most`` iterations don't bring every residual below ``tolerance``
    of its right side. ``rows`` is packed once and the blocks are read once an iteration: store it first.
    """
    columns = column_ids(rows)
    _checked(columns, problems)
    k = len(problems)
    sums = scalars(rows, problems)
    means = np.divide(sums[:, 1], sums[:, 0], out=np.zeros(k), where=sums[:, 0] > 0)
    context = rows.sparkSession.sparkContext
    blocks = written(packed(rows, columns), "blocks")
    # Labels aren't read again, nor masks that no problem asks for.
    lean = blocks.drop("y", *([] if any(p.bit >= 0 for p in problems) else ["mask"]))

    def first(batch: Rows, into: np.ndarray) -> None:
        w = np.stack([p.weights(batch.w, batch.mask) for p in problems], axis=1)
        batch.spread(np.concatenate([w, w * (batch.y[:, None] - means)], axis=1), into)

    start = added_up(blocks, len(columns), 2 * k, first)
    alphas = np.array([p.alpha for p in problems])
    scale, left = start[:, :k] + alphas, start[:, k:]
    size = np.sqrt((left * left).sum(axis=0))
    beta, z = np.zeros_like(left), left / scale
    way, inner, rounds = z.copy(), (left * z).sum(axis=0), 0
    while np.any(np.sqrt((left * left).sum(axis=0)) > tolerance * size):
        if rounds == most:
            raise ArithmeticError(f"no convergence in {most} iterations")
        rounds += 1
        shared = context.broadcast(way)

        def product(batch: Rows, into: np.ndarray, shared=shared) -> None:
            w = np.stack([p.weights(batch.w, batch.mask) for p in problems], axis=1)
            batch.spread(w * batch.sums(shared.value), into)

        turned = added_up(lean, len(columns), k, product) + alphas * way
        shared.destroy()
        curve = (way * turned).sum(axis=0)
        length = np.divide(inner, curve, out=np.zeros(k), where=curve > 0)
        beta += length * way
        left = left - length * turned
        z = left / scale
        before, inner = inner, (left * z).sum(axis=0)
        way = z + np.divide(inner, before, out=np.zeros(k), where=before > 0) * way
    return Fits(columns, beta, means, rounds, blocks)


def errors(rows: DataFrame, problems: list[Problem], fits: Fits) -> np.ndarray:
    """Weighted RMSE of each problem on the rows it leaves out, in one scan; NaN where there are none."""
    context, means = rows.sparkSession.sparkContext, fits.means
    shared = context.broadcast(fits.beta)
    k = len(problems)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, 2))
        for held in _blocks(batches):
            w = np.stack([held.w - p.weights(held.w, held.mask) for p in problems], axis=1)
            off = held.y[:, None] - means - held.sums(shared.value)
            total += np.stack([(w * off * off).sum(axis=0), w.sum(axis=0)], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(total[:, 0]), pa.array(total[:, 1])], ["problem", "square", "w"])

    parts = fits.blocks.mapInArrow(task, "problem int, square double, w double")
    found = parts.groupBy("problem").agg(F.sum("square"), F.sum("w")).orderBy("problem").collect()
    shared.destroy()
    return np.array([np.sqrt(r[1] / r[2]) if r[2] > 0 else np.nan for r in found])


def residuals(problems: list[Problem], fits: Fits) -> np.ndarray:
    """(columns, problems): what each fit leaves over of its normal equations, by weight of the column; one scan of the rows."""
    k, means = len(problems), fits.means
    shared = fits.blocks.sparkSession.sparkContext.broadcast(fits.beta)

    def part(batch: Rows, into: np.ndarray) -> None:
        w = np.stack([p.weights(batch.w, batch.mask) for p in problems], axis=1)
        batch.spread(np.concatenate([w, w * (batch.y[:, None] - means - batch.sums(shared.value))], axis=1), into)

    found = added_up(fits.blocks, len(fits.columns), 2 * k, part)
    shared.destroy()
    left = found[:, k:] - np.array([p.alpha for p in problems]) * fits.beta
    return np.divide(left, found[:, :k], out=np.full_like(left, np.nan), where=found[:, :k] > 0)


def fold_mask(fold, folds: int):
    """A mask whose bit f is 1 for rows of other folds than f: the training rows of fold f."""
    return F.lit((1 << folds) - 1).cast("long") - F.element_at(F.array(*[F.lit(1 << f).cast("long") for f in range(folds)]), fold.cast("int") + 1)


def cross_validated(rows: DataFrame, folds: int, alphas: list[float]) -> list[tuple[float, float]]:
    """(alpha, mean weighted RMSE over folds) of rows (w, y, fold, cols), fold from 0: all fits together."""
    masked = rows.withColumn("mask", fold_mask(F.col("fold"), folds))
    problems = [Problem(a, f) for a in alphas for f in range(folds)]
    found = errors(masked, problems, ridges(masked, problems)).reshape(len(alphas), folds)
    return list(zip(alphas, np.nanmean(found, axis=1).tolist()))


def frame(spark, fits: Fits, problem: int = 0) -> DataFrame:
    """col, beta of one problem."""
    return spark.createDataFrame(pa.table({"col": pa.array(fits.columns.astype(np.int64)), "beta": pa.array(fits.beta[:, problem].copy())}))
