"""Packing token sequences by non-negative least squares.

Documents are cut into windows' worth of tokens; what remains of each has a length below the
window. Lengths fall into bins of ``GRAIN`` tokens. All combinations of up to ``DEPTH`` bins that
fill a window exactly are enumerated, and non-negative least squares finds how often each is to
be repeated for their sum to match the histogram of pieces. Repeat counts are rounded down and
held to what the histogram has; what is left over is packed greedily, largest bin first.

The solver sees the histogram alone, which has window / GRAIN + 1 rows whatever the input. Pieces
are matched to the plan by rank within their bin. Ranks are counted in (bin, chunk) groups, so a
bin that holds most of the pieces is still dealt over all tasks.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rallyframe.llm.scratch import write_scratch
from rallyframe.llm.words import slices, worker_codec

WINDOW = 1024
GRAIN = 8
DEPTH = 3
END_ID = 0
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces_of(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """PIECES of (doc_id, text): cuts after each ``window`` ids. A null text counts as empty."""

    def cut(batches):
        codec = worker_codec(tokenizer, True)
        for batch in batches:
            for piece in slices(batch, 1):
                ids, ends = codec.encode(piece.column(1))
                out = []
                for doc_id, a, b in zip(piece.column(0).to_pylist(), ends[:-1], ends[1:]):
                    own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                    for at in range(0, len(own), window):
                        part = own[at : at + window]
                        out.append((doc_id, at, len(part), zlib.crc32(part.tobytes()), len(own)))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=[x.split()[0] for x in PIECES.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def combinations(units: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All non-increasing tuples of up to ``depth`` positive bins that add up to ``units``."""
    found = []

    def extend(head: tuple[int, ...], left: int) -> None:
        if not left:
            found.append(head)
            return
        slots = depth - len(head)
        if not slots:
            return
        for part in range(min(left, head[-1] if head else left), -(-left // slots) - 1, -1):
            extend((*head, part), left - part)

    extend((), units)
    return found


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """x >= 0 that minimises |ax - b|, by the active-set method."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, dtype=bool)
    scale = max(1.0, float(np.abs(b).max(initial=0)))
    gradient = a.T @ b
    for _ in range(rounds):
        waiting = np.where(active, -np.inf, gradient)
        pick = int(np.argmax(waiting))
        if waiting[pick] <= 1e-9 * scale:
            break
        active[pick] = True
        while True:
            some = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, some], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[some] = z
                break
            low = z <= 0
            old = x[some]
            step = np.min(old[low] / np.maximum(old[low] - z[low], 1e-300))
            x[some] = old + step * (z - old)
            gone = some[(x[some] <= 1e-12 * scale) & low]
            if not len(gone):
                gone = some[low]
            active[gone] = False
            x[~active] = 0
        gradient = a.T @ (b - a @ x)
    return x


def plan(histogram: np.ndarray, depth: int = DEPTH) -> list[tuple[dict[int, int], int]]:
    """Patterns (bin: pieces) and their repeats that use up ``histogram``; entry i counts bin i + 1.

    The last bin is a full window. Every piece is in exactly one repeat of one pattern, and no
    pattern exceeds the window.
    """
    units = len(histogram)
    left = histogram.astype(np.int64).copy()
    made = []
    options = combinations(units, depth)
    a = np.zeros((units, len(options)))
    for j, bins in enumerate(options):
        for part in bins:
            a[part - 1, j] += 1
    repeats = np.floor(nonnegative_least_squares(a, histogram.astype(float)) + 1e-6).astype(np.int64)
    for j in np.argsort(-repeats, kind="stable"):
        need = a[:, j].astype(np.int64)
        times = int(min(repeats[j], *(left[need > 0] // need[need > 0])))
        if times > 0:
            left -= times * need
            made.append(({int(i) + 1: int(need[i]) for i in np.flatnonzero(need)}, times))
    while left.any():
        room, pattern = units, {}
        spare = left.copy()
        while room:
            fit = np.flatnonzero(spare[:room])
            if not len(fit):
                break
            part = int(fit[-1]) + 1
            pattern[part] = pattern.get(part, 0) + 1
            spare[part - 1] -= 1
            room -= part
        times = min(int(left[p - 1]) // k for p, k in pattern.items())
        for p, k in pattern.items():
            left[p - 1] -= times * k
        made.append((pattern, times))
    return made


def _plan_rows(made: list[tuple[dict[int, int], int]]) -> list[tuple]:
    """(bin, low, high, first sequence, pieces per sequence, first place): ranks low..high-1 of a bin."""
    ranks: dict[int, int] = {}
    sequence, rows = 0, []
    for pattern, times in made:
        place = 0
        for part in sorted(pattern, reverse=True):
            low = ranks.get(part, 0)
            ranks[part] = low + pattern[part] * times
            rows.append((part, low, ranks[part], sequence, pattern[part], place))
            place += pattern[part]
        sequence += times
    return rows


def packed(pieces: DataFrame, window: int = WINDOW, grain: int = GRAIN, depth: int = DEPTH) -> DataFrame:
    """Adds sequence_id and offset to rows that have a ``length`` of 1 to ``window`` tokens.

    Pieces of a sequence stand at offsets without gaps from 0; sequences are numbered from 0.
    Equal pieces are packed each. No rows give no rows. ``pieces`` must be a stored table, as it
    is read twice.
    """
    spark = pieces.sparkSession
    units = window // grain
    chunks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    binned = pieces.withColumns(
        {"bin": F.ceil(F.col("length") / grain).cast("int"), "chunk": F.pmod(F.xxhash64("doc_id", "start"), F.lit(chunks)).cast("int")}
    )
    counts = write_scratch(binned.groupBy("bin", "chunk").agg(F.count("*").alias("n")), "piece-counts")
    histogram = np.zeros(units, dtype=np.int64)
    for row in counts.groupBy("bin").agg(F.sum("n").alias("n")).collect():  # a row for each bin
        histogram[row["bin"] - 1] = row["n"]
    rows = _plan_rows(plan(histogram, depth))
    table = spark.createDataFrame(rows, "bin int, low long, high long, first long, per long, place long")
    earlier = Window.partitionBy("bin").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("bin", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("bin", "chunk").orderBy("doc_id", "start", "ids_crc32")
    ranked = binned.withColumn("at", F.row_number().over(within).cast("long") - 1).join(bases, ["bin", "chunk"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("at")).drop("base", "at", "chunk")
    # The plan has a few rows for each of the units + 1 bins, whatever the input.
    placed = ranked.join(F.broadcast(table), "bin").where((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    nth = F.col("rank") - F.col("low")
    placed = placed.withColumns(
        {"sequence_id": F.col("first") + F.floor(nth / F.col("per")).cast("long"), "place": F.col("place") + nth % F.col("per")}
    )
    so_far = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(so_far), F.lit(0)).cast("long")).select(
        *pieces.columns, "sequence_id", "offset"
    )


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: PIECES, sequence_id, offset. Other columns of ``docs`` are ignored.

    A null or empty text is its end id alone. Null, equal and repeated doc_ids are documents of their own,
    and their pieces carry the id they have. A very long text is encoded by one task and cut into pieces like
    any other. An empty table gives no rows.
    """
    return packed(write_scratch(pieces_of(docs, tokenizer, window, end_id), "pieces"), window)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: pack all documents into sequences of at most 1024 tokens."""
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
