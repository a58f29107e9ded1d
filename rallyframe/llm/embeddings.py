"""Near-duplicate embeddings by PCA-ordered, tiled comparison.

Vectors of a label are scaled to length one in double precision, rotated to the principal axes of
a bounded sample and sorted by their first coordinate into tiles. Two tiles are compared only if
the bounds of their leading coordinates leave room for a cosine at the threshold. In a tile pair,
products over the leading dimensions come first; by Cauchy and Schwarz the rest of a product is
at most the product of the two suffix norms, and pairs whose bound falls short stop there. What is
left gets the exact cosine of the unrotated vectors. Any rotation gives the same result; a good one
stops earlier.

Rows that repeat a vector are one member with a count. Neighbouring tiles form blocks, and a pair of
blocks is a task's unit of work, which gets each of its tiles once, whatever many pairs they are in; a
label of any size is many blocks, dealt over all tasks. The tiles' outlines meet by label and a salt,
so that one label's pairs are found in many tasks. All links of a block pair are looked at where they
are found, but leave it as one row for each vector that has any: how many rows it is linked to, and
the least vector of its component within the pair of tiles. That is all that counts and components
need, and it doesn't grow with the square of a group. Vectors of floats stay floats until their
cosines are worked out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rallyframe.llm.components import components
from rallyframe.llm.scratch import write_scratch

THRESHOLD = 0.93
#: Rows of the sample that the axes are fitted on.
SAMPLE = 5000
TILE = 512
#: Tiles of a block, and parts that a label's outlines are dealt into.
BLOCK, SALTS = 8, 16
#: Dimensions after which products are bounded, in order.
STOPS = (8, 24)
#: Tiles are told apart by the ranges of so many leading coordinates.
LEADING = 4
#: Allowance for rounding, far below what separates cosines of interest.
SLACK = 1e-9


def axes(vectors: np.ndarray) -> np.ndarray:
    """Principal axes as columns, the one with most variance first."""
    if not len(vectors):
        return np.eye(vectors.shape[1])
    _, turned = np.linalg.eigh(vectors.T @ vectors)
    return turned[:, ::-1]


def vector_of(rows: DataFrame) -> Column:
    """A row's vector, as floats if it is stored so and else as doubles."""
    kind = rows.schema["embedding"].dataType.elementType.simpleString()
    return F.col("embedding") if kind == "float" else F.col("embedding").cast("array<double>")


def members(rows: DataFrame) -> DataFrame:
    """label, vector, vec_id (the least), copies: distinct usable vectors of each label.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without a
    label or a vec_id, are left out.
    """
    v = vector_of(rows)
    big = F.aggregate(v, F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x.cast("double"))))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.col("vec_id").isNotNull()).where(fine & (big > 0))
    # 0.0 and -0.0 compare alike in grouping.
    return usable.groupBy("label", v.alias("vector")).agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))


def numbers(found: DataFrame) -> str:
    """How components are stored: in four bytes if they are floats, else in eight."""
    return "<f4" if found.schema["vector"].dataType.elementType.simpleString() == "float" else "<f8"


def tiles(found: DataFrame, turned: dict[int, np.ndarray], size: int = TILE) -> DataFrame:
    """label, dim, tile, block, low, high, ids, copies, vectors: a row for each tile.

    A label's vectors are sorted by leading coordinate in range-partitioned tasks, so a tile never
    holds more than ``size`` rows and a label may span any number of tasks.
    """
    schema = "label long, dim int, tile string, block string, low array<double>, high array<double>, ids array<long>, copies array<long>, vectors binary"
    kind = found.schema["vector"].dataType.simpleString()
    width = np.dtype(numbers(found))

    def lead(batches):
        for batch in batches:
            vectors = batch.column(1).to_pylist()
            first = [float(_unit(np.array(v, dtype=float)) @ turned[len(v)][:, 0]) for v in vectors]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first)], names=["label", "vector", "vec_id", "copies", "lead"])

    keyed = found.select(F.col("label").cast("long").alias("label"), "vector", "vec_id", "copies").mapInArrow(
        lead, f"label long, vector {kind}, vec_id long, copies long, lead double"
    )
    keyed = write_scratch(keyed.withColumn("dim", F.size("vector")), "led")
    order = ["label", "dim", "lead", "vec_id"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches):
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0

        def row(key, ids, copies, vectors):
            x = np.array(vectors, dtype=float)
            y = _units(x) @ turned[key[1]][:, :LEADING]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([key[0]], pa.int64()),
                    pa.array([key[1]], pa.int32()),
                    pa.array([f"{part}.{n}"]),
                    pa.array([f"{part}.{n // BLOCK}"]),
                    pa.array([y.min(axis=0).tolist()]),
                    pa.array([y.max(axis=0).tolist()]),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([copies], pa.list_(pa.int64())),
                    pa.array([x.astype(width).tobytes()], pa.binary()),
                ],
                names=["label", "dim", "tile", "block", "low", "high", "ids", "copies", "vectors"],
            )

        key, ids, copies, vectors = None, [], [], []
        for batch in batches:
            for label, dim, vec_id, number, vector in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if ids and ((label, dim) != key or len(ids) == size):
                    yield row(key, ids, copies, vectors)
                    n, ids, copies, vectors = n + 1, [], [], []
                key = (label, dim)
                ids.append(vec_id)
                copies.append(number)
                vectors.append(vector)
        if ids:
            yield row(key, ids, copies, vectors)

    return ranged.select("label", "dim", "vec_id", "copies", "vector").mapInArrow(cut, schema)


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max()
    return v / np.sqrt(v @ v)


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def close_pairs(x: np.ndarray, y: np.ndarray, turned: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Rows i of x and j of y whose cosine is ``threshold`` or more."""
    u, w = _units(x), _units(y)
    p, q = u @ turned, w @ turned
    done = min(STOPS[0], p.shape[1])
    part = p[:, :done] @ q[:, :done].T
    rest = np.outer(np.sqrt((p[:, done:] ** 2).sum(axis=1)), np.sqrt((q[:, done:] ** 2).sum(axis=1)))
    i, j = np.nonzero(part + rest >= threshold - SLACK)
    value = part[i, j]
    for stop in STOPS[1:]:
        if stop >= p.shape[1] or not len(i):
            break
        value = value + np.einsum("nd,nd->n", p[i, done:stop], q[j, done:stop])
        done = stop
        suffix = np.sqrt((p[:, done:] ** 2).sum(axis=1))[i] * np.sqrt((q[:, done:] ** 2).sum(axis=1))[j]
        on = value + suffix >= threshold - SLACK
        i, j, value = i[on], j[on], value[on]
    exact = np.einsum("nd,nd->n", x[i], y[j]) / np.sqrt((x * x).sum(axis=1)[i] * (y * y).sum(axis=1)[j])
    bad = ~np.isfinite(exact)  # squares beyond the range of doubles
    exact[bad] = np.einsum("nd,nd->n", u[i[bad]], w[j[bad]])
    on = exact >= threshold
    return i[on], j[on]


def summed_up(ids: np.ndarray, copies: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of ``ids`` that a link (positions a, b) touches: it, its least connected id, linked copies."""
    linked = np.bincount(a, weights=copies[b], minlength=len(ids)) + np.bincount(b, weights=copies[a], minlength=len(ids))
    least = ids.copy()
    while True:
        low = np.minimum(least[a], least[b])
        after = least.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        if (after == least).all():
            break
        least = after
    some = np.flatnonzero(linked)
    return ids[some], least[some], linked[some].astype(np.int64)


def near_vectors(found: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """node, leader, n: links of members of one label with a cosine of ``threshold`` or more.

    A row for each member and tile pair in which it has links: the rows it is linked to there, and
    the least vec_id it is connected with there.
    """
    spark = found.sparkSession
    picked = found.select("vector", F.size("vector").alias("dim")).orderBy(F.xxhash64("vector")).limit(SAMPLE).collect()
    by_dim: dict[int, list] = {r["dim"]: [] for r in found.select(F.size("vector").alias("dim")).distinct().collect()}
    for r in picked:
        by_dim[r["dim"]].append(r["vector"])
    turned = {d: axes(_units(np.array(v, dtype=float))) if v else np.eye(d) for d, v in by_dim.items()}
    cut = write_scratch(tiles(found, turned), "tiles")
    width = numbers(found)
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
    salted = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    a = cut.select("label", "dim", salted.alias("salt"), F.col("tile").alias("t"), F.col("block").alias("p"), F.col("low").alias("al"), F.col("high").alias("ah"))
    b = cut.select(
        "label", "dim", F.pmod(F.hash("tile"), F.lit(SALTS)).alias("salt"), F.col("tile").alias("s"), F.col("block").alias("q"), F.col("low").alias("bl"), F.col("high").alias("bh")
    )
    # Squared gap of the two boxes; vectors of cosine c lie sqrt(2 - 2c) apart.
    gap = F.aggregate(
        F.sequence(F.lit(0), F.size("al") - 1),
        F.lit(0.0),
        lambda s, k: s + F.pow(F.greatest(F.get("al", k) - F.get("bh", k), F.get("bl", k) - F.get("ah", k), F.lit(0.0)), F.lit(2.0)),
    )
    # A pair of tiles of different blocks is taken in the order of these.
    once = F.when(F.col("p") == F.col("q"), F.col("t") <= F.col("s")).otherwise(F.col("p") < F.col("q"))
    pairs = a.join(b, ["label", "dim", "salt"]).where(once & (gap <= reach * reach)).select("p", "q", "t", "s")
    pairs = write_scratch(pairs, "tile-pairs")
    wanted = pairs.select(F.col("p").alias("one"), F.col("q").alias("two"), F.explode(F.array("t", "s")).alias("tile")).distinct()
    work = wanted.join(cut.select("tile", "dim", "ids", "copies", "vectors"), "tile")

    def compare(which: pa.Table, given: pa.Table) -> pa.Table:
        held = {r["tile"]: r for r in given.to_pylist()}
        out = [[np.zeros(0, np.int64)] * 3]
        for t, s in zip(which["t"].to_pylist(), which["s"].to_pylist()):
            one, two = held[t], held[s]
            x, y = (np.frombuffer(r["vectors"], dtype=width).reshape(-1, r["dim"]).astype(float) for r in (one, two))
            i, j = close_pairs(x, y, turned[one["dim"]], threshold)
            if t == s:
                i, j = i[i < j], j[i < j]
                ids, copies = np.array(one["ids"]), np.array(one["copies"])
            else:
                j = j + len(one["ids"])
                ids, copies = np.array(one["ids"] + two["ids"]), np.array(one["copies"] + two["copies"])
            out.append(summed_up(ids, copies, i, j))
        return pa.table([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], names=["node", "leader", "n"])

    return pairs.groupBy("p", "q").cogroup(work.groupBy("one", "two")).applyInArrow(compare, "node long, leader long, n long")


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of (vec_id, embedding, label).

    n_links counts the other vectors linked directly, repeats included; component_id is the least
    vec_id reachable, a row's own without links. Unusable vectors (see ``members``) link with
    nothing. A row without a vec_id has no links, component_id null and kept false. vec_id is meant
    as a key: where different vectors share one, each row is still returned, and these vectors'
    links may be counted together. Other columns are ignored. An empty table gives no rows.
    """
    found = write_scratch(members(rows), "members")
    links = write_scratch(near_vectors(found, threshold), "vector-links")
    linked = links.groupBy(F.col("node").alias("first")).agg(F.sum("n").alias("linked"))
    stars = components(links.select(F.col("node").alias("a"), F.col("leader").alias("b"))).withColumnRenamed("node", "first")
    classes = (
        found.withColumnRenamed("vec_id", "first")
        .join(linked, "first", "left")
        .join(stars, "first", "left")
        .select(
            "label",
            "vector",
            (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
            F.coalesce("component", "first").alias("component_id"),
        )
    )
    own = rows.select("vec_id", "label", vector_of(rows).alias("vector"))
    out = own.join(classes, ["label", "vector"], "left")
    named = F.col("vec_id").isNotNull()
    component = F.when(named, F.coalesce("component_id", "vec_id"))
    links_of = F.when(named, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long")
    return out.select(
        "vec_id", links_of.alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: links and components of every embedding."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
