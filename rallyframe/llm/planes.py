"""A token-id file format: bit planes of fixed-size blocks, each compressed with zstandard.

Documents are put in ascending order of doc_id by a range shuffle; each task encodes its range and
writes segments, a segment being whole documents of about ``SEGMENT`` ids. Segments are rows of a
Parquet table, so Spark's commit protocol and every file system it knows apply; ``payload`` holds
the format:

    magic "RFP1", ids (u32), ids per block (u32), blocks (u32)
    chunk index: for each block its planes (u32) and the compressed bytes of each plane (u32)
    the compressed planes, in the index's order

Plane k of a block has bit k of each of its ids, eight to a byte, first id lowest. Planes above
the highest bit set are not stored. Numbers are little-endian.

Beside the payload stand the segment's doc_ids and lengths and the ids before it in its part (one
part per task, numbered in order). The parts' totals, one row per task, give each part's base, so
that any document can be found without reading what stands before it.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rallyframe.llm.scratch import scratch_path
from rallyframe.llm.words import slices, worker_codec

BLOCK = 1 << 15
SEGMENT = 1 << 17
END_ID = 2
LEVEL = 3
MAGIC = b"RFP1"
SEGMENTS = "part int, segment int, before long, doc_ids array<long>, lengths array<long>, payload binary"


def pack_ids(ids: np.ndarray, block: int = BLOCK, level: int = LEVEL) -> bytes:
    """The format's bytes for an array of unsigned 32-bit ids."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=level).compress
    index, data = [], []
    for at in range(0, len(ids), block):
        part = ids[at : at + block].astype("<u4")
        n_planes = int(part.max()).bit_length()
        width = 1 if n_planes <= 8 else 2 if n_planes <= 16 else 4
        bits = np.unpackbits(part.astype(f"<u{width}").view(np.uint8).reshape(-1, width), axis=1, bitorder="little")
        planes = np.packbits(np.ascontiguousarray(bits.T[:n_planes]), axis=1, bitorder="little")
        chunks = [squeeze(p.tobytes()) for p in planes]
        index += [n_planes, *map(len, chunks)]
        data += chunks
    head = np.array([len(ids), block, -(-len(ids) // block), *index], dtype="<u4")
    return MAGIC + head.tobytes() + b"".join(data)


def unpack_ids(payload: bytes) -> np.ndarray:
    """The ids of ``pack_ids``' bytes."""
    import zstandard

    if payload[:4] != MAGIC:
        raise ValueError("not a bit-plane payload")
    widen = zstandard.ZstdDecompressor().decompress
    total, block, blocks = (int(x) for x in np.frombuffer(payload, dtype="<u4", count=3, offset=4))
    at, index = 16, []
    for _ in range(blocks):
        n_planes = int(np.frombuffer(payload, dtype="<u4", count=1, offset=at)[0])
        index.append(np.frombuffer(payload, dtype="<u4", count=n_planes, offset=at + 4))
        at += 4 + 4 * n_planes
    out = np.zeros(total, dtype=np.uint32)
    for b, sizes in enumerate(index):
        n = min(block, total - b * block)
        width = 1 if len(sizes) <= 8 else 2 if len(sizes) <= 16 else 4
        bits = np.zeros((8 * width, n), dtype=np.uint8)
        for k, size in enumerate(sizes):
            plane = np.frombuffer(widen(payload[at : at + int(size)], max_output_size=-(-n // 8)), dtype=np.uint8)
            bits[k] = np.unpackbits(plane, count=n, bitorder="little")
            at += int(size)
        out[b * block : b * block + n] = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(f"<u{width}").ravel()
    return out


def segments(docs: DataFrame, tokenizer: str, end_id: int = END_ID, segment: int = SEGMENT) -> DataFrame:
    """Rows of SEGMENTS for (doc_id, text), in ascending order of doc_id, nulls first.

    A null text counts as empty and has the end id alone. Repeated rows are written each.
    """

    def encoded(batches):
        codec = worker_codec(tokenizer, False)
        part, number, before = TaskContext.get().partitionId(), 0, 0
        names, sizes, kept, held = [], [], [], 0

        def row():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([before], pa.int64()),
                    pa.array([names], pa.list_(pa.int64())),
                    pa.array([sizes], pa.list_(pa.int64())),
                    pa.array([pack_ids(np.concatenate(kept))], pa.binary()),
                ],
                names=["part", "segment", "before", "doc_ids", "lengths", "payload"],
            )

        for batch in batches:
            for piece in slices(batch, 1):
                ids, ends = codec.encode(piece.column(1))
                for doc_id, a, b in zip(piece.column(0).to_pylist(), ends[:-1], ends[1:]):
                    names.append(doc_id)
                    sizes.append(int(b - a) + 1)
                    kept += [ids[a:b], np.array([end_id], dtype=np.uint32)]
                    held += int(b - a) + 1
                    if held >= segment:
                        yield row()
                        number, before = number + 1, before + held
                        names, sizes, kept, held = [], [], [], 0
        if names:
            yield row()

    ordered = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    return ordered.mapInArrow(encoded, SEGMENTS)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode ``docs`` and write them to ``path`` in the format above.

    A null or empty text is its end id alone. Null doc_ids come first; equal ones stand next to each other in any
    order. A very long text is encoded by one task and is a segment of its own. An empty table has no segments,
    and reading it back gives no rows. Other columns are ignored.
    """
    segments(docs, tokenizer, end_id).write.parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """part, base: the ids of all documents before each part. One row per writing task."""
    stored = spark.read.schema(SEGMENTS).parquet(path)
    totals = stored.groupBy("part").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of each document in the files at ``path``."""
    kinds = "doc_id long, part int, at long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def decoded(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack_ids(row["payload"]).astype("<u4")
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                cols = [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(np.full(len(ends), row["part"], dtype=np.int32)),
                    pa.array(starts + row["before"], pa.int64()),
                    pa.array(row["lengths"], pa.int64()),
                    pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)], pa.int64()),
                ]
                if with_ids:
                    cols.append(pa.array([ids[a:b].tolist() for a, b in zip(starts, ends)], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in kinds.split(", ")])

    docs = spark.read.schema(SEGMENTS).parquet(path).select("part", "before", "doc_ids", "lengths", "payload").mapInArrow(decoded, kinds)
    based = docs.join(F.broadcast(read_index(spark, path)), "part")
    return based.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: write every document's ids and read them back."""
    import public_tokenizers

    path = scratch_path(spark, "token-ids")
    write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_ids(spark, path)
