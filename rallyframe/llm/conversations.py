"""Repair of conversation structure: cheapest edits by a dynamic program over a trie of signatures.

What a repair costs depends only on a conversation's signature: one character a row, its role's
initial and its first fault. Distinct signatures are few beside conversations, and sorted ones share
prefixes. They are range partitioned and sorted, and each task walks its part of the prefix trie
depth first: the layers of the dynamic program along the current path are a stack, a prefix that
several signatures share is computed once, and each terminal node emits its signature's answer, which
an equality join carries back to the conversations.

Repaired conversations hash as one text, so a conversation's rows meet in one task; that much the
result itself asks for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States of ``(s?(ua)+)?``: nothing yet, after s, after u, after a. MOVES[state][role] is the next state.
MOVES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
TURNS = ("user", "assistant")
#: Parts of the signature table; a range of signatures is one task's subtree.
PARTS = 64


def damaged(rows: DataFrame, key: Column | None = None) -> DataFrame:
    """conv_id, turn, role, text, copy, live of the rows after damage; nulls in role and text are one space.

    The CRC-32 of ``conv_id:turn`` (nulls: one space) modulo 20 decides: 0 drops the row (it stays here
    with live false, so that its conversation is known), 1 empties its text, 2 removes its stops,
    3 repeats it (copy 1), 4 makes its role user.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", said("conv_id"), said("turn")).cast("binary")) % 20 if key is None else key
    rows = rows.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"), (F.col("kind") != 0).alias("live"))


def conversations(rows: DataFrame) -> DataFrame:
    """One row per conv_id (null is one too): rows, gaps, blank, duplicate, truncated, illegal, signature.

    ``rows`` is what ``damaged`` returns. They stand by turn, nulls first; ties by role, text and copy.
    ``rows`` here is the array of (role, text) in that order. Everything but the first exchange
    uses the partitioning by conv_id.
    """
    order = ["turn", "role", "text", "copy", "nth"]
    seen = Window.partitionBy("conv_id", "live", "role", "text").orderBy("turn", "copy")
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACES)), -1, 1)
    fault = (
        F.when(last == "", F.lit("b"))
        .when(F.col("nth") > 1, F.lit("d"))
        .when(~last.isin(".", "!", "?"), F.lit("t"))
        .otherwise(F.lit("k"))
    )
    initial = F.substring("role", 1, 1)
    rows = rows.repartition("conv_id").withColumn("nth", F.row_number().over(seen)).withColumn("fault", fault).withColumn("initial", initial)
    entry = F.struct(*order, "fault", "initial")
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.when(F.col("live"), entry))).alias("r"))
    turns = F.filter(F.transform("r", lambda x: x["turn"]), lambda t: t.isNotNull())
    many = lambda f: F.size(F.filter("r", lambda x: x["fault"] == f)).cast("long")
    pair = lambda x, i: F.concat(x["initial"], F.get("r", i + 1)["initial"])
    illegal = F.filter(F.transform("r", pair), lambda p: p.isNotNull() & ~p.isin("su", "ua", "au"))

    def symbol(x: Column) -> Column:
        role = F.when(x["initial"].isin("s", "u", "a"), x["initial"]).otherwise(F.lit("x"))
        return F.when(x["fault"].isin("b", "d"), F.lit("-")).when(x["fault"] == "t", F.upper(role)).otherwise(role)

    return grouped.select(
        "conv_id",
        F.transform("r", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("rows"),
        F.coalesce(F.array_max(turns) - F.array_min(turns) + 1 - F.size(F.array_distinct(turns)), F.lit(0)).cast("long").alias("gaps"),
        many("b").alias("blank"),
        many("d").alias("duplicate"),
        many("t").alias("truncated"),
        F.size(illegal).cast("long").alias("illegal"),
        F.array_join(F.transform("r", symbol), "").alias("signature"),
    )


# A layer maps a state to (cost, rank, state before, chunk): the cheapest edits of the rows so far that end
# there. chunk is what they add to those of the state before, some I and then the row's own initial; rank
# orders the layer's whole audits. As each holds one initial per row beside I and ends with one, none
# is the beginning of another, so audits compare by rank first and by chunk among equal ranks.
Layer = dict[int, tuple[int, int, int, str]]
ROOT: Layer = {0: (0, 0, 0, "")}


def reached(layer: Layer) -> Iterator[tuple[int, int, int, int, str]]:
    """(state, cost, rank, state before, inserts) after any inserts that can pay; a cycle never does."""
    for start, (cost, rank, _, _) in layer.items():
        state, inserts = start, ""
        yield state, cost, rank, start, inserts
        for _ in range(2):
            state, inserts, cost = 3 if state == 2 else 2, inserts + "I", cost + INSERT
            yield state, cost, rank, start, inserts


def step(layer: Layer, symbol: str) -> Layer:
    """The layer after one more row of a signature."""
    best: dict[int, tuple[int, int, str, int]] = {}

    def offer(state: int, cost: int, rank: int, chunk: str, before: int) -> None:
        if state not in best or (cost, rank, chunk) < best[state][:3]:
            best[state] = (cost, rank, chunk, before)

    role, extra = symbol.lower(), TRUNCATED if symbol.isupper() else 0
    for state, cost, rank, before, inserts in reached(layer):
        offer(state, cost + DELETE, rank, inserts + "D", before)
        if symbol == "-":
            continue
        for to, into in MOVES[state].items():
            if to == role:
                offer(into, cost + KEEP + extra, rank, inserts + "K", before)
            if to != "s":
                offer(into, cost + REROLE + extra, rank, inserts + "R", before)
    ranked = sorted({(rank, chunk) for _, rank, chunk, _ in best.values()})
    return {state: (cost, ranked.index((rank, chunk)), before, chunk) for state, (cost, rank, chunk, before) in best.items()}


def finish(stack: list[Layer]) -> tuple[int, str]:
    """Cost and audit of the signature whose layers are on the stack."""
    ends = [(cost, rank, inserts, before) for state, cost, rank, before, inserts in reached(stack[-1]) if state in ENDS]
    cost, _, inserts, state = min(ends)
    chunks = [inserts]
    for layer in reversed(stack[1:]):
        _, _, before, chunk = layer[state]
        chunks.append(chunk)
        state = before
    return cost, "".join(reversed(chunks))


def shared_prefix(a: str, b: str) -> int:
    """Length of what two signatures have in common from the start."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


def walk(signatures: Iterator[str]) -> Iterator[tuple[str, int, str]]:
    """(signature, cost, audit) of sorted signatures, each shared prefix computed once."""
    path, stack = "", [ROOT]
    for signature in signatures:
        del stack[shared_prefix(path, signature) + 1 :]
        for symbol in signature[len(stack) - 1 :]:
            stack.append(step(stack[-1], symbol))
        path = signature
        yield signature, *finish(stack)


def answers(signatures: DataFrame) -> DataFrame:
    """signature, cost, audit for each distinct signature."""

    def subtree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, int, str]] = []
        for answer in walk(s for batch in batches for s in batch.column(0).to_pylist()):
            out.append(answer)
            if len(out) == 4096:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    def batch_of(rows: list[tuple[str, int, str]]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.string())
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, ["signature", "cost", "audit"])

    ranged = signatures.select("signature").distinct().repartitionByRange(PARTS, "signature").sortWithinPartitions("signature")
    return ranged.mapInArrow(subtree, "signature string, cost long, audit string")


def apply_audit(rows: list[dict], audit: str) -> list[tuple[str, str]]:
    """The repaired (role, text) that an audit makes of a conversation's rows."""
    out: list[tuple[str, str]] = []
    at, system = 0, 0
    for edit in audit:
        turn = TURNS[(len(out) - system) % 2]
        if edit == "I":
            out.append((turn, ""))
            continue
        row, at = rows[at], at + 1
        if edit == "K":
            system += row["role"][:1] == "s"
            out.append((row["role"], row["text"]))
        elif edit == "R":
            out.append((turn, row["text"]))
    return out


@F.pandas_udf(StringType())
def repaired_sha256(rows: pd.Series, audits: pd.Series) -> pd.Series:
    """SHA-256 of the repaired lines of each conversation."""
    digest = lambda r, a: hashlib.sha256("\n".join(f"{role}:{text}" for role, text in apply_audit(list(r), a)).encode()).hexdigest()
    return rows.combine(audits, digest)


def repaired(rows: DataFrame, key: Column | None = None) -> DataFrame:
    """One row per conv_id of ``rows`` (conv_id, turn, role, text), after damage and repair.

    gaps, blank, duplicate, truncated, illegal describe the damaged conversation; cost and audit are the
    cheapest edits to role initials ``(s?(ua)+)?``, ties to the ASCII-least audit; repaired_sha256 hashes the
    result. Null conv_ids are one conversation, null turns stand first and count for no gap, null
    roles and texts are one space. A conversation without rows after damage has zeros and an empty
    audit. Repeated rows are duplicates of each other. Empty tables give no rows, very long texts and
    conversations none but longer tasks; other columns are ignored. ``key`` decides the damage instead
    of the CRC-32.
    """
    made = conversations(damaged(rows, key))
    known = answers(made)
    joined = made.join(known, "signature", "left")
    return joined.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", repaired_sha256("rows", "audit").alias("repaired_sha256")
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op12: all conversations, damaged and repaired."""
    return repaired(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
