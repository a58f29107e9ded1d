"""Conversation repair against an exhaustive search, whole results against plain Python, and odd inputs."""

import hashlib
import itertools
import random
import re
import zlib

from pyspark.sql import functions as F

from rallyframe.llm import conversations as C

ROWS = "conv_id long, turn long, role string, text string, cost long, audit string"


def exhaustive(symbols):
    """Least cost and ASCII-least audit over all edits with at most two inserts in a gap."""
    best = None
    edits = [["D"] if s == "-" else ["D", "K", "R"] for s in symbols]
    for choice in itertools.product(*edits):
        for inserts in itertools.product(range(3), repeat=len(symbols) + 1):
            audit, roles, cost = "", [""], 0
            for i in range(len(symbols) + 1):
                audit += "I" * inserts[i]
                cost += 3 * inserts[i]
                roles = [r + "".join(x) for r in roles for x in itertools.product("ua", repeat=inserts[i])]
                if i < len(symbols):
                    e, s = choice[i], symbols[i]
                    audit += e
                    cost += {"D": 4, "K": 0, "R": 3}[e] + (3 if e != "D" and s.isupper() else 0)
                    roles = [r + x for r in roles for x in {"D": [""], "K": [s.lower()], "R": ["u", "a"]}[e]]
            if any(re.fullmatch("(s?(ua)+)?", r) for r in roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def test_walk_is_the_cheapest_and_least():
    rnd = random.Random(5)
    signatures = sorted({"".join(rnd.choice("suaxSUAX-") for _ in range(rnd.randint(0, 4))) for _ in range(70)})
    got = list(C.walk(iter(signatures)))
    assert [g[0] for g in got] == signatures
    for signature, cost, audit in got:
        assert (cost, audit) == exhaustive(signature), signature


def test_shared_prefixes_are_computed_once(monkeypatch):
    made = []
    plain = C.step
    monkeypatch.setattr(C, "step", lambda layer, symbol: made.append(symbol) or plain(layer, symbol))
    list(C.walk(iter(["uaua", "uauaua", "uauaus", "uauaus"])))
    assert len(made) == 7


def plain(rows):
    """The contract, conversation by conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        said = lambda x: " " if x is None else str(x)
        live = []
        for c, turn, role, text in (r for r in rows if r[0] == conv):
            kind = zlib.crc32(f"{said(c)}:{said(turn)}".encode()) % 20
            role, text = "user" if kind == 4 else said(role), said(text)
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            live += [(turn is not None, turn or 0, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        live.sort()
        turns = {t for known, t, _, _ in live if known}
        faults, seen = [], set()
        for _, _, role, text in live:
            bare = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[2][:1] for r in live]
        symbols = ["-" if f in ("blank", "duplicate") else i.upper() if f else i for i, f in zip((i if i in ("s", "u", "a") else "x" for i in initials), faults)]
        cost, audit = list(C.walk(iter(["".join(symbols)])))[0][1:]
        lines = C.apply_audit([{"role": r[2], "text": r[3]} for r in live], audit)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest(),
        )
    return out


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, 9, "x") for r in rows], ROWS)


def collected(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_whole_results_on_odd_conversations(spark):
    rnd = random.Random(8)
    texts = ["Yes.", "No", " ", "", None, "Why?\n", "Well! \t", "é…", "A. B? C"]
    roles = ["user", "assistant", "system", "tool", None, "", "usher"]
    rows = [(rnd.choice([*range(60), None]), rnd.choice([*range(9), None]), rnd.choice(roles[: rnd.choice([2, 7])]), rnd.choice(texts)) for _ in range(900)]
    rows += rows[:40]  # repeated rows
    rows += [(77, t, "user" if t % 2 == 0 else "assistant", "word " * 20000 + ".") for t in range(4)]
    rows += [(88, t, "user", f"line {t}.") for t in range(3000)]  # a long conversation
    got = collected(C.repaired(rows_of(spark, rows)))
    want = plain(rows)
    assert got == want


def test_repaired_audits_are_legal(spark):
    rows = [(c, t, "assistant", f"{c} {t}") for c in range(20) for t in range(c % 5)]
    for line in C.repaired(rows_of(spark, rows)).collect():
        assert set(line.audit) <= set("DIKR")


def test_dropped_whole_and_empty(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = collected(C.repaired(rows_of(spark, [(gone, 0, "user", "Hi.")])))
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert C.repaired(rows_of(spark, [])).count() == 0


def test_chosen_damage(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Bye")]
    got = collected(C.repaired(rows_of(spark, rows), F.lit(9)))
    assert got[1][5:7] == (4, "KKD")
