"""Conversation repair against a brute-force DP, over partitions, and its odd inputs."""

import functools
import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest

from meridian.llm import conversation_repair as R
from meridian.plans.iterate import cut

BLANK = re.compile(r"[\x20\x09-\x0D]+\Z")
ROWS = "conv_id long, turn long, role string, text string, conv long, n int, audit string"


def conversations(seed, convs=60, long=0):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        roles = rng.choice([["user", "assistant"], ["system", "user", "assistant"], ["user", "user", "assistant", "tool", "System", ""]])
        size = long if c == 7 and long else rng.choice([1, 2, 3, 6, 12, 40])
        for t in range(size):
            role = rng.choice(roles) if rng.random() < 0.4 else roles[t % len(roles)]
            text = rng.choice(["Hi.", "what", "Why? ", " \n", "", "end!", f"n {rng.random()}.", "same text", "\x85", ". x"])
            rows.append((c, t if rng.random() < 0.95 else rng.choice([t + 100, t + 1, None]), role, text))
    rows += [(None, 1, "user", "a."), (None, None, "assistant", "b."), (None, 1, "user", "a."), (70, 2, None, None), (70, 3, "user", None),
             (71, None, None, "x."), rows[5], rows[5], (72, 1, "user", "long " * 40_000 + ".")]
    rows += [(c, t, "user", "x.") for c in range(200, 230) for t in range(1) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]   # lost whole
    rng.shuffle(rows)
    return rows


def brute(rows):
    by = {}
    for conv, turn, role, text in rows:
        own = by.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in own:
            said = BLANK.sub("", text)
            faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[0] for r in own if r[0] is not None]
        first = [r[1][:1] for r in own]

        @functools.cache
        def best(i, state, inserts, own=own, faults=faults):
            """Cost and audit of what follows; state: the last initial, or '' for nothing."""
            free = "a" if state == "u" else "u"
            found = [(0, "")] if i == len(own) and state in ("", "a") else []
            if inserts:
                found.append(after(3, "I", i, free, inserts - 1))
            if i < len(own):
                initial, extra = own[i][1][:1], 3 if faults[i] else 0
                found.append(after(4, "D", i + 1, state, 3))
                if faults[i] not in ("blank", "duplicate"):
                    if initial == free or (initial == "s" and state == ""):
                        found.append(after(extra, "K", i + 1, initial, 3))
                    found.append(after(3 + extra, "R", i + 1, free, 3))
            return min(found) if found else (1 << 60, "")

        def after(cost, edit, *rest, best=best):
            more, audit = best(*rest)
            return cost + more, edit + audit

        for i in range(len(own), -1, -1):
            for inserts in range(4):
                for state in ("a", "u", "s", ""):
                    best(i, state, inserts)
        cost, audit = best(0, "", 3)
        lines, at, last = [], 0, ""
        for e in audit:
            role = "assistant" if last == "u" else "user"
            if e == "I":
                lines.append(role + ":")
                last = role[0]
                continue
            if e == "K":
                lines.append(own[at][1] + ":" + own[at][2])
                last = own[at][1][0]
            elif e == "R":
                lines.append(role + ":" + own[at][2])
                last = role[0]
            at += 1
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost if own else 0, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def table(spark, rows, parts):
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], ROWS)
    return cut(df.repartition(parts))


COLUMNS = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize(("seed", "long", "partitions"), [(1, 0, 4), (2, 900, 23)])
def test_against_brute_force(spark, seed, long, partitions):
    rows = conversations(seed, long=long)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [tuple(r) for r in R.repair(R.damage(table(spark, rows, 3))).select(*COLUMNS).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(got, key=str) == brute(rows)


def test_empty(spark):
    assert R.repair(R.damage(spark.createDataFrame([], ROWS))).count() == 0


def test_runs_equal_single_rows():
    rng = random.Random(5)
    for _ in range(300):
        symbols = bytes(s for _ in range(rng.randint(0, 6)) for s in [rng.randrange(12)] * rng.randint(1, 40))
        v = R.with_insertions(R.END)
        for s in reversed(symbols):
            v = R._back(s, 1, v)[1]
        whole = R.costs_to_go(R.runs_of(symbols), R.with_insertions(R.END))
        assert whole[2] == v
        cost, audit = R.edits(symbols)
        assert cost == sum({"K": 0, "R": 3, "D": 4, "I": 3}[e] for e in audit) + 3 * sum(
            s % 3 == R.CUT_OFF and e != "D" for s, e in zip(symbols, audit.replace("I", ""), strict=True))


def test_long_conversation_is_cut(monkeypatch):
    monkeypatch.setattr(R, "PART_ROWS", 10)
    n = 64
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0] * n), pa.array([1] * 3 + [2] * 40 + [3] * 20 + [4]), pa.array(range(n)), pa.array(["user"] * n), pa.array([b"%d" % i for i in range(n)]),
         pa.array(["u"] * n), pa.array([3] * n), pa.array([1] * n)], names=["part", "conv", "turn", "role", "digest", "initial", "fault", "n"])
    got = pa.Table.from_batches(list(R._parts(iter([batch])))).to_pylist()
    assert [(p["conv"], p["place"], len(p["symbols"]), p["whole"]) for p in got] == [
        (1, 0, 3, False), (2, 0, 10, False), (2, 1, 10, False), (2, 2, 10, False), (2, 3, 10, False), (3, 0, 10, False), (3, 1, 10, False),
        (4, 0, 1, False)]
    assert len(R.runs_of(bytes([3]) * 10_000)) == 3
