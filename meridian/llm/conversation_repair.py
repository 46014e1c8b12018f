"""Conversation repair: the cheapest edits that make roles alternate, by a run-length DP.

A repaired conversation's role initials have the form ``(s?(ua)+)?``.  Edits, each an
initial of the audit: Keep a row (0), Rerole it to user or assistant (3), Delete it (4;
the only choice for blank and duplicate rows), Insert an empty user or assistant row
anywhere (3); a truncated row that is not deleted adds 3.  Which role a reroled or
inserted row gets follows from the row before it, so the audit tells all.

*DP.*  A row is one of a few symbols (role initial and fault).  Its edits, with the
insertions before them, are a min-plus transition on the four states nothing, after a
system, after a user, after an assistant row.  Equal consecutive symbols are one run;
costs-to-go pass a run in one product per set bit of its length, with cached binary
powers of the symbol's transition.  Then the choices are unrolled forwards: at each
place the ASCII-least edit among the cheapest, which gives the ASCII-least audit, as
different edits begin with different letters.

*Long conversations.*  Rows are cut by range of (conversation, turn), so a conversation
that holds a third of all rows lies in many partitions.  Transitions are associative:
every part sends its product, a 4 x 4 table; these give each part its costs-to-go, then
every part unrolls for each state that it may begin in, and the states are followed from
part to part.  Texts take part only at the end: each conversation's rows are streamed
in order behind its audit, and the digest of the repaired text is updated row by row,
so no conversation is held in memory.

Nulls: a null role or text is one space (its initial is neither s, u nor a, it is
blank).  A null conversation id is a conversation of its own, null turns come first.
Rows of one turn are taken by role, then by the SHA-256 of their text; equal rows repeat
each other.  Conversations without rows keep a row of zeros.  An empty table gives no
rows; other columns play no part.
"""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import shuffle_partitions
from meridian.plans.iterate import cut

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Fixed values of the contract: blanks, and what ends a whole text.
BLANK, ENDS = " \t\n\x0b\x0c\r", ".!?"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a row with each initial, from each state; None is not allowed.
AFTER = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
#: The state after a row whose role can be chosen, and that role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 50
END = (0, FAR, FAR, 0)
FINE, CUT_OFF, GONE = range(3)
LEGAL = {"su", "ua", "au"}
#: Rows of one part of a conversation, and of a run that is unrolled at once.
PART_ROWS, RUN_ROWS = 1 << 17, 1 << 12
Vector = tuple[int, int, int, int]


def with_insertions(v: Vector) -> Vector:
    """Costs-to-go if rows may be inserted first (two are enough to reach any state)."""
    for _ in range(2):
        v = tuple(min(v[q], INSERT + v[NEXT[q]]) for q in range(4))
    return v


def choices(symbol: int, q: int):
    """Edits of a row in state q, ASCII-least first: letter, cost, state after, whether the row is used up."""
    initial, fault = "sua?"[symbol // 3], symbol % 3
    yield "D", DELETE, q, True
    yield "I", INSERT, NEXT[q], False
    if fault != GONE:
        extra = TRUNCATED if fault == CUT_OFF else 0
        after = AFTER.get(initial, (None,) * 4)[q]
        if after is not None:
            yield "K", KEEP + extra, after, True
        yield "R", REROLE + extra, NEXT[q], True


def symbol_of(initial: str, fault: int) -> int:
    return 3 * ("sua".find(initial) if initial and initial in "sua" else 3) + fault


@functools.cache
def power(symbol: int, k: int) -> tuple:
    """The min-plus transition of 2^k rows of a symbol, with the insertions before them."""
    if k:
        half = power(symbol, k - 1)
        return tuple(tuple(min(half[i][m] + half[m][j] for m in range(4)) for j in range(4)) for i in range(4))
    rows = [[FAR] * 4 for _ in range(4)]
    for q in range(4):
        for _, cost, after, used in choices(symbol, q):
            if used:
                rows[q][after] = min(rows[q][after], cost)
    columns = [with_insertions(tuple(rows[q][j] for q in range(4))) for j in range(4)]
    return tuple(tuple(min(FAR, columns[j][q]) for j in range(4)) for q in range(4))


def level(v: Vector) -> tuple[int, Vector]:
    """The least cost, and the costs above it."""
    low = min(v)
    return low, tuple(min(FAR, x - low) for x in v)


@functools.lru_cache(1 << 16)
def _back(symbol: int, length: int, v: Vector) -> tuple[int, Vector]:
    k = 0
    while length:
        if length & 1:
            m = power(symbol, k)
            v = tuple(min(m[q][j] + v[j] for j in range(4)) for q in range(4))
        length >>= 1
        k += 1
    return level(v)


def runs_of(symbols: bytes) -> list[tuple[int, int]]:
    """Equal consecutive symbols as (symbol, rows)."""
    out, i = [], 0
    while i < len(symbols):
        j = i + 1
        while j < len(symbols) and symbols[j] == symbols[i] and j - i < RUN_ROWS:
            j += 1
        out.append((symbols[i], j - i))
        i = j
    return out


def costs_to_go(runs: list[tuple[int, int]], end: Vector) -> tuple[list[Vector], int, Vector]:
    """The levelled costs behind each run, and those before the first (their least, and the rest)."""
    total, v = level(end)
    behind = []
    for symbol, length in reversed(runs):
        behind.append(v)
        low, v = _back(symbol, length, v)
        total += low
    return behind[::-1], total, v


@functools.lru_cache(1 << 16)
def unroll(symbol: int, length: int, end: Vector, q: int) -> tuple[str, int]:
    """Edits of a run that begins in state q, and the state behind it."""
    after = [end]                                       # costs-to-go behind each row, from the last
    for _ in range(length):
        after.append(_back(symbol, 1, after[-1])[1])
    out = []
    for place in range(length, 0, -1):
        here, (low, _) = after[place - 1], _back(symbol, 1, after[place - 1])
        used = False
        while not used:
            least = low + after[place][q]
            for letter, cost, then, used in choices(symbol, q):  # noqa: B007
                if cost + (here[then] if used else low + after[place][then]) == least:
                    break
            out.append(letter)
            q = then
    return "".join(out), q


def at_end(q: int) -> tuple[str, int]:
    """Insertions behind the last row."""
    out = ""
    while END[q]:
        out, q = out + "I", NEXT[q]
    return out, q


def edits(symbols: bytes) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    runs = runs_of(symbols)
    behind, total, first = costs_to_go(runs, with_insertions(END))
    q, audit = NOTHING, []
    for (symbol, length), end in zip(runs, behind, strict=True):
        piece, q = unroll(symbol, length, end, q)
        audit.append(piece)
    return total + first[NOTHING], "".join(audit) + at_end(q)[0]


# ---------------------------------------------------------------- rows and parts

PART = ("conv long, part long, place int, turns long, first_turn long, last_turn long, blank long, duplicate long, "
        "truncated long, illegal long, first string, last string, symbols binary, whole boolean")
PART_SCHEMA = pa.schema([("conv", pa.int64()), ("part", pa.int64()), ("place", pa.int32())] +
                        [(n, pa.int64()) for n in ("turns", "first_turn", "last_turn", "blank", "duplicate", "truncated", "illegal")] +
                        [("first", pa.string()), ("last", pa.string()), ("symbols", pa.binary()), ("whole", pa.bool_())])


@dataclass
class Part:
    """What is known of a run of rows of one conversation."""

    conv: int | None
    turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    faults: list[int] = field(default_factory=lambda: [0, 0, 0])
    illegal: int = 0
    first: str | None = None
    last: str | None = None
    symbols: bytearray = field(default_factory=bytearray)

    def add(self, turn, initial: str, fault: int, n: int) -> None:
        """n equal rows; from the second on they are duplicates, unless blank."""
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
        for i in range(n):
            kind = 1 if i and fault != 0 else fault          # 0 blank, 1 duplicate, 2 truncated, 3 none
            if kind < 3:
                self.faults[kind] += 1
            if self.last is None:
                self.first = initial
            elif self.last + initial not in LEGAL:
                self.illegal += 1
            self.last = initial
            self.symbols.append(symbol_of(initial, (GONE, GONE, CUT_OFF, FINE)[kind]))

    def row(self, part: int, place: int, whole: bool) -> tuple:
        return (self.conv, part, place, self.turns, self.first_turn, self.last_turn, *self.faults, self.illegal,
                self.first, self.last, bytes(self.symbols), whole)


def _parts(batches):
    """Sorted rows as parts of conversations.  A part that is neither the first nor the
    last of its partition, nor cut for its length, is a whole conversation."""
    now, number, place, cut_short, out, part_id = None, 0, 0, False, [], None
    before = None                                        # the row before, to see equal ones

    def flush(last: bool) -> None:
        whole = not (number == 0 or last or cut_short or place)
        out.append(now.row(part_id, place, whole))

    for b in batches:
        for part, conv, turn, role, digest, initial, fault, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
            part_id = part
            if now is None or conv != now.conv:
                if now is not None:
                    flush(False)
                    number, place, cut_short = number + 1, 0, False
                now, before = Part(conv), None
            elif len(now.symbols) >= PART_ROWS:
                cut_short = True
                flush(False)
                place += 1
                now = Part(conv)
            if n:
                again = (turn, role, digest) == before
                now.add(turn, initial, 1 if again and fault else fault, n)
                before = (turn, role, digest)
        if len(out) >= 1000:
            yield _part_batch(out)
            out.clear()
    if now is not None:
        flush(True)
        yield _part_batch(out)


def _part_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), PART_SCHEMA, strict=True)],
                                      schema=PART_SCHEMA)


def _whole(batches):
    """Cost and audit of whole conversations."""
    for b in batches:
        found = [edits(s) for s in b.column("symbols").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("key"), pa.array([x[0] for x in found], pa.int64()),
                                          pa.array([x[1] for x in found], pa.string())], names=["key", "cost", "audit"])


def _products(batches):
    """The transition of each part, as 16 costs."""
    for b in batches:
        rows = []
        for s in b.column("symbols").to_pylist():
            runs, columns = runs_of(s), []
            for j in range(4):
                _, total, v = costs_to_go(runs, tuple(0 if q == j else FAR for q in range(4)))
                columns.append([min(FAR, total + x) for x in v])
            rows.append([columns[j][q] for q in range(4) for j in range(4)])
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("key", "part", "place")), pa.array(rows, pa.list_(pa.int64()))],
                                         names=["key", "part", "place", "product"])


def _ends(pdf: pd.DataFrame) -> pd.DataFrame:
    """Costs behind each part of a conversation, and its whole cost."""
    pdf = pdf.sort_values(["part", "place"])
    v, out = with_insertions(END), []
    for m in reversed(pdf["product"].tolist()):
        out.append(list(level(v)[1]))
        v = tuple(min(int(m[4 * q + j]) + v[j] for j in range(4)) for q in range(4))
    return pdf[["key", "part", "place"]].assign(end=out[::-1], cost=v[NOTHING])


def _every_begin(batches):
    """A part's edits for each state that it may begin in."""
    for b in batches:
        audits, behind = [], []
        for s, end in zip(b.column("symbols").to_pylist(), b.column("end").to_pylist(), strict=True):
            runs = runs_of(s)
            ends, *_ = costs_to_go(runs, tuple(end))
            audits.append([])
            behind.append([])
            for begin in range(4):
                out, q = [], begin
                for (symbol, length), e in zip(runs, ends, strict=True):
                    piece, q = unroll(symbol, length, e, q)
                    out.append(piece)
                audits[-1].append("".join(out))
                behind[-1].append(q)
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("key", "part", "place", "cost")), pa.array(audits, pa.list_(pa.string())),
                                          pa.array(behind, pa.list_(pa.int32()))],
                                         names=["key", "part", "place", "cost", "audits", "behind"])


def _follow(pdf: pd.DataFrame) -> pd.DataFrame:
    """Which state each part of a conversation begins in, and what is inserted behind the last."""
    pdf = pdf.sort_values(["part", "place"])
    q, begin = NOTHING, []
    for behind in pdf["behind"]:
        begin.append(q)
        q = int(behind[q])
    return pdf[["key", "part", "place"]].assign(begin=begin, tail=[""] * (len(pdf) - 1) + [at_end(q)[0]])


def key_of(conv: str = "conv") -> Column:
    """The conversation's id as a text that is never null."""
    return F.coalesce(F.col(conv).cast("string"), F.lit("null")).alias("key")


def audits_of(rows: DataFrame) -> DataFrame:
    """conv, gaps, blank, duplicate, truncated, illegal, cost, audit of each conversation.

    ``rows``: conv, turn, role, digest (of the text), initial, fault (0 blank, 1 duplicate,
    2 truncated, 3 none) and n (equal rows; 0 marks a conversation only)."""
    order = [F.col("conv"), F.col("turn"), F.col("role"), F.col("digest")]
    parts = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                .select(F.spark_partition_id().cast("long").alias("part"), "conv", "turn", "role", "digest", "initial", "fault", "n")
                .mapInArrow(_parts, PART))
    alone = (parts.where("whole").select(key_of(), "symbols")
             .mapInArrow(_whole, "key string, cost long, audit string"))
    # Conversations of several parts: products and states meet, never symbols or texts.
    split = parts.where("not whole").select(key_of(), "part", "place", "symbols")
    ends = (split.mapInArrow(_products, "key string, part long, place int, product array<long>")
            .groupBy("key").applyInPandas(_ends, "key string, part long, place int, end array<long>, cost long"))
    begun = cut(split.join(ends, ["key", "part", "place"]).mapInArrow(
        _every_begin, "key string, part long, place int, cost long, audits array<string>, behind array<int>"))
    states = begun.select("key", "part", "place", "behind").groupBy("key").applyInPandas(
        _follow, "key string, part long, place int, begin int, tail string")
    pieces = begun.join(states, ["key", "part", "place"]).select("key", "cost", F.struct(
        "part", "place", F.concat(F.get("audits", F.col("begin")), "tail").alias("piece")).alias("p"))
    joined = pieces.groupBy("key").agg(F.first("cost").alias("cost"), F.array_join(
        F.transform(F.array_sort(F.collect_list("p")), lambda x: x["piece"]), "").alias("audit"))
    found = alone.unionByName(joined)

    # Sums over the parts; neighbours of one conversation meet at their edges.
    edge = F.struct("part", "place", "first_turn", "last_turn", "first", "last")
    sums = parts.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("turns", "blank", "duplicate", "truncated", "illegal")],
                                     F.array_sort(F.collect_list(edge)).alias("edges"))
    turns = F.filter("edges", lambda e: e["first_turn"].isNotNull())
    roles = F.filter("edges", lambda e: e["first"].isNotNull())

    def met(edges: Column, test) -> Column:
        """Neighbouring parts for which ``test`` holds."""
        n = F.size(edges)
        near = F.zip_with(F.slice(edges, 1, F.greatest(n - 1, F.lit(0))), F.slice(edges, 2, F.greatest(n - 1, F.lit(0))), test)
        return F.size(F.filter(near, lambda x: x)).cast("long")

    same = met(turns, lambda a, b: a["last_turn"] == b["first_turn"])
    clash = met(roles, lambda a, b: ~F.concat(a["last"], b["first"]).isin(*sorted(LEGAL)))
    span = F.get(turns, F.size(turns) - 1)["last_turn"] - F.get(turns, F.lit(0))["first_turn"] + 1 - F.col("turns") + same
    out = sums.select("conv", key_of(), F.coalesce(span, F.lit(0).cast("long")).alias("gaps"), "blank", "duplicate", "truncated",
                      (F.col("illegal") + clash).alias("illegal"))
    return out.join(found, "key").drop("key")


NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
OUT = pa.schema([("conv", pa.int64()), *[(n, pa.int64()) for n in NUMBERS], ("audit", pa.string()), ("repaired_sha256", pa.string())])


class Repair:
    """The repaired text of one conversation, row by row."""

    def __init__(self, conv, numbers: list, audit: str):
        self.conv, self.numbers, self.audit = conv, numbers, audit
        self.at, self.q, self.any, self.hash = 0, NOTHING, False, hashlib.sha256()

    def line(self, role: str, text: str) -> None:
        self.hash.update(("\n" if self.any else "").encode() + role.encode() + b":" + text.encode())
        self.any = True

    def insertions(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.q = NEXT[self.q]
            self.line(ROLE[self.q], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.insertions()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.q = AFTER[role[0]][self.q]
            self.line(role, text)
        elif edit == "R":
            self.q = NEXT[self.q]
            self.line(ROLE[self.q], text)

    def done(self) -> tuple:
        self.insertions()
        return self.conv, *self.numbers, self.audit, self.hash.hexdigest()


def _stream(batches):
    """A partition's conversations, each an audit and then its rows in order."""
    now, out = None, []
    for b in batches:
        cols = {n: c.to_pylist() for n, c in zip(b.schema.names, b.columns, strict=True)}
        for i, n in enumerate(cols["n"]):
            if n is None:
                if now is not None:
                    out.append(now.done())
                now = Repair(cols["conv"][i], [cols[c][i] for c in NUMBERS], cols["audit"][i])
            else:
                for _ in range(n):
                    now.row(cols["role"][i], cols["text"][i])
        if len(out) >= 1000:
            yield _out_batch(out)
            out = []
    if now is not None:
        out.append(now.done())
    if out:
        yield _out_batch(out)


def _out_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), OUT, strict=True)], schema=OUT)


def damage(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """conv, turn, role, text, n: the rows after damage by crc32(conv:turn) mod 20.  n is 2
    for a repeated row and 0 for a dropped one (which only names its conversation)."""
    conv, turn = F.col(f"`{conv_col}`").cast("long"), F.col(f"`{turn_col}`").cast("long")
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role_col, text_col))
    shown = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (conv_col, turn_col)]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    gone = kind == 0
    return df.select(
        conv.alias("conv"), F.when(~gone, turn).alias("turn"),
        F.when(gone, "").when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(gone | (kind == 1), "").when(kind == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.when(gone, 0).when(kind == 3, 2).otherwise(1).alias("n"))


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv long, turn long, role, text, n): conv, gaps,
    blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    spark = rows.sparkSession
    digest = F.unhex(F.substring(F.sha2("text", 256), 1, 32))
    said = F.rtrim(F.col("text"), F.lit(BLANK))
    last = F.substring(said, -1, 1)
    fault = F.when(said == "", 0).when(~last.isin(*ENDS), 2).otherwise(3)
    facts = cut(rows.select("conv", "turn", "role", digest.alias("digest"), F.substring("role", 1, 1).alias("initial"),
                            fault.alias("fault"), "n"))
    # Texts that a role repeats in a conversation: the first turn stays as it is.
    turn = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
    again = (facts.where("n > 0 and fault <> 0").groupBy("conv", "role", "digest")
             .agg(F.min(turn).alias("first"), F.max(turn).alias("last")).where(F.col("first") != F.col("last"))
             .select(key_of(), "role", "digest", "first"))
    marked = facts.withColumn("key", key_of()).join(again, ["key", "role", "digest"], "left").select(
        "conv", "turn", "role", "digest", "initial",
        F.when(F.col("first").isNotNull() & (turn != F.col("first")) & (F.col("fault") != 0), 1).otherwise(F.col("fault")).alias("fault"), "n")
    audits = cut(audits_of(marked))

    none = [F.lit(None).cast("long").alias(c) for c in NUMBERS]
    texts = rows.where("n > 0").select("conv", "turn", "role", digest.alias("digest"), "text", "n", *none, F.lit(None).cast("string").alias("audit"))
    heads = audits.select("conv", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
                          F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("text"),
                          F.lit(None).cast("int").alias("n"), *NUMBERS, "audit")
    lines = heads.unionByName(texts).repartition(shuffle_partitions(spark), "conv")
    lines = lines.sortWithinPartitions("conv", F.col("n").isNotNull(), "turn", "role", "digest")
    return lines.select("conv", "role", "text", "n", *NUMBERS, "audit").mapInArrow(
        _stream, "conv long, " + ", ".join(f"{c} long" for c in NUMBERS) + ", audit string, repaired_sha256 string")
