"""Sharding by sampled splitters (DataFrame functions only).

Rows are ordered by (hash of the text, id, row number); equal texts lie side by
side.  A size-weighted sample of the keys gives quantile boundaries, the rows are
range-partitioned by them, and every range is measured exactly; an overfull one
is subdivided by splitters from a denser sample of its own, until none is.  The
exact sizes of the ranges, and running sums inside each, then place every row at
its byte offset, which the shards cut into equal parts.

Law ``bytes``: documents above 1/64 of a shard (fewer than 64 a shard, which
bounds what the driver places) go first, largest to the emptiest shard; the rest,
in key order, fills each shard to its share, so two shards differ by less than
1/32 of a shard unless one document alone is larger than that.

A null text has size 8 (as an empty one), a null id sorts first, repeated rows
are rows of their own, an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from meridian.plans.iterate import cut

ROW_BYTES = 8
RANGES_PER_SHARD = 8
SAMPLE_PER_RANGE = 32
BIG_PER_SHARD = 64
#: A range above this many rows is split further, so that a task sorts a bounded number.
MAX_RANGE_ROWS = 4_000_000


def _point(p) -> Column:
    return F.struct(*[F.lit(x).cast("long") for x in p])


def _range_of(splitters: list) -> Column:
    """How many splitters are <= the key, found in two steps of about sqrt(n)."""
    if not splitters:
        return F.lit(0)
    step = max(1, math.isqrt(len(splitters)))
    heads = F.array(*[_point(p) for p in splitters[step - 1::step]])
    groups = [splitters[i:i + step - 1] for i in range(0, len(splitters) + 1, step)]
    empty = F.array().cast("array<struct<col1:bigint,col2:bigint,col3:bigint>>")
    tails = F.array(*[F.array(*[_point(p) for p in g]) if g else empty for g in groups])
    key = F.col("point")
    c = F.size(F.filter(heads, lambda s: s <= key))
    return c * step + F.size(F.filter(F.get(tails, c), lambda s: s <= key))


def _sample(keys: DataFrame, weight: Column, seed: int) -> list:
    """Keys drawn with the chance ``weight`` (a pure function of the key, so a
    recomputed task draws the same)."""
    u = F.pmod(F.xxhash64("k", "sid", "tie", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    rows = keys.where(u < weight).select("k", "sid", "tie", F.greatest(weight, F.lit(1.0)).alias("w")).collect()
    return sorted((r.k, r.sid, r.tie, r.w) for r in rows)


def _quantiles(sample: list, parts: int) -> list:
    """At most ``parts - 1`` boundaries that cut the sample into about equal weights."""
    step = sum(s[3] for s in sample) / parts
    acc, out, target = 0.0, [], step
    for s in sample:
        if acc >= target and (not out or s[:3] > out[-1]):
            out.append(s[:3])
            target = step * (math.floor(acc / step) + 1)
        acc += s[3]
    return out


def shard_by_size(df: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, size, text_crc32, shard, slot."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    ident = F.col(f"`{id_col}`").cast("long")
    keys = cut(df.select(
        ident.alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("k"),
        F.coalesce(ident, F.lit(-(1 << 63))).alias("sid"), F.monotonically_increasing_id().alias("tie")))
    keys = keys.withColumn("point", F.struct(F.col("k").alias("col1"), F.col("sid").alias("col2"),
                                             F.col("tie").alias("col3")))
    rows, total = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    spark = df.sparkSession
    if rows == 0:
        return keys.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))

    # Large documents: fewer than shards * BIG_PER_SHARD, since each has more than that part of the bytes.
    is_big = F.col("size") * (shards * BIG_PER_SHARD) > F.lit(total)
    big = sorted(keys.where(is_big).select("size", "k", "sid", "tie", "doc_id", "text_crc32").collect(),
                 key=lambda r: (-r["size"], r["k"], r["sid"], r["tie"]))
    load, placed, count = [0] * shards, [], [0] * shards
    for r in big:
        s = min(range(shards), key=lambda i: (load[i], i))
        placed.append((r["doc_id"], r["size"], r["text_crc32"], s, count[s]))
        load[s] += r["size"]
        count[s] += 1
    small = keys.where(~is_big)
    n_small, b_small = rows - len(big), total - sum(load)
    starts = _fill(load, b_small)

    # Ranges of the others: about equal in bytes and in rows.
    n_ranges = shards * max(RANGES_PER_SHARD, math.ceil(n_small / shards / MAX_RANGE_ROWS))
    share = (F.col("size") / float(max(1, b_small)) + 1.0 / max(1, n_small)) / 2
    splitters = _quantiles(_sample(small, share * (n_ranges * SAMPLE_PER_RANGE), 0), n_ranges)
    seed = 0
    while True:
        ranged = small.withColumn("range", _range_of(splitters))
        stats = sorted(ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"),
                                                   F.sum(share).alias("share")).collect())
        over = [r for r in stats if r["share"] * n_ranges > 2 and r["rows"] > 1]
        if not over:
            break
        seed += 1
        scale = F.coalesce(*[F.when(F.col("range") == r["range"], F.lit(
            min(1e18, SAMPLE_PER_RANGE * math.ceil(r["share"] * n_ranges) / r["share"]))) for r in over])
        more = _sample(ranged.where(F.col("range").isin([r["range"] for r in over])), share * scale, seed)
        found = set(splitters)
        for r in over:
            lo = splitters[r["range"] - 1] if r["range"] else None
            hi = splitters[r["range"]] if r["range"] < len(splitters) else None
            own = [m for m in more if (lo is None or m[:3] >= lo) and (hi is None or m[:3] < hi)]
            found.update(_quantiles(own, math.ceil(r["share"] * n_ranges) + 1))
        if len(found) == len(splitters):       # nothing left that could be split, as one row holds the weight
            if seed > 8:
                break
            continue
        splitters = sorted(found)

    # Byte offsets: exact sizes of the ranges before, and a running sum inside.
    base, acc = {}, 0
    for r in stats:
        base[r["range"]] = acc
        acc += r["bytes"]
    order = W.partitionBy("range").orderBy("k", "sid", "tie")
    before = F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    shard = F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in starts[1:]]), lambda s: s <= F.col("offset")))
    at = cut(ranged.withColumn("before", before).withColumn("rn", F.row_number().over(order))
             .withColumn("offset", _lookup(base, "range") + F.col("before") + F.floor(F.col("size") / 2))
             .withColumn("shard", shard)
             .select("doc_id", "size", "text_crc32", "range", "rn", "shard"))
    first = {}
    for r in sorted(at.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("rows"), F.min("rn").alias("rn")).collect()):
        first[(r["shard"], r["range"])] = count[r["shard"]] - r["rn"]
        count[r["shard"]] += r["rows"]
    shift = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(s).alias("shard"), F.lit(g).alias("range"), F.lit(b).cast("long").alias("shift"))
        for (s, g), b in first.items()]))) if first else None
    out = None
    if shift is not None:                      # a few rows for each shard and range
        out = at.join(F.broadcast(shift), ["shard", "range"]).select(
            "doc_id", "size", "text_crc32", "shard", (F.col("rn") + F.col("shift")).alias("slot"))
    if placed:
        head = spark.range(1).select(F.inline(F.array(*[
            F.struct(F.lit(d).cast("long").alias("doc_id"), F.lit(z).cast("long").alias("size"),
                     F.lit(c).cast("long").alias("text_crc32"), F.lit(s).alias("shard"),
                     F.lit(t).cast("long").alias("slot")) for d, z, c, s, t in placed])))
        out = head if out is None else out.unionByName(head)
    return out


def _fill(load: list[int], rest: int) -> list[int]:
    """Where each shard's part of the other ``rest`` bytes begins, when they fill
    the shards up to one level."""
    order = sorted(load)
    level = 0.0
    for i in range(len(order), 0, -1):
        level = (rest + sum(order[:i])) / i
        if level >= order[i - 1]:
            break
    starts, acc = [], 0.0
    for x in load:
        starts.append(math.floor(acc))
        acc += max(0.0, level - x)
    return starts


def _lookup(values: dict, column: str) -> Column:
    """A bounded table (one entry per range) as an array literal, read by position."""
    top = max(values) if values else 0
    return F.get(F.array(*[F.lit(values.get(i, 0)).cast("long") for i in range(top + 1)]), F.col(column))
