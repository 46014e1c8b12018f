"""Exact "first n rows by a hash order" without a single-task sort.

``orderBy(h).limit(n)`` with n proportional to the table (20 % of the edges)
would gather n rows into one task.  Instead the n-th smallest key is found
with two histogram passes over the integer hash (high bits, then low bits),
each a distributed aggregation returning at most 2^16 rows; rows with that
exact hash value break the tie by their id columns.  The result is
a filter, so the selected rows never leave their partitions.  Tie columns are
integers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts of a tie column's range that one pass counts.
TIE_PARTS = 1024
HIGH_SHIFT = 15   # hashes are < 2^31: 2^16 high buckets x 2^15 low values


def _cum_pick(counts: list[tuple[int, int]], n: int) -> tuple[int, int]:
    """(bucket holding the n-th row, rows before that bucket)."""
    before = 0
    for b, c in sorted(counts):
        if before + c >= n:
            return b, before
        before += c
    raise ValueError("n exceeds the number of rows")


def _nth_tie(same: DataFrame, need: int, tie_cols: list[str]) -> tuple:
    """The tie columns of the ``need``-th of rows that share a hash.

    Column by column the value's range is narrowed by counts of ``TIE_PARTS`` parts of it, which
    brings that many numbers to the driver per pass however many rows tie."""
    found: list = []
    rows = same
    for c in tie_cols:
        lo, hi = rows.agg(F.min(c), F.max(c)).first()
        while lo < hi:
            width = (hi - lo) // TIE_PARTS + 1
            part = F.expr(f"cast((cast(`{c}` as decimal(20)) - {lo}) div {width} as bigint)")
            counts = sorted((r.b, r["count"]) for r in rows.filter(F.col(c).between(lo, hi)).groupBy(part.alias("b")).count().collect())
            at = counts[-1][0]                               # fewer rows than needed: the last value
            for b, n in counts:
                if n >= need:
                    at = b
                    break
                need -= n
            lo, hi = lo + at * width, min(hi, lo + (at + 1) * width - 1)
        rows = rows.filter(F.col(c) == lo)
        found.append(lo)
    return tuple(found)


def smallest_n(df: DataFrame, n: int, hash_col: str, tie_cols: list[str]) -> DataFrame:
    """Rows of ``df`` ranked < n by (hash_col, *tie_cols) ascending."""
    if n <= 0:
        return df.limit(0)
    total = df.count()
    if n >= total:
        return df
    hi = F.shiftright(F.col(hash_col), HIGH_SHIFT)
    hist = df.groupBy(hi.alias("b")).count().collect()
    b_hi, before = _cum_pick([(r.b, r["count"]) for r in hist], n)
    in_b = df.filter(hi == b_hi)
    lo_hist = in_b.groupBy(F.col(hash_col).alias("h")).count().collect()
    h_star, before2 = _cum_pick([(r.h, r["count"]) for r in lo_hist], n - before)
    need = n - before - before2          # rows to take among those with hash == h_star
    below = df.filter(F.col(hash_col) < h_star)
    same = df.filter(F.col(hash_col) == h_star)
    last = _nth_tie(same, need, tie_cols)
    # lexicographic (tie_cols) <= last among rows with the exact hash
    cond = None
    for i in range(len(tie_cols) - 1, -1, -1):
        eq_prefix = [F.col(tie_cols[j]) == F.lit(last[j]) for j in range(i)]
        term = F.col(tie_cols[i]) < F.lit(last[i]) if i < len(tie_cols) - 1 else F.col(tie_cols[i]) <= F.lit(last[i])
        for e in eq_prefix:
            term = term & e
        cond = term if cond is None else (cond | term)
    at = df.filter((F.col(hash_col) == h_star) & cond)
    return below.unionByName(at)
