"""Deterministic pseudo-random draws computed from ids.

Spark's ``rand(seed)`` depends on partitioning, so a recomputed partition (a lost
executor) or another engine would draw differently.  These draws are pure
functions of an integer key and a seed, written with integer arithmetic that
SQL engines share, so the same rows are picked on every recompute and the
DuckDB oracle can repeat them.

Fixed values (must stay as written so that results are reproducible):
multiplier 1103515245, increment 12345, modulus 2^31, seed stride 7919,
xor-shifts 13 and 16.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MULT = 1103515245
INC = 12345
MOD = 2147483648
SEED_STRIDE = 7919


def _fold(k: Column) -> Column:
    """A 64-bit integer key folded to 31 bits (keys below 2^31 stay as they are), so
    that the products below never leave the bigint range."""
    k = k.cast("bigint")
    return k.bitwiseAND(F.lit(MOD - 1)).bitwiseXOR(F.shiftright(k, 31).bitwiseAND(F.lit(MOD - 1)))


def hash_int(key, seed: int = 0) -> Column:
    """An integer in [0, 2^31) from an integer key."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.pmod(_fold(k) * F.lit(MULT) + F.lit(INC + seed * SEED_STRIDE), F.lit(MOD))
    h = h.bitwiseXOR(F.shiftright(h, 13))
    h = F.pmod(h * F.lit(MULT) + F.lit(INC), F.lit(MOD))
    return h.bitwiseXOR(F.shiftright(h, 16))


def hash_keys(keys, seed: int = 0) -> Column:
    """An integer in [0, 2^31) from several integer keys, taken in one after another."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    h = hash_int(cols[0], seed)
    for c in cols[1:]:
        h = hash_int(h.bitwiseXOR(_fold(c)), seed)
    return h


def hash_uniform(key, seed: int = 0) -> Column:
    """A double in [0, 1) from an integer key."""
    return hash_int(key, seed) / F.lit(float(MOD))


def _sql_fold(key: str) -> str:
    k = f"({key})::BIGINT"
    return f"xor({k} & {MOD - 1}, ({k} >> 31) & {MOD - 1})"


def sql_hash_int(key: str, seed: int = 0) -> str:
    """The same draw as SQL text (DuckDB / ANSI): ``xor`` and ``>>``."""
    h1 = f"(({_sql_fold(key)}) * {MULT} + {INC + seed * SEED_STRIDE}) % {MOD}"
    h2 = f"xor({h1}, ({h1}) >> 13)"
    h3 = f"(({h2}) * {MULT} + {INC}) % {MOD}"
    return f"xor({h3}, ({h3}) >> 16)"


def sql_hash_keys(keys: list[str], seed: int = 0) -> str:
    """``hash_keys`` as SQL text."""
    h = sql_hash_int(keys[0], seed)
    for k in keys[1:]:
        h = sql_hash_int(f"xor({h}, {_sql_fold(k)})", seed)
    return h


def sql_hash_uniform(key: str, seed: int = 0) -> str:
    return f"(({sql_hash_int(key, seed)}) / {float(MOD)})"
