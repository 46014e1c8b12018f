"""Licence scan by canonical digests (DataFrame functions only).

A text is put into canonical form line by line: lower case, lines that only state
a copyright or that all rights are reserved dropped (also behind comment marks), punctuation and white space reduced to word borders, and
equivalent spellings unified.  The SHA-256 digest of the whole canonical text is
hash-joined to the digests of the known licence texts (a list of a few dozen, so
the join needs no shuffle at any size).  The digest of every single line is looked
up in the same list, which finds licence notices inside a document.

Null texts count as empty; an empty text has the digest of nothing and no licence.  A text of
any length is read whole; an empty table gives no rows.
Each row stands for itself, so hot or repeated rows cost nothing extra.  Other
columns play no part.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.llm.license_texts import DIGESTS, EQUIVALENT, KNOWN

_BORDER = r"[^\p{L}\p{N}]+"
#: Marks that a comment puts before a line, in front of what is looked at.
_MARKS = r"^[\s#*/;!%<>|-]+"
_COPYRIGHT = ("copyright", "(c)", "©", "all rights reserved")


def _line(x: Column) -> Column:
    words = F.trim(F.regexp_replace(x, _BORDER, "  "))
    spelled = functools.reduce(lambda c, p: F.replace(c, F.lit(f" {p[0]} "), F.lit(f" {p[1]} ")), EQUIVALENT,
                               F.concat(F.lit(" "), words, F.lit(" ")))
    return F.trim(spelled)


def canonical_lines(text: Column) -> Column:
    """Canonical form of each line that holds words and is no copyright line."""
    lines = F.split(F.lower(F.coalesce(text, F.lit(""))), "\n")
    stated = F.filter(lines, lambda x: ~functools.reduce(
        lambda a, b: a | b, [F.startswith(F.regexp_replace(x, _MARKS, ""), F.lit(c)) for c in _COPYRIGHT]))
    return F.filter(F.transform(stated, _line), lambda x: x != "")


def known_digests(df: DataFrame) -> DataFrame:
    """digest, license: one row for each known text."""
    rows = df.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in KNOWN])))
    rows = rows.select(F.sha2(F.array_join(canonical_lines(F.col("text")), "  "), 256).alias("digest"), "license")
    more = df.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(digest).alias("digest"), F.lit(name).alias("license")) for name, digest in DIGESTS])))
    return rows.unionByName(more).distinct()


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest (of the whole canonical text), license (of the whole text, null if
    unknown), notices (licences of single lines, sorted)."""
    known = known_digests(df)
    by_digest = F.create_map(*[F.lit(x) for r in known.collect() for x in (r.digest, r.license)])   # a few dozen
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"),
                     canonical_lines(F.col(f"`{text_col}`").cast("string")).alias("lines"))
    found = F.transform("lines", lambda x: F.try_element_at(by_digest, F.sha2(x, 256)))
    rows = rows.select("doc_id", F.sha2(F.array_join("lines", "  "), 256).alias("digest"),
                       F.array_sort(F.array_distinct(F.filter(found, lambda x: x.isNotNull()))).alias("notices"))
    return rows.join(F.broadcast(known), "digest", "left").select("doc_id", "digest", "license", "notices")


def license_sql() -> str:
    """The same in DuckDB SQL over ``documents``."""
    def line(x: str) -> str:
        out = f"' ' || trim(regexp_replace({x}, '{_BORDER}', '  ', 'g')) || ' '"
        for a, b in EQUIVALENT:
            out = f"replace({out}, ' {a} ', ' {b} ')"
        return f"trim({out})"

    def lines(text: str) -> str:
        plain = " AND ".join(f"NOT starts_with(regexp_replace(x, '{_MARKS}', ''), '{c}')" for c in _COPYRIGHT)
        return (f"list_filter(list_transform(list_filter(string_split(lower(coalesce({text}, '')), chr(10)), lambda x: {plain}), "
                f"lambda x: {line('x')}), lambda x: x <> '')")

    digests = ", ".join(f"('{d}', '{n}')" for n, d in DIGESTS)
    quoted = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in KNOWN)
    return f"""
WITH known AS (SELECT DISTINCT sha256(array_to_string({lines('text')}, '  ')) AS digest, license
               FROM (VALUES {quoted}) AS k(license, text)
               UNION SELECT digest, license FROM (VALUES {digests}) AS x(digest, license)),
d AS (SELECT row_number() OVER () AS rn, doc_id, {lines('text')} AS lines FROM documents),
n AS (SELECT rn, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
      FROM (SELECT rn, sha256(unnest(lines)) AS digest FROM d) JOIN known USING (digest) GROUP BY rn)
SELECT doc_id, sha256(array_to_string(lines, '  ')) AS digest, known.license, coalesce(notices, '') AS notices
FROM d LEFT JOIN n USING (rn) LEFT JOIN known ON known.digest = sha256(array_to_string(lines, '  '))
"""
