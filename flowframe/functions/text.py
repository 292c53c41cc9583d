"""Text scalar functions (inventory I1-I11) as Column expressions.

Python's ``\\w``/``\\d``/``\\s`` are Unicode-aware; Java's are ASCII unless the
pattern starts with ``(?U)``, so every user pattern is prefixed (S9).  A regex
with no match gives NULL, as in pandas, not Spark's empty string (S8).
"""

from __future__ import annotations

import re
from typing import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def java_regex(pattern: str) -> str:
    """Python regex to Java: Unicode classes, named groups kept as ``(?<n>..)``."""
    p = re.sub(r"\(\?P<(\w+)>", r"(?<\1>", pattern)
    return p if p.startswith("(?U)") else "(?U)" + p


def java_replacement(repl: str) -> str:
    """Python replacement (``\\1``) to Java (``$1``)."""
    return re.sub(r"\\(\d+)", r"$\1", repl.replace("$", "\\$"))


def lower(c: Column) -> Column:
    return F.lower(c)


def strip(c: Column) -> Column:
    """``str.strip()``: all Unicode whitespace at both ends (``trim`` only
    removes blanks)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def length(c: Column) -> Column:
    return F.char_length(c)


def split_part(c: Column, sep: str, n: int) -> Column:
    """``str.split(sep).str[n]``: n-th part, NULL when absent."""
    return F.try_element_at(F.split(c, re.escape(sep)), F.lit(n + 1 if n >= 0 else n))


def split_columns(c: Column, sep: str, n: int, names: Sequence[str]) -> list[Column]:
    """``str.split(sep, expand=True)`` into ``n`` named columns."""
    parts = F.split(c, re.escape(sep))
    return [F.try_element_at(parts, F.lit(i + 1)).alias(names[i]) for i in range(n)]


def contains(c: Column, pattern: str, regex: bool = True, case: bool = True) -> Column:
    """I4: ``str.contains(p, case=, regex=)``; NULL text gives NULL."""
    if not regex:
        return F.contains(c, F.lit(pattern)) if case else F.contains(F.lower(c), F.lit(pattern.lower()))
    p = java_regex(pattern)
    if not case:
        p = "(?i)" + p
    return c.rlike(p)


def startswith(c: Column, prefix: str) -> Column:
    return F.startswith(c, F.lit(prefix))


def _group_shape(pattern: str, group: int) -> tuple[int, bool]:
    """Fewest characters of a group's match, and whether it takes part in every match."""
    def find(items, always: bool):
        for op, arg in items:
            name = str(op)
            if name == "SUBPATTERN":
                if arg[0] == group:
                    return arg[3].getwidth()[0], always
                found = find(arg[3], always)
            elif name == "BRANCH":
                found = next((f for b in arg[1] if (f := find(b, False))), None)
            elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
                found = find(arg[2], always and arg[0] > 0)
            elif name in ("ASSERT", "ATOMIC_GROUP"):
                found = find(arg[1] if name == "ASSERT" else arg, always)
            else:
                found = None
            if found:
                return found
        return None

    return find(re._parser.parse(pattern), True) or (0, True)


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """First match's ``group``; no match, or a group that took no part in it ->
    NULL (S8).  Spark gives '' for both, which only means NULL when the group cannot
    match the empty text; a group that can, and need not take part, goes to Python."""
    p = java_regex(pattern)
    fewest, always = _group_shape(pattern, group)
    if fewest > 0:
        return F.nullif(F.regexp_extract(c, p, group), F.lit(""))
    if always:
        return F.when(c.rlike(p), F.regexp_extract(c, p, group))

    @F.pandas_udf("string")
    def python_extract(s: pd.Series) -> pd.Series:
        found = s.map(lambda v: m[group] if v is not None and (m := re.search(pattern, v)) else None)
        return found.astype("object")

    return python_extract(c)


def extract_code(c: Column, pattern: str, default: int = 0) -> Column:
    """``str.extract(p).fillna(0).astype(int)``."""
    return F.coalesce(extract(c, pattern).try_cast("long"), F.lit(default))


def extract_named(c: Column, pattern: str) -> list[Column]:
    """``str.extract`` with named groups -> one column per group."""
    names = re.findall(r"\(\?P<(\w+)>", pattern)
    return [extract(c, pattern, i + 1).alias(n) for i, n in enumerate(names)]


def extract_all(c: Column, pattern: str) -> Column:
    """I8: ``str.extractall``: array of one struct per match for ``inline``/``posexplode``.

    Fields are the pattern's groups: their names, ``_0``, ``_1``, ... for groups without one.  A
    group that takes no part in a match or matches the empty text is NULL there, as in
    pandas; a pattern without groups is an error.
    """
    compiled = re.compile(pattern)
    if not compiled.groups:
        raise ValueError("the pattern has no groups")
    by_number = {n: name for name, n in compiled.groupindex.items()}
    p = F.lit(java_regex(pattern))
    arrays = [F.transform(F.regexp_extract_all(c, p, F.lit(i)), lambda v: F.nullif(v, F.lit(""))).alias(by_number.get(i, f"_{i - 1}"))
              for i in range(1, compiled.groups + 1)]
    return F.arrays_zip(*arrays)


def replace_regex(c: Column, pattern: str, repl: str) -> Column:
    """``str.replace(p, r, regex=True)`` with ``\\1`` back references."""
    return F.regexp_replace(c, java_regex(pattern), java_replacement(repl))


def replace_literal(c: Column, old: str, new: str) -> Column:
    """``str.replace(old, new, regex=False)``."""
    return F.replace(c, F.lit(old), F.lit(new))


def prefix(c: Column, p: str) -> Column:
    """``prefix + col.astype(str)``."""
    return F.concat(F.lit(p), c.cast("string"))


def cat(c: str, sep: str = ",", order: str | None = None) -> Column:
    """``str.cat(sep)`` as an aggregate (use it per group): missing values
    skipped, values joined in ``order`` (``listagg ... WITHIN GROUP``)."""
    if order is None:
        return F.listagg(F.col(c), F.lit(sep))
    return F.expr(f"listagg(`{c}`, '{sep}') WITHIN GROUP (ORDER BY `{order}`)")
