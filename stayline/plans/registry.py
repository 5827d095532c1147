"""Query registry shared by the plan modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

# Registered outputs round floating columns to this many decimals so that two
# engines summing in different orders compare equal.
DECIMALS = 6


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = decimal_rounding(sql.strip())
        return fn
    return deco


def _matching_paren(s: str, open_at: int) -> int:
    depth = 0
    quote = None
    for i in range(open_at, len(s)):
        ch = s[i]
        if quote:
            if ch == quote:
                quote = None
        elif ch in "'\"":
            quote = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
            if depth == 0:
                return i
    raise ValueError("unbalanced parentheses")


def _split_top(args: str) -> list[str]:
    out, depth, cur, quote = [], 0, [], None
    for ch in args:
        if quote:
            cur.append(ch)
            if ch == quote:
                quote = None
            continue
        if ch in "'\"":
            quote = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        if ch == "," and depth == 0:
            out.append("".join(cur))
            cur = []
        else:
            cur.append(ch)
    out.append("".join(cur))
    return out


def decimal_rounding(sql: str) -> str:
    """Oracle SQL: ``round(x, 6)`` → two-stage decimal rounding, the same
    recipe ``rounded`` applies on the Spark side (see there)."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        while j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):
            j = low.find("round(", j + 1)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        k = _matching_paren(sql, j + 5)
        args = _split_top(sql[j + 6:k])
        out.append(sql[i:j])
        if len(args) == 2 and args[1].strip() == str(DECIMALS):
            inner = decimal_rounding(args[0])
            out.append(f"coalesce(CAST(round(TRY_CAST({inner} AS DECIMAL(38, 9)), {DECIMALS}) AS DOUBLE), {inner})")
        else:
            out.append("round(" + ", ".join(decimal_rounding(a) for a in args) + ")")
        i = k + 1


def round_half_away(x: Column, decimals: int = DECIMALS) -> Column:
    """Two-stage decimal rounding: to 9 decimals (absorbs the last-bit noise of
    floating sums taken in different orders), then half-up to ``decimals``
    on the exact decimal.  Means of 2-decimal data over 32, 160, … rows sit
    exactly on a 6-decimal half, where rounding the raw double would follow
    the noise.  Values that no such decimal holds (infinity, NaN, 1e30) pass
    through unchanged."""
    return F.coalesce(F.round(x.try_cast("decimal(38,9)"), decimals).cast("double"), x)


def rounded(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """Round every double/float column (presentation only)."""
    cols: list[Column] = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if t in ("double", "float"):
            cols.append(round_half_away(F.col(f.name).cast("double"), decimals).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
