"""Small builders for the comparison SQL."""

from __future__ import annotations


def r(x: str, n: int) -> str:
    """Half-up rounding after cutting floating-point noise."""
    return f"CAST(round(CAST({x} AS DECIMAL(28,9)), {n}) AS DOUBLE)"


def _where(cond: str | None) -> str:
    return f" FILTER (WHERE {cond})" if cond else ""


def avg(x: str, cond: str | None = None, n: int = 1) -> str:
    return r(f"avg({x}){_where(cond)}", n)


def mn(x: str, cond: str | None = None, n: int = 1) -> str:
    return r(f"min({x}){_where(cond)}", n)


def mx(x: str, cond: str | None = None, n: int = 1) -> str:
    return r(f"max({x}){_where(cond)}", n)


def pct(cond: str, of: str | None = None, n: int = 1) -> str:
    return r(f"count(*) FILTER (WHERE {cond}) * 100.0 / nullif(count(*){_where(of)}, 0)", n)



def fin(sql: str, i=(), d=(), s=(), day=(), ts=(), x=None) -> str:
    """Final projection: whole numbers, doubles (6 places), as is, dates and times as text."""
    cols = [f"CAST({c} AS BIGINT) AS {c}" for c in i]
    cols += [f"{r(c, 6)} AS {c}" for c in d]
    cols += [f"{c} AS {c}" for c in s]
    cols += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in day]
    cols += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in ts]
    cols += [f"{text} AS {c}" for c, text in (x or {}).items()]
    return f"SELECT {', '.join(cols)} FROM ({sql}) AS fin"
