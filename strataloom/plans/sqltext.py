"""Fragments for the SQL that checks the queries."""


def r(expr: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(24,6)), {digits}) AS DOUBLE)"


def ratio(num: str, den: str, digits: int, scale: float = 1.0) -> str:
    n, d = f"CAST({num} AS DOUBLE)", f"CAST({den} AS DOUBLE)"
    return r(f"(CASE WHEN {d} <> 0 THEN {scale} * {n} / {d} END)", digits)


def pct(part: str, whole: str, digits: int = 2) -> str:
    return ratio(part, whole, digits, 100.0)


def m(expr: str) -> str:
    """Exact two-decimal amount."""
    return f"CAST({expr} AS DECIMAL(18,2))"


def d(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def n(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def day(expr: str) -> str:
    return f"CAST(CAST({expr} AS DATE) AS VARCHAR)"


def sec(later: str, earlier: str) -> str:
    return f"((epoch_us({later}) - epoch_us({earlier})) / 1000000.0)"
