"""SQL for DuckDB that states the adapters and families again, apart from the Spark plans."""

from __future__ import annotations

BARS = """trades AS (
  SELECT p_brand AS sym, CAST(l_shipdate AS DATE) AS d, l_extendedprice / nullif(l_quantity, 0) AS px, l_quantity AS q,
    row_number() OVER (PARTITION BY p_brand, CAST(l_shipdate AS DATE) ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax) AS k
  FROM lineitem JOIN part ON l_partkey = p_partkey
), bars AS (
  SELECT sym, d, min_by(px, k) AS o, max(px) AS h, min(px) AS l, max_by(px, k) AS c, sum(q) AS v FROM trades GROUP BY sym, d
)"""
MARKET = "mkt AS (SELECT CAST(l_shipdate AS DATE) AS d, avg(l_extendedprice / nullif(l_quantity, 0)) AS c FROM lineitem GROUP BY 1)"
PREPARED = """p AS (
  SELECT *, CAST(row_number() OVER s AS DOUBLE) AS t, lag(c) OVER s AS c1, lag(v) OVER s AS v1,
    avg(v) OVER (s ROWS 19 PRECEDING) AS usual
  FROM bars WINDOW s AS (PARTITION BY sym ORDER BY d)
), q AS (
  SELECT *, CASE WHEN c > c1 THEN 1.0 ELSE 0.0 END AS up, CASE WHEN c < c1 THEN 1.0 ELSE 0.0 END AS down, c - c1 AS dc, v - v1 AS dv,
    c / nullif(c1, 0) - 1 AS ret, c / nullif(c1, 0) AS rc, ln(v + 1) AS lv, ln(v / nullif(v1, 0) + 1) AS lrv,
    CASE WHEN v > 0 THEN v WHEN usual > 0 THEN usual ELSE 1.0 END AS vs
  FROM p
)"""


def gated(agg: str, x: str, n: int, least: int | None = None) -> str:
    return f"CASE WHEN count({x}) OVER w{n} >= {least or n} THEN {agg} END"


def over(agg: str, x: str, n: int) -> str:
    return gated(f"{agg}({x}) OVER w{n}", x, n)


def family(n: int) -> dict[str, str]:
    w = f"OVER w{n}"
    slope = gated(f"regr_slope(c, t) {w}", "c", n)
    top = f"(list_position(list(h) {w}, list_max(list(h) {w})) - 1)"
    bottom = f"(list_position(list(l) {w}, list_min(list(l) {w})) - 1)"
    rise, fall, moved = over("sum", "greatest(dc, 0)", n), over("sum", "greatest(-dc, 0)", n), f"({over('sum', 'abs(dc)', n)} + 1e-12)"
    rise, fall = (over("sum", f"CASE WHEN dc IS NOT NULL THEN greatest({s}dc, 0) END", n) for s in ("", "-"))
    vrise, vfall = (over("sum", f"CASE WHEN dv IS NOT NULL THEN greatest({s}dv, 0) END", n) for s in ("", "-"))
    vmoved = f"({over('sum', 'abs(dv)', n)} + 1e-12)"

    def corr(x: str, y: str) -> str:
        both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
        x, y = f"CASE WHEN {both} THEN {x} END", f"CASE WHEN {both} THEN {y} END"
        return gated(f"covar_samp({x}, {y}) {w} / nullif(sqrt(var_samp({x}) {w} * var_samp({y}) {w}), 0)", x, n)

    a = f"list(c) {w}"
    return {
        "ROC": f"lag(c, {n}) OVER s / c",
        "MA": f"{over('avg', 'c', n)} / c",
        "STD": f"{over('stddev_samp', 'c', n)} / c",
        "BETA": f"{slope} / c",
        "RSQR": gated(f"CASE WHEN var_samp(c) {w} * {n - 1} >= 1e-12 THEN regr_r2(c, t) {w} END", "c", n),
        "RESI": f"(c - ({over('avg', 'c', n)} + {slope} * {(n - 1) / 2})) / c",
        "MAX": f"{over('max', 'h', n)} / c",
        "MIN": f"{over('min', 'l', n)} / c",
        "QTLU": gated(f"quantile_cont(c, 0.8) {w}", "c", n) + " / c",
        "QTLD": gated(f"quantile_cont(c, 0.2) {w}", "c", n) + " / c",
        "RANK": gated(f"(len(list_filter({a}, lambda y: y < c)) + (len(list_filter({a}, lambda y: y = c)) + 1) / 2.0) / {n}", "c", n),
        "RSV": f"(c - {over('min', 'l', n)}) / ({over('max', 'h', n)} - {over('min', 'l', n)} + 1e-12)",
        "IMAX": gated(f"{top} / {float(n)}", "h", n),
        "IMIN": gated(f"{bottom} / {float(n)}", "l", n),
        "IMXD": gated(f"({top} - {bottom}) / {float(n)}", "h", n),
        "CORR": corr("c", "lv"),
        "CORD": corr("rc", "lrv"),
        "CNTP": over("avg", "up", n),
        "CNTN": over("avg", "down", n),
        "CNTD": f"{over('avg', 'up', n)} - {over('avg', 'down', n)}",
        "SUMP": f"{rise} / {moved}",
        "SUMN": f"{fall} / {moved}",
        "SUMD": f"({rise} - {fall}) / {moved}",
        "VMA": f"{over('avg', 'v', n)} / vs",
        "VSTD": f"{over('stddev_samp', 'v', n)} / vs",
        "WVMA": f"{over('stddev_samp', 'abs(ret) * v', n)} / ({over('avg', 'abs(ret) * v', n)} + 1e-12)",
        "VSUMP": f"{vrise} / {vmoved}",
        "VSUMN": f"{vfall} / {vmoved}",
        "VSUMD": f"({vrise} - {vfall}) / {vmoved}",
    }


def windows(sizes) -> str:
    return "WINDOW s AS (PARTITION BY sym ORDER BY d), " + ", ".join(f"w{n} AS (PARTITION BY sym ORDER BY d ROWS {n - 1} PRECEDING)" for n in sizes)


def rolling(only: set[str], sizes) -> str:
    cols = [f"round({x} + 1e-9, 6) + 0.0 AS {k}{n}" for n in sizes for k, x in family(n).items() if k in only]
    return f"WITH {BARS}, {PREPARED} SELECT sym, d, {', '.join(cols)} FROM q {windows(sizes)}"
