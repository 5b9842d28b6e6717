"""The rolling feature set of daily bars: bar shape, price ratios, and 29 families over five windows, in two grains.

``train`` and ``serve`` share names but differ on purpose: ties in RANK (average against highest), CORR and CORD (null
against 0 on a constant leg), and the volume that stands in for a zero one (mean of the last 20 with zeros, or of the
positive ones). The serve grain also starts after its first 69 bars and has 0 where open or close is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import windows as w

WINDOWS = (5, 10, 20, 30, 60)
TINY = 1e-12
KBAR = ("KMID", "KLEN", "KMID2", "KUP", "KUP2", "KLOW", "KLOW2", "KSFT", "KSFT2")
PRICE = ("OPEN0", "HIGH0", "LOW0", "VWAP0")
FAMILIES = tuple("ROC MA STD BETA RSQR RESI MAX MIN QTLU QTLD RANK RSV IMAX IMIN IMXD CORR CORD CNTP CNTN CNTD SUMP SUMN SUMD VMA VSTD WVMA VSUMP VSUMN VSUMD".split())
WARM_UP = 69


def feature_names() -> list[str]:
    return [*KBAR, *PRICE, *(f"{f}{n}" for n in WINDOWS for f in FAMILIES)]


def _by(num: Column, den: Column, serve: bool) -> Column:
    return F.when(den == 0, 0.0).otherwise(F.try_divide(num, den)) if serve else F.try_divide(num, den)


def shape(serve: bool = False) -> dict[str, Column]:
    """Bar shape and price ratios."""
    o, h, l, c = (F.col(x) for x in "ohlc")
    span, top, bottom = h - l + TINY, F.greatest("o", "c"), F.least("o", "c")
    return {
        "KMID": _by(c - o, o, serve),
        "KLEN": _by(h - l, o, serve),
        "KMID2": (c - o) / span,
        "KUP": _by(h - top, o, serve),
        "KUP2": (h - top) / span,
        "KLOW": _by(bottom - l, o, serve),
        "KLOW2": (bottom - l) / span,
        "KSFT": _by(2 * c - h - l, o, serve),
        "KSFT2": (2 * c - h - l) / span,
        "OPEN0": _by(o, c, serve),
        "HIGH0": _by(h, c, serve),
        "LOW0": _by(l, c, serve),
        "VWAP0": _by((o + h + l + c) / 4, c, serve),
    }


def prepared(bars: DataFrame, serve: bool = False) -> DataFrame:
    """Adds what all windows share: row number, changes, returns, log volumes and the volume to divide by."""
    c, v, c1, v1 = F.col("c"), F.col("v").cast("double"), w.lag("c"), w.lag(F.col("v").cast("double"))
    held = F.when(v > 0, v) if serve else v
    usual = F.avg(held).over(w.last_rows(20))
    return bars.withColumns(
        {
            "v": v,
            "t": F.row_number().over(w.series()).cast("double"),
            "up": F.coalesce((c > c1).cast("double"), F.lit(0.0)),
            "down": F.coalesce((c < c1).cast("double"), F.lit(0.0)),
            "dc": c - c1,
            "dv": v - v1,
            "ret": F.try_divide(c, c1) - 1,
            "rc": F.try_divide(c, c1),
            "lv": F.ln(F.greatest(v, F.lit(0.0)) + 1 if serve else v + 1),
            "lrv": F.ln(F.try_divide(v, v1) + 1),
            "vs": F.when(v > 0, v).otherwise(F.when(usual > 0, usual).otherwise(1.0)),
        }
    )


def family(n: int, serve: bool = False, only: set[str] | None = None) -> dict[str, Column]:
    """The families over n rows, from the columns that prepared() adds."""
    o = {x: F.col(x) for x in ("h", "l", "c", "v", "t", "up", "down", "dc", "dv", "ret", "rc", "lv", "lrv", "vs")}
    c, div = o["c"], F.try_divide
    full = lambda x: F.when(F.count("c").over(w.last_rows(n)) == n, x)
    slope = full(F.regr_slope("c", "t").over(w.last_rows(n)))
    high, low = w.rolled(o["h"], n, F.max), w.rolled(o["l"], n, F.min)
    top, bottom = w.arg_extreme(o["h"], n, True), w.arg_extreme(o["l"], n, False)
    rise, fall = w.total(w.at_least_zero(o["dc"]), n), w.total(w.at_least_zero(-o["dc"]), n)
    moved = w.total(F.abs("dc"), n) + TINY
    vrise, vfall = w.total(w.at_least_zero(o["dv"]), n), w.total(w.at_least_zero(-o["dv"]), n)
    vmoved = w.total(F.abs("dv"), n) + TINY
    weighted = F.abs("ret") * o["v"]
    corr = lambda x, y: F.coalesce(w.correlation(x, y, n), full(F.lit(0.0))) if serve else w.correlation(x, y, n)
    spread = full(F.var_samp("c").over(w.last_rows(n))) * (n - 1)
    out = {
        "ROC": div(w.lag("c", n), c),
        "MA": div(w.mean(c, n), c),
        "STD": div(w.deviation(c, n), c),
        "BETA": div(slope, c),
        "RSQR": F.when(spread >= 1e-12, F.regr_r2("c", "t").over(w.last_rows(n))),
        "RESI": div(c - (w.mean(c, n) + slope * ((n - 1) / 2)), c),
        "MAX": div(high, c),
        "MIN": div(low, c),
        "QTLU": div(w.quantile(c, n, 0.8), c),
        "QTLD": div(w.quantile(c, n, 0.2), c),
        "RANK": (w.rank_top if serve else w.rank_average)(c, n),
        "RSV": (c - low) / (high - low + TINY),
        "IMAX": top / n,
        "IMIN": bottom / n,
        "IMXD": (top - bottom) / n,
        "CORR": corr(c, o["lv"]),
        "CORD": corr(o["rc"], o["lrv"]),
        "CNTP": w.mean(o["up"], n),
        "CNTN": w.mean(o["down"], n),
        "CNTD": w.mean(o["up"], n) - w.mean(o["down"], n),
        "SUMP": rise / moved,
        "SUMN": fall / moved,
        "SUMD": (rise - fall) / moved,
        "VMA": w.mean(o["v"], n) / o["vs"],
        "VSTD": w.deviation(o["v"], n) / o["vs"],
        "WVMA": w.deviation(weighted, n) / (w.mean(weighted, n) + TINY),
        "VSUMP": vrise / vmoved,
        "VSUMN": vfall / vmoved,
        "VSUMD": (vrise - vfall) / vmoved,
    }
    return {f"{k}{n}": x for k, x in out.items() if only is None or k in only}


def features(bars: DataFrame, grain: str = "train", only: set[str] | None = None, sizes: tuple[int, ...] = WINDOWS) -> DataFrame:
    """sym, d and the features of every bar (``only`` some of the families). One shuffle and one sort by symbol."""
    serve = grain == "serve"
    cols = (shape(serve) if only is None else {}) | {k: x for n in sizes for k, x in family(n, serve, only).items()}
    out = prepared(bars, serve).select("sym", "d", "t", *(x.alias(k) for k, x in cols.items()))
    return (out.where(F.col("t") > WARM_UP) if serve else out).drop("t")
