"""Registered queries over the driver's tables, each with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import windows as w
from tessera.operators import asof, labels, normalize, rolling
from tessera.plans import sql
from tessera.sources import tables as t

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if oracle:
            ORACLES[name or f.__name__] = oracle
        return f

    return add


def rounded(df: DataFrame, digits: int = 6, bump: float = 0.0) -> DataFrame:
    """Doubles rounded, so that sums in another order give the same value; + 0.0 turns a negative zero. ``bump`` moves
    simple fractions off the half, where engines round differently."""
    return df.select(*((F.round(F.col(c) + bump, digits) + 0.0).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes))


@query(f"WITH {sql.BARS} SELECT sym, d, round(o, 6) AS o, round(h, 6) AS h, round(l, 6) AS l, round(c, 6) AS c, round(v, 6) AS v FROM bars")
def bars_daily(spark, d):
    return rounded(t.bars_daily(spark, d))


KBAR_SQL = f"""WITH {sql.BARS}, x AS (SELECT *, h - l + 1e-12 AS span, greatest(o, c) AS top, least(o, c) AS bottom FROM bars)
SELECT sym, d, round((c - o) / o, 6) + 0.0 AS KMID, round((h - l) / o, 6) AS KLEN, round((c - o) / span, 6) + 0.0 AS KMID2, round((h - top) / o, 6) AS KUP,
  round((h - top) / span, 6) AS KUP2, round((bottom - l) / o, 6) AS KLOW, round((bottom - l) / span, 6) AS KLOW2, round((2 * c - h - l) / o, 6) + 0.0 AS KSFT,
  round((2 * c - h - l) / span, 6) + 0.0 AS KSFT2, round(o / c, 6) AS OPEN0, round(h / c, 6) AS HIGH0, round(l / c, 6) AS LOW0, round((o + h + l + c) / 4 / c, 6) AS VWAP0 FROM x"""


@query(KBAR_SQL)
def kbar_price(spark, d):
    return rounded(t.bars_daily(spark, d).select("sym", "d", *(x.alias(k) for k, x in rolling.shape().items())))


for _name, _only, _sizes in (
    ("roll_roc_ma_std", {"ROC", "MA", "STD"}, rolling.WINDOWS),
    ("roll_ols", {"BETA", "RSQR", "RESI"}, rolling.WINDOWS),
    ("roll_minmax_quantile", {"MAX", "MIN", "QTLU", "QTLD", "RSV"}, rolling.WINDOWS),
    ("roll_rank_avg", {"RANK"}, rolling.WINDOWS),
    ("roll_argmax", {"IMAX", "IMIN", "IMXD"}, rolling.WINDOWS),
    ("roll_corr_cord", {"CORR", "CORD"}, rolling.WINDOWS),
    ("roll_updown", {"CNTP", "CNTN", "CNTD"}, rolling.WINDOWS),
    ("roll_sum_ratio", {"SUMP", "SUMN", "SUMD"}, rolling.WINDOWS),
    ("roll_volume", {"VMA", "VSTD", "WVMA", "VSUMP", "VSUMN", "VSUMD"}, rolling.WINDOWS),
):
    query(sql.rolling(_only, _sizes), _name)(lambda spark, d, only=_only, sizes=_sizes: rounded(rolling.features(t.bars_daily(spark, d), only=only, sizes=sizes), bump=1e-9))


_SHAPE = {"KMID": "(c - o) / o", "KLEN": "(h - l) / o", "KMID2": "(c - o) / span", "KUP": "(h - top) / o", "KUP2": "(h - top) / span", "KLOW": "(bottom - l) / o", "KLOW2": "(bottom - l) / span", "KSFT": "(2 * c - h - l) / o", "KSFT2": "(2 * c - h - l) / span", "OPEN0": "o / c", "HIGH0": "h / c", "LOW0": "l / c", "VWAP0": "(o + h + l + c) / 4 / c"}
ALL_158 = [*((x, k) for k, x in _SHAPE.items()), *((x, f"{k}{n}") for n in rolling.WINDOWS for k, x in sql.family(n).items())]
SHAPED = "qs AS (SELECT *, h - l + 1e-12 AS span, greatest(o, c) AS top, least(o, c) AS bottom FROM q)"


@query(f"WITH {sql.BARS}, {sql.PREPARED}, {SHAPED} SELECT sym, d, {', '.join(f'round({x} + 1e-9, 6) + 0.0 AS {k}' for x, k in ALL_158)} FROM qs {sql.windows(rolling.WINDOWS)}")
def features_158_train(spark, d):
    return rounded(rolling.features(t.bars_daily(spark, d)), bump=1e-9)


def _serve(x: str, name: str) -> str:
    """A feature in the serving grain: ties take the highest rank, constant legs give 0, as do bars without a price."""
    kind = name.rstrip("0123456789")
    n = int(name[len(kind) :] or 0)
    full = lambda y: sql.gated(y, "c", n)
    if kind == "RANK":
        return full(f"len(list_filter(list(c) OVER w{n}, lambda y: y <= c)) / {float(n)}")
    if kind in ("CORR", "CORD"):
        return f"coalesce({x}, {full('0.0')})"
    zero = next((k for k in "oc" if name in _SHAPE and x.endswith(f"/ {k}")), None)
    return f"CASE WHEN {zero} = 0 THEN 0 ELSE {x} END" if zero else x


_PREPARED = sql.PREPARED.replace("avg(v) OVER (s ROWS 19 PRECEDING)", "avg(CASE WHEN v > 0 THEN v END) OVER (s ROWS 19 PRECEDING)").replace("ln(v + 1)", "ln(greatest(v, 0) + 1)")


@query(f"WITH {sql.BARS}, {_PREPARED}, {SHAPED}, f AS (SELECT sym, d, t, {', '.join(f'round({_serve(x, k)} + 1e-9, 6) + 0.0 AS {k}' for x, k in ALL_158)} FROM qs {sql.windows(rolling.WINDOWS)}) SELECT * EXCLUDE (t) FROM f WHERE t > 69")
def features_158_serve(spark, d):
    return rounded(rolling.features(t.bars_daily(spark, d), "serve"), bump=1e-9)


_rank = sql.gated("len(list_filter(list(c) OVER w20, lambda y: y <= c)) / 20.0", "c", 20)


@query(f"WITH {sql.BARS}, {sql.PREPARED}, r AS (SELECT sym, d, t, round({_rank} + 1e-9, 6) AS RANK20 FROM q {sql.windows((20,))}) SELECT sym, d, RANK20 FROM r WHERE t > 69")
def roll_rank_max(spark, d):
    return rounded(rolling.features(t.bars_daily(spark, d), "serve", {"RANK"}, (20,)), bump=1e-9)


def _ahead(n: int) -> str:
    return f"round((lead(c, {n}) OVER s / c - 1) - (lead(m, {n}) OVER s / m - 1), 6) + 0.0 AS fwd_{n}d_excess"


@query(f"""WITH {sql.BARS}, {sql.MARKET}, x AS (
  SELECT sym, b.d, b.c, CASE WHEN date_diff('day', m.d, b.d) <= 5 THEN m.c END AS m FROM bars b ASOF LEFT JOIN mkt m ON b.d >= m.d
) SELECT sym, d, {', '.join(map(_ahead, (5, 20, 60)))} FROM x WINDOW s AS (PARTITION BY sym ORDER BY d)""")
def fwd_excess_asof(spark, d):
    return rounded(labels.excess_asof(t.bars_daily(spark, d), t.market_daily(spark, d)))


@query(f"""WITH {sql.BARS}, {sql.MARKET}, m AS (SELECT d, lead(c, 60) OVER (ORDER BY d) / c - 1 AS r FROM mkt),
x AS (SELECT sym, d, lead(c, 60) OVER (PARTITION BY sym ORDER BY d) / c - 1 AS own FROM bars)
SELECT sym, x.d, round(own - r, 6) + 0.0 AS fwd_60d_excess_raw FROM x LEFT JOIN m ON x.d = m.d""")
def fwd_excess_exact(spark, d):
    return rounded(labels.excess_exact(t.bars_daily(spark, d), t.market_daily(spark, d)))


_cal = ", ".join(
    f"round(b{n}.c / b.c - 1, 6) + 0.0 AS fwd_{n}d, CASE WHEN b{n}.c IS NOT NULL THEN b.d + {n + 1} END AS available_after_{n}d, "
    f"CASE WHEN b.sym <> 'Brand#11' THEN round((b{n}.c / b.c - 1) - (m{n}.c / m.c - 1), 6) + 0.0 END AS fwd_{n}d_excess"
    for n in (1, 5, 20)
)
_calj = " ".join(f"LEFT JOIN bars b{n} ON b{n}.sym = b.sym AND b{n}.d = b.d + {n} LEFT JOIN bars m{n} ON m{n}.sym = 'Brand#11' AND m{n}.d = b.d + {n}" for n in (1, 5, 20))


@query(f"WITH {sql.BARS} SELECT b.sym, b.d, {_cal} FROM bars b LEFT JOIN bars m ON m.sym = 'Brand#11' AND m.d = b.d {_calj}")
def fwd_calendar(spark, d):
    return rounded(labels.calendar_forward(t.bars_daily(spark, d), benchmark="Brand#11"))


@query(f"""WITH {sql.BARS}, x AS (SELECT sym, d, c / lag(c) OVER (PARTITION BY sym ORDER BY d) - 1 AS r FROM bars)
SELECT sym, d, round((r - avg(r) OVER w) / (stddev_samp(r) OVER w + 1e-12), 6) + 0.0 AS z, round(coalesce(r, median(r) OVER w, 0), 6) + 0.0 AS filled,
  round(CASE WHEN r IS NOT NULL THEN (rank() OVER (PARTITION BY d ORDER BY r NULLS LAST) + (count(*) OVER (PARTITION BY d, r) - 1) / 2.0) / count(r) OVER w END, 6) AS pct
FROM x WINDOW w AS (PARTITION BY d)""")
def cross_section(spark, d):
    x = t.bars_daily(spark, d).select("sym", "d", (F.try_divide("c", w.lag("c")) - 1).alias("r"))
    x = normalize.percent_rank_average(x, "r", "pct")
    return rounded(x.select("sym", "d", normalize.label_z(F.col("r")).alias("z"), normalize.median_fill(F.col("r")).alias("filled"), "pct"))


_clip = ", ".join(f"quantile_cont({c}, 0.001) AS lo_{c}, quantile_cont({c}, 0.999) AS hi_{c}" for c in "cv")
_mean = ", ".join(f"avg(least(greatest({c}, lo_{c}), hi_{c})) AS m_{c}, stddev_samp(least(greatest({c}, lo_{c}), hi_{c})) AS s_{c}" for c in "cv")
_z = ", ".join(f"round(least(greatest((least(greatest({c}, lo_{c}), hi_{c}) - m_{c}) / s_{c}, -5), 5), 6) + 0.0 AS {c}" for c in "cv")
_med = "SELECT median(abs(c - m)) AS mad FROM bars, med WHERE d < DATE '1996-01-01'"


@query(f"""WITH {sql.BARS}, tr AS (SELECT * FROM bars WHERE d < DATE '1996-01-01'), b AS (SELECT {_clip} FROM tr), s AS (SELECT {_mean} FROM tr, b),
med AS (SELECT median(c) AS m FROM tr), mad AS ({_med})
SELECT sym, d, {_z}, round(least(greatest((c - m) / greatest(1.4826 * mad, 1e-9), -3), 3), 6) + 0.0 AS rz FROM bars, b, s, med, mad""")
def train_clip_z(spark, d):
    train = F.col("d") < F.lit("1996-01-01").cast("date")
    x = normalize.robust_z(t.bars_daily(spark, d).select("sym", "d", "c", "v"), "c", train, "rz")
    return rounded(normalize.train_clip_z(x, ["c", "v"], train))


_EARN = "earn AS (SELECT o_custkey AS sym, CAST(o_orderdate AS DATE) AS d, max(o_totalprice) AS x FROM orders GROUP BY 1, 2)"
_ROWS = "rows_ AS (SELECT DISTINCT user_id AS sym, CAST(ts AS DATE) - 9500 AS d FROM events)"


def _earn(spark, d):
    return t.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("sym"), F.col("o_orderdate").cast("date").alias("d")).agg(F.max("o_totalprice").alias("x"))


def _asked(spark, d):
    return t.table(spark, d, "events").select(F.col("user_id").alias("sym"), F.date_sub(F.col("ts").cast("date"), 9500).alias("d")).distinct()


for _name, _op, _kw, _ok in (("asof_backward", ">=", {}, "TRUE"), ("asof_strict", ">", {"exact": False}, "TRUE"), ("asof_tolerance_days", ">=", {"days": 30}, "date_diff('day', e.d, r.d) <= 30")):
    query(f"WITH {_EARN}, {_ROWS} SELECT r.sym, r.d, CASE WHEN {_ok} THEN e.x END AS x FROM rows_ r ASOF LEFT JOIN earn e ON r.sym = e.sym AND r.d {_op} e.d", _name)(
        lambda spark, d, kw=_kw: asof.asof_join(_asked(spark, d), _earn(spark, d), **kw)
    )


@query(f"""WITH {sql.BARS}, {sql.MARKET}, x AS (SELECT sym, b.d, m.d AS md, m.c AS m FROM bars b ASOF LEFT JOIN mkt m ON b.d >= m.d),
y AS (SELECT *, count(*) OVER (PARTITION BY sym, md ORDER BY d) - max(CASE WHEN md = d THEN 1 ELSE 0 END) OVER (PARTITION BY sym, md) AS since FROM x)
SELECT sym, d, round(CASE WHEN since <= 2 THEN m END, 6) AS m FROM y""")
def asof_row_limit(spark, d):
    bars = t.bars_daily(spark, d).select("sym", "d")
    return rounded(asof.asof_join(bars, t.market_daily(spark, d).withColumnRenamed("c", "m"), None, rows=2))


@query(f"""WITH {sql.BARS}, {sql.MARKET}, x AS (
  SELECT sym, b.d, CASE WHEN count(b.c) OVER w20 >= 20 THEN avg(b.c) OVER w20 / b.c END AS MA20, CASE WHEN count(b.c) OVER w20 >= 20 THEN stddev_samp(b.c) OVER w20 / b.c END AS STD20,
    lag(b.c, 20) OVER s / b.c AS ROC20, lead(b.c, 5) OVER s / b.c - 1 AS fwd_5d
  FROM bars b WINDOW s AS (PARTITION BY sym ORDER BY b.d), w20 AS (PARTITION BY sym ORDER BY b.d ROWS 19 PRECEDING)
) SELECT sym, d, round(MA20, 6) AS MA20, round(STD20, 6) AS STD20, round(ROC20, 6) AS ROC20, round(fwd_5d, 6) + 0.0 AS fwd_5d FROM x WHERE MA20 IS NOT NULL AND ROC20 IS NOT NULL AND fwd_5d IS NOT NULL""")
def momentum_slice(spark, d):
    """The flagship: windows over daily bars with a forward label, in one shuffle."""
    bars = t.bars_daily(spark, d).withColumn("fwd_5d", F.try_divide(w.lead("c", 5), "c") - 1)
    c = F.col("c")
    out = bars.select("sym", "d", F.try_divide(w.mean(c, 20), c).alias("MA20"), F.try_divide(w.deviation(c, 20), c).alias("STD20"), F.try_divide(w.lag("c", 20), c).alias("ROC20"), "fwd_5d")
    return rounded(out.dropna())
