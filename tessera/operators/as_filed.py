"""Ratios from facts as they were first filed, on the share basis of the adjusted price.

Facts become one row for each symbol, quantity and period end; trailing years, split factors and unit errors are windows
over those small tables. Eight quantities then become events of one stream for each symbol, beside the days to serve, and
one window with eight last states is the whole as-of step: one exchange by symbol.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalars import guard, safe_ratio

#: Public XBRL tags of each flow, in order of preference, and of each balance.
FLOWS = {
    "ni": ["NetIncomeLoss"],
    "gp": ["GrossProfit"],
    "rev": ["Revenues", "RevenueFromContractWithCustomerExcludingAssessedTax", "SalesRevenueNet"],
    "cost": ["CostOfRevenue", "CostOfGoodsAndServicesSold"],
}
BALANCES = {"assets": "Assets", "equity": "StockholdersEquity", "shares": "EntityCommonStockSharesOutstanding"}
#: Days of a quarter, of a year and between the ends of a trailing year's first and last quarter; least size of
#: a denominator; a share count more than SPIKE times both neighbours, or GROSS times its surroundings, is an error of units.
QUARTER, YEAR, TRAILING = (80, 100), (350, 380), (330, 400)
LEAST = {"market_cap": 1e6, "equity": 1e5, "assets": 1e5, "shares": 1e3}
SPIKE, GROSS = 1.5, 20.0
FEATURES = ["earnings_yield", "book_to_price", "roe", "gross_profitability", "asset_growth"]
TAGS = ["ni", "gp", "as", "eq", "sh", "shraw", "agn", "agl"]


def first_filed(facts: DataFrame) -> DataFrame:
    """facts (sym, concept, start, end, filed, val): of all filings of the same fact the earliest, the least value of one day.
    Rows without a symbol, concept, end, day or value, or filed before their period ended, are no facts."""
    ok = facts.where("end <= filed and val is not null and sym is not null and concept is not null")
    one = ok.groupBy("sym", "concept", "start", "end").agg(F.min(F.struct("filed", "val")).alias("x"))
    return one.select("sym", "concept", "start", "end", "x.filed", "x.val")


def by_quantity(facts: DataFrame) -> DataFrame:
    """(sym, quantity, end, q, a, i): the quarter's, the year's and the balance's (filed, val), the preferred tag first. A
    balance without a start comes before one with it."""
    place = [(c, k, n) for k, tags in FLOWS.items() for n, c in enumerate(tags)] + [(c, k, 0) for k, c in BALANCES.items()]
    of = F.create_map(*(F.lit(x) for c, k, _ in place for x in (c, k)))
    rank = F.create_map(*(F.lit(x) for c, _, n in place for x in (c, n)))
    x = facts.withColumns({"quantity": F.try_element_at(of, F.col("concept")), "rank": F.try_element_at(rank, F.col("concept")), "span": F.datediff("end", "start")}).where("quantity is not null")
    flow = F.col("quantity").isin(*FLOWS)
    best = lambda when, name: F.min(F.when(when, F.struct("rank", F.col("start").isNotNull().alias("odd"), "filed", "val"))).alias(name)
    x = x.groupBy("sym", "quantity", "end").agg(best(flow & F.col("span").between(*QUARTER), "q"), best(flow & F.col("span").between(*YEAR), "a"), best(~flow, "i"))
    return x.select("sym", "quantity", "end", *(F.when(F.col(c).isNotNull(), F.struct(f"{c}.filed", f"{c}.val")).alias(c) for c in "qai"))


def trailing(rows: DataFrame) -> DataFrame:
    """(sym, end, ni, gp): (filed, val) of the trailing year. A year that was filed wins over the sum of four quarters, which
    counts where the first and the last of them end TRAILING days apart. A missing fourth quarter is the year less the three
    that end 20 to 365 days before it. Gross profit that was not filed is revenue less cost of the same end."""
    x = rows.where("q is not null or a is not null").withColumn("n", F.datediff("end", F.lit("1970-01-01").cast("date")))
    by = Window.partitionBy("sym", "quantity")
    inside = by.orderBy("n").rangeBetween(-365, -20)
    three = F.count("q").over(inside) == 3
    fourth = F.struct(F.greatest(F.col("a.filed"), F.max("q.filed").over(inside)).alias("filed"), (F.col("a.val") - F.sum("q.val").over(inside)).alias("val"))
    x = x.withColumn("fourth", F.when(F.col("q").isNull() & F.col("a").isNotNull() & three, fourth)).withColumn("x", F.coalesce("q", "fourth"))
    last = Window.partitionBy("sym", "quantity", F.col("x").isNotNull()).orderBy("n")
    four = last.rowsBetween(-3, 0)
    whole = (F.count("x").over(four) == 4) & (F.col("n") - F.lag("n", 3).over(last)).between(*TRAILING)
    summed = F.when(whole, F.struct(F.max("x.filed").over(four).alias("filed"), F.sum("x.val").over(four).alias("val")))
    x = x.select("sym", "quantity", "end", F.coalesce("a", summed).alias("x")).where("x is not null")
    wide = x.groupBy("sym", "end").agg(*(F.max(F.when(F.col("quantity") == k, F.col("x"))).alias(k) for k in FLOWS))
    made = F.when(F.col("rev").isNotNull() & F.col("cost").isNotNull(), F.struct(F.greatest("rev.filed", "cost.filed").alias("filed"), (F.col("rev.val") - F.col("cost.val")).alias("val")))
    return wide.select("sym", "end", "ni", F.coalesce("gp", made).alias("gp"))


def factor_at(asked: DataFrame, factors: DataFrame, splits: DataFrame) -> DataFrame:
    """asked (sym, d, ...) with ``fac``, the last of the factors (sym, d, factor) by the day. A day before a symbol's first
    factor takes that one times the ratios of the splits (sym, d, ratio) after the day and up to the first factor's: a
    running product from the end, so no day meets a list of splits. Null for a symbol without factors."""
    known = factors.select("sym", "d", F.struct("d", "factor").alias("_f"))
    events = known.unionByName(splits.select("sym", "d", F.col("ratio").cast("double").alias("_r")), allowMissingColumns=True)
    stream = asked.withColumn("_ask", F.lit(1)).unionByName(events.withColumn("_ask", F.lit(0)), allowMissingColumns=True).withColumn("_n", F.datediff("d", F.lit("1970-01-01").cast("date")))
    by = Window.partitionBy("sym")
    x = stream.withColumns({"_first": F.min("_f").over(by), "_last": F.last("_f", ignorenulls=True).over(by.orderBy("_n", "_ask").rowsBetween(Window.unboundedPreceding, 0))})
    later = by.orderBy(-F.col("_n")).rangeBetween(Window.unboundedPreceding, -1)
    ahead = F.product(F.when(F.col("d") <= F.col("_first.d"), F.col("_r"))).over(later)
    x = x.withColumn("fac", F.coalesce(F.col("_last.factor"), F.col("_first.factor") * F.coalesce(ahead, F.lit(1.0)))).where("_ask = 1")
    return x.select(*asked.columns, "fac")


def share_counts(rows: DataFrame, factors: DataFrame, splits: DataFrame) -> DataFrame:
    """(sym, end, filed, shares, adjusted): counts as filed and on the basis of the adjusted price; ``adjusted`` is null for
    errors of units: lone spikes, and counts far off the median of the seven around them."""
    x = rows.where("quantity = 'shares' and i is not null").select("sym", F.col("end").alias("d"), "i.filed", F.col("i.val").alias("shares"))
    x = factor_at(x, factors, splits).withColumn("adj", F.col("shares") * F.col("fac"))
    w = Window.partitionBy("sym").orderBy("d")
    prev, after, around = F.lag("adj").over(w), F.lead("adj").over(w), w.rowsBetween(-3, 3)
    local = F.when(F.count("adj").over(around) >= 3, F.percentile("adj", F.lit(0.5)).over(around))
    x = x.withColumns({"prev": prev, "after": after, "local": local})
    off = lambda a, of, times: F.coalesce((of != 0) & (a / F.nullif(of, F.lit(0.0)) > times), F.lit(False)) | F.coalesce((of == 0) & (a > 0), F.lit(False))
    below = lambda a, of, times: F.coalesce(a / F.nullif(of, F.lit(0.0)) < 1 / times, F.lit(False))
    a = F.col("adj")
    spike = (off(a, F.col("prev"), SPIKE) & off(a, F.col("after"), SPIKE)) | (below(a, F.col("prev"), SPIKE) & below(a, F.col("after"), SPIKE))
    gross = off(a, F.col("local"), GROSS) | below(a, F.col("local"), GROSS)
    return x.select("sym", F.col("d").alias("end"), "filed", "shares", F.when(~(spike | gross), a).alias("adjusted"))


def _events(df: DataFrame, **values: tuple[Column, Column]) -> DataFrame:
    """(sym, d, end, tag, val): each value from the day after it was filed."""
    parts = [F.struct(F.lit(tag).alias("tag"), F.date_add(filed, 1).alias("d"), val.cast("double").alias("val")) for tag, (filed, val) in values.items()]
    x = df.select("sym", "end", F.explode(F.array(*parts)).alias("x")).select("sym", "x.d", "end", "x.tag", "x.val")
    return x.where("d is not null and val is not null")


def panel(facts: DataFrame, prices: DataFrame, factors: DataFrame, splits: DataFrame, failed: DataFrame) -> DataFrame:
    """The as-filed panel of prices (sym, d, c) for symbols with facts: share counts, market value, five features, and for each the
    day it became available, the period it reports on and its age. ``failed`` (sym): symbols whose split basis is unknown; what
    rests on their shares is null. The job fails on a value used before it was available."""
    clean = first_filed(facts)
    rows = by_quantity(clean)
    flows = trailing(rows)
    held = rows.where("quantity in ('assets', 'equity') and i is not null")
    w = Window.partitionBy("sym", "quantity").orderBy("end")
    year = F.datediff("end", F.lag("end", 4).over(w)).between(*TRAILING)
    held = held.withColumn("before", F.when((F.col("quantity") == "assets") & year, F.lag("i.val", 4).over(w)))
    own, filed, val = F.col("quantity"), F.col("i.filed"), F.col("i.val")
    shares = share_counts(rows, factors, splits)
    known = F.col("before").isNotNull()
    events = (
        _events(flows, ni=(F.col("ni.filed"), F.col("ni.val")), gp=(F.col("gp.filed"), F.col("gp.val")))
        .union(_events(held, eq=(filed, F.when(own == "equity", val)), agn=(filed, F.when(known, val)), agl=(filed, F.col("before")), **{"as": (filed, F.when(own == "assets", val))}))
        .union(_events(shares, sh=(F.col("filed"), F.col("adjusted")), shraw=(F.col("filed"), F.col("shares"))))
    )
    days = prices.join(clean.select("sym").distinct(), "sym", "left_semi").select("sym", "d", F.col("c").alias("price"), F.lit(1).alias("_day"))
    stream = events.withColumn("_day", F.lit(0)).unionByName(days, allowMissingColumns=True)
    last = Window.partitionBy("sym").orderBy("d", "_day", "end").rowsBetween(Window.unboundedPreceding, 0)
    state = lambda tag: F.last(F.when(F.col("tag") == tag, F.struct("val", F.col("d").alias("av"), F.col("end").alias("fpe"))), ignorenulls=True).over(last).alias(tag)
    x = stream.select("sym", "d", "price", "_day", *map(state, TAGS)).where("_day = 1")
    x = x.join(failed.select("sym", F.lit(True).alias("_failed")).distinct(), "sym", "left")
    return _features(_checked(x))


def _features(x: DataFrame) -> DataFrame:
    v = lambda tag: F.col(f"`{tag}`.val")
    count = F.when(F.col("_failed").isNull(), guard(v("sh"), LEAST["shares"], True))
    raw = guard(v("shraw"), LEAST["shares"], True)
    x = x.withColumns({"shares_asfiled": raw, "shares_adj": count})
    x = x.withColumns({"market_cap": guard(F.col("shares_adj") * F.col("price"), LEAST["market_cap"], True), "market_cap_asfiled": guard(F.col("shares_asfiled") * F.col("price"), LEAST["market_cap"], True)})
    cap = F.col("market_cap")
    growth = safe_ratio(v("agn"), guard(v("agl"), LEAST["assets"], True)) - 1
    values = {
        "earnings_yield": (safe_ratio(v("ni"), cap), ["ni", "sh"], ["ni"]),
        "book_to_price": (safe_ratio(guard(v("eq"), LEAST["equity"]), cap), ["eq", "sh"], ["eq"]),
        "roe": (safe_ratio(v("ni"), guard(v("eq"), LEAST["equity"], True)), ["ni", "eq"], ["ni", "eq"]),
        "gross_profitability": (safe_ratio(v("gp"), guard(v("as"), LEAST["assets"], True)), ["gp", "as"], ["gp", "as"]),
        "asset_growth": (F.when(growth.isNotNull(), F.least(F.greatest(growth, F.lit(-0.99)), F.lit(5.0))), ["agn"], ["agn"]),
    }
    latest = lambda tags, part: F.greatest(*c) if len(c := [F.col(f"`{t}`.{part}") for t in tags]) > 1 else c[0]
    x = x.withColumns({f: value for f, (value, _, _) in values.items()})
    origin = {}
    for f, (_, available, period) in values.items():
        there = F.col(f).isNotNull()
        origin[f"{f}_available_at"] = F.when(there, latest(available, "av"))
        origin[f"{f}_fiscal_period_end"] = F.when(there, latest(period, "fpe"))
        origin[f"{f}_age_days"] = F.when(there, F.datediff("d", latest(available, "av")))
    return x.select("sym", "d", "price", "shares_asfiled", "shares_adj", "market_cap", "market_cap_asfiled", *values, *(c.alias(k) for k, c in origin.items()))


def _checked(x: DataFrame) -> DataFrame:
    """A filter that holds for every row or fails the job, so no pruning of columns passes it by; it reads the states alone."""
    bad = [F.coalesce((F.col(f"`{k}`.av") > F.col("d")) | (F.col(f"`{k}`.av") < F.col(f"`{k}`.fpe")), F.lit(False)) for k in TAGS]
    early = F.exists(F.array(*bad), lambda b: b)
    return x.where(F.when(early, F.raise_error(F.lit("a value is used before it was available, or was available before its period ended"))).cast("boolean").isNull())
