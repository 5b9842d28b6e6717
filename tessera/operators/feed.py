"""A daily feed of fundamental ratios in which every value says when it was known and which period it reports on.

Facts become one row for each filer and period, filers become symbols (one filer may have several share classes), and
filings, prices and the days to serve become one stream for each symbol. One window over that stream carries each concept
forward together with its provenance, so the as-of join, the carry-forward and the prices take one exchange by symbol.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalars import finite, oldest, safe_ratio

#: Public XBRL tags, in the order in which one stands in for another.
INCOME, GROSS_PROFIT, ASSETS = ["NetIncomeLoss"], ["GrossProfit"], ["Assets"]
EQUITY = ["StockholdersEquity", "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest"]
SHARES = ["CommonStockSharesOutstanding", "CommonStockSharesIssued", "WeightedAverageNumberOfDilutedSharesOutstanding", "WeightedAverageNumberOfSharesOutstandingBasic"]
REVENUE = ["Revenues", "RevenueFromContractWithCustomerExcludingAssessedTax"]
COST = ["CostOfRevenue", "CostOfGoodsAndServicesSold"]
CONCEPTS = [*INCOME, *GROSS_PROFIT, *ASSETS, *EQUITY, *SHARES, *REVENUE, *COST]
FEATURES = ["earnings_yield", "book_to_price", "gross_profitability", "roe", "asset_growth"]
PRICED = ["earnings_yield", "book_to_price"]
#: Days after a period's end at which a report without any date counts as filed; least coverage of each
#: feature among the names it can have, and among all names; least share of priced names; greatest age of a source.
FALLBACK_DAYS = 60
FLOORS = {"earnings_yield": 0.6, "book_to_price": 0.6, "gross_profitability": 0.5, "roe": 0.6, "asset_growth": 0.6}
UNIVERSE_FLOORS = {"earnings_yield": 0.3, "book_to_price": 0.3, "gross_profitability": 0.5, "roe": 0.8, "asset_growth": 0.8}
PRICE_FLOOR, MAX_AGE_DAYS = 0.5, 150


def accepted_days(accepted: DataFrame) -> DataFrame:
    """accepted (sym, period_end, accepted, filed) -> (sym, period_end, accepted): the later of a filing's two dates, the
    latest of all filings for the period. Dates before the period's end are no dates."""
    day = F.greatest(F.col("accepted").cast("date"), F.col("filed").cast("date"))
    rows = accepted.select(F.upper("sym").alias("sym"), F.col("period_end").cast("date").alias("period_end"), day.alias("accepted"))
    return rows.where("accepted >= period_end").groupBy("sym", "period_end").agg(F.max("accepted").alias("accepted"))


def quarterly(facts: DataFrame, ciks: DataFrame | None = None, accepted: DataFrame | None = None, concepts: list[str] = CONCEPTS) -> DataFrame:
    """facts (sym or cik, period_end, concept, filed, val) -> (sym, period_end, a column for each concept, available, source).

    Of several values of a concept the one filed last counts, an undated one as the last of all, the greatest of equals.
    ``available`` is the last filing day among the values used (source "filed"), else the vendor's day ("accepted"), else
    FALLBACK_DAYS after the period ("expected"). ``ciks`` (cik, sym) gives a filer's rows to each of its symbols, after they
    have been aggregated. A period whose values are all null keeps its row.
    """
    key = "sym" if ciks is None else "cik"
    newest = lambda c: F.max(F.when((F.col("concept") == c) & F.col("val").isNotNull(), F.struct(F.col("filed").isNull().alias("undated"), F.col("filed").cast("date").alias("filed"), "val")))
    wide = facts.groupBy(key, "period_end").agg(*(newest(c).alias(c) for c in concepts))
    filed = F.greatest(*(F.col(f"{c}.filed") for c in concepts))
    wide = wide.select(key, "period_end", *(F.col(f"{c}.val").alias(c) for c in concepts), filed.alias("filed"))
    if ciks is not None:
        wide = wide.join(ciks.select("cik", "sym").where("sym is not null").distinct(), "cik").drop("cik")
    wide = wide.where("sym is not null").withColumn("sym", F.upper("sym"))
    if accepted is None:
        wide = wide.withColumn("accepted", F.lit(None).cast("date"))
    else:
        wide = wide.join(accepted_days(accepted), ["sym", "period_end"], "left")
    source = F.when(F.col("filed").isNotNull(), "filed").when(F.col("accepted").isNotNull(), "accepted").otherwise("expected")
    available = F.coalesce("filed", "accepted", F.date_add("period_end", FALLBACK_DAYS))
    return wide.select("sym", "period_end", *concepts, available.alias("available"), source.alias("source"))


def serving_days(prices: DataFrame, filings: DataFrame) -> DataFrame:
    """(sym, d): every day on which some symbol has a price, for each symbol that has both a price and a filing."""
    names = prices.select("sym").distinct().join(filings.select("sym").distinct(), "sym", "left_semi")
    days = prices.agg(F.collect_set("d").alias("days"))  # at most one for each day of a calendar
    return names.join(F.broadcast(days), F.lit(True)).select("sym", F.explode("days").alias("d"))


def carried(filings: DataFrame, prices: DataFrame, days: DataFrame, concepts: list[str] = CONCEPTS) -> DataFrame:
    """(sym, d, price, report, a struct for each concept) on each of the ``days``.

    A concept's struct (val, available, period_end) is the last one known by the day in order of availability, then of
    period, with the filing that it came from, which need not be the last; ``report`` is the last filing itself
    (period_end, available, source), whatever it holds."""
    known = [F.when(F.col(c).isNotNull(), F.struct(F.col(c).cast("double").alias("val"), "available", "period_end")).alias(c) for c in concepts]
    rows = filings.select("sym", F.col("available").alias("d"), F.lit(0).alias("_kind"), F.col("period_end").alias("_end"), F.struct("period_end", "available", "source").alias("report"), *known)
    closes = prices.select("sym", "d", F.lit(1).alias("_kind"), F.struct(F.col("d").alias("at"), F.col("c").alias("close")).alias("_close"))
    stream = rows.unionByName(closes, allowMissingColumns=True).unionByName(days.select("sym", "d", F.lit(2).alias("_kind")), allowMissingColumns=True)
    w = Window.partitionBy("sym").orderBy("d", "_kind", "_end").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c: F.last(c, ignorenulls=True).over(w).alias(c)
    out = stream.select("sym", "d", "_kind", last("_close"), last("report"), *map(last, concepts)).where("_kind = 2")
    return out.select("sym", "d", F.when(F.col("_close.at") == F.col("d"), F.col("_close.close")).alias("price"), "report", *concepts)


def _origin(*operands: Column) -> Column:
    """(available, period_end) of the operand that was known first."""
    x = oldest(*((o["available"], o["period_end"]) for o in operands))
    return F.struct(x["available"].alias("available"), x["period_end"].alias("period_end"))


def ratios(x: DataFrame, rows: int = 252) -> DataFrame:
    """The five features of each day, each with the day its oldest operand became available, the period it reports on and its
    age in days; the day's price and the last filing. Gross profit is revenue less cost where no filing states it."""
    first = lambda tags: reduce(lambda a, b: F.coalesce(a, b), map(F.col, tags))
    income, stated, assets = (first(t) for t in (INCOME, GROSS_PROFIT, ASSETS))
    equity, shares, revenue, cost = (first(t) for t in (EQUITY, SHARES, REVENUE, COST))
    made = _origin(revenue, cost)
    made = F.struct((revenue["val"] - cost["val"]).alias("val"), made["available"].alias("available"), made["period_end"].alias("period_end"))
    profit = F.when(stated.isNotNull(), stated).otherwise(made)
    cap = shares["val"] * F.col("price")
    before = F.lag(assets["val"], rows).over(Window.partitionBy("sym").orderBy("d"))
    now = assets["val"]
    change = F.when(before != 0, now / before - 1).when((before == 0) & (now != 0), F.signum(now) * 10)  # beyond either bound
    values = {
        "earnings_yield": (safe_ratio(income["val"], cap), _origin(income, shares)),
        "book_to_price": (safe_ratio(equity["val"], cap), _origin(equity, shares)),
        "gross_profitability": (safe_ratio(profit["val"], now), _origin(profit, assets)),
        "roe": (safe_ratio(income["val"], equity["val"]), _origin(income, equity)),
        "asset_growth": (F.when(change.isNotNull(), F.least(F.greatest(change, F.lit(-0.99)), F.lit(5.0))), _origin(assets)),
    }
    x = x.select("sym", "d", "price", "report", *(v.alias(f) for f, (v, _) in values.items()), *(o.alias(f"_{f}") for f, (_, o) in values.items()))
    source = [c for f in values for c in (F.col(f"_{f}.available").alias(f"{f}_source_available_at"), F.col(f"_{f}.period_end").alias(f"{f}_source_fiscal_period_end"), F.datediff("d", F.col(f"_{f}.available")).alias(f"{f}_source_age_days"))]
    row = [F.col("report.period_end").alias("fiscal_period_end"), F.col("report.available").alias("available_at"), F.col("report.source").alias("available_source")]
    return x.select("sym", "d", *values, *source, "price", *row)


def checked(feed: DataFrame) -> DataFrame:
    """``feed``, but the job fails on a row that uses a filing before it was available or has it before its period's end. The
    check is a filter, so it runs whatever columns are read."""
    early = F.col("available_at") > F.col("d")
    odd = F.col("fiscal_period_end") > F.col("available_at")
    fail = F.when(early, F.raise_error(F.lit("a row uses a filing that was not yet available"))).when(odd, F.raise_error(F.lit("a filing was available before its period ended")))
    return feed.where(fail.cast("boolean").isNull())


def daily(facts: DataFrame, prices: DataFrame, ciks: DataFrame | None = None, accepted: DataFrame | None = None) -> DataFrame:
    """The whole feed from facts and prices (sym, d, c)."""
    filings = quarterly(facts, ciks, accepted)
    return checked(ratios(carried(filings, prices, serving_days(prices, filings))))


def verdict(feed: DataFrame, universe: DataFrame, floors: dict[str, float] = FLOORS, universe_floors: dict[str, float] = UNIVERSE_FLOORS, price_floor: float = PRICE_FLOOR, max_age: int = MAX_AGE_DAYS) -> DataFrame:
    """Coverage and freshness on the last day served, a row for each feature.

    n_have finite values are held against the names that can have the feature (those with a price where it needs one, else
    all served) and against all names of the ``universe``; n_stale of them rest on a source that is older than ``max_age``
    days. price_ok, coverage_ok and freshness_ok are verdicts of the whole feed and repeat on each row."""
    has = lambda c: finite(F.col(c)).isNotNull()
    counts = [F.struct(F.count(F.when(has(c), 1)).alias("have"), F.count(F.when(has(c) & (F.col(f"{c}_source_age_days") > max_age), 1)).alias("stale")).alias(c) for c in floors]
    by_day = feed.groupBy("d").agg(F.countDistinct("sym").alias("n_served"), F.count(F.when(has("price"), 1)).alias("n_priced"), *counts)
    last = by_day.orderBy(F.desc("d")).limit(1).crossJoin(F.broadcast(universe.select(F.countDistinct(F.upper("sym")).alias("n_universe"))))  # one row each
    share = lambda n, of: F.when(of > 0, n / of).otherwise(0.0)

    def row(c: str) -> Column:
        have, stale, expected = F.col(f"{c}.have"), F.col(f"{c}.stale"), F.col("n_priced" if c in PRICED else "n_served")
        own, all_ = share(have, expected), share(have, F.col("n_universe"))
        columns = {
            "feature": F.lit(c), "n_have": have, "n_expected": expected, "coverage": own, "min_coverage": F.lit(floors[c]), "ok": own >= floors[c],
            "universe_coverage": all_, "universe_min_coverage": F.lit(universe_floors[c]), "universe_ok": all_ >= universe_floors[c],
            "n_stale": stale, "stale_fraction": share(stale, have), "fresh_ok": stale == 0,
        }
        return F.struct(*(v.alias(k) for k, v in columns.items()))

    x = last.select("d", "n_served", "n_priced", "n_universe", share(F.col("n_priced"), F.col("n_universe")).alias("price_coverage"), F.array(*map(row, floors)).alias("rows"))
    price_ok = F.col("price_coverage") >= price_floor
    x = x.withColumns({"price_ok": price_ok, "coverage_ok": price_ok & F.forall("rows", lambda r: r["ok"] & r["universe_ok"]), "freshness_ok": F.forall("rows", lambda r: r["fresh_ok"])})
    return x.withColumn("r", F.explode("rows")).select("d", "r.*", "n_served", "n_priced", "n_universe", "price_coverage", "price_ok", "coverage_ok", "freshness_ok")
