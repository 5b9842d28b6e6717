"""The seam to a vendor: a caller's function as a Spark data source, read in parallel as a batch or as a stream.

``spark.read.format("vendor")`` with the options ``function`` ("module:name"), ``schema`` (DDL), ``names`` (symbols, comma between
them), ``start``, ``end`` (days, both included) and ``days`` (of one request). A request is a symbol and a range of at most so many
days; each is a partition of its own, and a task calls ``function(symbol, start, end, options)`` for it, which yields tuples in the
schema's order. As a stream, the offset is the last day read: a batch asks for the days after it up to the day that
``function.latest(options)`` names. Only the function knows the vendor; time-outs and retries are Spark's task retries.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from importlib import import_module

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition


class Request(InputPartition):
    def __init__(self, symbol: str, start: dt.date, end: dt.date):
        self.symbol, self.start, self.end = symbol, start, end


def function_of(options: dict):
    module, _, name = options["function"].partition(":")
    return getattr(import_module(module), name)


def requests(options: dict, start: dt.date, end: dt.date) -> list[Request]:
    """A request for each symbol and range of days; symbols in upper case, each once, in the order given."""
    size = dt.timedelta(days=int(options.get("days", 366)))
    names = dict.fromkeys(x.strip().upper() for x in options["names"].split(",") if x.strip())
    out = []
    for name in names:
        at = start
        while at <= end:
            last = min(end, at + size - dt.timedelta(days=1))
            out.append(Request(name, at, last))
            at = last + dt.timedelta(days=1)
    return out


class _Calls:
    def __init__(self, options: dict):
        self.options = options

    def read(self, partition: Request) -> Iterator[tuple]:
        yield from function_of(self.options)(partition.symbol, partition.start, partition.end, self.options)


class Batch(_Calls, DataSourceReader):
    def partitions(self) -> list[Request]:
        day = dt.date.fromisoformat
        return requests(self.options, day(self.options["start"]), day(self.options["end"]))


class Stream(_Calls, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"through": str(dt.date.fromisoformat(self.options["start"]) - dt.timedelta(days=1))}

    def latestOffset(self) -> dict:
        return {"through": str(function_of(self.options).latest(self.options))}

    def partitions(self, start: dict, end: dict) -> list[Request]:
        day = dt.date.fromisoformat
        return requests(self.options, day(start["through"]) + dt.timedelta(days=1), day(end["through"]))

    def commit(self, end: dict) -> None:
        """Nothing is kept on the vendor's side."""


class Vendor(DataSource):
    @classmethod
    def name(cls) -> str:
        return "vendor"

    def schema(self) -> str:
        return self.options["schema"]

    def reader(self, schema) -> Batch:
        return Batch(self.options)

    def streamReader(self, schema) -> Stream:
        return Stream(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Vendor)


def trades(symbol: str, start: dt.date, end: dt.date, options: dict) -> Iterator[tuple]:
    """A stand-in vendor: (sym, d, n, value) of the orders that a customer segment ``symbol`` placed on each day of a range, read
    from the Parquet files under ``options["path"]``."""
    import pyarrow.compute as pc
    import pyarrow.dataset as ds

    customers = ds.dataset(f"{options['path']}/customer.parquet").to_table(columns=["c_custkey"], filter=pc.field("c_mktsegment") == symbol)
    days = (pc.field("o_orderdate") >= dt.datetime.combine(start, dt.time())) & (pc.field("o_orderdate") < dt.datetime.combine(end + dt.timedelta(days=1), dt.time()))
    orders = ds.dataset(f"{options['path']}/orders.parquet").to_table(columns=["o_orderdate", "o_totalprice"], filter=days & pc.field("o_custkey").isin(customers["c_custkey"]))
    table = orders.append_column("d", pc.cast(orders["o_orderdate"], "date32")).group_by("d").aggregate([("o_totalprice", "count"), ("o_totalprice", "sum")])
    for d, n, value in zip(*(table[c].to_pylist() for c in ("d", "o_totalprice_count", "o_totalprice_sum")), strict=True):
        yield symbol, d, n, value
