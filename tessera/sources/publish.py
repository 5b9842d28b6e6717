"""A partitioned Parquet table that is published all or nothing, a few partitions at a time.

A publish writes the new partitions beside the table (folder ``_next``), checks them there, and then puts down one commit
file. Until that file exists the table is the old one; from then on it is the new one: moving the partitions in is only
carrying out the commit, and whoever opens the table next carries out what a lost driver has left. A rerun of the same
publish gives the same table. The result stays a plain table that Spark reads by its path; folders whose names begin with an
underscore are not read.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources import tables

NEXT, COMMIT = "_next", "_commit.json"


class PublishError(RuntimeError):
    """What was written does not pass its checks; the table is as it was."""


class Table:
    """``path``: the table's folder; ``by``: its partition column; ``keys``: what names a row."""

    def __init__(self, spark: SparkSession, path: str, by: str, keys: list[str]):
        self.spark, self.path, self.by, self.keys = spark, path.rstrip("/"), by, keys
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())
        self.recover()

    def _at(self, *parts: str):
        return self._hadoop.Path("/".join([self.path, *(p for p in parts if p)]))

    def _folders(self, *parts: str) -> list[str]:
        at = self._at(*parts)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at) if s.isDirectory() and not s.getPath().getName().startswith("_")) if self._fs.exists(at) else []

    def recover(self) -> None:
        """Carry out a commit that was put down, or drop what was written without one."""
        if self._fs.exists(self._at(COMMIT)):
            self._move(json.loads(self._read(COMMIT)))
        elif self._fs.exists(self._at(NEXT)):
            self._fs.delete(self._at(NEXT), True)

    def _read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _move(self, names: list[str]) -> None:
        for name in names:  # one that is no longer there has been moved
            if self._fs.exists(self._at(NEXT, name)):
                self._fs.delete(self._at(name), True)
                if not self._fs.rename(self._at(NEXT, name), self._at(name)):
                    raise PublishError(f"{name} could not be moved; the commit stays and is carried out when the table is opened")
        self._fs.delete(self._at(NEXT), True)
        self._fs.delete(self._at(COMMIT), False)

    def read(self) -> DataFrame | None:
        """The table, or None before its first publish."""
        return self.spark.read.option("basePath", self.path).parquet(self.path) if self._folders() else None

    def parts(self) -> list[str]:
        """Names of the partitions that are there."""
        return [x.partition("=")[2] for x in self._folders()]

    def _stage(self, df: DataFrame) -> None:
        self._fs.delete(self._at(NEXT), True)
        df.write.partitionBy(self.by).parquet(str(self._at(NEXT)))

    def _commit(self) -> None:
        names = self._folders(NEXT)
        aside = self._at("_commit.tmp")
        out = self._fs.create(aside, True)
        try:
            out.write(bytearray(json.dumps(names).encode()))
        finally:
            out.close()
        if not self._fs.rename(aside, self._at(COMMIT)):
            raise PublishError("the commit could not be put down")
        self._move(names)

    def publish(self, df: DataFrame, check: Callable[[DataFrame], str | None] | None = None) -> list[str]:
        """Replaces the partitions that ``df`` has rows of; other partitions stay. Every key may occur once. ``check`` sees the
        written rows and names what is wrong with them. Returns the partitions' folders."""
        self.recover()
        self._stage(df)
        names = self._folders(NEXT)
        if names:
            written = self.spark.read.option("basePath", str(self._at(NEXT))).parquet(str(self._at(NEXT)))
            twice = written.groupBy(*self.keys).count().where("count > 1").limit(1).count()
            wrong = f"a key of {self.keys} occurs twice" if twice else check(written) if check else None
            if wrong:
                self._fs.delete(self._at(NEXT), True)
                raise PublishError(wrong)
            self._commit()
        return names

    def upsert(self, new: DataFrame, check: Callable[[DataFrame], str | None] | None = None) -> list[str]:
        """Rows of ``new`` win over rows of the same key. Only the partitions of ``new`` are read and written, so a key must not
        move from one partition to another."""
        old = self.read()
        if old is not None:
            touched = [r[0] for r in new.select(self.by).distinct().collect()]  # folders that are about to be written
            old = old.where(F.col(self.by).isin(touched))
            new = tables.upsert(old.select(*new.columns), new, self.keys)
        return self.publish(new, check)
