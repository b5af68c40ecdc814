"""Tables of SQLite databases, such as a feed index: ``spark.read.format("sqlite_rows")``, read in ranges of rowid."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from contextlib import closing

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from colloquy.sources.feeds import likeliest_feeds, read_feeds


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def tables_of(path: str) -> dict[str, list[str]]:
    """Tables of the database with their columns, by name."""
    with closing(_open(path)) as db:
        names = [r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name")]
        return {n: [r[1] for r in db.execute(f"PRAGMA table_info({_quoted(n)})")] for n in names}


class RowRange(InputPartition):
    def __init__(self, first: int, last: int) -> None:
        super().__init__((first, last))
        self.first, self.last = first, last


class SqliteReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.table = options["path"], options["table"]
        self.columns = options["columns"].split("\n")
        self.rows = int(options.get("rows_per_partition", 500_000))

    def partitions(self) -> list[RowRange]:
        with closing(_open(self.path)) as db:
            low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.table)}").fetchone()
        return [RowRange(0, -1)] if low is None else [RowRange(a, min(a + self.rows - 1, high)) for a in range(low, high + 1, self.rows)]

    def read(self, partition: RowRange) -> Iterator[tuple]:
        wanted = ", ".join(f"CAST({_quoted(c)} AS TEXT)" for c in self.columns)
        with closing(_open(self.path)) as db:
            yield from db.execute(f"SELECT rowid, {wanted} FROM {_quoted(self.table)} WHERE rowid BETWEEN ? AND ?", (partition.first, partition.last))


class SqliteSource(DataSource):
    """Options: path, on a disk that all executors see; table; columns, one a line; rows_per_partition. All as text, with
    the rowid as ``pos``."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_rows"

    def schema(self) -> str:
        return ", ".join(["pos bigint", *(f"`{c}` string" for c in self.options["columns"].split("\n"))])

    def reader(self, schema) -> SqliteReader:
        return SqliteReader(dict(self.options))


def read_sqlite(spark: SparkSession, path: str, table: str, columns: list[str], rows_per_partition: int = 500_000) -> DataFrame:
    spark.dataSource.register(SqliteSource)
    return spark.read.format("sqlite_rows").option("table", table).option("columns", "\n".join(columns)).option("rows_per_partition", rows_per_partition).load(path)


def feeds_of(spark: SparkSession, path: str, languages: list[str]) -> DataFrame:
    """read_feeds() of the database's likeliest feed table. Raises ValueError if it has none."""
    name, url, lang = likeliest_feeds(tables_of(path))
    return read_feeds({name: read_sqlite(spark, path, name, [url, lang]).drop("pos")}, languages)
