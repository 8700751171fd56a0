"""Market data as a Python data source: one input partition per day and exchange."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Columns of each kind of data beside date, ticker and exchange.
KINDS = {
    "names": "name string",
    "prices": "open double, high double, low double, close double, volume long, transaction long, rate double",
    "caps": "close double, marketcap long, volume long, transaction long, shares long",
    "fundamentals": "bps double, per double, pbr double, eps double, div double, dps double",
}


class DayPartition(InputPartition):
    def __init__(self, date: str, exchange: str) -> None:
        self.date, self.exchange = date, exchange


class MarketSource(DataSource):
    """``spark.read.format("weftline_market")`` with options path, kind (see KINDS), dates and exchanges (comma-separated).

    Offline it reads Parquet from ``path/kind/date=D/exchange=E``, a folder a
    partition; ``path`` is one that all workers see. A fetch from an API takes
    the place of ``MarketReader.fetch``. A day without data gives no rows.
    """

    @classmethod
    def name(cls) -> str:
        return "weftline_market"

    def schema(self) -> str:
        return f"date date, ticker string, exchange string, {KINDS[self.options.get('kind', 'names')]}"

    def reader(self, schema) -> MarketReader:
        return MarketReader(self.options, [f.name for f in schema.fields])


class MarketReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]) -> None:
        self.folder = f"{options['path'].rstrip('/')}/{options.get('kind', 'names')}"
        self.columns = columns
        self.dates = [x for x in options.get("dates", "").split(",") if x]
        self.exchanges = [x for x in options.get("exchanges", "").split(",") if x]

    def partitions(self) -> list[DayPartition]:
        return [DayPartition(d, e) for d in self.dates for e in self.exchanges]

    def fetch(self, date: str, exchange: str) -> Iterator:
        """Arrow batches of one day and exchange."""
        import datetime

        import pyarrow as pa
        import pyarrow.fs
        import pyarrow.parquet as pq

        where = f"{self.folder}/date={date}/exchange={exchange}"
        fs, path = pyarrow.fs.FileSystem.from_uri(where) if "://" in where or where.startswith("file:") else (pyarrow.fs.LocalFileSystem(), where)
        listed = fs.get_file_info(pyarrow.fs.FileSelector(path, allow_not_found=True))
        for f in sorted(x.path for x in listed if x.path.endswith(".parquet")):
            with fs.open_input_file(f) as file:
                for b in pq.ParquetFile(file).iter_batches(columns=[c for c in self.columns if c not in ("date", "exchange")]):
                    day = pa.array([datetime.date.fromisoformat(date)] * len(b), pa.date32())
                    own = {"date": day, "exchange": pa.array([exchange] * len(b), pa.string())} | {n: b.column(n) for n in b.schema.names}
                    yield pa.RecordBatch.from_arrays([own[c] for c in self.columns], self.columns)

    def read(self, partition: DayPartition) -> Iterator:
        yield from self.fetch(partition.date, partition.exchange)
