"""A paged source of discovered rows as a stream (X04 of the survey).

Discovery gives its finds in pages and, with each, where the next one begins. A stream's offset is that continuation: the
number of the first page that has not been read. A batch is a range of pages, each read by a task of its own; Spark logs
the range before it reads it, so after a restart the same pages are read again, or the next ones, and none twice or never.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "framewell_pages"


def write_pages(df: DataFrame, order: list[str], rows: int, path: str, first: int = 0) -> None:
    """df in pages of ``rows`` rows, by order, numbered from ``first``; a page appears as a whole."""
    from framewell.operators.ranks import numbered

    paged = numbered(df, [F.col(c) for c in order], "_place").withColumn("page", (F.lit(first) + F.floor((F.col("_place") - 1) / rows)).cast("long"))
    paged.repartition("page").sortWithinPartitions("page", "_place").drop("_place").write.mode("append").partitionBy("page").parquet(path)


class _Page(InputPartition):
    def __init__(self, number: int, files: list[str]):
        self.number, self.files = number, files


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns = path, columns

    def _pages(self) -> dict[int, list[str]]:
        """Files of each page that is there."""
        store, root = pafs.FileSystem.from_uri(self.path)
        found: dict[int, list[str]] = {}
        for x in store.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
            m = re.search(r"/page=(\d+)/[^/_.][^/]*\.parquet$", x.path)
            if m and "/_temporary/" not in x.path:
                found.setdefault(int(m[1]), []).append(x.path)
        return found

    def initialOffset(self) -> dict:
        return {"page": 0}

    def latestOffset(self) -> dict:
        pages, n = self._pages(), 0
        while n in pages:
            n += 1
        return {"page": n}

    def partitions(self, start: dict, end: dict) -> list[_Page]:
        pages = self._pages()
        return [_Page(n, sorted(pages[n])) for n in range(start["page"], end["page"])]

    def read(self, partition: _Page) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(self.path)
        for name in partition.files:
            with store.open_input_file(name) as file:
                for batch in pq.ParquetFile(file).iter_batches(columns=self.columns):
                    rows = pa.table(batch.columns, names=batch.schema.names).append_column("page", pa.array([partition.number] * batch.num_rows, pa.int64()))
                    yield from rows.select([*self.columns, "page"]).to_batches()

    def commit(self, end: dict) -> None:
        """Pages stay where they are; another stream may read them."""


class PagedSource(DataSource):
    """Options: path, and columns as a schema string without the page's number, which comes last."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return f"{self.options['columns']}, page long"

    def streamReader(self, schema) -> _Reader:
        return _Reader(self.options["path"], [f.name for f in schema if f.name != "page"])


def page_stream(spark: SparkSession, path: str, columns: str) -> DataFrame:
    spark.dataSource.register(PagedSource)
    return spark.readStream.format(NAME).option("path", path).option("columns", columns).load()
