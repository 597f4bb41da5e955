"""A partitioned Spark data source over a paged API with an injected fetcher.

A partition is a range of pages of one key.  The driver holds the ranges only, of
``RANGE_PAGES`` pages each, not the pages.  A task asks for its pages one by one, tries a failing
one again after growing pauses, and checks each body against the number of records that the plan
expects, so a page that stays short or broken fails the job instead of getting lost.  Pages that
have landed already can be left out of the ranges, so a job that died goes on where it was.

The classes are made inside a function: Python sends them to the workers by value, and the
workers need not have this package.
"""

from __future__ import annotations

import binascii
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Fetcher = Callable[[str, int, int, int], str]

RANGE_PAGES = 20
ATTEMPTS = 4
PAUSE_SECONDS = 0.5
SCHEMA = "key string, page bigint, body string"


def page_ranges(plan: DataFrame, landed: DataFrame | None = None, size: int = RANGE_PAGES) -> DataFrame:
    """Rows of a page plan as ranges ``(key, first, last, page_size, total)`` of at most ``size``
    consecutive pages, without the pages of ``landed(key, page)``."""
    if landed is not None:
        plan = plan.join(landed.select("key", "page").distinct(), ["key", "page"], "left_anti")
    # pages of one block of ``size``; a gap within it splits the range
    block = plan.withColumn("block", F.floor(F.col("page") / size))
    w = Window.partitionBy("key", "block").orderBy("page")
    return block.withColumn("run", F.col("page") - F.row_number().over(w)).groupBy("key", "block", "run").agg(
        F.min("page").alias("first"), F.max("page").alias("last"), F.first("page_size").alias("page_size"),
        F.first("total").alias("total")).drop("block", "run")


def fetched(key: str, page: int, page_size: int, total: int, fetcher: Fetcher, attempts: int = ATTEMPTS,
            pause: float = PAUSE_SECONDS) -> str:
    """The body of one page, tried up to ``attempts`` times.  Fails if it stays broken or holds
    another number of records than planned."""
    import json
    import time

    want, problem = min(page_size, total - page * page_size), ""
    for attempt in range(attempts):
        if attempt:
            time.sleep(pause * 2 ** (attempt - 1))
        try:
            body = fetcher(key, page, page * page_size, page_size)
            got = len(json.loads(body))
        except Exception as e:  # noqa: BLE001  (any failure of a fetch is tried again, the last is raised)
            problem = f"{type(e).__name__}: {e}"
            continue
        if got == want:
            return body
        problem = f"{got} records, planned {want}"
    raise RuntimeError(f"page {key}/{page} after {attempts} attempts: {problem}")


def source_class(fetcher: Fetcher, ranges: list[tuple], attempts: int = ATTEMPTS, pause: float = PAUSE_SECONDS) -> type:
    """A ``DataSource`` class named ``civic_pages`` for the ranges of a job."""
    columns, one_page = SCHEMA, fetched

    class Range(InputPartition):
        def __init__(self, key: str, first: int, last: int, page_size: int, total: int) -> None:
            self.key, self.first, self.last, self.page_size, self.total = key, first, last, page_size, total

    class PageReader(DataSourceReader):
        def partitions(self) -> list:
            return [Range(*r) for r in ranges] or [Range("", 0, -1, 1, 0)]

        def read(self, part) -> Iterator[tuple]:
            for page in range(part.first, part.last + 1):
                yield part.key, page, one_page(part.key, page, part.page_size, part.total, fetcher, attempts, pause)

    class PagedSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "civic_pages"

        def schema(self) -> str:
            return columns

        def reader(self, schema) -> DataSourceReader:
            return PageReader()

    return PagedSource


def read_pages(plan: DataFrame, fetcher: Fetcher, landed: DataFrame | None = None, attempts: int = ATTEMPTS,
               pause: float = PAUSE_SECONDS, size: int = RANGE_PAGES) -> DataFrame:
    """``(key, page, body)`` of every planned page that is not in ``landed``."""
    spark = plan.sparkSession
    by_value()
    rows = page_ranges(plan, landed, size).orderBy("key", "first").collect()  # one row a range
    spark.dataSource.register(source_class(fetcher, [tuple(r[c] for c in ("key", "first", "last", "page_size", "total"))
                                                     for r in rows], attempts, pause))
    return spark.read.format("civic_pages").load()


def by_value() -> None:
    """This module's functions travel to the workers by value."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


# ------------------------------------------------------------------ landed pages
def land_pages(pages: DataFrame, root: str) -> DataFrame:
    """Store pages ``(key, page, body)`` as one text file each below ``root``; returns them as landed."""
    out = pages.select(F.hex(F.col("key").cast("binary")).alias("key_hex"), "page", F.col("body").alias("value"))
    out.repartition("key_hex", "page").write.mode("append").partitionBy("key_hex", "page").text(root)
    return landed_pages(pages.sparkSession, root)


def landed_pages(spark: SparkSession, root: str) -> DataFrame:
    """``(key, page)`` of the page files below ``root``."""
    files = spark.read.format("text").schema("value string, key_hex string, page bigint").load(root)
    return files.select(F.unhex("key_hex").cast("string").alias("key"), "page").distinct()


def landed_fetcher(root: str) -> Fetcher:
    """Fetch from page files that ``land_pages`` stored, on any file system that pyarrow knows."""
    def fetch(key: str, page: int, offset: int, size: int) -> str:
        import pyarrow.fs as fs

        where = f"{root}/key_hex={binascii.hexlify(key.encode('utf-8')).decode().upper()}/page={page}"
        files, path = fs.FileSystem.from_uri(where if "://" in where else "file://" + where.removeprefix("file:"))
        found = [f.path for f in files.get_file_info(fs.FileSelector(path)) if f.base_name.startswith("part-")]
        if len(found) != 1:
            raise FileNotFoundError(f"{len(found)} files of page {key}/{page}")
        with files.open_input_stream(found[0]) as f:
            return f.read().decode("utf-8").rstrip("\n")

    return fetch
