"""Paged extraction: page plan, page numbering, distributed page fetch.

The open-data API is read in pages of ``LIMIT n OFFSET m``.  The plan (one row
per page) is a DataFrame: per key the number of matching rows, ``ceil(n / size)``
pages, one row per page (a key with no row gets no page).  Fetching runs as
``mapInPandas`` over the plan, so pages are spread over tasks and the plan never
passes through the driver; the page body (a JSON array) is decoded on the JVM
with ``from_json`` + ``explode``.  A page that fails is not dropped silently: it
comes back as a row with ``error`` set.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civic_mart.functions.text import url_quote

# fixed values: page size of the extract jobs
PAGE_SIZE = 1000

PAGE_PLAN_SCHEMA = "key string, page bigint, offset bigint, page_size bigint, total bigint"
FETCHED_SCHEMA = "key string, page bigint, body string, error string"


def page_plan(counts: DataFrame, key: str, count: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """``(key, n)`` -> one row per page: ``page`` 0..ceil(n/size)-1, ``offset``, ``page_size``."""
    pages = F.ceil(F.col(count) / F.lit(page_size)).cast("bigint")
    seq = F.when(pages > 0, F.sequence(F.lit(0).cast("bigint"), pages - 1)).otherwise(F.array().cast("array<bigint>"))
    return counts.select(F.col(key).alias("key"), F.col(count).cast("bigint").alias("total"),
                         F.explode(seq).alias("page")).select(
        "key", "page", (F.col("page") * page_size).alias("offset"), F.lit(page_size).cast("bigint").alias("page_size"),
        "total")


def page_url(base: str, query: Column, page_size: int = PAGE_SIZE) -> Column:
    """``base + '?$query=' + quote(query + ' LIMIT n OFFSET m')`` for a plan row."""
    q = F.concat(query, F.lit(f" LIMIT {page_size} OFFSET "), F.col("offset").cast("string"))
    return F.concat(F.lit(base + "?$query="), url_quote(q))


def positions(df: DataFrame, group: list[str], order: list[str], partitions: int | None = None) -> DataFrame:
    """Add ``_pos``: 0-based position of each row within its group in ``order``.

    A window partitioned by the group would put a hot group in one task.  Instead
    rows are range-partitioned on (group, order) and sorted in place; each task
    numbers its rows, a small table of per-(partition, group) counts gives every
    partition its starting offset, and a join adds it back.  ``order`` must make
    rows unique within a group (ties would make positions depend on the shuffle).
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(n, *group, *order).sortWithinPartitions(*group, *order)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_local", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)))
    # written once: both uses below read the same numbered rows (and a lost executor
    # cannot make a recomputation number them differently)
    from civic_mart.sources.sinks import materialize
    tagged = materialize(tagged, "positions")
    counts = tagged.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_first"))
    w = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    return (tagged.join(counts, ["_part", *group])
            .withColumn("_pos", F.col("_before") + F.col("_local") - F.col("_first"))
            .drop("_part", "_local", "_n", "_first", "_before"))


def with_pages(df: DataFrame, group: list[str], order: list[str], page_size: int = PAGE_SIZE) -> DataFrame:
    """Page number of each row (``LIMIT/OFFSET`` paging over a stable order)."""
    return positions(df, group, order).withColumn("page", F.floor(F.col("_pos") / page_size).cast("bigint")).drop("_pos")


def keyset_plan(df: DataFrame, group: str, key: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """One row per page ``(key, page, low, high, n_rows)`` by ranges of a unique key: a page asks
    for ``low <= key < high`` in place of LIMIT and OFFSET.  The bounds are the key's quantiles
    at every ``page_size`` rows; a group's first page has no lower and its last no upper bound.

    LIMIT/OFFSET pages shift when rows come or go between two reads, so rows are read twice or not
    at all.  A key stays in its range: rows that arrive later fall in one page, and every row that
    was there when the plan was made is read once."""
    placed = positions(df.select(F.col(group).alias("key"), F.col(key).alias("low")), ["key"], ["low"])
    page = F.floor(F.col("_pos") / page_size).cast("bigint")
    # a page's rows lie together: its bounds come from partial aggregates
    pages = placed.groupBy("key", page.alias("page")).agg(F.min("low").alias("low"), F.count(F.lit(1)).alias("n_rows"))
    after = pages.select("key", (F.col("page") - 1).alias("page"), F.col("low").alias("high"))
    return pages.join(after, ["key", "page"], "left").select(
        "key", "page", F.when(F.col("page") > 0, F.col("low")).alias("low"), "high", "n_rows")


def in_page(key: Column, low: Column, high: Column) -> Column:
    """Whether a key belongs to a page of a keyset plan."""
    return (low.isNull() | (key >= low)) & (high.isNull() | (key < high))


# ------------------------------------------------------------------ fetchers
Fetcher = Callable[[str, int, int, int], str]


def http_fetcher(url_of: Callable[[str, int, int, int], str], headers: dict[str, str] | None = None,
                 timeout: float = 60.0) -> Fetcher:
    """Fetch from an HTTP API (``requests`` if installed, else ``urllib``)."""
    def fetch(key: str, page: int, offset: int, size: int) -> str:
        url = url_of(key, page, offset, size)
        try:
            import requests  # noqa: PLC0415
            r = requests.get(url, headers=headers or {}, timeout=timeout)
            r.raise_for_status()
            return r.text
        except ImportError:
            import urllib.request  # noqa: PLC0415
            req = urllib.request.Request(url, headers=headers or {})
            with urllib.request.urlopen(req, timeout=timeout) as resp:  # noqa: S310
                return resp.read().decode("utf-8")
    return fetch


def fetch_pages(plan: DataFrame, fetcher: Fetcher, tasks: int | None = None) -> DataFrame:
    """Fetch every planned page in parallel; one output row per page (body or error)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys, pages, bodies, errors = [], [], [], []
            for key, page, offset, size in zip(pdf["key"], pdf["page"], pdf["offset"], pdf["page_size"]):
                keys.append(key)
                pages.append(int(page))
                try:
                    bodies.append(fetcher(key, int(page), int(offset), int(size)))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  (kept as data, not swallowed)
                    bodies.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({"key": keys, "page": pages, "body": bodies, "error": errors})

    n = tasks or max(1, int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return plan.repartition(n, "key", "page").mapInPandas(run, FETCHED_SCHEMA)


def page_bodies(rows: DataFrame, page: list[str], order: str) -> DataFrame:
    """Rows with their page keys -> one JSON array per page (at most a page's rows each)."""
    fields = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in page])
    body = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.to_json(fields).alias("j")))),
                       lambda x: x["j"])
    return rows.groupBy(*page).agg(F.concat(F.lit("["), F.array_join(body, ","), F.lit("]")).alias("body"))


def checked_pages(plan: DataFrame, pages: DataFrame) -> DataFrame:
    """Every planned page with its body.  A page that is missing, failed or holds another
    number of records than planned fails the job: no page is lost unseen."""
    p = pages.select("key", "page", "body", *([F.col("error")] if "error" in pages.columns else [
        F.lit(None).cast("string").alias("error")]))
    j = plan.join(p, ["key", "page"], "left")
    want = F.least(F.col("page_size"), F.col("total") - F.col("offset"))
    got = F.json_array_length("body")
    bad = F.when(F.col("error").isNotNull(), F.col("error")).when(F.col("body").isNull(), F.lit("no such page")).when(
        ~got.eqNullSafe(want), F.concat(F.lit("records: "), F.coalesce(got.cast("string"), F.lit("none"))))
    fail = F.raise_error(F.concat(F.lit("page "), F.col("key"), F.lit("/"), F.col("page").cast("string"), F.lit(": "), bad))
    return j.select("key", "page", F.when(bad.isNull(), F.col("body")).otherwise(fail).alias("body"))


def page_records(pages: DataFrame, record_schema: T.StructType) -> DataFrame:
    """Decode page bodies (JSON arrays) into one row per record; an empty page gives no row."""
    arr = T.ArrayType(record_schema)
    return pages.select("key", "page", F.explode(F.from_json("body", arr)).alias("r")).select("key", "page", "r.*")


def page_errors(fetched: DataFrame) -> DataFrame:
    return fetched.where(F.col("error").isNotNull()).select("key", "page", "error")
