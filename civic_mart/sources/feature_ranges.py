"""Features of large GeoJSON documents, read in byte ranges.

A FeatureCollection is one JSON value, so a JSON reader puts a whole document in one task.  Here
each file is cut into byte ranges.  A first pass counts, per range, the string quotes and the
brackets outside strings, for a range that begins outside a string and for one that begins
inside (escapes are told from the bytes before, so only this is open).  A running sum over the
ranges of a file, one small row each, then gives every range the state at its first byte.  A second
pass cuts out the objects that begin in the range two brackets deep, which are the features, and
reads on behind the range for the end of the last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANGE_BYTES = 8 << 20
FEATURE_DEPTH = 2  # inside the document's object and its array of features


def byte_ranges(spark: SparkSession, path: str, size: int = RANGE_BYTES) -> DataFrame:
    """``(path, first, last)`` of every range of the files at ``path`` (a listing; nothing is read)."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(size).cast("bigint")))
    return files.select("path", "length", first.alias("first")).select(
        "path", "first", F.least(F.col("first") + size, F.col("length")).alias("last"))


def _open(path: str):
    """A random-access file of any file system that pyarrow knows."""
    import pyarrow.fs as fs

    uri = f"file://{path[5:]}" if path.startswith("file:/") and not path.startswith("file://") else path
    system, where = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    return system.open_input_file(where)


def _read(file, first: int, last: int) -> tuple[np.ndarray, bool]:
    """Bytes of a range, and whether its first byte is escaped by a backslash before it."""
    slashes, at = 0, first
    while at > 0:
        back = max(0, at - 64)
        file.seek(back)
        raw = file.read(at - back)
        run = len(raw) - len(raw.rstrip(b"\\"))
        slashes, at = slashes + run, back
        if run < len(raw):
            break
    file.seek(first)
    return np.frombuffer(file.read(last - first), np.uint8), slashes % 2 == 1


def _quotes(raw: np.ndarray, escaped: bool) -> np.ndarray:
    """Where a quote begins or ends a string: one with an even number of backslashes before it."""
    n = len(raw)
    slash = raw == 0x5C
    at = np.arange(n)
    # length of the run of backslashes that ends just before each byte
    other = np.maximum.accumulate(np.where(slash, -1, at))
    before = np.concatenate([[0], at[1:] - 1 - other[:-1]])
    lead = np.concatenate([[True], other[:-1] < 0])  # the run reaches back before the range
    before = before + (lead & escaped)
    return (raw == 0x22) & (before % 2 == 0)


def _steps(raw: np.ndarray) -> np.ndarray:
    """+1 at opening, -1 at closing brackets and braces."""
    return ((raw == 0x7B) | (raw == 0x5B)).astype(np.int8) - ((raw == 0x7D) | (raw == 0x5D)).astype(np.int8)


def _summary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for r in pdf.itertuples():
            with _open(r.path) as file:
                raw, escaped = _read(file, r.first, r.last)
            quote, step = _quotes(raw, escaped), _steps(raw)
            inside = np.cumsum(quote) % 2 == 1
            out.append((r.path, r.first, r.last, int(quote.sum()) % 2, int(step[~inside].sum()), int(step[inside].sum())))
        yield pd.DataFrame(out, columns=["path", "first", "last", "flips", "outside", "within"])


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for r in pdf.itertuples():
            found = []
            with _open(r.path) as file:
                raw, escaped = _read(file, r.first, r.last)
                quote, step = _quotes(raw, escaped), _steps(raw)
                inside = (np.cumsum(quote) + r.in_string) % 2 == 1
                step[inside] = 0
                depth = np.cumsum(step, dtype=np.int64) + r.depth
                begin = np.flatnonzero((step == 1) & (raw == 0x7B) & (depth == FEATURE_DEPTH + 1))
                end = np.flatnonzero((step == -1) & (raw == 0x7D) & (depth == FEATURE_DEPTH))
                if len(begin):
                    end = end[np.searchsorted(end, begin[0]):]  # an object that began before belongs to its range
                found += [raw[a:b + 1].tobytes().decode("utf-8") for a, b in zip(begin, end)]
                if len(begin) > len(end):  # the last one goes on behind the range
                    found.append(_tail(file, r.last, raw[begin[-1]:], int(depth[-1]), bool(inside[-1])))
            if found:
                yield pd.DataFrame({"feature": found})


def _tail(file, at: int, head: np.ndarray, depth: int, in_string: bool) -> str:
    parts, size = [head.tobytes()], 1 << 16
    while True:
        raw, escaped = _read(file, at, at + size)
        if not len(raw):
            raise ValueError("the document ends inside a feature")
        quote, step = _quotes(raw, escaped), _steps(raw)
        inside = (np.cumsum(quote) + in_string) % 2 == 1
        step[inside] = 0
        run = np.cumsum(step, dtype=np.int64) + depth
        end = np.flatnonzero((step == -1) & (run == FEATURE_DEPTH))
        if len(end):
            return (b"".join(parts) + raw[:end[0] + 1].tobytes()).decode("utf-8")
        parts.append(raw.tobytes())
        at, depth, in_string, size = at + len(raw), int(run[-1]), bool(inside[-1]), min(2 * size, RANGE_BYTES)


def feature_texts(spark: SparkSession, path: str, size: int = RANGE_BYTES) -> DataFrame:
    """``feature``: the JSON text of every object two brackets deep in the documents at ``path`` (the
    caller keeps those of type Feature).  Files of any size are read by as many tasks as they have
    ranges."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    ranges = byte_ranges(spark, path, size).repartition("path", "first")
    told = ranges.mapInPandas(_summary, "path string, first bigint, last bigint, flips int, outside bigint, within bigint")
    before = Window.partitionBy("path").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    state = told.withColumn("in_string", (F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2).cast("int"))
    state = state.withColumn("step", F.when(F.col("in_string") == 0, F.col("outside")).otherwise(F.col("within")))
    state = state.withColumn("depth", F.coalesce(F.sum("step").over(before), F.lit(0)))
    return state.select("path", "first", "last", "in_string", "depth").repartition("path", "first").mapInPandas(
        _features, "feature string")
