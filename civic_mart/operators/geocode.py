"""Geocode: resolve points against nested polygon layers and merge per key.

The source system resolves every record against three layers in three
branches and merges the branches with a co-group by key, taking for each
output column the first non-null value (block branch first, then tract, then
neighborhood).  Here the three lookups are chained left joins on one record
stream and the merge is one ``groupBy(key)``; "first" is made deterministic by
ordering records on ``order`` columns and polygons on their id.

First-non-null is a minimum over ``struct(order, value)`` restricted to
non-null values, so it decomposes: records are first reduced to distinct
(key, location) groups (map-side partial aggregation absorbs hot keys), and the
spatial refine runs once per group.  A key's only group is its result; where a
key has several, the merge takes the minimum of the group minima.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civic_mart.operators import spatial


@dataclass(frozen=True)
class LayerSpec:
    prefix: str
    layer: spatial.Layer
    outputs: dict[str, str]              # output column -> layer attribute
    borough_attrs: tuple[str, str] = ("BoroCode", "BoroName")


@dataclass
class GeocodeSpec:
    key: str
    order: list[str]                      # record order for "first"
    x: str
    y: str
    borough: str
    fields: dict[str, str] = field(default_factory=dict)   # output -> source column
    layers: list[LayerSpec] = field(default_factory=list)


def _first(value: Column, order: Column) -> Column:
    """Struct (order, value) of the first non-null value; combine with ``F.min``."""
    return F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v")))


def geocode(records: DataFrame, spec: GeocodeSpec,
            broadcast_limit: int = spatial.DEFAULT_BROADCAST_LIMIT, salt: int = 1) -> DataFrame:
    """One row per ``spec.key`` with the merged fields and layer attributes, however often
    the source repeats a key.  ``salt`` splits hot index cells of layers that are too large
    to broadcast (see ``spatial.locate``)."""
    loc = [spec.key, spec.x, spec.y, spec.borough]
    ord_col = F.struct(*[F.col(c) for c in spec.order])
    groups = records.groupBy(*loc).agg(
        F.min(ord_col).alias("_ord"),
        *[F.min(_first(F.col(src), ord_col)).alias(f"_f_{out}") for out, src in spec.fields.items()],
    )
    groups = groups.withColumn("_groups", F.count(F.lit(1)).over(Window.partitionBy(spec.key)))

    def located(which: Column) -> DataFrame:
        # both parts read ``_ord`` (never null), so they share one shuffle of the groups
        rows = groups.where(which & F.col("_ord").isNotNull())
        for ls in spec.layers:
            rows = spatial.locate(rows, ls.layer, spec.x, spec.y, spec.borough, ls.prefix, broadcast_limit, salt)
        return rows

    outs = [F.col(f"_f_{out}")["v"].alias(out) for out in spec.fields]
    outs += [F.col(f"{ls.prefix}{attr}").alias(out) for ls in spec.layers for out, attr in ls.outputs.items()]
    if spec.layers:
        outs += [F.coalesce(*[F.col(f"{ls.prefix}{ls.borough_attrs[i]}") for ls in spec.layers]).alias(name)
                 for i, name in enumerate(("borough_code", "borough_name"))]
    single = located(F.col("_groups") == 1).select(spec.key, *outs)

    aggs = [F.min(F.col(f"_f_{out}"))["v"].alias(out) for out in spec.fields]
    boro_code, boro_name = [], []
    for ls in spec.layers:
        order = F.struct(F.col("_ord"), F.col(f"{ls.prefix}pid"))
        for out, attr in ls.outputs.items():
            aggs.append(F.min(_first(F.col(f"{ls.prefix}{attr}"), order))["v"].alias(out))
        boro_code.append(F.min(_first(F.col(f"{ls.prefix}{ls.borough_attrs[0]}"), order))["v"])
        boro_name.append(F.min(_first(F.col(f"{ls.prefix}{ls.borough_attrs[1]}"), order))["v"])
    if spec.layers:
        aggs += [F.coalesce(*boro_code).alias("borough_code"), F.coalesce(*boro_name).alias("borough_name")]
    return single.unionByName(located(F.col("_groups") > 1).groupBy(spec.key).agg(*aggs))
