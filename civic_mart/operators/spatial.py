"""Point-in-polygon on plain columns.

Geometry is kept as WKT text at rest (as the layer tables store it) and parsed
once per polygon into an array of edges ``array<struct<x1,y1,x2,y2>>``.  The
containment test is a higher-order expression evaluated on the JVM:

* even-odd crossing count of a ray towards +x over all rings (holes and the
  parts of a multipolygon are just more rings), and
* not on any edge: containment is strict, a point on the boundary is outside.

Both rest on the exact side of a point to an edge (operators/exact.py).

The lookup joins points to polygons through a two-level index.  A base grid (one
cell size a layer) lists every polygon under each cell its bounding box touches.
Cells that hold more than ``CELL_EDGES`` edges or ``CELL_POLYGONS`` polygons are
split like a quadtree, round by round, until they hold less.  A polygon's entry in
a cell holds only the edges that may touch the cell and one parity that stands for
all others, so testing a candidate costs its local edges whatever the polygon's size;
a cell inside a polygon holds no edge of it at all.  A point finds the level of its
cell in a small directory of split cells and then joins the cell table on (borough
bucket, level, cell x, cell y).  Joining on the borough alone would give a handful of
huge tasks.  Tables are broadcast only when their size is below a limit; past it the
joins are shuffle joins on the cell key, left to AQE for skewed cells.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from civic_mart.functions.text import borough_key
from civic_mart.operators import exact
from civic_mart.sources import sinks

# ring text "x y, x y, ..." inside the innermost parentheses
_RING_RE = r"\(([^()]+)\)"

EDGE_TYPE = "array<struct<x1:double,y1:double,x2:double,y2:double>>"

DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024

#: a cell with more edges or polygons is split, each time in 4 x 4, at most ``MAX_ROUNDS`` times
#: (polygons that meet in one point share a cell at any size)
CELL_EDGES = 256
CELL_POLYGONS = 64
SPLIT_BITS = 2
MAX_ROUNDS = 8
#: bytes of an edge and of a polygon's entry beside its edges and attributes
EDGE_BYTES, ENTRY_BYTES = 40, 96


def wkt_rings(wkt: Column) -> Column:
    """POLYGON / MULTIPOLYGON WKT -> ``array<array<struct<x:double,y:double>>>``.

    One split per ring into a flat list of numbers, read pairwise (x, y)."""
    # a lambda's argument is evaluated once: a ring is split once, not anew for each of its numbers
    rings = F.transform(F.regexp_extract_all(wkt, F.lit(_RING_RE), 1), lambda r: F.split(F.trim(r), r"[\s,]+"))

    def ring(nums: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor(F.size(nums) / 2).cast("int") - 1),
            lambda i: F.struct(nums[i * 2].cast("double").alias("x"), nums[i * 2 + 1].cast("double").alias("y")))

    return F.transform(rings, ring)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt to all cores.  A table of polygons is small on disk for the work that each of
    its rows asks for: read as files and row groups split it, a few tasks would do it all."""
    spark = df.sparkSession
    return df.repartition(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def ring_edges(rings: Column) -> Column:
    """Rings -> flat edge list (consecutive vertex pairs of every ring; a single point has none)."""
    per_ring = F.transform(
        F.filter(rings, lambda r: F.size(r) >= 2),
        lambda r: F.transform(
            F.sequence(F.lit(1), F.size(r) - 1),
            lambda i: F.struct(
                r[i - 1]["x"].alias("x1"), r[i - 1]["y"].alias("y1"),
                r[i]["x"].alias("x2"), r[i]["y"].alias("y2"),
            ),
        ),
    )
    return F.flatten(per_ring)


def rings_to_wkt(rings: Column) -> Column:
    """Inverse of :func:`wkt_rings` for single-part polygons (GeoJSON -> WKT)."""
    ring_txt = F.transform(
        rings,
        lambda r: F.concat(
            F.lit("("),
            F.array_join(F.transform(r, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", "),
            F.lit(")"),
        ),
    )
    return F.concat(F.lit("POLYGON ("), F.array_join(ring_txt, ", "), F.lit(")"))


def contains(edges: Column, px: Column, py: Column) -> Column:
    """Strict containment of (px, py) in the polygon given by its edge list.  Exact."""
    return _inside(edges, px, py)


def _crosses(e: Column, px: Column, py: Column) -> tuple[Column, Column]:
    """(whether the ray from the point towards +x crosses the edge, the point's side of it).

    The side (null elsewhere) is taken only where the point is in the edge's bounding box."""
    beyond = px < F.least(e["x1"], e["x2"])
    # most edges are settled by a comparison or two: a conjunction ends at the first that fails
    boxed = (px <= F.greatest(e["x1"], e["x2"])) & ~beyond & (py >= F.least(e["y1"], e["y2"])) \
        & (py <= F.greatest(e["y1"], e["y2"]))
    exactly = exact.side(e["x1"], e["y1"], e["x2"], e["y2"], px, py)
    # the ray meets an edge that goes up from its left side, one that goes down from its right
    meets = beyond | F.coalesce(boxed & (exactly != 0) & ((e["y2"] > e["y1"]) == (exactly > 0)), F.lit(False))
    return ((e["y1"] > py) != (e["y2"] > py)) & meets, F.when(boxed, exactly)


def _inside(edges: Column, px: Column, py: Column) -> Column:
    """Parity of the crossings of the ray from the point towards +x, and false on an edge."""
    def step(acc: Column, e: Column) -> Column:
        crosses, side = _crosses(e, px, py)
        return F.struct((acc["odd"] != crosses).alias("odd"), (acc["on"] | F.coalesce(side == 0, F.lit(False))).alias("on"))

    # one pass over the edges: parity of the crossings, and whether the point lies on one
    return F.aggregate(edges, F.struct(F.lit(False).alias("odd"), F.lit(False).alias("on")), step,
                       lambda acc: acc["odd"] & ~acc["on"])


def _inside_cell(edges: Column, start: Column, px: Column, py: Column) -> Column:
    """The same for a point of a cell and a polygon's edges in it; the parity begins with ``start``.

    The edges carry, for each end, whether it lies in a column of cells right of theirs (``r1``,
    ``r2``): such an end counts as the start of a line going up, which stands for the edges that
    the cell leaves out.  An edge of a cell has all its coordinates, so each is a plain yes or no: the
    odd ones are counted, and only a point found inside is looked for on the edges.  Most edges are
    settled by a comparison or two, which matters as lambdas are interpreted."""
    def odd(e: Column) -> Column:
        return (_crosses(e, px, py)[0] != (e["r1"] & (e["y1"] <= py))) != (e["r2"] & (e["y2"] <= py))

    def on(e: Column) -> Column:
        return F.coalesce(_crosses(e, px, py)[1] == 0, F.lit(False))

    return (start != (F.size(F.filter(edges, odd)) % 2 == 1)) & ~F.exists(edges, on)


@dataclass
class Layer:
    """A polygon layer prepared for lookups.

    ``df`` columns: ``_bkey`` (borough bucket), ``_pid`` (ordering id, smallest wins),
    ``_edges``, bounding box ``_xmin/_xmax/_ymin/_ymax`` and the attribute columns.
    ``cells`` has one row per (bucket, level, cell x, cell y) with the polygons of the cell;
    ``splits`` has, for each round, the cells that were split (bucket, cell x, cell y at the
    round's level).  ``size_bound`` is the size of ``cells`` in bytes, measured.
    """

    df: DataFrame
    attrs: tuple[str, ...]
    cell: float
    size_bound: int
    cells: DataFrame
    entries: DataFrame | None = None
    splits: list[tuple[DataFrame, int]] = field(default_factory=list)  # (split cells, their number)
    rejected: DataFrame | None = None  # (_bkey, _pid) of polygons without an edge, which contain nothing


def prepare_layer(polygons: DataFrame, geom_col: str, borough_col: str, id_col: str,
                  attrs: list[str], cell: float | None = None, materialize=None,
                  cell_edges: int = CELL_EDGES, cell_polygons: int = CELL_POLYGONS) -> Layer:
    """Parse WKT once per polygon; pick the base cell size from the layer itself (square root
    of the mean bounding-box area) unless given; list polygons under cells and split the
    crowded ones.  ``materialize`` (a ``DataFrame -> DataFrame`` that stores and re-reads) keeps
    the parsed layer and its cell table so later lookups neither parse nor index again; without
    it both are computed anew by each lookup."""
    keep = materialize or (lambda df: df)
    store = materialize or (lambda df: sinks.materialize(df, "layer-split"))  # a round reads the one before often
    parsed = spread(polygons).select(
        borough_key(F.col(borough_col)).alias("_bkey"), F.col(id_col).alias("_pid"),
        ring_edges(wkt_rings(F.col(geom_col))).alias("_edges"), *[F.col(a) for a in attrs])
    # bounds from the edge list in one pass (a struct of four running extremes)
    init = F.struct(F.lit(float("inf")).alias("a"), F.lit(float("-inf")).alias("b"),
                    F.lit(float("inf")).alias("c"), F.lit(float("-inf")).alias("d"))
    box = F.aggregate(F.col("_edges"), init, lambda acc, e: F.struct(
        F.least(acc["a"], e["x1"]).alias("a"), F.greatest(acc["b"], e["x1"]).alias("b"),
        F.least(acc["c"], e["y1"]).alias("c"), F.greatest(acc["d"], e["y1"]).alias("d")))
    df = parsed.withColumn("_box", box).select(
        "_bkey", "_pid", "_edges", F.col("_box.a").alias("_xmin"), F.col("_box.b").alias("_xmax"),
        F.col("_box.c").alias("_ymin"), F.col("_box.d").alias("_ymax"), *[F.col(a) for a in attrs])
    # NULL and empty geometries and single points have no edge: reported, and left out of the index
    drawn = F.coalesce(F.size("_edges") > 0, F.lit(False))
    w, h = F.col("_xmax") - F.col("_xmin"), F.col("_ymax") - F.col("_ymin")
    df, st = _measured(df, materialize, area=F.avg(F.when(drawn, w * h)), side=F.max(F.when(drawn, F.greatest(w, h))))
    rejected = df.where(~drawn).select("_bkey", "_pid")
    df = df.where(drawn)
    if cell is None:
        cell = math.sqrt(st["area"]) if st["area"] else 1.0
    cell = float(cell)
    widest = max(1.0, (st["side"] or 0.0) / cell)  # cells along the longest side of a polygon
    parts = keep(_counted(_base_entries(df, cell, widest), cell_edges, cell_polygons))
    done, splits, where = [], [], ["_bkey", "_ix", "_iy"]
    for rounds in range(MAX_ROUNDS):
        crowded, st = _measured(parts.where("_crowded").select(*where).distinct(), store, n=F.count(F.lit(1)))
        if not st["n"]:
            break
        splits.append((crowded, st["n"]))
        level = (rounds + 1) * SPLIT_BITS
        small = _refine(parts.where("_crowded").drop("_crowded"), cell, level - SPLIT_BITS, level)
        done.append(parts.where("NOT _crowded"))
        parts = store(_counted(small, cell_edges, cell_polygons))
    done.append(parts)  # after the last round crowded cells stay as they are
    entries = done[0]
    for d in done[1:]:
        entries = entries.unionByName(d)
    entries = entries.drop("_crowded")
    cells, size = _measured(_cells(entries, attrs), materialize, bytes=F.sum("_bytes"))
    return Layer(df=df, attrs=tuple(attrs), cell=cell, size_bound=int(size["bytes"] or 0), cells=cells, entries=entries,
                 splits=splits, rejected=rejected)


def _measured(df: DataFrame, materialize, **what: Column) -> tuple[DataFrame, dict]:
    """The kept table and aggregates over it, taken while it is written (a task that runs twice
    can only add to a sum); without ``materialize`` by a job of their own."""
    named = [c.alias(n) for n, c in what.items()]
    if materialize is None:
        return df, df.agg(*named).first().asDict()
    seen = Observation()
    kept = materialize(df.observe(seen, *named))
    return kept, seen.get


def _index(v: Column, cell: float, level: int) -> Column:
    """Number of the cell along one axis.  Scaling by a power of two is exact, so a point's cell
    lies in its parent cell, and an edge's cells between those of its ends."""
    return F.floor(v / F.lit(cell) * F.lit(2.0 ** level)).cast("bigint")


def _refine(rows: DataFrame, cell: float, parent: int | None, level: int) -> DataFrame:
    """Entries of the cells at ``level`` from whole polygons (``parent`` None) or from entries of
    larger cells.  An entry keeps the edges that touch the cell (and a few that pass very near),
    marked with the ends right of it.

    ``_odd`` is the parity that the edges outside a cell add for every point of it.  Their sum is
    the same all over the cell once each local edge's ends right of the cell count as lines going
    up, as in ``_inside_cell``; it is taken at the cell's centre from the parent's edges."""
    ranges = []
    for axis in ("x", "y"):
        low, high = _index(F.col(f"_{axis}min"), cell, level), _index(F.col(f"_{axis}max"), cell, level)
        if parent is not None:
            bits = level - parent
            low = F.greatest(low, F.shiftleft(F.col(f"_i{axis}"), bits))
            high = F.least(high, F.shiftleft(F.col(f"_i{axis}") + 1, bits) - 1)
        ranges.append(F.sequence(low, high))
    scale = cell * 2.0 ** -level
    # each edge once with the cells of its bounding box
    boxed = F.transform("_edges", lambda e: F.struct(
        e.alias("e"), *[f.alias(n) for n, f in (
            ("a", _index(F.least(e["x1"], e["x2"]), cell, level)), ("b", _index(F.greatest(e["x1"], e["x2"]), cell, level)),
            ("c", _index(F.least(e["y1"], e["y2"]), cell, level)), ("d", _index(F.greatest(e["y1"], e["y2"]), cell, level)))]))

    def near(b: Column, ix: Column, iy: Column, cx: Column, cy: Column) -> Column:
        e = b["e"]
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        # half a cell, and more than rounding can move a point or a corner
        reach = F.lit(scale * (0.5 + 1e-6)) + (F.abs(cx) + F.abs(cy)) * F.lit(1e-12)
        return ((b["a"] <= ix) & (b["b"] >= ix) & (b["c"] <= iy) & (b["d"] >= iy)
                & (F.abs(dx * (cy - e["y1"]) - dy * (cx - e["x1"])) <= (F.abs(dx) + F.abs(dy)) * reach))

    def ends(odd: Column, e: Column, cy: Column) -> Column:
        return (odd != (e["r1"] & (e["y1"] <= cy))) != (e["r2"] & (e["y2"] <= cy))

    def entry(ix: Column, iy: Column) -> Column:
        cx, cy = (ix + F.lit(0.5)) * F.lit(scale), (iy + F.lit(0.5)) * F.lit(scale)

        def outside(odd: Column, b: Column) -> Column:
            e = b["e"]
            odd = odd != (_crosses(e, cx, cy)[0] & ~near(b, ix, iy, cx, cy))  # most edges do not cross: that is asked first
            return ends(odd, e, cy) if parent is not None else odd

        local = F.transform(F.filter("_boxed", lambda b: near(b, ix, iy, cx, cy)), lambda b: F.struct(
            *[b["e"][n].alias(n) for n in ("x1", "y1", "x2", "y2")],
            (F.when(b["e"]["x1"] >= b["e"]["x2"], b["b"]).otherwise(b["a"]) > ix).alias("r1"),
            (F.when(b["e"]["x2"] >= b["e"]["x1"], b["b"]).otherwise(b["a"]) > ix).alias("r2")))
        return F.struct(ix.alias("_ix"), iy.alias("_iy"), local.alias("_edges"),
                        F.aggregate("_boxed", F.col("_odd") if parent is not None else F.lit(False), outside).alias("_odd"))

    def settled(c: Column) -> Column:
        cy = (c["_iy"] + F.lit(0.5)) * F.lit(scale)
        return F.struct(c["_ix"].alias("_ix"), c["_iy"].alias("_iy"), c["_edges"].alias("_edges"),
                        F.aggregate(c["_edges"], c["_odd"], lambda odd, e: ends(odd, e, cy)).alias("_odd"))

    cells = F.flatten(F.transform(ranges[0], lambda ix: F.transform(ranges[1], lambda iy: entry(ix, iy))))
    kept = F.filter(F.transform(cells, settled), lambda c: (F.size(c["_edges"]) > 0) | c["_odd"])
    others = [c for c in rows.columns if c not in ("_edges", "_odd", "_ix", "_iy", "_level")]
    return rows.withColumn("_boxed", boxed).select(*others, F.explode(kept).alias("_c")).select(
        *others, "_c.*", F.lit(level).alias("_level"))


def _base_entries(df: DataFrame, cell: float, widest: float) -> DataFrame:
    """One row per (polygon, base cell) that the polygon may cover a part of.  A polygon of many
    cells is taken down to them in steps of 8 x 8, each from the edges of the step before."""
    steps = max(1, math.ceil(math.log(widest, 8)))
    out, parent = df, None
    for step in range(steps):
        level = -3 * (steps - 1 - step)
        out = _refine(out, cell, parent, level)
        parent = level
    return out


def _counted(entries: DataFrame, cell_edges: int, cell_polygons: int) -> DataFrame:
    """Entries (of one level) that a point can find, with ``_crowded``: whether their cell holds too much.

    Polygons behind the first that covers a whole cell are never the smallest id of a point there.
    They go before the cells are counted and split, so that polygons lying many deep are not carried
    down to ever smaller cells.  One shuffle by cell; nothing is collected."""
    w = Window.partitionBy("_bkey", "_ix", "_iy")
    cover = F.min(F.when(F.size("_edges") == 0, F.col("_pid"))).over(w)
    rows = entries.withColumn("_cover", cover).where(F.col("_cover").isNull() | (F.col("_pid") <= F.col("_cover"))).drop("_cover")
    return rows.withColumn("_crowded", (F.sum(F.size("_edges")).over(w) > cell_edges)
                           | (F.count_if(F.size("_edges") > 0).over(w) > cell_polygons))


def exploded_layer(layer: Layer) -> DataFrame:
    """One row per (polygon, index cell it has a part in)."""
    return layer.entries


def _cells(entries: DataFrame, attrs: list[str]) -> DataFrame:
    """One row per (borough bucket, level, cell): its polygons, sorted by polygon id.  Polygons
    after the first that covers the whole cell can never be the smallest id of a point in it."""
    entry = F.struct(F.col("_pid"), F.col("_odd"), F.col("_xmin"), F.col("_xmax"), F.col("_ymin"), F.col("_ymax"),
                     F.col("_edges"), *[F.col(a) for a in attrs])
    w = ["_bkey", "_level", "_ix", "_iy"]
    cover = F.min(F.when(F.size("_edges") == 0, F.col("_pid"))).over(Window.partitionBy(*w))  # same keys: no second shuffle
    rows = entries.withColumn("_cover", cover).where(F.col("_cover").isNull() | (F.col("_pid") <= F.col("_cover")))
    text = sum((F.coalesce(F.length(F.col(a).cast("string")), F.lit(0)) for a in attrs), F.lit(0))
    return rows.groupBy(*w).agg(
        F.array_sort(F.collect_list(entry)).alias("_cands"),
        F.sum(F.size("_edges") * EDGE_BYTES + text + ENTRY_BYTES).alias("_bytes"),
        F.sum(F.size("_edges")).alias("_n_edges"))


def cell_table(layer: Layer) -> DataFrame:
    return layer.cells


def _levels(points: DataFrame, layer: Layer, prefix: str, broadcast_limit: int) -> DataFrame:
    """Add ``{prefix}_plvl``: the level of the point's cell.  One join with each round's split
    cells; a layer without crowded cells has none."""
    u, v = F.col(f"{prefix}_pu"), F.col(f"{prefix}_pv")
    out, hits = points, F.lit(0)
    for rounds, (split, n) in enumerate(layer.splits):
        # a cell split in one round lies in a cell split in the round before: hits count the level
        at = rounds * SPLIT_BITS
        names = [f"{prefix}_s{rounds}{c}" for c in "bxy"]
        d = split.toDF(*names)
        if n * 128 <= broadcast_limit:
            d = F.broadcast(d)
        out = out.join(d, (F.col(f"{prefix}_pk") == F.col(names[0]))
                       & (F.floor(u * F.lit(2.0 ** at)).cast("bigint") == F.col(names[1]))
                       & (F.floor(v * F.lit(2.0 ** at)).cast("bigint") == F.col(names[2])), "left")
        hits = hits + F.col(names[0]).isNotNull().cast("int")
    return out.select(*points.columns, (hits * SPLIT_BITS).alias(f"{prefix}_plvl"))


def locate(points: DataFrame, layer: Layer, x: str, y: str, borough: str, prefix: str,
           broadcast_limit: int = DEFAULT_BROADCAST_LIMIT, salt: int = 1) -> DataFrame:
    """Add ``{prefix}pid`` and ``{prefix}<attr>``: the polygon of the point's borough
    bucket with the smallest id that strictly contains the point (NULLs when none).

    Exactly one output row per input row: the cell table has one row per key.  It
    is broadcast when its size is under ``broadcast_limit``; otherwise the
    join shuffles on (bucket, cell) and AQE splits skewed cells.  ``salt > 1``
    additionally spreads every cell over ``salt`` join keys in the shuffle path:
    the cell table is replicated ``salt`` times and each point takes a salt from a
    hash of its whole row (deterministic on retry; points stacked on one spot are
    spread too).  Points without coordinates find nothing; they are dealt by a hash
    of their row, so a shuffle does not put them all in one task.
    """
    cells = layer.cells.select(
        F.col("_bkey").alias(f"{prefix}_bkey"), F.col("_level").alias(f"{prefix}_clvl"), F.col("_ix").alias(f"{prefix}_cx"),
        F.col("_iy").alias(f"{prefix}_cy"), F.col("_cands").alias(f"{prefix}_cands"))
    broadcast = layer.size_bound <= broadcast_limit
    if broadcast:
        cells = F.broadcast(cells)
    px, py = F.col(x), F.col(y)
    row_hash = F.xxhash64(*[F.col(c) for c in points.columns])
    placed = px.isNotNull() & py.isNotNull()
    pts = (points
           .withColumn(f"{prefix}_pk", F.when(placed, borough_key(F.col(borough))).otherwise(
               F.concat(F.lit("\u0000"), F.pmod(row_hash, F.lit(65536)).cast("string"))))
           .withColumn(f"{prefix}_pu", F.coalesce(px / F.lit(layer.cell), F.lit(0.0)))
           .withColumn(f"{prefix}_pv", F.coalesce(py / F.lit(layer.cell), F.lit(0.0))))
    pts = _levels(pts, layer, prefix, broadcast_limit)
    scale = F.pow(F.lit(2.0), F.col(f"{prefix}_plvl"))  # exact for whole numbers
    pts = (pts.withColumn(f"{prefix}_pcx", F.floor(F.col(f"{prefix}_pu") * scale).cast("bigint"))
           .withColumn(f"{prefix}_pcy", F.floor(F.col(f"{prefix}_pv") * scale).cast("bigint")))
    cond = ((F.col(f"{prefix}_pk") == F.col(f"{prefix}_bkey")) & (F.col(f"{prefix}_plvl") == F.col(f"{prefix}_clvl"))
            & (F.col(f"{prefix}_pcx") == F.col(f"{prefix}_cx")) & (F.col(f"{prefix}_pcy") == F.col(f"{prefix}_cy")))
    if salt > 1 and not broadcast:
        cells = cells.withColumn(f"{prefix}_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        pts = pts.withColumn(f"{prefix}_psalt", F.pmod(row_hash, F.lit(salt)).cast("int"))
        cond = cond & (F.col(f"{prefix}_psalt") == F.col(f"{prefix}_salt"))
    j = pts.join(cells, cond, "left")
    inside = F.filter(
        F.col(f"{prefix}_cands"),
        lambda p: (px >= p["_xmin"]) & (px <= p["_xmax"]) & (py >= p["_ymin"]) & (py <= p["_ymax"])
        & _inside_cell(p["_edges"], p["_odd"], px, py))
    hit = F.try_element_at(inside, F.lit(1))
    j = j.withColumn(f"{prefix}_hit", hit)
    out = j.select(*points.columns, F.col(f"{prefix}_hit._pid").alias(f"{prefix}pid"),
                   *[F.col(f"{prefix}_hit").getField(a).alias(f"{prefix}{a}") for a in layer.attrs])
    return out


def first_containing(points: DataFrame, layer: Layer, key: str, x: str, y: str, borough: str,
                     prefix: str = "", broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Points with the attributes of the containing polygon of smallest id (NULLs when none)."""
    return locate(points, layer, x, y, borough, prefix, broadcast_limit)


def unmatched_boroughs(points: DataFrame, polygons: DataFrame, borough: str, borough_col: str) -> DataFrame:
    """Points whose borough bucket has no polygon at all, counted per raw borough value."""
    keys = polygons.select(borough_key(F.col(borough_col)).alias("_bkey")).distinct()
    return (points.withColumn("_pk", borough_key(F.col(borough)))
            .join(keys, F.col("_pk") == F.col("_bkey"), "left_anti")
            .groupBy(F.col("_pk").alias("borough_key")).agg(F.count(F.lit(1)).alias("n_points")))
