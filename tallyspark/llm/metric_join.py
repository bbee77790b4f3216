"""Embedding near-duplicates by an exact metric range join.

Two vectors of one label link when their cosine is at least a threshold, that
is when the unit vectors lie within a radius r of each other. Equal vectors of
a label form one class first, so copies cost nothing. Pivots, dense spots of a
bounded sample (``SAMPLE_ROWS`` rows; any pivots give the same result), cut
each label into cells: a vector is at home with its nearest pivot. A vector x
at home at h also visits a cell p before h in the order if some point of p may
be within r of it: by the triangle inequality only if x lies within r of the
plane between the pivots, (d(x,p)^2 - d(x,h)^2) / (2 d(h,p)) <= r, and within r
of the cell's farthest point, d(x,p) <= r + R(p). So every pair that may link
meets in exactly one cell, and cells join independently.

A cell is dealt into rings of distance from its pivot, and rings into blocks of
about ``BLOCK_ROWS`` vectors, so that no cell is one task: pairs of blocks whose
rings lie more than r apart are left out (triangle inequality once more), pairs
inside the ball of radius r / 2 link without a look at them and are counted by
one sum per cell; the other pairs of blocks are compared exactly, each in a task
of its own. A task returns for each vector how many vectors it links with and
one edge of a spanning forest, never the pairs.

Defined results: a vector that is null, zero or holds a null or non-finite
component, or whose label is null, links with nothing; of vectors of different
length the shorter counts as padded with zeros; rows that repeat an id are
vectors of their own; component_id is the smallest non-null id of the
component (null if it has none); a null id is kept if its component has no
other; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash
from .jaccard import components

THRESHOLD = 0.93
SAMPLE_ROWS = 8192
BLOCK_ROWS = 1024
#: A pivot must have this share of its label's sample around it; so a label has at most 20 and one for the rest.
PIVOT_SHARE = 0.05
PIVOT_ROWS = 4
#: Rings of distance per radius.
RINGS = 4
#: Slack of all bounds against rounding of distances.
SLACK = 1e-7
#: Vectors that hold more than this share of all rows (so fewer than 200) are looked up by broadcast.
HOT_SHARE = 1 / 200

_PLACED = "label long, cell int, home boolean, ring int, node long, weight long, unit array<double>"
_BLOCK = "label long, cell int, home boolean, ring int, part long, nodes binary, weights binary, width int, units binary"


def _usable() -> F.Column:
    # An unordered comparison with null or NaN is not true, so these fail the test too.
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return F.coalesce(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda c: c != 0), F.lit(False))


def classes(rows: DataFrame) -> DataFrame:
    """(node, label, embedding, weight, low_id): the different usable vectors
    of each label. Trailing zeros do not make a vector different."""
    found = rows.groupBy("label", "embedding").agg(F.count("*").alias("weight"), F.min("vec_id").alias("low_id"))
    return stash(found.select(F.monotonically_increasing_id().alias("node"), "label", "embedding", "weight", "low_id"), "metric-classes")


def unit_rows(vectors) -> np.ndarray:
    """Unit vectors, padded to the longest, in double precision."""
    out = np.zeros((len(vectors), max((len(v) for v in vectors), default=0)))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    out /= np.abs(out).max(axis=1, initial=1e-320)[:, None]
    return out / np.sqrt((out * out).sum(axis=1))[:, None]


def _widen(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] >= width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    width = max(a.shape[1], b.shape[1])
    return np.sqrt(np.maximum(2 - 2 * (_widen(a, width) @ _widen(b, width).T), 0))


def dense_spots(units: np.ndarray, radius: float) -> np.ndarray:
    """The sample's vector with the most others within half a radius, then
    the next among those not yet covered; at least one."""
    near = _distances(units, units) <= radius / 2
    open_, chosen = np.ones(len(units), bool), []
    least = max(PIVOT_ROWS, PIVOT_SHARE * len(units))
    while open_.any():
        gain = (near & open_[None, :]).sum(axis=1)
        best = int(gain.argmax())
        if chosen and gain[best] < least:
            break
        chosen.append(best)
        open_ &= ~near[best]
    return units[chosen]


def choose_pivots(nodes: DataFrame, radius: float, sample_rows: int = SAMPLE_ROWS) -> dict[int, np.ndarray]:
    """Pivots of each label that the sample meets (``sample_rows`` rows by a
    hash of the node, so at most so many vectors reach the driver). A row
    with many copies is no likelier than another."""
    drawn = nodes.orderBy(F.xxhash64("node"), "node").limit(sample_rows).select("label", "embedding").toPandas()
    return {int(label): dense_spots(unit_rows(own["embedding"].tolist()), radius) for label, own in drawn.groupby("label")}


def _nearest(units: np.ndarray, pivots: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distances to all pivots, the nearest one's number and its distance (-1: unknown)."""
    if pivots is None:  # a label that the sample missed is one cell around nothing
        unknown = np.full(len(units), -1.0)
        return unknown[:, None], np.zeros(len(units), int), unknown
    d = _distances(units, pivots)
    home = d.argmin(axis=1)
    return d, home, d[np.arange(len(d)), home]


def place(nodes: DataFrame, pivots: dict[int, np.ndarray], radius: float) -> DataFrame:
    """Home rows and visits of every vector (see the module's head)."""
    shared = nodes.sparkSession.sparkContext.broadcast(pivots)  # SAMPLE_ROWS vectors at most
    step = radius / RINGS

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for label, own in pdf.groupby("label"):
                _, home, d = _nearest(unit_rows(own["embedding"].tolist()), shared.value.get(int(label)))
                far = pd.DataFrame({"label": int(label), "cell": home, "far": d}).groupby(["label", "cell"], as_index=False).max()
                yield far.astype({"label": "int64", "cell": "int32"})
    far = nodes.select("label", "embedding").mapInPandas(reach, "label long, cell int, far double")
    # One row per cell: as many as there are pivots and labels without one; the latter need no bound.
    bounds = {(r["label"], r["cell"]): r["far"] for r in far.groupBy("label", "cell").agg(F.max("far").alias("far")).where("far > 0").collect()}

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for label, own in pdf.groupby("label"):
                label = int(label)
                units, p = unit_rows(own["embedding"].tolist()), shared.value.get(label)
                d, home, least = _nearest(units, p)
                at = [np.arange(len(units))]
                cell, distance = [home], [least]
                for c in range(d.shape[1] - 1):
                    gap = np.maximum(_distances(p[home], p[c:c + 1])[:, 0], 1e-12)
                    visits = (c < home) & (d[:, c] ** 2 - least**2 <= 2 * gap * (radius + SLACK)) & (d[:, c] <= radius + bounds.get((label, c), 0.0) + SLACK)
                    at.append(np.flatnonzero(visits))
                    cell.append(np.full(len(at[-1]), c))
                    distance.append(d[at[-1], c])
                rows = np.concatenate(at)
                yield pd.DataFrame({
                    "label": label, "cell": np.concatenate(cell).astype(np.int32), "home": np.arange(len(rows)) < len(units),
                    # Vectors at an unknown distance share one ring outside the ball that links without a look.
                    "ring": np.where((ring := np.concatenate(distance) / step) < 0, RINGS, ring).astype(np.int32), "node": own["node"].to_numpy()[rows],
                    "weight": own["weight"].to_numpy()[rows], "unit": list(units[rows])})
    return stash(nodes.select("node", "label", "embedding", "weight").mapInPandas(work, _PLACED), "metric-placed")


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("node")
    first = pdf.iloc[0]
    units = pdf["unit"].tolist()
    width = max(len(u) for u in units)
    data = np.array([np.pad(u, (0, width - len(u))) for u in units])
    return pd.DataFrame([(int(first["label"]), int(first["cell"]), bool(first["home"]), int(first["ring"]), int(first["part"]),
                          pdf["node"].to_numpy(np.int64).tobytes(), pdf["weight"].to_numpy(np.int64).tobytes(), width, data.tobytes())],
                        columns=[c.split()[0] for c in _BLOCK.split(", ")])


def link_blocks(a: tuple, b: tuple | None, threshold: float) -> list[tuple[int, int, int]]:
    """(node, links, root) of vectors that link across blocks a and b, or
    within a where b is None; root is the smallest node joined with it.

    A block is (nodes, weights, units)."""
    same, other = b is None, a if b is None else b
    width = max(a[2].shape[1], other[2].shape[1])
    meets = _widen(a[2], width) @ _widen(other[2], width).T >= threshold
    if same:
        np.fill_diagonal(meets, False)
    count_a, count_b = meets @ other[1], meets.T @ a[1]
    far = np.iinfo(np.int64).max
    low_a, low_b = a[0].copy(), other[0].copy()
    rows, cols = np.flatnonzero(count_a), np.flatnonzero(count_b)
    meets = meets[np.ix_(rows, cols)]
    while len(rows):
        new_a = np.minimum(low_a[rows], np.where(meets, low_b[cols][None, :], far).min(axis=1))
        new_b = np.minimum(low_b[cols], np.where(meets, new_a[:, None], far).min(axis=0))
        still = (new_a == low_a[rows]).all() and (new_b == low_b[cols]).all()
        low_a[rows], low_b[cols] = new_a, new_b
        if same:
            low_a = low_b = np.minimum(low_a, low_b)
        if still:
            break
    out = [(int(a[0][i]), int(count_a[i]), int(low_a[i])) for i in rows]
    return out if same else out + [(int(other[0][i]), int(count_b[i]), int(low_b[i])) for i in cols]


def _joined(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        blocks = [(np.frombuffer(r.nodes, np.int64), np.frombuffer(r.weights, np.int64), np.frombuffer(r.units).reshape(-1, r.width)) for r in pdf.itertuples()]
        found = link_blocks(blocks[0], blocks[1] if len(blocks) > 1 else None, threshold)
        return pd.DataFrame(found, columns=["node", "links", "root"]).astype("int64")
    return run


def range_links(nodes: DataFrame, threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(node, links, root): for every vector that links with others, rows
    whose links (copies counted) add up to its number, and edges to roots that
    connect what links connect. ``nodes``: see ``classes``."""
    radius = float(np.sqrt(2 - 2 * threshold))
    placed = place(nodes, choose_pivots(nodes, radius, sample_rows), radius)
    key = ["label", "cell", "home", "ring"]
    sizes = placed.groupBy(*key).count().where(F.col("count") > block_rows).withColumnRenamed("count", "rows")
    part = F.pmod(F.xxhash64("node"), F.coalesce(F.ceil(F.col("rows") / block_rows), F.lit(1).cast("long")))
    packed = placed.join(sizes, key, "left").withColumn("part", part).drop("rows").groupBy(*key, "part").applyInPandas(_pack, _BLOCK)
    blocks = stash(packed.withColumn("block", F.monotonically_increasing_id()), "metric-blocks")

    meta = blocks.select("block", *key, "part")
    a, b = (meta.select("label", "cell", *[F.col(c).alias(f"{n}_{c}") for c in ("block", "home", "ring", "part")]) for n in "ab")
    inner = RINGS // 2  # rings within half the radius
    order = (F.col("a_ring") < F.col("b_ring")) | ((F.col("a_ring") == F.col("b_ring")) & (F.col("a_part") <= F.col("b_part")))
    once = F.col("a_home") & (~F.col("b_home") | order)
    close = F.abs(F.col("a_ring") - F.col("b_ring")) - 1 <= RINGS
    sure = F.col("b_home") & (F.col("a_ring") < inner) & (F.col("b_ring") < inner)
    pairs = a.join(b, ["label", "cell"]).where(once & close & ~sure).select("a_block", "b_block")
    sides = pairs.select("a_block", "b_block", F.col("a_block").alias("block")).unionByName(
        pairs.where("a_block <> b_block").select("a_block", "b_block", F.col("b_block").alias("block")))
    data = blocks.select("block", "nodes", "weights", "width", "units")
    tasks = sides.join(data, "block").groupBy("a_block", "b_block")
    across = tasks.applyInPandas(_joined(threshold), "node long, links long, root long")

    # Vectors in the ball of half the radius around a pivot all link with one another.
    ball = placed.where(F.col("home") & (F.col("ring") < inner)).select("label", "cell", "node", "weight")
    sums = ball.groupBy("label", "cell").agg(F.sum("weight").alias("all"), F.min("node").alias("root"), F.count("*").alias("vectors"))
    sums = sums.where("vectors > 1")
    inside = ball.join(sums, ["label", "cell"]).select("node", (F.col("all") - F.col("weight")).alias("links"), "root")
    return across.unionByName(inside)


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    usable = _usable()
    # Zeros at the end change no cosine; without them equal vectors are equal arrays.
    last = F.array_max(F.transform("embedding", lambda c, i: F.when(c != 0, i + 1).otherwise(0)))
    able = rows.where(usable).withColumn("embedding", F.slice("embedding", F.lit(1), last))
    nodes = classes(able)
    found = stash(range_links(nodes, threshold, sample_rows, block_rows), "metric-links")
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a <> b"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = nodes.join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lows = grouped.groupBy("root").agg(F.min("low_id").alias("component_id"), F.sum("weight").alias("rows"))
    judged = grouped.join(lows, "root").select(
        F.col("label").alias("of_label"), F.col("embedding").alias("of"), "weight", "component_id", "rows",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    judged = stash(judged, "metric-judged")

    # Rows take their class's figures; very common vectors by broadcast, so that none makes one task's key.
    total = nodes.agg(F.sum("weight")).first()[0] or 0
    hot = judged.where(F.col("weight") > max(1, int(total * HOT_SHARE)))
    same = (F.col("label") == F.col("of_label")) & (F.col("embedding") == F.col("of"))
    figures = ["n_links", "component_id", "rows"]
    tagged = able.join(F.broadcast(hot), same, "left").select("vec_id", "label", "embedding", *[F.col(c).alias(f"hot_{c}") for c in figures])
    done = tagged.where("hot_rows is not null").select("vec_id", *[F.col(f"hot_{c}").alias(c) for c in figures])
    rest = tagged.where("hot_rows is null").select("vec_id", "label", "embedding").join(judged.drop("weight"), same).select("vec_id", *figures)
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(1).cast("long").alias("rows"))
    out = done.unionByName(rest).unionByName(alone)
    kept = F.when(F.col("vec_id").isNull(), F.col("rows") == 1).otherwise(F.col("vec_id") == F.col("component_id"))
    return out.select("vec_id", "n_links", "component_id", kept.alias("kept"))


def op11_metric_join(embeddings: DataFrame) -> DataFrame:
    return near_duplicates(embeddings)


ORACLE = f"""
with recursive v as (
  select row_number() over () as node, vec_id, label, embedding::double[] as e,
         label is not null and embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
         and len(list_filter(embedding, lambda c: c <> 0)) > 0 as usable
  from embeddings),
links as (
  select a.node as a, b.node as b from v a join v b on a.label = b.label and a.node <> b.node and a.usable and b.usable
  where list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
reach(a, b) as (select node, node from v union select r.a, l.b from reach r join links l on r.b = l.a),
parts as (select r.a as node, min(v.vec_id) as component_id from reach r join v on v.node = r.b group by r.a),
counts as (select a as node, count(*) as n from links group by a)
select v.vec_id, coalesce(c.n, 0)::bigint as n_links, p.component_id::bigint as component_id, v.vec_id = p.component_id as kept
from v join parts p on p.node = v.node left join counts c on c.node = v.node
"""
