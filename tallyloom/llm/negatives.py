"""Hard-negative mining by inner product over a packed R-tree.

Rows are packed by sort-tile-recursive: sorted by label and a coordinate over the whole table and cut in tiles, in a
tile sorted and sliced along one coordinate after the other until a slice fits a leaf. Leaves and the nodes
above them keep the least and the greatest value of every coordinate, which bound the inner product of an anchor with any
row below: each coordinate gives an interval, and the intervals add up.

A search keeps a queue of nodes, the greatest bound first. A node is left out when its bounds miss every score window
or when, for every window, its bound is strictly below the last of the rows found so far; at equal bounds it is
opened, since a smaller id may decide. An anchor's windows share one queue.

Tiles and anchors meet by an equal join on the tile's number, in groups of one tile and a bounded number of anchors: the set of
anchors is searched against all rows in blocks. A group gives its first rows of each window, and the first of those of all
tiles are the answer. First the positives are sought, rows of the anchor's label, then the negatives in the score
windows that the positives set.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import mapped, read, ship, stored

POSITIVES = 5
NEGATIVES = 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
SCALE = 256
ANCHOR_EVERY = 100
#: Rows of a tile, of a leaf, children of a node, anchors that meet a tile at once.
TILE_ROWS = 4_096
LEAF_ROWS = 128
FANOUT = 8
ANCHORS_AT_ONCE = 4_096
#: Rows of a partition of the sort that all tiles are cut from.
SORTED_ROWS = 1 << 18

EXACT = 2**53
LEAVES = "tile bigint, leaf int, width int, rows array<bigint>, ids array<bigint>, labels array<bigint>, points array<bigint>"


def prepared(embeddings: DataFrame) -> DataFrame:
    """The rows that take part: ``row`` (a number of its own), ``id``, ``label`` and ``point``, whole numbers.

    Rows with a missing label, a missing vector, or a missing or non-finite component take no part. Rows that repeat
    an id are rows of their own; a missing id is no anchor and comes behind all ids. Other columns are ignored.
    """
    number = F.col("vec_id").cast("bigint")
    label = F.col("label").cast("bigint")
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select(number.alias("id"), label.alias("label"), vector.alias("vector"))
    rows = rows.filter(F.col("label").isNotNull() & F.col("vector").isNotNull())
    kept = rows.filter(~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    shifted = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    point = F.transform("vector", lambda x: F.floor(x * SCALE))
    return kept.select("id", shifted.alias("label"), point.alias("point")).withColumn("row", F.monotonically_increasing_id())


def tiled(points: DataFrame, tile_rows: int = TILE_ROWS) -> tuple[DataFrame, int]:
    """``points`` with the number of their ``tile``, and how many tiles there are.

    Sorted by label, first coordinate and row, so that equal vectors may lie in several tiles, and cut every ``tile_rows`` rows.
    """
    total = points.count()
    tiles = -(-total // tile_rows)
    order = ["label", F.get("point", F.lit(0)), "row"]
    parts = max(8, -(-total // SORTED_ROWS))
    dealt = points.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    dealt = stored(dealt, "sorted-vectors").withColumn("part", F.shiftright("at", 33))
    # One row for each partition.
    sizes = dealt.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(F.col("part").alias("__part"), (before - F.col("first")).alias("shift"))
    numbered = dealt.join(F.broadcast(starts), F.col("part") == F.col("__part"))
    return numbered.select("row", "id", "label", "point", F.expr(f"(at + shift) div {tile_rows}").alias("tile")), tiles


def _matrix(points: list[np.ndarray], width: int) -> np.ndarray:
    """Rows of equal width: a shorter vector has zeros behind it."""
    out = np.zeros((len(points), width), dtype=np.int64)
    for i, point in enumerate(points):
        out[i, : len(point)] = point
    return out


def str_leaves(points: np.ndarray, leaf_rows: int = LEAF_ROWS) -> list[np.ndarray]:
    """Positions of the rows of each leaf: sort-tile-recursive over the coordinates, the widest spread first."""
    spread = points.max(axis=0).astype(float) - points.min(axis=0) if len(points) else np.zeros(points.shape[1])
    axes = np.argsort(-spread, kind="stable").tolist()

    def slices(own: np.ndarray, depth: int) -> Iterator[np.ndarray]:
        leaves = -(-len(own) // leaf_rows)
        if leaves <= 1 or not axes:
            yield from (own[low : low + leaf_rows] for low in range(0, len(own), leaf_rows))
            return
        left = max(1, len(axes) - depth)
        slabs = max(2, int(np.ceil(leaves ** (1 / left))))
        step = -(-leaves // slabs) * leaf_rows
        order = own[np.argsort(points[own, axes[depth % len(axes)]], kind="stable")]
        for low in range(0, len(order), step):
            yield from slices(order[low : low + step], depth + 1)

    return list(slices(np.arange(len(points)), 0))


def packed(numbered: DataFrame, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """The leaf pages of every tile's tree, in the order of packing."""

    def pages(own: pa.Table) -> pa.Table:
        vectors = [np.asarray(value.values.to_numpy(zero_copy_only=False), dtype=np.int64) for value in own["point"].combine_chunks()]
        width = max(map(len, vectors), default=0)
        points = _matrix(vectors, width)
        rows, labels = own["row"].to_numpy(), own["label"].to_numpy()
        ids = own["id"].to_pylist()
        found = []
        for leaf, at in enumerate(str_leaves(points, leaf_rows)):
            found.append((own["tile"][0].as_py(), leaf, width, rows[at].tolist(), [ids[i] for i in at], labels[at].tolist(), points[at].ravel().tolist()))
        kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 4]
        names = [column.split()[0] for column in LEAVES.split(", ")]
        return pa.table([pa.array(column, kind) for column, kind in zip(zip(*found, strict=True), kinds, strict=True)], names)

    ship(numbered.sparkSession)
    return numbered.groupBy("tile").applyInArrow(pages, LEAVES)


@dataclass
class Node:
    """A leaf with its rows, or a node with its children; ``least`` and ``most`` of every coordinate below."""

    least: np.ndarray
    most: np.ndarray
    labels: frozenset
    children: list[Node] = field(default_factory=list)
    lows: np.ndarray | None = None  # of the children, stacked
    highs: np.ndarray | None = None
    rows: np.ndarray | None = None
    ids: list | None = None
    label: np.ndarray | None = None
    points: np.ndarray | None = None


def tree(leaves: list[Node], fanout: int = FANOUT) -> Node:
    """The tree over leaves in their packed order."""
    level = leaves
    while len(level) > 1:
        above = []
        for low in range(0, len(level), fanout):
            own = level[low : low + fanout]
            lows, highs = np.array([n.least for n in own]), np.array([n.most for n in own])
            above.append(Node(lows.min(axis=0), highs.max(axis=0), frozenset().union(*(n.labels for n in own)), own, lows, highs))
        level = above
    return level[0]


def _greatest(anchor: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Upper bounds of the inner products: the greater end of every coordinate's interval, added up."""
    return highs @ np.maximum(anchor, 0) + lows @ np.minimum(anchor, 0)


def _least(anchor: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    return lows @ np.maximum(anchor, 0) + highs @ np.minimum(anchor, 0)


@dataclass
class Wanted:
    """The first ``k`` rows with scores from ``low`` to ``high``: score descending, then id, a missing id last, then row."""

    low: float
    high: float
    k: int
    found: list[tuple] = field(default_factory=list)

    def misses(self, least: float, greatest: float) -> bool:
        if greatest < self.low or least > self.high:
            return True
        return len(self.found) >= self.k and min(greatest, self.high) < -self.found[self.k - 1][0]

    def offer(self, scores: np.ndarray, node: Node, allowed: np.ndarray) -> None:
        at = np.flatnonzero(allowed & (scores >= self.low) & (scores <= self.high))
        if len(self.found) >= self.k:
            at = at[scores[at] >= -self.found[self.k - 1][0]]
        if not len(at):
            return
        if len(at) > self.k:  # all that tie with the last of the first k stay
            last = np.partition(scores[at], len(at) - self.k)[len(at) - self.k]
            at = at[scores[at] >= last]
        more = [(-int(scores[i]), node.ids[i] is None, node.ids[i] or 0, int(node.rows[i])) for i in at.tolist()]
        self.found = heapq.nsmallest(self.k, self.found + more)


def search(root: Node, anchor: np.ndarray, row: int, label: int, same_label: bool, windows: list[Wanted]) -> None:
    """Fill the windows with an anchor's first rows of its own label, but itself, or of other labels."""

    def fits(node: Node) -> bool:
        return label in node.labels if same_label else node.labels != {label}

    whole = _greatest(anchor, root.least[None], root.most[None])[0], _least(anchor, root.least[None], root.most[None])[0]
    queue: list[tuple] = [(-whole[0], 0, whole[1], root)] if fits(root) else []
    pushed = 1
    while queue:
        greatest, _, least, node = heapq.heappop(queue)
        if all(window.misses(least, -greatest) for window in windows):
            continue
        if node.children:
            tops, bottoms = _greatest(anchor, node.lows, node.highs), _least(anchor, node.lows, node.highs)
            for child, top, bottom in zip(node.children, tops.tolist(), bottoms.tolist(), strict=True):
                if fits(child) and not all(window.misses(bottom, top) for window in windows):
                    heapq.heappush(queue, (-top, pushed, bottom, child))
                    pushed += 1
            continue
        scores = node.points @ anchor
        allowed = (node.label == label) & (node.rows != row) if same_label else node.label != label
        for window in windows:
            if not window.misses(least, -greatest):
                window.offer(scores, node, allowed)


def _search_tile(same_label: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The search of one tile for a group of anchors, as a function for cogrouped tables."""

    def searched(pages: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if pages.num_rows and asked.num_rows:
            anchors = [np.asarray(value.values.to_numpy(zero_copy_only=False), dtype=np.int64) for value in asked["point"].combine_chunks()]
            width = max(pages["width"][0].as_py(), *map(len, anchors))
            anchors = _matrix(anchors, width)
            stacked = []
            for page in sorted(pages.to_pylist(), key=lambda page: page["leaf"]):
                own = np.array(page["points"], dtype=np.int64).reshape(-1, page["width"]) if page["width"] else np.zeros((len(page["rows"]), 0), np.int64)
                stacked.append(np.pad(own, ((0, 0), (0, width - page["width"]))))
            # Products of doubles are exact as long as every sum of them is; beyond that, whole numbers of any size.
            largest = [max((abs(int(f(m))) for m in ms for f in (np.min, np.max) if m.size), default=0) for ms in (stacked, [anchors])]
            kind = np.float64 if width * largest[0] * largest[1] < EXACT else object
            leaves = []
            for page, own in zip(sorted(pages.to_pylist(), key=lambda page: page["leaf"]), stacked, strict=True):
                own = own.astype(kind)
                leaves.append(Node(own.min(axis=0), own.max(axis=0), frozenset(page["labels"]), rows=np.array(page["rows"]), ids=page["ids"], label=np.array(page["labels"]), points=own))
            root = tree(leaves)
            for anchor, row, label, windows in zip(anchors.astype(kind), asked["row"].to_pylist(), asked["label"].to_pylist(), asked["windows"].to_pylist(), strict=True):
                wanted = [Wanted(w["low"] if w["low"] is not None else -np.inf, w["high"] if w["high"] is not None else np.inf, w["k"]) for w in windows]
                search(root, anchor, row, label, same_label, wanted)
                for window, own in zip(windows, wanted, strict=True):
                    found.extend((row, window["window"], -score, None if missing else number, other) for score, missing, number, other in own.found)
        columns = list(zip(*found, strict=True)) or [()] * 5
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table([pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], ["anchor", "window", "score", "id", "other"])

    return searched


def first_rows(pages: DataFrame, asked: DataFrame, same_label: bool, anchors_at_once: int = ANCHORS_AT_ONCE) -> DataFrame:
    """The first rows of every window over all tiles: ``anchor``, ``window``, ``score``, ``id``, ``other`` and ``place``.

    ``asked`` has ``number``, ``row``, ``label``, ``point``, ``tiles`` (the tiles to search) and ``windows``.
    """
    part = F.floor(F.col("number") / anchors_at_once).cast("bigint")
    asked = asked.withColumn("part", part).withColumn("tile", F.explode("tiles")).select("tile", "part", "row", "label", "point", "windows")
    groups = asked.select("tile", "part").distinct().withColumnsRenamed({"tile": "__tile", "part": "__part"})
    dealt = pages.join(groups, F.col("tile") == F.col("__tile")).select(F.col("__part").alias("part"), *pages.columns)
    ship(pages.sparkSession)
    schema = "anchor bigint, window int, score bigint, id bigint, other bigint"
    found = dealt.groupBy("tile", "part").cogroup(asked.groupBy("tile", "part")).applyInArrow(_search_tile(same_label), schema)
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("id"), "other")
    return found.withColumn("place", F.row_number().over(order))


def hard_negatives(
    embeddings: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low_percent: int = LOW_PERCENT,
    high_percent: int = HIGH_PERCENT,
    anchor_every: int = ANCHOR_EVERY,
    tile_rows: int = TILE_ROWS,
    leaf_rows: int = LEAF_ROWS,
    anchors_at_once: int = ANCHORS_AT_ONCE,
) -> DataFrame:
    """For every anchor and each of its positives, the first rows of another label in the positive's score window.

    Anchors are the rows whose id ``anchor_every`` divides. Vectors of unequal lengths are compared as if the shorter one had
    zeros behind it. An anchor that repeats an id is searched for on its own, and has its twin for a positive. An
    anchor without positives, a window without rows and an empty table give no rows. A score beyond 64 bits is an error.
    """
    numbered, tiles = tiled(stored(prepared(embeddings), "vectors"), tile_rows)
    numbered = stored(numbered, "tiled-vectors")
    pages = stored(packed(numbered, leaf_rows), "leaves")
    anchors = numbered.filter(F.col("id") % anchor_every == 0).select("row", "id", "label", "point").withColumn("number", F.pmod(F.xxhash64("row"), F.lit(2**40)))
    # Anchors are parted by a hash of their row, in as many parts as hold a bounded number each.
    parts = max(1, -(-anchors.count() // anchors_at_once))
    anchors = stored(anchors.withColumn("number", F.pmod("number", F.lit(parts)) * anchors_at_once), "anchors")

    of_label = numbered.groupBy("label").agg(F.sort_array(F.collect_set("tile")).alias("tiles")).withColumnRenamed("label", "__label")
    anything = F.struct(F.lit(0).alias("window"), F.lit(None).cast("bigint").alias("low"), F.lit(None).cast("bigint").alias("high"), F.lit(positives).alias("k"))
    asked = anchors.join(of_label, F.col("label") == F.col("__label")).withColumn("windows", F.array(anything))
    near = stored(first_rows(pages, asked, True, anchors_at_once).filter(F.col("place") <= positives), "positives")

    exact = F.col("score").cast("decimal(38,0)")
    low, high = F.ceil(exact * low_percent / 100).cast("bigint"), F.floor(exact * high_percent / 100).cast("bigint")
    window = F.struct(F.col("place").alias("window"), low.alias("low"), high.alias("high"), F.lit(negatives).alias("k"))
    windows = near.filter("score >= 0").groupBy(F.col("anchor").alias("__anchor")).agg(F.sort_array(F.collect_list(window)).alias("windows"))
    asked = anchors.join(windows, F.col("row") == F.col("__anchor")).withColumn("tiles", F.sequence(F.lit(0), F.lit(max(tiles, 1) - 1)).cast("array<bigint>"))
    far = first_rows(pages, asked, False, anchors_at_once).filter(F.col("place") <= negatives)

    pairs = near.select(F.col("anchor").alias("__anchor"), F.col("place").alias("__window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = anchors.select(F.col("row").alias("__row"), F.col("id").alias("anchor_id"))
    rows = far.join(pairs, (F.col("anchor") == F.col("__anchor")) & (F.col("window") == F.col("__window"))).join(named, F.col("anchor") == F.col("__row"))
    return rows.select("anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding against all embeddings."""
    return hard_negatives(read(spark, sf_dir, "embeddings"))


OP12_SQL = f"""
with e as (
  select row_number() over () as row, vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         [floor({SCALE} * x::double) for x in embedding] as point
  from embeddings
  where label is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (
  select a.row as anchor, a.id as anchor_id, b.row as other, b.id, a.label = b.label as same, list_inner_product(a.point, b.point)::bigint as score
  from e as a, e as b where a.id % {ANCHOR_EVERY} = 0 and a.row <> b.row),
p as (
  select anchor, anchor_id, id as positive_id, score as positive_score, row_number() over (partition by anchor order by score desc, id, other) as place
  from s where same),
n as (
  select p.anchor_id, p.positive_id, s.id as negative_id, p.positive_score, s.score as negative_score,
         row_number() over (partition by p.anchor, p.place order by s.score desc, s.id, s.other)::int as rank
  from p join s using (anchor)
  where p.place <= {POSITIVES} and not s.same and {LOW_PERCENT} * p.positive_score <= 100 * s.score and 100 * s.score <= {HIGH_PERCENT} * p.positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= {NEGATIVES}
"""
