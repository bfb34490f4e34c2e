"""Hard negatives by a cover tree over norm-augmented vectors, without loss.

A vector x gets one more component, sqrt(M^2 - |x|^2) with M the largest norm, and an anchor q gets a zero there.  Then all
vectors lie on a sphere of radius M and <q, x> = |q| M cos(angle of q and x): the larger the inner product the nearer.
A tree node holds vectors within a covering angle R of its centre, so their inner products with q lie between
|q| M cos(angle + R) and |q| M cos(angle - R).

* The top level is a net of at most CENTRES vectors of a bounded sample (farthest first).  Every vector goes to the nearest
  of them; the covering angles are taken over all vectors, so the bounds hold whatever the sample.
* A node's vectors are dealt in blocks of about BLOCK.  A task builds the lower levels over a block: children are
  a net of the node's vectors, farthest first until the covering angle halves, down to leaves of LEAF vectors.
* An anchor descends best first, by the largest inner product a node may hold.  Nodes outside all of the anchor's windows, or that can't
  reach what it has found already, are skipped; vectors of a leaf are scored exactly, in integers.

An anchor visits one node of the top level first; what it finds there bounds what it asks of the others.  Tasks
hand on at most the wanted number of rows per window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spread import Batches, gathered, groups, shared, stage

#: Vectors the top level is drawn from, nodes of the top level at most, vectors and anchors that meet in a task.
SAMPLE = 8192
CENTRES = 1024
BLOCK = 2048
ANCHORS = 1024
LEAF = 32
FAN = 32
#: Anchors that descend together.
SLICE = 128
#: The factor of components, positives of an anchor, negatives of a positive.
SCALE = 256
POSITIVES = NEGATIVES = 5
#: Vectors with a squared norm from here on have no place among long scores.
NORM_LIMIT = 1 << 60
#: Angles are told to about 1e-8; all bounds are widened by this.
SLACK = 1e-7
LOW, HIGH = -(1 << 62), 1 << 62

VECTOR = "row long, vec_id long, label long, vector array<int>, square long"
WINDOWS = "array<struct<lo:long,hi:long,floor:long>>"
HITS = "anchor long, hi long, score long, vec_id long, row long"


def _whole_numbers(batches: Batches) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, embedding) to scaled whole components; rows that can't take part go."""
    for batch in batches:
        ids, labels, vectors, squares = [], [], [], []
        for vec_id, label, embedding in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "label", "embedding"))):
            if any(x is None for x in embedding):
                continue
            with np.errstate(over="ignore"):
                v = np.floor(SCALE * np.array(embedding, np.float64))
            if not np.isfinite(v).all() or (np.abs(v) >= 1 << 30).any() or float(v @ v) >= NORM_LIMIT:
                continue
            whole = v.astype(np.int64)
            ids.append(vec_id)
            labels.append(label)
            vectors.append(whole.astype(np.int32))
            squares.append(int(whole @ whole))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(vectors, pa.list_(pa.int32())), pa.array(squares, pa.int64())],
            names=["vec_id", "label", "vector", "square"],
        )


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Lists as rows of ``dim`` numbers; shorter ones are filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def on_sphere(vectors: np.ndarray, squares: np.ndarray, most: int) -> np.ndarray:
    """Unit vectors with the augmenting component last."""
    rest = np.sqrt(np.maximum(0.0, (most - squares).astype(np.float64)))
    out = np.concatenate([vectors.astype(np.float64), rest[:, None]], axis=1)
    return out / np.sqrt(float(most)) if most else np.concatenate([vectors * 0.0, rest[:, None] + 1], axis=1)


def _unit(vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return np.divide(vectors, norms[:, None], out=np.zeros(vectors.shape), where=norms[:, None] > 0)


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def net(points: np.ndarray, first: int, many: int, enough: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres chosen farthest first, and each point's nearest of them and its angle.

    Stops at ``many`` centres or when all points are within ``enough`` of one.
    """
    chosen = [first]
    nearest = np.zeros(len(points), np.int64)
    angle = angles(points @ points[first])
    while len(chosen) < many:
        far = int(angle.argmax())
        if angle[far] <= enough:
            break
        mine = angles(points @ points[far])
        closer = mine < angle
        nearest[closer] = len(chosen)
        angle[closer] = mine[closer]
        nearest[far], angle[far] = len(chosen), 0.0
        chosen.append(far)
    return np.array(chosen), nearest, angle


@dataclass
class Tree:
    """Nodes as arrays: centre, covering angle, children, and for leaves their points."""

    centres: np.ndarray
    radii: np.ndarray
    children: list[list[int]]
    leaves: list[np.ndarray | None]

    @classmethod
    def over(cls, points: np.ndarray) -> Tree:
        centres, radii, children, leaves = [], [], [], []

        def node(mine: np.ndarray, centre: int, radius: float) -> int:
            at = len(centres)
            centres.append(centre)
            radii.append(radius)
            children.append([])
            leaves.append(mine)
            return at

        start = angles(points @ points[0])
        todo = [node(np.arange(len(points)), 0, float(start.max()))]
        while todo:
            at = todo.pop()
            mine = leaves[at]
            if len(mine) <= LEAF or radii[at] <= SLACK:
                continue
            first = int(np.flatnonzero(mine == centres[at])[0])
            chosen, nearest, angle = net(points[mine], first, FAN, radii[at] / 2)
            for k, c in enumerate(chosen):
                own = nearest == k
                children[at].append(node(mine[own], int(mine[c]), float(angle[own].max())))
            leaves[at] = None
            todo += children[at]
        return cls(np.array(centres), np.array(radii), children, leaves)


def bounds(cosines: np.ndarray, radii: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product that nodes may hold; ``scale`` is |q| M."""
    angle, reach = angles(cosines), radii + SLACK
    wide = scale * SLACK + 1
    return scale * np.cos(np.minimum(np.pi, angle + reach)) - wide, scale * np.cos(np.maximum(0.0, angle - reach)) + wide


def descend(
    tree: Tree, vectors: np.ndarray, asked: np.ndarray, counts: np.ndarray, windows: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """For each anchor's window the first ``wanted`` vectors, those of equal scores in the order given, best first.

    Rows of ``asked`` are anchors, once per window; ``windows`` their (lo, hi, floor): scores up to hi, from lo and floor on, are
    wanted.  ``counts`` tells which vectors may count, ``low`` and ``high`` bound the scores per node.  All anchors descend
    together, and each reads its most promising leaves first, a few, then more, as long as they may hold better scores
    than found.  Returns (anchor, vector, score) and the number of scores computed.
    """
    lo, hi, least = windows[:, 0], windows[:, 1], np.maximum(windows[:, 0], windows[:, 2])
    high = high.copy()
    useful = (low <= hi[:, None]) & (high >= least[:, None])
    for node, below in enumerate(tree.children):  # parents come before their children
        high[:, below] = np.minimum(high[:, below], high[:, [node]])
        useful[:, below] &= useful[:, [node]]
    leaves = [node for node, mine in enumerate(tree.leaves) if mine is not None]
    ceiling = np.where(useful[:, leaves], high[:, leaves], -np.inf)
    turn = np.argsort(np.argsort(-ceiling, axis=1), axis=1)
    scores = np.full((len(asked), len(vectors)), LOW - 1, np.int64)
    first, read = 0, 0
    for upto in (2, 10, 40, len(leaves)):
        now = (turn >= first) & (turn < upto) & (ceiling >= least[:, None])
        for k in np.flatnonzero(now.any(axis=0)):
            who, mine = np.flatnonzero(now[:, k]), tree.leaves[leaves[k]]
            found = (asked[who] @ vectors[mine].T).astype(np.int64)
            read += found.size
            fits = counts[np.ix_(who, mine)] & (found <= hi[who, None]) & (found >= lo[who, None])
            scores[np.ix_(who, mine)] = np.where(fits, found, LOW - 1)
        if len(vectors) >= wanted:
            least = np.maximum(least, np.partition(scores, -wanted, axis=1)[:, -wanted])
        first = upto
    anchor, vector = np.nonzero(scores >= least[:, None])
    score = scores[anchor, vector]
    order = np.lexsort((vector, -score, anchor))
    anchor, vector, score = anchor[order], vector[order], score[order]
    rank = np.arange(len(anchor)) - np.searchsorted(anchor, anchor)
    return anchor[rank < wanted], vector[rank < wanted], score[rank < wanted], read


def _placed(batches: Batches, centres: np.ndarray, dim: int, most: int) -> Iterator[pa.RecordBatch]:
    """Each vector's nearest centre and its angle to it."""
    for batch in batches:
        points = on_sphere(matrix(batch.column("vector"), dim), batch.column("square").to_numpy(zero_copy_only=False), most)
        cosines = points @ centres.T
        node = cosines.argmax(axis=1) if len(points) else np.zeros(0, np.int64)
        angle = angles(cosines[np.arange(len(points)), node])
        arrays = [*batch.columns, pa.array(node.astype(np.int64)), pa.array(angle)]
        yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "node", "angle"])


def _routed(
    batches: Batches, centres: np.ndarray, radii: np.ndarray, dim: int, most: int, first: bool
) -> Iterator[pa.RecordBatch]:
    """(row, vector, square, windows, seen) to the top nodes to visit: one at first, then all others that may still count."""
    for batch in batches:
        squares = batch.column("square").to_numpy(zero_copy_only=False)
        # An anchor's own augmenting component is zero.
        norms = np.sqrt(squares.astype(np.float64))
        unit = _unit(matrix(batch.column("vector"), dim), norms)
        low, high = bounds(unit @ centres[:, :-1].T, radii, (norms * np.sqrt(float(most)))[:, None])
        rows, nodes = [], []
        for i, (row, windows, seen) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("row", "windows", "seen")))):
            useful = np.zeros(len(radii), bool)
            for w in windows:
                useful |= (low[i] <= w["hi"]) & (high[i] >= max(w["lo"], w["floor"]))
            if first:
                top = max(w["hi"] for w in windows)
                middle = (low[i] + high[i]) / 2
                order = np.where(useful & (radii >= 0), np.where(middle <= top, middle, 2.0 * top - middle), -np.inf)
                go = [int(order.argmax())] if useful.any() else []
            else:
                useful[list(seen or [])] = False
                go = np.flatnonzero(useful & (radii >= 0)).tolist()
            rows += [row] * len(go)
            nodes += go
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(nodes, pa.int64())], names=["row", "node"])


def _searched(batches: Batches, dim: int, most: int, same: bool, wanted: int) -> Iterator[pa.RecordBatch]:
    """A block of vectors and the anchors that visit it to each anchor's best rows per window."""
    for group in groups(batches, ["node", "block", "chunk"]):
        asks = group.column("windows").is_valid().to_numpy()
        here, anchors = group.filter(pa.array(~asks)), group.filter(pa.array(asks))
        if not here.num_rows or not anchors.num_rows:
            continue
        vectors, asked = matrix(here.column("vector"), dim), matrix(anchors.column("vector"), dim)
        squares, own = here.column("square").to_numpy(), anchors.column("square").to_numpy()
        ids, labels, rows = (here.column(c).to_numpy() for c in ("vec_id", "label", "row"))
        order = np.lexsort((rows, ids))
        vectors, squares, ids, labels, rows = (x[order] for x in (vectors, squares, ids, labels, rows))
        points = on_sphere(vectors, squares, most)
        tree = Tree.over(points)
        # Sums below 2**53 are exact in doubles.
        exact = float(np.sqrt(own.max())) * float(np.sqrt(squares.max())) < 1 << 52
        left = vectors.astype(np.float64) if exact else vectors
        mine, label = anchors.column("row").to_numpy(), anchors.column("label").to_numpy()
        windows = anchors.column("windows").to_pylist()
        for at in range(0, len(asked), SLICE):
            part = range(at, min(at + SLICE, len(asked)))
            pair = np.array([i for i in part for _ in windows[i]])
            spans = np.array([(w["lo"], w["hi"], w["floor"]) for i in part for w in windows[i]])
            norms = np.sqrt(own[part].astype(np.float64))
            unit = _unit(asked[part], norms)
            low, high = bounds(unit @ points[tree.centres, :-1].T, tree.radii, (norms * np.sqrt(float(most)))[:, None])
            counts = (labels == label[part, None]) & (rows != mine[part, None]) if same else labels != label[part, None]
            q = asked[pair].astype(left.dtype)
            who, other, score, _ = descend(tree, left, q, counts[pair - at], spans, low[pair - at], high[pair - at], wanted)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (mine[pair[who]], spans[who, 1], score, ids[other], rows[other])],
                names=["anchor", "hi", "score", "vec_id", "row"],
            )


@dataclass
class Index:
    """The dealt vectors and the top level."""

    placed: DataFrame  # VECTOR, node, block
    nodes: DataFrame  # node, blocks
    centres: np.ndarray
    radii: np.ndarray  # -1 for a node without vectors
    dim: int
    most: int
    folder: str

    def visits(self, anchors: DataFrame, name: str, first: bool, same: bool, wanted: int, size: int) -> tuple[DataFrame, DataFrame]:
        """Which nodes the anchors (VECTOR, windows, seen) visit, and what they find there."""
        route = partial(_routed, centres=self.centres, radii=self.radii, dim=self.dim, most=self.most, first=first)
        routes = anchors.select("row", "vector", "square", "windows", "seen").mapInArrow(route, "row long, node long")
        routes = stage(routes, self.folder, f"{name}_routes")
        chunks = routes.groupBy("node").agg(F.ceil(F.count("*") / F.lit(size)).cast("int").alias("chunks"))
        dealt = chunks.join(self.nodes, "node")
        asking = (
            routes.join(dealt, "node")
            .withColumn("chunk", F.pmod(F.xxhash64("row"), F.col("chunks")).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .join(anchors.drop("seen"), "row")
        )
        there = self.placed.join(dealt, "node").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        cells = ["node", "block", "chunk", "row", "vec_id", "label", "vector", "square"]
        both = asking.select(*cells, "windows").unionByName(there.select(*cells, F.lit(None).cast(WINDOWS).alias("windows")))
        found = gathered(both, ["node", "block", "chunk"]).mapInArrow(
            partial(_searched, dim=self.dim, most=self.most, same=same, wanted=wanted), HITS
        )
        return routes, stage(found, self.folder, f"{name}_hits")

    def search(self, anchors: DataFrame, name: str, same: bool, wanted: int, size: int) -> DataFrame:
        """HITS with rank: per anchor (VECTOR, windows) and window the first ``wanted`` rows of the same or another label."""
        best = F.expr("row_number() OVER (PARTITION BY anchor, hi ORDER BY score DESC, vec_id, row)")
        routes, hits = self.visits(anchors.withColumn("seen", F.lit(None).cast("array<long>")), f"{name}_1", True, same, wanted, size)
        worst = hits.groupBy("anchor", "hi").agg(F.count("*").alias("n"), F.min("score").alias("worst")).where(F.col("n") >= wanted)
        known = worst.groupBy(F.col("anchor").alias("row")).agg(F.map_from_entries(F.collect_list(F.struct("hi", "worst"))).alias("worst"))
        seen = routes.groupBy("row").agg(F.collect_list("node").alias("seen"))
        floor = lambda w: F.struct(w["lo"].alias("lo"), w["hi"].alias("hi"), F.coalesce(F.col("worst")[w["hi"]], w["floor"]).alias("floor"))
        again = anchors.join(known, "row", "left").join(seen, "row", "left")
        again = stage(again.withColumn("windows", F.transform("windows", floor)).drop("worst"), self.folder, f"{name}_again")
        _, more = self.visits(again, f"{name}_2", False, same, wanted, size)
        return hits.unionByName(more).withColumn("rank", best).where(F.col("rank") <= wanted)


def hard_negatives(
    embeddings: DataFrame,
    *,
    every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    centres: int = CENTRES,
    block: int = BLOCK,
    anchors: int = ANCHORS,
    sample: int = SAMPLE,
) -> DataFrame:
    """Per anchor and positive the best rows of another label whose score is 80 to 100 % of the positive's.

    Rows are (vec_id, embedding, label).  Anchors are rows whose vec_id is divisible by ``every``; an anchor's positives are
    its first other rows of the same label.  Scores are inner products of the components times 256, rounded down; the
    higher comes first, of equal ones the smaller vec_id.  Rows without vec_id or label, and vectors that are null or hold
    null or non-finite components, take no part, nor do vectors so long (2**30 in length, or a component of 2**22) that
    a score might be no long.  Shorter vectors are filled up with zeros; an empty one scores 0.  Positives with a score
    below 0 have no negatives.  Rows that share a vec_id are rows of their own, also as anchors.  The sample draws the
    top level alone; every row is indexed and the result is whole.  Other columns are left out; an empty table gives no rows.
    """
    spark, folder = embeddings.sparkSession, shared(embeddings)
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    usable = rows.mapInArrow(_whole_numbers, "vec_id long, label long, vector array<int>, square long")
    usable = stage(usable.withColumn("row", F.monotonically_increasing_id()), folder, "usable")
    n, dim, most = usable.agg(F.count("*"), F.max(F.size("vector")), F.max("square")).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n:
        return spark.createDataFrame([], schema)
    drawn = usable.orderBy(F.xxhash64("row"), "row").limit(sample).select("vector", "square").toArrow()
    points = on_sphere(matrix(drawn.column("vector"), dim), drawn.column("square").to_numpy(), most)
    chosen, _, _ = net(points, 0, min(centres, -(-n // block)), 0.0)
    place = partial(_placed, centres=points[chosen], dim=dim, most=most)
    columns = [F.col(c) for c in ("row", "vec_id", "label", "vector", "square")]
    placed = stage(usable.select(*columns).mapInArrow(place, f"{VECTOR}, node long, angle double"), folder, "placed")
    # At most a row per centre.
    sizes = placed.groupBy("node").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).collect()
    radii = np.full(len(chosen), -1.0)
    radii[[r["node"] for r in sizes]] = [r["radius"] for r in sizes]
    nodes = spark.createDataFrame([(r["node"], -(-r["n"] // block)) for r in sizes], "node long, blocks int")
    dealt = placed.join(nodes, "node").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    index = Index(dealt.drop("blocks", "angle"), nodes, points[chosen], radii, dim, most, folder)

    asking = usable.where(F.col("vec_id") % every == 0).select(*columns)
    open_ = F.array(F.struct(F.lit(LOW).alias("lo"), F.lit(HIGH).alias("hi"), F.lit(LOW).alias("floor"))).cast(WINDOWS)
    best = index.search(asking.withColumn("windows", open_), "positives", True, positives, anchors)
    best = stage(best.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), folder, "positives")
    span = F.expr("named_struct('lo', (positive_score * 4 + 4) div 5, 'hi', positive_score, 'floor', CAST(%d AS BIGINT))" % LOW)
    spans = best.where("positive_score >= 0").groupBy(F.col("anchor").alias("row")).agg(F.collect_set(span).cast(WINDOWS).alias("windows"))
    hits = index.search(stage(asking.join(spans, "row"), folder, "windows"), "negatives", False, negatives, anchors)
    hits = hits.select("anchor", F.col("hi").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (
        best.join(hits, ["anchor", "positive_score"])
        .join(asking.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def mined_negatives(embeddings: DataFrame) -> DataFrame:
    """``hard_negatives`` with the label of every row whose vec_id is divisible by 7 moved on by one, modulo 10."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(embeddings.select("vec_id", "embedding", moved.alias("label")))


ORACLE = """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
               CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
        FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
    ), p AS (
        SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
    )
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
           id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    QUALIFY rank <= 5
"""
