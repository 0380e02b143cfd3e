"""Two searches for largest inner products, over vectors dealt out by cells of an index.

Inner products become distances by one more coordinate: with M the largest norm,
|q - x|^2 = |q|^2 + M^2 - 2 q.x if x is extended by sqrt(M^2 - |x|^2) and q by 0.

``stable_projection_search`` (approximate): vectors are projected by a few random
normal directions and indexed by kd-trees there; pages come up by projected
distance and are verified until a chi-square test says that what is left is
further away with the wanted probability. ``mtree_search`` (exact): M-trees of
paged metric nodes with covering radii and distances to the parent, searched best
first, by many queries together; bounds from the triangle inequality spare distances.

Both run in two rounds. The cells of a top level (fitted to a bounded sample;
every vector is indexed) are dealt out in blocks. A query first searches its
own cell, which bounds its k-th distance; then it visits the cells that this
bound does not rule out. A task streams queries past one block of vectors.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import sample_by_id, settled

#: Rows of the sample that the top level is fitted to; cells it has at most; rows of a cell and of a block; queries at a time.
SAMPLE, MOST_CELLS, BLOCK, BATCH = 8192, 2048, 4096, 1024
#: Where a component is beyond two to this power all are divided by one power of two, so that squared norms stay finite.
EXPONENT = 480


class Best:
    """The k best (score, id) of each query of a batch; ties to smaller ids."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = np.full((queries, k), -np.inf)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)

    def update(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        candidates = (scores >= self.scores[rows, -1, None]).sum(1)
        better = candidates > 0
        rows, scores = rows[better], scores[better]
        if not len(rows):
            return
        most = int(candidates.max())
        if most < scores.shape[1]:  # no row has more that can be among its best, so the others aren't sorted
            top = np.argpartition(scores, scores.shape[1] - most, 1)[:, -most:]
            scores, ids = np.take_along_axis(scores, top, 1), ids[top]
        scores = np.concatenate([self.scores[rows], scores], 1)
        ids = np.concatenate([self.ids[rows], np.broadcast_to(ids, (len(rows), ids.shape[-1]))], 1)
        order = np.lexsort((ids, -scores), axis=-1)[:, : self.k]
        self.scores[rows] = np.take_along_axis(scores, order, 1)
        self.ids[rows] = np.take_along_axis(ids, order, 1)


def groups_of(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of each value."""
    order = np.argsort(values, kind="stable")
    ends = np.flatnonzero(np.diff(values[order])) + 1
    for part in np.split(order, ends):
        yield int(values[part[0]]), part


class Space:
    """The extension of vectors to distances, for one largest norm."""

    def __init__(self, squared_norm: float):
        self.most = squared_norm

    def points(self, x: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.most - np.einsum("ij,ij->i", x, x), 0)
        return np.concatenate([x, np.sqrt(rest)[:, None]], 1)

    def queries(self, q: np.ndarray) -> np.ndarray:
        return np.concatenate([q, np.zeros((len(q), 1))], 1)

    def radius(self, q: np.ndarray, score: np.ndarray) -> np.ndarray:
        """The distance that a score means."""
        return np.sqrt(np.maximum(np.einsum("ij,ij->i", q, q) + self.most - 2 * score, 0))


class KdTree:
    """Median splits of the widest coordinate down to ``leaf`` points; boxes of the leaves, tight or up to the splits."""

    def __init__(self, points: np.ndarray, leaf: int, tight: bool):
        self.splits: list[tuple[int, float, int, int]] = []  # coordinate, value, below, above; leaves are ~number
        self.leaves: list[np.ndarray] = []
        boxes: list[tuple[np.ndarray, np.ndarray]] = []

        def grow(at: np.ndarray, low: np.ndarray, high: np.ndarray) -> int:
            own = points[at]
            spread = own.max(0) - own.min(0)
            c = int(spread.argmax())
            value = float(np.median(own[:, c])) if len(at) > leaf else 0.0
            right = own[:, c] > value
            if len(at) <= leaf or not right.any() or right.all():
                self.leaves.append(at)
                boxes.append((own.min(0), own.max(0)) if tight else (low, high))
                return ~(len(self.leaves) - 1)
            k = len(self.splits)
            self.splits.append((c, value, 0, 0))
            lower, upper = high.copy(), low.copy()
            lower[c] = upper[c] = value
            self.splits[k] = (c, value, grow(at[~right], low, lower), grow(at[right], upper, high))
            return k

        d = points.shape[1]
        self.root = grow(np.arange(len(points)), np.full(d, -np.inf), np.full(d, np.inf))
        self.low, self.high = (np.array([b[i] for b in boxes]) for i in (0, 1))

    def cell(self, points: np.ndarray) -> np.ndarray:
        out = np.empty(len(points), np.int64)
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, at = todo.pop()
            if node < 0:
                out[at] = ~node
                continue
            c, value, below, above = self.splits[node]
            right = points[at, c] > value
            todo += [(below, at[~right]), (above, at[right])]
        return out

    def distances(self, q: np.ndarray) -> np.ndarray:
        """From each query to each leaf's box."""
        total = np.zeros((len(q), len(self.leaves)))
        for c in range(q.shape[1]):
            x = q[:, c, None]
            total += np.maximum(np.maximum(self.low[None, :, c] - x, x - self.high[None, :, c]), 0) ** 2
        return np.sqrt(total)


def chi_square_quantile(p: float, m: int) -> float:
    """For an even number m of degrees of freedom, by bisection of the closed form."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        x = (low + high) / 2
        cdf = 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))
        low, high = (x, high) if cdf < p else (low, x)
    return (low + high) / 2


class StableProjections:
    """Projections, the test, and the index of one block."""

    def __init__(self, space: Space, size: int, projections: int = 8, confidence: float = 0.97, page: int = 128, seed: int = 7):
        self.space, self.page = space, page
        self.directions = np.random.default_rng(seed).standard_normal((size + 1, projections))
        #: Of a neighbour at distance r, the projection is within this times r with the wanted confidence.
        self.factor = math.sqrt(chi_square_quantile(confidence, projections))

    def fit_top(self, sample: np.ndarray, cells: int) -> None:
        self.top = KdTree(self.space.points(sample) @ self.directions, max(1, math.ceil(len(sample) / cells)), False)
        self.cells = len(self.top.leaves)

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.top.cell(self.space.points(x) @ self.directions), np.zeros(len(x))

    def near(self, q: np.ndarray, score: np.ndarray, radii: np.ndarray) -> np.ndarray:
        """Which cells each query with this k-th score has yet to visit."""
        reach = self.factor * self.space.radius(q, score)
        return self.top.distances(self.space.queries(q) @ self.directions) <= reach[:, None]

    def index(self, x: np.ndarray, ids: np.ndarray) -> Callable:
        tree = KdTree(self.space.points(x) @ self.directions, self.page, True)

        def search(q: np.ndarray, own: np.ndarray, bound: np.ndarray, k: int) -> Best:
            best = Best(len(q), k)
            away = tree.distances(self.space.queries(q) @ self.directions)
            order = np.argsort(away, 1)
            active = np.arange(len(q))
            for step in range(len(tree.leaves)):
                page = order[active, step]
                score = np.maximum(best.scores[active, -1], bound[active])
                go = away[active, page] <= self.factor * self.space.radius(q[active], score)
                active, page = active[go], page[go]
                if not len(active):
                    break
                for leaf, part in groups_of(page):
                    verify(best, active[part], q, own, x, ids, tree.leaves[leaf])
            return best

        return search


def verify(best: Best, rows: np.ndarray, q: np.ndarray, own: np.ndarray, x: np.ndarray, ids: np.ndarray, at: np.ndarray) -> None:
    scores = q[rows] @ x[at].T
    scores[own[rows][:, None] == ids[at][None]] = -np.inf
    best.update(rows, scores, ids[at])


class MTree:
    """Metric nodes: a pivot, a covering radius, the distance to the parent's pivot, and children or a page of points."""

    SLACK = 1e-6

    def __init__(self, space: Space, page: int = 256, fanout: int = 8):
        self.space, self.page, self.fanout = space, page, fanout

    @staticmethod
    def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        squared = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None] - 2 * a @ b.T
        return np.sqrt(np.maximum(squared, 0))

    def _pivots(self, points: np.ndarray, n: int) -> np.ndarray:
        """Points far from each other, one after the other."""
        chosen = [0]
        away = self.apart(points, points[:1])[:, 0]
        while len(chosen) < n and away.max() > 0:
            chosen.append(int(away.argmax()))
            away = np.minimum(away, self.apart(points, points[chosen[-1] : chosen[-1] + 1])[:, 0])
        return points[chosen]

    def fit_top(self, sample: np.ndarray, cells: int) -> None:
        self.top = self._pivots(self.space.points(sample), cells)
        self.cells = len(self.top)

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest pivot's cell, and the distance to that pivot."""
        away = self.apart(self.space.points(x), self.top)
        cell = away.argmin(1)
        return cell, away[np.arange(len(x)), cell]

    def near(self, q: np.ndarray, score: np.ndarray, radii: np.ndarray) -> np.ndarray:
        away = self.apart(self.space.queries(q), self.top)
        return away - radii[None] <= self.space.radius(q, score)[:, None] + self._slack()

    def _slack(self) -> float:
        return self.SLACK * (1 + math.sqrt(self.space.most))

    def index(self, x: np.ndarray, ids: np.ndarray) -> Callable:
        points = self.space.points(x)
        pivots: list[np.ndarray] = []
        radius: list[float] = []
        to_parent: list[float] = []
        children: list[np.ndarray] = []
        pages: list[tuple[np.ndarray, np.ndarray] | None] = []

        def grow(at: np.ndarray, pivot: np.ndarray, parent: np.ndarray) -> int:
            k = len(pivots)
            away = self.apart(points[at], pivot[None])[:, 0]
            pivots.append(pivot)
            radius.append(float(away.max()))
            to_parent.append(float(self.apart(pivot[None], parent[None])[0, 0]))
            children.append(np.empty(0, np.int64))
            pages.append(None)
            parts = []
            if len(at) > self.page and away.max() > 0:
                chosen = self._pivots(points[at], self.fanout)
                nearest = self.apart(points[at], chosen).argmin(1)
                parts = [(at[nearest == c], chosen[c]) for c in range(len(chosen)) if (nearest == c).any()]
            if len(parts) > 1:
                children[k] = np.array([grow(own, p, pivot) for own, p in parts])
            else:
                pages[k] = (at, away)
            return k

        start = points[:1].mean(0)
        grow(np.arange(len(x)), start, start)
        pivot, cover, above = np.array(pivots), np.array(radius), np.array(to_parent)
        inner = np.array([page is None for page in pages])
        slack = self._slack()

        def search(q: np.ndarray, own: np.ndarray, bound: np.ndarray, k: int) -> Best:
            best = Best(len(q), k)
            target = self.space.queries(q)
            lower = np.full((len(q), len(pivot)), np.inf)
            to_pivot = np.zeros((len(q), len(pivot)))
            to_pivot[:, 0] = self.apart(target, pivot[:1])[:, 0]
            lower[:, 0] = np.maximum(to_pivot[:, 0] - cover[0], 0)

            def reach(rows: np.ndarray) -> np.ndarray:
                return self.space.radius(q[rows], np.maximum(best.scores[rows, -1], bound[rows])) + slack

            def visit(n: int, rows: np.ndarray) -> None:
                lower[rows, n] = np.inf
                within = reach(rows)[:, None]
                if pages[n] is None:
                    below = children[n]
                    known = np.abs(to_pivot[rows, n][:, None] - above[below][None]) - cover[below][None]
                    useful = known <= within
                    needed, some = np.flatnonzero(useful.any(0)), np.flatnonzero(useful.any(1))
                    if len(needed):
                        away = self.apart(target[rows[some]], pivot[below[needed]])
                        to_pivot[np.ix_(rows[some], below[needed])] = away
                        bounds = np.maximum(away - cover[below[needed]][None], 0)
                        lower[np.ix_(rows[some], below[needed])] = np.where(useful[np.ix_(some, needed)], bounds, np.inf)
                else:
                    at, away = pages[n]
                    useful = np.abs(to_pivot[rows, n][:, None] - away[None]) <= within
                    needed, some = np.flatnonzero(useful.any(0)), np.flatnonzero(useful.any(1))
                    if len(needed):
                        verify(best, rows[some], q, own, x, ids, at[needed])

            # A query without a bound goes to the nodes nearest to itself until it has one.
            active = np.flatnonzero(np.isneginf(bound))
            while len(active):
                node = lower[active].argmin(1)
                go = np.isfinite(lower[active, node])
                active, node = active[go], node[go]
                for n, part in groups_of(node) if len(active) else ():
                    visit(n, active[part])
                active = active[np.isneginf(best.scores[active, -1])]
            # Then a node is visited by all queries that it may have results for: inner nodes first, the nearest to any query first.
            everyone = np.arange(len(q))
            while np.isfinite(near := lower.min(0)).any():
                upper = np.where(inner, near, np.inf)
                n = int(upper.argmin() if np.isfinite(upper).any() else near.argmin())
                rows = np.flatnonzero(np.isfinite(lower[:, n]) & (lower[:, n] <= reach(everyone)))
                lower[:, n] = np.inf
                if len(rows):
                    visit(n, rows)
            return best

        return search


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def usable(embeddings: DataFrame, vector_id: str, vector: str, zero: bool) -> DataFrame:
    """Rows (vec_id, v array<double>) that take part: an id, and a vector with finite components only.

    Where lengths differ, shorter vectors end in zeros, so inner products are those of the components both have.
    """
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(F.col(vector_id).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite)
    if not zero:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    least, most = rows.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if least is None or least == max(1, most):
        return rows
    return rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(max(1, most)) - F.size("v"))))


def _located(rows: DataFrame, method) -> DataFrame:
    """Adds each vector's cell and its distance to the cell's pivot."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell, away = method.home(_matrix(batch.column("v")))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(cell.astype(np.int32)), pa.array(away)], ["vec_id", "v", "cell", "away"])

    return rows.mapInArrow(locate, "vec_id long, v array<double>, cell int, away double")


def _search_blocks(data: DataFrame, queries: DataFrame, method, k: int) -> DataFrame:
    """Streams queries (cell, block, vec_id, v, bound) past the vectors of their block; at most k results of each."""
    rows = data.select("cell", "block", F.lit(0).alias("kind"), "vec_id", "v", F.lit(0.0).alias("bound"))
    rows = rows.unionByName(queries.select("cell", "block", F.lit(1).alias("kind"), "vec_id", "v", "bound"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, vectors, ids, index = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, block, kind, vec_id, bound = (np.asarray(batch.column(c)) for c in ("cell", "block", "kind", "vec_id", "bound"))
            v = _matrix(batch.column("v"))
            code = (cell.astype(np.int64) << 33) | (block.astype(np.int64) << 1) | kind
            ends = np.concatenate((np.flatnonzero(np.diff(code)) + 1, [len(code)]))
            start = 0
            for end in ends.tolist():
                key = (int(cell[start]), int(block[start]))
                if key != current:
                    current, vectors, ids, index = key, [], [], None
                if kind[start] == 0:
                    vectors.append(v[start:end])
                    ids.append(vec_id[start:end])
                elif vectors:
                    if index is None:
                        index = method.index(np.concatenate(vectors), np.concatenate(ids))
                    for at in range(start, end, BATCH):
                        part = slice(at, min(end, at + BATCH))
                        best = index(v[part], vec_id[part], bound[part], k)
                        keep = np.isfinite(best.scores) & (best.scores >= bound[part][:, None])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.broadcast_to(vec_id[part][:, None], keep.shape)[keep]), pa.array(best.ids[keep]), pa.array(best.scores[keep])], ["query_id", "vec_id", "score"]
                        )
                start = end

    dealt = rows.repartition("cell", "block").sortWithinPartitions("cell", "block", "kind", "vec_id")
    return dealt.mapInArrow(search, "query_id long, vec_id long, score double")


def _search(rows: DataFrame, is_query: Column, k: int, make: Callable[[Space, int], object]) -> DataFrame:
    rows = settled(rows)
    nothing = rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    largest = rows.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0]
    if largest is None:
        return nothing
    lowered = max(0, math.frexp(largest)[1] - EXPONENT)
    if lowered:
        rows = settled(rows.withColumn("v", F.transform("v", lambda x: x / 2.0**lowered)))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    facts = rows.agg(F.max(square).alias("most"), F.count("*").alias("n"), F.max(F.size("v")).alias("size")).first()
    method = make(Space(facts["most"]), facts["size"])
    sample = sample_by_id(rows, "vec_id", SAMPLE).orderBy("vec_id", "v").select("v").toArrow()
    method.fit_top(_matrix(sample.column("v")), min(MOST_CELLS, max(1, math.ceil(facts["n"] / BLOCK))))
    cells = settled(_located(rows, method))
    known = cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect()
    radii, blocks = np.full(method.cells, -np.inf), np.zeros(method.cells, np.int64)
    for c in known:
        radii[c["cell"]], blocks[c["cell"]] = c["radius"], math.ceil(c["n"] / (2 * BLOCK))
    per_cell = F.element_at(F.array(*(F.lit(int(b)) for b in np.maximum(blocks, 1))), F.col("cell") + 1)
    data = cells.withColumn("block", F.pmod(F.xxhash64("vec_id"), per_cell).cast("int"))
    asked = data.where(is_query).groupBy("vec_id").agg(F.min(F.struct("v", "cell", "block")).alias("least")).select("vec_id", "least.*")
    first = settled(_search_blocks(data, asked.withColumn("bound", F.lit(float("-inf"))), method, k))
    reached = first.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    bound = F.when(F.col("n") == k, F.col("least")).otherwise(F.lit(float("-inf")))
    again = asked.join(reached.select(F.col("query_id").alias("vec_id"), bound.alias("bound")), "vec_id", "left").fillna(float("-inf"), ["bound"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                near = method.near(_matrix(part.column("v")), np.asarray(part.column("bound")), radii)
                row, cell = np.nonzero(near)
                counts = blocks[cell]
                row, cell = np.repeat(row, counts), np.repeat(cell, counts)
                block = np.arange(len(cell)) - np.repeat(np.cumsum(counts) - counts, counts)
                new = (cell != np.asarray(part.column("cell"))[row]) | (block != np.asarray(part.column("block"))[row])
                taken = part.select(["vec_id", "v", "bound"]).take(pa.array(row[new]))
                yield pa.RecordBatch.from_arrays([pa.array(cell[new].astype(np.int32)), pa.array(block[new].astype(np.int32)), *taken.columns], ["cell", "block", "vec_id", "v", "bound"])

    visits = again.select("vec_id", "v", "cell", "block", "bound").mapInArrow(visit, "cell int, block int, vec_id long, v array<double>, bound double")
    found = first.unionByName(_search_blocks(data, visits, method, k))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    score = F.col("score") * 2.0**lowered * 2.0**lowered if lowered else F.col("score")
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", score.alias("score"))


def stable_projection_search(embeddings: DataFrame, is_query: Column, k: int = 20, vector_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each query about the k largest inner products with other rows, ties to smaller ids.

    ``is_query`` is a condition on the column vec_id. A neighbour is missed
    with a probability of 0.03 at most. Null and zero vectors, and those with
    null or non-finite components, take no part, nor do rows without an id; of
    vectors of several lengths the shorter ones end in zeros. Rows of one id are
    one query, the smallest of their vectors, and never its neighbours. Vectors
    with components beyond 2**480 are ranked on a common smaller scale; a
    score that no double holds is infinite.
    An empty table gives an empty result; other columns are ignored.
    """
    return _search(usable(embeddings, vector_id, vector, zero=False), is_query, k, lambda space, size: StableProjections(space, size))


def mtree_search(embeddings: DataFrame, is_query: Column, k: int = 20, scale: int = 64, vector_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Like ``stable_projection_search``, but exact, on components floor(scale * x); scores are whole numbers. Zero and empty vectors take part.

    Scores are exact up to 2**53; those that no long holds are the largest or smallest long.
    """
    most = sys.float_info.max

    def whole(x: Column) -> Column:
        scaled = F.greatest(F.least(x * scale, F.lit(most)), F.lit(-most))
        return F.when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).otherwise(scaled)

    rows = usable(embeddings, vector_id, vector, zero=True).withColumn("v", F.transform("v", whole))
    found = _search(rows, is_query, k, lambda space, size: MTree(space))
    score = F.when(F.col("score") >= 2.0**63, F.lit((1 << 63) - 1)).when(F.col("score") <= -(2.0**63), F.lit(-(1 << 63))).otherwise(F.col("score").cast("long"))
    return found.withColumn("score", score)
