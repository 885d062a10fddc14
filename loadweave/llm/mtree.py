"""Exact top-k search by inner product with M-trees.

Vectors are dealt by a hash into blocks of bounded size, and each block becomes an M-tree: pages of entries around a pivot,
with the page's covering radius and every entry's distance to the pivot, and above them as many levels of nodes over nodes as
the block needs, up to one root, each with the same and its distance to its parent's pivot. Trees are written to the shared
folder. Queries go through the trees in blocks: each (query block, tree) is one task, and the best of each query over all trees
are its result.

With integer vectors, <q, x> = (|q|^2 + |x|^2 - d(q, x)^2) / 2. A node of pivot p, radius r and longest vector n thus holds
no score above (|q|^2 + n^2 - max(0, d(q, p) - r)^2) / 2, nor above <q, p> + |q| r. Since d(q, p) >= |d(q, o) - d(o, p)| for the
parent's pivot o, both bounds can be had from stored distances before d(q, p) is computed; likewise for entries in a page. Every
query has one queue of nodes, which starts with the root, and takes what has the best bound, a few at a time and many queries at
once, until the best bound left is below its k-th score. Distances and products that stored distances rule out are not computed
(products of a page are computed for all its queries at once unless fewer than one in 16 is needed); counts tell how many.

Equal vectors are one entry with their ids in order. Of a query's own ids none counts, and of the others only the first k can
matter, so as many ids are looked at as k and the most frequent id of the entry make.

Cases: null vectors, and vectors with null or non-finite components, take no part, nor do rows without vec_id; vectors of
other lengths are searched among themselves; rows that share the query's vec_id are the query's own and no candidates;
repeated candidate rows count each, repeated query rows once (the least vector, if they differ); an empty table gives no
rows; extra columns are ignored. Sums of doubles are exact while a vector's squared length, after scaling, is below 2^52. Longer
vectors are kept in blocks of their own; what they are compared with is scored in integers of any size, without a tree. Vectors
with a component of 2^57 or more after scaling take no part; a score that fits no long is null in the query.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import batch_rows, settled, table

SCALE, K, EVERY = 64, 20, 20
#: Vectors of a tree, entries of a page, children of an inner node, queries of a block.
TREE, PAGE, FAN, QUERIES_AT_ONCE = 4096, 64, 4, 512
#: Times that the centres of a split move.
MOVES = 4
#: Below this squared length every sum of products is an exact double; pairs with a longer vector are scored in integers.
TOO_LONG = 2.0**52
#: Components are smaller than this after scaling, so that the scores of 4,096 of them have 38 digits at most.
TOO_LARGE = 2.0**57


class Tree:
    """One block's M-tree, as flat arrays. Nodes are numbered level by level from the root, so children are neighbours, and all
    pages (the leaves) are on the last level; entries are in the order of their pages, so every node holds a stretch of them."""

    PARTS = ("vectors", "norm2", "id_at", "ids", "id_most", "entry_far", "start", "stop", "child_at", "pivot", "pivot2", "radius", "longest", "node_far")
    _DOUBLES = ("vectors", "pivot")

    def save(self) -> bytes:
        out = io.BytesIO()
        small = {k: v.astype(np.int32) if k in self._DOUBLES and np.abs(v).max() < 2**31 else v for k in self.PARTS for v in [getattr(self, k)]}
        np.savez(out, **small)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Tree:
        tree = cls()
        with np.load(io.BytesIO(data)) as parts:
            for k in cls.PARTS:
                setattr(tree, k, parts[k].astype(np.float64) if k in cls._DOUBLES else parts[k])
        return tree

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray) -> Tree:
        vectors, inverse = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort((ids, inverse.reshape(-1)))
        id_at = np.searchsorted(inverse.reshape(-1)[order], np.arange(len(vectors) + 1))
        x = vectors.astype(np.float64)
        # As many levels as the number of vectors asks for; each has FAN times the entries a node of the one below.
        limits = [PAGE]
        while limits[-1] < len(x):
            limits.append(limits[-1] * FAN)
        levels, children = [[np.arange(len(x))]], []
        for limit in limits[-2::-1]:
            parted = [cls._parted(x, own, limit) for own in levels[-1]]
            children += map(len, parted)
            levels.append([part for parts in parted for part in parts])
        at = np.concatenate(levels[-1])
        tree = cls()
        tree.vectors, tree.ids = x[at], np.concatenate([ids[order][id_at[k] : id_at[k + 1]] for k in at.tolist()])
        tree.id_at = np.concatenate([[0], np.cumsum(np.diff(id_at)[at])])
        runs = np.flatnonzero(np.concatenate([[True], (np.diff(tree.ids) != 0) | np.isin(np.arange(1, len(tree.ids)), tree.id_at)]))
        lengths = np.diff(np.append(runs, len(tree.ids)))
        tree.id_most = np.maximum.reduceat(lengths, np.searchsorted(runs, tree.id_at[:-1]))
        tree.norm2 = (tree.vectors**2).sum(1)
        ends = [np.cumsum([len(own) for own in level]) for level in levels]
        tree.stop = np.concatenate(ends)
        tree.start = np.concatenate([np.append(0, e[:-1]) for e in ends])
        tree.child_at = 1 + np.cumsum([0, *children])
        tree._cover()
        return tree

    @staticmethod
    def _parted(x: np.ndarray, own: np.ndarray, limit: int) -> list[np.ndarray]:
        """Rows `own` of x in two and two again, by the nearer of two centres, until no part has more than `limit`.

        The centres start at two far members and move to their rows' means. A cut that would leave less than an eighth on one
        side is put there instead, in the order along the line between the centres, so parts are few and the splitting ends."""
        done, waiting = [], [own]
        while waiting:
            own = waiting.pop()
            if len(own) <= limit:
                done.append(own)
                continue
            mine = x[own]
            a = mine[((mine - mine[0]) ** 2).sum(1).argmax()]
            b = mine[((mine - a) ** 2).sum(1).argmax()]
            for _ in range(MOVES):
                near_b = mine @ (b - a) > ((b**2).sum() - (a**2).sum()) / 2
                if near_b.all() or not near_b.any():
                    break
                a, b = mine[~near_b].mean(0), mine[near_b].mean(0)
            along = mine @ (b - a)
            side = np.argsort(along, kind="stable")
            cut = int(np.searchsorted(along[side], ((b**2).sum() - (a**2).sum()) / 2, side="right"))
            cut = min(max(cut, -(-len(own) // 8)), len(own) - -(-len(own) // 8))
            waiting += [own[side[cut:]], own[side[:cut]]]
        return done

    def _cover(self) -> None:
        """Of each node: the member nearest to the mean as pivot, covering radius, largest squared length, distance to the parent's
        pivot. Of each entry: the distance to its page's pivot."""
        pivots, radii, longest, self.entry_far = [], [], [], np.zeros(len(self.vectors))
        for a, b in zip(self.start.tolist(), self.stop.tolist(), strict=True):
            own = self.vectors[a:b]
            pivot = own[((own - own.mean(0)) ** 2).sum(1).argmin()]
            self.entry_far[a:b] = np.sqrt(((own - pivot) ** 2).sum(1))  # pages come last
            pivots.append(pivot)
            radii.append(self.entry_far[a:b].max())
            longest.append(self.norm2[a:b].max())
        self.pivot, self.radius, self.longest = np.array(pivots), np.array(radii), np.array(longest)
        self.pivot2 = (self.pivot**2).sum(1)
        parent = np.append(0, np.repeat(np.arange(len(self.child_at) - 1), np.diff(self.child_at)))
        self.node_far = np.sqrt(((self.pivot - self.pivot[parent]) ** 2).sum(1))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query_id, vec_id, score) of each query's k best entries, its own id left out; ties to smaller ids.

        computed, avoided: distances to pivots that were worked out, and those that stored distances ruled out for a node whose
        parent was opened. scored: products with entries; all others of the queries' products with all entries were avoided."""
        q = queries.astype(np.float64)
        n, q2 = len(q), (q**2).sum(1)
        length = np.sqrt(q2)
        best = np.full((n, k), -np.inf)
        best_id = np.full((n, k), np.iinfo(np.int64).max)
        slack = 1e-7 * (q2 + self.norm2.max()) + 1e-6
        self.computed, self.avoided, self.scored = 0, 0, 0

        def inside(far: np.ndarray, rows: np.ndarray, pivot2: np.ndarray, radius: np.ndarray) -> np.ndarray:
            """No vector within radius of a pivot has a higher score: the pivot's own, and the radius along the query."""
            return (q2[rows, None] + pivot2 - far**2) / 2 + length[rows, None] * radius + slack[rows, None]

        def above(far: np.ndarray, rows: np.ndarray, radius: np.ndarray, longest: np.ndarray) -> np.ndarray:
            """No vector within radius of a pivot, and no longer than `longest`, has a higher score."""
            return (q2[rows, None] + longest - np.maximum(0, far - radius) ** 2) / 2 + slack[rows, None]

        def bound(far: np.ndarray, rows: np.ndarray, nodes: slice) -> np.ndarray:
            """Both; far: the queries' distances to the nodes' pivots, or anything below them."""
            return np.minimum(above(far, rows, self.radius[nodes], self.longest[nodes]), inside(far, rows, self.pivot2[nodes], self.radius[nodes]))

        def distance(rows: np.ndarray, nodes: slice) -> np.ndarray:
            self.computed += len(rows) * (nodes.stop - nodes.start)
            return np.sqrt(np.maximum(0, q2[rows, None] + self.pivot2[nodes] - 2 * (q[rows] @ self.pivot[nodes].T)))

        def products(rows: np.ndarray, own: np.ndarray, may: np.ndarray) -> np.ndarray:
            """Scores of rows and entries; -inf where there are few that may count and this is none of them."""
            if 16 * np.count_nonzero(may) >= may.size:
                self.scored += may.size
                return q[rows] @ self.vectors[own].T
            r, c = np.nonzero(may)
            self.scored += len(r)
            out = np.full(may.shape, -np.inf)
            out[r, c] = np.einsum("ij,ij->i", q[rows[r]], self.vectors[own[c]])
            return out

        def visit(page: int, rows: np.ndarray, far: np.ndarray) -> None:
            a, b = self.start[page], self.stop[page]
            # What the stored distances to the pivot rule out is not computed.
            entry_far = self.entry_far[a:b]
            may = np.minimum(above(np.abs(far[:, None] - entry_far), rows, np.zeros(1), self.norm2[a:b]), inside(far[:, None], rows, self.pivot2[page], entry_far)) >= best[rows, -1:]
            own, some = np.flatnonzero(may.any(0)), may.any(1)
            if not len(own):
                return
            rows, may = rows[some], may[some][:, own]
            scores = products(rows, a + own, may)
            first = self.id_at[a + own]
            width = np.minimum(self.id_at[a + own + 1] - first, k + self.id_most[a + own])
            column = np.repeat(np.arange(len(own)), width)
            ids = self.ids[np.repeat(first, width) + np.arange(len(column)) - np.repeat(np.cumsum(width) - width, width)]
            scores = np.where(ids == query_ids[rows, None], -np.inf, scores[:, column])
            better = scores.max(1) >= best[rows, -1]
            if not better.any():
                return
            rows, scores = rows[better], scores[better]
            all_scores = np.concatenate([best[rows], scores], 1)
            all_ids = np.concatenate([best_id[rows], np.where(scores == -np.inf, np.iinfo(np.int64).max, ids)], 1)
            top = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
            best[rows], best_id[rows] = np.take_along_axis(all_scores, top, 1), np.take_along_axis(all_ids, top, 1)

        # The queue: no score is above this, for each query and node that waits; and distances to the pivots.
        nodes, inner = len(self.radius), len(self.child_at) - 1
        everyone, root = np.arange(n), slice(0, 1)
        far = np.full((n, nodes), np.nan)
        queue = np.full((n, nodes), -np.inf)
        far[:, root] = distance(everyone, root)
        queue[:, root] = bound(far[:, root], everyone, root)

        def open_node(node: int, rows: np.ndarray) -> None:
            """Puts the node's children into the queues of rows, but for those that the stored distance rules out."""
            a, b = int(self.child_at[node]), int(self.child_at[node + 1])
            stored = np.abs(far[rows, node][:, None] - self.node_far[a:b])
            may = bound(stored, rows, slice(a, b)) >= best[rows, -1:]
            self.avoided += int((~may).sum())
            for c in np.flatnonzero(may.any(0)).tolist():
                some, child = rows[may[:, c]], slice(a + c, a + c + 1)
                d = distance(some, child)
                far[some, a + c] = d[:, 0]
                queue[some, a + c] = bound(d, some, child)[:, 0]

        def take(rows: np.ndarray, items: np.ndarray) -> None:
            queue[rows, items] = -np.inf
            order = np.argsort(items, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(items[order])) + 1):
                if len(part) and (item := int(items[part[0]])) < inner:
                    open_node(item, rows[part])
                elif len(part):
                    visit(item, rows[part], far[rows[part], item])

        # First the best path down to a page, which gives each query a score to beat; then more and more nodes at once.
        active, step, turn = everyone, 1, 0
        while len(active):
            some = np.argsort(-queue[active], axis=1, kind="stable")[:, :step]
            most = np.take_along_axis(queue[active], some, 1)
            want = (most >= best[active, -1:]) & (most > -np.inf)
            r, c = np.nonzero(want)
            take(active[r], some[r, c])
            active, turn = active[want[:, 0]], turn + 1
            step = step if FAN**turn <= nodes else min(2 * step, 64)
        rows, columns = np.nonzero(best > -np.inf)
        return query_ids[rows], best_id[rows, columns], best[rows, columns].astype(np.int64)


def scaled(vector: Column) -> Column:
    """floor(SCALE * x) of each component as a double; null if the vector takes no part: it or a component is null, or a component
    is not finite or reaches TOO_LARGE after scaling."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) * SCALE >= TOO_LARGE))
    return F.when(x.isNotNull() & (F.size(x) > 0) & ~bad, F.transform(x, lambda v: F.floor(v * SCALE).cast("double")))


def exact_best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[list[int], list[int], list[int]]:
    """(query_id, vec_id, score) of each query's k best rows, its own id left out, by integers of any size."""
    whole = lambda x: np.array([int(v) for v in x.ravel().tolist()], object).reshape(x.shape)
    out: tuple[list[int], list[int], list[int]] = ([], [], [])
    for q, row in zip(query_ids.tolist(), whole(queries) @ whole(vectors).T, strict=True):
        best = heapq.nsmallest(k, ((-s, v) for s, v in zip(row.tolist(), ids.tolist(), strict=True) if v != q))
        for s, v in best:
            for to, value in zip(out, (q, v, -s), strict=True):
                to.append(value)
    return out


def _packed(rows: DataFrame, name: str, size: int) -> DataFrame:
    """Rows (vec_id, z, long) in blocks of about `size`: dim, name (the block's number), long, ids, values (rows end to end).

    Blocks hold long vectors only or none; those of long ones have numbers of their own."""
    n = rows.groupBy("dim", "long").count().select("dim", "long", F.ceil(F.col("count") / size).cast("int").alias("parts"))
    number = 2 * F.pmod(F.xxhash64("vec_id", "z", F.lit(name)), F.col("parts")).cast("int") + F.col("long").cast("int")
    dealt = rows.join(F.broadcast(n), ["dim", "long"]).withColumn(name, number)
    packed = dealt.groupBy("dim", name, "long").agg(F.collect_list(F.struct("vec_id", "z")).alias("rows"))
    return packed.select("dim", name, "long", F.col("rows.vec_id").alias("ids"), F.flatten("rows.z").alias("values"))


def top_k(rows: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score decimal(38,0)) of the k highest inner products of each query with all rows. rows: vec_id, embedding."""
    spark = rows.sparkSession
    asks = is_query.alias("asks")
    good = rows.select(F.col("vec_id").cast("long").alias("vec_id"), asks, scaled(F.col("embedding")).alias("z")).where(F.col("vec_id").isNotNull() & F.col("z").isNotNull())
    # Of rows with one id and one vector no more than k can be among anyone's k best, so k of them are all that a tree needs.
    each = good.groupBy("vec_id", "z").agg(F.count(F.lit(1)).alias("copies"), F.coalesce(F.bool_or("asks"), F.lit(False)).alias("asks"))
    is_long = F.aggregate("z", F.lit(0.0), lambda a, v: a + v * v) >= TOO_LONG
    each = settled(each.withColumns({"dim": F.size("z"), "long": is_long}))
    candidates = each.select("vec_id", "z", "dim", "long", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))).alias("copy")).drop("copy")
    width = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))
    of_rows = lambda batch, row, ids: (batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in (ids, ids + 1))
    save = lambda ids, vectors: b"".join([np.int64(len(ids)).tobytes(), np.asarray(ids, np.int64).tobytes(), np.asarray(vectors, np.float64).tobytes()])

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, values = of_rows(batch, row, 3)
                plain = batch.column(2)[row].as_py()
                # Long vectors are kept as they are: their distances are beyond exact doubles.
                tree = save(ids, values) if plain else Tree.build(ids, values.reshape(len(ids), -1).astype(np.int64)).save()
                yield pa.RecordBatch.from_arrays([*(batch.column(c)[row : row + 1] for c in (0, 1, 2)), pa.array([tree], pa.binary())], ["dim", "tree_no", "long", "tree"])

    with batch_rows(spark, 1):
        trees = settled(_packed(candidates, "tree_no", TREE).mapInArrow(plant, "dim int, tree_no int, long boolean, tree binary"))
    own = each.where("asks").groupBy("vec_id").agg(F.min(F.struct("z", "long")).alias("x")).select("vec_id", "x.z", "x.long", F.size("x.z").alias("dim"))
    queries = settled(_packed(own, "query_no", QUERIES_AT_ONCE))
    # Each tree goes to one task, once, and query blocks come to it one after another.
    numbers = trees.select("dim", "tree_no")
    asked = queries.join(F.broadcast(numbers.groupBy("dim").agg(F.collect_list("tree_no").alias("all"))), "dim")
    asked = asked.select("dim", F.explode("all").alias("tree_no"), "query_no", "ids", "values", "long", F.lit(None).cast("binary").alias("tree"))
    first = trees.select("dim", "tree_no", F.lit(-1).alias("query_no"), F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("array<double>").alias("values"), "long", "tree")
    lined = first.unionByName(asked).repartition(width, "dim", "tree_no").sortWithinPartitions("dim", "tree_no", "query_no")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree: Tree | None = None
        block: tuple[np.ndarray, np.ndarray] | None = None
        for batch in batches:
            for row in range(batch.num_rows):
                if batch.column(2)[row].as_py() < 0:
                    data = batch.column(6)[row].as_py()
                    tree = block = None
                    if batch.column(5)[row].as_py():
                        n = int(np.frombuffer(data, np.int64, 1)[0])
                        block = np.frombuffer(data, np.int64, n, 8), np.frombuffer(data, np.float64, offset=8 + 8 * n).reshape(n, -1)
                    else:
                        tree = Tree.load(data)
                    continue
                ids, values = of_rows(batch, row, 3)
                vectors = values.reshape(len(ids), -1)
                if tree is not None and not batch.column(5)[row].as_py():
                    q, v, s = tree.search(ids, vectors, k)
                    s = pa.array(s).cast(pa.decimal128(38, 0))
                else:
                    # A long vector on either side: in integers, whatever their size.
                    against = block or (tree.ids, np.repeat(tree.vectors, np.diff(tree.id_at), axis=0))
                    q, v, s = exact_best(ids, vectors, *against, k)
                    s = pa.array(list(map(Decimal, s)), pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), s], ["query_id", "vec_id", "score"])

    with batch_rows(spark, 1):
        found = settled(lined.mapInArrow(search, "query_id long, vec_id long, score decimal(38,0)"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)
    return found.withColumn("score", F.col("score").try_cast("long"))


ORACLE = f"""
WITH good AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS z FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.z, c.z)::BIGINT AS score
  FROM (SELECT vec_id, min(z) AS z FROM good WHERE vec_id % {EVERY} = 0 GROUP BY vec_id) q JOIN good c ON c.vec_id <> q.vec_id AND len(c.z) = len(q.z)),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= {K}
"""

QUERIES = {"op1_mtree": op1_mtree}
ORACLES = {"op1_mtree": ORACLE}
