"""Exact top-k inner products by best-first search in M-trees.

Inner products become distances by one more coordinate: with m the largest
squared norm, x is stored as (x, sqrt(m - |x|^2)) and q is asked as (q, 0);
then |q' - x'|^2 = |q|^2 + m - 2 q.x. Rows are dealt into shards, and each
shard is an M-tree: pages of PAGE entries, an entry of an inner page with its
covering radius, and every entry with its distance to the page's parent
pivot. A search takes pages by their best possible score. Before an entry's
distance is computed, the stored parent distance bounds it by the triangle
inequality; whole pages go by their radius. Scores are integer products; where
norms allow scores beyond a long, products of Python integers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from relayline.llm.common import arrow_schema, map_rows, materialize, runs

PAGE = 256                                    # rows of a leaf, and pivots of a page, at most
SHARD_VALUES, GROUP_QUERIES = 1 << 20, 16384  # components in a tree; queries that one task asks it
EXACT = float(1 << 52)                        # integer products below it are exact in float64
LONG = float(1 << 62)                         # products and scaled components below it fit a long


def whole(vector, factor: int = 256) -> bytes | None:
    """Int64 bytes of floor(factor * x); None if the vector takes no part. One
    that a long cannot hold fails."""
    if vector is None or any(x is None for x in vector):
        return None
    v = np.floor(np.asarray(vector, dtype=np.float64) * factor)
    if not np.isfinite(v).all():
        return None
    if (np.abs(v) >= LONG).any():
        raise OverflowError("a vector's component is 2^62 or more after scaling")
    return v.astype(np.int64).tobytes()


class Page:
    """An inner page has the points of its pivots, their covering radii and
    pages; a leaf the range ``start`` to ``end`` of the tree's rows. ``above``:
    the entries' distances to the pivot of this page."""
    __slots__ = ("above", "points", "radius", "pages", "start", "end")


class MTree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        x = vectors.astype(np.float64)
        squares = (x * x).sum(axis=1)
        self.most = float(squares.max(initial=0))
        self.x = np.hstack([x, np.sqrt(np.maximum(self.most - squares, 0))[:, None]])
        self.first = self.x[0].copy() if len(x) else None
        self.order: list[np.ndarray] = []
        self.placed = 0
        self.root = self._load(np.arange(len(x)), self.first, np.random.default_rng(3))
        order = np.concatenate(self.order) if self.order else np.arange(0)
        self.ids, self.x, self.vectors = ids[order], self.x[order], vectors[order]  # leaves lie together

    def _from(self, point: np.ndarray, rows: np.ndarray) -> np.ndarray:
        gap = self.x[rows] - point
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))

    def _load(self, rows, pivot, random) -> Page:
        """A page over ``rows``: each goes to the nearest of the pivots."""
        page = Page()
        if len(rows) <= PAGE:
            page.above = self._from(pivot, rows) if len(rows) else np.zeros(0)
            page.pages, page.start, page.end = None, self.placed, self.placed + len(rows)
            self.order.append(rows)
            self.placed += len(rows)
            return page
        fan = min(PAGE, -(-len(rows) // PAGE) + 1)
        picks = random.choice(rows, fan, replace=False)
        x, p = self.x[rows], self.x[picks]
        near = ((p * p).sum(axis=1) - 2 * x @ p.T).argmin(axis=1)
        parts = [rows[near == k] for k in range(fan)]
        if max(map(len, parts)) == len(rows):  # copies of one point
            parts = np.array_split(rows, fan)
        pairs = [(pick, part) for pick, part in zip(picks, parts) if len(part)]
        picks = np.array([pick for pick, _ in pairs])
        page.points, page.above = self.x[picks], self._from(pivot, picks)
        page.radius = np.array([self._from(self.x[pick], part).max() for pick, part in pairs])
        page.pages = [self._load(part, self.x[pick], random) for pick, part in pairs]
        return page

    def search(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """The k best (score, id), ties to the smaller id, without id ``own``."""
        if not len(self.ids):
            return []
        asked = query.astype(np.float64)
        norm = float(asked @ asked)
        exact = norm < EXACT and self.most < EXACT
        long = np.sqrt(norm) * np.sqrt(self.most) < LONG
        slack = 1e-9 * (norm + self.most) + 1e-6
        best: list[tuple[int, int]] = []       # a heap of (score, -id)

        def reach(distance):                   # the highest score at this distance
            return (norm + self.most - np.square(np.maximum(distance, 0))) / 2 + slack

        gap = np.append(asked, 0.0) - self.first
        heap = [(-np.inf, 0, float(np.sqrt(gap @ gap)), self.root)]
        pushed = 1
        while heap:
            bound, _, to_pivot, page = heapq.heappop(heap)
            least = best[0][0] if len(best) == k else -np.inf
            if -bound < least:
                break
            # |d(q, pivot) - d(entry, pivot)| bounds the entry's distance.
            near = np.abs(to_pivot - page.above)
            if page.pages is not None:
                near -= page.radius
            on = np.flatnonzero(reach(near - 1e-9 * to_pivot) >= least)
            if not len(on):
                continue
            if page.pages is None:
                few = 2 * len(on) < len(page.above)
                rows = on + page.start if few else slice(page.start, page.end)
                if exact:
                    scores = self.x[rows, :-1] @ asked
                elif long:
                    scores = self.vectors[rows] @ query
                else:                          # Python integers
                    scores = self.vectors[rows].astype(object) @ query.astype(object)
                ids = self.ids[rows]
                others = ids != own            # the query's own row may be repeated
                scores, ids = scores[others], ids[others]
                if len(scores) > k:            # of a page the k best, and their ties
                    least = max(least, np.partition(scores, -k)[-k])
                for at in np.flatnonzero(scores >= least).tolist():
                    item = int(scores[at]), -int(ids[at])
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
                continue
            points = page.points[on]
            distance = np.sqrt(np.maximum(norm + self.most - 2 * (points[:, :-1] @ asked), 0))
            bounds = reach(distance - page.radius[on] - 1e-9 * distance)
            for at, d, b in zip(on.tolist(), distance.tolist(), bounds.tolist()):
                if b >= least:
                    heapq.heappush(heap, (-b, pushed, d, page.pages[at]))
                    pushed += 1
        return [(score, -i) for score, i in sorted(best, reverse=True)]


def _search(k: int, schema: T.StructType):
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by group and kind: a group's vectors (0) come before
        its queries (1), which are asked as they come."""
        group, ids, vectors, tree = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, found = pa.Table.from_batches([batch]), []
            for start, end in runs(rows, "group"):
                part = rows.slice(start, end - start)
                if part["group"][0].as_py() != group:
                    group, ids, vectors, tree = part["group"][0].as_py(), [], [], None
                kind = part["kind"].to_numpy()
                own, vec = part["id"].to_pylist(), part["vec"].to_pylist()
                cut = int(np.searchsorted(kind, 1))
                ids += own[:cut]
                vectors += vec[:cut]
                if cut < len(own) and tree is None:
                    tree = MTree(np.array(ids, np.int64),
                                 np.frombuffer(b"".join(vectors), np.int64).reshape(len(ids), -1) if ids
                                 else np.zeros((0, 1), np.int64))
                    ids, vectors = [], []
                for query, v in zip(own[cut:], vec[cut:]):
                    found += [(query, v, at, score)
                              for score, at in tree.search(np.frombuffer(v, np.int64), query, k)]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*found), out)], schema=out)
    return run


def top_k(rows: DataFrame, queries: Column, k: int = 5) -> DataFrame:
    """``(vec_id, embedding)`` to ``(query_id, rank, vec_id, score)``: for
    each row that ``queries`` holds for, the k other ids with the highest
    inner products of floor(256 x), ties to the smaller id; fewer if there
    are fewer rows.

    Rows without id, and vectors that are null, empty or hold null or
    non-finite components, take no part. A component of 2^54 or more, or a
    score in the result that a long cannot hold, fails. Vectors are
    compared with those of their length. Repeated rows are candidates as often
    as they occur, but ask once. Other columns are ignored.
    """
    def clean():
        return lambda cols: {"id": cols["vec_id"], "ask": cols["ask"], "vec": [
            None if i is None or not v else whole(v) for i, v in zip(cols["vec_id"], cols["embedding"])]}

    asked = rows.select("vec_id", "embedding", F.coalesce(queries, F.lit(False)).alias("ask"))
    valid = materialize(map_rows(asked, "id long, ask boolean, vec binary", clean).where("vec IS NOT NULL").withColumn(
        "size", F.octet_length("vec")), "search-vectors")
    asks = valid.where("ask").select("id", "vec", "size").distinct()
    counts = valid.groupBy("size").agg(
        F.ceil(F.count(F.lit(1)) * (F.first("size") / 8) / SHARD_VALUES).cast("int").alias("shards"),
        F.greatest(F.lit(1), F.ceil(F.sum(F.col("ask").cast("int")) / GROUP_QUERIES)).cast("int").alias("parts"))
    of = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    deal = lambda name, *cols: F.pmod(F.xxhash64(*cols), F.col(name)).cast("int")
    vectors = valid.withColumn("row", F.monotonically_increasing_id()).join(counts, "size").withColumn(
        "shard", deal("shards", "id", "row")).withColumn("part", of("parts")).select(
        "size", "shard", "part", F.lit(0).alias("kind"), "id", "vec")
    queried = asks.join(counts, "size").withColumn("part", deal("parts", "id")).withColumn("shard", of("shards")).select(
        "size", "shard", "part", F.lit(1).alias("kind"), "id", "vec")
    both = vectors.unionByName(queried).withColumn("group", F.concat_ws(":", "size", "shard", "part"))
    schema = T._parse_datatype_string("query_id long, query binary, vec_id long, score long")
    found = both.select("group", "kind", "id", "vec").repartition("group").sortWithinPartitions(
        "group", "kind").mapInArrow(_search(k, schema), schema)
    place = Window.partitionBy("query_id", "query").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
