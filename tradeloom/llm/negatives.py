"""Hard negatives: for an anchor, rows of other labels that score almost as well as its positives.

A row's score is its inner product with the anchor, in whole numbers. Rows are packed into
R-trees by sort, tile, recurse: slabs along the coordinate that spreads most are cut by a range
partitioning, tasks tile a slab along the further coordinates into pages of PAGE rows, which are
written once; a task that reads pages builds the upper levels over them. A box gives each
coordinate an interval, and so bounds the inner product with a query from both sides. A
best-first queue per query opens boxes of FAN pages by upper bound, in turns of one, two, four
boxes and so on, and leaves out boxes and pages outside the query's window of scores and those
strictly below the kth score found. What the queries of a turn open in a box is scored by one
matrix product, once for all windows of an anchor. Each task returns its k best rows of a query;
the k best of these are the answer.

Queries are dealt into parts of QUERY_BYTES, each of which is sent to all tasks in turn, so
that neither the driver nor a task holds more than a part, a batch of pages and k rows a query.

Rows without an id or a label, with a null or empty vector, or with a component that is null or
not finite take no part, nor do vectors longer than 2**31 units, whose scores 64 bits might not
hold; vectors of different lengths are not compared. Repeated rows are rows of their own; a row
that has the anchor's id is never its positive. Ties go to the smaller id, then to the smaller
label. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.llm.frames import col
from tradeloom.llm.texts import trim
from tradeloom.sources.scratch import materialize

UNIT = 256  # units per 1 of a component
PAGE, FAN = 64, 16  # rows of a page, boxes of a box
QUERY_BYTES = 32 << 20
QUERIES_AT_ONCE = 1024
LONGEST = float(1 << 62)  # square of the longest vector, in units
EVERYTHING = (np.iinfo(np.int64).min, np.iinfo(np.int64).max)
NOTHING = EVERYTHING[0]  # below all scores


def usable_rows(vectors: DataFrame) -> DataFrame:
    """`vec_id`, `label`, `dim`, `vector` of the rows that take part, components in whole units."""
    vector = col("embedding").cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x))
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * UNIT * x * UNIT)
    rows = vectors.select(col("vec_id").cast("bigint").alias("vec_id"), col("label").cast("bigint").alias("label"),
                          vector.alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & finite)
    rows = rows.where(square < LONGEST)
    return rows.withColumn("dim", F.size("vector"))


def tiles(rows: np.ndarray, page: int = PAGE) -> list[np.ndarray]:
    """Rows of each page, packed by sort, tile, recurse along the coordinates that spread most."""
    pages = -(-len(rows) // page)
    cuts = max(1, min(rows.shape[1], int(np.ceil(np.log2(max(pages, 1))))))
    spread = np.argsort(-(rows.max(axis=0) - rows.min(axis=0)), kind="stable")[:cuts]

    def tile(some: np.ndarray, left: np.ndarray) -> list[np.ndarray]:
        n = -(-len(some) // page)
        if n <= 1:
            return [some] if len(some) else []
        some = some[np.argsort(rows[some, left[0]], kind="stable")]
        slabs = n if len(left) == 1 else int(np.ceil(n ** (1 / len(left))))
        step = -(-n // slabs) * page
        parts = [some[i : i + step] for i in range(0, len(some), step)]
        if len(left) == 1:
            return parts
        return [p for part in parts for p in tile(part, left[1:])]

    return tile(np.arange(len(rows)), spread)


def pack(rows: DataFrame) -> DataFrame:
    """The rows as written pages: `dim`, and ids, labels and vectors of a page as bytes."""
    at = F.posexplode("vector").alias("at", "x")
    widest = rows.select("dim", at).groupBy("dim", "at").agg(F.variance("x").alias("spread")).groupBy("dim").agg(
        F.max_by("at", "spread").alias("widest")
    )
    # Rows that agree there are cut apart by a hash of their id.
    along = rows.join(widest, "dim").withColumn("_first", F.get("vector", F.col("widest"))).drop("widest")
    order = ["dim", "_first", F.xxhash64("vec_id")]
    slabs = along.repartitionByRange(*order).sortWithinPartitions(*order)

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in ("dim", "ids", "labels", "vectors")}
            dims = batch["dim"].to_numpy()
            ids, labels = batch["vec_id"].to_numpy(), batch["label"].to_numpy()
            lists = batch["vector"]
            for dim in np.unique(dims):
                places = np.flatnonzero(dims == dim)
                flat = lists.take(pa.array(places)).flatten().to_numpy()
                matrix = np.floor(flat.reshape(len(places), dim) * UNIT)
                for page in tiles(matrix):
                    out["dim"].append(int(dim))
                    out["ids"].append(ids[places[page]].astype("<i8").tobytes())
                    out["labels"].append(labels[places[page]].astype("<i8").tobytes())
                    out["vectors"].append(matrix[page].astype("<f8").tobytes())
            yield pa.RecordBatch.from_pydict(out, schema=PAGES)
            trim()

    return materialize(slabs.mapInArrow(tile, "dim int, ids binary, labels binary, vectors binary"), "pages")


PAGES = pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary())])


@dataclass
class Tree:
    """Pages of one dimension and the boxes above them, lowest level first."""

    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    first: np.ndarray  # row each page begins at, and the number of rows
    levels: list[tuple[np.ndarray, np.ndarray]]  # lowest and highest components of each box

    @classmethod
    def over(cls, dim: int, ids: list[bytes], labels: list[bytes], vectors: list[bytes]) -> Tree:
        sizes = np.array([len(i) // 8 for i in ids])
        first = np.concatenate([[0], np.cumsum(sizes)])
        rows = np.frombuffer(b"".join(vectors), "<f8").reshape(-1, dim)
        low, high = np.minimum.reduceat(rows, first[:-1]), np.maximum.reduceat(rows, first[:-1])
        levels = [(low, high)]
        while len(low) > 1:
            heads = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, heads), np.maximum.reduceat(high, heads)
            levels.append((low, high))
        return cls(np.frombuffer(b"".join(ids), "<i8"), np.frombuffer(b"".join(labels), "<i8"), rows, first, levels)

    def exact_with(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and queries as numbers whose inner products are exact."""
        largest = np.abs(queries).max() * np.abs(self.rows).max() * self.rows.shape[1]
        if largest < 1 << 53:
            return self.rows, queries
        return self.rows.astype(np.int64), queries.astype(np.int64)

    def bounds(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each level the lower and upper bounds of the inner products: boxes by queries.

        In each coordinate the product lies between those with the box's two ends. Bounds are
        widened by what rounding may have taken from large ones.
        """
        for level in range(len(self.levels)):
            yield self.bounds_of(level, slice(None), queries)

    def bounds_of(self, level: int, boxes: np.ndarray | slice, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bounds of some boxes of a level."""
        low, high = (side[boxes] for side in self.levels[level])
        up, down = np.maximum(queries, 0).T, np.minimum(queries, 0).T
        spare = (np.maximum(np.abs(low), np.abs(high)) @ np.abs(queries).T) * 1e-12
        spare = np.where(spare < 1e-2, 0.0, spare)  # sums of whole numbers this small are exact
        return low @ up + high @ down - spare, high @ up + low @ down + spare

    def below(self, level: int, boxes: np.ndarray) -> np.ndarray:
        """The boxes of the next lower level that lie in some boxes of a level."""
        inside = (boxes[:, None] * FAN + np.arange(FAN)).ravel()
        return inside[inside < len(self.levels[level - 1][0])]

    def rows_of(self, pages: np.ndarray) -> np.ndarray | slice:
        """The places of the pages' rows; ascending pages without a gap are one slice."""
        if pages[-1] - pages[0] == len(pages) - 1:
            return slice(self.first[pages[0]], self.first[pages[-1] + 1])
        return np.concatenate([np.arange(self.first[p], self.first[p + 1]) for p in pages])


@dataclass
class Queries:
    """Queries of one dimension: the k best rows with scores from low to high, of the label or of all others.

    Queries of one key have one vector and lie side by side.
    """

    key: np.ndarray
    own: np.ndarray  # id not to be returned for a query of its own label
    label: np.ndarray
    low: np.ndarray
    high: np.ndarray
    of: np.ndarray  # vector of each query, ascending
    vectors: np.ndarray
    same: bool
    k: int


@dataclass
class Best:
    """The k best rows of each query so far, best first; NOTHING is the score of a free place."""

    score: np.ndarray
    found: np.ndarray
    label: np.ndarray

    @classmethod
    def of(cls, queries: Queries) -> Best:
        shape = (len(queries.key), queries.k)
        return cls(np.full(shape, NOTHING), np.zeros(shape, np.int64), np.zeros(shape, np.int64))

    def least(self, queries: Queries, some: np.ndarray) -> np.ndarray:
        """The score a row needs at least to be among the best of some queries."""
        return np.maximum(queries.low[some], self.score[some, -1])

    def take(self, of: np.ndarray, score: np.ndarray, found: np.ndarray, label: np.ndarray) -> None:
        """Put each row in its place among the best rows of its query."""
        places = (self.score, self.found, self.label)
        touched = np.unique(of)
        held, at = np.nonzero(self.score[touched] > NOTHING)
        of = np.concatenate([of, touched[held]])
        rows = [np.concatenate([new, old[touched[held], at]]) for new, old in zip((score, found, label), places)]
        order = np.lexsort((rows[2], rows[1], -rows[0], of))
        of = of[order]
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        kept = rank < self.score.shape[1]
        self.score[touched] = NOTHING
        for new, old in zip(rows, places):
            old[of[kept], rank[kept]] = new[order][kept]


def best_first(tree: Tree, queries: Queries, some: np.ndarray, best: Best) -> None:
    """Bring the best rows of `some` queries, which lie side by side, up to date with the tree's."""
    of = queries.of[some] - queries.of[some[0]]
    rows, vectors = tree.exact_with(queries.vectors[queries.of[some[0]] : queries.of[some[-1]] + 1])
    high, least = queries.high[some], best.least(queries, some)
    level = len(tree.levels) - 1
    boxes = np.arange(len(tree.levels[level][0]))
    while True:
        lower, upper = (side[:, of] for side in tree.bounds_of(level, boxes, vectors))
        wanted = (upper >= least) & (lower <= high)
        if level <= 1:
            break
        boxes = tree.below(level, boxes[wanted.any(axis=1)])
        level -= 1
    queue = np.argsort(np.where(wanted, -upper, np.inf), axis=0, kind="stable")
    length = wanted.sum(axis=0)
    start, turn = 0, 1
    while start < length.max(initial=0):
        next_ones = queue[start : start + turn]
        _, query = np.nonzero(start + np.arange(len(next_ones))[:, None] < length)
        box = next_ones[start + np.arange(len(next_ones))[:, None] < length]
        by_box = np.argsort(box, kind="stable")
        for group in np.split(by_box, np.flatnonzero(np.diff(box[by_box])) + 1):
            i, mine = box[group[0]], query[group]
            # Boxes strictly below the kth score found are left out.
            mine = mine[upper[i, mine] >= best.least(queries, some[mine])]
            if len(mine):
                pages = tree.below(1, boxes[i : i + 1]) if level else boxes[i : i + 1]
                open_box(tree, rows, vectors, pages, queries, some[mine], of[mine], best)
        start, turn = start + turn, 2 * turn


def open_box(tree: Tree, rows: np.ndarray, vectors: np.ndarray, pages: np.ndarray,
             queries: Queries, mine: np.ndarray, of: np.ndarray, best: Best) -> None:
    """Score the rows of a box's pages for the queries `mine`, whose vectors are `vectors[of]`."""
    least, high, k = best.least(queries, mine), queries.high[mine], queries.k
    asked, of = np.unique(of, return_inverse=True)
    lower, upper = (side[:, of] for side in tree.bounds_of(0, pages, vectors[asked]))
    pages = pages[((upper >= least) & (lower <= high)).any(axis=1)]
    if not len(pages):
        return
    at = tree.rows_of(pages)
    ids, labels = tree.ids[at], tree.labels[at]
    scores = (vectors[asked] @ rows[at].T)[of]
    good = (scores >= least[:, None]) & (scores <= high[:, None])
    if len(ids) > k and np.count_nonzero(good) > 8 * k * len(mine):
        # Of many rows only those that are among the k best here, with all that tie with the last.
        good &= (labels == queries.label[mine][:, None]) == queries.same
        if queries.same:
            good &= ids != queries.own[mine][:, None]
        kth = np.partition(np.where(good, scores, scores.dtype.type(NOTHING)), len(ids) - k, axis=1)[:, len(ids) - k]
        good &= scores >= kth[:, None]
    query, row = np.nonzero(good)
    score, found, label = scores[query, row].astype(np.int64), ids[row], labels[row]
    query = mine[query]
    kept = (label == queries.label[query]) == queries.same
    if queries.same:
        kept &= found != queries.own[query]
    kept &= (score > best.score[query, -1]) | (found <= best.found[query, -1])
    if kept.any():
        best.take(query[kept], score[kept], found[kept], label[kept])


def answer(tree: Tree, queries: Queries, best: Best) -> None:
    """Bring the best rows of each query up to date with the tree's."""
    for start in range(0, len(queries.key), QUERIES_AT_ONCE):
        best_first(tree, queries, np.arange(start, min(start + QUERIES_AT_ONCE, len(queries.key))), best)


def search(pages: DataFrame, asked: DataFrame, same: bool, k: int) -> DataFrame:
    """`key`, `low`, `high`, `place`, `found_id`, `score`: the k best rows of each query, places from 1.

    `asked` has `key`, `vec_id`, `label`, `dim`, `vector` in units and the window from `low` to
    `high`.
    """
    spark = pages.sparkSession
    size = asked.agg(F.sum(F.col("dim") * 8 + 64)).first()[0] or 0
    parts = int(size // QUERY_BYTES) + 1
    found = None
    for part in range(parts):
        mine = asked.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == part) if parts > 1 else asked
        sent = spark.sparkContext.broadcast(grouped(mine.toArrow(), same, k))
        more = pages.mapInArrow(searcher(sent), "key bigint, low bigint, high bigint, score bigint, found_id bigint, label bigint")
        found = more if found is None else found.union(more)
    order = Window.partitionBy("key", "low", "high").orderBy(F.desc("score"), "found_id", "label")
    ranked = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    return ranked.drop("label")


def grouped(asked: pa.Table, same: bool, k: int) -> dict[int, Queries]:
    """Queries by dimension."""
    dims = asked["dim"].to_numpy()
    out = {}
    for dim in np.unique(dims):
        mine = asked.take(pa.array(np.flatnonzero(dims == dim))).sort_by("key")
        _, first, of = np.unique(mine["key"].to_numpy(), return_index=True, return_inverse=True)
        vectors = mine["vector"].take(pa.array(first)).combine_chunks().flatten().to_numpy().reshape(-1, dim)
        columns = (mine[c].to_numpy() for c in ("key", "vec_id", "label", "low", "high"))
        out[int(dim)] = Queries(*columns, of, vectors, same, k)
    return out


FOUND = pa.schema([(c, pa.int64()) for c in ("key", "low", "high", "score", "found_id", "label")])


def searcher(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: dict[int, Queries] = sent.value
        best = {dim: Best.of(q) for dim, q in asked.items()}
        for batch in batches:
            pages = batch.to_pydict()
            for dim in sorted(set(pages["dim"]) & set(asked)):
                here = [i for i, d in enumerate(pages["dim"]) if d == dim]
                tree = Tree.over(dim, *([pages[c][i] for i in here] for c in ("ids", "labels", "vectors")))
                answer(tree, asked[dim], best[dim])
        for dim, q in asked.items():
            of, place = np.nonzero(best[dim].score > NOTHING)
            rows = (side[of, place] for side in (best[dim].score, best[dim].found, best[dim].label))
            columns = (q.key[of], q.low[of], q.high[of], *rows)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=FOUND)
        trim()

    return run


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5,
                   least: int = 80, most: int = 100) -> DataFrame:
    """`anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`, `negative_score`.

    Anchors are the rows whose id is divisible by `every`. Negatives score from `least` to
    `most` hundredths of the positive's score.
    """
    rows = usable_rows(vectors)
    pages = pack(rows)
    units = F.transform("vector", lambda x: F.floor(x * UNIT).cast("double"))
    anchors = rows.where(F.col("vec_id") % every == 0).select(
        F.monotonically_increasing_id().alias("key"), "vec_id", "label", "dim", units.alias("vector")
    )
    anchors = materialize(anchors, "anchors")  # fixes the keys
    anyhow = {c: F.lit(int(x)) for c, x in zip(("low", "high"), EVERYTHING)}
    liked = search(pages, anchors.withColumns(anyhow), True, positives)
    # least * score <= 100 * negative <= most * score, in whole numbers.
    score = F.col("score").cast("decimal(20,0)")
    window = {
        "low": F.ceil(least * score / 100).cast("bigint"),
        "high": F.floor(most * score / 100).cast("bigint"),
    }
    liked = liked.select("key", "place", F.col("found_id").alias("positive_id"), F.col("score")).withColumns(window)
    liked = materialize(liked.withColumnRenamed("score", "positive_score"), "positives")
    windows = liked.where(F.col("low") <= F.col("high")).select("key", "low", "high").distinct()
    hard = search(pages, materialize(anchors.join(windows, "key"), "windows"), False, negatives)
    hard = hard.withColumnsRenamed({"place": "rank", "found_id": "negative_id", "score": "negative_score"})
    named = anchors.select("key", F.col("vec_id").alias("anchor_id"))
    return named.join(liked, "key").join(hard, ["key", "low", "high"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label))
