"""Hard negatives: rows of another label that score close below an anchor's positives.

Vectors become whole numbers, so scores (inner products) are exact. Rows are dealt into tiles by a hash
of their id, anchors into blocks of anchors that lie close together, each block with a spanning tree
over its anchors; every tile meets every block. In a tile, the root of a block scores all rows. A
child's score of a row differs from its parent's by the edge's length times the row's norm at most, so
the parent's score, or the bounds that the parent has, bound the child's: only rows whose bounds
overlap the window that is wanted are scored again. The window of positives is what beats the
last one kept, the window of negatives lies between two shares of the positives' scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.llm.common import map_rows
from leafmill.plans.workdir import written

POSITIVES, NEGATIVES = 5, 10
#: Least and greatest score of a negative, in hundredths of the positive's.
LOW, HIGH = 30, 90
SCALE = 256
#: Rows of a tile at most (on average), and at least while there are fewer tiles than tasks.
TILE_ROWS, LEAST_ROWS = 65_536, 1024
#: Anchors with one tree, and rows that pass through a tree at a time.
BLOCK, STEP = 256, 8192
#: Vectors that order anchors before they are cut into blocks: signs along so many dimensions.
SIGNS = 16

_UNIT = (
    "tile int, anchors boolean, ids array<bigint>, labels array<bigint>, vectors array<int>, "
    "parents array<int>, edges array<double>, owners array<int>, positives array<bigint>, "
    "scores array<bigint>"
)


def whole(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``id, label, vector`` of the rows that take part, each component ``floor(scale * x)``."""
    odd = F.exists(
        "vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    rows = df.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(label_col).cast("bigint").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    kept = rows.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(~odd)
    parts = F.transform("vector", lambda x: F.floor(x * scale).cast("int"))
    return kept.select("id", "label", parts.alias("vector"))


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order (parents first), parent and edge length of each vector; the root is its own parent."""
    size = len(vectors)
    squares = (vectors * vectors).sum(axis=1)
    apart = np.sqrt(np.maximum(squares[:, None] + squares[None] - 2 * vectors @ vectors.T, 0))
    root = int(apart.sum(axis=1).argmin())
    order, parent = [root], np.full(size, root)
    least = apart[root].copy()
    free = np.ones(size, bool)
    free[root] = False
    while len(order) < size:
        at = int(np.where(free, least, np.inf).argmin())
        order.append(at)
        free[at] = False
        closer = free & (apart[at] < least)
        least[closer], parent[closer] = apart[at][closer], at
    edges = apart[np.arange(size), parent]
    return np.array(order), parent, edges


def _kind(norm: float) -> type:
    """A number type in which inner products of vectors of this norm are exact."""
    if norm * norm < 2**24:
        return np.float32
    if norm * norm < 2**53:
        return np.float64
    if norm * norm >= 2**62:
        raise OverflowError("a score does not fit 64 bits")
    return np.int64


@dataclass
class Tile:
    """Rows of a tile by id, an id once."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray

    @staticmethod
    def of(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Tile:
        ids, labels, vectors = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(ids, kind="stable")
        if len(ids) > 1 and (np.diff(ids[order]) == 0).any():
            # Of rows with one id the smallest label and vector counts.
            order = np.lexsort((*vectors.T[::-1], labels, ids))
            order = order[np.concatenate([[True], np.diff(ids[order]) != 0])]
        vectors = vectors[order].astype(np.float64)
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        return Tile(ids[order], labels[order], vectors, norms)


@dataclass
class Block:
    """Anchors, parents first, and the positives that each has (none while these are looked for)."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    parents: np.ndarray
    edges: np.ndarray
    owners: np.ndarray
    positives: np.ndarray
    scores: np.ndarray


def best(scores: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The highest scores and their ids; of equal scores the smaller id comes first."""
    if len(scores) > 4 * most:  # only what can be among the first is sorted
        last = np.partition(scores, len(scores) - most)[len(scores) - most]
        scores, ids = scores[scores >= last], ids[scores >= last]
    order = np.lexsort((ids, -scores))[:most]
    return scores[order], ids[order]


def bounded(block: Block, tile: Tile, wanted) -> tuple[int, int]:
    """Pass the rows of a tile through the tree of a block.

    ``wanted`` is called for each anchor with the slice of rows, the lower and upper bounds of their
    scores, and a function that scores the rows given by number; it says for which rows it did so by
    returning their numbers and scores, which narrows the bounds of the anchor's children. Returns how
    many scores were computed and how many there are.
    """
    top = max(tile.norms.max(initial=0), np.sqrt((block.vectors**2).sum(axis=1)).max(initial=0))
    kind = _kind(top)
    rows, anchors = tile.vectors.astype(kind), block.vectors.astype(kind)
    done = 0
    for begin in range(0, len(tile.ids), STEP):
        part = slice(begin, begin + STEP)
        held, norms = rows[part], tile.norms[part]
        bounds: list[tuple[np.ndarray, np.ndarray]] = []
        for number, (parent, edge) in enumerate(zip(block.parents, block.edges)):
            anchor = anchors[number]
            if number == 0:
                low = high = (held @ anchor).astype(np.int64)
                done += len(held)
            else:
                reach = np.ceil(edge * norms * (1 + 1e-9) + 1e-6).astype(np.int64)
                low, high = bounds[parent][0] - reach, bounds[parent][1] + reach

            def score(at: np.ndarray) -> np.ndarray:
                return (held[at] @ anchor).astype(np.int64)

            at, exact = wanted(number, part, low, high, score, number == 0)
            if number and len(at):
                done += len(at)
                low[at] = high[at] = exact
            bounds.append((low, high))
    return done, len(block.ids) * len(tile.ids)


def find_positives(block: Block, tile: Tile, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The best scores and ids of other rows of the label of each anchor."""
    none = np.empty(0, np.int64)
    kept = [(none, none) for _ in block.ids]
    label_at = {label: tile.labels == label for label in set(block.labels.tolist())}

    def wanted(number, part, low, high, score, exact):
        scores, ids = kept[number]
        same = label_at[int(block.labels[number])][part] & (tile.ids[part] != block.ids[number])
        least = scores[-1] if len(scores) == most else np.iinfo(np.int64).min
        at = np.flatnonzero(same & (high >= least))
        found = low[at] if exact else score(at)
        kept[number] = best(
            np.concatenate([scores, found]), np.concatenate([ids, tile.ids[part][at]]), most
        )
        return at, found

    bounded(block, tile, wanted)
    return kept


def windows_of(scores: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest whole score with ``low * s <= 100 * score <= high * s``."""
    return -((-low * scores) // 100), (high * scores) // 100


def find_negatives(
    block: Block, tile: Tile, most: int, low_share: int, high_share: int
) -> tuple[list[tuple[np.ndarray, np.ndarray]], tuple[int, int]]:
    """The best scores and ids of rows of another label in the window of each positive."""
    none = np.empty(0, np.int64)
    kept = [(none, none) for _ in block.positives]
    least, greatest = windows_of(block.scores, low_share, high_share)
    own = [np.flatnonzero(block.owners == number) for number in range(len(block.ids))]
    label_at = {label: tile.labels != label for label in set(block.labels.tolist())}

    def wanted(number, part, low, high, score, exact):
        uses = [p for p in own[number] if least[p] <= greatest[p]]
        if not uses:
            return none, none
        # A window whose list is full only wants what beats the last one kept.
        floors = [max(least[p], kept[p][0][-1]) if len(kept[p][0]) == most else least[p] for p in uses]
        other = label_at[int(block.labels[number])][part]
        at = np.flatnonzero(other & (high >= min(floors)) & (low <= max(greatest[p] for p in uses)))
        found = low[at] if exact else score(at)
        ids = tile.ids[part][at]
        for p, floor in zip(uses, floors):
            inside = (found >= floor) & (found <= greatest[p])
            if inside.any():
                scores, names = kept[p]
                kept[p] = best(
                    np.concatenate([scores, found[inside]]), np.concatenate([names, ids[inside]]), most
                )
        return at, found

    counts = bounded(block, tile, wanted)
    return kept, counts


def _lists(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return values.astype(kind), offsets - offsets[0]


def _units(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[Tile, Block]]:
    """Each tile with each of its blocks; a tile's rows come before the blocks."""
    now, parts, tile = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        tiles = columns["tile"].to_numpy(zero_copy_only=False)
        anchors = columns["anchors"].to_numpy(zero_copy_only=False).astype(bool)
        held = {
            name: _lists(columns[name], np.float64 if name == "edges" else np.int64)
            for name in batch.schema.names[2:]
        }
        changes = np.flatnonzero((np.diff(tiles) != 0) | (np.diff(anchors.astype(int)) != 0)) + 1
        for begin, end in zip([0, *changes], [*changes, batch.num_rows]):
            if tiles[begin] != now:
                now, parts, tile = tiles[begin], [], None

            def cut(name: str, a: int, b: int) -> np.ndarray:
                values, offsets = held[name]
                return values[offsets[a] : offsets[b]]

            if not anchors[begin]:
                vectors = cut("vectors", begin, end).reshape(-1, dims)
                parts.append((cut("ids", begin, end), cut("labels", begin, end), vectors))
                continue
            if tile is None:
                if not parts:
                    continue  # a tile without rows
                tile, parts = Tile.of(parts), []
            for row in range(begin, end):
                given = [cut(name, row, row + 1) for name in batch.schema.names[2:]]
                given[2] = given[2].reshape(-1, dims).astype(np.float64)
                yield tile, Block(*given)


def anchor_blocks(anchors: DataFrame, dims: int) -> DataFrame:
    """Blocks of close anchors with their trees; ``anchors`` has ``id, label, vector, found``.

    ``found`` is an array of ``score, id``: an anchor's positives.
    """
    signs = F.transform(F.slice("vector", 1, SIGNS), lambda x: (x >= 0).cast("int"))
    ordered = anchors.withColumn("_signs", signs).repartitionByRange("label", "_signs", "id")
    ordered = ordered.sortWithinPartitions("label", "_signs", "id").drop("_signs")
    size = BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def out(rows: list[dict]) -> pa.RecordBatch:
            vectors = np.array([r["vector"] for r in rows], np.float64).reshape(len(rows), dims)
            order, parent, edges = spanning_tree(vectors)
            place = np.empty(len(order), int)
            place[order] = np.arange(len(order))
            rows = [rows[i] for i in order]
            found = [(n, f["id"], f["score"]) for n, r in enumerate(rows) for f in r["found"]]
            owners, ids, scores = zip(*found) if found else ((), (), ())
            made = {
                "ids": [r["id"] for r in rows],
                "labels": [r["label"] for r in rows],
                "vectors": vectors[order].astype(np.int32).ravel(),
                "parents": place[parent[order]].astype(np.int32),
                "edges": edges[order],
                "owners": np.array(owners, np.int32),
                "positives": np.array(ids, np.int64),
                "scores": np.array(scores, np.int64),
            }
            kinds = {"vectors": pa.int32(), "parents": pa.int32(), "owners": pa.int32()}
            kinds["edges"] = pa.float64()
            return pa.RecordBatch.from_arrays(
                [pa.array([v], pa.list_(kinds.get(k, pa.int64()))) for k, v in made.items()],
                list(made),
            )

        for batch in batches:
            held += batch.to_pylist()
            while len(held) >= size:
                yield out(held[:size])
                held = held[size:]
        if held:
            yield out(held)

    return map_rows(ordered, run, _UNIT.split(", ", 2)[2])


def _dealt(rows: DataFrame, blocks: DataFrame, tiles: int) -> DataFrame:
    """Rows and blocks by tile: a tile's rows first, then every block. One task has one tile."""
    names = blocks.columns
    none = F.array().cast("array<int>")
    given = {
        "ids": F.array("id"), "labels": F.array("label"), "vectors": F.col("vector"),
        "edges": F.array().cast("array<double>"),
    }
    own = rows.select(
        F.pmod(F.xxhash64("id"), F.lit(tiles)).cast("int").alias("tile"),
        F.lit(False).alias("anchors"),
        *(given.get(c, none).cast(blocks.schema[c].dataType).alias(c) for c in names),
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile")
    copies = blocks.select(every, F.lit(True).alias("anchors"), *names)
    both = own.unionByName(copies)
    return both.repartitionById(tiles, F.col("tile")).sortWithinPartitions("tile", "anchors")


def _first(rows: DataFrame, by: list[str], score: str, name: str, most: int) -> DataFrame:
    """The first rows of each group by score, then id, numbered by ``rank`` from 1."""
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(name))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(
    df: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` is a condition on ``id``, the id as a whole number. An anchor's positives are the
    ``positives`` other rows of its label with the highest scores; for each, the ``negatives`` rows of
    another label with the highest scores among those with ``low * positive_score <= 100 *
    negative_score <= high * positive_score`` are returned, by rank. Of equal scores the smaller id
    comes first. Components are ``floor(scale * x)`` and have to fit 32 bits, scores 64 bits; else the
    job fails.

    Rows with a NULL id, label or vector or a NULL or non-finite component take no part. Of rows with
    one id the one with the smallest label and vector counts. A shorter vector reads as filled up
    with zeros. Without anchors or rows there is no result. Every anchor meets every row, in tiles:
    rows move once for each of the two steps, anchors once to each tile.
    """
    spark = df.sparkSession
    rows = whole(df, id_col, vector_col, label_col, scale)
    count, longest = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    dims = max(longest or 0, 1)
    missing = F.array_repeat(F.lit(0), F.lit(dims) - F.size("vector"))
    rows = rows.withColumn("vector", F.concat("vector", missing))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tiles = max(-(-count // TILE_ROWS), min(parts, -(-count // LEAST_ROWS)), 1)

    smallest = F.min(F.struct("label", "vector")).alias("row")
    chosen = written(
        spark, rows.where(anchors).groupBy("id").agg(smallest).select("id", "row.*"), "anchors"
    )
    none = F.array().cast("array<struct<score:bigint,id:bigint>>")
    first_blocks = written(
        spark, anchor_blocks(chosen.withColumn("found", none), dims), "blocks"
    )

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile, block in _units(batches, dims):
            found = find_positives(block, tile, positives)
            owners = np.repeat(block.ids, [len(ids) for _, ids in found])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(owners),
                    pa.array(np.concatenate([ids for _, ids in found])),
                    pa.array(np.concatenate([scores for scores, _ in found])),
                ],
                ["anchor", "id", "score"],
            )

    near = map_rows(
        _dealt(rows, first_blocks, tiles), nearest, "anchor bigint, id bigint, score bigint"
    )
    kept = _first(near, ["anchor"], "score", "id", positives)
    found = kept.groupBy("anchor").agg(F.collect_list(F.struct("score", "id")).alias("found"))
    ready = chosen.join(found.withColumnRenamed("anchor", "id"), "id")
    blocks = written(spark, anchor_blocks(ready, dims), "blocks")

    def mined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile, block in _units(batches, dims):
            found, _ = find_negatives(block, tile, negatives, low, high)
            if not found:
                continue
            sizes = [len(ids) for _, ids in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(block.ids[block.owners], sizes)),
                    pa.array(np.repeat(block.positives, sizes)),
                    pa.array(np.concatenate([ids for _, ids in found])),
                    pa.array(np.repeat(block.scores, sizes)),
                    pa.array(np.concatenate([scores for scores, _ in found])),
                ],
                ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"],
            )

    schema = (
        "anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint, "
        "negative_score bigint"
    )
    hard = map_rows(_dealt(rows, blocks, tiles), mined, schema)
    ranked = _first(hard, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return ranked.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
