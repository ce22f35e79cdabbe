"""Self-join of documents on the Jaccard similarity of their word shingles, with connected components.

Exact, in these steps:

1. Each text becomes a set of shingle hashes. Texts with one set form a class (a node); only
   classes are compared.
2. Prefix filter: two sets that are similar enough share one of the first ``n - ceil(t n) + 1``
   members in any common order. Hash order is used, with shingles known to be frequent last, so
   that few sets meet at one key. (The list of frequent ones comes from a part of the texts and
   has a fixed size; it changes the work, not the result.)
3. At each key every set is paired with the first set there. These pairs are checked by
   intersecting sorted arrays, and the links give components.
4. Sets that share a key but are in different components meet in tiles: one key, one band of
   sizes, at most ``TILE`` sets by ``TILE``. Bitmaps in which each member flips a bit bound the
   overlap from above. Pairs of a small tile that pass are checked exactly afterwards. A tile of
   ``LARGE`` sets or more holds the arrays too: the pairs that pass are checked in it, and it hands
   on the links that join two of its components, fewer than it has sets, and nothing else.

Pairs inside one component are not compared again: they cannot change it. Hot keys are harmless in
3 (minima are combined before they move, the join may split a key) and cut into tiles in 4.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import free_name, id_text, id_type, map_rows, small_batches, tidy
from leafmill.llm.graph import components
from leafmill.plans.workdir import passing, written

WORDS = 5
#: Similarity as a fraction.
LEAST, WHOLE = 4, 5
TILE = 1024
BAND = 1.25
#: Sets of a tile that checks its pairs itself, and the bytes of arrays a part of one may hold.
LARGE, TILE_BYTES = 256, 32 << 20
#: Most frequent shingles that the order puts last, and the share of the texts they come from.
HOT_KEYS = 1 << 16
HOT_SHARE, HOT_LEAST = 64, 8
#: Bits of the tables that tell texts whose arrays are wanted, and shared keys, from most others.
WANTED_BITS, KEY_BITS = 1 << 24, 1 << 26
MOST_BITS = 4096
#: Sets that a task remembers as written, and rows of keys in a batch.
SEEN, ROWS_OUT = 200_000, 1 << 18
#: What a row of a tile does.
IS_MET, MEETS, MEETS_ALL = 0, 1, 2
MIX = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(words: list[bytes], width: int = WORDS) -> np.ndarray:
    """64-bit hash of each run of ``width`` words, in order; fewer words are one run, none give none."""
    if not words:
        return np.zeros(0, dtype=np.int64)
    hashes = word_hashes(words)
    size = min(width, len(words))
    count = len(words) - size + 1
    out = np.full(count, size, dtype=np.uint64)
    for k in range(size):
        out = (out ^ hashes[k : k + count]) * MIX[k % len(MIX)]
        out ^= out >> np.uint64(29 + k % len(MIX))
    return out.view(np.int64)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted different shingles of a text, letters A-Z lower-cased."""
    words = (text or "").encode("utf-8").lower().split()  # of bytes: A-Z and ASCII white space only
    return np.unique(shingles(words))


def node_of(members: np.ndarray) -> int:
    """One number for a set."""
    number = xxhash.xxh3_64_intdigest(members.tobytes())
    return number - (1 << 64) if number >> 63 else number


def prefix(members: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """The members of which any similar set must have one."""
    wanted = len(members) - -(-LEAST * len(members) // WHOLE) + 1
    if len(hot):
        place = np.minimum(np.searchsorted(hot, members), len(hot) - 1)
        frequent = hot[place] == members
        members = np.concatenate([members[~frequent], members[frequent]])
    return members[:wanted]


def bitmap(members: np.ndarray) -> bytes:
    """Parity of the members that fall on each bit; as many bits as members, within limits."""
    bits = 64
    while bits < len(members) and bits < MOST_BITS:
        bits *= 2
    odd = np.bincount(members & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def folded(packed: bytes, bits: int) -> np.ndarray:
    """A bitmap at a smaller width, as 64-bit words."""
    words = np.frombuffer(packed, dtype=np.uint64)
    while len(words) * 64 > bits:
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words


def band_of(size: Column) -> Column:
    return F.floor(F.log(BAND, size)).cast("int")


def _frequent(texts: DataFrame) -> np.ndarray:
    """Shingles found often in a share of the different texts, sorted; at most ``HOT_KEYS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            keys = np.concatenate([shingle_set(t) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(keys)], ["key"])

    part = texts.where(F.pmod("row", F.lit(HOT_SHARE)) == 0).dropDuplicates(["row"])
    counted = map_rows(part, run, "key long").groupBy("key").count()
    kept = counted.where(F.col("count") >= HOT_LEAST).orderBy(F.desc("count"), "key")
    return np.array(sorted(r["key"] for r in kept.limit(HOT_KEYS).collect()), dtype=np.int64)


def _prefix_rows(prefixes: DataFrame, wanted: np.ndarray | None = None) -> DataFrame:
    """``key, node, size``: a row for each member of a set's prefix, or those that may be ``wanted``."""
    shared = prefixes.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            held = batch.column(2).to_pylist()
            keys = np.frombuffer(b"".join(held), np.int64)
            counts = [len(k) // 8 for k in held]
            nodes = np.repeat(batch.column(0).to_numpy(), counts)
            sizes = np.repeat(batch.column(1).to_numpy().astype(np.int32), counts)
            if table is not None:
                kept = _has(table, keys)
                keys, nodes, sizes = keys[kept], nodes[kept], sizes[kept]
            for k in range(0, len(keys), ROWS_OUT):
                part = [pa.array(c[k : k + ROWS_OUT]) for c in (keys, nodes, sizes)]
                yield pa.RecordBatch.from_arrays(part, ["key", "node", "size"])

    return map_rows(prefixes.select("node", "n_shingles", "prefix"), run, "key long, node long, size int")


def _has(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether a table of bits has those of the values."""
    bit = np.mod(values, len(table) * 64)
    return (table[bit // 64] >> (bit % 64).astype(np.uint64) & np.uint64(1)).astype(bool)


def wanted_filter(nodes: DataFrame, column: str, size: int = WANTED_BITS) -> np.ndarray:
    """A table of ``size`` bits with those of the given nodes set, whatever their number."""
    bit = F.pmod(F.col(column), F.lit(size))
    words = (
        nodes.select((bit / 64).cast("int").alias("word"), (bit % 64).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .toArrow()
    )
    table = np.zeros(size // 64, dtype=np.uint64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return table


def _arrays(nodes: DataFrame, bitmaps: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, members`` of the sets in the column ``node``, and of a few others, once for a node.

    Each is cut again from one text that has it.
    """
    spark = texts.sparkSession
    of = bitmaps.select("node", "row").join(nodes.distinct(), "node", "left_semi")
    shared = spark.sparkContext.broadcast(wanted_filter(of, "row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        seen: set[int] = set()
        for batch in batches:
            batch = batch.filter(pa.array(_has(table, batch.column(2).to_numpy())))
            for part in small_batches([batch]):
                numbers, arrays = [], []
                if len(seen) > SEEN:
                    seen.clear()
                for text, row in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    members = shingle_set(text) if row not in seen else ()
                    seen.add(row)
                    if len(members):
                        numbers.append(node_of(members))
                        arrays.append(members.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers, pa.int64()), pa.array(arrays, pa.binary())], ["node", "members"]
                )

    made = map_rows(texts, run, "node long, members binary")
    return written(spark, made, "jaccard").dropDuplicates(["node"])


def _checked(pairs: DataFrame, bitmaps: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that are similar enough, by intersecting their sorted arrays."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    arrays = _arrays(nodes, bitmaps, texts)
    held = pairs.join(arrays.select(F.col("node").alias("a"), F.col("members").alias("left")), "a")
    held = held.join(arrays.select(F.col("node").alias("b"), F.col("members").alias("right")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "left"):
            keep = []
            for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                one, other = np.frombuffer(left, np.int64), np.frombuffer(right, np.int64)
                both = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(WHOLE * both >= LEAST * (len(one) + len(other) - both))
            kept = batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            yield kept

    return map_rows(held.select("a", "b", "left", "right"), run, "a long, b long")


def _possible(pairs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose bitmaps allow the similarity."""
    held = pairs
    for node, side in (("a", "left"), ("b", "right")):
        named = bitmaps.select(
            F.col("node").alias(node),
            F.col("n_shingles").alias(f"{side}_size"),
            F.col("bitmap").alias(side),
        )
        held = held.join(named, node)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for row in batch.to_pylist():
                bits = 8 * min(len(row["left"]), len(row["right"]))
                apart = folded(row["left"], bits) ^ folded(row["right"], bits)
                total = row["left_size"] + row["right_size"]
                keep.append(allows(total, int(np.bitwise_count(apart).sum())))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    columns = ["a", "b", "left", "left_size", "right", "right_size"]
    return map_rows(held.select(*columns), run, "a long, b long")


def allows(total, apart):
    """Whether two sets of ``total`` members together, with at least ``apart`` in one only, may be
    similar: overlap <= (total - apart) / 2, and similar if overlap * (t + 1) >= t * total."""
    return (total - apart) * (LEAST + WHOLE) >= 2 * LEAST * total


def _tiles(rows: DataFrame, bitmaps: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of small tiles and links of large ones, both ``a, b`` of different components.

    ``rows`` holds ``key, node, size, component``. A set is at home in its band of sizes and a guest in
    the one below; each tile pairs its home sets with each other and with guests. A tile with many
    sets is cut: a part of the home sets meets a part of all sets. The pairs are those whose bitmaps
    allow the similarity; the links have been checked, and with them the tile's components are those
    that all its links would give.
    """
    home = rows.withColumn("band", band_of(F.col("size"))).withColumn("home", F.lit(True))
    guest = home.withColumn("band", F.col("band") - 1).withColumn("home", F.lit(False))
    placed = home.unionByName(guest)
    counts = placed.groupBy("key", "band").agg(
        F.count(F.lit(1)).alias("held"),
        F.sum(F.col("size").cast("long") * 8).alias("bytes"),
        F.sum(F.col("home").cast("int")).alias("homes"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
    )
    large = F.col("held") >= LARGE
    parts = F.greatest(F.ceil(F.col("held") / TILE), F.when(large, F.ceil(F.col("bytes") / TILE_BYTES)))
    counts = counts.where("low <> high AND homes > 0").select(
        "key", "band", parts.cast("int").alias("parts"), large.alias("large")
    )
    placed = placed.join(counts, ["key", "band"]).withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    )
    placed = written(rows.sparkSession, placed, "jaccard")
    # Of a whole tile each set has one row: one at home meets all, a guest is only met. Of a cut one
    # a row stands for a set that meets others in each column, one for a set that is met in each row.
    none = F.lit(0)
    whole = placed.where("parts = 1").select(
        "*", none.alias("row"), none.alias("column"), F.when(F.col("home"), MEETS_ALL).otherwise(IS_MET).alias("role")
    )
    cut = placed.where("parts > 1")
    every = F.sequence(none, F.col("parts") - 1)
    first = cut.where("home").select("*", F.explode(every).alias("column"), F.lit(MEETS).alias("role"))
    second = cut.select("*", F.explode(every).alias("row"), F.lit(IS_MET).alias("role"))
    columns = ["key", "band", "row", "column", "role", "node", "size", "component", "large"]
    sided = (
        whole.select(*columns)
        .unionByName(first.withColumn("row", F.col("part")).select(*columns))
        .unionByName(second.withColumn("column", F.col("part")).select(*columns))
    )
    sided = sided.join(bitmaps.select("node", "bitmap"), "node")

    dealt = ["key", "band", "row", "column"]

    def streamed(tiles: DataFrame, work, *also: str) -> DataFrame:
        # Tiles are many and mostly tiny, so they stream by in order; none is a call of its own.
        ordered = tiles.select(*dealt, "role", "node", "size", "component", "bitmap", *also)
        ordered = ordered.repartition(*dealt).sortWithinPartitions(*dealt)
        return map_rows(ordered, lambda batches: _in_order(batches, work), "a long, b long").distinct()

    pairs = streamed(sided.where("NOT large"), _pairs_between)
    huge = placed.where("large")
    if huge.isEmpty():
        return pairs, pairs.limit(0)
    arrays = _arrays(huge.select("node"), bitmaps, texts)
    return pairs, streamed(sided.where("large").join(arrays, "node"), _links_between, "members")


def _in_order(batches: Iterator[pa.RecordBatch], work) -> Iterator[pa.RecordBatch]:
    """``work`` on the tiles that come by in order, given as a table and the starts of its tiles."""
    open_tile = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if open_tile is not None:
            table = pa.concat_tables([open_tile, table])
        change = np.zeros(max(table.num_rows - 1, 0), dtype=bool)
        for name in ("key", "band", "row", "column"):
            values = table.column(name).to_numpy()
            change |= values[1:] != values[:-1]
        starts = [0, *(np.flatnonzero(change) + 1).tolist()]
        open_tile = table.slice(starts[-1])
        if len(starts) > 1:
            yield work(table.slice(0, starts[-1]), starts)
    if open_tile is not None and open_tile.num_rows > 1:
        yield work(open_tile, [0, open_tile.num_rows])


def _overlaps(arrays: list[bytes]) -> np.ndarray:
    """A row of bits for each set, one for every member that two sets or more have."""
    sets = [np.frombuffer(a, np.int64) for a in arrays]
    flat = np.concatenate(sets)
    _, place, counts = np.unique(flat, return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    kept = shared[place]
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[kept]
    columns = number[place[kept]]
    bits = np.zeros((len(sets), int(shared.sum()) // 64 + 1), np.uint64)
    np.bitwise_or.at(bits, (rows, columns >> 6), np.uint64(1) << (columns & 63).astype(np.uint64))
    return bits


def _links_between(table: pa.Table, starts: list[int]) -> pa.RecordBatch:
    """Links of the tiles, each of which joins two components that the links before it left apart."""
    role = table.column("role").to_numpy()
    nodes = table.column("node").to_numpy()
    sizes = table.column("size").to_numpy().astype(np.int64)
    parts = table.column("component").to_numpy().copy()
    found = []
    for start, end in zip(starts, starts[1:]):
        tile = table.slice(start, end - start)
        maps = tile.column("bitmap").to_pylist()
        width = 8 * min(map(len, maps))
        words = np.array([folded(m, width) for m in maps])
        members = None
        others = start + np.flatnonzero(role[start:end] != MEETS)
        for i in (start + np.flatnonzero(role[start:end] != IS_MET)).tolist():
            size = sizes[others]
            fit = parts[others] != parts[i]
            fit &= (WHOLE * size >= LEAST * sizes[i]) & (WHOLE * sizes[i] >= LEAST * size)
            near = others[fit]
            apart = np.bitwise_count(words[near - start] ^ words[i - start]).sum(axis=1)
            near = near[allows(sizes[near] + sizes[i], apart.astype(np.int64))]
            if not len(near):
                continue
            if members is None:
                members = _overlaps(tile.column("members").to_pylist())
            both = np.bitwise_count(members[near - start] & members[i - start]).sum(axis=1)
            both = both.astype(np.int64)
            for other in near[WHOLE * both >= LEAST * (sizes[near] + sizes[i] - both)].tolist():
                if parts[other] != parts[i]:
                    found.append((min(nodes[i], nodes[other]), max(nodes[i], nodes[other])))
                    here = parts[start:end]
                    here[here == parts[other]] = parts[i]
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _pairs_between(table: pa.Table, starts: list[int]) -> pa.RecordBatch:
    role = table.column("role").to_numpy()
    nodes = table.column("node").to_numpy()
    sizes = table.column("size").to_numpy().astype(np.int64)
    parts = table.column("component").to_numpy()
    maps = table.column("bitmap").to_pylist()
    found = []
    for start, end in zip(starts, starts[1:]):
        if end - start < 2:
            continue
        others = start + np.flatnonzero(role[start:end] != MEETS)
        words, bits = None, 0
        for i in (start + np.flatnonzero(role[start:end] != IS_MET)).tolist():
            size = sizes[others]
            fit = (parts[others] != parts[i]) & (nodes[others] != nodes[i])
            fit &= (WHOLE * size >= LEAST * sizes[i]) & (WHOLE * sizes[i] >= LEAST * size)
            near = others[fit]
            if not len(near):
                continue
            if words is None:
                bits = 8 * min(map(len, maps[start:end]))
                words = np.array([folded(m, bits) for m in maps[start:end]])
            apart = np.bitwise_count(words[near - start] ^ words[i - start]).sum(axis=1)
            near = near[allows(sizes[near] + sizes[i], apart.astype(np.int64))]
            low, high = np.minimum(nodes[near], nodes[i]), np.maximum(nodes[near], nodes[i])
            found.append(np.column_stack([low, high]))
    pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _classes(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``id, row, n_shingles, node`` of all rows (``row``: hash of the text), and ``node, component`` of
    the nodes that have a link."""
    spark, kind = df.sparkSession, id_type(df, id_col)
    tidy(spark)
    texts = id_text(df, id_col, text_col).withColumn("row", F.xxhash64("text"))

    hot = spark.sparkContext.broadcast(_frequent(texts))

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = hot.value
        seen: set[int] = set()
        for batch in small_batches(batches):
            sizes, nodes, maps, prefixes = [], [], [], []
            if len(seen) > SEEN:
                seen.clear()
            for text in batch.column(1).to_pylist():
                members = shingle_set(text)
                sizes.append(len(members))
                nodes.append(node_of(members) if len(members) else None)
                first = len(members) > 0 and nodes[-1] not in seen
                maps.append(bitmap(members) if first else None)
                prefixes.append(prefix(members, frequent).tobytes() if first else None)
                seen.add(nodes[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array(maps, pa.binary()),
                    pa.array(prefixes, pa.binary()),
                ],
                ["id", "row", "n_shingles", "node", "bitmap", "prefix"],
            )

    # Prefixes are kept, a fifth of the sets; the few sets that are compared are cut again. A set that
    # several tasks hold is there several times, which every step that reads them takes care of.
    schema = f"id {kind}, row long, n_shingles long, node long, bitmap binary, prefix binary"
    docs = written(spark, map_rows(texts, classes, schema), "jaccard")
    bitmaps = docs.where("bitmap IS NOT NULL").select("node", "row", "n_shingles", "bitmap")
    bitmaps = written(spark, bitmaps.dropDuplicates(["node"]), "jaccard")
    prefixes = docs.where("prefix IS NOT NULL")

    firsts = _prefix_rows(prefixes).groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    firsts = written(spark, firsts.where("first <> last").select("key", "first"), "jaccard")
    # Most keys are of one set: a table of fixed size keeps those at home.
    rows = _prefix_rows(prefixes, wanted_filter(firsts, "key", KEY_BITS))
    shared = rows.join(firsts, "key")
    # Of copies in several tasks one row stays.
    shared = written(spark, shared.distinct(), "jaccard")

    sizes = shared.where("node = first").select("key", F.col("size").alias("first_size")).distinct()
    star = (
        shared.where("node <> first")
        .join(sizes, "key")
        .where(
            (WHOLE * F.least("size", "first_size") >= LEAST * F.greatest("size", "first_size"))
        )
        .select(F.col("first").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    star = written(spark, star, "jaccard")
    links = written(spark, _checked(written(spark, _possible(star, bitmaps), "jaccard"), bitmaps, texts), "jaccard")
    found = components(links)

    placed = shared.select("key", "node", "size").join(found, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    open_keys = (
        placed.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("key")
    )
    placed = written(spark, placed.join(open_keys, "key"), "jaccard")
    pairs, joined = _tiles(placed, bitmaps, texts)
    more = written(spark, pairs.join(star, ["a", "b"], "left_anti"), "jaccard")
    links = links.union(_checked(more, bitmaps, texts)).union(joined)
    return docs.drop("bitmap", "prefix"), components(written(spark, links, "jaccard"))


def join_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, n_shingles, component_id`` per row.

    ``component_id`` is the smallest id among the rows that can be reached by links, the row's own
    included. (Links are not counted: pairs known to be connected are not compared.) A NULL, empty or blank text
    has an empty set and is linked with nothing: its component is its own id. Rows of equal sets are
    linked. Repeated rows and ids are kept; a row with a NULL id gets the smallest id of the others
    of its component, or NULL. Two different shingles or sets with one 64-bit hash count as equal.
    """
    spark = df.sparkSession
    with passing(spark):
        docs, found = _classes(df, id_col, text_col)
        # The smallest id of each class, then of each component of classes.
        least = docs.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("least"))
        named = (
            least.join(found, "node", "left")
            .withColumn("component", F.coalesce("component", "node"))
        )
        lowest = named.groupBy("component").agg(F.min("least").alias("component_id"))
        named = named.join(lowest, "component").select("node", "component_id")
        joined = docs.join(named, "node", "left").select(
            "id",
            "n_shingles",
            F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        return written(spark, joined, "jaccard", keep=True)


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, with all their columns, of which one stays for each component.

    That of the smallest id stays (NULL ids last, then the smaller hash of the text). Rows without a
    word are linked with nothing and all stay; of equal rows with words one stays.
    """
    spark = df.sparkSession
    with passing(spark):
        docs, found = _classes(df, id_col, text_col)
        order = F.struct(F.col("id").isNull(), "id", "row")
        chosen = (
            docs.where("node IS NOT NULL")
            .join(found.select("node", "component"), "node", "left")
            .groupBy(F.coalesce("component", "node").alias("component"))
            .agg(F.min(order).alias("kept"))
        )
        kept = chosen.select(F.col("kept.id").alias("leafmill_id"), F.col("kept.row").alias("leafmill_row"))
        kept = written(spark, kept, "jaccard", keep=True)
    of = free_name(df, "leafmill_of")
    marked = df.withColumn(of, F.xxhash64(F.col(text_col).cast("string")))
    blank = ~F.coalesce(F.col(text_col).cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    same = marked[id_col].eqNullSafe(kept["leafmill_id"]) & (marked[of] == kept["leafmill_row"])
    with_words = marked.where(~blank).join(kept, same, "left_semi").dropDuplicates([id_col, of])
    return with_words.unionByName(marked.where(blank)).drop(of)
