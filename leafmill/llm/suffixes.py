"""Exact substring dedup with suffix arrays built by linear grouping.

Every ``SIZE`` bytes of a document that also start in a document of smaller id are removed.

1. Anchors: of each ``SIZE``-byte window the ``ANCHOR``-byte pieces with the smallest hash. Equal windows
   have equal anchors at equal places, so only windows that share an anchor can be equal.
2. Anchors of one document only are dropped: anchors move in packed blocks by ranges, two owners of
   each at most; a task compares those of a range and sets the bits of the ones with two owners in a
   table of fixed size, which lets the next passes skip most others.
3. The context of an anchor is what all windows over it can reach. Equal contexts of an anchor are one
   class with the smallest id. How far a class agrees with another one of its anchor on both sides
   bounds the windows that it may share. A suffix array over what is left of the classes, many
   anchors at a time, brings equal windows together and gives each window the smallest id that has
   it over the same anchor. An anchor and what follows it are one symbol: their rank.
4. Each occurrence of a context learns from its class which of its windows to remove; the windows of
   a document are united and cut from its text.

The suffix array is built in two phases. Suffixes are grouped by their first byte. Groups are taken
in descending order; each suffix of a group points to the nearest one before it in a lower group,
and those pointed at move, by how many point at them, into new groups just above their old one. In
the end a group holds the suffixes that begin with one Lyndon word, and a single ascending pass
along the pointers puts the suffixes of all groups in order; no text of names is ever sorted again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import OUT_ROWS, id_text, id_type, map_rows, small_batches, tidy
from leafmill.plans.workdir import written

SIZE = 50
ANCHOR = 30
REACH = SIZE - ANCHOR
WINDOWS = REACH + 1
#: Bits of the table of shared anchors (a power of two), and symbols that one suffix array takes in.
TABLE_BITS = 26
SHARED_BITS = 1 << TABLE_BITS
ARRAY_BYTES = 1 << 15
#: What stands around texts: no byte of UTF-8.
MARK = b"\xff"
#: Bytes of texts that are cut into anchors at once, anchors that a task packs, the text whose anchors
#: one task compares at once, and the contexts that a task puts into classes at once.
CHUNK_BYTES, HELD_KEYS, BUCKET_BYTES, LEAST_BUCKETS, TASK_CONTEXTS = 1 << 17, 1 << 20, 8 << 20, 32, 300_000
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)


def suffix_array(text: bytes | list[int]) -> list[int]:
    """Starts of all suffixes in ascending order (a suffix comes before its continuations)."""
    size = len(text)
    if not size:
        return []
    # Groups are intervals of `order`, named by where they start.
    symbols = np.frombuffer(text, np.uint8) if isinstance(text, bytes) else np.array(text)
    order = np.argsort(symbols, kind="stable").tolist()
    place, group, held = [0] * size, [0] * size, [0] * size
    start = 0
    for i, suffix in enumerate(order):
        if text[suffix] != text[order[start]]:
            start = i
        place[suffix], group[suffix] = i, start
        held[start] += 1
    lower = [-1] * size
    end = size
    while end:
        start = group[order[end - 1]]
        members = order[start:end]
        end = start
        if len(members) > 1:
            members.sort()
        pointed: dict[int, int] = {}
        for suffix in members:
            at = suffix - 1
            while at >= 0 and group[at] >= start:
                at = lower[at]
            lower[suffix] = at
            if at >= 0:
                pointed[at] = pointed.get(at, 0) + 1
        if not pointed:
            continue
        moving: dict[tuple[int, int], list[int]] = {}
        for suffix, times in pointed.items():
            moving.setdefault((-times, group[suffix]), []).append(suffix)
        turns = sorted(moving) if len(moving) > 1 else list(moving)
        for turn in turns:
            leaving, old = moving[turn], turn[1]
            rest = held[old]
            if len(leaving) == rest:
                continue
            for suffix in leaving:  # to the end of the interval
                rest -= 1
                here, there = place[suffix], old + rest
                other = order[there]
                order[here], order[there] = other, suffix
                place[other], place[suffix] = here, there
            held[old], fresh = rest, old + rest
            held[fresh] = len(leaving)
            for suffix in leaving:
                group[suffix] = fresh
    out, free, done = [-1] * size, list(range(size)), bytearray(size)
    for i in range(-1, size):
        at = size - 1 if i < 0 else out[i] - 1
        while at >= 0 and not done[at]:
            start = group[at]
            out[free[start]] = at
            free[start] += 1
            done[at] = 1
            at = lower[at]
    return out


def joined_texts(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts behind each other with ``REACH`` marks around each; where they start and end."""
    gap = MARK * REACH
    sizes = np.array([len(r) for r in raws], np.int64)
    ends = np.cumsum(sizes + REACH)
    return np.frombuffer(gap + gap.join(raws) + gap, np.uint8), ends - sizes, ends


def hashes(data: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of all pieces of 2, 4, 8 and 16 bytes."""
    part = data.astype(np.uint64) + np.uint64(1)
    parts = {}
    for width in (1, 2, 4, 8):  # hashes of twice the width from two neighbours
        part = part[: len(part) - width] * MIX[0] + part[width:] * MIX[1]
        part ^= part >> np.uint64(31)
        parts[2 * width] = part
    return parts


def anchors(
    parts: dict[int, np.ndarray], starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the anchors of the windows of joined texts."""
    inside = ends - starts >= SIZE
    if not inside.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    count = len(parts[2]) + 2 - ANCHOR
    piece, at = parts[16][:count], 16
    for width in (8, 4, 2):  # and the rest of the anchor's bytes
        piece = piece * MIX[1] + parts[width][at : at + count] * MIX[0]
        piece ^= piece >> np.uint64(29)
        at += width
    least = _sliding(piece, np.minimum)
    # Windows that lie in no text have no anchor.
    change = np.zeros(len(least) + 1, np.int8)
    change[starts[inside]] = 1
    change[ends[inside] - SIZE + 1] = -1
    least[np.cumsum(change[:-1], dtype=np.int8) == 0] = 0
    # A piece is chosen if it is the least of some window: the largest of the least ones over it.
    padded = np.concatenate([np.zeros(REACH, np.uint64), least, np.zeros(REACH, np.uint64)])
    at = np.flatnonzero((_sliding(padded, np.maximum) == piece) & (piece > 0))
    return piece[at].view(np.int64), at


def class_numbers(parts: dict[int, np.ndarray], at: np.ndarray) -> np.ndarray:
    """Hashes of the anchors' contexts, with the marks that take the place of what is no text."""
    out, place = parts[16][at - REACH], 16 - REACH
    for width in (16, 16, 16, 4, 2):
        out = out * MIX[1] + parts[width][at + place] * MIX[0]
        out ^= out >> np.uint64(29)
        place += width
    return out.view(np.int64)


def _sliding(values: np.ndarray, pick) -> np.ndarray:
    """``pick`` over each run of ``WINDOWS`` values."""
    width, out = 1, values
    while 2 * width <= WINDOWS:
        out = pick(out[: len(out) - width], out[width:])
        width *= 2
    rest = WINDOWS - width
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


class Sides:
    """What stands before and after the anchors of classes in order of their key.

    ``left`` (read backwards) and ``right`` hold ``REACH`` bytes, marks beyond the context. ``before``
    and ``after`` say on how many of its own bytes a class agrees at most with another of its anchor.
    """

    def __init__(self, key: np.ndarray, lead: np.ndarray, contexts: pa.BinaryArray) -> None:
        count = len(key)
        offsets = np.frombuffer(contexts.buffers()[1], np.int32)[contexts.offset :][: count + 1].astype(np.int64)
        data = np.frombuffer(contexts.buffers()[2], np.uint8)
        steps = np.arange(REACH)
        anchor = offsets[:-1] + lead
        tail = offsets[1:] - anchor - ANCHOR
        self.key, self.lead = key, lead
        self.left = np.where(steps < lead[:, None], data[np.maximum(anchor[:, None] - 1 - steps, 0)], MARK[0])
        last = len(data) - 1
        self.right = np.where(
            steps < tail[:, None], data[np.minimum(anchor[:, None] + ANCHOR + steps, last)], MARK[0]
        )
        self.before = np.minimum(self._most(self.left), lead)
        self.after = np.minimum(self._most(self.right), tail)

    def _most(self, side: np.ndarray) -> np.ndarray:
        order = np.lexsort((*words(side).T[::-1], self.key))
        same = agreement(side[order[1:]], side[order[:-1]])
        same[self.key[order[1:]] != self.key[order[:-1]]] = 0
        out = np.zeros(len(order), np.int64)
        out[order[1:]] = same
        out[order[:-1]] = np.maximum(out[order[:-1]], same)
        return out

    def near(self) -> np.ndarray:
        """Which classes may share a window with another one of their anchor."""
        return self.before + self.after >= REACH

    def take(self, rows: np.ndarray) -> Sides:
        out = object.__new__(Sides)
        for name, values in vars(self).items():
            setattr(out, name, values[rows])
        return out

    @staticmethod
    def joined(parts: list[Sides]) -> Sides:
        out = object.__new__(Sides)
        for name in vars(parts[0]):
            setattr(out, name, np.concatenate([getattr(p, name) for p in parts]))
        return out


def words(side: np.ndarray) -> np.ndarray:
    """Bytes of each row as whole numbers in the same order."""
    wide = np.zeros((len(side), -(-side.shape[1] // 8) * 8), np.uint8)
    wide[:, : side.shape[1]] = side
    return wide.view(">u8").astype(np.uint64)


def agreement(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Equal bytes at the beginning of each row."""
    differ = one != other
    return np.where(differ.any(axis=1), differ.argmax(axis=1), one.shape[1])


def held_before(sides: Sides, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows that one of a smaller owner also has over its anchor: rows and places in the contexts,
    in order.

    All windows hold the anchor. It and the bytes after it are one symbol, the rank of these bytes, so
    the suffixes that begin with one window still follow each other.
    """
    count = len(owners)
    order = np.lexsort(words(sides.right).T[::-1])
    ranked = sides.right[order]
    name = np.zeros(count, np.int64)
    name[order] = 256 + np.cumsum(np.append(True, (ranked[1:] != ranked[:-1]).any(axis=1)))
    sizes = sides.before + 1
    starts = np.cumsum(sizes) - sizes
    # Each class: as many bytes before the anchor as may be shared, and the symbol.
    of = np.repeat(np.arange(count), sizes)
    back = sides.before[of] - (np.arange(len(of)) - starts[of])  # bytes before the anchor from here
    text = np.where(back > 0, sides.left[of, np.maximum(back, 1) - 1], name[of])
    order = np.array(suffix_array(text.tolist()), np.int64)
    order = order[back[order] + sides.after[of[order]] >= REACH]
    row, reach = of[order], back[order]
    equal = (reach[1:] == reach[:-1]) & (agreement(sides.left[row[1:]], sides.left[row[:-1]]) >= reach[1:])
    equal &= agreement(sides.right[row[1:]], sides.right[row[:-1]]) >= REACH - reach[1:]
    run = np.cumsum(np.append(True, ~equal))
    key, owner = sides.key[row], owners[row]
    by = np.lexsort((owner, key, run))
    run, key, owner, row, reach = (x[by] for x in (run, key, owner, row, reach))
    first = np.append(True, (run[1:] != run[:-1]) | (key[1:] != key[:-1]))
    later = owner > owner[first][np.cumsum(first) - 1]
    row, place = row[later], sides.lead[row[later]] - reach[later]
    by = np.lexsort((place, row))
    return row[by], place[by]


def joined_spans(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Spans joined where they overlap or touch, in order."""
    if not len(starts):
        return []
    order = np.argsort(starts)
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.flatnonzero(np.concatenate([[True], starts[1:] > reach[:-1]]))
    last = np.append(first[1:], len(starts)) - 1
    return list(zip(starts[first].tolist(), reach[last].tolist()))


def _bytes_of(text: str | None) -> bytes:
    return (text or "").encode("utf-8")


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The number of the first row of each chunk of texts, and the joined texts."""
    raws, first, held = [], 0, 0
    for row, text in enumerate(batch.column(1).to_pylist()):
        raws.append(_bytes_of(text))
        held += len(raws[-1])
        if held >= CHUNK_BYTES:
            yield first, *joined_texts(raws)
            raws, first, held = [], row + 1, 0
    if raws:
        yield first, *joined_texts(raws)


def _key_blocks(texts: DataFrame, buckets: int) -> DataFrame:
    """Anchors in blocks by their place in the table: ``bucket, keys, owners``.

    Keys are turned, so that their first bits are the place. Of each key a block has two different
    owners at most; an anchor of a row with a NULL id always has two.
    """
    owned = texts.select(F.xxhash64("id").alias("owner"), "text", F.col("id").isNull().alias("lone"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Buckets begin with a word of the table.
        lows = np.array([-(-(b * (SHARED_BITS // 64)) // buckets) for b in range(buckets)], np.uint64)
        lows <<= np.uint64(64 - TABLE_BITS + 6)
        keys: list[np.ndarray] = []
        owners: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            key, owner = np.concatenate(keys).view(np.uint64), np.concatenate(owners)
            keys.clear(), owners.clear()
            key = (key << np.uint64(64 - TABLE_BITS)) | (key >> np.uint64(TABLE_BITS))
            order = np.argsort(key)
            key, owner = key[order], owner[order]
            new = np.append(True, key[1:] != key[:-1])
            start = np.flatnonzero(new)[np.cumsum(new) - 1]
            other = owner != owner[start]
            number = np.cumsum(other)
            keep = new | (other & (number - number[start] == 1))
            key, owner = key[keep], owner[keep]
            cuts = [*np.searchsorted(key, lows).tolist(), len(key)]
            spans = [(b, start, end) for b, (start, end) in enumerate(zip(cuts, cuts[1:])) if start < end]
            columns = [pa.array([s[0] for s in spans], pa.int32())]
            columns += [pa.array([x[a:b].tobytes() for _, a, b in spans], pa.binary()) for x in (key, owner)]
            return pa.RecordBatch.from_arrays(columns, ["bucket", "keys", "owners"])

        held = 0
        for batch in small_batches(batches):
            owner, lone = batch.column(0).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
            for first, data, starts, ends in _chunks(batch):
                key, at = anchors(hashes(data), starts, ends)
                row = first + np.searchsorted(starts, at, "right") - 1
                keys.append(key)
                owners.append(np.where(lone[row], 0, owner[row]))
                held += len(key)
                if lone[row].any():
                    keys.append(key[lone[row]])
                    owners.append(np.ones(len(keys[-1]), np.int64))
                if held >= HELD_KEYS:
                    yield flush()
                    held = 0
        if held:
            yield flush()

    return map_rows(owned, run, "bucket int, keys binary, owners binary")


def _shared_bits(blocks: DataFrame) -> DataFrame:
    """``word, bits`` of the table of the anchors that have two owners."""
    # A bucket at a time.
    ordered = blocks.repartition("bucket").sortWithinPartitions("bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(held: list[tuple]) -> pa.RecordBatch:
            key, owner = (np.concatenate([np.frombuffer(h[c], t) for h in held]) for c, t in ((0, np.uint64), (1, np.int64)))
            order = np.argsort(key)
            key, owner = key[order], owner[order]
            shared = key[1:][(key[1:] == key[:-1]) & (owner[1:] != owner[:-1])]
            place = np.unique(shared >> np.uint64(64 - TABLE_BITS))
            words, start = np.unique(place >> np.uint64(6), return_index=True)
            bits = np.uint64(1) << (place & np.uint64(63))
            bits = np.bitwise_or.reduceat(bits, start) if len(start) else bits
            return pa.RecordBatch.from_arrays(
                [pa.array(words.astype(np.int32)), pa.array(bits.view(np.int64))], ["word", "bits"]
            )

        bucket, held = None, []
        for batch in batches:
            for here, keys, owners in zip(*[c.to_pylist() for c in batch.columns]):
                if here != bucket and held:
                    yield found(held)
                    held = []
                bucket = here
                held.append((keys, owners))
        if held:
            yield found(held)

    return map_rows(ordered, run, "word int, bits long")


def _shared_contexts(batch: pa.RecordBatch, table: np.ndarray) -> Iterator[tuple]:
    """Of the contexts whose anchor may be shared, a chunk at a time: row, key and class, where the
    anchor and the text start and the text ends in the joined texts, and these."""
    for first, data, starts, ends in _chunks(batch):
        parts = hashes(data)
        key, at = anchors(parts, starts, ends)
        bit = key & (SHARED_BITS - 1)
        held = ((table[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1)) > 0
        key, at = key[held], at[held]
        row = np.searchsorted(starts, at, "right") - 1
        yield first + row, key, class_numbers(parts, at), at, starts[row], ends[row], data


def _classes(texts: DataFrame, shared, kind: str) -> DataFrame:
    """``key, class, least, last, lead, context`` of the shared contexts, ordered by key.

    A task sends each class once for ``TASK_CONTEXTS`` contexts, so a passage of very many documents
    costs few rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        held: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            docs = pa.concat_arrays(ids)
            rank = pc.rank(docs, tiebreaker="dense").to_numpy().astype(np.int64)
            holder = np.zeros(len(rank) + 1, np.int64)
            holder[rank] = np.arange(len(rank))
            row, key, number = (np.concatenate([h[c] for h in held]) for c in range(3))
            order = np.argsort(number, kind="stable")
            number, of = number[order], rank[row[order]]
            start = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
            least, last = (holder[pick.reduceat(of, start)] for pick in (np.minimum, np.maximum))
            # In the order of the texts: each chunk gives the contexts of the classes it is first to have.
            by = np.argsort(order[start])
            chosen, least, last = order[start][by], least[by], last[by]
            bounds = np.searchsorted(chosen, np.cumsum([0, *[len(h[0]) for h in held]]))
            passed = 0
            for (_, key, number, at, data), a, b in zip(held, bounds, bounds[1:]):
                if a < b:
                    mine = chosen[a:b] - passed
                    windows = np.lib.stride_tricks.sliding_window_view(data, SIZE + REACH)[at[mine] - REACH]
                    text = windows != MARK[0]
                    offsets = np.append(0, np.cumsum(text.sum(axis=1))).astype(np.int32)
                    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(windows[text])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(number[mine]),
                            pa.array(key[mine]),
                            docs.take(pa.array(least[a:b])),
                            docs.take(pa.array(last[a:b])),
                            pa.array(text[:, :REACH].sum(axis=1).astype(np.int32)),
                            pa.Array.from_buffers(pa.binary(), b - a, buffers),
                        ],
                        ["class", "key", "least", "last", "lead", "context"],
                    )
                passed += len(key)
            ids.clear(), held.clear()

        count = docs_before = 0
        for batch in small_batches(batches):
            ids.append(batch.column(0))
            for row, key, number, at, _, _, data in _shared_contexts(batch, shared.value):
                if len(row):
                    held.append((docs_before + row, key, number, at, data))
                    # Texts with few contexts are held as well.
                    count += max(len(row), len(data) // 100)
            docs_before += batch.num_rows
            if count >= TASK_CONTEXTS:
                yield from flush()
                count = docs_before = 0
        if count:
            yield from flush()

    schema = f"class long, key long, least {kind}, last {kind}, lead int, context binary"
    # Dealt by key, so the aggregation by key and class needs no further exchange.
    sent = map_rows(texts, run, schema).repartition("key")
    merged = sent.groupBy("key", "class").agg(
        F.min("least").alias("least"),
        F.max("last").alias("last"),
        F.first("lead").alias("lead"),
        F.first("context").alias("context"),
    )
    return merged.sortWithinPartitions("key", "class")


def _occurrences(texts: DataFrame, shared, kind: str) -> DataFrame:
    """``class, id, row, start, end`` of the shared contexts. ``start`` is ``REACH`` bytes before the
    anchor, also where that is before the text; the end lies in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            for row, _, number, at, first, last, _ in _shared_contexts(batch, shared.value):
                start, end = at - REACH - first, np.minimum(at + SIZE, last) - first
                rows = pa.array(row)
                columns = [pa.array(number), batch.column(0).take(rows), batch.column(2).take(rows)]
                columns += [pa.array(c.astype(np.int32)) for c in (start, end)]
                out = pa.RecordBatch.from_arrays(columns, ["class", "id", "row", "start", "end"])
                for k in range(0, len(row), OUT_ROWS):
                    yield out.slice(k, OUT_ROWS)

    return map_rows(texts, run, f"class long, id {kind}, row long, start int, end int")


def _judged(classes: DataFrame, kind: str) -> DataFrame:
    """``class, least, last, removed``: places in the context of windows that a smaller id holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ["class", "least", "last", "removed"]
        todo: list[tuple[pa.RecordBatch, Sides]] = []
        held = 0

        def emit(rows: list[pa.RecordBatch], of: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
            table = pa.Table.from_batches(rows).combine_chunks()
            columns = [table.column(f).combine_chunks() for f in fields[:3]]
            offsets = np.searchsorted(of, np.arange(table.num_rows + 1)).astype(np.int32)
            removed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(places.astype(np.int32)))
            return pa.RecordBatch.from_arrays([*columns, removed], fields)

        def arrays() -> pa.RecordBatch:
            rows = [batch for batch, _ in todo]
            least = pa.concat_arrays([batch.column("least") for batch in rows])
            owners = pc.rank(least, tiebreaker="dense").to_numpy().astype(np.int64)
            return emit(rows, *held_before(Sides.joined([sides for _, sides in todo]), owners))

        for batch in _whole_anchors(batches):
            sides = Sides(
                batch.column("key").to_numpy(), batch.column("lead").to_numpy().astype(np.int64), batch.column("context")
            )
            close = sides.near()
            far = batch.filter(pa.array(~close))
            if far.num_rows:
                yield emit([far], *[np.zeros(0, np.int32)] * 2)
            # The classes of an anchor stay together.
            batch, sides = batch.filter(pa.array(close)), sides.take(close)
            if not batch.num_rows:
                continue
            sizes = np.cumsum(sides.before + 1)
            key = sides.key
            ends = [*(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), batch.num_rows]
            start = done = 0
            for end in ends:
                if held + int(sizes[end - 1]) - done >= ARRAY_BYTES:
                    todo.append((batch.slice(start, end - start), sides.take(np.arange(start, end))))
                    yield arrays()
                    todo.clear()
                    start, done, held = end, int(sizes[end - 1]), 0
            if start < batch.num_rows:
                todo.append((batch.slice(start), sides.take(np.arange(start, batch.num_rows))))
                held += int(sizes[-1]) - done
        if todo:
            yield arrays()

    schema = f"class long, least {kind}, last {kind}, removed array<int>"
    return map_rows(classes, run, schema)


def _whole_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of their key, cut so that no key is in two batches."""
    waiting: list[pa.RecordBatch] = []

    def joined() -> pa.RecordBatch:
        return pa.concat_batches(waiting)

    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        last = int(np.searchsorted(key, key[-1]))  # where the last key starts
        if last:
            waiting.append(batch.slice(0, last))
        if waiting and (last or waiting[0].column("key")[0].as_py() != key[0]):
            yield joined()
            waiting.clear()
        waiting.append(batch.slice(last))
    if waiting:
        yield joined()


def _spans(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the spans of all rows in flat arrays, and where those of each row end."""
    of = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).fill_null(0).to_numpy())
    start, end, removed = lists.flatten().flatten()
    start, end = start.to_numpy().astype(np.int64), end.to_numpy().astype(np.int64)
    count = pc.list_value_length(removed).fill_null(0).to_numpy()
    whole = removed.is_null().to_numpy(zero_copy_only=False)
    single = np.repeat(start, count) + removed.flatten().to_numpy()
    # Places in a context count from where the text begins.
    single += np.repeat(np.maximum(-start, 0), count)
    of = np.concatenate([of[whole], np.repeat(of, count)])
    order = np.argsort(of, kind="stable")
    starts = np.concatenate([np.maximum(start[whole], 0), single])[order]
    ends = np.concatenate([end[whole], single + SIZE])[order]
    return starts, ends, np.searchsorted(of[order], np.arange(len(lists)), "right")


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept, kept_sha256`` per row; ``kept`` is binary.

    Texts are UTF-8 bytes, NULL is empty. A row with a NULL id comes after all others and loses what
    any of them has, but takes nothing from another. Rows of one id are one document to the others:
    no byte is removed because of the own id, and repeated rows get equal results.
    """
    spark, kind = df.sparkSession, id_type(df, id_col)
    tidy(spark)
    texts = id_text(df, id_col, text_col).withColumn("row", F.xxhash64("text"))
    named, lone = texts.where("id IS NOT NULL"), texts.where("id IS NULL")
    nameless = not lone.isEmpty()
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(min(max(LEAST_BUCKETS, -(-size // BUCKET_BYTES)), SHARED_BITS // 64))
    bits = _shared_bits(_key_blocks(texts, buckets)).toArrow()
    table = np.zeros(SHARED_BITS // 64, dtype=np.uint64)
    table[bits.column("word").to_numpy()] = bits.column("bits").to_numpy().view(np.uint64)
    broadcast = spark.sparkContext.broadcast(table)

    judged = _judged(_classes(named, broadcast, kind), kind)
    if not nameless:
        judged = judged.where("least < last OR size(removed) > 0")
    judged = written(spark, judged, "suffixes")

    found = _occurrences(texts, broadcast, kind)
    later = F.col("id").isNull() | (F.col("id") > F.col("least"))
    spans = (
        found.join(judged, "class")
        .where(later | (F.size("removed") > 0))
        # Without places, the whole context goes.
        .select("id", "row", F.struct("start", "end", F.when(~later, F.col("removed")).alias("removed")).alias("span"))
        .groupBy("id", "row")
        .agg(F.collect_list("span").alias("spans"))
    )
    spans = written(spark, spans, "suffixes").withColumnsRenamed({"id": "of_id", "row": "of_row"})
    joined = texts.join(
        spans, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("row") == F.col("of_row")), "left"
    ).select("id", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sizes, removed, counts, kept = [], [], [], []
            starts, ends, cuts = _spans(batch.column(2))
            for text, a, b in zip(batch.column(1).to_pylist(), [0, *cuts[:-1].tolist()], cuts.tolist()):
                raw = _bytes_of(text)
                runs = joined_spans(starts[a:b], ends[a:b])
                at, parts = 0, []
                for start, end in runs:
                    parts.append(raw[at:start])
                    at = end
                left = b"".join([*parts, raw[at:]])
                sizes.append(len(raw))
                removed.append(len(raw) - len(left))
                counts.append(len(runs))
                kept.append(left)
            digests = [hashlib.sha256(k).hexdigest() for k in kept]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *[pa.array(c, pa.int64()) for c in (sizes, removed, counts)],
                    pa.array(kept, pa.binary()),
                    pa.array(digests, pa.string()),
                ],
                ["id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
            )

    schema = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    return map_rows(joined, cut, schema)
