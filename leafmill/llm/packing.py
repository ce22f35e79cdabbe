"""Packing token sequences into windows: bounded-space online packing.

Each task keeps a fixed number of open windows. A document's tokens go, in order,

1. as whole windows of their own, as long as a full window of them is left,
2. what remains into the open window with the least room that still holds it (best fit),
3. if none has room, the fullest open window is topped up with the head of the remainder and
   emitted, and the rest starts a new window.

So emitted windows are full. At its end a task folds its open windows together until at most one
is not full. Those leftovers, with their ids, are then merged over tasks in rounds of ``fan_in``
tasks each, so no task ever reads more than ``fan_in`` windows; the last one is padded.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.bpe import CACHE_CHARS, PATTERN, Bpe
from leafmill.llm.common import OUT_ROWS, id_text, id_type, map_rows, small_batches
from leafmill.plans.workdir import written

#: Sequences of a task: task number (or round and group) in the high bits, a counter in the low ones.
TASK_SHIFT = 32
ROUND_SHIFT = 58


class Tokens(Bpe):
    """The vocabulary with the tokenizer library's own merge loop in place of the backtracking."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        ranks = {t: i for i, t in enumerate(self.tokens) if i not in self.special.values()}
        self.plain = tiktoken.Encoding(
            "vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

    def pack_chunk(self, chunk: str) -> bytes:
        packed = self.chunks.recall(chunk)
        if packed is None:
            packed = array("I", self.plain(chunk)).tobytes()
            if len(chunk) <= CACHE_CHARS:
                self.chunks.keep(chunk, packed)
        return packed


@lru_cache(maxsize=4)
def tokens(path: str) -> Tokens:
    """The vocabulary of a file, built once per worker process."""
    return Tokens(path)


class Windows:
    """The open windows of one task. ``emit`` gets each full window's pieces.

    A piece is ``(id, start, packed ids, tokens of the document)``.
    """

    def __init__(self, size: int, keep_open: int, emit) -> None:
        self.size, self.keep_open, self.emit = size, keep_open, emit
        self.room: list[tuple[int, int]] = []  # (room, key), ascending: the fullest comes first
        self.pieces: dict[int, list] = {}
        self.made = 0

    def add(self, doc, start: int, packed: bytes, total: int) -> None:
        size = self.size
        at, left = 0, len(packed) // 4
        while left >= size:
            self.emit([(doc, start + at, packed[4 * at : 4 * (at + size)], total)])
            at, left = at + size, left - size
        while left:
            spot = bisect_left(self.room, (left, -1))
            if spot < len(self.room):  # best fit
                room, key = self.room.pop(spot)
                take = left
            elif len(self.room) < self.keep_open:
                room, key, take = size, self.made, left
                self.pieces[key] = []
                self.made += 1
            else:  # none fits: top up the fullest and emit it
                room, key = self.room.pop(0)
                take = room
            window = self.pieces[key]
            window.append((doc, start + at, packed[4 * at : 4 * (at + take)], total))
            at, left, room = at + take, left - take, room - take
            if room:
                insort(self.room, (room, key))
            else:
                self.emit(self.pieces.pop(key))

    def fold(self) -> list:
        """Merge the open windows; the pieces of the one that stays unfilled, in order."""
        rest = [piece for _, key in self.room for piece in self.pieces.pop(key)]
        self.room, window, room = [], [], self.size
        for doc, start, packed, total in rest:
            at, left = 0, len(packed) // 4
            while left:
                take = min(left, room)
                window.append((doc, start + at, packed[4 * at : 4 * (at + take)], total))
                at, left, room = at + take, left - take, room - take
                if not room:
                    self.emit(window)
                    window, room = [], self.size
        return window


class Pieces:
    """Collects output rows: placed pieces without their ids, leftovers with them."""

    def __init__(self, base: int, kind: pa.DataType) -> None:
        self.base, self.made = base, 0
        self.kind = kind
        self.rows: list[tuple] = []

    def emit(self, window: list) -> None:
        self.put(window, False)

    def put(self, window: list, leftover: bool) -> None:
        number, offset = self.base + self.made, 0
        for doc, start, packed, total in window:
            count = len(packed) // 4
            crc = zlib.crc32(packed)
            held = packed if leftover else None
            self.rows.append((doc, start, count, crc, total, number, offset, held))
            offset += count
        self.made += 1

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[]] * 8
        kinds = [self.kind, *[pa.int64()] * 6, pa.binary()]
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], FIELDS
        )


FIELDS = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "packed"]
RESULT = FIELDS[:-1]


def _schema(kind: str) -> str:
    longs = ", ".join(f"{name} long" for name in FIELDS[1:-1])
    return f"id {kind}, {longs}, packed binary"


def pack_documents(
    df: DataFrame,
    path: str,
    size: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = 0,
    keep_open: int = 32,
    fan_in: int = 64,
) -> DataFrame:
    """Pieces of documents in sequences of ``size`` tokens.

    One row per piece: ``id, start, length, ids_crc32, doc_tokens, sequence_id, offset``. A
    document is its ids with ``end_id`` after them (None: without), so a NULL or empty text is one
    token, or no row without an end id. Each token lies in one piece, each sequence is full but
    one. Repeated rows are packed each; ids may repeat or be NULL. An empty table gives no rows.

    One pass over the texts; the placed pieces are written to the shared folder, because the
    leftovers are read apart from them and must come from the same run of a task.
    """
    kind = id_type(df, id_col)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = tokens(path).pack
        end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
        out, windows = None, None
        for batch in small_batches(batches):
            if out is None:
                out = Pieces(TaskContext.get().partitionId() << TASK_SHIFT, batch.column(0).type)
                windows = Windows(size, keep_open, out.emit)
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                packed = (pack(text) if text else b"") + end
                windows.add(doc, 0, packed, len(packed) // 4)
                if len(out.rows) >= OUT_ROWS:
                    yield out.take()
        if out is not None:
            out.put(windows.fold(), True)
            yield out.take()

    spark = df.sparkSession
    placed = written(
        spark, map_rows(id_text(df, id_col, text_col), place, _schema(kind)), "packing"
    )
    done = [placed.where(F.col("packed").isNull()).select(*RESULT)]
    left = placed.where(F.col("packed").isNotNull())
    groups = (left.agg(F.max(_number())).first()[0] or 0) + 1  # tasks, numbered from 0
    turn = 0
    while groups > 1:
        turn, groups = turn + 1, -(-groups // fan_in)
        merged = _merge(left, turn, size, fan_in, kind)
        merged = written(spark, merged, "packing")
        done.append(merged.where(F.col("packed").isNull()).select(*RESULT))
        left = merged.where(F.col("packed").isNotNull())
    done.append(left.select(*RESULT))
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def _number() -> Column:
    """The task or group that a sequence comes from."""
    return F.shiftright(
        F.col("sequence_id").bitwiseAND(F.lit((1 << ROUND_SHIFT) - 1)), TASK_SHIFT
    )


def _merge(left: DataFrame, turn: int, size: int, fan_in: int, kind: str) -> DataFrame:
    """One round: unfilled windows of ``fan_in`` groups become full windows and one unfilled."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        base = (turn << ROUND_SHIFT) | (key[0].as_py() << TASK_SHIFT)
        out = Pieces(base, table.schema.field("id").type)
        windows = Windows(size, fan_in + 1, out.emit)
        windows.made, windows.room = 1, [(0, 0)]
        windows.pieces[0] = [
            (r["id"], r["start"], r["packed"], r["doc_tokens"]) for r in table.to_pylist()
        ]
        out.put(windows.fold(), True)
        return pa.Table.from_batches([out.take()])

    # Neighbouring numbers form a group, each with one window, so a group is as large as the fan-in.
    grouped = left.withColumn("part", F.floor(_number() / fan_in).cast("long"))
    return grouped.groupBy("part").applyInArrow(
        lambda key, table: merge(key, table.drop(["part"])), _schema(kind)
    )
