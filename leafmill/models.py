"""Plug-in models: the only places where rows leave the JVM.

A model is given as a factory, a picklable function without arguments that returns a function from
a list of inputs to a list of outputs. The factory runs once per task, on the executor. Rows pass in
Arrow batches. Retries are bounded; a row that still fails keeps its message in ``error`` and does
not stop the others.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

Model = Callable[[], Callable[[list], list]]

# Tries and the pause between them, in seconds.
TRIES = 3
PAUSE = 5.0
#: Rows that fail one after another until a task stops calling the model row by row.
GIVE_UP = 10
#: Bytes of input that one call gets, unless a single row is larger.
CALL_BYTES = 32 << 20


class _Caller:
    """Calls of one task's model: whole lists first, halves of a failed one, then single rows."""

    def __init__(self, call, kind: pa.DataType, tries: int, pause: float, give_up: int) -> None:
        self.call, self.kind, self.give_up = call, kind, give_up
        self.tries, self.pause = max(tries, 1), pause
        self.failed_in_a_row = 0

    def _outputs(self, items: list, tries: int) -> list:
        for attempt in range(tries):
            try:
                outputs = list(self.call(items))
                if len(outputs) != len(items):
                    raise ValueError("the model returned a different number of outputs")
                return outputs
            except Exception:  # a model may raise anything
                if attempt + 1 == tries:
                    raise
                time.sleep(self.pause)
        return []

    def _typed(self, value: Any) -> tuple[Any, str | None]:
        """The value as the output type can hold it, or why it cannot."""
        try:
            return pa.array([value], self.kind)[0].as_py(), None
        except Exception as problem:
            return None, f"{type(problem).__name__}: {problem}"

    def results(self, items: list, first: bool = True) -> list[tuple[Any, str | None]]:
        if not items:
            return []
        down = self.failed_in_a_row >= self.give_up
        if down and not first:
            return [(None, f"gave up after {self.give_up} failures in a row")] * len(items)
        # Only a whole batch and a single row are tried again: the halves between them are many.
        again = (first or len(items) == 1) and not down
        try:
            outputs = self._outputs(items, self.tries if again else 1)
        except Exception as problem:
            if len(items) == 1:
                self.failed_in_a_row += 1
                return [(None, f"{type(problem).__name__}: {problem}")]
            half = len(items) // 2
            return self.results(items[:half], False) + self.results(items[half:], False)
        self.failed_in_a_row = 0
        return [self._typed(value) for value in outputs]


def _call_slices(batch: pa.RecordBatch, at: int, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose inputs together hold ``most`` bytes at most, or single rows."""
    column = batch.column(at)
    if not (pa.types.is_string(column.type) or pa.types.is_binary(column.type)):
        yield batch
        return
    start, held = 0, 0
    for i, size in enumerate(pc.binary_length(column).fill_null(0).to_pylist()):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def apply_model(
    df: DataFrame,
    column: str,
    output: str,
    model: Model,
    tries: int = TRIES,
    pause: float = PAUSE,
    give_up: int = GIVE_UP,
    call_bytes: int = CALL_BYTES,
) -> DataFrame:
    """Replace ``column`` by ``value`` (of type ``output``) and ``error``. NULL input gives NULL.

    A whole batch (of at most ``call_bytes`` bytes) is offered to the model up to ``tries`` times;
    if that fails its halves are, down to single rows, which are tried again too. After ``give_up``
    rows that fail one after another the other rows of a batch get an error without a call, and each
    later batch is offered once, so a service that is down ends a task soon. An output that is not of
    the type is an error of its row. The other columns pass through unread.
    """
    rest = [f for f in df.schema.fields if f.name != column]
    kind = T._parse_datatype_string(output)
    schema = T.StructType(
        [*rest, T.StructField("value", kind), T.StructField("error", T.StringType())]
    )
    arrow_kind = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caller = _Caller(model(), arrow_kind, tries, pause, give_up)
        for whole in batches:
            at = whole.schema.get_field_index(column)
            for batch in _call_slices(whole, at, call_bytes):
                given = batch.column(at).to_pylist()
                present = [i for i, x in enumerate(given) if x is not None]
                results: list[tuple[Any, str | None]] = [(None, None)] * len(given)
                for i, answer in zip(present, caller.results([given[i] for i in present])):
                    results[i] = answer
                columns = [c for i, c in enumerate(batch.columns) if i != at]
                names = [n for i, n in enumerate(batch.schema.names) if i != at]
                values = pa.array([v for v, _ in results], arrow_kind)
                errors = pa.array([e for _, e in results], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*columns, values, errors], [*names, "value", "error"]
                )

    return df.mapInArrow(run, schema)


def count_tokens(df: DataFrame, text: str, tokenizer: Model) -> DataFrame:
    """Exact token counts by a given tokenizer, as ``tokens``; 0 for NULL and for failures."""
    done = apply_model(df, text, "int", tokenizer, tries=1)
    return done.withColumn("tokens", F.coalesce("value", F.lit(0))).drop("value", "error")


def embed(df: DataFrame, text: str, embedder: Model, **retry: Any) -> DataFrame:
    """Embeddings by a given model: ``value array<float>`` and ``error`` in place of ``text``."""
    return apply_model(df, text, "array<float>", embedder, **retry)


def extract(df: DataFrame, content: str, extractor: Model, **retry: Any) -> DataFrame:
    """Text of binary content by a given extractor: ``value`` and ``error`` in place of it."""
    return apply_model(df, content, "struct<text:string,pages:array<string>>", extractor, **retry)
