"""Helpers shared by the training-text operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The characters that end a word, `[\x20\x09-\x0D]`.
WORD_SPACE = " \t\n\x0b\x0c\r"

#: Batches of rows after which a task gives back what it has freed.
RELEASE_EVERY = 4

_DDL = {
    pa.int32(): "int",
    pa.int64(): "bigint",
    pa.float64(): "double",
    pa.bool_(): "boolean",
    pa.string(): "string",
    pa.binary(): "binary",
}


def words(text: str | None) -> list[bytes]:
    """The words `[^\\x20\\x09-\\x0D]+` of a text as UTF-8; none for null.

    ``bytes.split`` splits on exactly those six ASCII characters, unlike ``str.split``.
    """
    return (text or "").encode().split()


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of an id as text, modulo ``parts``; NULL for a NULL id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(column.cast("string")), F.lit(parts))


def ddl(schema: pa.Schema) -> str:
    """The schema as Spark DDL."""

    def kind(t: pa.DataType) -> str:
        if pa.types.is_list(t):
            return f"array<{kind(t.value_type)}>"
        if pa.types.is_struct(t):
            return "struct<" + ",".join(f"{t[i].name}:{kind(t[i].type)}" for i in range(t.num_fields)) + ">"
        return _DDL[t]

    return ", ".join(f"`{field.name}` {kind(field.type)}" for field in schema)


def release_memory() -> None:
    """Give memory that was freed back to the system. A Python worker outlives its task; without
    this it holds the most that any earlier stage took, beside the heap of its executor. In a task,
    freed arrays lie between those still in use and are not given back either."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def map_columns(
    df: DataFrame,
    make: Callable[[], Callable[[dict[str, list]], dict[str, Iterable]]],
    schema: pa.Schema,
    done: Callable[[], None] | None = None,
) -> DataFrame:
    """Map Arrow batches as column lists. ``make`` is called once in each task, ``done`` at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for k, batch in enumerate(batches):
            if k and not k % RELEASE_EVERY:
                release_memory()
            made = step(batch.to_pydict())
            yield pa.RecordBatch.from_arrays(
                [pa.array(made[field.name], type=field.type) for field in schema], schema=schema
            )
        step = batch = made = None
        if done is not None:
            done()
        release_memory()

    return df.mapInArrow(run, ddl(schema))


def filter_rows(
    df: DataFrame, column: str, make: Callable[[], Callable[[list], Iterable[bool]]]
) -> DataFrame:
    """Keep the rows for which the verdict on ``column`` is true, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verdict = make()
        for k, batch in enumerate(batches):
            if k and not k % RELEASE_EVERY:
                release_memory()
            keep = verdict(batch.column(batch.schema.get_field_index(column)).to_pylist())
            yield batch.filter(pa.array(keep, type=pa.bool_()))
        verdict = batch = keep = None
        release_memory()

    return df.mapInArrow(run, df.schema)


def mix64(values: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: a bijection of unsigned 64-bit integers that spreads all bits."""
    v = values.astype(np.uint64)
    v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))
