"""Column expressions and batch helpers shared by the operators of this package."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Bytes of text that a Python helper handles at once.
BLOCK_BYTES = 1 << 20


def whole_text(name: str) -> Column:
    """The text of a row, empty where it is null."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def is_held_out(name: str) -> Column:
    """Whether a document belongs to the fifth that no model learns from; a null id does."""
    crc = F.crc32(F.col(f"`{name}`").cast("string").cast("binary"))
    return F.coalesce(crc % 5 == 0, F.lit(True))


def spare_name(df: DataFrame, wanted: str) -> str:
    """A column name that the table does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def map_arrow(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], Iterator[dict]],
    schema: str,
) -> DataFrame:
    """Apply ``function`` to each Arrow batch; it yields columns by name."""
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in function(batch):
                arrays = [pa.array(columns[f.name], type=f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def text_blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str | None]]]:
    """Cut a batch into runs of rows of about ``BLOCK_BYTES``; yields the first row and the texts."""
    texts = batch.column(column)
    begin, size = 0, 0
    for row in range(len(texts)):
        size += len(texts[row].as_buffer() or b"") if texts[row].is_valid else 0
        if size >= BLOCK_BYTES:
            yield begin, texts[begin : row + 1].to_pylist()
            begin, size = row + 1, 0
    if begin < len(texts):
        yield begin, texts[begin:].to_pylist()
