"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that separate words, as a character class for both Java and Python.
SPACE = r"[\x20\x09-\x0D]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text; null gives none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that the texts of one hold at most ``most`` bytes, or one row."""
    for batch in batches:
        at, total = 0, 0
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for i, size in enumerate(sizes):
            if i > at and total + size > most:
                yield batch.slice(at, i - at)
                at, total = i, 0
            total += size
        if sizes:
            yield batch.slice(at)
