"""Python steps over columns of texts in slices of a few rows, so that a task never holds what a whole Arrow batch makes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rows that are Python objects at a time. Arrow batches have up to 10,000 rows, of whole pages too.
SLICE_ROWS = 64


def sliced(arrays: list[pa.Array], rows: int = SLICE_ROWS) -> Iterator[list[list]]:
    """The values of ``arrays`` as lists, at most ``rows`` of each at a time; empty arrays give one empty slice."""
    for at in range(0, max(1, len(arrays[0])), rows):
        yield [a.slice(at, rows).to_pylist() for a in arrays]


def by_row(one: Callable, made: pa.DataType, kind: str) -> Callable[..., Column]:
    """A function of columns that gives ``one`` of each row's values, null as None. made, kind: the result's type in Arrow and in SQL."""

    def single(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for (values,) in sliced([batch]):
                yield pa.array([one(v) for v in values], made)

    def several(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            for columns in sliced(list(batch)):
                yield pa.array([one(*row) for row in zip(*columns, strict=True)], made)

    def of(*columns: Column | str) -> Column:
        return F.arrow_udf(single if len(columns) == 1 else several, kind)(*columns)

    return of
