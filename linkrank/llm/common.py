"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_AT_ONCE = 128  # rows of a batch that a task turns into output at a time
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(key: Column | str) -> Column:
    """0 to 3 from the CRC-32 of the id as text; a null id counts as an empty one."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 4


def held_out(key: Column | str) -> Column:
    """Whether a row is kept away from learning."""
    return fold(key) == 2


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def pieces(batch: pa.RecordBatch, rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """A batch in slices, so that what is derived from it never exists as a whole."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def free_name(taken: list[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column has that name."""
    lower = {name.lower() for name in taken}
    while wanted.lower() in lower:
        wanted += "_"
    return wanted


BLOCK = 256  # values of an array that are added up at a time


def running(values: str, kind: str, plus: str = "{a} + {v}", zero: str = "0") -> str:
    """SQL for the running totals of an array expression, in time linear in its length.

    Appending to an array copies it, so totals are made per block of values, and for the blocks.
    ``kind`` is the type of the values, ``plus`` combines a total ``{a}`` with a value ``{v}``.
    """

    def totals(array: str, start: str) -> str:
        new = plus.format(a="s.at", v="v")
        return (
            f"aggregate({array}, named_struct('at', {start}, 'all', CAST(array() AS array<{kind}>)),"
            f" (s, v) -> named_struct('at', {new}, 'all', array_append(s.all, {new})), s -> s.all)"
        )

    zero = f"CAST({zero} AS {kind})"
    blocks = (
        f"transform(IF(size(xs) = 0, CAST(array() AS array<int>), sequence(0, (size(xs) - 1) DIV {BLOCK})),"
        f" k -> slice(xs, k * {BLOCK} + 1, {BLOCK}))"
    )
    whole = f"aggregate(b, {zero}, (a, v) -> {plus.format(a='a', v='v')})"
    inner = totals("get(bs, k)", f"IF(k = 0, {zero}, get(ends, k - 1))")
    return (
        f"get(transform(array({values}), xs -> get(transform(array({blocks}), bs ->"
        f" get(transform(array({totals(f'transform(bs, b -> {whole})', zero)}), ends ->"
        f" flatten(transform(bs, (b, k) -> {inner}))), 0)), 0)), 0)"
    )
