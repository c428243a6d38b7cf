"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newslens.session import written

WHITE_SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, survives lost executors."""
    return written(df, f"llm-{label}")


def free(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that ``df`` does not use, whatever extra columns it has."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def columns_of(df: DataFrame) -> list[Column]:
    """All columns by exact name, also names with dots."""
    return [F.col(f"`{c}`") for c in df.columns]


def tie_order(df: DataFrame) -> list[Column]:
    """doc_id first (null last), then all other columns that have an order."""
    rest = [F.col(f"`{c}`") for c, kind in df.dtypes
            if c != "doc_id" and "map<" not in kind and "variant" not in kind]
    return [F.asc_nulls_last("doc_id"), *rest]


def as_bytes(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column in UTF-8; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def by_group(batches: Iterable[pa.RecordBatch], keys: list[str], most: int) -> Iterator[pa.Table]:
    """Cut batches that are sorted by ``keys`` into tables of whole groups.

    A table has about ``most`` rows, more only where one group has more.
    """
    held: list[pa.RecordBatch] = []
    rows = 0

    def last_cut(table: pa.Table) -> int:
        """Where the last group begins."""
        n = table.num_rows
        last = [table.column(k)[n - 1] for k in keys]
        low, high = 0, n - 1
        while low < high:  # the last group is a run at the end: find its first row
            mid = (low + high) // 2
            if [table.column(k)[mid] for k in keys] == last:
                high = mid
            else:
                low = mid + 1
        return low

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < most:
            continue
        whole = pa.Table.from_batches(held)
        cut = last_cut(whole)
        if cut:
            yield whole.slice(0, cut)
        rest = whole.slice(cut).combine_chunks()
        held, rows = rest.to_batches(), rest.num_rows
    if rows:
        yield pa.Table.from_batches(held)


def batch_of(names: list[str], columns: list, types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


Build = Callable[[SparkSession, str], DataFrame]
