"""What the operators on vectors share: rows that take part, Arrow lists as matrices, first rows of packed lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm import common

common.shipped(__name__)

#: A found row: the larger score first, then the smaller id, a null one last.
HIT = "struct<less:{},nameless:boolean,id:long,_f:long,_r:long>"


def usable(vector: Column) -> Column:
    """Neither null nor empty, and every component a finite number."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~odd


def of_one_length(rows: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """The rows whose vector has the most frequent length (of equal ones the longest), and that length; 0 for no rows."""
    sizes = rows.groupBy(F.size(vector).alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    if sizes is None:
        return rows, 0
    return rows.where(F.size(vector) == sizes["n"]), sizes["n"]


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """A list column without nulls as rows of float64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def whole(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """A list column of whole numbers without nulls as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def inner(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed up from the first component to the last."""
    return np.add.accumulate(x * y, axis=1)[:, -1]


def ranked(ids: pa.ChunkedArray, f: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of rows by id, a null one last; ids with 0 for null; which are null."""
    nameless = np.array(ids.is_null().to_pylist(), bool)
    number = ids.fill_null(0).to_numpy()
    return np.lexsort((r, f, number, nameless)), number, nameless


def packed(lists: list[tuple[np.ndarray, np.ndarray]], number: np.ndarray, nameless: np.ndarray, f: np.ndarray, r: np.ndarray, kind: type) -> pa.ListArray:
    """A list of found rows for each pair of positions and scores."""
    ends = np.cumsum([0, *(len(at) for at, _ in lists)]).astype(np.int32)
    at = np.concatenate([x for x, _ in lists]) if lists else np.zeros(0, np.int64)
    score = np.concatenate([x for _, x in lists]) if lists else np.zeros(0, kind)
    ids = pa.array(number[at], mask=nameless[at])
    hits = pa.StructArray.from_arrays([pa.array(-score), pa.array(nameless[at]), ids, pa.array(f[at]), pa.array(r[at])], names=["less", "nameless", "id", "_f", "_r"])
    return pa.ListArray.from_arrays(pa.array(ends), hits)


def first(lists: str, n: int) -> Column:
    """The first `n` of all lists of a group, each row once. The lists are short: `n` of each task at most."""
    return F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list(lists)))), 1, n)
