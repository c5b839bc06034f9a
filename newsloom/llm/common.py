"""What the training-data operators share: tables, word classes, stored stages."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.store import shared_dir, stored  # noqa: F401

#: The white space of every contract: space and \t \n \v \f \r.
WHITE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"
#: Stored tables of narrow rows (ids, hashes) are broadcast up to this number of rows, beyond it they are joined.
BROADCAST_ROWS = 1_000_000
BATCH_ROWS = 1000
#: Texts that a task works on at once, in bytes (a single longer text is one slice).
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Arrow batches of whole texts: so many rows, so that neither side holds many megabytes off the heap."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def bounded(narrow: DataFrame) -> DataFrame:
    """A stored table of narrow rows, to be broadcast if its counted size allows it."""
    return F.broadcast(narrow) if narrow.count() <= BROADCAST_ROWS else narrow


def fresh(df: DataFrame, name: str) -> str:
    """The name, lengthened until df has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(column: str | Column = "text") -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c, F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z only, as the contracts ask; other letters keep their case."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def flat_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in one array, and how many each text has (null text: none)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(texts)
    words = lists.values
    parents = pc.list_parent_indices(lists)
    some = pc.greater(pc.binary_length(words), 0)
    words, parents = words.filter(some), parents.filter(some)
    counts = np.bincount(parents.to_numpy(), minlength=len(texts)).astype(np.int64)
    return words, counts


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts hold about ``most`` bytes at most (one row at least)."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    a = 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + most, side="right")))
        yield batch.slice(a, b - a)
        a = b


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions starts[i] .. starts[i] + counts[i], one run after another."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) - np.repeat(ends - counts, counts) + np.repeat(starts, counts)
