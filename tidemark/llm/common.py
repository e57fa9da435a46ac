"""Small helpers that several operators of this subpackage use."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship

#: Rows in one Arrow batch of whole texts; bounds a Python worker's memory.
TEXT_BATCH_ROWS = 1000

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z alone, independent of locale and of other alphabets."""
    return F.translate(column, ASCII_UPPER, ASCII_LOWER)


def fold(column: Column | str, folds: int) -> Column:
    """crc32 of the value as text, modulo ``folds``; null for null."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(column.cast("string").cast("binary")) % F.lit(folds)


def bounded_batches(df: DataFrame) -> DataFrame:
    """Limit the session's Arrow batches, since each may hold whole long texts; workers get the package."""
    ship(df.sparkSession)
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > TEXT_BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH_ROWS))
    return df


def map_texts(
    df: DataFrame,
    keep: Iterable[str],
    text: str,
    schema: str,
    rows: Callable[[list[bytes | None]], list[pa.Array]],
) -> DataFrame:
    """Run ``rows`` over Arrow batches of UTF-8 texts, with the ``keep`` columns carried along.

    ``schema`` names the kept columns first, then what ``rows`` returns, in order.
    """
    keep = list(keep)
    source = bounded_batches(df).select(*keep, F.col(text).cast("binary").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = rows(batch.column(batch.num_columns - 1).to_pylist())
                columns = [batch.column(i) for i in range(len(keep))] + made
                yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = source.select(*keep).schema
    names = [f.name for f in fields] + [part.strip().split(" ")[0] for part in schema.split(",")]
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
    return source.mapInArrow(run, ", ".join([*kept, schema]))
