"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import work_path

# Rows of one Arrow batch. Documents may be long, so a worker holds few of them at a time.
BATCH_ROWS = "256"
# Tables of known size are written in files of about so many rows.
FILE_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(df: DataFrame, each: Callable[..., tuple | None], schema: str) -> DataFrame:
    """``each(*row)`` for every row, inside Arrow batches; None gives no row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            rows = [r for r in map(each, *columns) if r is not None]
            yield to_batch(rows, arrow_schema)

    arrow_schema = arrow_of(df.sparkSession, schema)
    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_batches(df: DataFrame, each: Callable[..., list[tuple]], schema: str) -> DataFrame:
    """Rows that ``each`` makes of the columns, as lists, of every Arrow batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield to_batch(each(*(c.to_pylist() for c in batch.columns)), arrow_schema)

    arrow_schema = arrow_of(df.sparkSession, schema)
    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def arrow_of(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def small_batches(spark: SparkSession) -> None:
    """Bound the rows per Arrow batch; only sizes depend on it, never a result."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage, survives lost executors.

    With ``rows``, about their number, a small table of many partitions becomes few files."""
    if rows is not None:
        df = df.coalesce(1 + rows // FILE_ROWS)
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def hash_sample(df: DataFrame, rows: int, by: list[str]) -> DataFrame:
    """At most ``rows`` rows, those with the least hash of some columns.

    Rows are first thinned by their hash to about twice as many, so that what meets in the
    last task does not grow with the number of tasks.
    """
    total = df.count()
    kept = min(1.0, (2 * rows + 100) / max(1, total))
    place = F.pmod(F.xxhash64(*by), F.lit(1 << 40))
    return df.where(place < int(kept * (1 << 40))).orderBy(place, *by).limit(rows)


def bucket_of(column: Column, n: int) -> Column:
    """crc32 of a column's text, modulo n; null counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % n
