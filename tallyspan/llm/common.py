"""What the text operators share: folds, batches and kernels over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows of one Arrow batch; with texts of 100,000 characters a batch stays near 50 MB.
BATCH_ROWS = 512


def text_batches(spark: SparkSession) -> None:
    """Small Arrow batches, so that a worker never holds thousands of long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def fold(key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo 5: the shared train and held-out split."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(5))


def map_texts(
    df: DataFrame, kernel: Callable[[list[str | None]], dict[str, list]], schema: str, keep: list[str], text: str = "text", kind: str = "string"
) -> DataFrame:
    """Apply ``kernel`` to each batch of texts; its columns stand beside ``keep``.

    ``kernel`` gets a list of texts (None for null) and returns one list per
    new column, of the same length. It runs once per Arrow batch. ``kind`` is
    the type that ``text`` is cast to first.
    """
    text_batches(df.sparkSession)
    source = df.select(*keep, F.col(text).cast(kind).alias("__text"))
    types = [f.dataType.simpleString() for f in StructType.fromDDL(schema).fields]
    out = source.select(*keep).schema.simpleString()[len("struct<") : -1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = kernel(b.column(len(keep)).to_pylist())
            cols = [b.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                cols + [x if isinstance(x, pa.Array) else pa.array(x, _arrow(t)) for x, t in zip(made.values(), types, strict=True)],
                names=[*keep, *made],
            )

    return source.mapInArrow(run, f"{out}, {schema}")


def filter_texts(df: DataFrame, keep: Callable[[list[str | None]], list[bool]], text: str = "text") -> DataFrame:
    """The rows of ``df`` for which ``keep`` says True; whole rows pass through the batch, nothing is shuffled."""
    text_batches(df.sparkSession)
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(keep(b.column(at).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def _arrow(name: str) -> pa.DataType:
    plain = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    if name.startswith("array<"):
        return pa.list_(_arrow(name[6:-1]))
    if name.startswith("struct<"):
        parts, depth, start, body = [], 0, 0, name[7:-1]
        for i, c in enumerate(body + ","):
            depth += (c == "<") - (c == ">")
            if c == "," and not depth:
                parts.append(body[start:i].split(":", 1))
                start = i + 1
        return pa.struct([(k, _arrow(v)) for k, v in parts])
    return plain[name]
