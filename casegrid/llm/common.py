"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegrid.session import ensure_checkpoint_dir

#: White space of all word rules here: U+0020 and U+0009 to U+000D, which is
#: also what ``bytes.split()`` and ``bytes.strip()`` take without an argument.
WHITE_SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage: a later stage reads the written rows, also after an
    executor was lost. The folder is the one of ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame) -> DataFrame:
    """All columns of ``df`` in one struct ``row``, so that no name can clash with a result's."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def with_results(df: DataFrame, inputs: list[str], fields: str,
                 fn: Callable[..., list[pa.Array]]) -> DataFrame:
    """``row`` (all columns of ``df``) and the columns that ``fn`` makes from ``inputs``, by Arrow batch."""
    rows = packed(df)
    places = [df.columns.index(c) for c in inputs]
    names = ["row", *T.StructType.fromDDL(fields).names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0)
            yield pa.RecordBatch.from_arrays([row, *fn(*[row.field(i) for i in places])], names=names)

    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL(fields).fields])
    return rows.mapInArrow(run, schema)


#: Texts that exist as Python objects at a time, besides those in the batch.
TEXTS_AT_ONCE = 256


def as_bytes(texts: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    binary = texts.cast(pa.binary())
    for i in range(0, len(binary), TEXTS_AT_ONCE):
        for x in binary.slice(i, TEXTS_AT_ONCE).to_pylist():
            yield b"" if x is None else x


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, whatever the optimiser merges."""
    return F.transform(F.array(value), body)[0]


def doc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
