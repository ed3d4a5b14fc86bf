"""Helpers that the corpus operators share: scratch tables, words and Arrow batches."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import shared_folder

#: One word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def stash(df: DataFrame, name: str, large: bool = True) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; the folder goes when the driver ends.

    The plan that follows starts from files all executors can reach, so a lost executor costs
    a re-read and not the recomputation of everything before. After a ``large`` shuffle its files are released.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    if large:
        release(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Have the driver collect its garbage, upon which Spark deletes shuffle files no plan needs any more.

    A finished command's plan is held until Spark's listeners have heard of its end, hence the pauses and
    the second round. ``spark.omicspark.release`` set to false leaves it out, where disk is ample and tables are small.
    """
    if spark.conf.get("spark.omicspark.release", "true") == "false":
        return
    for _ in range(2):
        gc.collect()
        time.sleep(0.3)
        spark.sparkContext._jvm.System.gc()


def unused(df: DataFrame, *names: str) -> tuple[str, ...]:
    """``names``, each with as many underscores before it as no column of ``df`` has that name in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return tuple(out)


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it was; null counts as empty.

    All-ASCII texts (as many bytes as characters) take the quick built-in.
    """
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def word_count(text: Column) -> Column:
    """Number of words of ``text`` as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def map_batches(df: DataFrame, rows: Callable[[list, list], Iterator[tuple]], schema: str, columns: tuple[str, str] = ("doc_id", "text"), most: int | None = None) -> DataFrame:
    """Apply ``rows(ids, texts)``, which yields tuples of ``schema``, to Arrow batches of two columns; ``most`` tuples are held at a time, or those of a batch."""
    target = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = iter(rows(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            while out := list(islice(made, most)):
                columns_out = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns_out, target, strict=True)], names=target.names
                )

    return df.select(*columns).mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))
