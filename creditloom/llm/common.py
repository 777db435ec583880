"""What the corpus operators share: stages in the shared folder, and Arrow functions over texts."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from creditloom.session import checkpoint_folder

#: Words of the corpus contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
find_words = re.compile(WORD).findall

#: Bytes of text that one call of an Arrow function gets at once (a longer text comes alone).
SLICE_BYTES = 1 << 20
#: Bytes of one Arrow batch on its way to an Arrow function and back (a longer row comes alone), whatever the rows are long: the
#: JVM and the worker hold whole batches, and a worker keeps for later tasks what it once took.
BATCH_BYTES, _BATCH_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bits of a filter of keys: a fuller one lets more through, never fewer.
FILTER_BITS = 1 << 24


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read again: cuts the lineage, survives lost executors.

    The shuffle files of the write are dropped when it is done: what follows reads the stage only.
    """
    spark, setting = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path, before = stage_path(spark, name), spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(setting, before)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: int, budget: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with at most ``budget`` bytes of text, one row at least."""
    sizes, start, total = batch.column(column), 0, 0
    lengths = pc.fill_null(pc.binary_length(sizes), 0).to_pylist()
    for i, n in enumerate(lengths):
        if i > start and total + n > budget:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield batch.slice(start)


def map_texts(df: DataFrame, keep: list[str], text: str, fn: Callable[[list], list], fields: str, at_once: int = SLICE_BYTES) -> DataFrame:
    """The columns ``keep`` and those ``fields`` that ``fn`` makes of the texts.

    ``fn`` gets a list of texts (None where null) of at most ``at_once`` bytes, or one longer text, and returns one Arrow array
    per field. Only ``keep`` and ``text`` are read and sent, by place: their names may be any. Batches are limited by Spark's own setting, which
    is read when the result is computed: it is set for the session, unless the session has a value of its own.
    """
    if df.sparkSession.conf.get(_BATCH_SETTING, None) is None:
        df.sparkSession.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    width = len(keep)
    given = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").cast("string").alias("text"))
    names = [f"c{i}" for i in range(width)] + [f"f{i}" for i in range(len(StructType.fromDDL(fields)))]
    kinds = [f.dataType for f in given.schema][:width] + [f.dataType for f in StructType.fromDDL(fields)]

    def run(batches):
        for batch in batches:
            for part in slices(batch, width, at_once):
                made = fn(part.column(width).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(width)] + made, names=names)
        pa.default_memory_pool().release_unused()  # the worker waits for other tasks, of other stages too

    schema = StructType([StructField(n, k) for n, k in zip(names, kinds)])
    return given.mapInArrow(run, schema).toDF(*keep, *StructType.fromDDL(fields).names)


def bit_filter(keys: DataFrame) -> bytes:
    """One bit for each value that the only column of ``keys`` takes modulo ``FILTER_BITS``: of a fixed size, however many there are."""
    place = F.expr(f"(`{keys.columns[0]}` & {FILTER_BITS - 1}L) + 1")  # bitmap buckets count from 1
    found = keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in found:
        start = (r["bucket"] - 1) * 4096
        bits[start:start + 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return bits.tobytes()


def in_filter(bits: bytes, keys: np.ndarray) -> np.ndarray:
    """Which keys the filter may hold: all that it was made of, and some others."""
    place = keys & (FILTER_BITS - 1)
    return np.frombuffer(bits, np.uint8)[place >> 3] >> (place & 7).astype(np.uint8) & 1 > 0


def plain_names(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns named by place, and the new name of each: helper columns then clash with none."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def keep_texts(docs: DataFrame, text: str, fn: Callable[[list], list[bool]]) -> DataFrame:
    """The rows of ``docs`` whose text ``fn`` accepts."""
    given, names = plain_names(docs)
    marked = map_texts(given, given.columns, names[text], lambda texts: [pa.array(fn(texts), pa.bool_())], "good boolean")
    return marked.where("good").drop("good").toDF(*docs.columns)


def remainder(column: str, n: int):
    """crc32 of a column's text form, modulo ``n``: deals rows to folds alike in every engine."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def with_row_key(docs: DataFrame, *columns: str) -> DataFrame:
    """``docs`` with ``_k1`` and ``_k2``, 96 bits that tell rows with other values in ``columns`` apart; null is a value."""
    flags = [F.col(c).isNull() for c in columns]
    return docs.withColumns({"_k1": F.xxhash64(*columns, *flags), "_k2": F.hash(*columns, *flags)})
