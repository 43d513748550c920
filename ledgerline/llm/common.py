"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ledgerline.session import ensure_checkpoint_dir, ship_package

#: Bytes of text that one vectorised step works on; a longer single text is a step of its own.
STEP_BYTES = 1 << 20

#: Word separators of every operator here: blank and the control characters TAB to CR.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True

_MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; the path is only ever opened by Spark's readers."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which driver and executors share."""
    import uuid

    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Spark then deletes the shuffle files of a query when it ends; the stored rows do not need them any more.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, partition_by: str | None = None, compression: str = "snappy") -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        writer = df.write.option("compression", compression)
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def smallest_hashes(df: DataFrame, columns: list[str], limit: int) -> DataFrame:
    """``limit`` rows with the smallest hash of ``columns``; tasks send the driver about twice ``limit`` rows in all, not each."""
    size = df.count()
    place = F.pmod(F.xxhash64(*columns), F.lit(1 << 40))
    if size > 4 * limit:
        df = df.where(place < int((1 << 40) * (2.0 * limit + 1000) / size))
    return df.orderBy(place, *columns).limit(limit)


def fold(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % modulus


def steps(
    batches: Iterator[pa.RecordBatch], text_index: int, limit: int = STEP_BYTES, max_rows: int = 4096
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Split Arrow batches into steps of about ``limit`` text bytes and at most ``max_rows`` rows.

    Yields ``(rows, data, offsets)``: the rows of the step, their texts' UTF-8
    bytes one after the other, and where each text begins (one offset more than rows).
    Null texts count as empty.
    """
    for batch in batches:
        text = batch.column(text_index)
        if text.null_count:
            text = text.fill_null("")
        wide = pa.types.is_large_string(text.type)
        buffers = text.buffers()
        n = len(text)
        if not n:
            continue
        offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)[text.offset : text.offset + n + 1].astype(np.int64)
        data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
        at = 0
        while at < n:
            end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            end = min(max(end, at + 1), at + max_rows, n)
            yield batch.slice(at, end - at), data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
            at = end


#: Bytes of an Arrow batch between Spark and a Python worker: rows here are whole texts, of which the default of 10000 rows can be very large.
BATCH_BYTES = "4m"


def map_arrow(df: DataFrame, run: Callable, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` in batches of bounded size, whose workers can import this package."""
    ship_package(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(run, schema)


def annotated(docs: DataFrame, text: str, added: T.StructType, make: Callable[[], Callable], max_rows: int = 4096) -> DataFrame:
    """``docs`` with the columns ``added``; columns of the same names are replaced.

    ``make()`` runs once a task and returns ``step(rows, data, offsets)``, which
    gives the new columns of one step (see ``steps``) as Arrow arrays.
    """
    base = docs.drop(*[name for name in added.names if name != text])
    schema = T.StructType([f for f in base.schema.fields if f.name not in added.names] + added.fields)
    kept = [name for name in base.columns if name not in added.names]
    types = [to_arrow_type(f.dataType) for f in added.fields]

    def run(batches):
        step = make()
        index = base_columns.index(text)
        for rows, data, offsets in steps(batches, index, max_rows=max_rows):
            new = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=t) for c, t in zip(step(rows, data, offsets), types)]
            yield pa.RecordBatch.from_arrays([rows.column(base_columns.index(c)) for c in kept] + new, names=schema.names)

    base_columns = list(base.columns)
    return map_arrow(base, run, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64, elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int = BASE) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below ``n``."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, STEP_BYTES + 1024)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * STEP_BYTES:
            _POWERS[base] = have
    return have[:n]


class RollingHash:
    """Position-independent 64-bit hashes of any substring of a byte array, from one prefix sum."""

    def __init__(self, data: np.ndarray):
        self.prefix = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[data] * powers(len(data)), out=self.prefix[1:])
        self.unpower = powers(len(data) + 1, UNBASE)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.prefix[ends] - self.prefix[starts]) * self.unpower[starts]
        return mix(raw ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))

    def windows(self, k: int) -> np.ndarray:
        """Hash of every window of ``k`` bytes, the same as ``of`` gives."""
        n = len(self.prefix) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.prefix[k:] - self.prefix[:n]) * self.unpower[:n] ^ np.uint64(k * 0xD6E8FEB86659FD93 & _MASK))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and of the two-byte letters U+00C0 to U+00DE."""
    out = _LOWER[data]
    second = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)) + 1
    out[second] += 32
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and the text each word is in."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = inside[firsts]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    lasts = firsts[1:] - 1
    closes[lasts] = inside[lasts]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(closes) + 1
    owner = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, owner
