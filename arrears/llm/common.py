"""Helpers shared by the text operators: byte views of Arrow text, word runs and 64-bit hashes in numpy.

Texts stay UTF-8 bytes from the Parquet page to the hash; no Python object is
made per word. All hashes are unsigned 64-bit numbers that wrap around.
"""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrears.session import materialize

#: bytes of text that one numpy pass works on; a longer single text is worked on alone
CHUNK_BYTES = 1 << 20
MAX_DOCS = 60_000
_ODD = 0x9E3779B97F4A7C15

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE_VALUE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every output bit depends on every input bit."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = (np.multiply.accumulate(up), np.multiply.accumulate(down))
        if size <= 4 * CHUNK_BYTES:
            _POWERS[base] = have
    return have


class RangeHash:
    """Hash of any byte range of one buffer in constant time (polynomial prefix sums modulo 2**64)."""

    def __init__(self, data: np.ndarray, base: int = _ODD):
        up, self.down = _powers(len(data) + 1, base)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUE[data] * up[: len(data)], out=self.prefix[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.down[start] + np.asarray(end - start).astype(np.uint64))

    def every(self, length: int) -> np.ndarray:
        """Hash of the ``length`` bytes from each position."""
        n = len(self.prefix) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.prefix[length:] - self.prefix[:n]) * self.down[:n])


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def chunks(offsets: np.ndarray, max_bytes: int = CHUNK_BYTES):
    """Ranges [i, j) of whole texts of at most ``max_bytes`` together, or one longer text alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), n, i + MAX_DOCS)
        yield i, j
        i = j


def text_chunks(column, max_bytes: int = CHUNK_BYTES):
    """(i, j, bytes, offsets) for consecutive ranges of the texts of a column."""
    data, off = text_buffer(column)
    for i, j in chunks(off, max_bytes):
        yield i, j, data[off[i]: off[j]], off[i: j + 1] - off[i]


def word_runs(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` and the number of words before each text."""
    solid = ~SPACE[data]
    if not len(solid):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = off[:-1][off[:-1] < len(data)]
    first[inner] = solid[inner]
    tail = off[1:][off[1:] > 0] - 1
    last[tail] = solid[tail]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, off)


def word_counts(column) -> np.ndarray:
    """Words of each text of an Arrow column."""
    out = [np.diff(word_runs(data, off)[2]) for _, _, data, off in text_chunks(column)]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def small_batches(batches, rows: int = 1024, max_bytes: int = 4 * CHUNK_BYTES):
    """The same rows in smaller Arrow batches, so that what a batch turns into stays small too; a larger row is alone.

    What the input held is given back to the system at the end of the partition:
    a worker lives on through later stages.
    """
    for b in batches:
        sizes = np.zeros(b.num_rows, np.int64)
        for column in b.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
                sizes += np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
        upto = np.append(0, np.cumsum(sizes))
        i = 0
        while i < b.num_rows:
            j = int(np.searchsorted(upto, upto[i] + max_bytes, side="right")) - 1
            j = min(max(j, i + 1), i + rows, b.num_rows)
            yield b.slice(i, j - i)
            i = j
    release_memory()


def release_memory() -> None:
    """Hand freed memory of the Arrow pool and of the C heap back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def ranked(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with pos (place in its group from 0, by ``order``, nulls first) and n (rows of the group).

    One range-partitioned sort, written; a place is the row's number in its
    partition plus the group's rows in the partitions before. Equal rows are
    told apart by their place in the input, so no value can hold up one task.
    ``group`` columns are not null.
    """
    keys = [*group, *order, "_tie"]
    sort = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    sort = materialize(sort.drop("_tie").withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)), name)
    parts = sort.groupBy(*group, "_part").agg(F.min("_at").alias("_from"), F.count("*").alias("_rows"))
    ahead = Window.partitionBy(*group).orderBy("_part")
    parts = parts.withColumn("_ahead", F.sum("_rows").over(ahead) - F.col("_rows")).withColumn("n", F.sum("_rows").over(Window.partitionBy(*group)))
    place = parts.select(*group, "_part", (F.col("_ahead") - F.col("_from")).alias("_shift"), "n")
    return sort.join(materialize(place, f"{name}-parts"), [*group, "_part"]).withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, as SQL over its characters (null text: null)."""
    chars = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    byte = "lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda r, k: xor(r >> 1, (r & 1) * 3988292384))"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {chars}), {byte}))"
