"""What the training-data operators share: scratch tables, batches of whole texts as numpy arrays, and fixed-size sketches.

Texts reach Python in Arrow batches. A batch is one byte buffer with offsets, so words are found and hashed for all its
documents at once. Sketches have a number of counters that is chosen from the input's size up to 2**MOST_BITS: each task
adds up its own rows, and what tasks send is merged by counter range, streaming.
"""

from __future__ import annotations

import ctypes
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mossgrid.functions.common import kept, scratch  # noqa: F401

BATCH_ROWS = 256
BATCH_BYTES = 1 << 18
ARROW_BYTES = 1 << 22
LEAST_BITS = 16
MOST_BITS = 24
CHUNK_BITS = 16

_ASCII = np.arange(256, dtype=np.uint8)
LOWER = np.where((_ASCII >= 65) & (_ASCII <= 90), _ASCII + 32, _ASCII).astype(np.uint8)
#: Words of `[^\x20\x09-\x0D]+`: in UTF-8 these separators are single bytes.
NOT_SPACE = ~((_ASCII == 32) | ((_ASCII >= 9) & (_ASCII <= 13)))

U64 = np.uint64


def prepare(spark: SparkSession) -> None:
    """Keeps Arrow batches small, in rows and in bytes: long texts must not meet in one batch. The session keeps these settings, since plans run later."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (the finalizer of splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def random_words(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit words."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U64) + U64(seed) * U64(1 << 32)) * U64(0x9E3779B97F4A7C15))


_BYTE_WORDS = random_words(256, 1)
_BASE = U64(0x9E3779B97F4A7C15)
_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))
_POWERS: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            run = np.full(size, base, U64)
            run[0] = 1
            _POWERS[k] = np.multiply.accumulate(run)
    return _POWERS[0], _POWERS[1]


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A text column as bytes and offsets; null is empty."""
    flat = column.fill_null("") if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column.fill_null(b"")
    flat = flat.cast(pa.large_string()) if pa.types.is_string(flat.type) else flat.cast(pa.large_binary()) if pa.types.is_binary(flat.type) else flat
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
    data = np.frombuffer(flat.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if flat.buffers()[2] is not None and len(flat) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def release() -> None:
    """Gives memory that a task has freed back to the system: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def pieces(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about BATCH_BYTES of text at most; a longer text stands alone."""
    release()
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = buffer(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + BATCH_BYTES, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end
    release()


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run of word bytes; a run ends with its row."""
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    mask = is_word[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = False, mask[:-1]
    after[-1], after[:-1] = False, mask[1:]
    firsts = offsets[:-1]
    before[firsts[firsts < n]] = False
    lasts = offsets[1:][np.diff(offsets) > 0] - 1
    after[lasts] = False
    starts, ends = np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def slices(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, offsets, first row) of a batch: whole, or where it is one long text in parts of BATCH_BYTES that end between words. A part is longer only by one word."""
    if len(offsets) != 2 or len(data) <= BATCH_BYTES:
        yield data, offsets, 0
        return
    start = 0
    while start < len(data):
        end = min(start + BATCH_BYTES, len(data))
        gaps = np.flatnonzero(~is_word[data[start:end]]) if end < len(data) else ()
        if len(gaps):
            end = start + int(gaps[-1]) + 1
        while end < len(data) and not len(gaps):  # one word so far
            gaps = np.flatnonzero(~is_word[data[end : end + BATCH_BYTES]])
            end = end + int(gaps[0]) + 1 if len(gaps) else min(end + BATCH_BYTES, len(data))
        yield data[start:end], np.array([0, end - start], np.int64), 0
        start = end


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, from one running polynomial sum over the buffer."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE_WORDS[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


# Sketches


def sketch_bits(items: int, per_counter: int = 32) -> int:
    """Counters (as a power of two) that get so many items each, within LEAST_BITS and MOST_BITS (64 MB of counters in a task)."""
    return min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, items / per_counter)))))


class Counts:
    """Counters that a task adds hashed items to."""

    def __init__(self, bits: int) -> None:
        self.bits = bits
        self.total = np.zeros(1 << bits, np.uint32)

    def add(self, hashes: np.ndarray) -> None:
        np.add.at(self.total, (hashes >> U64(64 - self.bits)).astype(np.int64), np.uint32(1))

    def chunks(self) -> Iterator[tuple[int, bytes]]:
        for k in range(1 << (self.bits - CHUNK_BITS)):
            part = self.total[k << CHUNK_BITS : (k + 1) << CHUNK_BITS]
            if part.any():
                yield k, zlib.compress(part.tobytes(), 1)


def merged_counts(chunks: DataFrame, bits: int) -> np.ndarray:
    """The sum of the tasks' counters: rows (chunk, counts) are added up chunk by chunk as they stream past. 2**bits counters come to the driver, whatever the input."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(counts), np.uint32)
                sums[k] = sums[k] + part if k in sums else part.astype(np.uint64)
        for k, part in sums.items():
            yield pa.record_batch({"chunk": pa.array([k], pa.int32()), "counts": pa.array([zlib.compress(np.minimum(part, 0xFFFFFFFF).astype(np.uint32).tobytes(), 1)], pa.binary())})

    total = np.zeros(1 << bits, np.uint32)
    for row in chunks.select("chunk", "counts").repartition(16, "chunk").mapInArrow(add, "chunk int, counts binary").collect():
        total[row.chunk << CHUNK_BITS : (row.chunk + 1) << CHUNK_BITS] = np.frombuffer(zlib.decompress(row.counts), np.uint32)
    return total


def id_filter(ids: DataFrame) -> Callable:
    """A Column function that holds for every id in ids and for few others: 16 bits an id up to 2**MOST_BITS, broadcast. Use it before an exact join."""
    spark, name = ids.sparkSession, ids.columns[0]
    bits = sketch_bits(16 * ids.count(), 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Counts(bits)
        for batch in batches:
            sketch.add(mix(batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64).view(U64)))
        for k, counts in sketch.chunks():
            yield pa.record_batch({"chunk": pa.array([k], pa.int32()), "counts": pa.array([counts], pa.binary())})

    marks = np.packbits(merged_counts(ids.select(name).mapInArrow(count, "chunk int, counts binary"), bits) > 0)
    there = spark.sparkContext.broadcast(marks)

    @F.arrow_udf("boolean")
    def listed(x: pa.Array) -> pa.Array:
        at = (mix(x.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U64)) >> U64(64 - bits)).astype(np.int64)
        return pa.array((there.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1, pa.bool_())

    return listed


# Connected components


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over links, for every node of a link.

    Alternates large-star and small-star steps (each a grouping by node that keeps the smallest neighbour) and ends when
    every edge leads from a node of one edge to a root. Every step is a scratch table.
    """
    edges = kept(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = kept(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"), "large")
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        edges = kept(small, "small")
        ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
        if not ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where("up > 1 or up > 0 and down > 0").agg(F.count("*")).first()[0]:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
