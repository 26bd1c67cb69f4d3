"""Canonical k-mer codes of whole Arrow batches: two bits a base, rolled over all sequences of a batch at once.

A code orders like its text (A, C, G, T), so the canonical code is that of the smaller of a k-mer and its reverse
complement. Long sequences are read in slices that overlap by k - 1 bases, so memory follows the slice, not the sequence.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_K = 31
SLICE = 1 << 18
#: Bases that are read at once where nothing needs more: their codes stay in the processor's cache.
NEAR_SLICE = 1 << 16
#: Bases of a minimizer, and the k-mers that are sent together at most.
MINIMIZER = 9
MOST_RUN = 200
#: Rows and bytes of an Arrow batch of sequences.
BATCH_ROWS = 1 << 11
BATCH_BYTES = 1 << 22

_CODE = np.full(256, 4, np.uint8)
_CODE[np.frombuffer(b"ACGTacgt", np.uint8)] = [0, 1, 2, 3, 0, 1, 2, 3]
_LETTER = np.frombuffer(b"ACGT", np.uint8)


def sequence_slices(column: pa.Array, k: int, most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, offsets, first row) of about `most` bases (else SLICE); a longer sequence comes in overlapping parts. Null is empty."""
    most = most or SLICE
    flat = column.cast(pa.large_string()).fill_null("")
    if not len(flat):
        return
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    data = np.frombuffer(flat.buffers()[2], np.uint8) if flat.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(flat):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        low, high = int(offsets[row]), int(offsets[end])
        if end > row + 1 or high - low <= most:
            yield data[low:high], offsets[row : end + 1] - low, row
        else:
            for at in range(low, max(low + 1, high - k + 1), most):
                part = data[at : min(at + most + k - 1, high)]
                yield part, np.array([0, len(part)], np.int64), row
        row = end


def _canonical(base: np.ndarray, k: int) -> np.ndarray:
    """The canonical code at every place, whatever its letters; NEAR_SLICE places at a time."""
    n = len(base) - k + 1
    if n <= NEAR_SLICE:
        return _near_canonical(base, k)
    out = np.empty(n, np.uint64)
    for at in range(0, n, NEAR_SLICE):
        out[at : at + NEAR_SLICE] = _near_canonical(base[at : at + NEAR_SLICE + k - 1], k)
    return out


def _near_canonical(base: np.ndarray, k: int) -> np.ndarray:
    n = len(base) - k + 1
    forward, backward = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    # Codes of 1, 2, 4, ... bases; those that make up k are chained.
    ahead, behind = (base & 3).astype(np.uint64), (3 - (base & 3)).astype(np.uint64)
    size, done = 1, 0
    while size <= k:
        if k & size:
            forward = (forward << np.uint64(2 * size)) | ahead[done : done + n]
            backward |= behind[done : done + n] << np.uint64(2 * done)
            done += size
        if 2 * size <= k:
            ahead, behind = (ahead[:-size] << np.uint64(2 * size)) | ahead[size:], behind[:-size] | (behind[size:] << np.uint64(2 * size))
        size *= 2
    return np.minimum(forward, backward)


def _sound(base: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(whether a k-mer of ACGT within its row starts there, row) of every place."""
    n = len(base) - k + 1
    bad = np.concatenate(([0], np.cumsum(base > 3)))
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    return (bad[k:] == bad[:-k]) & (offsets[1:][rows] - np.arange(n) >= k), rows


def canonical_codes(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, rows) of all k-mers of ACGT in either case; places with another letter are left out."""
    if len(data) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    base = _CODE[data]
    sound, rows = _sound(base, offsets, k)
    return _canonical(base, k)[sound], rows[sound]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def kmer_runs(data: np.ndarray, offsets: np.ndarray, k: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, row, k-mers, bytes of bases, all bases) of the stretches of neighbouring k-mers in one bucket, by bucket.

    The least hash of its canonical m-mers (its minimizer) chooses a k-mer's bucket, so neighbours mostly share it, and every
    occurrence of the k-mer, or of its reverse complement, is in the same one. Bases are packed by four.
    """
    if len(data) < k:
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.zeros(0, np.uint8)
    base = _CODE[data]
    m = min(k, MINIMIZER)
    n, width, size = len(data) - k + 1, k - m + 1, 1
    least = _mixed(_canonical(base, m) + np.uint64(1))
    while 2 * size <= width:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    bucket = (np.minimum(least[:n], least[width - size : width - size + n]) % np.uint64(buckets)).astype(np.int64)
    sound, rows = _sound(base, offsets, k)
    same = np.concatenate(([False], sound[1:] & sound[:-1] & (bucket[1:] == bucket[:-1]) & (rows[1:] == rows[:-1])))
    start = np.flatnonzero(sound & ~same)
    count = np.flatnonzero(sound & ~np.concatenate((same[1:], [False]))) - start + 1
    parts = -(-count // MOST_RUN)
    if (parts > 1).any():
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start, count = np.repeat(start, parts) + MOST_RUN * nth, np.minimum(np.repeat(count, parts) - MOST_RUN * nth, MOST_RUN)
    order = np.argsort(bucket[start], kind="stable")
    start, count = start[order], count[order]
    letters = np.concatenate((base & 3, np.zeros(3, np.uint8)))
    four = (letters[:-3] << 6) | (letters[1:-2] << 4) | (letters[2:-1] << 2) | letters[3:]
    held = (count + k + 2) // 4
    inside = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
    return bucket[start], rows[start], count, held, four[np.repeat(start, held) + 4 * inside]


def run_codes(counts: np.ndarray, bases: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, run) of the k-mers of stretches as kmer_runs() packs them."""
    size = counts.astype(np.int64) + k - 1
    held = (size + 3) // 4
    letters = ((bases[:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3).ravel()
    inside = np.arange(len(letters)) - np.repeat(4 * (np.cumsum(held) - held), 4 * held)
    letters = letters[inside < np.repeat(size, 4 * held)]
    if len(letters) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sound, runs = _sound(letters, np.concatenate(([0], np.cumsum(size))), k)
    return _canonical(letters, k)[sound], runs[sound]


def _different(first: np.ndarray, then: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs in order, as words of 64 bits; then is below 2^bits."""
    first, then = first.astype(np.uint64), then.astype(np.uint64)
    if not len(first):
        return first, then
    if bits + int(first.max()).bit_length() <= 64:
        both = (first << np.uint64(bits)) | then
        both.sort()
        both = both[np.concatenate(([True], both[1:] != both[:-1]))]
        return both >> np.uint64(bits), both & np.uint64((1 << bits) - 1)
    order = np.lexsort((then, first))
    a, b = first[order], then[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    return a[new], b[new]


def distinct_pairs(codes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs of (code, row), by row and code; codes are of 2 k bits, rows count from 0."""
    rows, codes = _different(rows, codes, 2 * k)
    return codes, rows.astype(np.int64)


def code_text(codes: np.ndarray, k: int) -> np.ndarray:
    """Codes as ASCII, a row of k bytes each."""
    shifts = np.arange(2 * (k - 1), -1, -2, dtype=np.uint64)
    return _LETTER[((codes[:, None] >> shifts) & np.uint64(3)).astype(np.uint8)]


@cache
def canonical_index(k: int) -> tuple[tuple[str, ...], np.ndarray]:
    """Canonical k-mers in name order, and for every code the place of its canonical one; for small k."""
    codes = np.arange(1 << 2 * k, dtype=np.uint64)
    other = np.zeros_like(codes)
    for j in range(k):
        other |= (np.uint64(3) - ((codes >> np.uint64(2 * j)) & np.uint64(3))) << np.uint64(2 * (k - 1 - j))
    least = np.minimum(codes, other)
    names, place = np.unique(least, return_inverse=True)
    return tuple(bytes(x).decode() for x in code_text(names, k)), place


# MD5 (RFC 1321) of many short texts of one length at once; the sine table is by its rule.
_SINES = np.floor(np.abs(np.sin(np.arange(1, 65))) * (1 << 32)).astype(np.uint32)
_TURNS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))


def md5_prefix(texts: np.ndarray) -> np.ndarray:
    """The first 60 bits of the MD5 of every row of bytes (55 at most), as whole numbers: what the first 15 hex digits say."""
    count, width = texts.shape
    block = np.zeros((count, 56), np.uint8)
    block[:, :width] = texts
    block[:, width] = 0x80
    return _md5(list(np.ascontiguousarray(block.view("<u4").T[: width // 4 + 1])), width)


@cache
def _code_words(letters: int, end: bool) -> np.ndarray:
    """The word that up to four letters make, by their code; at the end of a text the byte 0x80 follows."""
    block = np.zeros((1 << 2 * letters, 4), np.uint8)
    block[:, :letters] = code_text(np.arange(1 << 2 * letters, dtype=np.uint64), letters)
    if end:
        block[:, letters] = 0x80
    return block.view("<u4")[:, 0].copy()


def code_md5(codes: np.ndarray, k: int) -> np.ndarray:
    """md5_prefix() of the texts of codes, by words of four letters."""
    words = [_code_words(4, False)[((codes >> np.uint64(2 * (k - at - 4))) & np.uint64(0xFF)).astype(np.intp)] for at in range(0, k - 3, 4)]
    rest = k % 4
    words.append(_code_words(rest, True)[(codes & np.uint64((1 << 2 * rest) - 1)).astype(np.intp)])
    return _md5(words, k)


def _md5(words: list[np.ndarray], width: int) -> np.ndarray:
    """The first 60 bits for texts of that many bytes; words: those up to the one with the byte 0x80. Every step works in place."""
    start = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
    a, b, c, d = (np.full(len(words[0]), x, np.uint32) for x in start)
    mixed = np.empty_like(a)
    for step in range(64):
        kind = step // 16
        if kind == 0:
            np.bitwise_xor(c, d, out=mixed)
            mixed &= b
            mixed ^= d
            word = step
        elif kind == 1:
            np.bitwise_xor(b, c, out=mixed)
            mixed &= d
            mixed ^= c
            word = (5 * step + 1) % 16
        elif kind == 2:
            np.bitwise_xor(b, c, out=mixed)
            mixed ^= d
            word = (3 * step + 5) % 16
        else:
            np.invert(d, out=mixed)
            mixed |= b
            mixed ^= c
            word = 7 * step % 16
        a += mixed
        a += np.uint32((int(_SINES[step]) + (8 * width if word == 14 else 0)) & 0xFFFFFFFF)
        if word < len(words):
            a += words[word]
        turn = _TURNS[kind][step % 4]
        np.left_shift(a, np.uint32(turn), out=mixed)
        a >>= np.uint32(32 - turn)
        a |= mixed
        a += b
        a, d, c, b = d, c, b, a
    first, second = (a + start[0]).byteswap().astype(np.uint64), (b + start[1]).byteswap().astype(np.uint64)
    return ((first << np.uint64(32)) | second) >> np.uint64(4)


def small_batches(df: DataFrame) -> DataFrame:
    """Keeps Arrow batches small in rows and bytes, so that memory doesn't follow the lengths of sequences. The session keeps the settings, since plans run later."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def spread(df: DataFrame) -> DataFrame:
    """Sequences that few tasks would read, as from a file of one row group, dealt out over the cores; others stay where they are. Counting the tasks reads no sequence."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    used = df.select(F.spark_partition_id().alias("task")).distinct().count()
    return df if 2 * used >= cores else df.repartition(cores)


def sampled_hashes(contigs: DataFrame, k: int, scale: int, key: str = "genome") -> DataFrame:
    """(key, hash): hashes of canonical k-mers that are multiples of scale, sampled before a row leaves the scan; a long or repeated sequence may give one twice."""
    if not 1 <= k <= MOST_K:
        raise ValueError(f"k must be 1 to {MOST_K}")

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, offsets, first in sequence_slices(batch.column(1), k, NEAR_SLICE):
                codes, rows = canonical_codes(data, offsets, k)
                for start in range(0, len(codes), 1 << 14):  # stays in the processor's cache
                    hashes = code_md5(codes[start : start + (1 << 14)], k)
                    hit = np.flatnonzero(hashes % np.uint64(scale) == 0)
                    if len(hit):
                        yield pa.record_batch({key: batch.column(0).take(pa.array(rows[start + hit] + first)), "hash": pa.array(hashes[hit].astype(np.int64))})

    kind = contigs.schema[key].dataType.simpleString()
    return small_batches(spread(contigs.select(key, "seq"))).mapInArrow(sample, f"`{key}` {kind}, hash long")


def counted_codes(contigs: DataFrame, k: int, key: str) -> DataFrame:
    """(key, code, n): the canonical k-mers of every row's sequence as codes, with their number; rows of one key, and slices of a long sequence, may repeat them."""
    if not 1 <= k <= MOST_K:
        raise ValueError(f"k must be 1 to {MOST_K}")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, offsets, first in sequence_slices(batch.column(1), k):
                codes, rows = canonical_codes(data, offsets, k)
                order = np.lexsort((codes, rows))
                c, r = codes[order], rows[order]
                new = np.flatnonzero(np.concatenate(([True], (c[1:] != c[:-1]) | (r[1:] != r[:-1])))) if len(c) else np.zeros(0, np.int64)
                n = np.diff([*new, len(c)])
                for start in range(0, len(new), 1 << 16):
                    at = new[start : start + (1 << 16)]
                    yield pa.record_batch({key: batch.column(0).take(pa.array(r[at] + first)), "code": pa.array(c[at].astype(np.int64)), "n": pa.array(n[start : start + (1 << 16)].astype(np.int64))})

    kind = contigs.schema[key].dataType.simpleString()
    return small_batches(spread(contigs.select(key, "seq"))).mapInArrow(code, f"`{key}` {kind}, code long, n long")


def code_counts(contigs: DataFrame, k: int, key: str) -> DataFrame:
    """(key, counts): for every row the counts of all canonical k-mers in name order; rows without one are left out. For small k."""
    names, place = canonical_index(k)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, sums = -1, np.zeros(len(names), np.int64)
            ready: list[tuple[int, np.ndarray]] = []
            for data, offsets, first in sequence_slices(batch.column(1), k, NEAR_SLICE):
                codes, rows = canonical_codes(data, offsets, k)
                n = len(offsets) - 1
                table = np.bincount(rows * len(names) + place[codes.astype(np.int64)], minlength=n * len(names)).reshape(n, len(names))
                for row in range(n):
                    if first + row != last:  # else another part of the same long sequence
                        if sums.any():
                            ready.append((last, sums))
                        last, sums = first + row, table[row]
                    else:
                        sums = sums + table[row]
            if sums.any():
                ready.append((last, sums))
            if ready:
                counts = pa.array(np.concatenate([x for _, x in ready]), pa.int64())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ready) + 1, dtype=np.int32) * len(names)), counts)
                yield pa.record_batch({key: batch.column(0).take(pa.array([r for r, _ in ready])), "counts": lists})

    kind = contigs.schema[key].dataType.simpleString()
    return small_batches(spread(contigs.select(key, "seq"))).mapInArrow(count, f"`{key}` {kind}, counts array<long>")


def summed_counts(contigs: DataFrame, k: int, key: str) -> DataFrame:
    """(key, counts) with a row per key: one pass over the sequences, then sums of whole arrays' cells, map-side first."""
    names, _ = canonical_index(k)
    rows = code_counts(contigs, k, key)
    sums = rows.groupBy(key).agg(*(F.sum(F.col("counts")[i]).alias(f"n{i}") for i in range(len(names))))
    return sums.select(key, F.array(*(F.col(f"n{i}") for i in range(len(names)))).alias("counts"))


def code_runs(sequences: DataFrame, k: int, buckets: int) -> DataFrame:
    """(bucket, block, low, counts, bases): all k-mers of (number, seq), packed as stretches; number is 2^16 * block + low. Some 1.4 bytes a k-mer of 21."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(0).to_numpy()
            for data, offsets, first in sequence_slices(batch.column(1), k):
                bucket, rows, count, held, bases = kmer_runs(data, offsets, k, buckets)
                if not len(bucket):
                    continue
                own = number[rows + first]
                new = np.flatnonzero(np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (own[1:] >> 16 != own[:-1] >> 16))))
                ends, at = np.append(new, len(bucket)), np.concatenate(([0], np.cumsum(held)))
                cut = lambda x, places: pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(new), [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(x))]).cast(pa.binary())  # noqa: B023, E731
                low, counts, packed = cut((own & 0xFFFF).astype(np.uint16), 2 * ends), cut(count.astype(np.uint8), ends), cut(bases, at[ends])
                yield pa.record_batch({"bucket": pa.array(bucket[new]), "block": pa.array(own[new] >> 16), "low": low, "counts": counts, "bases": packed})

    return small_batches(sequences.select("number", "seq")).mapInArrow(pack, "bucket long, block long, low binary, counts binary, bases binary")


def distinct_sizes(sequences: DataFrame, k: int) -> DataFrame:
    """(number, size): the different k-mers of every row of (number, seq) of up to SLICE bases."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, offsets, first in sequence_slices(batch.column(1), k):
                sizes = np.bincount(distinct_pairs(*canonical_codes(data, offsets, k), k)[1], minlength=len(offsets) - 1)
                yield pa.record_batch({"number": batch.column(0).slice(first, len(sizes)), "size": pa.array(sizes.astype(np.int64))})

    return small_batches(sequences.select("number", "seq")).mapInArrow(count, "number long, size long")


def opened(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number, k-mers, bases) of all stretches in rows of code_runs()."""
    join = lambda c, kind: np.frombuffer(b"".join(x.as_py() for x in rows[c]), kind)
    counts, bases = join("counts", np.uint8), join("bases", np.uint8)
    block = np.repeat(rows["block"].to_numpy(), [len(x.as_py()) for x in rows["counts"]])
    return (block << 16) | join("low", np.uint16).astype(np.int64), counts, bases


def class_hits(rows: pa.Table, k: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Of one bucket (code_runs() with `known`): (number, genomes, first, mixed, n), k-mers that a read holds of each class; and with n 0 the genomes of every class of several.

    A class is a set of genomes that hold a k-mer alike, told by their number, the first of them and a sum of 64-bit hashes, which
    is 0 for one genome. Reads pass in parts of about `most` k-mers.
    """
    known = rows["known"].to_numpy().astype(bool)
    number, counts, bases = opened(rows.filter(pa.array(known)))
    if not len(counts):
        return
    codes, runs = run_codes(counts, bases, k)
    genomes, at = np.unique(number, return_inverse=True)
    codes, holder = _different(codes, at[runs], len(genomes).bit_length())
    holder = genomes[holder.astype(np.int64)]
    new = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    held = np.diff(np.append(new, len(codes)))
    mixed, leads = np.add.reduceat(_mixed(holder.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), new).view(np.int64), holder[new]
    # Classes of one genome by its place, then those of several.
    single, own = held == 1, np.searchsorted(genomes, leads)
    several = np.flatnonzero(~single)
    order = several[np.lexsort((mixed[several], leads[several], held[several]))]
    start = np.concatenate(([True], (held[order][1:] != held[order][:-1]) | (leads[order][1:] != leads[order][:-1]) | (mixed[order][1:] != mixed[order][:-1])))[: len(order)]
    which = np.where(single, own, 0)
    which[order] = len(genomes) + np.cumsum(start) - 1
    first = order[start]
    classes = np.concatenate((np.stack((np.ones_like(genomes), genomes, np.zeros_like(genomes)), axis=1), np.stack((held[first], leads[first], mixed[first]), axis=1)))
    codes = codes[new]
    columns = lambda a, c, n: pa.record_batch({"number": pa.array(a), "genomes": pa.array(classes[c, 0]), "first": pa.array(classes[c, 1]), "mixed": pa.array(classes[c, 2]), "n": pa.array(n)})
    size = held[first]
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    yield columns(holder[np.repeat(new[first], size) + inside], np.repeat(len(genomes) + np.arange(len(first)), size), np.zeros(len(inside), np.int64))
    number, counts, bases = opened(rows.filter(pa.array(~known)))
    byte = (counts.astype(np.int64) + k + 2) // 4
    start = np.cumsum(byte) - byte
    order = np.argsort(number, kind="stable")
    number, counts, byte, start = number[order], counts[order], byte[order], start[order]
    total, low = np.cumsum(counts, dtype=np.int64), 0
    while low < len(number):
        # Up to the end of a read, so that its k-mers are told apart.
        high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + most)))
        high = int(np.searchsorted(number, number[high - 1], "right"))
        part = slice(low, high)
        inside = np.arange(byte[part].sum()) - np.repeat(np.cumsum(byte[part]) - byte[part], byte[part])
        found, runs = run_codes(counts[part], bases[np.repeat(start[part], byte[part]) + inside], k)
        reads, own = np.unique(number[part], return_inverse=True)
        found, who = _different(found, own[runs], len(reads).bit_length())
        place = np.minimum(np.searchsorted(codes, found), len(codes) - 1)
        hit = codes[place] == found
        both, n = np.unique(who[hit].astype(np.int64) * len(classes) + which[place[hit]], return_counts=True)
        yield columns(reads[both // len(classes)], both % len(classes), n.astype(np.int64))
        low = high


def class_best(profiles: pa.Table, known: pa.Table, most: int = 1 << 21) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of profiles, row of known, shared) of every profile's best genome, of equal ones the last by name; profiles that share nothing are left out.

    profiles: first, mixed, shared, lists alike of a profile's classes in one order; known: mag, name and lists first, mixed of
    its classes of several genomes. Counted are at most some `most` cells and members of classes at once, equal profiles once.
    """
    known = known.append_column("_row", pa.array(np.arange(len(known)))).sort_by("name")
    number, none = known["mag"].to_numpy(), np.zeros(0, np.int64)
    if not len(known) or not len(profiles):
        return none, none, none
    flat = lambda t, c: t[c].combine_chunks().flatten().to_numpy()
    lengths = lambda t: t["first"].combine_chunks().value_lengths().fill_null(0).to_numpy().astype(np.int64)
    member = np.concatenate((np.repeat(np.arange(len(known)), lengths(known)), np.arange(len(known))))
    first = np.concatenate((flat(profiles, "first"), flat(known, "first"), number))
    mixed = np.concatenate((flat(profiles, "mixed"), flat(known, "mixed"), np.zeros_like(number)))
    order = np.lexsort((mixed, first))
    a, b = first[order], mixed[order]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(np.concatenate(([0], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    held, own = which[: len(which) - len(member)], which[len(which) - len(member) :]
    order = np.argsort(own, kind="stable")
    member, start = member[order], np.searchsorted(own[order], np.arange(which.max() + 2))
    shared, size = flat(profiles, "shared"), np.diff(start)[held]
    at = np.concatenate(([0], np.cumsum(lengths(profiles))))
    both, seen = np.stack((held, shared), axis=1), {}
    same = np.array([seen.setdefault(both[x:y].tobytes(), (len(seen), row))[0] for row, (x, y) in enumerate(zip(at[:-1], at[1:], strict=True))])
    rows = np.array([row for _, row in seen.values()])
    wide, best, top = len(known), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    step = max(1, most // wide)
    for low in range(0, len(rows), step):
        block = rows[low : low + step]
        count = at[block + 1] - at[block]
        entries = np.repeat(at[block] - np.cumsum(count) + count, count) + np.arange(count.sum())
        line, sums, total = np.repeat(np.arange(len(block)) * wide, count), np.zeros(len(block) * wide), np.cumsum(size[entries])
        begin = 0
        while begin < len(entries):
            end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + most, "right")))
            e, n = entries[begin:end], size[entries[begin:end]]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            sums += np.bincount(np.repeat(line[begin:end], n) + member[np.repeat(start[held[e]], n) + inside], np.repeat(shared[e], n), len(sums))
            begin = end
        sums = sums.reshape(len(block), wide)
        best[low : low + step] = wide - 1 - sums[:, ::-1].argmax(axis=1)
        top[low : low + step] = sums.max(axis=1).astype(np.int64)
    row = np.flatnonzero(top[same] > 0)
    return row, known["_row"].to_numpy()[best[same[row]]], top[same[row]]
