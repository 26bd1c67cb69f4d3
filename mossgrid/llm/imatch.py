"""I-Match document fingerprints.

Terms whose document frequency lies in a band (neither common nor rare) form the lexicon. A fingerprint has one part per
randomised subset of the lexicon: the hash of the document's distinct terms in that subset, sorted and each counted once
(hashes of terms are summed, which no order changes). Subsets are drawn at several rates, so that long and short documents
alike have parts that few terms decide and that edits spare. Two fingerprints are compared at the sparsest rate at which
half of the parts stand in either.

The band is set as parts of the number of documents, so the lexicon can't outgrow the mean number of distinct terms of a
document over the lower part: its size has a bound whatever the corpus, and it is broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mossgrid.llm.common import LOWER, NOT_SPACE, U64, buffer, mix, pieces, prepare, random_words, signed, slices, span_hashes, word_spans

LEAST_PART = 1e-3
MOST_PART = 0.1
LEAST_DOCS = 2
#: Of the lexicon's terms, one in so many is in a subset, and so many subsets are drawn at each rate; each rate divides the next.
RATES = (1, 4, 16, 64, 256, 1024)
SUBSETS = 12
EMPTY = "-"
RANGE_BYTES = 1 << 24
MOST_RANGES = 20_000


def terms(column: pa.Array, lexicon: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct term hashes of each row (of the lexicon, if given), sorted, and offsets. Terms are words `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased. A long text is read in slices."""
    data, offsets = buffer(column)
    found = []
    for part, at, first in slices(data, offsets, NOT_SPACE):
        low = LOWER[part]
        starts, ends, row = word_spans(low, at, NOT_SPACE)
        h = span_hashes(low, starts, ends)
        if lexicon is not None:
            at = np.minimum(np.searchsorted(lexicon, h), max(len(lexicon) - 1, 0))
            inside = lexicon[at] == h if len(lexicon) else np.zeros(len(h), bool)
            h, row = h[inside], row[inside]
        found.append((h, row + first))
    h, row = (np.concatenate([x[i] for x in found]) if found else np.zeros(0, t) for i, t in enumerate((U64, np.int64)))
    at = np.searchsorted(row, np.arange(len(offsets)))
    sets = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        own = h[a:b].copy()
        own.sort()
        sets.append(own[np.concatenate(([True], own[1:] != own[:-1]))] if len(own) > 1 else own)
    return np.concatenate(sets) if sets else h[:0], np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int64)


def lexicon(docs: DataFrame, text: str = "text", least: float = LEAST_PART, most: float = MOST_PART) -> np.ndarray:
    """Sorted hashes of the terms in the band, whose ends count. Document frequencies cover all rows, repeated ones each time; null and empty texts count as documents without terms. Empty tables have an empty lexicon."""
    prepare(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, rows = [], 0, 0

        def summed() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.record_batch([signed(found), pa.array(n.astype(np.int64)), pa.array(np.zeros(len(n), np.int64))], ["term", "n", "rows"])

        for batch in pieces(batches, "text"):
            found, _ = terms(batch.column("text"))
            waiting.append(found)
            size += len(found)
            rows += batch.num_rows
            if size > 1 << 20:
                yield summed()
                waiting, size = [], 0
        if size:
            yield summed()
        yield pa.record_batch([pa.nulls(1, pa.int64()), pa.array([0], pa.int64()), pa.array([rows], pa.int64())], ["term", "n", "rows"])

    counts = docs.select(F.col(text).alias("text")).mapInArrow(count, "term long, n long, rows long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"))
    total = docs.count()
    band = counts.where(F.col("term").isNotNull() & (F.col("n") >= max(LEAST_DOCS, least * total)) & (F.col("n") <= max(LEAST_DOCS, most * total)))
    return np.sort(band.select("term").toPandas()["term"].to_numpy(np.int64).view(U64))


def fingerprints(column: pa.Array, words: np.ndarray) -> np.ndarray:
    """Parts of each row's fingerprint by rate, 0 where a subset has none of its terms. A row without any lexicon term has its whole text's hash in every part."""
    found, at = terms(column, words)
    row = np.repeat(np.arange(len(column)), np.diff(at))
    out = np.zeros((len(column), len(RATES), SUBSETS), U64)
    for k, seed in enumerate(random_words(SUBSETS, 11)):
        drawn, own = mix(found ^ seed), row
        for j, rate in enumerate(RATES):  # a rate's subset lies in that of the rate before
            inside = drawn % U64(rate) == 0
            drawn, own = drawn[inside], own[inside]
            np.add.at(out[:, j, k], own, mix(drawn ^ U64(rate)))
            out[own, j, k] |= U64(1)
    for i in np.flatnonzero(np.diff(at) == 0).tolist():
        text = column[i].as_py() or ""
        out[i] = mix(np.frombuffer(hashlib.md5(text.encode()).digest()[:8], U64)) | U64(1)
    return out


def shown(parts: np.ndarray) -> list[str]:
    return ["".join(f"{x >> 40:06x}" if x else EMPTY for x in row) for row in parts.reshape(len(parts), -1).tolist()]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal parts among those that either row has, at the sparsest rate of which half of the parts are there, else at the first."""
    either = ((a != 0) | (b != 0)).sum(axis=2)
    equal = ((a == b) & (a != 0)).sum(axis=2)
    rate = len(RATES) - 1 - (either[:, ::-1] >= SUBSETS / 2).argmax(axis=1)
    rate = np.where((either >= SUBSETS / 2).any(axis=1), rate, 0)
    rows = np.arange(len(a))
    return equal[rows, rate] / np.maximum(either[rows, rate], 1)


def fingerprint_documents(docs: DataFrame, words: np.ndarray, text: str = "text") -> DataFrame:
    """Adds fingerprint to every row; an earlier column of the name is replaced. Null text is empty; equal texts have equal fingerprints. Tables may be empty."""
    prepare(docs.sparkSession)
    docs = docs.drop("fingerprint")
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shown(fingerprints(batch.column(text), shared.value)))], [*batch.schema.names, "fingerprint"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(add, f"{fields}, fingerprint string")


def in_order(docs: DataFrame) -> DataFrame:
    """Rows by descending id in ranges of their own, each range followed by a copy of the row that comes next (guard).

    Texts move once. The number of ranges follows the bytes of text. Their bounds are quantiles of the ids; an id that has
    more rows than a range should (or null) is split by a hash of the texts, in whose order rows of one id stand. A few
    numbers per range come to the driver.
    """
    spark = docs.sparkSession
    docs = docs.withColumn("key", F.bitwise_not(F.xxhash64("text")))
    whole = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).first()
    ranges = min(MOST_RANGES, max(spark.sparkContext.defaultParallelism, (whole["size"] or 0) // RANGE_BYTES + 1, 1))
    ids = docs.where("doc_id is not null")
    cuts = sorted({int(x) for x in ids.approxQuantile("doc_id", [k / ranges for k in range(1, ranges)], 0.2 / ranges)}) if ranges > 1 and whole["n"] else []
    hot = {r.doc_id: r.n for r in docs.groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("n") > max(1, whole["n"] // ranges)).collect()}
    # Bounds in descending order of (id, key): an id's bound stands before all of its rows, those inside a hot id at equal steps of the key.
    lowest, top = -(1 << 63), 1 << 63
    bounds = {(x, top) for x in cuts} | {(lowest if x is None else x, top) for x in hot}
    bounds |= {(lowest if x is None else x, top - ((k << 64) // parts)) for x, n in hot.items() if (parts := n * ranges // whole["n"] + 1) for k in range(1, parts)}
    bounds = np.array(sorted(bounds), dtype=[("id", np.int64), ("key", object)])
    split = {int(x): np.array([int(k) for k in bounds["key"][bounds["id"] == x][:-1]], np.int64) for x in {lowest if i is None else i for i in hot}}
    bound_ids, last = bounds["id"].copy(), len(bounds)

    @F.arrow_udf("int")
    def range_of(i: pa.Array, key: pa.Array) -> pa.Array:
        """The number of bounds that stand before a row: the ranges are numbered in its descending order."""
        i, key = i.fill_null(lowest).to_numpy(zero_copy_only=False), key.to_numpy(zero_copy_only=False)
        below = np.searchsorted(bound_ids, i, "left")  # bounds of lower ids come after
        for x, inner in split.items():
            own = i == x
            if own.any():
                below[own] += np.searchsorted(inner, key[own], "left")
        return pa.array(last - below, pa.int32())

    ranged = docs.withColumn("range", range_of("doc_id", "key"))
    first = {r["range"]: (r.top["i"], r.top["key"]) for r in ranged.groupBy("range").agg(F.max(F.struct(F.coalesce("doc_id", F.lit(lowest)).alias("i"), "key")).alias("top")).collect()}
    order = sorted(first)
    before = dict(zip(order, order[-1:] + order[:-1], strict=True))
    firsts = spark.sparkContext.broadcast({first[r]: before[r] for r in order})

    @F.arrow_udf("int")
    def guard_of(i: pa.Array, key: pa.Array) -> pa.Array:
        return pa.array(map(firsts.value.get, zip(i.fill_null(lowest).to_pylist(), key.to_pylist(), strict=True)), pa.int32())

    row = lambda r, guard: F.struct(r.alias("range"), F.lit(guard).alias("guard"))
    guard = guard_of("doc_id", "key")
    both = ranged.withColumn("to", guard).withColumn("p", F.explode(F.array_compact(F.array(row(F.col("range"), False), F.when(F.col("to").isNotNull(), row(F.col("to"), True))))))
    spread = both.select("doc_id", "text", "key", "p.range", "p.guard")
    return spread.repartitionById(last + 1, F.col("range")).sortWithinPartitions("range", "guard", F.desc_nulls_last("doc_id"), F.desc("key"), "text")


def edited_neighbours(docs: DataFrame, words: np.ndarray) -> DataFrame:
    """Every row of (doc_id, text) with its fingerprint, that of its edited text, and their likeness and that to the next row's.

    The edited text has its last third replaced by as many first characters of the next row's; the last row's next is the
    first. Null texts are empty. Null ids are last; rows of one id stand in order of a hash of their texts, so repeated rows
    are neighbours. A long text takes a few times its own bytes: it is hashed in slices. Ranges are of RANGE_BYTES, larger
    ones from MOST_RANGES of them on; a task streams its range. Other columns than doc_id and text don't come back. Tables
    may be empty.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(words)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, str]]:
        last, guarded = None, False
        for batch in batches:
            for r, guard, i, text in zip(*(batch.column(c).to_pylist() for c in ("range", "guard", "doc_id", "text")), strict=True):
                if last is not None and last[0] == r and not guarded:
                    yield last[1], last[2], text
                if not guard or last is None or last[0] != r:
                    last, guarded = (r, i, text), guard
                else:
                    guarded = True

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def done() -> pa.RecordBatch:
            texts, following = [x[1] for x in waiting], [x[2] for x in waiting]
            edited = [t[: len(t) - len(t) // 3] + f[: len(t) // 3] for t, f in zip(texts, following, strict=True)]
            column = lambda x: pa.array(x, pa.large_string())
            own, other = fingerprints(column(texts), shared.value), fingerprints(column(edited), shared.value)
            near = np.concatenate((own[1:], fingerprints(column(following[-1:]), shared.value)))
            for k in range(len(texts) - 1):
                if following[k] != texts[k + 1]:
                    near[k] = fingerprints(column([following[k]]), shared.value)[0]
            return pa.record_batch([pa.array([x[0] for x in waiting], pa.int64()), pa.array(map(len, texts), pa.int64()), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited]), pa.array(shown(own)), pa.array(shown(other)), pa.array(likeness(own, other)), pa.array(likeness(own, near))], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        for x in pairs(batches):
            waiting.append(x)
            size += len(x[1])
            if size > 1 << 20:
                yield done()
                waiting, size = [], 0
        if waiting:
            yield done()

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_order(docs).mapInArrow(compare, schema)
