"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts every n-gram of every labelled row (no sample): each task adds up its own counters, and counters are merged
by language as they stream past. The matrix of log probabilities has languages x 2**BITS entries and is broadcast; its size
depends on the number of languages only. Scores are sums of whole numbers, so equal texts have equal results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mossgrid.llm.common import U64, pieces, prepare

BITS = 16
ORDERS = (2, 3)
SCALE = 1 << 12
#: With so many, a task's counters take 128 MB and the broadcast matrix 64 MB.
MOST_LANGUAGES = 256
UNKNOWN = "und"
#: Characters of a text that are counted together; longer ones come in slices.
SLICE = 1 << 18
_LETTER = np.zeros(0, bool)


def letters(points: np.ndarray) -> np.ndarray:
    global _LETTER
    if not len(_LETTER):
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _LETTER[points]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, each with a space before and after, letters kept and runs of the rest one space; and offsets."""
    parts = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    gap = np.array([32], np.uint32)
    joined = np.concatenate([x for p in parts for x in (gap, p, gap)]) if parts else gap[:0]
    offsets = np.concatenate(([0], np.cumsum([len(p) + 2 for p in parts]))).astype(np.int64)
    first = np.zeros(len(joined), bool)
    first[offsets[:-1]] = True
    other = ~letters(joined)
    keep = ~other | first | ~np.concatenate(([False], other[:-1]))
    joined = np.where(other, np.uint32(32), joined)[keep]
    return joined, np.concatenate(([0], np.cumsum(keep)))[offsets]


def feature_numbers(points: np.ndarray, k: int) -> np.ndarray:
    """Feature numbers of all n-grams of k code points."""
    n, wide = len(points), points.astype(U64)
    h = np.full(max(0, n - k + 1), k, U64)
    for i in range(k if len(h) else 0):
        h = (h + wide[i : n - k + 1 + i]) * U64(0x9E3779B97F4A7C15)
    h ^= h >> U64(29)
    h *= U64(0xBF58476D1CE4E5B9)
    return (h >> U64(64 - BITS)).astype(np.int32)


def long_counts(text: str) -> np.ndarray:
    """How often each feature stands in a long text, read in slices whose n-grams reach back into the slice before: what features() finds, in memory of a slice beside the text."""
    low, counts = text.lower(), np.zeros(1 << BITS, np.int64)
    tail, gap = np.array([32], np.uint32), True
    for at in range(0, len(low) + 1, SLICE):
        part = np.frombuffer(low[at : at + SLICE].encode("utf-32-le", "surrogatepass"), np.uint32)
        if at + SLICE > len(low):
            part = np.concatenate((part, np.array([32], np.uint32)))
        other = ~letters(part)
        keep = ~other | ~np.concatenate(([gap], other[:-1]))
        points = np.concatenate((tail, np.where(other, np.uint32(32), part)[keep]))
        for k in ORDERS:
            counts += np.bincount(feature_numbers(points[max(0, len(tail) - k + 1) :], k), minlength=1 << BITS)
        tail, gap = points[-(max(ORDERS) - 1) :], bool(other[-1])
    return counts


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all n-grams of all texts, row by row, and offsets. An n-gram lies in one text."""
    points, offsets = code_points(texts)
    n = len(points)
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    found, rows = [], []
    for k in ORDERS:
        if n >= k:
            inside = row[: n - k + 1] == row[k - 1 :]
            found.append(feature_numbers(points, k)[inside])
            rows.append(row[: n - k + 1][inside])
    if not found:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    rows, found = np.concatenate(rows), np.concatenate(found)
    order = np.argsort(rows, kind="stable")
    return found[order], np.searchsorted(rows[order], np.arange(len(texts) + 1))


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", most_languages: int = MOST_LANGUAGES) -> tuple[list[str], np.ndarray]:
    """(languages, scaled log probabilities) from all rows with a language and a text, repeated ones each time.

    Rows without either teach nothing, nor do texts without a letter; a table without such rows gives a model that knows no
    language. Languages have equal priors. More than most_languages labels are an error, not dropped.
    """
    prepare(labelled.sparkSession)
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    names = sorted(r[0] for r in rows.select("lang").distinct().limit(most_languages + 1).collect())
    if len(names) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    if not names:
        return [], np.zeros((1 << BITS, 0), np.int32)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in pieces(batches, "text"):
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            if len(texts) == 1 and len(texts[0]) > SLICE:
                got = long_counts(texts[0])
                sums[langs[0]] = sums[langs[0]] + got if langs[0] in sums else got
                continue
            found, at = features(texts)
            index = {x: k for k, x in enumerate(sorted(set(langs)))}
            own = np.repeat(np.array([index[x] for x in langs]), np.diff(at))
            got = np.bincount((own << BITS) + found, minlength=len(index) << BITS).reshape(len(index), -1)
            for x, k in index.items():
                sums[x] = sums[x] + got[k] if x in sums else got[k]
        for x, c in sums.items():
            yield pa.record_batch([pa.array([x]), pa.array([zlib.compress(c.astype(np.int64).tobytes(), 1)], pa.binary())], ["lang", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for x, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                c = np.frombuffer(zlib.decompress(c), np.int64)
                sums[x] = sums[x] + c if x in sums else c
        for x, c in sums.items():
            yield pa.record_batch([pa.array([x]), pa.array([zlib.compress(c.astype(np.int64).tobytes(), 1)], pa.binary())], ["lang", "counts"])

    schema = "lang string, counts binary"
    merged = {r.lang: np.frombuffer(zlib.decompress(r.counts), np.int64) for r in rows.mapInArrow(count, schema).repartition(16, "lang").mapInArrow(add, schema).collect()}
    counts = np.stack([merged[x] for x in names]).astype(np.float64) + 0.5
    return names, np.rint(SCALE * np.log(counts / counts.sum(axis=1, keepdims=True))).astype(np.int32).T.copy()


def predict(df: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text") -> DataFrame:
    """Adds lang_pred, the language of the highest likelihood under equal priors, and score, its posterior with the evidence divided by the square root of the number of n-grams (the plain posterior is 1 for nearly every text).

    `und` with score 0 where the text is null or has no letter, or no language was learned. A tie goes to the language
    first in name order. A long text is counted in slices, so it takes a few times its own bytes. Earlier columns of these
    names are replaced.
    """
    prepare(df.sparkSession)
    df = df.drop("lang_pred", "score")
    shared = df.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = shared.value
        for batch in pieces(batches, text):
            texts = [x or "" for x in batch.column(text).to_pylist()]
            long = len(texts) == 1 and len(texts[0]) > SLICE
            found, at = features([] if long else texts)
            best, sure = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if names and (long or len(found)):
                if long:
                    counts, full = long_counts(texts[0]), np.zeros(1, np.int64)
                    sums, n = (counts @ table.astype(np.int64))[:, None], counts.sum(keepdims=True)
                else:
                    full = np.flatnonzero(np.diff(at) > 0)
                    sums = np.stack([np.add.reduceat(table[:, k][found].astype(np.int64), at[:-1][full]) for k in range(len(names))])
                    n = np.diff(at)[full]
                gap = (sums - sums.max(axis=0)) / (SCALE * np.sqrt(n))
                p = np.exp(gap)
                p = p.max(axis=0) / p.sum(axis=0)
                top = sums.argmax(axis=0)
                for i, k, x in zip(full.tolist(), top.tolist(), p.tolist(), strict=True):
                    if any(map(str.isalpha, texts[i])):
                        best[i], sure[i] = names[k], x
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.string()), pa.array(sure)], [*batch.schema.names, "lang_pred", "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(score, f"{fields}, lang_pred string, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """True for the quarter of the rows that training never sees."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
