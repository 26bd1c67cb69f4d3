"""Ranked lexical search over a length-stratified index.

The index lies in shards of some megabytes of text. In a shard, documents are grouped by equal normaliser m (a stratum),
and a term's postings by stratum and, within it, by tf, so that an impact is computed once for each tf of a stratum. A
query bounds every stratum by its terms' largest impacts there, visits strata by falling bound and leaves those that can't
reach its k-th score. A shard is searched in one task; every shard gives its best k, which then compete.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from mossgrid.functions.common import union
from mossgrid.llm.common import LOWER, buffer, kept, pieces, prepare, release, slices, span_hashes, word_spans

TOP = 10
SHARD_BYTES = 1 << 23
#: Queries, and terms in all, that are searched together: their terms and weights are broadcast. A query of more terms goes alone.
QUERY_BLOCK = 1000
BLOCK_TERMS = 1 << 20
#: Documents of the first strata that a query visits, in multiples of k.
FIRST_VISIT = 4
INDEX = "shard long, term string, df long, strata array<long>, tf array<int>, n array<int>, docs array<int>, ids array<long>"

_BYTES = np.arange(256)
#: Terms of `[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+`: in UTF-8 all their separators are single bytes.
IS_TERM = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)


def term_spans(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Lower-cased bytes with starts, ends and rows of their terms."""
    data, offsets = buffer(batch.column(column))
    for part, at, row in slices(data, offsets, IS_TERM):
        low = LOWER[part]
        starts, ends, rows = word_spans(low, at, IS_TERM)
        yield low, starts, ends, rows + row


def corpus_size(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Documents with a term, and all their terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = terms = 0
        for batch in pieces(batches, text_col):
            found = np.zeros(batch.num_rows, np.int64)
            for _, _, _, rows in term_spans(batch, text_col):
                found += np.bincount(rows, minlength=batch.num_rows)
            documents, terms = documents + int((found > 0).sum()), terms + int(found.sum())
        yield pa.record_batch({"documents": pa.array([documents]), "terms": pa.array([terms])})

    got = docs.select(text_col).mapInArrow(count, "documents long, terms long").agg(F.sum("documents"), F.sum("terms")).first()
    return got[0] or 0, got[1] or 0


class Shard:
    """Documents and postings of some megabytes of text, until they are written as rows of the index."""

    def __init__(self, number: int) -> None:
        self.number, self.bytes, self.documents = number, 0, 0
        self.ids: list = []
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.names: dict[int, bytes] = {}

    def add(self, ids: pa.Array, batch: pa.RecordBatch, text_col: str) -> None:
        for low, starts, ends, rows in term_spans(batch, text_col):
            self.bytes += len(low)
            if not len(starts):
                continue
            hashes = span_hashes(low, starts, ends)
            order = np.lexsort((hashes, rows))
            h, r = hashes[order], rows[order]
            first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (r[1:] != r[:-1]))))
            self.found.append((h[first], (r[first] + self.documents).astype(np.int32), np.diff([*first, len(h)]).astype(np.int32)))
            unique, at = np.unique(hashes, return_index=True)
            for k, i in zip(unique.tolist(), at.tolist(), strict=True):
                if k not in self.names:
                    self.names[k] = low[starts[i] : ends[i]].tobytes()
        self.ids.extend(ids.to_pylist())
        self.documents += batch.num_rows

    def rows(self, documents: int, terms: int) -> Iterator[pa.RecordBatch]:
        """The shard's own row (term null: strata of its documents in order, and their ids), then a row for each term. Documents without a term aren't there."""
        if not self.found:
            return
        h, r, tf = (np.concatenate([x[k] for x in self.found]) for k in range(3))
        self.found = []
        length = np.bincount(r, tf, self.documents).astype(np.int64)
        m = np.array([100 - 90 + (90 * n * documents) // terms for n in length.tolist()], np.int64)
        numbers = np.array([(1 << 63) - 1 if x is None else x for x in self.ids], np.int64)
        held = np.flatnonzero(length)
        order = held[np.lexsort((numbers[held], m[held]))]
        place = np.zeros(self.documents, np.int32)
        place[order] = np.arange(len(order))
        strata, stratum = np.unique(m[order], return_inverse=True)
        names, term = np.unique(h, return_inverse=True)
        d = place[r]
        by = np.lexsort((d, tf, stratum[d], term))
        term, d, tf = term[by], d[by], tf[by]
        s = stratum[d]
        same = np.concatenate(([False], (term[1:] == term[:-1]) & (d[1:] == d[:-1])))
        if same.any():  # parts of one long text
            by = np.lexsort((d, term))
            term, d, tf = term[by], d[by], tf[by]
            first = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (d[1:] != d[:-1]))))
            term, d, tf = term[first], d[first], np.add.reduceat(tf, first)
            by = np.lexsort((d, tf, stratum[d], term))
            term, d, tf = term[by], d[by], tf[by]
            s = stratum[d]
        groups = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (s[1:] != s[:-1]) | (tf[1:] != tf[:-1]))))
        sizes = np.diff([*groups, len(term)])
        of_group = np.searchsorted(term[groups], np.arange(len(names) + 1))
        of_posting = np.searchsorted(term, np.arange(len(names) + 1))
        lists = lambda at, values: pa.ListArray.from_arrays(pa.array(at, pa.int32()), values)
        none = lambda kind, n: pa.nulls(n, pa.list_(kind))
        schema = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("strata", pa.list_(pa.int64())), ("tf", pa.list_(pa.int32())), ("n", pa.list_(pa.int32())), ("docs", pa.list_(pa.int32())), ("ids", pa.list_(pa.int64()))])
        own = [pa.array([self.number]), pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.array([m[order]], pa.list_(pa.int64())), none(pa.int32(), 1), none(pa.int32(), 1), none(pa.int32(), 1), pa.array([[self.ids[k] for k in order.tolist()]], pa.list_(pa.int64()))]
        yield pa.record_batch(own, schema)
        for start in range(0, len(names), 4096):  # of one batch
            end = min(start + 4096, len(names))
            n, g, p = end - start, slice(of_group[start], of_group[end]), slice(of_posting[start], of_posting[end])
            at_group, at_posting = of_group[start : end + 1] - of_group[start], of_posting[start : end + 1] - of_posting[start]
            yield pa.record_batch(
                [
                    pa.array(np.full(n, self.number)),
                    pa.array([self.names[k].decode("utf-8", "replace") for k in names[start:end].tolist()], pa.string()),
                    pa.array(np.diff(of_posting[start : end + 1]).astype(np.int64)),
                    lists(at_group, pa.array(strata[s[groups[g]]])),
                    lists(at_group, pa.array(tf[groups[g]].astype(np.int32))),
                    lists(at_group, pa.array(sizes[g].astype(np.int32))),
                    lists(at_posting, pa.array(d[p].astype(np.int32))),
                    none(pa.int64(), n),
                ],
                schema,
            )


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int, int]:
    """The written index of every document, with the number of documents that have a term and of all their terms.

    Null and empty texts have no terms. Each row is a document, also under a repeated or null id. A long text is read in
    slices; its own terms are all that a task holds of it.
    """
    prepare(docs.sparkSession)
    documents, terms = corpus_size(docs, text_col)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        shard = Shard(base)
        for batch in pieces(batches, text_col):
            shard.add(batch.column(0), batch, text_col)
            if shard.bytes >= SHARD_BYTES:
                yield from shard.rows(documents, terms)
                number += 1
                shard = Shard(base | number)
                release()
        yield from shard.rows(documents, terms)

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), text_col)
    return kept(rows.mapInArrow(index, INDEX), "index"), documents, terms


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, terms) of every query with a term, each term once."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text_col):
            own: list[dict] = [{} for _ in range(batch.num_rows)]
            for low, starts, ends, rows in term_spans(batch, text_col):
                for a, b, r in zip(starts.tolist(), ends.tolist(), rows.tolist(), strict=True):
                    own[r][low[a:b].tobytes().decode("utf-8", "replace")] = None
            yield pa.record_batch({"item": batch.column(0), "terms": pa.array([list(x) for x in own], pa.list_(pa.string()))})

    kind = queries.schema[id_col].dataType.simpleString()
    return queries.select(F.col(id_col).alias("item"), text_col).mapInArrow(find, f"item {kind}, terms array<string>").where(F.size("terms") > 0)


def blocks(queries: Iterator[Row]) -> Iterator[list[Row]]:
    """Queries in blocks of QUERY_BLOCK at most, with BLOCK_TERMS terms at most."""
    block, size = [], 0
    for row in queries:
        if block and (len(block) == QUERY_BLOCK or size + len(row.terms) > BLOCK_TERMS):
            yield block
            block, size = [], 0
        block.append(row)
        size += len(row.terms)
    if block:
        yield block


class Postings:
    """One term in one shard: for every posting its stratum, document and impact, and the largest impact of each stratum."""

    def __init__(self, m: np.ndarray, tf: np.ndarray, n: np.ndarray, docs: np.ndarray, strata: np.ndarray) -> None:
        tf = tf.astype(np.int64)
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m)  # once for each tf of a stratum
        stratum = np.searchsorted(strata, m)
        last = np.flatnonzero(np.concatenate((stratum[1:] != stratum[:-1], [True])))  # tf rises within a stratum
        self.strata, self.most = stratum[last], impact[last]
        self.stratum, self.impact, self.docs = np.repeat(stratum, n), np.repeat(impact, n), docs


def best_of(parts: list[tuple[int, Postings]], sizes: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k best documents of a shard, by score and then id; strata are visited by falling bound."""
    bound = np.zeros(len(sizes), np.int64)
    for w, p in parts:
        bound[p.strata] += w * p.most
    order = np.argsort(-bound, kind="stable")
    order = order[bound[order] > 0]
    score = np.zeros(len(ids), np.int64)
    start, end, least = 0, int(np.searchsorted(np.cumsum(sizes[order]), FIRST_VISIT * k)) + 1, 1
    while start < len(order) and bound[order[start]] >= least:
        visit = np.zeros(len(sizes), bool)
        visit[order[start:end][bound[order[start:end]] >= least]] = True
        for w, p in parts:
            at = visit[p.stratum]
            score[p.docs[at]] += w * p.impact[at]
        if (score > 0).sum() >= k:
            least = max(1, int(np.partition(score, -k)[-k]))
        start, end = end, 2 * end
    found = np.flatnonzero(score >= least)
    found = found[np.lexsort((ids[found], -score[found]))][:k]
    return found, score[found]


def search(index: tuple[DataFrame, int, int], queries: DataFrame, k: int = TOP, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(id_col, rank, doc_id, score): the k best documents with a score above 0 for every query, ties by rising doc_id (none is last).

    Each row of queries is a query, also under a repeated or null id; those without a term, or whose terms no document
    holds, have no rows. Queries go through in blocks (see blocks()): a block's terms and weights are broadcast, and only
    postings of its terms are moved, a shard's to one task. Tables may be empty.
    """
    rows, documents, _ = index
    spark: SparkSession = rows.sparkSession
    prepare(spark)
    terms = kept(query_terms(queries, id_col, text_col), "queries")
    kind = terms.schema["item"].dataType.simpleString()
    asked = terms.toLocalIterator() if documents else iter(())
    results = [_searched(spark, rows, documents, block, kind, k) for block in blocks(asked)]
    if not results:
        return terms.where("false").select(F.col("item").alias(id_col), F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    return union(*results).select(F.col("item").alias(id_col), "rank", "doc_id", "score")


def _searched(spark: SparkSession, rows: DataFrame, documents: int, block: list[Row], kind: str, k: int) -> DataFrame:
    names = spark.createDataFrame([(t,) for t in sorted({t for r in block for t in r.terms})], "term string")
    found = rows.join(F.broadcast(names), "term", "left_semi")
    held = {r.term: r.df for r in found.select("term", "df").groupBy("term").agg(F.sum("df").alias("df")).collect()}
    weights = {t: math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for t, df in held.items()}
    asked = [[(t, weights[t]) for t in r.terms if weights.get(t, 0) > 0] for r in block]
    there = spark.sparkContext.broadcast(asked)

    def in_shard(shard: pa.Table) -> pa.Table:
        columns = {c: shard.column(c).combine_chunks() for c in ("term", "strata", "tf", "n", "docs", "ids")}
        names = columns["term"].to_pylist()
        lists = {}
        for c in ("strata", "tf", "n", "docs"):
            x = columns[c].chunk(0) if isinstance(columns[c], pa.ChunkedArray) else columns[c]
            lists[c] = (x.values.to_numpy(zero_copy_only=False), np.asarray(x.offsets))
        of = lambda c, i: lists[c][0][lists[c][1][i] : lists[c][1][i + 1]]
        own = names.index(None)
        strata, sizes = np.unique(of("strata", own), return_counts=True)
        known = columns["ids"][own].as_py()
        ids = np.array([(1 << 63) - 1 if x is None else x for x in known], np.int64)
        postings = {t: Postings(of("strata", i), of("tf", i), of("n", i), of("docs", i), strata) for i, t in enumerate(names) if t is not None}
        out: tuple[list, list, list] = ([], [], [])
        for q, terms in enumerate(there.value):
            parts = [(w, postings[t]) for t, w in terms if t in postings]
            if parts:
                places, scores = best_of(parts, sizes, ids, k)
                out[0].extend([q] * len(places))
                out[1].extend(known[i] for i in places.tolist())
                out[2].extend(scores.tolist())
        return pa.table({"q": pa.array(out[0], pa.int32()), "doc_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.int64())})

    wanted = rows.join(F.broadcast(names), "term", "left_semi").unionByName(rows.where("term IS NULL"))
    best = wanted.groupBy("shard").applyInArrow(in_shard, "q int, doc_id long, score long")
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    items = spark.createDataFrame([(i, r.item) for i, r in enumerate(block)], f"q int, item {kind}")
    return kept(ranked.join(F.broadcast(items), "q").select("item", "rank", "doc_id", "score"), "ranked")


def sql(documents: str = "documents", queries: str = "benchmark", k: int = TOP) -> str:
    """The same in DuckDB's SQL, scoring every document that holds a term."""
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    low = lambda x: f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH t AS (SELECT r, doc_id, unnest(regexp_extract_all({low('text')}, '{term}')) AS term FROM (SELECT row_number() OVER () AS r, doc_id, text FROM {documents})),
n AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM t GROUP BY r),
s AS (SELECT count(*)::BIGINT AS documents, sum(n)::BIGINT AS terms FROM n),
l AS (SELECT r, n.doc_id, 100 - 90 + (90 * n * documents) // terms AS m FROM n, s),
q AS (SELECT DISTINCT i, item_id, unnest(regexp_extract_all({low('text')}, '{term}')) AS term FROM (SELECT row_number() OVER () AS i, item_id, text FROM {queries})),
p AS (SELECT r, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(documents) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term),
x AS (SELECT i, item_id, p.r, any_value(l.doc_id) AS doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM q JOIN p ON q.term = p.term JOIN w ON w.term = p.term JOIN l ON l.r = p.r GROUP BY i, item_id, p.r)
SELECT item_id, rank, doc_id, score FROM (SELECT *, (row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank FROM x WHERE score > 0) WHERE rank <= {k}"""
