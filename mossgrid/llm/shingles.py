"""N-gram Jaccard join: a size-aware heavy-light join over sets of word shingles.

A document's set holds its distinct shingles of five words (A-Z lower-cased, words `[^\\x20\\x09-\\x0D]+`). Two documents
link when their sets' Jaccard similarity reaches the threshold. Equal sets are one class before anything is paired, so
copies cost nothing. Between classes:

* Light sets (up to a boundary) enumerate their subsets of each size that a partner could share; linked sets share one.
* Heavy sets scan inverted lists, but only those of their rarest shingles: a linked partner must be in one of them. Rarity
  comes from a fixed-size count sketch over all documents; any order that is a function of the shingle is exact, so
  collisions in the sketch only move a shingle to the back.
* The boundary is where the sum of both costs, measured on the class sizes, is least.

Within a list, members are compared with one hub, then only with members of other components, so that a group of copies
costs one comparison a member and no pair that could join two components is left out. Candidate pairs are
verified on whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mossgrid.functions.common import running
from mossgrid.llm.common import LOWER, NOT_SPACE, U64, Counts, buffer, components, id_filter, kept, merged_counts, mix, pieces, prepare, random_words, signed, sketch_bits, slices, span_hashes, word_spans

WORDS = 5
PERCENT = 80
MOST_LIGHT = 24
#: Bytes of a word and its separator, to size the sketch by.
WORD_BYTES = 6
#: From here on numbers stand for rows without an id, where there are such rows.
NO_ID = 1 << 62
#: Pairs of one document that are compared in one place.
PART_PAIRS = 256


def least_overlap(size: int, percent: int = PERCENT) -> int:
    """The smallest overlap with any linked partner: percent of the larger set, and of this one at least."""
    return -(-percent * size // 100)


def prefix_length(size: int, percent: int = PERCENT) -> int:
    return size - least_overlap(size, percent) + 1


def subset_sizes(size: int, percent: int = PERCENT) -> list[int]:
    """Sizes of the subsets that linked pairs share: one for each size that the larger partner can have."""
    return sorted({c for t in range(size, size * 100 // percent + 1) if (c := least_overlap(t, percent)) <= size})


def subset_count(size: int, percent: int = PERCENT) -> int:
    import math

    return sum(math.comb(size, c) for c in subset_sizes(size, percent))


def subset_keys(shingles: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Hashes of the subsets: a subset's is the sum of its members', so it's the whole sum less what is left out."""
    own = mix(shingles ^ U64(0x5851F42D4C957F2D))
    total, keys = own.sum(dtype=U64), []
    for c in subset_sizes(len(shingles), percent):
        left = list(combinations(range(len(own)), len(own) - c))
        keys.append(mix(total - (own[np.array(left, np.int64)].sum(axis=1, dtype=U64) if left[0] else np.zeros(1, U64)) + U64(c * 0x632BE5AB)))
    return np.concatenate(keys)


def boundary(sizes: dict[int, int], list_length: float, percent: int = PERCENT) -> int:
    """The largest light size: subsets of the light sets and list entries of the heavy ones cost least together."""
    enumerate_, scan = ([sizes.get(n, 0) * f(n) for n in range(1, MOST_LIGHT + 1)] for f in (lambda n: subset_count(n, percent), lambda n: prefix_length(n, percent) * (1 + list_length)))
    return min(range(MOST_LIGHT + 1), key=lambda x: sum(enumerate_[:x]) + sum(scan[x:]))


def shingle_sets(column: pa.Array, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, and each row's offsets into them."""
    data, offsets = buffer(column)
    found = []
    for part, at, first in slices(data, offsets, NOT_SPACE):
        low = LOWER[part]
        starts, ends, row = word_spans(low, at, NOT_SPACE)
        found.append((span_hashes(low, starts, ends), row + first))
    words, row = (np.concatenate([x[i] for x in found]) if found else np.zeros(0, t) for i, t in enumerate((U64, np.int64)))
    times = random_words(k, 7) | U64(1)
    n = len(words)
    at = np.searchsorted(row, np.arange(len(offsets)))
    if n >= k:
        grams = np.zeros(n - k + 1, U64)
        for i in range(k):
            grams += words[i : n - k + 1 + i] * times[i]
        grams = mix(grams)
    sets = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= k:
            own = grams[a : b - k + 1].copy()
            own.sort()
            if len(own) > 1:
                own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        else:
            own = mix((words[a:b] * times[: b - a]).sum(dtype=U64, keepdims=True) + U64(b - a)) if b > a else words[:0]
        sets.append(own)
    return np.concatenate(sets) if sets else np.zeros(0, U64), np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int64)


def profiles(docs: DataFrame, bits: int, k: int = WORDS) -> DataFrame:
    """One pass over the texts: (doc_id, n, s1, s2) with the set's size and 128-bit signature, and rows (chunk, counts) of the tasks' shingle counts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Counts(bits)
        for batch in pieces(batches, "text"):
            grams, at = shingle_sets(batch.column("text"), k)
            sketch.add(grams)
            sums = [np.concatenate((np.zeros(1, U64), np.cumsum(x, dtype=U64))) for x in (mix(grams), mix(grams ^ U64(0xD1342543DE82EF95)))]
            m = batch.num_rows
            yield pa.record_batch([batch.column("doc_id"), pa.array(np.diff(at)), *(signed(x[at[1:]] - x[at[:-1]]) for x in sums), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], ["doc_id", "n", "s1", "s2", "chunk", "counts"])
        for c, counts in sketch.chunks():
            yield pa.record_batch([pa.nulls(1, pa.int64())] * 4 + [pa.array([c], pa.int32()), pa.array([counts], pa.binary())], ["doc_id", "n", "s1", "s2", "chunk", "counts"])

    return docs.mapInArrow(scan, "doc_id long, n long, s1 long, s2 long, chunk int, counts binary")


def list_keys(docs: DataFrame, frequent: np.ndarray, most_light: int, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, rare, common, subsets): keys of the lists that a document's set enters. rare ones are of shingles that the sketch bounds; common ones of frequent shingles, which come after them in the order."""
    marks = docs.sparkSession.sparkContext.broadcast(np.packbits(frequent))
    bits = len(frequent).bit_length() - 1

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            grams, at = shingle_sets(batch.column("text"), k)
            place = (grams >> U64(64 - bits)).astype(np.int64)
            often = (marks.value[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
            rare, common, subsets = [], [], []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                n = b - a
                p = prefix_length(n, percent) if n and n >= least_overlap(most_light + 1, percent) else 0
                rare.append(grams[a:b][~often[a:b]][:p])
                common.append(grams[a:b][often[a:b]][: p - len(rare[-1])])
                subsets.append(subset_keys(grams[a:b], percent) if 0 < n <= most_light else grams[:0])
            yield pa.record_batch([batch.column("doc_id"), *(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(y) for y in x]))).astype(np.int32)), signed(np.concatenate(x))) for x in (rare, common, subsets))], ["doc_id", "rare", "common", "subsets"])

    return docs.mapInArrow(scan, "doc_id long, rare array<long>, common array<long>, subsets array<long>")


def linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link."""
    both = np.concatenate((one, two))
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return len(two) > 0 and 100 * shared >= percent * (len(both) - shared)


def verified(pairs: DataFrame, docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(a, b, linked) for pairs of documents, by their whole texts. Only texts that the pairs name are moved.

    A document with more than PART_PAIRS pairs as a is a hub: its pairs are dealt in parts of about so many, and its text
    goes to each part once, ahead of the texts of its b.
    """
    named = id_filter(pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))))
    texts = docs.where(named("doc_id"))
    hubs = kept(pairs.groupBy("a").agg(F.ceil(F.count("*") / PART_PAIRS).alias("parts")).where("parts > 1"), "hubs")
    of_a, of_b = (texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}")) for c in ("a", "b"))
    few = pairs.join(hubs, "a", "left_anti").join(of_b, "b").join(of_a, "a").select("a", "b", "text_a", "text_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hub = None, None
        for batch in pieces(pieces(batches, "text_b"), "text_a"):
            grams, at = shingle_sets(batch.column("text_b"), k)
            found = []
            for i, a in enumerate(batch.column("a").to_pylist()):
                text = batch.column("text_a")[i].as_py()
                if a != last or hub[0] != text:
                    last, hub = a, (text, shingle_sets(pa.array([text], pa.string()), k)[0])
                found.append(linked(hub[1], grams[at[i] : at[i + 1]], percent))
            yield pa.record_batch([batch.column("a"), batch.column("b"), pa.array(found, pa.bool_())], ["a", "b", "linked"])

    def compare_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sets = None, []
        for batch in pieces(batches, "text"):
            grams, at = shingle_sets(batch.column("text"), k)
            out = []
            for i, (a, part, b) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "part", "b")), strict=True)):
                own = grams[at[i] : at[i + 1]]
                if b is not None:
                    out.append((a, b, any(linked(x, own, percent) for x in sets)))
                else:  # a may stand in several rows
                    sets = [*sets, own] if (a, part) == last else [own]
                    last = a, part
            yield pa.record_batch([pa.array([x[c] for x in out], kind) for c, kind in enumerate((pa.int64(), pa.int64(), pa.bool_()))], ["a", "b", "linked"])

    out = few.mapInArrow(compare, "a long, b long, linked boolean")
    if not hubs.isEmpty():
        second = pairs.join(hubs, "a").join(of_b, "b").select("a", F.pmod(F.xxhash64("b"), "parts").alias("part"), "b", F.col("text_b").alias("text"))
        first = hubs.join(of_a, "a").select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), F.col("text_a").alias("text"))
        dealt = first.unionByName(second).repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
        out = out.unionByName(dealt.mapInArrow(compare_parts, "a long, b long, linked boolean"))
    return out.groupBy("a", "b").agg(F.max("linked").alias("linked"))


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row: component_id is the smallest id that links reach, the row's own included.

    Null or empty text: no shingles, own component. Rows of one id are one document (a link of any of its rows counts).
    Every row without an id is a document of its own and links like any other; a component in which no row has an id is
    null. Ids may be any long. Ties and repeated rows need no rule: classes are sets. A long text's words are hashed in
    slices, so it takes some 8 bytes a word and its distinct shingles. Tables may be empty.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    nameless, numbers = not docs.where("doc_id is null").isEmpty(), None
    if nameless:  # such rows get numbers behind all ids, which a table holds fast
        if (docs.agg(F.max("doc_id")).first()[0] or 0) >= NO_ID:  # then ids get numbers too, in their order
            numbers = kept(running(docs.where("doc_id is not null").select("doc_id").distinct(), [F.col("doc_id")], number=F.lit(1).cast("long")), "ids")
            docs = docs.join(numbers, "doc_id", "left").select(F.col("number").alias("doc_id"), "text")
        docs = kept(docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID) + F.monotonically_increasing_id())), "numbered")
    bits = sketch_bits((docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // WORD_BYTES)
    scanned = kept(profiles(docs, bits, k), "profiles")
    rows = scanned.where("chunk is null").select("doc_id", "n", "s1", "s2")
    classes = kept(rows.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "classes")
    counts = merged_counts(scanned.where("chunk is not null"), bits)
    sizes = classes.agg(F.sum("n").alias("own"), F.sum(F.col("n") * F.col("copies")).alias("all")).first()
    small = {r.n: r.c for r in classes.where(F.col("n") <= MOST_LIGHT).groupBy("n").agg(F.count("*").alias("c")).collect()}
    light = boundary(small, sizes["all"] / sizes["own"] if sizes["own"] else 1.0, percent)
    mean = float(counts.sum(dtype=np.uint64)) / len(counts)
    frequent = counts > mean + max(16.0, 6 * mean**0.5)

    reps = classes.select(F.col("rep").alias("doc_id"), "n").groupBy("doc_id").agg(F.max("n").alias("n"))
    keyed = kept(list_keys(docs, frequent, light, k, percent).withColumn("r", F.size("rare")).join(reps, "doc_id"), "keys")  # read five times below
    w = Window.partitionBy("key")
    # A rare shingle's list is short: the sketch never counts too few. Its rows meet once.
    rare = keyed.select(F.posexplode("rare").alias("pos", "key"), "doc_id", "n", "r").withColumn("members", F.count("*").over(w)).where("members > 1").select("key", "doc_id", "n", "r", "pos")
    common = keyed.select(F.posexplode("common").alias("i", "key"), "doc_id", "n", "r").select("key", "doc_id", "n", "r", (F.col("r") + F.col("i")).alias("pos"))
    subsets = keyed.select(F.explode("subsets").alias("key"), "doc_id", "n", "r").select("key", "doc_id", "n", "r", F.lit(0).alias("pos"))
    lists = kept(rare.unionByName(shared_only(common.unionByName(subsets))), "lists")

    links = spark.createDataFrame([], "a long, b long")
    tried, labels, first = None, None, True
    while True:
        if labels is None:
            left = lists.withColumn("c", F.col("doc_id"))
        else:
            left = lists.join(labels, lists.doc_id == labels.node, "left").select("key", "doc_id", "n", "r", "pos", F.coalesce("component", "doc_id").alias("c"))
        pairs = hub_pairs(left, first, percent)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = kept(pairs, "pairs")
        if pairs.isEmpty():
            break
        found = kept(verified(pairs, docs, k, percent), "verified")
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = links.unionByName(found.where("linked").select("a", "b"))
        labels = kept(components(links), "labels")
        first = False

    if labels is None:
        labels = spark.createDataFrame([], "node long, component long")
    moved = classes.join(labels, classes.rep == labels.node, "left").where("copies > 1 or component is not null").select("n", "s1", "s2", F.coalesce("component", "rep").alias("component"))
    out = rows.join(moved, ["n", "s1", "s2"], "left")
    named = lambda c: F.when(c < NO_ID, c) if nameless else c
    out = out.select(named(F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"), named(F.coalesce("component", "doc_id")).alias("component_id"))
    if numbers is not None:
        for c in ("doc_id", "component_id"):
            out = out.join(numbers.select(F.col("doc_id").alias("_id"), F.col("number").alias(c)), c, "left").withColumn(c, F.col("_id")).drop("_id")
    return out.select("doc_id", "n_shingles", "component_id")


def shared_only(keys: DataFrame) -> DataFrame:
    """Rows of keys that more than one document has, without gathering a key's rows in one task."""
    many = keys.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("key")
    return keys.join(many, "key", "left_semi").select("key", "doc_id", "n", "r", "pos")


def may_link(n: str, at: str, m: str, other: str, percent: int = PERCENT) -> Column:
    """Whether sets of n and m shingles can link if this is their first common shingle, at these places in the order.

    If it isn't the first, the list of the first one has the pair. The overlap is at most what is left of either set.
    """
    left = F.least(F.col(n) - F.col(at), F.col(m) - F.col(other))
    return left * (100 + percent) >= (F.col(n) + F.col(m)) * percent


def hub_pairs(members: DataFrame, first: bool, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) of a list's hubs with its members in other components.

    First, the hub is the member with the fewest rare shingles, which most copies are near to. Later, hubs are the members
    outside the list's largest component; the caller drops pairs tried before and comes back until none is left.
    """
    hub = F.struct("r", "doc_id", "n", "c", "pos")
    if first:
        hubs = members.groupBy("key").agg(F.min(hub).alias("h")).select("key", "h.*")
    else:
        sides = members.groupBy("key", "c").agg(F.count("*").alias("m"))
        largest = sides.groupBy("key").agg(F.max(F.struct("m", F.col("c").alias("top"))).alias("s"), F.count("*").alias("parts")).where("parts > 1").select("key", "s.top")
        hubs = members.join(largest, "key").where("c <> top").select("key", "doc_id", "n", "c", "pos")
    hubs = hubs.select("key", F.col("doc_id").alias("a"), F.col("n").alias("an"), F.col("c").alias("ac"), F.col("pos").alias("apos"))
    joined = members.join(hubs, "key").where((F.col("c") != F.col("ac")) & may_link("n", "pos", "an", "apos", percent))
    return joined.select(F.least("a", "doc_id").alias("a"), F.greatest("a", "doc_id").alias("b")).distinct()


def sql(table: str = "documents") -> str:
    """The same groups in DuckDB's SQL, for ids that stand once: shared shingles of all pairs counted, then whatever links reach."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS w FROM {table}),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {WORDS} THEN list_transform(range(1, len(w) - {WORDS - 2}), lambda i: array_to_string(w[i : i + {WORDS - 1}], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM pair JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= {PERCENT} * (a.n + b.n - c)),
reach(doc_id, to_id) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, y FROM reach JOIN link ON x = to_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id"""
