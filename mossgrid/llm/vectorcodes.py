"""Vector code compression: product-quantisation codes from member-resident Lloyd rounds in whole numbers.

A vector is cut into equal parts, and every part belongs to the owner of (position, entry, salt) in a partitioned RDD of
numpy blocks. In a round owners add up their resident members, entries move to their members' mean, and members look for
their nearest entry where they lie; only parts whose entry changes go through the next shuffle. Residents stay, since both
sides of the union have one partitioner. Blocks are cached on the executors; a lost one is made again from its lineage,
which is as long as the rounds. Codebooks (entries x dimensions whole numbers) are all that reaches the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mossgrid.llm.common import kept, mix, release

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Parts that a partition of owners holds, and those of a batch that become blocks together.
PARTS_A_TASK = 200_000
BATCH_PARTS = 100_000
#: Whole numbers up to this size are exact in double products; beyond it Python's whole numbers are used.
EXACT = 1 << 53
LONG = 1 << 63


def usable(embeddings: DataFrame, id_col: str, vector_col: str, parts: int) -> tuple[DataFrame, int]:
    """(_row, _id, _label, _vector) of the rows that can be cut, written down, and the vectors' length.

    Whole numbers stand in doubles, which hold them exactly. Products by SCALE that a double can't hold stand at its largest.
    """
    sound = F.col(vector_col).isNotNull() & ~F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    big = 1.7976931348623157e308
    scaled = F.transform(vector_col, lambda x: F.greatest(F.least(x.cast("double") * SCALE, F.lit(big)), F.lit(-big)))
    # Doubles from 2^52 on are whole already; Spark's floor gives longs.
    floors = F.transform(scaled, lambda x: F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x))
    label = F.col("label") if "label" in embeddings.columns else F.lit(None).cast("int")
    rows = embeddings.where(sound).select(F.col(id_col).alias("_id"), label.alias("_label"), floors.alias("_vector")).withColumn("_row", F.monotonically_increasing_id())
    rows = kept(rows, "vectors")
    first = rows.orderBy(F.asc_nulls_last("_id"), "_vector").select(F.size("_vector").alias("n")).first()
    n = first.n if first else 0
    return rows.where(F.size("_vector") == n) if n and n % parts == 0 else rows.limit(0), n


class Codebooks:
    """Entries of every position as whole numbers, exact whatever their size."""

    def __init__(self, entries: list[list[list[int]]], largest: int) -> None:
        self.entries = entries
        self.width = len(entries[0][0]) if entries and entries[0] else 0
        self.fast = self.width * (2 * largest + 2) ** 2 < EXACT
        self.tables = [np.array(x, float).reshape(-1, self.width) for x in entries] if self.fast else None

    def nearest(self, position: int, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each member (lowest of equals) and its squared distance; a distance beyond a long is -1."""
        if self.fast:
            table = self.tables[position]
            apart = (members * members).sum(axis=1)[:, None] - 2 * members @ table.T + (table * table).sum(axis=1)[None]
            best = apart.argmin(axis=1)
            return best.astype(np.int32), apart[np.arange(len(best)), best].astype(np.int64)
        found = []
        for row in members.tolist():
            row = [int(x) for x in row]
            found.append(min((sum((x - c) ** 2 for x, c in zip(row, entry, strict=True)), k) for k, entry in enumerate(self.entries[position])))
        return np.array([k for _, k in found], np.int32), np.array([d if d < LONG else -1 for d, _ in found], np.int64)

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(x) for book in self.entries for entry in book for x in entry).encode()).hexdigest()


def owner(key: tuple[int, int, int]) -> int:
    """A number spread over all owners; partitions are that number modulo their count."""
    position, entry, salt = key
    return int(mix(np.array([position << 48 | entry << 32 | salt], np.uint64))[0] >> np.uint64(1))


def blocks(position: int, entries: np.ndarray, salts: int, rows: np.ndarray, members: np.ndarray) -> Iterator[tuple]:
    """((position, entry, salt), (rows, members)): the members by owner; a row's salt never changes."""
    salt = (mix(rows.view(np.uint64)) % np.uint64(salts)).astype(np.int64)
    order = np.lexsort((salt, entries))
    e, s = entries[order], salt[order]
    cuts = np.flatnonzero(np.concatenate(([True], (e[1:] != e[:-1]) | (s[1:] != s[:-1])))) if len(e) else np.zeros(0, np.int64)
    for start, end in zip(cuts, [*cuts[1:], len(e)], strict=True):
        at = order[start:end]
        yield (position, int(e[start]), int(s[start])), (rows[at], members[at])


def placed(rows: DataFrame, books: Codebooks, parts: int, salts: int, partitions: int) -> RDD:
    """Every part at its first owner."""
    there = rows.sparkSession.sparkContext.broadcast(books)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            whole_vectors = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
            width = whole_vectors.shape[1] // parts
            for position in range(parts):
                members = np.ascontiguousarray(whole_vectors[:, position * width : (position + 1) * width])
                found = list(blocks(position, there.value.nearest(position, members)[0], salts, ids, members))
                if found:
                    keys, values = zip(*found, strict=True)
                    yield pa.record_batch({"key": pa.array([list(k) for k in keys], pa.list_(pa.int64())), "rows": pa.array([v[0].tobytes() for v in values], pa.binary()), "members": pa.array([v[1].tobytes() for v in values], pa.binary())})
        release()

    cut_rows = rows.select("_row", "_vector").mapInArrow(cut, "key array<long>, rows binary, members binary")
    width = books.width
    pairs = cut_rows.rdd.map(lambda r: (tuple(r.key), (np.frombuffer(r.rows, np.int64), np.frombuffer(r.members, float).reshape(-1, width))))
    return pairs.partitionBy(partitions, owner)


def joined_blocks(blocks_: Iterator[tuple]) -> Iterator[tuple]:
    """One block for each owner of a partition: residents and those that came."""
    by: dict[tuple, list] = {}
    for key, block in blocks_:
        by.setdefault(key, []).append(block)
    for key, found in by.items():
        yield key, found[0] if len(found) == 1 else tuple(np.concatenate([x[k] for x in found]) for k in (0, 1))


def means(residents: RDD, books: Codebooks, largest: int) -> Codebooks:
    """Entries moved to the floor of their members' mean; unused ones stay. A task sends one sum for each entry that it holds part of."""
    fast = books.fast

    def add(found: Iterator[tuple]) -> Iterator[tuple]:
        sums: dict[tuple, list] = {}
        for (position, entry, _), (_, members) in found:
            total = [int(x) for x in members.astype(np.int64).sum(axis=0)] if fast else [sum(int(x) for x in column) for column in members.T.tolist()]
            old = sums.get((position, entry))
            sums[position, entry] = [len(members), total] if old is None else [old[0] + len(members), [a + b for a, b in zip(old[1], total, strict=True)]]
        yield from sums.items()

    merged = residents.mapPartitions(add).reduceByKey(lambda a, b: [a[0] + b[0], [x + y for x, y in zip(a[1], b[1], strict=True)]])
    entries = [list(book) for book in books.entries]
    for (position, entry), (n, total) in merged.collect():  # entries x positions rows at most
        entries[position][entry] = [x // n for x in total]
    return Codebooks(entries, largest)


def assigned(residents: RDD, books: Codebooks) -> RDD:
    """((position, entry, salt), (rows, members, nearest entries, distances)): each owner looks up its own members."""
    there = residents.context.broadcast(books)
    look = lambda found: ((key, (rows, members, *there.value.nearest(key[0], members))) for key, (rows, members) in found)
    return residents.mapPartitions(look, preservesPartitioning=True)


def migrated(looked_up: RDD, salts: int, partitions: int) -> RDD:
    """Members at their nearest entries' owners: those whose entry is the same stay, only the others are shuffled."""

    def stay(found: Iterator[tuple]) -> Iterator[tuple]:
        for key, (rows, members, entries, _) in found:
            same = entries == key[1]
            if same.any():
                yield key, (rows[same], members[same])

    def leave(found: Iterator[tuple]) -> Iterator[tuple]:
        for key, (rows, members, entries, _) in found:
            if len(at := np.flatnonzero(entries != key[1])):
                yield from blocks(key[0], entries[at], salts, rows[at], members[at])

    residents = looked_up.mapPartitions(stay, preservesPartitioning=True)
    return residents.union(looked_up.mapPartitions(leave).partitionBy(partitions, owner)).mapPartitions(joined_blocks, preservesPartitioning=True)


def vector_codes(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every usable vector, a row for each.

    A vector is usable if it isn't null, holds no null, NaN or infinity and is as long as that of the smallest id, a length
    that `parts` divides; other rows are left out. Codebooks start from the `entries` smallest ids (no id is last, equal ids
    by their vectors), fewer if there are fewer. Repeated rows count as often as they stand. Errors beyond a long are null,
    and so is the sum over their label. An empty table gives no rows. Rounds are few: lineage is as long as they are.
    """
    spark: SparkSession = embeddings.sparkSession
    rows, length = usable(embeddings, id_col, vector_col, parts)
    count, top = rows.agg(F.count("*"), F.max(F.array_max(F.transform("_vector", F.abs)))).first()
    if not count:
        none = rows.select(F.col("_id").alias(id_col), F.col("_label").alias("label"))
        return none.select("*", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    largest, width = int(top), length // parts
    starts = [[int(x) for x in r._vector] for r in rows.orderBy(F.asc_nulls_last("_id"), "_vector").select("_vector").limit(entries).collect()]
    books = Codebooks([[x[p * width : (p + 1) * width] for x in starts] for p in range(parts)], largest)
    partitions = max(spark.sparkContext.defaultParallelism, math.ceil(parts * count / PARTS_A_TASK))
    residents, held = placed(rows, books, parts, partitions, partitions).mapPartitions(joined_blocks, preservesPartitioning=True), []
    partitions = residents.getNumPartitions()
    for number in range(1, rounds + 1):
        books = means(residents, books, largest)
        looked_up = assigned(residents, books).persist(StorageLevel.MEMORY_AND_DISK)
        held.append(looked_up)
        if number < rounds:
            residents = migrated(looked_up, partitions, partitions)

    digits = np.array([f"{k:02x}" for k in range(entries)])

    def codes(found: Iterator[tuple]) -> Iterator[tuple]:
        for (position, _, _), (ids, _, nearest, apart) in found:
            yield position, ids.tobytes(), nearest.tobytes(), apart.tobytes()

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for position, ids, nearest, apart in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                ids = np.frombuffer(ids, np.int64)
                yield pa.record_batch({"_row": pa.array(ids), "position": pa.array(np.full(len(ids), position, np.int32)), "digits": pa.array(digits[np.frombuffer(nearest, np.int32)], pa.string()), "apart": pa.array(np.frombuffer(apart, np.int64))})

    packed = spark.createDataFrame(looked_up.mapPartitions(codes), "position int, ids binary, nearest binary, apart binary")
    long = packed.mapInArrow(spread, "_row long, position int, digits string, apart long")
    by_row = long.groupBy("_row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "digits"))), lambda x: x["digits"]), "").alias("code"), F.sum("apart").alias("sum"), F.min("apart").alias("least"))
    coded = rows.select("_row", "_id", "_label").join(by_row, "_row").withColumn("error", F.when(F.col("least") >= 0, F.col("sum")))
    coded = kept(coded.select("_id", "_label", "code", "error"), "codes")
    for x in held:
        x.unpersist()
    labels = coded.groupBy(F.col("_label").alias("_l")).agg(F.sum("error").alias("label_error"), F.count_if(F.col("error").isNull()).alias("beyond"))
    out = coded.join(labels, F.col("_label").eqNullSafe(F.col("_l")))
    return out.select(F.col("_id").alias(id_col), F.col("_label").alias("label"), "code", "error", F.when(F.col("beyond") == 0, F.col("label_error")).alias("label_error"), F.lit(books.digest()).alias("codebooks_sha256"))


def sql(table: str = "embeddings", entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same in DuckDB's SQL for vectors of one length: every part against every entry, in doubles that hold whole numbers."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (SELECT row, position, min_by(entry, (d, entry)) AS entry, min(d)::BIGINT AS d FROM (SELECT p.row, p.position, b.entry, list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, b.c) + list_inner_product(b.c, b.c) AS d FROM p JOIN b{k} b ON p.position = b.position) GROUP BY row, position),""")
        if k < rounds:
            steps.append(f"""s{k} AS (SELECT position, entry, place, floor(sum(x) / count(*)) AS x FROM (SELECT a.position, a.entry, unnest(p.x) AS x, generate_subscripts(p.x, 1) AS place FROM a{k} a JOIN p ON a.row = p.row AND a.position = p.position) GROUP BY position, entry, place),
b{k + 1} AS MATERIALIZED (SELECT b.position, b.entry, coalesce(m.c, b.c) AS c FROM b{k} b LEFT JOIN (SELECT position, entry, list(x ORDER BY place) AS c FROM s{k} GROUP BY position, entry) m ON b.position = m.position AND b.entry = m.entry),""")
    return f"""
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS x FROM {table} WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT row, position, x[(position * (len(x) // {PARTS}) + 1):((position + 1) * (len(x) // {PARTS}))] AS x FROM v, range({PARTS}) AS r(position)),
b0 AS (SELECT position, row - 1 AS entry, x AS c FROM p WHERE row <= {entries}),
{chr(10).join(steps)}
c AS (SELECT row, string_agg(lower(printf('%02x', entry::INT)), '' ORDER BY position) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY row),
h AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY position, entry)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, label, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM c JOIN v ON c.row = v.row, h"""
