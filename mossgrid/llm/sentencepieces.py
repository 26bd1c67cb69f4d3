"""SentencePiece encoding and decoding with N-best segmentation.

Each stretch of text is a lattice of vocabulary pieces. Forward Viterbi scores give the best way to reach each place; going
back from the end, they are exact heuristics, so an A-star search takes complete segmentations off its agenda in order of
their scores. No piece holds a space mark after another character, nor a line end, so a text's lattice falls apart into
stretches that are solved once and kept; the text's N best are merged from those of its stretches, exactly.

The vocabulary's file is a parameter. Its pieces are in order of frequency, and a piece's score follows Zipf's law by its
place there; scores are whole numbers in units of 2**-20. Characters without a piece become byte pieces.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

from mossgrid.llm.common import pieces as batches_of
from mossgrid.llm.common import prepare

UNIT = 1 << 20
MARK = "▁"
STRETCH = re.compile(r"\n|▁*[^▁\n]+|▁+")
MOST_KEPT = 200_000
LONGEST = 64
SOLVED_AT_ONCE = 8192
NONE = -(1 << 30)
NO_OTHER = 1 << 62
NBEST = 4
PATHS = "array<struct<score:double,n_pieces:int,ids:binary>>"


def stretches_of(text: str) -> list[str]:
    """The parts of STRETCH. Splitting at a mark finds them too, unless spaces stand together, and is faster."""
    if not text:
        return []
    if "  " in text or MARK in text or "\0" in text or text[0] == " ":
        return STRETCH.findall(MARK + text.replace(" ", MARK))
    parts = (MARK + text.replace(" ", "\0" + MARK).replace("\n", "\0\n\0")).split("\0")
    return [x for x in parts if x] if "\n" in text else parts


def grown(h: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Hashes of strings made longer by a code point."""
    h = (h ^ (points.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def utf32(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class HashTable:
    """Pieces and their prefixes by the hash of their code points, for many strings at once; sorted, with the first place of each bucket."""

    BITS = 20

    def __init__(self, pieces: dict[str, tuple[int, int]], prefixes: set[str]) -> None:
        names = sorted(prefixes, key=len)
        lengths = np.fromiter(map(len, names), np.int64, len(names))
        points, at = utf32("".join(names)), np.cumsum(lengths) - lengths
        hashes, live = np.zeros(len(names), np.uint64), np.arange(len(names))
        for k in range(int(lengths.max(initial=0))):
            live = live[lengths[live] > k]
            hashes[live] = grown(hashes[live], points[at[live] + k])
        order = np.argsort(hashes)
        if len(names) > 1 and (np.diff(hashes[order]) == 0).any():
            raise ValueError("two pieces share a hash")
        found = [pieces.get(names[k], (-1, NONE)) for k in order.tolist()]
        self.hash = np.append(hashes[order], np.uint64(0))
        self.id, self.score = np.array([*(x[0] for x in found), -1], np.int32), np.array([*(x[1] for x in found), NONE], np.int32)
        self.first = np.searchsorted(self.hash[:-1] >> np.uint64(64 - self.BITS), np.arange((1 << self.BITS) + 1, dtype=np.uint64)).astype(np.int32)
        self.deepest = int(np.diff(self.first).max(initial=0))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Places in id and score; the last place for strings that no piece starts with."""
        bucket = (h >> np.uint64(64 - self.BITS)).astype(np.int64)
        at, out = self.first[bucket], np.full(len(h), len(self.id) - 1, np.int64)
        left = np.flatnonzero(self.first[bucket + 1] > at)
        for _ in range(self.deepest):
            k = at[left]
            hit = self.hash[k] == h[left]
            out[left[hit]] = k[hit]
            left = left[~hit]
            at[left] += 1
        return out


def solve_many(v: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """best_and_gap of many short stretches at once: ids, how many each has, totals, gaps, and whether each could be solved (no byte pieces needed).

    Viterbi scores of the best and the second best way to each place go forward, for all stretches together. Of equal
    ways the one whose last piece is shorter is the best.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(-lengths, kind="stable")  # stretches of at least j characters are the first ones
    points = utf32("".join([words[k] for k in order.tolist()]))
    n, size, many = lengths[order], len(points), len(words)
    at = np.cumsum(n) - n
    owner = np.repeat(np.arange(many), n)
    room = (at + n)[owner] - np.arange(size)  # characters from here to the end of the stretch
    arcs, live, h, k = [], np.arange(size), np.zeros(size, np.uint64), 0
    while len(live):
        k += 1
        inside = room[live] >= k
        live, h = live[inside], h[inside]
        h = grown(h, points[live + k - 1])
        entry = v.table.find(h)
        known = entry < len(v.table.id) - 1
        live, h, entry = live[known], h[known], entry[known]
        arcs.append((live + owner[live], entry))
    # Places are numbered through all stretches with one more for each end, after as many as the longest piece has characters.
    most = len(arcs)
    gain, piece = np.full((most + size + many, most), NONE, np.int32), np.full((most + size + many, most), -1, np.int32)
    for k, (start, entry) in enumerate(arcs):
        gain[most + start + k + 1, k], piece[most + start + k + 1, k] = v.table.score[entry], v.table.id[entry]
    begin = most + at + np.arange(many)
    best, second = (np.full(most + size + many, NONE, np.int32) for _ in range(2))  # a stretch of LONGEST characters stays above NONE, twice NONE is no overflow
    taken, pieces = (np.zeros(most + size + many, np.int64) for _ in range(2))
    best[begin] = 0
    longest = int(n[0]) if many else 0
    upto = np.searchsorted(-n, -np.arange(1, longest + 1), "right")
    rows, back = np.arange(many), np.arange(1, most + 1)
    for j in range(1, longest + 1):
        to, k = begin[: upto[j - 1]] + j, min(most, j)
        come, won = to[:, None] - back[:k], gain[to, :k]
        ways = best[come] + won
        top, row = ways.argmax(axis=1), rows[: len(to)]
        best[to] = np.maximum(ways[row, top], NONE)
        ways[row, top] = NONE
        second[to] = np.maximum(np.maximum(ways, second[come] + won).max(axis=1), NONE)
        taken[to], pieces[to] = top + 1, pieces[come[row, top]] + 1
    ends = begin + n
    solved, total = best[ends] > NONE, best[ends].astype(np.int64)
    gap = np.where(second[ends] > NONE, total - second[ends], NO_OTHER)
    counts = np.zeros(many, np.int64)
    counts[order] = np.where(solved, pieces[ends], 0)
    out = np.empty(int(counts.sum()), np.int32)
    last = np.cumsum(counts)[order] - 1
    left = np.flatnonzero(solved)
    place = ends[left]
    while len(left):
        step = taken[place]
        out[last[left]] = piece[place, step - 1]
        last[left] -= 1
        place = place - step
        more = place > begin[left]
        left, place = left[more], place[more]
    undo = np.empty_like(order)
    undo[order] = np.arange(many)
    return out, counts, total[undo], gap[undo], solved[undo]


class Vocabulary:
    """Pieces with whole-number scores. ids are the file's."""

    def __init__(self, names: list[str], kinds: list[str]) -> None:
        self.names, self.kinds = names, kinds
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(names, kinds, strict=True)) if k == "byte"}
        place = 0
        self.score: dict[str, tuple[int, int]] = {}
        for i, (p, k) in enumerate(zip(names, kinds, strict=True)):
            if k == "piece":
                place += 1
                self.score.setdefault(p, (i, -round(UNIT * math.log(place + 1))))
        self.unknown = -round(UNIT * math.log(place + 2)) - UNIT
        if any("\n" in p or MARK in p.lstrip(MARK) for p in self.score):
            raise ValueError("a piece spans stretches")
        self.starts = {p[:k] for p in self.score for k in range(1, len(p) + 1)}
        self.longest = max(map(len, self.score), default=1)
        self.table = HashTable(self.score, self.starts)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        kind = lambda i: "byte" if model.is_byte(i) else "other" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "piece"
        return cls([model.id_to_piece(i) for i in range(n)], [kind(i) for i in range(n)])

    def lattice(self, text: str) -> list[list[tuple[int, tuple[int, ...], int]]]:
        """For each end, the pieces that end there: (start, ids, score)."""
        ends: list[list] = [[] for _ in range(len(text) + 1)]
        get, starts = self.score.get, self.starts
        for i, c in enumerate(text):
            if c not in starts or c not in self.score:
                if c not in self.score:
                    raw = c.encode("utf-8", "surrogatepass")
                    ends[i + 1].append((i, tuple(self.bytes[b] for b in raw), self.unknown * len(raw)))
                if c not in starts:
                    continue
            j = i + 1
            while j <= len(text) and (part := text[i:j]) in starts:
                hit = get(part)
                if hit is not None:
                    ends[j].append((i, (hit[0],), hit[1]))
                j += 1
        return ends


def forward(ends: list) -> list[int]:
    """Viterbi scores of the best way from the start to each place."""
    best = [0] * len(ends)
    for j in range(1, len(ends)):
        best[j] = max(best[i] + s for i, _, s in ends[j])
    return best


class Step:
    """An arc of the lattice after the way from the text's end to it, which is found by parent links. Ways are ordered as tuples of their arcs' ids from the end; jump links meet where two ways part in logarithmic time."""

    __slots__ = ("at", "depth", "gone", "ids", "jump", "up")

    def __init__(self, up: Step | None, ids: tuple[int, ...], at: int, gone: int) -> None:
        self.up, self.ids, self.at, self.gone = up, ids, at, gone
        if up is None:
            self.depth, self.jump = 0, self
        else:
            over = up.jump
            self.depth = up.depth + 1
            self.jump = over.jump if up.depth - over.depth == over.depth - over.jump.depth else up

    def above(self, depth: int) -> Step:
        x = self
        while x.depth > depth:
            x = x.jump if x.jump.depth >= depth else x.up
        return x

    def __lt__(self, other: Step) -> bool:
        depth = min(self.depth, other.depth)
        x, y = self.above(depth), other.above(depth)
        if x is y:
            return self.depth < other.depth
        while x.up is not y.up:
            x, y = (x.up, y.up) if x.jump is y.jump else (x.jump, y.jump)
        return x.ids < y.ids

    def way(self) -> tuple[int, ...]:
        """The pieces of the way, in the text's order."""
        out, x = [], self
        while x.up is not None:
            out += x.ids
            x = x.up
        return tuple(out)


def n_best(ends: list, n: int, best: list[int] | None = None) -> list[tuple[int, tuple[int, ...]]]:
    """The n best segmentations as (score, ids), best first; equal scores in order of their ids from the end."""
    best = best or forward(ends)
    agenda = [(-best[-1], Step(None, (), len(ends) - 1, 0))]
    out = []
    while agenda and len(out) < n:
        f, step = heapq.heappop(agenda)
        if step.at == 0:
            out.append((-f, step.way()))
            continue
        gone = step.gone
        for i, ids, s in ends[step.at]:
            heapq.heappush(agenda, (-(best[i] + s + gone), Step(step, ids, i, gone + s)))
    return out


def best_and_gap(ends: list) -> tuple[int, tuple[int, ...], int | None]:
    """The best segmentation and how much the second falls behind (None if there is none). Of equal ones, that whose last pieces are shorter."""
    best = forward(ends)
    n = len(ends) - 1
    back = [None] * n + [0]
    for j in range(n, 0, -1):
        for i, _, s in ends[j]:
            if back[j] is not None and (back[i] is None or back[j] + s > back[i]):
                back[i] = back[j] + s
    at, ids, gap, total = n, [], None, best[n]
    on_path: set[tuple[int, tuple]] = set()
    while at:
        i, part, s = min((x for x in ends[at] if best[x[0]] + x[2] == best[at]), key=lambda x: -x[0])
        on_path.add((at, part))
        ids.append(part)
        at = i
    for j in range(1, n + 1):
        for i, part, s in ends[j]:
            if (j, part) not in on_path and back[j] is not None:
                lost = total - (best[i] + s + back[j])
                gap = lost if gap is None or lost < gap else gap
    return total, tuple(x for part in reversed(ids) for x in part), gap


class Encoder:
    """Encodes whole texts; solved stretches are kept, up to a number."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v, self.more = vocabulary, {}
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.start, self.count, self.totals, self.gaps = (np.zeros(0, np.int64) for _ in range(4))

    def solve(self, new: list[str]) -> None:
        """Solves stretches not met before: short ones together, long ones and those with byte pieces one by one."""
        short = [x for x in new if len(x) <= LONGEST]
        alone = [x for x in new if len(x) > LONGEST]
        for first in range(0, len(short), SOLVED_AT_ONCE):
            part = short[first : first + SOLVED_AT_ONCE]
            ids, counts, totals, gaps, solved = solve_many(self.v, part)
            if not solved.all():
                alone += [part[k] for k in np.flatnonzero(~solved).tolist()]
                part, counts, totals, gaps = [part[k] for k in np.flatnonzero(solved).tolist()], counts[solved], totals[solved], gaps[solved]
            self.keep(part, ids, counts, totals, gaps)
        if alone:
            found = [best_and_gap(self.v.lattice(x)) for x in alone]
            counts = [len(ids) for _, ids, _ in found]
            self.keep(alone, np.array([i for _, ids, _ in found for i in ids], np.int32), np.array(counts), np.array([x[0] for x in found]), np.array([NO_OTHER if x[2] is None else x[2] for x in found]))

    def keep(self, names: list[str], ids: np.ndarray, counts: np.ndarray, totals: np.ndarray, gaps: np.ndarray) -> None:
        base, held = len(self.at), len(self.ids)
        self.at.update(zip(names, range(base, base + len(names)), strict=True))
        self.ids = np.concatenate((self.ids, ids))
        self.start = np.concatenate((self.start, held + np.cumsum(counts) - counts))
        self.count, self.totals, self.gaps = (np.concatenate(x) for x in ((self.count, counts), (self.totals, totals), (self.gaps, gaps)))

    def others(self, stretch: str, n: int) -> list[tuple[int, bytes]]:
        """Segmentations after the best, by A-star search: (loss, ids)."""
        key = (stretch, n)
        if key not in self.more:
            if len(self.more) >= MOST_KEPT // 20:
                self.more.clear()
            k = self.at[stretch]
            own = self.ids[self.start[k] : self.start[k] + self.count[k]].tobytes()
            found = [(int(self.totals[k]) - s, np.array(ids, "<i4").tobytes()) for s, ids in n_best(self.v.lattice(stretch), n)]
            same = next((i for i, x in enumerate(found) if x[1] == own), 0)
            self.more[key] = found[:same] + found[same + 1 :]
        return self.more[key]

    def encode(self, text: str, n: int = NBEST) -> list[tuple[float, bytes]]:
        return self.encode_all([text], n)[0]

    def encode_all(self, texts: list[str], n: int = NBEST) -> list[list[tuple[float, bytes]]]:
        """The n best segmentations of each text as (score, little-endian 32-bit ids). An empty text has one, without pieces."""
        split = [stretches_of(x) for x in texts]
        flat = list(chain.from_iterable(split))
        if len(self.at) >= MOST_KEPT:
            self.clear()
        own: dict = dict.fromkeys(flat)  # most stretches stand in a batch several times
        own.update(zip(own, list(map(self.at.get, own)), strict=True))
        new = [x for x, k in own.items() if k is None]
        self.solve(new)
        own.update(zip(new, map(self.at.__getitem__, new), strict=True))
        at = np.fromiter(map(own.__getitem__, flat), np.int64, len(flat))
        counts, gaps, totals = self.count[at], self.gaps[at], self.totals[at]
        ends = np.concatenate(([0], np.cumsum(counts)))
        ids = self.ids[np.arange(ends[-1]) + np.repeat(self.start[at] - ends[:-1], counts)].astype("<i4").tobytes()
        out, b = [], 0
        for stretches in split:
            a, b = b, b + len(stretches)
            whole, places = ids[4 * ends[a] : 4 * ends[b]], 4 * (ends[a : b + 1] - ends[a])
            out.append(self.ways(stretches, whole, places, int(totals[a:b].sum()), gaps[a:b], n))
        return out

    def ways(self, stretches: list[str], whole: bytes, places: np.ndarray, total: int, gaps: np.ndarray, n: int) -> list[tuple[float, bytes]]:
        """The best segmentation of a text and, merged from those of its stretches, the next ones. places: where the stretches' ids begin, and the end."""
        out = [(total / UNIT, whole)]
        if n == 1 or not stretches:
            return out
        # Any of the n best differs from the best only in the n - 1 stretches that lose least.
        least = np.argpartition(gaps, n - 2)[: n - 1] if len(gaps) >= n else np.arange(len(gaps))
        edge = gaps[least].max()
        under = np.flatnonzero(gaps < edge)
        where = sorted([*under.tolist(), *np.flatnonzero(gaps == edge)[: len(least) - len(under)].tolist()])
        ways = [(0, ())]
        for k in where:
            more = self.others(stretches[k], n) if gaps[k] < NO_OTHER else []
            ways = heapq.nsmallest(n, ways + [(loss + a, (*change, (k, ids))) for loss, change in ways for a, ids in more])
        for loss, change in ways[1:]:
            parts, at = [], 0
            for k, ids in change:
                parts += [whole[at : places[k]], ids]
                at = places[k + 1]
            out.append(((total - loss) / UNIT, b"".join([*parts, whole[at:]])))
        return out


class Decoder:
    """Texts of ids: marks become spaces, runs of byte pieces UTF-8 (damaged bytes U+FFFD); the leading space that encoding adds goes."""

    def __init__(self, names: list[str], byte_of: dict[int, int]) -> None:
        self.byte_of = byte_of
        self.names = [chr(byte_of[i]) if byte_of.get(i, 128) < 128 else p.replace(MARK, " ") for i, p in enumerate(names)]
        self.high = np.array([byte_of.get(i, 0) >= 128 for i in range(len(names))])

    def decode(self, ids: np.ndarray) -> str:
        names = self.names
        if not self.high[ids].any():
            return "".join([names[i] for i in ids.tolist()]).removeprefix(" ")
        out, run = [], bytearray()
        for i in ids.tolist():
            if self.high[i]:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            out.append(names[i])
        out.append(run.decode("utf-8", "replace"))
        return "".join(out).removeprefix(" ")


def encode_texts(df: DataFrame, path: str, text: str = "text", n: int = NBEST, column: str = "nbest", decoded: str | None = None) -> DataFrame:
    """Adds nbest, the n best segmentations of each whole text, best first: score, n_pieces and ids (little-endian 32-bit).

    Null texts have null, empty ones one empty segmentation. A text with fewer segmentations has fewer. The vocabulary is
    read once on the driver and broadcast (its size is the file's). An earlier column of the name is replaced. decoded: a
    column for the text that the best segmentation decodes to, in the same pass (as decode_ids() gives it).
    """
    prepare(df.sparkSession)
    df = df.drop(column, *([decoded] if decoded else []))
    v = Vocabulary.load(path)
    shared = df.sparkSession.sparkContext.broadcast((v.names, v.kinds))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Vocabulary(*shared.value)
        encoder, decoder = Encoder(own), Decoder(own.names, {i: b for b, i in own.bytes.items()})
        for batch in batches_of(batches, text):
            texts = batch.column(text)
            found = encoder.encode_all([x or "" for x in texts.to_pylist()], n)
            flat = list(chain.from_iterable(found))
            ids = pa.array([x for _, x in flat], pa.binary())
            ways = pa.StructArray.from_arrays([pa.array([x for x, _ in flat], pa.float64()), pa.array([len(x) // 4 for _, x in flat], pa.int32()), ids], ["score", "n_pieces", "ids"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(x) for x in found]))), pa.int32()), ways)
            if texts.null_count:
                lists = pa.compute.if_else(texts.is_valid(), lists, pa.scalar(None, lists.type))
            more, names = [lists], [column]
            if decoded:
                back = (decoder.decode(np.frombuffer(ways[0][1], "<i4")) for ways in found)
                more.append(pa.array([x if t else None for t, x in zip(texts.is_valid().to_pylist(), back, strict=True)] if texts.null_count else list(back), pa.string()))
                names.append(decoded)
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(encode, f"{fields}, `{column}` {PATHS}" + (f", `{decoded}` string" if decoded else ""))


def decode_ids(df: DataFrame, path: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """Adds the text of a column of little-endian 32-bit ids; null stays null. A mark character in a text comes back as a space."""
    prepare(df.sparkSession)
    df = df.drop(column)
    v = Vocabulary.load(path)
    shared = df.sparkSession.sparkContext.broadcast((v.names, {i: b for b, i in v.bytes.items()}))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(*shared.value)
        for batch in batches_of(batches, ids):
            texts = [None if x is None else decoder.decode(np.frombuffer(x, "<i4")) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, column])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(read, f"{fields}, `{column}` string")
