import heapq
import itertools
import random
import tracemalloc

import numpy as np

from mossgrid.llm.sentencepieces import MARK, NO_OTHER, STRETCH, UNIT, Decoder, Encoder, Vocabulary, best_and_gap, decode_ids, encode_texts, forward, n_best, solve_many, stretches_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def small():
    names = ["<unk>", *(f"<0x{i:02X}>" for i in range(256)), MARK, MARK * 2, MARK + "a", "a", "b", "c", "ab", "bc", "abc", MARK + "ab", "ca", "aa", "cab"]
    return Vocabulary(names, ["other"] + ["byte"] * 256 + ["piece"] * (len(names) - 257))


def every(v, text):
    ends = v.lattice(MARK + text.replace(" ", MARK))
    ways = [[(0, ())]]
    for j in range(1, len(ends)):
        ways.append([(a + s, (*ids, *part)) for i, part, s in ends[j] for a, ids in ways[i]])
    return sorted(ways[-1], key=lambda x: -x[0])


def test_n_best_against_all_segmentations():
    v, draw = small(), random.Random(3)
    for _ in range(300):
        text = "".join(draw.choice("abc é\n") for _ in range(draw.randrange(1, 12)))
        want = every(v, text)
        for n in (1, 2, 4, 9):
            got = Encoder(v).encode(text, n)
            assert [round(s * UNIT) for s, _ in got] == [s for s, _ in want[:n]]
            ids = [tuple(np.frombuffer(x, "<i4").tolist()) for _, x in got]
            assert len(set(ids)) == len(ids) and all((round(s * UNIT), x) in set(want) for (s, _), x in zip(got, ids, strict=True))
            whole = n_best(v.lattice(MARK + text.replace(" ", MARK)), n)
            assert [s for s, _ in whole] == [s for s, _ in want[:n]]


def test_many_stretches_at_once_equal_one_by_one():
    v, draw = small(), random.Random(4)
    texts = ["".join(draw.choice("abc") for _ in range(draw.randrange(1, 30))) for _ in range(100)]
    assert Encoder(v).encode_all(texts) == [Encoder(v).encode(x) for x in texts]


def test_stretches():
    draw = random.Random(8)
    for _ in range(3000):
        text = "".join(draw.choice("ab  \n\n▁\0é" if draw.random() < 0.3 else "ab \n") for _ in range(draw.randrange(12)))
        assert stretches_of(text) == (STRETCH.findall(MARK + text.replace(" ", MARK)) if text else [])


def test_stretches_at_once_equal_the_search():
    v, draw = Vocabulary.load(MODEL), random.Random(7)
    words = ["".join(draw.choice("aeinrstül▁é日") for _ in range(draw.randrange(1, 70))) for _ in range(300)]
    ids, counts, totals, gaps, solved = solve_many(v, words)
    ends = np.cumsum(counts)
    for k, word in enumerate(words):
        total, way, gap = best_and_gap(v.lattice(word))
        if solved[k]:
            assert (totals[k], tuple(ids[ends[k] - counts[k] : ends[k]].tolist()), gaps[k]) == (total, way, NO_OTHER if gap is None else gap)
        else:
            assert counts[k] == 0 and any(c not in v.score for c in word)
    assert solved.sum() > 100


def test_round_trip_with_the_public_vocabulary():
    v = Vocabulary.load(MODEL)
    decoder = Decoder(v.names, {i: b for b, i in v.bytes.items()})
    for text in ["", " ", "  two  spaces ", "Füße\n\n\tü", "日本語😀\x00\x7f", "a" * 5000, "x\r\ny", " lead", "́"]:
        for _, ids in Encoder(v).encode(text):
            assert decoder.decode(np.frombuffer(ids, "<i4")) == text


def with_whole_paths(ends, n):
    best, out = forward(ends), []
    agenda = [(-best[-1], (), len(ends) - 1, 0)]
    while agenda and len(out) < n:
        f, back, at, g = heapq.heappop(agenda)
        if at == 0:
            out.append((-f, tuple(x for part in reversed(back) for x in part)))
            continue
        for i, ids, s in ends[at]:
            heapq.heappush(agenda, (-(best[i] + s + g), (*back, ids), i, g + s))
    return out


def test_parent_links_keep_the_order_of_equal_scores():
    v, draw = small(), random.Random(5)
    v.score = {p: (i, -(1 + len(p) // 3) * 10) for p, (i, _) in v.score.items()}
    for size in (3, 9, 40, 300):
        for letters in ("a", "ab", "abc", "abcé"):
            ends = v.lattice("".join(draw.choice(letters) for _ in range(size)))
            assert n_best(ends, 9) == with_whole_paths(ends, 9)


def test_long_stretch_without_spaces_in_bounded_memory():
    v, draw = Vocabulary.load(MODEL), random.Random(6)
    text = "".join(draw.choice("abcdefghijklmnopqrstuvwxyzABCXYZ0123456789+/=(){};日本語é") for _ in range(100_000))
    ends = v.lattice(text)
    tracemalloc.start()
    found = n_best(ends, 4)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(set(found)) == 4 and [s for s, _ in found] == sorted((s for s, _ in found), reverse=True) and most < 500e6
    decoder = Decoder(v.names, {i: b for b, i in v.bytes.items()})
    coded = Encoder(v).encode(text)
    assert len(coded) == 4 and all(decoder.decode(np.frombuffer(ids, "<i4")) == text for _, ids in coded)


def test_tables(spark):
    rows = [(1, "a cab", "x"), (1, "a cab", "x"), (2, None, "y"), (None, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, nbest string")
    got = encode_texts(df, MODEL).collect()
    assert sorted((r.doc_id or 0, None if r.nbest is None else len(r.nbest)) for r in got) == [(0, 1), (1, 4), (1, 4), (2, None)]
    best = encode_texts(df, MODEL).selectExpr("text", "nbest[0].ids AS ids", "1 AS decoded")
    assert all(r.text == r.decoded for r in decode_ids(best, MODEL).collect())
    assert encode_texts(df.limit(0), MODEL).count() == 0
    assert len(list(itertools.chain(*(r.nbest or [] for r in got)))) == 9
