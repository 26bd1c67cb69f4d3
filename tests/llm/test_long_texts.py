"""Long texts take memory of a small multiple of their bytes, and give what they give whole."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from mossgrid.llm import common, imatch, langid, lexical, shingles


def made(n, seed=1):
    draw = random.Random(seed)
    parts = [draw.choice(["kala", "MANA", "\u00e9t\u00e9", "x9", "\n", " ", "--", "\u03a3", "\U0001f600"]) + draw.choice(["", " ", "  "]) for _ in range(n)]
    return "".join(parts) + draw.choice(["", " ", "end"])


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1000])
def test_language_counts_in_slices(size, monkeypatch):
    for seed in range(12):
        text = made(seed * 9, seed)
        whole, _ = langid.features([text])
        monkeypatch.setattr(langid, "SLICE", size)
        assert (langid.long_counts(text) == np.bincount(whole, minlength=1 << langid.BITS)).all()
        monkeypatch.undo()


@pytest.mark.parametrize("size", [1, 5, 64, 1000])
def test_words_in_slices(size, monkeypatch):
    for seed in range(8):
        column = pa.array([made(200, seed) + "w" * 300], pa.string())
        data, offsets = common.buffer(column)
        want = shingles.shingle_sets(column), imatch.terms(column), list(lexical.term_spans(pa.record_batch({"text": column}), "text"))
        spans = sorted(bytes(low[a:b]) for low, starts, ends, _ in want[2] for a, b in zip(starts, ends, strict=True))
        monkeypatch.setattr(common, "BATCH_BYTES", size)
        for is_word in (common.NOT_SPACE, lexical.IS_TERM):
            parts = list(common.slices(data, offsets, is_word))
            assert b"".join(p.tobytes() for p, *_ in parts) == data.tobytes() and all(len(p) for p, *_ in parts)
        assert all((a == b).all() for got, old in zip((shingles.shingle_sets(column), imatch.terms(column)), want, strict=False) for a, b in zip(got, old, strict=True))
        got = sorted(bytes(low[a:b]) for low, starts, ends, _ in lexical.term_spans(pa.record_batch({"text": column}), "text") for a, b in zip(starts, ends, strict=True))
        assert got == spans
        monkeypatch.undo()


def test_memory_follows_the_text():
    """20 MB of words: what each of these takes beside the text, in bytes a byte of text."""
    text = " ".join(f"word{k % 977} kala{k % 13}" for k in range(1_450_000))
    column = pa.array([text], pa.string())
    words = np.sort(np.unique(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64)))
    taken = {}
    for name, run in {"language": lambda: langid.long_counts(text), "shingles": lambda: shingles.shingle_sets(column), "terms": lambda: imatch.terms(column, words)}.items():
        tracemalloc.start()
        run()
        taken[name] = tracemalloc.get_traced_memory()[1] / len(text)
        tracemalloc.stop()
    assert taken["language"] < 8 and taken["shingles"] < 14 and taken["terms"] < 4, taken
