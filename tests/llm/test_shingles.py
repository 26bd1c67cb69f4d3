import random
import re

from mossgrid.llm import shingles
from mossgrid.llm.shingles import jaccard_groups

SCHEMA = "doc_id long, text string, lang string, n_shingles long"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    sets = []
    for i, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
        sets.append((i, {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()))
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, s), (j, t) = sets[a], sets[b]
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets)


def got(spark, rows):
    return sorted(tuple(r) for r in jaccard_groups(spark.createDataFrame(rows, SCHEMA)).collect())


def test_against_brute_force(spark):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for base in range(40):
        n = draw.choice([1, 2, 4, 5, 6, 8, 9, 10, 12, 13, 14, 20, 40, 200])
        text = [draw.choice(words) for _ in range(n)]
        for _ in range(draw.choice([1, 2, 3, 8])):
            copy = list(text)
            for _ in range(draw.choice([0, 0, 1, 2, 6])):
                at = draw.randrange(len(copy))
                draw.choice([lambda: copy.__setitem__(at, "X"), lambda: copy.insert(at, draw.choice(words)), lambda: copy.append("end")])()
            rows.append((len(rows), draw.choice([" ", "\n", "\t "]).join(copy), "en", 0))
    rows += [(900, None, None, None), (901, "", "en", 1), (902, " \n", None, 1), (903, "A b C d E", None, 1), (904, "a B c D e", None, 1), (905, "ÄB c d e f", None, 1), (906, "äb c d e f", None, 1)]
    rows += [(910, "long " * 30000, None, 1), (911, "Long " * 29000, None, 1)] + [rows[3], rows[3]]
    assert got(spark, rows) == brute(rows)


def test_light_boundaries(spark, monkeypatch):
    draw = random.Random(6)
    for light in (0, 9, 24):
        monkeypatch.setattr(shingles, "boundary", lambda *_, light=light: light)
        rows = []
        for _ in range(25):
            text = [draw.choice("abcdefghijklmnop") for _ in range(draw.randrange(5, 20))]
            rows += [(len(rows), " ".join(text), None, None), (len(rows) + 1, " ".join([*text, "z"]), None, None)]
        assert got(spark, rows) == brute(rows)


def test_subsets_are_shared_by_linked_sets():
    for s in range(1, 20):
        for t in range(s, s * 100 // 80 + 1):
            need = -(-80 * (s + t) // 180)  # overlap of a linked pair
            c = shingles.least_overlap(t)
            assert need > s or (c in shingles.subset_sizes(s) and c in shingles.subset_sizes(t) and c <= need)


def test_empty_table_and_null_ids(spark):
    assert got(spark, []) == []
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(None, "q"), (4, "r"), (None, "r"), (None, long), (9, long + " end"), (None, long + " end end"), (None, "s t"), (None, "s  t"), (None, None)]
    found = [tuple(r) for r in jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(map(str, found)) == sorted(map(str, [(None, 1, None), (4, 1, 4), (None, 1, 4), (None, 36, 9), (9, 37, 9), (None, 38, 9), (None, 1, None), (None, 1, None), (None, 0, None)]))


def test_any_id(spark):
    """Ids up to the largest long keep their id and component, beside rows without one."""
    top, text = (1 << 63) - 1, "one two three four five six seven"
    rows = [(top, text), (1 << 62, text + " eight"), (top - 5, "else " * 9), (-(1 << 63), "quite another text of more words"), (None, text), (None, "alone here now"), (None, "quite another text of more words")]
    rows = [(i, t, None, 0) for i, t in rows]
    result = sorted(jaccard_groups(spark.createDataFrame(rows, SCHEMA)).collect(), key=str)
    # 3 of 4 shingles are too few to link.
    want = [(None, 3, top), (None, 1, None), (None, 2, -(1 << 63)), (top, 3, top), (1 << 62, 4, 1 << 62), (top - 5, 1, top - 5), (-(1 << 63), 2, -(1 << 63))]
    assert sorted(map(str, map(tuple, result))) == sorted(map(str, want))
    named = [r for r in rows if r[0] is not None]
    assert sorted(map(tuple, got(spark, named))) == sorted(x for x in want if x[0] is not None)


def test_one_hub_of_many(spark, monkeypatch):
    """A hub's pairs are compared in parts, its text once in each."""
    monkeypatch.setattr(shingles, "PART_PAIRS", 16)
    base = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join([*base, f"x{i}"]), "en", 0) for i in range(300)] + [(400, " ".join(base[:30] + [f"y{k}" for k in range(30)]), "en", 0)]
    assert got(spark, rows) == brute(rows)
