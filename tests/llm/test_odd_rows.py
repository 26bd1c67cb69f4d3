"""Every operator on nulls in any column, empty and very long texts, repeated rows, empty tables and clashing column names."""

import pytest
from pyspark.sql import functions as F

from mossgrid.llm import gif, imatch, langid, lexical, licenses, linededup, mixing, pagetext, queries, secrets, sentencepieces, shingles, warc

#: Names that operators use for results or inside, beside those that they replace.
CLASHES = ["media_", "frames_", "batch", "low", "words", "key", "own", "w", "at", "place", "m", "rate", "rank", "part", "bucket", "cut", "n", "s1", "s2", "rep", "component", "hub", "range", "guard", "p", "term", "rows", "page", "host", "site", "tree", "digest", "last", "salt", "file", "offset", "length", "payload", "revisit", "names", "score_", "copy", "order", "value", "col"]
LONG = "kala mana toma " * 60_000 + "password=longsecret1"


def table(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *(F.lit(k).alias(c) for k, c in enumerate(CLASHES)))


ROWS = [(1, "kala mana. Released under the MIT License", "aa", "s", 9), (1, "kala mana. Released under the MIT License", "aa", "s", 9), (2, None, None, None, None), (3, "", "aa", "s", 0), (None, "toma kala", "aa", None, 9), (None, "toma kala", "aa", None, 9), (None, None, None, None, None), (4, LONG, "aa", "s", len(LONG)), (5, " \n\t", None, "s", 3), (6, "\x00<é> 😀", "bb", "s2", 5)]

WITH_ALL = {
    "store_texts": lambda df: gif.store_texts(df),
    "gif_frames": lambda df: gif.gif_frames(gif.store_texts(df)),
    "licenses": lambda df: licenses.scan_licenses(df),
    "mix": lambda df: mixing.mix_documents(df),
    "secrets": lambda df: secrets.scan_secrets(df),
    "lines": lambda df: linededup.dedup_lines(df),
    "masked": lambda df: secrets.scan_secrets(df, redact=True),
    "imatch": lambda df: imatch.fingerprint_documents(df, imatch.lexicon(df)),
    "language": lambda df: langid.predict(df, langid.train(df)),
    "pieces": lambda df: sentencepieces.encode_texts(df, queries.VOCABULARY),
    "decoded": lambda df: sentencepieces.decode_ids(sentencepieces.encode_texts(df, queries.VOCABULARY).selectExpr("* EXCEPT (nbest)", "nbest[0].ids AS ids"), queries.VOCABULARY),
}
PAGE = lambda df: df.selectExpr("* EXCEPT (doc_id, text, source)", "doc_id AS page_id", "source AS url", "text AS html")
OWN_COLUMNS = {
    "groups": lambda df: shingles.jaccard_groups(df),
    "neighbours": lambda df: imatch.edited_neighbours(df, imatch.lexicon(df)),
    "mixed sizes": lambda df: mixing.mixed_sizes(df),
    "page text": lambda df: pagetext.extract_text(PAGE(df)),
    "archives": lambda df: warc.read_records(warc.write_archives(PAGE(df))),
}


@pytest.mark.parametrize("name", [*WITH_ALL, *OWN_COLUMNS])
def test_odd_rows(spark, name):
    df = table(spark, ROWS)
    operator = WITH_ALL.get(name) or OWN_COLUMNS[name]
    out = operator(df)
    rows = out.collect()
    assert len(rows) == len(ROWS)
    if name in WITH_ALL:
        assert all(r[c] == k for r in rows for k, c in enumerate(CLASHES)) and {r.doc_id for r in rows} == {None, 1, 2, 3, 4, 5, 6}
        mixed = {"copies"}  # one of two equal rows may be taken
        plain = lambda r: str({k: v for k, v in r.asDict().items() if k not in mixed})
        assert len({plain(r) for r in rows if r.doc_id == 1}) == 1 and len({plain(r) for r in rows if r.doc_id is None}) == 2
    none = operator(table(spark, []))
    assert none.columns == out.columns and none.count() == 0


def test_odd_rows_in_an_index(spark):
    """Rows without text aren't found, all others are, whatever their ids and other columns."""
    df = table(spark, ROWS)
    found = lexical.search(lexical.build_index(df), df.selectExpr("doc_id AS item_id", "text"), 20).collect()
    of = lambda item: [r.doc_id for r in found if r.item_id == item]
    assert set(of(5)) == set(of(3)) == set() and set(of(6)) == {6} and set(of(2)) == set()
    assert set(of(4)) == {1, 4, None} and len(of(1)) == 2 * len(set(of(4))) + 4  # two equal items, each with both rows of 1 and of no id
    assert [r.rank for r in found if r.item_id == 6] == [1]
