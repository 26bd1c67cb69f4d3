"""The registered queries of the training-data operators: thin digests of what each operator returns, over whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mossgrid.llm import gif, imatch, langid, lexical, licenses, linededup, mixing, pagetext, secrets, sentencepieces, shingles, vectorcodes, warc
from mossgrid.llm.common import prepare


#: The vocabulary file of op10 and of the pipeline's last stage.
VOCABULARY = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a grey GIF, decoded again; feature is frames, duration and the histogram of grey levels."""
    prepare(spark)
    stored = gif.store_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    read = gif.gif_frames(stored.withColumn("media_bytes", F.octet_length("media").cast("long")).withColumn("media_sha256", F.sha2("media", 256)), whole=False, most_pixels=None, most_bytes=None).drop("media")
    read = read.withColumn("frames", F.when(F.col("gif_error").isNull(), F.col("frames")).otherwise(F.raise_error("gif_error")))
    pixels = F.when(F.size("frames") == 1, F.col("frames")[0]["pixels"]).otherwise(F.unhex(F.array_join(F.transform("frames", lambda f: F.hex(f["pixels"])), "")))
    bins = F.transform(F.sequence(F.lit(0), F.lit(gif.BINS - 1)), lambda k: F.aggregate(F.col("frames"), F.lit(0).cast("long"), lambda s, f: s + F.get(f["histogram"], k)))
    last = F.col("frames")[F.size("frames") - 1]
    feature = F.concat_ws(";", F.size("frames"), last["start_ms"] + last["delay_ms"], F.array_join(bins.cast("array<string>"), ","))
    out = read.select("doc_id", "n_bytes", "media_bytes", "media_sha256", feature.alias("feature"), pixels.alias("payload"))
    return out.select("doc_id", "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(F.expr("substring(payload, -64, 64)")).alias("tail_crc32"), "media_bytes", "media_sha256", "feature")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingles.jaccard_groups(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed_sizes(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = secrets.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    spans = lambda kinds: F.array_join(F.transform(F.filter("secrets", lambda s: s["kind"].isin(*kinds)), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(spans(secrets.KINDS[:3]).cast("binary"), 256).alias("base_sha256"), spans(secrets.KINDS).alias("spans"))


def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return imatch.edited_neighbours(docs, imatch.lexicon(docs))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", langid.held_out())
    model = langid.train(docs.where("not held_out"))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def op9_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.extract_text(table(spark, sf_dir, "pages"))


def piece_digests(docs: DataFrame) -> DataFrame:
    """What encoding and decoding give for every row of (doc_id, text): the best segmentation, how far the others fall behind, and whether decoding restores the text. Both go in one pass, so that a task needs one Python worker."""
    coded = sentencepieces.encode_texts(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), VOCABULARY, decoded="decoded")
    best = F.col("nbest")[0]
    whole = F.sha2(F.unhex(F.array_join(F.transform("nbest", lambda p: F.hex(p["ids"])), "")), 256)
    restored = F.col("decoded") == F.replace("text", F.lit(sentencepieces.MARK), F.lit(" "))
    return coded.select("doc_id", best["n_pieces"].cast("long").alias("n_pieces"), F.sha2(best["ids"], 256).alias("ids_sha256"), best["score"].alias("score"), F.size("nbest").cast("long").alias("n_best"), (best["score"] - F.element_at("nbest", -1)["score"]).alias("spread"), whole.alias("nbest_sha256"), restored.alias("round_trip"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build_index(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return lexical.search(index, table(spark, sf_dir, "benchmark"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    coded = vectorcodes.vector_codes(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256", "label")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept_lines = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept_lines.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_gif_media, op2_licenses, op3_ngram_jaccard, op4_warc, op5_source_mix, op6_secrets, op7_imatch, op8_language, op9_page_text, op10_pieces, op11_ranked_search, op12_vector_codes, op13_line_dedup)}
ORACLE_SQL = {"op2_licenses": licenses.sql(), "op3_ngram_jaccard": shingles.sql(), "op4_warc": warc.sql(), "op5_source_mix": mixing.sql(), "op11_ranked_search": lexical.sql(), "op12_vector_codes": vectorcodes.sql(), "op13_line_dedup": linededup.sql()}
