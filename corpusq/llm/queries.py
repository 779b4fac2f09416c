"""One query per dealt operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusq.llm import (
    compression,
    conversation_trie,
    decontaminate,
    kdtree,
    licenses,
    near_duplicates,
    packing,
    periodic_runs,
    pii,
    quality,
    secret_scan,
    tokens,
    url_filter,
    warc,
)
from corpusq.llm.texts import read_table, share_code

QUERIES = {}


def register(run):
    def query(spark, sf):
        share_code(spark)
        return run(spark, sf)

    QUERIES[run.__name__] = query
    return run


@register
def op1_compression_bands(spark, sf):
    return compression.compression_rules(read_table(spark, sf, "documents"), ["doc_id"])


@register
def op2_simhash_windows(spark, sf):
    return decontaminate.contaminated(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"), ["doc_id"])


SHARDS = 8


@register
def op3_kd_tree(spark, sf):
    placed = kdtree.kd_shards(read_table(spark, sf, "documents"), SHARDS)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


@register
def op4_license_alignment(spark, sf):
    return licenses.scan_licenses(read_table(spark, sf, "documents"), ["doc_id"])


@register
def op5_crf_secrets(spark, sf):
    return secret_scan.scan_secrets(read_table(spark, sf, "documents"), ["doc_id"])


@register
def op6_weighted_minhash(spark, sf):
    return near_duplicates.near_duplicates(read_table(spark, sf, "documents"))


@register
def op7_crf_pii(spark, sf):
    return pii.find_pii(read_table(spark, sf, "documents"), ["doc_id"])


SEQUENCE_TOKENS = 2048


@register
def op8_certified_packing(spark, sf):
    pieces = tokens.token_pieces(read_table(spark, sf, "documents"), ["doc_id"], SEQUENCE_TOKENS)
    return packing.pack(pieces, SEQUENCE_TOKENS)


@register
def op9_warc_splits(spark, sf):
    manifest = warc.write_archives(read_table(spark, sf, "pages"), warc.archive_folder(spark))
    records = warc.read_archives(manifest)
    page = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1)
    number = lambda c: F.when(page(c) != "", page(c)).cast("long")
    return records.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to_id").alias("refers_to"),
    )


@register
def op10_subword_quality(spark, sf):
    docs = read_table(spark, sf, "documents")
    model = quality.train(docs, read_table(spark, sf, "labels"))
    rows = docs.select("doc_id", quality.held_out().alias("held_out"), "text")
    return quality.score_texts(rows, ["doc_id", "held_out"], model)


@register
def op11_parentheses_trie(spark, sf):
    return conversation_trie.prefix_trie(read_table(spark, sf, "conversations"), grafted=True)


URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

# Sites whose pages are listed: the second label of their hosts' domain names.
LISTED_SITES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")


@register
def op12_blocked_bloom(spark, sf):
    """The listed URLs are those of the pages of ``LISTED_SITES``."""
    pages = read_table(spark, sf, "pages").select("page_id", "url")
    site = F.element_at(F.split(url_filter.host_of(F.col("url")), "\\."), -3)
    listed = pages.where(site.isin(*LISTED_SITES)).select("url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(pages, rules, listed, ["page_id"])


@register
def op13_basic_factors(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string"))
    tile = F.when(h % 10 == 0, F.floor(h / 10))
    found = periodic_runs.periodic_runs(docs, ["doc_id"], tile=tile)
    runs = F.arrays_zip("starts", "lengths", "periods")
    line = lambda r: F.concat_ws(",", r["starts"], r["lengths"], r["periods"])
    # Runs come by start and period, so the first of the longest is wanted.
    best = F.get("runs", F.array_position("lengths", F.array_max("lengths")).cast("int") - 1)
    rows = found.withColumn("runs", runs).withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size("starts").cast("bigint").alias("n_runs"),
        F.col("best.starts").alias("start"),
        F.col("best.lengths").alias("length"),
        F.col("best.periods").alias("period"),
        F.expr("(1000 * best.lengths) div best.periods").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
