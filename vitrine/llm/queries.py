"""The ``opN_`` queries: each applies its operator to the whole intended table
and derives the contract's columns from the operator's result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import align, decontaminate, license, minhash, mixing, oracles, pieces, quality, repair, sharding, tokencount, trie, urlfilter, warc
from vitrine.llm.common import new_folder
from vitrine.llm.registry import query
from vitrine.sources.tables import table


def byte_bpe() -> str:
    """Place of the byte-level BPE vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_bpe() -> str:
    """Place of the SentencePiece model."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@query("op1_minhash_near_dedup", oracles.OP1)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.duplicate_classes(table(spark, sf_dir, "documents").select("doc_id", "text"), percent=85)


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.histogram(table(spark, sf_dir, "documents").select("source", "text"), byte_bpe(), by=("source",))


@query("op3_license_scan", oracles.OP3)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op4_benchmark_decontamination", oracles.OP4)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last_word"] - s["first_word"] + 1)
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


@query("op5_source_mixing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), "rate", "copies")


@query("op6_warc", oracles.OP6)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    archive = warc.write_archive(pages)
    return warc.read_captures(archive, pages).drop("url", "payload")


@query("op7_quality_rules", oracles.OP7)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    signals = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality.cascade(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_signals=signals)
    base = " or ".join(rule.sql() for rule in quality.BASE)
    return judged.select("doc_id", *signals, F.expr(base).alias("base_failed"), "kept")


@query("op8_sharding", oracles.OP8)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    body = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    placed = sharding.shard(rows, 40, order=["doc_id", "text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op9_token_shards")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-shards")
    manifest = repair.write_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), byte_bpe(), folder)
    return repair.read_shards(manifest, folder)


URL_RULES = [urlfilter.UrlRule("allow", "com/"), urlfilter.UrlRule("block", "example.com/en/"), urlfilter.UrlRule("allow", "www.example.com/en/"),
             urlfilter.UrlRule("block", "net/es/"), urlfilter.UrlRule("block", "net/fr/")]


@query("op10_url_filter")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = urlfilter.fit(urlfilter.seed_labels(pages))
    return urlfilter.judge(pages, URL_RULES, model).select("page_id", "host", "path", "rule", "verdict", "score")


@query("op11_sentencepiece")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), piece_bpe(), decode=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op12_conversation_trie", oracles.OP12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = trie.conversation_trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    nodes = built.nodes.join(trie.ends_sha256(built.ends), trie.KEY, "left")
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


@query("op13_tokenizer_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents").select("doc_id", "text"), byte_bpe(), piece_bpe())
