"""The registered queries of this subpackage: name -> function of (spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import common, conversation_repair, decontaminate, language_id, mih, near_dup, ngram_lm, oracle, packing, secrets, token_alignment, tokenize, toxicity, training_order, url_filter, warc


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of every document, scanned through a fresh blob ledger."""
    docs = common.documents(spark, sf_dir)
    found = secrets.scan_versions(docs, ["doc_id"], common.shared_dir(spark, "secret-ledger"))
    f = F.col("findings")
    count = lambda kind: F.size(F.filter(f, lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in secrets.BASE_KINDS),
        F.sha2(secrets.spans_text(f, secrets.BASE_KINDS), 256).alias("base_sha256"),
        secrets.spans_text(f).alias("spans"),
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document; learned from the documents that are not held out."""
    docs = common.documents(spark, sf_dir)
    held_out = F.coalesce(common.crc_remainder("doc_id", 7) == 2, F.lit(False))
    model = ngram_lm.train(docs, ~held_out)
    scored = ngram_lm.score(docs, model, ["doc_id"])
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )


def op3_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows by cosine of every row whose id is divisible by 50."""
    return mih.nearest(common.table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0, k=5)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 4096 ids, with a checksum of each piece's ids."""
    pieces = packing.pack(common.documents(spark, sf_dir), tokenize.tokenizer_path(), packing.WINDOW)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    judged = url_filter.judge(common.table(spark, sf_dir, "pages"), ["page_id"])
    return judged.select("page_id", "host", "path", "rule", "verdict", "spam_score")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learned from two thirds of the ids."""
    docs = common.documents(spark, sf_dir)
    remainder = common.crc_remainder("doc_id", 3)
    model = language_id.train(docs, remainder != 1)
    predicted = language_id.predict(docs, model, ["doc_id"])
    return predicted.select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents at a similarity of 0.85."""
    return near_dup.near_duplicates(common.documents(spark, sf_dir), percent=85)


def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies: slot, shard and byte in it, from the tasks that wrote
    the shards."""
    rows, _, _ = training_order.materialise(common.documents(spark, sf_dir), tokenize.tokenizer_path(), "epoch-0")
    byte = (F.col("slot") % training_order.SHARD) * training_order.STRIDE + F.col("offset")
    return rows.select("doc_id", "start", "length", "slot", "shard", (2 * byte).alias("byte_offset"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; learned from two thirds of the labelled ids."""
    docs = common.documents(spark, sf_dir)
    remainder = common.crc_remainder("doc_id", 3)
    model = toxicity.train(docs, common.table(spark, sf_dir, "labels"), remainder != 1)
    scored = toxicity.score(docs, model, ["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(remainder == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, re-parameterised or not, with the matched extent."""
    found = decontaminate.contaminated(common.documents(spark, sf_dir), common.table(spark, sf_dir, "benchmark"))
    best = F.max_by(F.struct("n_matched", "n_item", "doc_start", "n_slots"), F.struct("n_matched", -F.col("doc_start")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of two public tokenizers aligned over every document."""
    path = tokenize.tokenizer_path
    aligned = token_alignment.align(common.documents(spark, sf_dir), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))
    return aligned.documents.drop("groups")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by the hash of its turns, with its faults and its cheapest repair."""
    return conversation_repair.repair(conversation_repair.damage(common.table(spark, sf_dir, "conversations")))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record, then read back from the archives by way of the index."""
    index, root = warc.write_archives(common.table(spark, sf_dir, "pages"))
    return warc.read_records(index, root, with_payload=False).drop("url")


QUERIES = {
    "op1_secret_scans": op1_secret_scans,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_multi_index_hashing": op3_multi_index_hashing,
    "op4_packing": op4_packing,
    "op5_url_filters": op5_url_filters,
    "op6_language_id": op6_language_id,
    "op7_minhash": op7_minhash,
    "op8_training_order": op8_training_order,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
    "op11_token_alignment": op11_token_alignment,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_warc": op13_warc,
}
ORACLE: dict[str, str] = oracle.ORACLE
