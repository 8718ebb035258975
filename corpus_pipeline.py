"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and works on every document its predecessor kept; its result
is written as Parquet and read again as the next stage's documents. All stages but the last return
the columns of ``documents``; further columns of the input, whatever their names, are left out. Texts are
read whole, whatever their length; an empty table gives an empty result of the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import common, decontaminate, near_dup, packing, secrets, tokenize, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold. Null and empty texts have no evidence and
    stay; repeated rows share their score and go or stay together; null labels and languages do not matter;
    without a usable label every document stays; ties in the learned sample go by id."""
    labels = common.table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, common.crc_remainder("doc_id", 3) != 1)
    return toxicity.score(docs, model, COLUMNS).where(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id. Null and empty texts
    are in no group and stay; a repeated row is kept once; rows with a null id stay once a text; groups are
    closed under links, so ties do not arise but for equal ids."""
    return near_dup.deduplicate(docs.select(*COLUMNS), percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item. Null and empty texts hold none and stay, as do all documents
    if the benchmark is empty; repeated rows go or stay together, also under a null id; of several items
    and runs (ties) one is enough."""
    return decontaminate.clean(docs.select(*COLUMNS), common.table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced; ``n_chars`` follows the new text. Null and empty texts have no
    finding and are returned as they are; repeated rows and equal texts are scanned once and changed alike;
    overlapping findings (ties) are replaced as one stretch; a null id does not matter."""
    ledger = common.shared_dir(spark, "pipeline-ledger")
    return secrets.redact_versions(docs.select(*COLUMNS), ledger).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences: which ids of which document lie where. Null and empty texts hold the end
    id alone; repeated rows and rows of equal length (ties) are packed each for itself; a null id stays null."""
    pieces = packing.pack(docs, tokenize.tokenizer_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

# No stage but the redaction has a form in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = common.documents(spark, sf_dir).select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
