"""JSON record documents (the product catalog): array documents or JSON Lines.

Records stay raw JSON text until validated: required keys are checked by *presence* (a present
key holding null passes), then typed values are extracted with defaults.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.parse import lenient_double
from starloom.schemas import API_REQUIRED_KEYS


def records_from_array_documents(docs: DataFrame, value: str = "value") -> DataFrame:
    """Explode JSON array documents into one raw record per element -> ``(doc, pos, record)``.

    A document whose top level is not an array fails the job with a clear message.
    """
    checked = docs.select(
        F.monotonically_increasing_id().alias("doc"),
        F.when(
            F.json_array_length(F.col(value)).isNotNull(), F.col(value)
        ).otherwise(F.raise_error(F.lit("Expected a JSON array at the top level of the document"))).alias("v"),
    )
    return checked.select("doc", F.posexplode(F.from_json("v", "array<string>")).alias("pos", "record"))


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """Each file is one JSON array (the API response). A file is parsed by one task, so use
    :func:`read_json_lines` for large catalogs."""
    return records_from_array_documents(spark.read.text(path, wholetext=True))


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per line: split and parsed in parallel -> ``(doc, pos, record)``."""
    return spark.read.text(path).select(
        F.lit(0).cast("long").alias("doc"), F.monotonically_increasing_id().alias("pos"), F.col("value").alias("record")
    )


def has_keys(record: Column, required: Sequence[str] = API_REQUIRED_KEYS) -> Column:
    """True when every required key is present in the JSON object (null values count as present)."""
    keys = F.json_object_keys(record)
    missing = F.array_except(F.array(*[F.lit(k) for k in required]), keys)
    return F.coalesce(F.size(missing) == 0, F.lit(False))


def validate_records(records: DataFrame, required: Sequence[str] = API_REQUIRED_KEYS) -> DataFrame:
    """Keep records that carry every required key."""
    return records.where(has_keys(F.col("record"), required))


def record_counts(records: DataFrame, required: Sequence[str] = API_REQUIRED_KEYS) -> DataFrame:
    """``(records, valid, dropped)`` in one pass."""
    ok = has_keys(F.col("record"), required)
    return records.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(ok).alias("valid"),
        F.count_if(~ok).alias("dropped"),
    )


def _num(record: Column, path: str) -> Column:
    return lenient_double(F.get_json_object(record, path))


def flatten_api_products(records: DataFrame) -> DataFrame:
    """``(id, api_category, price, rating)`` from validated catalog records.

    * ``api_category``: the category text lower-cased; a null category reads as ``none``
      (the text form of a missing value), non-text values by their JSON text;
    * ``price``: number, missing or null -> 0.0;
    * ``rating``: ``rating.rate`` when ``rating`` is an object, otherwise 0.0.
    """
    r = F.col("record")
    rating = F.get_json_object(r, "$.rating")
    rating_is_object = F.json_object_keys(rating).isNotNull()
    category = F.get_json_object(r, "$.category")
    return records.select(
        F.get_json_object(r, "$.id").alias("id"),
        F.lower(F.coalesce(category, F.lit("None"))).alias("api_category"),
        F.coalesce(_num(r, "$.price"), F.lit(0.0)).alias("price"),
        F.when(rating_is_object, F.coalesce(_num(r, "$.rating.rate"), F.lit(0.0))).otherwise(F.lit(0.0)).alias("rating"),
    )


def write_json_lines(records: DataFrame, path: str) -> None:
    """Land raw records as JSON Lines, one record's text a line; :func:`read_json_lines` reads them
    back as they were (the commit protocol makes the write atomic per job)."""
    one_line = F.regexp_replace("record", r"[\r\n]+", " ")  # line breaks are white space in JSON
    records.select(one_line).write.mode("overwrite").text(path)
