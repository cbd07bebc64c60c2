"""Landed feature-collection documents.

Three readers for the same layer, chosen by how the documents are stored:

* ``read_landing_geojson``: one document per file. A file is one task, so it scales with the
  number of files.
* ``read_landing_text``: one document per line. Files split between lines.
* ``split.read_landing_split``: one document per file, split *inside* the document, for a feed whose
  single document is too large for a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seismark.schema import CORRUPT, RAW_DOCUMENT, SOURCE, UNFINISHED

_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def read_landing_geojson(
    spark: SparkSession, path: str, schema: T.StructType = RAW_DOCUMENT, streaming: bool = False,
    **options,
) -> DataFrame:
    """One row per landed file: its features, and the text of a document that did not parse.

    The file is read as one text and parsed from memory. The multi-line form of the JSON source
    would fetch the text of each number from the file again, by its position.
    """
    reader = spark.readStream if streaming else spark.read
    texts = reader.options(recursiveFileLookup=True, **options).text(path, wholetext=True)
    return parse_documents(texts.filter(~F.col("value").rlike(r"^\s*$")), "value", schema)


def read_landing_text(
    spark: SparkSession, path: str, schema: T.StructType = RAW_DOCUMENT, streaming: bool = False,
    **options,
) -> DataFrame:
    """One row per line; blank lines hold no document."""
    reader = spark.readStream if streaming else spark.read
    lines = reader.options(recursiveFileLookup=True, **options).text(path)
    return parse_documents(lines.filter(F.trim("value") != ""), "value", schema)


def parse_documents(
    df: DataFrame, text: str, schema: T.StructType = RAW_DOCUMENT
) -> DataFrame:
    """Parse a text column that holds one document per row."""
    parsed = F.from_json(F.col(text), schema, _PERMISSIVE)
    return df.select(parsed.alias("document")).select("document.*")


def explode_features(documents: DataFrame) -> DataFrame:
    """One row per feature; a document with a missing, null or empty list gives none.

    The outer form is used on purpose: the plain one adds a filter on the size of the list, and
    that filter would parse the text a second time underneath the parsing step.
    """
    exploded = documents.select(F.explode_outer("features").alias("feature"))
    return exploded.filter(F.col("feature").isNotNull())


def explode_entries(documents: DataFrame) -> DataFrame:
    """(feature, record): one row per feature, and one with the text of each document of which
    something did not parse. Each document is taken apart once; what the reader tells about its file
    stays beside."""
    kind = documents.schema["features"].dataType
    # the first entry stands for the document itself, the others for its features
    features = F.concat(F.array(F.lit(None).cast(kind.elementType)), F.coalesce("features", F.array().cast(kind)))
    entries = F.arrays_zip(features.alias("feature"), F.array(F.col(CORRUPT)).alias("record"))
    told = [c for c in (SOURCE, UNFINISHED) if c in documents.columns]
    exploded = documents.select(F.explode_outer(entries).alias("entry"), *told).select("entry.*", *told)
    return exploded.filter(F.col("feature").isNotNull() | F.col("record").isNotNull())


def split_documents(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable, quarantined). A document is quarantined when any of it did not parse; what
    did parse of it stays among the readable ones, as ``partly_read`` tells."""
    readable = documents.filter(F.col("features").isNotNull())
    # Spark refuses a query of the corrupt column alone, so the test names the list as well.
    with_list = F.coalesce(F.size("features") >= -1, F.lit(True))
    broken = documents.filter(F.col(CORRUPT).isNotNull() & with_list).select(
        F.col(CORRUPT).alias("document"), F.col("features").isNotNull().alias("partly_read")
    )
    return readable, broken
