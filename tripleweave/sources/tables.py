"""Readers and writers of the stage tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .json_arrays import read_json_array, write_json_arrays

ENTITIES = "map<string,array<string>>"
CHUNK_SCHEMA = "id bigint, file string, chunk_index int, source string, text string"
ENTITY_SCHEMA = f"id bigint, text string, entities {ENTITIES}"
SYNTAX = (
    "struct<tokens:array<struct<text:string,lemma:string,pos:string,tag:string,dep:string,i:int,head_i:int,"
    "head_text:string>>,dep:string,con_pos:string,"
    "dep_triples:array<struct<head_i:int,head_text:string,dep:string,child_i:int,child_text:string>>>"
)
TRIPLET_SCHEMA = f"id bigint, text string, syntax {SYNTAX}, entities {ENTITIES}, triplets variant"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_text_file(spark: SparkSession, path: str) -> DataFrame:
    """One file as one document: source, file, text."""
    return read_text_files(spark, path)


def read_text_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Every matching UTF-8 file as one document: source, file, text.

    ``source`` is the path (of local files without a scheme) and ``file`` the
    name, both as they are written, not in URI form.

    Many files are packed into a split by Spark. Sort by ``file`` (code point
    order) where the order of files matters.
    """
    files = spark.read.text(pattern, wholetext=True)
    plain = lambda c: F.url_decode(F.replace(F.col(c), F.lit("+"), F.lit("%2B")))
    source = F.regexp_replace(plain("_metadata.file_path"), "^file:/+", "/")
    return files.select(source.alias("source"), plain("_metadata.file_name").alias("file"), F.col("value").alias("text"))


def _read(spark: SparkSession, path: str, schema: str, fmt: str, array: bool) -> DataFrame:
    if fmt == "json":
        return read_json_array(spark, path, schema) if array else spark.read.schema(schema).json(path)
    return spark.read.schema(schema).format(fmt).load(path)


def with_rec(df: DataFrame) -> DataFrame:
    """Add ``rec``, a record key that rises in file order.

    ``id`` may repeat between files. The key depends on how the scan is split:
    store the result before using it twice.
    """
    return df.withColumn("rec", F.monotonically_increasing_id())


def read_chunks(spark: SparkSession, path: str, fmt: str = "json", array: bool = True) -> DataFrame:
    """Chunk table. ``array``: JSON files are arrays, each read by as many tasks as it has blocks; otherwise JSON lines."""
    return _read(spark, path, CHUNK_SCHEMA, fmt, array)


def read_entities(spark: SparkSession, path: str, fmt: str = "json", array: bool = True) -> DataFrame:
    """Entity table with one map per record."""
    return _read(spark, path, ENTITY_SCHEMA, fmt, array)


def read_triplet_records(spark: SparkSession, path: str, fmt: str = "json", array: bool = True) -> DataFrame:
    """Triplet table; ``triplets`` is VARIANT because it may be a list or an error object."""
    return _read(spark, path, TRIPLET_SCHEMA, fmt, array)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite a stage table. JSON (one record a line) and ``json_array`` (one array a file) keep NULL fields."""
    if fmt == "json_array":
        write_json_arrays(df, path)
        return
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    writer.save(path)
