"""Reading raw JSON records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.sources.array_files import FILE, RECORD, array_elements

BAD = "__bad_record"
OBJECT = "__object"

# Files up to this size are read whole, one a row; larger ones are cut into their elements by
# many tasks.
WHOLE_FILE_BYTES = 32 << 20

# White space of JSON, and the mark some writers put at the start of a file.
SPACE = " \t\r\n"
BYTE_ORDER_MARK = "\ufeff"

# ---- Fixed values: the raw record ------------------------------------------------
RAW_RECORD = T.StructType(
    [
        T.StructField("prob_desc_time_limit", T.StringType()),
        T.StructField("prob_desc_sample_outputs", T.StringType()),
        T.StructField("src_uid", T.StringType()),
        T.StructField("prob_desc_notes", T.StringType()),
        T.StructField("prob_desc_description", T.StringType()),
        T.StructField("prob_desc_output_spec", T.StringType()),
        T.StructField("prob_desc_input_spec", T.StringType()),
        T.StructField("prob_desc_output_to", T.StringType()),
        T.StructField("prob_desc_input_from", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("lang_cluster", T.StringType()),
        T.StructField("difficulty", T.LongType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("code_uid", T.StringType()),
        T.StructField("prob_desc_memory_limit", T.StringType()),
        T.StructField("prob_desc_sample_inputs", T.StringType()),
        T.StructField("exec_outcome", T.StringType()),
        T.StructField("source_code", T.StringType()),
        T.StructField("prob_desc_created_at", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("hidden_unit_tests", T.StringType()),
    ]
)


def _unmarked(text: Column) -> Column:
    return F.when(text.startswith(BYTE_ORDER_MARK), F.substr(text, F.lit(2))).otherwise(text)


def _opens_with(text: Column, sign: str) -> Column:
    """Whether the JSON value begins with this sign, after any white space."""
    return F.ltrim(text, F.lit(SPACE)).startswith(sign)


def _read(spark: SparkSession, directory: str, pattern: str, whole_file_bytes: int) -> DataFrame:
    """Every record as JSON text, with its file name: the elements of an array, or the file.

    A small file is read whole, as its text is one JSON value. An array is cut into the texts of
    its elements before any field is looked at, so a bad field costs its own record at most.
    A byte order mark is no part of the value. A file that is no JSON stays one record. A missing
    directory is Spark's own error. Files that are larger give the same records without any
    task holding one of them; only if one is no JSON, its record is the first part that is none.
    """
    files = (
        spark.read.option("pathGlobFilter", pattern)
        .text(directory, wholetext=True)
        .filter(F.col("_metadata.file_size") <= whole_file_bytes)
        .select(_unmarked(F.col("value")).alias("value"), F.col("_metadata.file_name").alias(FILE))
    )
    largest = _largest_file(spark, directory, pattern)
    if largest is None:
        raise FileNotFoundError(f"no {pattern} files in {directory!r}")
    elements = F.from_json("value", "array<string>")
    listed = F.when(_opens_with(F.col("value"), "[") & elements.isNotNull(), elements).otherwise(F.array("value"))
    records = files.select(FILE, F.explode(listed).alias(RECORD))
    if largest <= whole_file_bytes:
        return records
    large = array_elements(spark, directory, pattern, whole_file_bytes)
    return records.union(large.select(FILE, _unmarked(F.col(RECORD))))


def _largest_file(spark: SparkSession, directory: str, pattern: str) -> int | None:
    """Bytes of the largest file, None without files. Only the listing is read."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
    return listing.agg(F.max("length")).first()[0]


def _typed(raw: Column, dtype: T.DataType) -> Column:
    """A field's raw text as its type, null where it does not hold one.

    A whole number may be written with a fraction of zero, as in 1500.0.
    """
    if isinstance(dtype, T.StringType):
        return raw
    if isinstance(dtype, T.IntegralType):
        number = raw.try_cast("double")
        whole = F.when(number == F.floor(number), raw.try_cast("decimal(38,6)").try_cast(dtype))
        return F.coalesce(raw.try_cast(dtype), whole)
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.from_json(raw, dtype)
    return raw.try_cast(dtype)


def _parsed(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Adds each field, and BAD: the text is no object, or a field holds no value of its type."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    opened = records.withColumn(OBJECT, F.when(_opens_with(F.col(RECORD), "{"), F.from_json(RECORD, texts)))
    broken = F.try_parse_json(RECORD).isNull() | F.col(OBJECT).isNull()
    fields = {f.name: _typed(F.col(OBJECT)[f.name], f.dataType) for f in schema.fields}
    typed = opened.select(FILE, RECORD, OBJECT, broken.alias(BAD), *[v.alias(n) for n, v in fields.items()])
    lost = [
        F.col(OBJECT)[f.name].isNotNull() & F.col(f"`{f.name}`").isNull()
        for f in schema.fields
        if not isinstance(f.dataType, T.StringType)
    ]
    return typed.withColumn(BAD, reduce(lambda a, b: a | b, lost, F.col(BAD)))


def scan_json_records(
    spark: SparkSession,
    directory: str,
    schema: T.StructType = RAW_RECORD,
    pattern: str = "*.json",
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> DataFrame:
    """Records of every *.json file directly in a directory, an array being many records.

    Files up to whole_file_bytes are a row of a task each; larger array files are read by as
    many tasks as Spark divides them into, and never whole. Only a single record of over 2 GB
    cannot be read. Numbers and other values in a text field are kept as their JSON text. Records that cannot be read as the schema are left
    out; quarantine_corrupt lists them.
    """
    parsed = _parsed(_read(spark, directory, pattern, whole_file_bytes), schema)
    return parsed.filter(~F.col(BAD)).drop(BAD, FILE, RECORD, OBJECT)


def quarantine_corrupt(
    spark: SparkSession,
    directory: str,
    schema: T.StructType = RAW_RECORD,
    pattern: str = "*.json",
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> DataFrame:
    """File name and text of the records that cannot be read, each once."""
    parsed = _parsed(_read(spark, directory, pattern, whole_file_bytes), schema)
    return parsed.filter(BAD).select(F.col(FILE).alias("file_name"), F.col(RECORD).alias("record"))
