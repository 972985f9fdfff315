"""CSV sources: header read as text, declared columns cast by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from emporia.sources.registry import Registry
from emporia.sources.schemas import SOURCE_SCHEMAS

# Fixed value: what the CSV reader puts for an empty field before it becomes NULL. The
# reader takes a field with this very text for NULL too, so it consists of
# characters that Unicode keeps out of any text.
NULL_MARK = "\uffff\ufdd0\uffff"

def cast_by_name(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast each declared column, matched by name, to its declared type.

    Undeclared columns pass through unchanged (text for CSV input). A declared
    column missing from the frame raises ``KeyError``. Under ANSI mode a value
    that does not parse (``'abc'`` as a price) fails the job instead of turning
    into NULL.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise KeyError(f"declared columns not in source: {missing}")
    declared = {f.name: f.dataType for f in schema.fields}
    casts = {}
    for name, dtype in declared.items():
        if df.schema[name].dataType == dtype:
            continue
        value = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, StringType):
            value = F.when(F.trim(value) != "", value)  # empty text has no number or time
        if isinstance(dtype, TimestampNTZType):
            casts[name] = F.to_timestamp_ntz(value)
        else:
            casts[name] = value.cast(dtype)
    return df.withColumns(casts) if casts else df


def _reader(spark: SparkSession, header: bool, options: dict[str, str] | None) -> DataFrameReader:
    reader = spark.read.option("header", header).option("escape", '"')
    # An empty field is NULL, a quoted empty one is the empty text.
    reader = reader.option("nullValue", NULL_MARK).option("emptyValue", "")
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    header: bool = True,
    multiline: bool = False,
    options: dict[str, str] | None = None,
    infer_undeclared: bool = False,
) -> DataFrame:
    """Read CSV with a header, every column as text, then apply ``schema`` by name.

    ``path`` is a file, a folder of part files or a glob. By default no types are
    inferred: inference costs an extra pass over the files and its result depends on
    the data (``01151`` would become the integer 1151). With ``infer_undeclared`` the
    columns that ``schema`` does not name get the types Spark's reader infers for
    them; declared ones are read as text and cast by name all the same. Where every
    column is declared the pass is left out.

    ``multiline`` reads quoted fields that contain line breaks as one record, at the
    price of not splitting a file across tasks: land such a dataset as many part
    files. A quote inside a quoted field is doubled. ``options`` go to the reader as
    they are and win over these defaults.
    """
    options = {**({"multiLine": "true"} if multiline else {}), **(options or {})}
    text = _reader(spark, header, options).option("inferSchema", False)
    declared = set(schema.fieldNames()) if schema is not None else set()
    if infer_undeclared and not set(text.csv(path).columns) <= declared:
        inferred = _reader(spark, header, options).option("inferSchema", True).csv(path).schema
        typed = StructType(
            [StructField(f.name, StringType() if f.name in declared else f.dataType) for f in inferred.fields]
        )
        text = _reader(spark, header, options).schema(typed)
    df = text.csv(path)
    return cast_by_name(df, schema) if schema is not None else df


def read_source(
    spark: SparkSession,
    dataset: str,
    registry: Registry | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Read a source dataset from its landing files, as the registry says."""
    registry = registry or Registry()
    return read_csv(
        spark,
        registry.source_path(dataset),
        schema=schema if schema is not None else SOURCE_SCHEMAS[dataset],
        options=registry.read_options(dataset),
        infer_undeclared=dataset in registry.infer_undeclared,
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", max_records_per_file: int = 0) -> None:
    """Write a frame as headed CSV part files (quoted fields may contain line breaks).

    Outer spaces are kept (Spark's writer trims them by default). A NULL is an empty
    field, the empty text a quoted one. ``max_records_per_file`` bounds the part
    files, and with them the read tasks of a multi-line dataset.
    """
    (
        df.write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("escape", '"')
        .option("emptyValue", '""')
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
        .csv(path)
    )
