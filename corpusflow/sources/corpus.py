"""Reading text corpora and saving them with a metadata record."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpusflow.session import work_dir
from corpusflow.settings import MAX_LENGTH, SPLIT
from corpusflow.sources.json_arrays import array_items

CORRUPT = "_corrupt_record"

_FORMATS = {
    ".parquet": "parquet",
    ".orc": "orc",
    ".csv": "csv",
    ".tsv": "tsv",
    ".txt": "text",
    ".jsonl": "jsonl",
    ".json": "json",
}
_COMPRESSED = (".gz", ".bz2", ".zst", ".deflate", ".snappy", ".lz4")

METADATA_SCHEMA = (
    "dataset_name STRING, num_examples BIGINT, max_length INT, split STRING, "
    "features ARRAY<STRING>, null_texts BIGINT"
)


def _json_reader(spark: SparkSession, schema, on_bad: str):
    if on_bad == "fail":
        reader = spark.read.option("mode", "FAILFAST")
    elif on_bad == "keep":
        reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        if schema is not None:
            struct = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
            schema = StructType([*struct.fields, StructField(CORRUPT, StringType())])
    else:
        raise ValueError(f"on_bad must be 'fail' or 'keep', not {on_bad!r}")
    return reader.schema(schema) if schema is not None else reader


def read_json_document(spark: SparkSession, path: str, schema=None, on_bad: str = "fail") -> DataFrame:
    """JSON documents, one per file: an object is one row, a top-level array one row per item.

    A file is read by one task; use :func:`read_json_array` or :func:`read_jsonl` for large inputs.
    """
    return _json_reader(spark, schema, on_bad).option("multiLine", True).json(path)


def read_json_array(
    spark: SparkSession, path: str, schema=None, on_bad: str = "fail", range_bytes: int | None = None
) -> DataFrame:
    """Large files that each hold one array of objects, one row per object: every byte range is read by a task of its own.

    The objects are written once to the shared folder, a line each, and read by
    :func:`read_jsonl`. Rows are those of :func:`read_json_document`.
    """
    lines = work_dir(spark, "json_lines")
    array_items(spark, path, range_bytes).write.text(lines)
    return read_jsonl(spark, lines, schema, on_bad)


def read_jsonl(spark: SparkSession, path: str, schema=None, on_bad: str = "fail") -> DataFrame:
    """One JSON object per line; blank lines are skipped and files are split between tasks.

    ``on_bad="keep"`` puts unreadable lines into ``_corrupt_record`` instead of failing.
    """
    return _json_reader(spark, schema, on_bad).json(path)


def _suffix_format(path: str) -> str | None:
    """Format by the suffix, under that of a compression; None for others."""
    name = path.rstrip("/").rsplit("/", 1)[-1].lower()
    name = next((name.removesuffix(c) for c in _COMPRESSED if name.endswith(c)), name)
    return next((f for suffix, f in _FORMATS.items() if name.endswith(suffix)), None)


def _folder_format(spark: SparkSession, path: str) -> str:
    """Format of the files in a folder, by their names; Parquet if they have no suffix of ours."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    ending = F.lower(F.regexp_extract("path", r"((\.[A-Za-z0-9]+){0,2})$", 1))
    known = F.regexp_extract(ending, "(" + "|".join([*_FORMATS, *_COMPRESSED]).replace(".", "\\.") + ").*$", 0)
    found = {_suffix_format(row[0]) for row in files.select(known).distinct().collect()} - {None}
    if len(found) > 1:
        raise ValueError(f"{path} holds files of several formats: {', '.join(sorted(found))}; give fmt")
    return found.pop() if found else "parquet"


def read_files(spark: SparkSession, path: str, fmt: str | None = None, schema=None) -> DataFrame:
    """A file or folder of any format; a compression's suffix is looked through.

    Without ``fmt`` the path's suffix decides, and for a folder without one the
    names of its files. CSV and TSV have a header line; without ``schema`` their
    columns are strings.
    """
    fmt = fmt or _suffix_format(path) or _folder_format(spark, path)
    if fmt == "jsonl":
        return read_jsonl(spark, path, schema)
    if fmt == "json":
        return read_json_document(spark, path, schema)
    reader = spark.read.format("csv" if fmt == "tsv" else fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt in ("csv", "tsv"):
        reader = reader.option("header", True).option("sep", "\t" if fmt == "tsv" else ",")
    return reader.load(path)


def read_named(
    spark: SparkSession, name: str, registry: dict[str, str] | None = None, schema=None, fmt: str | None = None
) -> DataFrame:
    """A dataset by name: a path from ``registry``, else a table or view of the session.

    A ``schema`` given for a table selects its columns, cast; one it lacks is NULL.
    """
    if registry and name in registry:
        return read_files(spark, registry[name], fmt, schema)
    df = spark.table(name)
    if schema is None:
        return df
    struct = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in struct])


def resolve_dataset(
    spark: SparkSession,
    source: str,
    split: str | None = None,
    schema=None,
    registry: dict[str, str] | None = None,
    fmt: str | None = None,
) -> DataFrame:
    """A dataset given as an existing path or, failing that, as a name.

    ``split`` selects rows; a dataset without a ``split`` column is the split ``train``.
    """
    try:
        df = read_files(spark, source, fmt, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        df = read_named(spark, source, registry, schema, fmt)
    return df if split is None else select_split(df, split)


def select_split(df: DataFrame, split: str = SPLIT) -> DataFrame:
    """Rows of one split. A dataset without a ``split`` column is the split ``train``; it has no other.

    On a dataset written with ``partitionBy("split")`` only that folder is read.
    """
    if "split" in df.columns:
        return df.where(F.col("split") == split)
    if split != SPLIT:
        raise ValueError(f"the dataset has no split {split!r}: without a split column all of it is {SPLIT!r}")
    return df


def text_column(df: DataFrame) -> str:
    """``text`` if there is one, else the first column; it has to hold strings."""
    name = "text" if "text" in df.columns else df.columns[0]
    if not isinstance(df.schema[name].dataType, StringType):
        raise TypeError(f"text column {name!r} holds {df.schema[name].dataType.simpleString()}, not strings")
    return name


def save_dataset(
    df: DataFrame,
    out_dir: str,
    dataset_name: str,
    split: str = SPLIT,
    max_length: int = MAX_LENGTH,
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Write ``<out_dir>/dataset`` and ``<out_dir>/metadata``; returns the metadata record.

    The counts are observed while the data is written, so there is no second pass.
    ``max_length`` is recorded only: saving never truncates.
    """
    try:
        null_text = F.count_if(F.col(text_column(df)).isNull())
    except TypeError:
        null_text = F.lit(0).cast("bigint")
    counts = Observation("saved rows")
    observed = df.observe(counts, F.count(F.lit(1)).alias("num_examples"), null_text.alias("null_texts"))
    writer = observed.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{out_dir}/dataset")

    record = (dataset_name, counts.get["num_examples"], max_length, split, df.columns, counts.get["null_texts"])
    spark = df.sparkSession
    metadata = spark.createDataFrame([record], METADATA_SCHEMA)
    metadata.coalesce(1).write.mode("errorifexists").json(f"{out_dir}/metadata")
    return read_metadata(spark, out_dir)


def load_dataset(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(f"{out_dir}/dataset")


def read_metadata(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.schema(METADATA_SCHEMA).json(f"{out_dir}/metadata")
