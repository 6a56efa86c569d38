"""Reading, saving and describing corpora."""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import text as tx
from corpusflow.queries.tables import table
from corpusflow.session import work_dir
from corpusflow.sources import corpus as src

DOCUMENTS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
ITEMS_PER_DOCUMENT = 1000


def read_json_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_dir(spark, 'json')}/items.json"
    items = table(spark, sf_dir, "benchmark")
    # one pretty-printed array per file
    documents = items.groupBy(F.expr(f"item_id div {ITEMS_PER_DOCUMENT}").alias("part")).agg(
        F.to_json(F.array_sort(F.collect_list(F.struct("item_id", "text"))), {"pretty": "true"}).alias("value")
    )
    documents.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return src.read_json_document(spark, path, "item_id BIGINT, text STRING")


def _as_arrays(batches):
    """Objects as lines of an array, one array for each task and so for each file."""
    yield pa.RecordBatch.from_arrays([pa.array(["["])], ["value"])
    separator = ""
    for batch in batches:
        lines = []
        for value in batch.column("value").to_pylist():
            lines.append(separator + value)
            separator = ","
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["]"])], ["value"])


def read_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pretty-printed arrays, one for each split of the table, read in ranges of a quarter megabyte."""
    path = f"{work_dir(spark, 'arrays')}/documents"
    objects = table(spark, sf_dir, "documents").select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("value"))
    objects.mapInArrow(_as_arrays, "value string").write.text(path)
    return src.read_json_array(spark, path, DOCUMENTS, range_bytes=1 << 18)


def read_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_dir(spark, 'jsonl')}/documents.jsonl"
    table(spark, sf_dir, "documents").select(F.to_json(F.struct("*")).alias("value")).write.text(path)
    return src.read_jsonl(spark, path, DOCUMENTS)


def scan_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.read_files(spark, f"{sf_dir}/documents.parquet")


def read_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "conversations").createOrReplaceTempView("corpusflow_conversations")
    return src.read_named(spark, "corpusflow_conversations")


def resolve_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Parquet path, compressed lines of JSON, a folder of CSV files, and a name."""
    base = work_dir(spark, "sources")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    items.select(F.to_json(F.struct("*")).alias("value")).write.option("compression", "gzip").text(f"{base}/items.jsonl.gz")
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("text"))
    pages.write.option("header", True).csv(f"{base}/pages")
    found = {
        "path": src.resolve_dataset(spark, f"{sf_dir}/documents.parquet"),
        "lines": src.resolve_dataset(spark, f"{base}/items.jsonl.gz", schema="item_id BIGINT, text STRING"),
        "folder": src.resolve_dataset(spark, f"{base}/pages", schema="page_id BIGINT, text STRING"),
        "name": src.resolve_dataset(spark, "chats", registry={"chats": f"{sf_dir}/conversations.parquet"}),
    }
    first, *rest = [df.select(F.lit(origin).alias("origin"), "text") for origin, df in found.items()]
    for df in rest:
        first = first.unionByName(df)
    return first


def select_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "split")
    held_out = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1).isin("0", "1")
    labelled = table(spark, sf_dir, "documents").withColumn(
        "split", F.when(held_out, "validation").otherwise("train")
    )
    src.save_dataset(labelled, out, "documents", partition_by=["split"])
    saved = src.load_dataset(spark, out)
    splits = [src.select_split(saved, s).select("doc_id", "text", "split") for s in ("train", "validation")]
    return splits[0].unionByName(splits[1])


def save_reload_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "dataset")
    src.save_dataset(table(spark, sf_dir, "documents"), out, "documents")
    return src.load_dataset(spark, out)


def dataset_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "metadata")
    return src.save_dataset(table(spark, sf_dir, "documents"), out, "documents")


def resolve_text_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    parts = table(spark, sf_dir, "part").select("p_name", "p_brand")
    resolved = [df.select(F.lit(src.text_column(df)).alias("text_column"), F.col(src.text_column(df)).alias("content")) for df in (documents, parts)]
    return resolved[0].unionByName(resolved[1])


def text_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", tx.text_length(F.col("text")).cast("bigint").alias("n_chars"))


def union_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusflow.operators.telemetry import union_history

    documents = table(spark, sf_dir, "documents").select(F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), "text")
    items = table(spark, sf_dir, "benchmark").select(F.lit("benchmark").alias("origin"), F.col("item_id").alias("id"), "text")
    return union_history(documents, items)


QUERIES = {
    "scan_documents": scan_documents,
    "read_json_doc": read_json_doc,
    "read_json_array": read_json_array,
    "read_jsonl": read_jsonl,
    "read_named": read_named,
    "resolve_source": resolve_source,
    "select_split": select_split,
    "save_reload_roundtrip": save_reload_roundtrip,
    "dataset_metadata": dataset_metadata,
    "resolve_text_column": resolve_text_column,
    "text_length": text_length,
    "union_history": union_history,
}

_ALL_DOCUMENTS = "SELECT doc_id, text, lang, source, n_chars FROM documents"

ORACLE = {
    "scan_documents": _ALL_DOCUMENTS,
    "read_json_doc": "SELECT item_id, text FROM benchmark",
    "read_json_array": _ALL_DOCUMENTS,
    "read_jsonl": _ALL_DOCUMENTS,
    "read_named": "SELECT conv_id, turn, role, text FROM conversations",
    "resolve_source": """
        SELECT 'path' AS origin, text FROM documents
        UNION ALL SELECT 'lines' AS origin, text FROM benchmark
        UNION ALL SELECT 'folder' AS origin, url AS text FROM pages
        UNION ALL SELECT 'name' AS origin, text FROM conversations""",
    "select_split": """
        SELECT doc_id, text,
               CASE WHEN substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) IN ('0', '1')
                    THEN 'validation' ELSE 'train' END AS split
        FROM documents""",
    "save_reload_roundtrip": _ALL_DOCUMENTS,
    "dataset_metadata": """
        SELECT 'documents' AS dataset_name, count(*) AS num_examples, CAST(2048 AS INTEGER) AS max_length,
               'train' AS split, ['doc_id', 'text', 'lang', 'source', 'n_chars'] AS features,
               count(*) FILTER (WHERE text IS NULL) AS null_texts
        FROM documents""",
    "resolve_text_column": """
        SELECT 'text' AS text_column, text AS content FROM documents
        UNION ALL SELECT 'p_name' AS text_column, p_name AS content FROM part""",
    "text_length": "SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars FROM documents",
    "union_history": """
        SELECT 'documents' AS origin, doc_id AS id, text FROM documents
        UNION ALL SELECT 'benchmark' AS origin, item_id AS id, text FROM benchmark""",
}
