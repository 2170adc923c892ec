"""Reading and writing the tiers of a corpus."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, is_dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system of a path, so that any store that Spark reads will do."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType, strict: bool = False) -> DataFrame:
    """All lines below a folder. A missing folder is empty. Adds bad_json; strict fails on malformed lines instead."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not exists(spark, path):
        return spark.createDataFrame([], schema).withColumn("bad_json", F.lit(False))
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json*")
    if strict:
        return reader.schema(schema).option("mode", "FAILFAST").json(path).withColumn("bad_json", F.lit(False))
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = reader.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return rows.withColumn("bad_json", F.col(CORRUPT).isNotNull()).drop(CORRUPT)


def read_html(spark: SparkSession, path: str) -> DataFrame:
    """source_url, html, license of *.html files, with what a sidecar <name>.meta.json says; without one the file's own address."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.html").load(path)
    pages = files.select(F.regexp_replace("path", r"\.html$", "").alias("stem"), F.decode(F.col("content"), "UTF-8").alias("html"))
    try:
        meta = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.meta.json").load(path)
        meta = meta.select(F.regexp_replace("path", r"\.meta\.json$", "").alias("stem"), F.from_json(F.decode(F.col("content"), "UTF-8"), "source_url string, license string").alias("m"))
        pages = pages.join(meta, "stem", "left")
    except AnalysisException:  # no sidecars at all
        pages = pages.withColumn("m", F.lit(None).cast("struct<source_url:string,license:string>"))
    return pages.select(F.coalesce("m.source_url", F.concat("stem", F.lit(".html"))).alias("source_url"), "html", F.col("m.license").alias("license"))


def label_sources(base: DataFrame, new: DataFrame, priority: list[str]) -> DataFrame:
    """Both datasets with _source: the first two names of the priority list, or base and new."""
    names = [*priority, *["base", "new"][len(priority) :]][:2]
    return base.withColumn("_source", F.lit(names[0])).unionByName(new.withColumn("_source", F.lit(names[1])), allowMissingColumns=True)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_record_parquet(df: DataFrame, path: str) -> None:
    """One JSON string column, only if there are rows."""
    if not df.isEmpty():
        df.select(F.to_json(F.struct("*")).alias("record")).write.mode("overwrite").parquet(path)


def config_hash(*parts) -> str:
    plain = [asdict(p) if is_dataclass(p) else p for p in parts]
    return hashlib.sha256(json.dumps(plain, sort_keys=True, default=str).encode()).hexdigest()[:16]


def write_manifest(spark: SparkSession, path: str, data: dict) -> None:
    fs, p = _fs(spark, f"{path}/manifest.json")
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(data, ensure_ascii=False).encode()))
    out.close()


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    if not exists(spark, f"{path}/manifest.json"):
        return None
    return json.loads("\n".join(r.value for r in spark.read.text(f"{path}/manifest.json").collect()))


def is_done(spark: SparkSession, path: str, config: str) -> bool:
    """A finished tier made with the same settings can be taken as it is."""
    return exists(spark, f"{path}/_SUCCESS") and (read_manifest(spark, path) or {}).get("config") == config


def drop_counts(status: DataFrame, reason: str = "drop_reason") -> dict:
    """seen, kept and the count of each reason: a handful of rows."""
    kind = F.coalesce(F.split_part(F.col(reason), F.lit(":"), F.lit(1)), F.lit("kept"))
    found = {r.kind: r.n for r in status.groupBy(kind.alias("kind")).agg(F.count("*").alias("n")).collect()}
    return {"seen": sum(found.values()), "kept": found.pop("kept", 0), "dropped": found}
