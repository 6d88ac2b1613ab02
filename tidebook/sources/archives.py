"""JSON-lines archives: paths, numbered lines, strict parsing."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Behind each line when it is parsed: only a line that is one whole JSON value keeps it in its place.
SENTINEL = "tidebook-5c1f0e9a-end-of-line"
SUFFIXES = (".jsonl", ".jsonl.gz")


def resolve_inputs(spark: SparkSession, paths: list[str], min_age_seconds: float = 0) -> list[str]:
    """Distinct files below the paths (folders recursively) that end in .jsonl or .jsonl.gz, sorted;
    those in folders only if they were last modified `min_age_seconds` ago or earlier.

    Any Hadoop file system; FileNotFoundError if a path doesn't exist, isn't such a file, or if there
    is no file at all.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found: set[str] = set()
    latest = (time.time() - min_age_seconds) * 1000
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(conf)
        if not fs.exists(at):
            raise FileNotFoundError(path)
        if fs.getFileStatus(at).isFile():
            if not path.endswith(SUFFIXES):
                raise FileNotFoundError(f"{path} is not an archive")
            found.add(fs.makeQualified(at).toString())
            continue
        files = fs.listFiles(at, True)
        while files.hasNext():
            file = files.next()
            name = file.getPath().toString()
            if name.endswith(SUFFIXES) and file.getModificationTime() <= latest:
                found.add(name)
    if not found:
        raise FileNotFoundError(", ".join(paths))
    return sorted(found)


def common_root(paths: list[str]) -> str:
    """The deepest folder that holds all paths, which may lie below several roots."""
    parts = [p.rsplit("/", 1)[0].split("/") for p in paths]
    same = 0
    while parts and all(len(p) > same and p[same] == parts[0][same] for p in parts):
        same += 1
    return "/".join(parts[0][:same]) if parts else ""


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """source_file, source_bytes (the file's size), source_block (where the split starts), source_line (from
    1, blank lines count) and value of every line.

    Lines are numbered within a split, and the splits' counts are summed up over a file: a file that
    is cut into many splits is numbered by as many tasks.
    """
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_size").alias("source_bytes"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    within = Window.partitionBy("source_file", "block").orderBy("at")
    counts = lines.groupBy("source_file", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("source_file", "block", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("start"))
    numbered = lines.withColumn("no", F.row_number().over(within)).join(starts, ["source_file", "block"])
    return numbered.select("source_file", "source_bytes", F.col("block").alias("source_block"), (F.col("start") + F.col("no")).alias("source_line"), "value")


def parsed(lines: DataFrame, column: str = "value") -> DataFrame:
    """Adds record (VARIANT, null unless the line is one JSON object), invalid_json, not_object,
    record_type and canonical (the record's JSON with sorted keys)."""
    whole = F.try_parse_json(F.concat(F.lit("["), F.col(column), F.lit(f',"{SENTINEL}"]')))
    out = lines.withColumn("__all", whole)
    sound = (F.try_variant_get("__all", "$[1]", "string") == SENTINEL) & F.try_variant_get("__all", "$[2]", "variant").isNull()
    out = out.withColumn("__sound", F.coalesce(sound, F.lit(False)))
    value = F.try_variant_get("__all", "$[0]", "variant")
    is_object = F.startswith(F.schema_of_variant(value), F.lit("OBJECT"))
    out = out.withColumns({"invalid_json": ~F.col("__sound"), "not_object": F.col("__sound") & ~F.coalesce(is_object, F.lit(False))})
    out = out.withColumn("record", F.when(F.col("__sound") & ~F.col("not_object"), value))
    return out.withColumns({"record_type": F.try_variant_get("record", "$.record_type", "string"), "canonical": F.to_json("record")}).drop("__all", "__sound")
