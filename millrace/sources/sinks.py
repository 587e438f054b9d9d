"""Writers: Parquet parts of bounded size with a manifest, text corpora, JSON documents."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources import files

#: Rows a part file holds at most.
PART_ROWS = 250_000


def write_parts(rows: DataFrame, path: str, part_rows: int = PART_ROWS, mode: str = "errorifexists") -> DataFrame:
    """Write zstd Parquet parts of at most ``part_rows`` rows and give (file, n_rows); no rows at all are an error."""
    rows.write.mode(mode).option("maxRecordsPerFile", part_rows).option("compression", "zstd").parquet(path)
    counts = rows.sparkSession.read.schema(rows.schema).parquet(path).groupBy(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file")).agg(F.count("*").alias("n_rows"))
    if counts.isEmpty():
        raise ValueError(f"no rows were written to {path}")
    return counts


def manifest(spark: SparkSession, path: str, **facts: str) -> DataFrame:
    """(path, sha256, bytes, facts) of what a folder of parts holds."""
    return files.inventory(spark, path, "*.parquet").withColumn("facts", F.lit(json.dumps(facts, sort_keys=True)))


def append_shard(rows: DataFrame, path: str) -> bool:
    """Append rows as new files, unless there are none."""
    if rows.isEmpty():
        return False
    rows.write.mode("append").option("compression", "zstd").parquet(path)
    return True


def write_lines(lines: DataFrame, path: str, column: str = "line", mode: str = "errorifexists") -> None:
    lines.select(column).write.mode(mode).text(path)


def write_document(rows: DataFrame, path: str, most: int = 10_000) -> None:
    """One small JSON document (a manifest or a status), written whole or not at all: more than ``most`` rows are an error."""
    lines = rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).limit(most + 1).toPandas()["j"]
    if len(lines) > most:
        raise ValueError(f"more than {most} rows for one document")
    data = [json.loads(r) for r in lines]
    part = f"{path}.part"
    with open(part, "w", encoding="utf-8") as out:
        json.dump(data[0] if len(data) == 1 else data, out, ensure_ascii=False, sort_keys=True, indent=1)
    os.replace(part, path)
