"""Raw files in, silver tables and CSV exports out."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.contracts import (
    CONFIG_SCHEMA, EVAL_CASE_SCHEMA, NA_TOKENS,
)
from reviewmill.functions.text import na_to_null
from reviewmill.operators.dimension import categories_json
from reviewmill.operators.headers import SourceConfig, conform_raw, rename_headers
from reviewmill.operators.routing import decode_key, is_reference_key, source_of
from reviewmill.sources.multiline import read_csv_in_splits


LARGE_FILE = 256 << 20


def read_mapping_config(spark: SparkSession, path: str) -> DataFrame:
    """Mapping config with its row order in ``pos``; a malformed row fails the read."""
    return (
        spark.read.schema(CONFIG_SCHEMA)
        .csv(path, sep=";", header=True, mode="FAILFAST", enforceSchema=False)
        .withColumn("pos", F.monotonically_increasing_id())
    )


def load_config(spark: SparkSession, path: str) -> SourceConfig:
    return SourceConfig.from_frame(read_mapping_config(spark, path))


# Scheme and authority of a file URI; what follows is the path.
AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?"


def relative_key(uri: Column, root: str) -> Column:
    """Key below the lake root, as ``raw/...``, from an encoded file URI."""
    start = re.sub(AUTHORITY, "", root.rstrip("/")) + "/"
    path = F.regexp_replace(decode_key(F.replace(uri, F.lit("+"), F.lit("%2B"))), AUTHORITY, "")
    return F.when(F.startswith(path, F.lit(start)), F.substring(path, len(start) + 1, 1 << 20)).otherwise(path)


def list_keys(spark: SparkSession, root: str, prefix: str = "raw/") -> DataFrame:
    """``path, length, file_key`` of every file under a prefix; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(f"{root.rstrip('/')}/{prefix}")
        .select("path", "length", relative_key(F.col("_metadata.file_path"), root).alias("file_key"))
    )


def read_raw_csv(
    spark: SparkSession, paths: str | Iterable[str], multi_line: bool | str = True, columns: list[str] | None = None, where: Column | None = None,
) -> DataFrame:
    """All-string read of comma files whatever their extension.

    Missing-value spellings become null, ``pos`` is the row order inside a file and
    ``path`` the file. Quoted newlines need ``multi_line``: True makes a file one task, ``"splits"`` reads large files by many
    tasks (see ``multiline``); False is for texts without newlines. Files read together must
    share one header: a differing header fails instead of shifting columns. ``where``, over the file path alone, prunes files
    below ``paths`` and needs ``columns``, their header.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if multi_line == "splits":
        df = read_csv_in_splits(spark, paths, where)
        return df.select(*[na_to_null(F.col(f"`{c}`"), NA_TOKENS).alias(c) for c in df.columns[:-2]], "pos", "path")
    reader = spark.read.options(
        header=True, multiLine=multi_line, quote='"', escape='"', encoding="UTF-8", inferSchema=False, enforceSchema=False, mode="PERMISSIVE",
        recursiveFileLookup=where is not None)
    if columns is not None:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    df = reader.csv(paths)
    names = df.columns
    if where is not None:
        df = df.where(where)
    return df.select(
        *[na_to_null(F.col(f"`{c}`"), NA_TOKENS).alias(c) for c in names],
        F.monotonically_increasing_id().alias("pos"),
        F.col("_metadata.file_path").alias("path"),
    )


def spans_lines(spark: SparkSession, paths: str | list[str], where: Column | None = None) -> bool:
    """Whether a quoted cell runs over a line break: some line then holds an odd number of quotes."""
    lines = spark.read.option("recursiveFileLookup", where is not None).text(paths)
    if where is not None:
        lines = lines.where(where)
    odd = F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1
    return not lines.filter(odd).isEmpty()


def read_facts(
    spark: SparkSession, root: str, config: SourceConfig, multi_line: bool | str | None = None, large: int = LARGE_FILE
) -> tuple[DataFrame | None, DataFrame | None, DataFrame, dict[str, list[str]]]:
    """Every raw file below ``root``, routed by key.

    Returns the unioned raw facts (contract columns, ``source, file_key, pos`` and
    ``has_id``), the raw dimension, the table of keys without a known source, and the configured
    headers a source lacks. One row per source comes to the driver, with one file to take the header from; the reads are
    pruned by file path, so other sources' files are not opened. With ``multi_line`` left open, a source with a large file is read
    in splits: plain ones, unless a scan of its lines finds a cell that runs over a line break.
    """
    routed = list_keys(spark, root).select(
        "path", "length", "file_key", is_reference_key(F.col("file_key")).alias("is_reference"), source_of(F.col("file_key"), config.sources).alias("source"))
    unknown = routed.filter("NOT is_reference AND source IS NULL").select("file_key")
    groups = routed.groupBy("is_reference", F.when(~F.col("is_reference"), F.col("source")).alias("source")).agg(
        F.min_by("path", "file_key").alias("example"), F.max("length").alias("largest")).collect()
    key = relative_key(F.col("_metadata.file_path"), root)
    facts, dimension, absent = None, None, {}

    def read(example: str, mine: Column, mode: bool | str) -> DataFrame:
        columns = read_raw_csv(spark, example).columns[:-2]
        return read_raw_csv(spark, f"{root.rstrip('/')}/raw", mode, columns, mine)

    for group in sorted(groups, key=lambda g: config.sources.index(g["source"]) if g["source"] is not None else -1):
        if group["is_reference"]:
            dimension = read(group["example"], is_reference_key(key), True)
        elif group["source"] is not None:
            mine = (source_of(key, config.sources) == group["source"]) & ~is_reference_key(key)
            mode = multi_line
            if mode is None:
                mode = True if group["largest"] <= large else "splits" if spans_lines(spark, f"{root.rstrip('/')}/raw", mine) else False
            raw, missing = rename_headers(read(group["example"], mine, mode), config.headers[group["source"]])
            if missing:
                absent[group["source"]] = missing
            part = with_lineage(raw, root, group["source"])
            facts = part if facts is None else facts.unionByName(part)
    return facts, dimension, unknown, absent


def with_lineage(raw: DataFrame, root: str, source: str) -> DataFrame:
    """Raw contract columns plus source, file key, row order and whether an id column exists."""
    return conform_raw(
        raw.withColumns({
            "source": F.lit(source),
            "file_key": relative_key(F.col("path"), root),
            "has_id": F.lit("review_id" in raw.columns),
        }),
        ("source", "file_key", "pos", "has_id"),
    )


def write_silver(facts: DataFrame, path: str, partition: tuple[str, ...] = ("restaurant_id",)) -> None:
    """Partitioned Parquet; writing again replaces only the partitions present.

    The rebalance hint groups rows by partition value and splits a hot value over tasks,
    so file counts stay low without one task per restaurant.
    """
    facts.hint("rebalance", *partition).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*partition).parquet(path)


def write_dimension(dimension: DataFrame, path: str) -> None:
    dimension.write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header: dates in ISO form, category arrays as JSON text, nulls empty."""
    columns = []
    for name, dtype in df.dtypes:
        if dtype == "date":
            columns.append(F.date_format(name, "yyyy-MM-dd").alias(name))
        elif dtype == "array<string>":
            columns.append(categories_json(F.col(name)).alias(name))
        else:
            columns.append(F.col(name))
    df.select(*columns).write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="")


def save_results(results: DataFrame, path: str, run: str) -> None:
    """Keep the result table of a check or evaluation run beside those of other runs."""
    results.withColumn("run", F.lit(run)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("run").parquet(path)


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation cases from a JSON array file; extra fields are ignored."""
    return spark.read.schema(EVAL_CASE_SCHEMA).option("multiLine", "true").json(path)
