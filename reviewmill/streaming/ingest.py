"""File-arrival jobs: raw files to silver, silver to index.

All drain what has arrived and stop (``availableNow``), or keep running on a trigger. A
checkpoint remembers the files seen. Every sink write can be repeated: silver replaces
the partitions of the files at hand, the index takes unseen ids only.

``ingest_lake`` lists ``raw/`` once for all sources. A batch is a bounded list of files in order of arrival; the mapping config is read anew
for every batch, so a change takes effect with the next one, and a ledger beside the facts holds per file what became of it and under
which version of the config. The first file that cannot be read stops the batch: files before it are loaded, it is marked with
its error, files behind it wait, and the stream fails. After repair the same batch runs again. Files of no bytes are not seen.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reviewmill.contracts import FACT_SCHEMA, NA_TOKENS, RAW_REFERENCE_COLUMNS
from reviewmill.functions.text import na_to_null
from reviewmill.operators.dedup import without_id
from reviewmill.operators.dimension import conform_dimension, standardize_dimension
from reviewmill.operators.headers import SourceConfig, rename_headers
from reviewmill.operators.index import append_documents
from reviewmill.operators.routing import is_reference_key, source_of
from reviewmill.plans.facts import standardize_facts
from reviewmill.sources.files import (
    LARGE_FILE, read_mapping_config, read_raw_csv, relative_key, spans_lines, with_lineage, write_dimension, write_silver,
)

FILE_UNIT = ("source", "file_key")
MAX_FILES = 1_000  # files of one batch; their list is what comes to the driver
LEDGER = "batch_key string, file_key string, modified timestamp, n_bytes bigint, kind string, source string, status string, error string, config_version string"


def read_versioned_config(spark: SparkSession, path: str, root: str) -> tuple[SourceConfig, str]:
    """The mapping config as it stands now and its version, which ``<root>/config_versions`` keeps with its rows."""
    rows = read_mapping_config(spark, path)
    listed = sorted(rows.collect(), key=lambda r: r["pos"])
    version = hashlib.sha256(repr([tuple(r)[:-1] for r in listed]).encode()).hexdigest()[:16]
    rows.withColumn("config_version", F.lit(version)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("config_version").parquet(f"{root}/config_versions")
    return SourceConfig.from_frame(rows), version


def _arrivals(spark: SparkSession, root: str, max_files: int) -> DataFrame:
    """New files below ``raw/`` as a stream; contents are not read."""
    return (
        spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
        .options(recursiveFileLookup=True, maxFilesPerTrigger=max_files).load(f"{root.rstrip('/')}/raw")
        .select("path", relative_key(F.col("_metadata.file_path"), root).alias("file_key"), F.col("modificationTime").alias("modified"), F.col("length").alias("n_bytes"))
    )


def _headers(spark: SparkSession, root: str, paths: list[str]) -> dict[str, str]:
    """First line by file key, read where the files are; an empty file has none."""
    lines = spark.read.text(paths).where("_metadata.file_block_start = 0").select(
        relative_key(F.col("_metadata.file_path"), root).alias("file_key"), "value", F.monotonically_increasing_id().alias("at"))
    return {r["file_key"]: r["line"] for r in lines.groupBy("file_key").agg(F.min_by("value", "at").alias("line")).collect()}


def _routed(spark: SparkSession, files: DataFrame, config: SourceConfig) -> list[Row]:
    """The batch's files in order of arrival, each with its kind and source."""
    source = source_of(F.col("file_key"), config.sources)
    kind = F.when(is_reference_key(F.col("file_key")), "dimension").when(source.isNotNull(), "fact").otherwise("unknown")
    rows = files.select("*", kind.alias("kind"), F.when(kind == "fact", source).alias("source")).collect()
    return sorted(rows, key=lambda r: (r["modified"], r["file_key"]))


def _fault(file: Row, header: str | None, columns: list[str], config: SourceConfig) -> str | None:
    """Why a file cannot be loaded, None if it can."""
    if file["kind"] == "unknown":
        return "no configured source in the key"
    if header is None:
        return "no header"
    if file["kind"] == "dimension":
        return None if "location" in columns else "no location column"
    known = {*config.headers[file["source"]], *config.headers[file["source"]].values()}
    return None if known & set(columns) else "no configured column in the header"


def _read_group(spark: SparkSession, files: list[Row], multi_line: bool | str | None, large: int) -> DataFrame:
    """Files of one header. Large files are read by many tasks, also where cells run over line breaks."""
    paths = [f["path"] for f in files]
    if multi_line is None:
        multi_line = True if max(f["n_bytes"] for f in files) <= large else "splits" if spans_lines(spark, paths) else False
    return read_raw_csv(spark, paths, multi_line)


def _load_facts(root: str, raw: DataFrame, config: SourceConfig, all_have_ids: bool) -> None:
    """Facts to silver, rows without an id to quarantine; files without an id column keep their rows as they are."""
    lost = Observation()
    # Counted while the facts are written, so the batch is read again only for rows to set aside.
    observed = raw.observe(lost, F.count_if(F.col("has_id") & F.col("review_id").isNull()).alias("rows"))
    if all_have_ids:
        observed = observed.drop("has_id")
    facts = standardize_facts(observed, config.divisor_of(F.col("source")), unit=FILE_UNIT)
    write_silver(facts, f"{root}/processed/facts", ("restaurant_id", "file_key"))
    if lost.get["rows"]:
        write_silver(without_id(raw.filter("has_id").drop("has_id")), f"{root}/quarantine/rows", ("source", "file_key"))


def load_files(
    spark: SparkSession, root: str, files: DataFrame, config: SourceConfig, version: str = "", batch_key: str = "",
    only: Iterable[str] | None = None, dimension: bool = True, multi_line: bool | str | None = None, large: int = LARGE_FILE,
) -> None:
    """Load a bounded list of arrived files in order, up to the first that cannot be; then fail with its error.

    ``only`` names the sources to take, files of others are passed over. The ledger is written before a failure.
    """
    listed = [
        f for f in _routed(spark, files, config)
        if (f["kind"] == "dimension" and dimension) or (f["kind"] == "fact" and (only is None or f["source"] in only)) or (f["kind"] == "unknown" and only is None)
    ]
    headers = _headers(spark, root, [f["path"] for f in listed]) if listed else {}
    columns: dict[str, list[str]] = {}
    good, fault = [], None
    for file in listed:
        line = headers.get(file["file_key"])
        if line is not None and line not in columns:
            columns[line] = read_raw_csv(spark, file["path"]).columns[:-2]
        fault = _fault(file, line, columns.get(line, []), config)
        if fault:
            break
        good.append(file)

    groups: dict[tuple[str, str], list[Row]] = {}
    for file in good:
        if file["kind"] == "fact":
            groups.setdefault((file["source"], headers[file["file_key"]]), []).append(file)
    raw, all_have_ids = None, True
    for (source, _), group in groups.items():
        renamed, _ = rename_headers(_read_group(spark, group, multi_line, large), config.headers[source])
        part = with_lineage(renamed, root, source)
        all_have_ids = all_have_ids and "review_id" in renamed.columns
        raw = part if raw is None else raw.unionByName(part)
    if raw is not None:
        _load_facts(root, raw, config, all_have_ids)
    for file in [f for f in good if f["kind"] == "dimension"][-1:]:
        clean = conform_dimension(standardize_dimension(read_raw_csv(spark, file["path"]).drop("path", "pos")))
        write_dimension(clean, f"{root}/processed/reference")

    if batch_key and listed:
        told = [(f, "loaded", None) for f in good] + [(f, "failed", fault) for f in listed[len(good):len(good) + 1]] + [
            (f, "waiting", None) for f in listed[len(good) + 1:]]
        rows = [(batch_key, f["file_key"], f["modified"], f["n_bytes"], f["kind"], f["source"], status, error, version) for f, status, error in told]
        spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("batch_key").parquet(f"{root}/ledger")
    if fault:
        raise ValueError(f"{listed[len(good)]['file_key']}: {fault}")


def ingest_lake(
    spark: SparkSession, root: str, config: str | SourceConfig, checkpoint: str, max_files: int = MAX_FILES, every: str | None = None,
    multi_line: bool | str | None = None, large: int = LARGE_FILE,
) -> StreamingQuery:
    """Load new raw files of all sources and the dimension, in order of arrival.

    ``config`` is the path of the mapping config, read anew in every batch, or a fixed one. ``every`` is a trigger interval for a query
    that keeps running; without it the query drains what has arrived and stops. A file is the unit of deduplication, and a file
    arriving again under its key replaces its former result. Rows without an id go to quarantine.
    """
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        settings, version = read_versioned_config(session, config, root) if isinstance(config, str) else (config, "fixed")
        load_files(session, root, batch, settings, version, f"{name}-{batch_id}", multi_line=multi_line, large=large)

    return _run(_arrivals(spark, root, max_files), load, checkpoint, every)


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """What became of every file of every batch, under which config; a batch run again replaces its rows."""
    return spark.read.schema(LEDGER).parquet(f"{root}/ledger")


def ingest_source(
    spark: SparkSession, root: str, source: str, config: SourceConfig, checkpoint: str,
    max_files: int = MAX_FILES, multi_line: bool | str | None = None, large: int = LARGE_FILE,
) -> StreamingQuery:
    """Drain new raw files of one source into ``<root>/processed/facts``.

    The longest configured name in the key decides, so a nested name leaves files to it. Files of other sources are pruned, not opened.
    """
    key = F.col("file_key")
    mine = _arrivals(spark, root, max_files).filter((source_of(key, config.sources) == source) & ~is_reference_key(key))

    def load(batch: DataFrame, batch_id: int) -> None:
        load_files(batch.sparkSession, root, batch, config, only=(source,), dimension=False, multi_line=multi_line, large=large)

    return _run(mine, load, checkpoint)


def quarantine_unknown(spark: SparkSession, root: str, config: SourceConfig, checkpoint: str) -> StreamingQuery:
    """List new raw files that no source and no dimension claims in ``<root>/quarantine/files``; contents are not read."""
    arrived = (
        spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", "true").load(f"{root.rstrip('/')}/raw")
        .select(relative_key(F.col("_metadata.file_path"), root).alias("file_key"), F.col("length").alias("n_bytes"), "modificationTime")
    )
    unknown = arrived.filter(source_of(F.col("file_key"), config.sources).isNull() & ~is_reference_key(F.col("file_key")))
    return (
        unknown.writeStream.format("parquet").option("path", f"{root}/quarantine/files").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def ingest_dimension(spark: SparkSession, root: str, checkpoint: str, columns: list[str] | None = None) -> StreamingQuery:
    """Drain new dimension files; the latest file replaces the dimension."""
    names = columns or list(RAW_REFERENCE_COLUMNS)
    stream = (
        spark.readStream.format("csv").schema(", ".join(f"`{c}` string" for c in names))
        .options(header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8", enforceSchema=False, recursiveFileLookup=True, maxFilesPerTrigger=1)
        .load(f"{root.rstrip('/')}/raw")
    )
    mine = stream.select(*[na_to_null(F.col(f"`{c}`"), NA_TOKENS).alias(c) for c in names], F.col("_metadata.file_path").alias("path")).filter(
        is_reference_key(relative_key(F.col("path"), root)))

    def load(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write_dimension(conform_dimension(standardize_dimension(batch.drop("path"))), f"{root}/processed/reference")

    return _run(mine, load, checkpoint)


def index_stream(
    spark: SparkSession, root: str, index_path: str, checkpoint: str, model: Callable | None = None, max_files: int | None = None
) -> StreamingQuery:
    """Drain new silver files into the review index."""
    partitioned = "restaurant_id string, file_key string"
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FACT_SCHEMA.fields if f.name != "restaurant_id")
    reader = spark.readStream.schema(f"{schema}, {partitioned}")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    silver = reader.parquet(f"{root}/processed/facts")

    def load(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("pos", F.monotonically_increasing_id())
        append_documents(rows, index_path, ("file_key", "pos"), model)

    return _run(silver, load, checkpoint)


def _run(stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
