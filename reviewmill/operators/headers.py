"""Mapping config: header renames and rating divisors per source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.contracts import FACT_SCHEMA, RAW_FACT_COLUMNS


def header_maps(config: DataFrame) -> DataFrame:
    """``source, headers`` with one input-to-target map per source.

    Names are lower-cased after grouping: of two spellings the later in sort order stands.
    Within a spelling the last row for an input column (by ``pos``) wins.
    """
    return (
        config.groupBy("source_dataset", "input_column")
        .agg(F.max_by("target_column", "pos").alias("target"))
        .groupBy("source_dataset")
        .agg(F.map_from_entries(F.collect_list(F.struct("input_column", "target"))).alias("headers"))
        .groupBy(F.lower("source_dataset").alias("source"))
        .agg(F.max_by("headers", "source_dataset").alias("headers"))
    )


def rating_divisors(config: DataFrame) -> DataFrame:
    """``source, divisor, n_distinct``: first non-null divisor as a whole number, 1 if none."""
    given = F.when(F.col("rating_divisor").isNotNull(), F.col("pos"))
    return (
        config.groupBy("source_dataset")
        .agg(
            F.min_by("rating_divisor", given).alias("first"),
            F.count_distinct("rating_divisor").alias("n_distinct"),
        )
        .groupBy(F.lower("source_dataset").alias("source"))
        .agg(F.max_by(F.struct("first", "n_distinct"), "source_dataset").alias("picked"))
        .select(
            "source",
            F.coalesce(F.col("picked.first").cast("int"), F.lit(1)).alias("divisor"),
            F.col("picked.n_distinct").alias("n_distinct"),
        )
    )


@dataclass(frozen=True)
class SourceConfig:
    """The config as select lists need it: on the driver, one entry per configured source."""

    headers: dict[str, dict[str, str]]
    divisors: dict[str, int]
    conflicting: tuple[str, ...] = ()

    @classmethod
    def from_frame(cls, config: DataFrame) -> SourceConfig:
        rows = header_maps(config).join(rating_divisors(config), "source").collect()
        return cls(
            headers={r["source"]: dict(r["headers"]) for r in rows},
            divisors={r["source"]: r["divisor"] for r in rows},
            conflicting=tuple(sorted(r["source"] for r in rows if r["n_distinct"] > 1)),
        )

    @property
    def sources(self) -> list[str]:
        """Longest name first, so a nested name never shadows the longer one."""
        return sorted(self.headers, key=lambda s: (-len(s), s))

    def divisor_of(self, source: Column) -> Column:
        """Divisor lookup as an expression; 1 for a source without one."""
        entries = [F.lit(x) for item in sorted(self.divisors.items()) for x in item]
        if not entries:
            return F.lit(1)
        return F.coalesce(F.try_element_at(F.create_map(*entries), source), F.lit(1))


def rename_headers(df: DataFrame, mapping: dict[str, str]) -> tuple[DataFrame, list[str]]:
    """Apply one source's renames; also report configured columns the file lacks."""
    missing = sorted(c for c in mapping if c not in df.columns)
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns}), missing


def united_headers(df: DataFrame, maps: dict[str, dict[str, str]]) -> DataFrame:
    """Rows of many sources under their own headers, brought to the target columns in one pass over ``df``.

    A row takes a target from the header its source maps to it, or from the column of the target's own name.
    """
    targets = dict.fromkeys(t for mapping in maps.values() for t in mapping.values())
    renamed = {h for mapping in maps.values() for h in mapping}
    plain = [c for c in df.columns if c not in renamed and c not in targets]
    columns = []
    for target in targets:
        headers = [(s, h) for s, mapping in maps.items() for h, t in mapping.items() if t == target and h in df.columns]
        value = F.col(target) if target in df.columns else F.lit(None).cast("string")
        for source, header in headers:
            value = F.when(F.col("source") == source, F.col(header)).otherwise(value)
        columns.append(value.alias(target))
    return df.select(*plain, *columns)


def conform_raw(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Project on the raw contract; absent columns become null strings, others vanish."""
    present = set(df.columns)
    columns = [
        F.col(c).cast("string").alias(c) if c in present else F.lit(None).cast("string").alias(c)
        for c in RAW_FACT_COLUMNS
    ]
    return df.select(*columns, *[c for c in extra if c in present])


def conform(df: DataFrame, schema: T.StructType = FACT_SCHEMA, extra: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the schema's columns in its order and types; missing ones are null."""
    present = set(df.columns)
    columns = []
    for field in schema.fields:
        source = F.col(field.name).try_cast(field.dataType) if field.name in present else F.lit(None).cast(field.dataType)
        columns.append(source.alias(field.name, metadata=field.metadata))
    return df.select(*columns, *extra)


def schema_issues(df: DataFrame, contract: tuple[str, ...], ignore: tuple[str, ...] = ()) -> dict[str, list[str]]:
    """Missing and extra columns, and order when the set fits; driver-side metadata only."""
    actual = [c for c in df.columns if c not in ignore]
    missing = sorted(set(contract) - set(actual))
    extra = sorted(set(actual) - set(contract))
    disordered = [] if missing or extra or tuple(actual) == contract else actual
    return {"missing": missing, "extra": extra, "disordered": disordered}
