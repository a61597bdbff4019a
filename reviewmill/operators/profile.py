"""Profiles of raw facts: fan-out, tips, domains, cents, customers, text lengths."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.session import fresh_path


def duplicate_fanout(raw: DataFrame, attributes: tuple[str, ...]) -> DataFrame:
    """Per source and rows-per-id: how many ids, and in how many each attribute disagrees.

    Disagreement is min against max, which needs one pass and no distinct sets. Texts are
    compared by 64-bit hash, so aggregation buffers stay fixed-width and texts stay home.
    """
    types = dict(raw.dtypes)

    def value(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.xxhash64(c)) if types[c] == "string" else F.col(c)

    per_id = raw.groupBy("source", "review_id").agg(
        F.count(F.lit(1)).alias("rows_per_id"),
        *[(F.min(value(c)) != F.max(value(c))).alias(f"conflict_{c}") for c in attributes],
    )
    return per_id.groupBy("source", "rows_per_id").agg(
        F.count(F.lit(1)).alias("ids"),
        *[F.count_if(F.col(f"conflict_{c}")).alias(f"conflict_{c}") for c in attributes],
    )


def tips(raw: DataFrame, tolerance: float = 0.1) -> DataFrame:
    """Stored against recomputed tip share, and shares of generous and zero tips, per source."""
    recomputed = F.col("tip_amount") / F.nullif(F.col("total_spent"), F.lit(0.0)) * 100
    gap = F.abs(recomputed - F.col("tip_percentage"))
    return raw.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(gap.isNotNull()).alias("comparable"),
        F.count_if(gap < tolerance).alias("consistent"),
        F.round(F.avg((F.col("tip_percentage") > 20).cast("int")), 6).alias("over_20_share"),
        F.round(F.avg((F.col("tip_amount") == 0).cast("int")), 6).alias("zero_tip_share"),
    )


def domain_gaps(raw: DataFrame, column: str, low: int, high: int) -> DataFrame:
    """Whole numbers of an expected range that a source never shows."""
    seen = raw.groupBy("source", column).agg(F.count(F.lit(1)).alias("_rows"))
    # listed by thousands first, so that no row ever holds the whole range
    blocks = seen.select("source").distinct().select("source", F.explode(F.sequence(F.lit(low), F.lit(high), F.lit(1000))).alias("_start"))
    numbers = F.sequence(F.col("_start"), F.least(F.col("_start") + 999, F.lit(high)))
    expected = blocks.select("source", F.explode(numbers).alias(column)).withColumn(column, F.col(column).cast("int"))
    return expected.join(seen.select("source", column), ["source", column], "left_anti")


def spend_per_person(raw: DataFrame, low: float) -> DataFrame:
    """Spend per head by source: smallest, median, 99th percentile and rows under a limit, all exact."""
    head = F.when(F.col("party_size") > 0, F.col("total_spent") / F.col("party_size"))
    priced = raw.select("source", head.alias("per_person")).filter(F.col("per_person").isNotNull())
    totals = priced.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.min("per_person"), 4).alias("lowest"),
        F.count_if(F.col("per_person") < low).alias("below_limit"),
    )
    found = discrete_percentiles(priced, "source", "per_person", {"median": 0.5, "p99": 0.99})
    return totals.join(found, "source").select(
        "source", "n_rows", "lowest", F.round("median", 4).alias("median"), F.round("p99", 4).alias("p99"), "below_limit"
    )


def discrete_percentiles(rows: DataFrame, by: str, column: str, shares: dict[str, float]) -> DataFrame:
    """The smallest value of each group that at least a share of its rows do not exceed, exact for any number of values."""
    def rank(share: float) -> Callable[[Column], Column]:
        return lambda n: F.greatest(F.ceil(F.lit(share) * n), F.lit(1))

    return values_at(rows, by, column, {name: rank(share) for name, share in shares.items()})


def interpolated_percentile(rows: DataFrame, by: str, column: str, share: float, name: str) -> DataFrame:
    """The value at a share of the way from the first to the last of each group, between its two neighbours; exact for any number."""
    place = {"_low": lambda n: F.floor(F.lit(share) * (n - 1)) + 1, "_high": lambda n: F.ceil(F.lit(share) * (n - 1)) + 1}
    found = values_at(rows, by, column, place)
    along = F.lit(share) * (F.col("_all") - 1) - F.floor(F.lit(share) * (F.col("_all") - 1))
    return found.select(by, (F.col("_low") * (1 - along) + F.col("_high") * along).alias(name))


def values_at(rows: DataFrame, by: str, column: str, ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """The values of each group at given ranks (functions of the group's size, from 1), and the size in ``_all``.

    Rows are written once, by bins of magnitude, a bounded number per group. Running totals of the bins name the one bin that
    holds a rank, and only that bin's values are counted and put in order.
    """
    value = F.col(column).cast("double")
    size = F.floor(F.log2(F.abs(value) + 1) * 256)
    path = fresh_path(rows.sparkSession, "bins")
    rows.filter(value.isNotNull()).select(by, value.alias("_value"), F.when(value < 0, -size - 1).otherwise(size).alias("_bin")).write.parquet(path)
    binned = rows.sparkSession.read.parquet(path)
    bins = binned.groupBy(by, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy(by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = F.sum("_n").over(Window.partitionBy(by))
    asked = F.array(*[F.struct(F.lit(name).alias("name"), rank(F.col("_all")).cast("bigint").alias("rank")) for name, rank in ranks.items()])
    placed = bins.withColumns({"_upto": F.sum("_n").over(running), "_all": whole}).select(
        by, "_bin", (F.col("_upto") - F.col("_n")).alias("_before"), "_upto", "_all", F.explode(asked).alias("_p"))
    rank = F.col("_p.rank")
    wanted = placed.filter((rank > F.col("_before")) & (rank <= F.col("_upto"))).select(
        by, "_bin", "_all", F.col("_p.name").alias("_name"), (rank - F.col("_before")).alias("_rank"))
    values = binned.join(wanted.select(by, "_bin").distinct(), [by, "_bin"], "left_semi").groupBy(by, "_bin", "_value").agg(
        F.count(F.lit(1)).alias("_n"))
    inside = Window.partitionBy(by, "_bin").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = values.withColumn("_upto", F.sum("_n").over(inside))
    met = ordered.join(wanted, [by, "_bin"]).filter((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank")))
    return met.groupBy(by).agg(*[F.max(F.when(F.col("_name") == name, F.col("_value"))).alias(name) for name in ranks], F.max("_all").alias("_all"))


def customer_overlap(raw: DataFrame) -> DataFrame:
    """Per prefix and number of restaurants: customer ids seen in that many restaurants."""
    split = F.split("customer_id", "_")
    seen = raw.filter(F.col("customer_id").isNotNull()).groupBy("customer_id", "source").agg(F.count(F.lit(1)).alias("visits"))
    per_customer = seen.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("restaurants"), F.sum("visits").alias("visits")
    )
    return per_customer.groupBy(split[0].alias("prefix"), "restaurants").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("visits").alias("visits")
    )


def cents_of(amount: Column) -> Column:
    """Last two digits of an amount, kept exact through a decimal."""
    return F.pmod((amount.cast("decimal(18,2)") * 100).cast("bigint"), F.lit(100)).cast("int")


def cent_uniformity(raw: DataFrame, column: str = "total_spent") -> DataFrame:
    """Chi-square of the 100 cent endings against a flat spread, per source.

    With equal expectation e = n/100 the statistic is sum(o^2)/e - n, in which endings
    never seen add nothing; so they need no row.
    """
    endings = raw.filter(F.col(column).isNotNull()).groupBy("source", cents_of(F.col(column)).alias("cents")).agg(
        F.count(F.lit(1)).alias("n")
    )
    square = F.col("n").cast("double") * F.col("n")
    return endings.groupBy("source").agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("endings"),
        F.round(F.sum(square) * 100 / F.sum("n") - F.sum("n"), 4).alias("chi_square"),
    )


def text_lengths(docs: DataFrame, text: str, limit: int) -> DataFrame:
    """Share of texts longer than the embedding limit, per restaurant."""
    return docs.filter(F.col(text).isNotNull()).groupBy("restaurant_id").agg(
        F.count(F.lit(1)).alias("texts"),
        F.count_if(F.length(text) > limit).alias("over_limit"),
        F.round(F.avg((F.length(text) > limit).cast("int")), 6).alias("over_limit_share"),
        F.max(F.length(text)).alias("longest"),
    )


def restaurant_summary(facts: DataFrame, dimension: DataFrame) -> DataFrame:
    """Stars and review counts computed from the facts, beside the dimension."""
    stats = facts.groupBy("restaurant_id").agg(
        F.round(F.avg("rating"), 6).alias("avg_rating"),
        F.count(F.lit(1)).alias("reviews"),
        F.count("rating").alias("rated"),
        F.sum("transaction_count").alias("submissions"),
    )
    return dimension.join(stats, "restaurant_id", "left").fillna(0, ["reviews", "rated", "submissions"])


def docs_per_restaurant(index: DataFrame, n: int = 10) -> DataFrame:
    """The index total and its n largest restaurants: ``scope, restaurant_id, docs``."""
    counts = index.rollup("restaurant_id").agg(
        F.count(F.lit(1)).alias("docs"), F.grouping("restaurant_id").alias("_total")
    )
    return (
        counts.orderBy(F.desc("_total"), F.desc("docs"), "restaurant_id").limit(n + 1)
        .select(F.when(F.col("_total") == 1, "total").otherwise("restaurant").alias("scope"), "restaurant_id", "docs")
    )
