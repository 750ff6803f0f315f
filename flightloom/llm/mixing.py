"""Mixing sources to target weights along a curriculum that changes over the training run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightloom.llm.common import NOT_SPACE, null_safe_key, running_start
from flightloom.session import settle

WEIGHTS = (5, 2, 1)  # by the rank of the source, repeating
TOTAL = 1.5  # words in the mix, as a share of all words
MOST = 2  # times a source may be repeated
SLICE_DIGITS = 3  # 4,096 slices per source

# Knots (training time, relative weight) of each weight class; linear between the knots. Heavy
# sources come early, light ones late. Only the shape matters: each is scaled to the source's target.
CURRICULUM = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0)),
)


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACE)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, total: float, most: int, weights: tuple[int, ...]) -> DataFrame:
    """One row per source: source, source_size, rank, weight and target.

    ``sizes`` has one row (source, source_size) per source; that list, not the documents, is ordered
    in one place. Sources in code point order, null last, weigh ``weights`` in turn. A target stops
    at ``most`` times the source's size and what it leaves is shared by weight among the others:
    sources are taken by size over weight, and the first one that keeps its share ends the filling.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(rank, F.lit(len(weights))) + 1)
    ranked = sizes.select("source", "source_size", rank.alias("rank"), weight.alias("weight"))
    limit = (F.col("source_size") * most).cast("double")
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    filled = (
        ranked.withColumn("limit", limit)
        .withColumn("wanted", F.sum("source_size").over(Window.partitionBy()) * F.lit(total))
        .withColumn(
            "before",
            F.coalesce(F.sum("limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        )
        .withColumn("rest", F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn(
            "stops", (F.col("wanted") - F.col("before")) / F.col("rest") >= F.col("limit") / F.col("weight")
        )
    )
    whole = Window.partitionBy()
    stopped = F.sum(F.when(F.col("stops"), F.col("limit")).otherwise(0.0)).over(whole)
    free = F.sum(F.when(F.col("stops"), 0).otherwise(F.col("weight"))).over(whole)
    level = (F.col("wanted") - stopped) / F.nullif(free, F.lit(0))
    return filled.select(
        "source",
        "source_size",
        "rank",
        "weight",
        F.when(F.col("stops"), F.col("limit")).otherwise(F.col("weight") * level).alias("target"),
    )


def when_demanded(share: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """The time at which the integral of a piecewise linear weight reaches ``share`` of its whole."""
    areas = [(b - a) * (f + g) / 2 for (a, f), (b, g) in zip(knots, knots[1:])]
    whole, done, out = sum(areas), 0.0, None
    for ((a, f), (b, g)), area in zip(zip(knots, knots[1:]), areas):
        inside = F.greatest(share * whole - done, F.lit(0.0))
        slope = (g - f) / (b - a)
        if slope:
            time = F.lit(a) + (F.sqrt(F.greatest(F.lit(f * f) + inside * (2 * slope), F.lit(0.0))) - f) / slope
        else:
            time = F.lit(a) + (inside / f if f else F.lit(b - a))
        out = time if out is None else F.when(share * whole > done, time).otherwise(out)
        done += area
    return F.least(F.greatest(out, F.lit(knots[0][0])), F.lit(knots[-1][0]))


def plan_mix(
    docs: DataFrame,
    total: float = TOTAL,
    most: int = MOST,
    weights: tuple[int, ...] = WEIGHTS,
    curriculum=CURRICULUM,
) -> DataFrame:
    """Adds to every row of ``docs`` how often the mix takes it and when.

    Added columns: mix_size (words; null text: 0), mix_start (words of the source's documents before
    it), mix_source_size, mix_target, mix_copies, mix_positions (training time of each copy, 0 to 1). A source's documents are ordered by MD5 of
    doc_id; as many whole passes as fit its target take all of them, and a last pass takes those whose middle
    lies before the rest, so that the source's words miss the target by half a document at most.
    A copy's position inverts the integral of its source's weight over time at the middle of its
    words. A null source is a source; a null id sorts first; rows that repeat an id are separate documents.
    An empty text is placed but takes no words. Extra columns are kept; no names but ``mix_`` and
    ``__`` ones are taken. The result depends on the rows alone, never on their partitioning.
    """
    sized = docs.withColumn("mix_size", words_of(F.col("text"))).withColumn("__source", null_safe_key("source"))
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = sized.withColumn("__order", order).withColumn("__slice", F.substring("__order", 1, SLICE_DIGITS))
    sources = source_targets(
        settle(
            sized.groupBy("source").agg(F.sum("mix_size").alias("source_size")), "sources"
        ),
        total, most, weights,
    ).select(
        null_safe_key("source").alias("__source"),
        F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"),
        F.pmod("rank", F.lit(len(weights))).alias("__class"),
    )
    started = running_start(
        sized, ["__source"], "__slice", ["__order", "doc_id", "mix_size"], "mix_size", "mix_start"
    )
    size, target = F.col("mix_source_size"), F.col("mix_target")
    middle = F.col("mix_start") + F.col("mix_size") / 2
    passes = F.when(size > 0, F.floor(target / size)).otherwise(F.lit(0))
    rest = target - F.col("__passes") * size
    joined = started.join(sources, "__source").withColumn("__passes", passes)
    counted = joined.withColumn(
        "mix_copies", (F.col("__passes") + F.when((rest > 0) & (middle <= rest), 1).otherwise(0)).cast("long")
    )

    def position(copy: Column) -> Column:
        share = F.when(target > 0, (copy * size + middle) / target).otherwise(F.lit(0.0))
        out = None
        for i, knots in enumerate(curriculum):
            time = when_demanded(share, knots)
            out = time if out is None else F.when(F.col("__class") == i, time).otherwise(out)
        return out

    copies = F.when(F.col("mix_copies") > 0, F.sequence(F.lit(0), F.col("mix_copies") - 1)).otherwise(
        F.array().cast("array<bigint>")
    )
    return counted.withColumn("mix_positions", F.transform(copies, position)).drop(
        "__source", "__order", "__slice", "__passes", "__class"
    )


def mix(docs: DataFrame, with_plan: bool = False, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, range-sorted by training position.

    Columns of ``docs`` plus mix_copy (from 0) and mix_position. Ties sort by doc_id. ``with_plan`` keeps the
    plan's columns and adds the documents that are not taken; both added columns are null there.
    """
    planned = plan_mix(docs, **options)
    columns = [c for c in planned.columns if c != "mix_positions"] if with_plan else docs.columns
    copies = F.posexplode_outer if with_plan else F.posexplode
    taken = planned.select(*[F.col(c) for c in columns], copies("mix_positions").alias("mix_copy", "mix_position"))
    return taken.repartitionByRange("mix_position", "doc_id").sortWithinPartitions("mix_position", "doc_id")
