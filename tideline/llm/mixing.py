"""Mixing sources to target weights by systematic sampling.

Every document of a source expects the same number of copies, ``target / source size``.  Along
a fixed order of the source's documents the expected copies are summed up, one random offset
per source is added, and a document is emitted once for every integer its interval crosses.
The order is by size, so each stretch of similar documents gets its share and the words taken
stay within about one large document of the target.

The running sum needs each document's rank in its source.  No task ever sorts a whole source:
ranks are counts of smaller sizes (one row per size), plus counts of earlier hash slots of the
same size (``SLOTS`` rows), plus the rank inside one slot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import WORD, written

SEED = "mix-1"


def word_count(text: Column) -> Column:
    """Number of words of a text; none for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    ``sizes`` has one row per source (``source, source_size``).  Sources in code point order,
    null last, take ``weights`` in turn and share ``share`` times the sum of all sizes.  A target
    stops at ``most`` times its source's size; the excess is shared again by weight among the
    others.  That fixed point is found directly: by rising ``cap / weight`` the sources that
    stop come first, and the level of the rest follows from the sums before each source.
    """
    if share > most:
        raise ValueError("the sources cannot hold the share asked for")
    place = F.pmod(F.col("_place") - 1, F.lit(len(weights))) + 1
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("_ratio", "_place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0.0))
    levels = (
        sizes.withColumn("_place", F.row_number().over(by_name))
        .withColumn("_weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), place.cast("int")))
        .withColumn("_cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("_turn", F.row_number().over(by_ratio))
        # The level if all sources before this one stop.
        .withColumn("_level", (F.col("_total") - earlier("_cap")) / (F.sum("_weight").over(everything) - earlier("_weight")))
    )
    # It holds for all from the first source on that it does not fill.
    fits = F.when(F.col("_level") <= F.col("_ratio"), F.struct("_turn", "_level"))
    level = F.coalesce(F.min(fits).over(everything)["_level"], F.lit(float("inf")))
    return levels.withColumn("_held", level).select(
        "source", "source_size", F.least("_cap", F.col("_weight") * F.col("_held")).alias("target")
    )


def copies(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = SEED,
    slots: int = 4096,
) -> DataFrame:
    """Every row of ``docs`` with what the mix takes of it.

    Needs ``doc_id, source`` and ``_size`` (words, not null).  Adds ``_source_size``,
    ``_target`` and ``_copies`` (0 to ``ceil(most)``); rows without words get no copies.  Rows
    that agree in source, size and doc_id are exchangeable: which of them comes first changes
    nothing else.  ``docs`` is read twice, so it should be a stored table or cheap to make.
    """
    name = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null"))
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    slot = F.pmod(F.conv(F.substring("_key", 1, 6), 16, 10).cast("long"), F.lit(slots))
    rows = docs.withColumn("_name", name).withColumn("_key", key).withColumn("_slot", slot)
    per_slot = written(
        rows.groupBy("_name", "source", "_size", "_slot").agg(F.count(F.lit(1)).alias("_rows")), "mix-counts"
    )
    per_size = per_slot.groupBy("_name", "source", "_size").agg(F.sum("_rows").alias("_rows"))
    per_source = per_size.groupBy("source").agg(F.sum(F.col("_size") * F.col("_rows")).alias("source_size"))
    goals = targets(per_source, weights, share, most).select(
        name.alias("_name"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target")
    )

    def before(window) -> Column:
        return F.coalesce(F.sum("_rows").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    smaller = per_size.select("_name", "_size", before(Window.partitionBy("_name").orderBy("_size")).alias("_smaller"))
    offsets = (
        per_slot.withColumn("_earlier", before(Window.partitionBy("_name", "_size").orderBy("_slot")))
        .join(smaller.join(goals, "_name"), ["_name", "_size"])
        .select("_name", "_size", "_slot", (F.col("_earlier") + F.col("_smaller")).alias("_first"), "_source_size", "_target")
    )
    within = Window.partitionBy("_name", "_size", "_slot").orderBy("_key", "doc_id")
    placed = rows.withColumn("_rank", F.row_number().over(within)).join(offsets, ["_name", "_size", "_slot"])
    at = F.col("_first") + F.col("_rank")
    each = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(F.lit(0.0))
    draw = F.md5(F.concat(F.lit(seed), F.col("_name")))
    offset = F.conv(F.substring(draw, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    crossed = F.floor(at * each + offset) - F.floor((at - 1) * each + offset)
    return placed.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        "_source_size",
        "_target",
        F.when(F.col("_size") > 0, crossed).otherwise(F.lit(0)).cast("long").alias("_copies"),
    )


def mixed(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` (same columns), each as often as it is taken."""
    # Whole rows travel as one struct, so that no column of theirs meets a name used here.
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        "doc_id",
        "source",
        word_count(F.col(f"`{text}`")).alias("_size"),
    )
    taken = copies(sized, **options).where(F.col("_copies") > 0)
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))
    return taken.select("_row", again.alias("_copy")).select("_row.*")
