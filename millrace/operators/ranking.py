"""Ranks and row numbers without sorting all rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.measures import rows
from ..session import checkpointed


def rank_by_measure(
    df: DataFrame, measure: str, within: Sequence[str] = (), rank: str = "rank",
    dense_rank: str | None = None, percent_rank: str | None = None, top: int | None = None,
    of: DataFrame | None = None,
) -> DataFrame:
    """Add the rank of each row by ``measure`` descending, within ``within``.

    Rows of one measure value share a rank, so it is enough to rank the
    distinct values and to count how many rows each one holds. That histogram
    is what passes through the window. For positive whole-number measures that
    add up to M it has at most sqrt(2 M) values per group: 1.4 million for a
    trillion mentions, however many rows there are. The rows themselves are
    never brought together: they meet the ranks by broadcast, or, within groups,
    in a join whose large parts Spark splits. ``top`` keeps the rows of rank <= top, with all ties.
    ``of`` names a plainer frame with the same ranked rows, to count them without the steps ``df`` took since.
    """
    # Histogram columns carry names of their own, as both join sides come from df.
    group = {f"_g{i}": c for i, c in enumerate(within)}
    hist = (df if of is None else of).groupBy(*[F.col(c).alias(n) for n, c in group.items()], F.col(measure).alias("_value")).agg(
        rows().alias("_ties")
    )
    order = Window.partitionBy(*group).orderBy(F.desc("_value"))
    before = F.coalesce(F.sum("_ties").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    values = {"_rank": before + 1}
    if dense_rank:
        values["_dense"] = F.row_number().over(order)
    if percent_rank:
        values["_of"] = F.sum("_ties").over(Window.partitionBy(*group))
    ranks = hist.select(*group, "_value", *[c.alias(n) for n, c in values.items()])
    if top is not None:
        ranks = ranks.filter(F.col("_rank") <= top)
    same = F.col(measure).eqNullSafe(F.col("_value"))
    for n, c in group.items():
        same = same & F.col(c).eqNullSafe(F.col(n))
    if not within:
        ranks = F.broadcast(ranks)  # bounded by sqrt(2 M) rows, see above
    joined = df.join(ranks, same).drop(*group, "_value")
    out = {rank: F.col("_rank")}
    if dense_rank:
        out[dense_rank] = F.col("_dense").cast("bigint")
    if percent_rank:
        spread = F.col("_of") - 1
        out[percent_rank] = F.when(spread > 0, (F.col("_rank") - 1) / spread).otherwise(F.lit(0.0))
    return joined.withColumns(out).drop(*values)


def _in_order(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """The rows in order over range partitions, with ``_stretch`` (partition) and ``_place`` (from 0) in it.

    Checkpointed: the bounds come from a sample, so the rows must be dealt once and for all.
    """
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    kept = checkpointed(ordered)
    return kept.withColumns({"_stretch": F.shiftright("_at", 33), "_place": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_at")


def number_rows(df: DataFrame, keys: Sequence[Column], name: str) -> DataFrame:
    """Row number over all rows, of any number, in the ascending order of ``keys`` (NULL first) without ties.

    A window without partition would bring all rows into one task. Range partitions are sorted side by side
    instead, as many as shuffles have; a row's number is its place plus the rows of the partitions before.
    """
    dealt = _in_order(df, [k.asc_nulls_first() for k in keys])
    earlier = Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy("_stretch").agg(rows().alias("_n")).select("_stretch", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    # Broadcast: one row per partition.
    return dealt.join(F.broadcast(before), "_stretch").withColumn(name, F.col("_before") + F.col("_place") + 1).select(*df.columns, name)


def rank_by_range(
    df: DataFrame, measure: str, rank: str = "rank", dense_rank: str | None = None, percent_rank: str | None = None,
) -> DataFrame:
    """Add the rank of each row by a measure of any type and any number of values, descending, NULL last.

    The distinct values with their ties are ranked in range partitions: rows and values of the partitions
    before, plus those before in the partition. Rows meet their value's ranks in a join that Spark sizes: it
    broadcasts few values, else it shuffles and splits the parts of a value that many rows have.
    """
    values = df.groupBy(F.col(measure).alias("_value")).agg(rows().alias("_ties"))
    dealt = _in_order(values, [F.desc_nulls_last("_value")])
    within = Window.partitionBy("_stretch").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("_stretch").agg(F.sum("_ties").alias("_n"), rows().alias("_v")).select(
        "_stretch", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_v").over(earlier), F.lit(0)).alias("_values_before"), F.sum("_n").over(Window.partitionBy(F.lit(1))).alias("_of"))
    # Broadcast: one row per partition.
    ranked = dealt.withColumn("_ahead", F.coalesce(F.sum("_ties").over(within), F.lit(0))).join(F.broadcast(totals), "_stretch").select(
        "_value", (F.col("_rows_before") + F.col("_ahead") + 1).alias("_rank"), (F.col("_values_before") + F.col("_place") + 1).alias("_dense"), "_of")
    out = {rank: F.col("_rank")}
    if dense_rank:
        out[dense_rank] = F.col("_dense")
    if percent_rank:
        out[percent_rank] = F.when(F.col("_of") > 1, (F.col("_rank") - 1) / (F.col("_of") - 1)).otherwise(F.lit(0.0))
    joined = df.join(ranked, F.col(measure).eqNullSafe(F.col("_value")))
    return joined.withColumns(out).drop("_value", "_rank", "_dense", "_of")
