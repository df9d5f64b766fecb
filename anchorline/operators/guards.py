"""Checks that stop a run before it publishes a short or empty result.

Each check is a query whose rows are the violations; `refuse` turns any into an error.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorline import vocabulary as V
from anchorline.functions import predicates as P


class IncompleteInputError(RuntimeError):
    """An input or a result cannot be shown to be complete, so nothing is published."""


def refuse(violations: DataFrame, message: str) -> None:
    """Raise when the check found anything, quoting one violation."""
    found = violations.take(1)
    if found:
        raise IncompleteInputError(f"{message}: {found[0].asDict()}")


def refuse_none(rows: int, name: str) -> None:
    """Raise when a table that must not be empty has no rows, as counted when it was written."""
    if not rows:
        raise IncompleteInputError(f"{name} has no rows; refusing to publish it")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per named table, and whether each may be published."""
    counted = [
        rows.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, rows in tables.items()
    ]
    union = counted[0]
    for one in counted[1:]:
        union = union.unionByName(one)
    return union.withColumn("publishable", F.col("row_count") > 0)


def count_mismatches(rows: DataFrame, manifest: DataFrame, slice_column: str) -> DataFrame:
    """Slices whose row count differs from the advertised one.

    `manifest` holds the slice column and `expected`. A slice either side lacks counts
    as zero there.
    """
    read = rows.groupBy(slice_column).agg(F.count("*").alias("found"))
    return (
        read.join(manifest, slice_column, "full_outer")
        .select(
            slice_column,
            F.coalesce("found", F.lit(0)).alias("found"),
            F.coalesce("expected", F.lit(0)).alias("expected"),
        )
        .where("found <> expected")
    )


def page_problems(pages: DataFrame, items: str) -> DataFrame:
    """Pages of a landed feed that are missing, unsuccessful, empty, landed twice, unexpected or
    unreadable. A line that does not parse has no page number.

    The first page says how many there are; without that, or where pages disagree about it,
    the feed is unusable. `items` is the field of the result that holds the page's claims.
    """
    count = F.coalesce(F.size(f"result.{items}"), F.lit(0))
    if "unreadable" not in pages.columns:
        pages = pages.withColumn("unreadable", F.lit(None).cast("string"))
    per_page = pages.groupBy("page").agg(
        F.bool_and(F.coalesce("success", F.lit(False))).alias("ok"),
        F.min(count).alias("fewest"),
        F.max("meta.pages").alias("advertised"),
        F.min("meta.pages").alias("least"),
        F.count(F.lit(1)).alias("documents"),
        F.count("unreadable").alias("damaged"),
    )
    advertised = per_page.agg(
        F.coalesce(F.max(F.when(F.col("page") == 1, F.col("advertised"))), F.lit(0)).alias("pages"),
        F.max("advertised").alias("most"),
        F.min("least").alias("least"),
    )
    usable = F.col("pages") >= 1
    unusable = advertised.select(
        F.lit(None).cast("int").alias("page"),
        F.when(~usable, "unusable page count")
        .when(F.col("most") != F.col("least"), "disagreeing page counts")
        .alias("problem"),
    )
    wanted = advertised.where(usable).select(F.explode(F.sequence(F.lit(1), "pages")).alias("wanted"))
    seen = wanted.join(per_page, F.col("wanted") == F.col("page"), "full_outer").select(
        F.coalesce("wanted", "page").alias("page"),
        F.when(F.col("damaged") > 0, "unreadable")
        .when(F.col("wanted").isNull(), "unexpected")
        .when(F.col("ok").isNull(), "missing")
        .when(F.col("documents") > 1, "duplicate")
        .when(~F.col("ok"), "unsuccessful")
        .when(F.col("fewest") < 1, "empty")
        .alias("problem"),
    )
    found = unusable.unionByName(seen.where(usable_feed(advertised)))
    return found.where("problem IS NOT NULL").select("page", "problem")


def usable_feed(advertised: DataFrame) -> Column:
    """Whether the first page advertises any page: one row, read as a value."""
    return advertised.select(F.col("pages") >= 1).scalar()


def standing_checks(start: date) -> dict[str, Column]:
    """What every run counts among the actions since `start`, by name.

    Rows the verdict would accept and the prefilter alone would miss, which count when another
    row makes their award a candidate; sweep phrases that are no termination text, of which
    there must be none; and rows without any id, which all share one key.
    """
    recent = P.in_window("action_date", start)
    return {
        "accepted, not candidates": P.is_explicit_termination(start) & ~P.is_candidate(),
        "phrase without termination": recent
        & P.matches_sweep_phrase()
        & ~P.is_termination("description"),
        "without any id": recent & (F.col("award_key") == V.FALLBACK_KEY_PREFIX),
    }
