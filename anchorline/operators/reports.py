"""Reports over whole histories: period pull-backs and fiscal-year counts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorline import vocabulary as V
from anchorline.functions import predicates as P
from anchorline.functions import scalars as S
from anchorline.operators.filters import among
from anchorline.operators.overrides import apply_overrides
from anchorline.schemas import FISCAL_YEAR, PULLBACK, conform
from anchorline.sources.ledger import award_rollup
from anchorline.sources.ledger import since as ledger_since


def end_date_history(
    ledger: DataFrame, *, agency_id: int = V.AGENCY_ID, since: date = V.HISTORY_START
) -> DataFrame:
    """One agency's actions since `since` with the end date each one reports."""
    return ledger_since(ledger, since, agency_id).select(
        "award_id",
        S.native_id("piid", "fain", "uri").alias("native_award_id"),
        "generated_unique_award_id",
        F.col("transaction_unique_id").alias("sort_key"),
        "is_fpds",
        F.col("type").alias("award_type_code"),
        "action_date",
        "recipient_name",
        S.effective_end(
            "period_of_performance_current_end_date", "ordering_period_end_date"
        ).alias("end_date"),
        "ingest_seq",
    )


def may_be_pulled_back(
    history: DataFrame, *, start: date, min_days: int = V.MIN_PULLBACK_DAYS
) -> DataFrame:
    """The awards that dates alone do not rule out: all that are pulled back, and those whose
    last day has several end dates.

    Of an award's last dated day the least and the greatest end date are kept, each packed
    behind the day into one number, so the aggregation is by hash over numbers and dates.
    """
    day, end = F.unix_date("action_date").cast("long"), F.unix_date("end_date").cast("long")
    wide, half = 1 << 32, (1 << 31) - 1
    dated = history.groupBy("award_id").agg(
        F.max("end_date").alias("latest_end"),
        F.max("action_date").alias("last_action"),
        F.max(day * wide + (half - end)).alias("least"),
        F.max(day * wide + (half + end)).alias("most"),
    )
    least = F.date_from_unix_date((half - F.pmod("least", F.lit(wide))).cast("int"))
    most = F.date_from_unix_date((F.pmod("most", F.lit(wide)) - half).cast("int"))
    return dated.where(
        (F.col("last_action") >= F.lit(start))
        & (F.datediff("latest_end", least) > min_days)
        & (most >= F.lit(start))
    ).select("award_id")


def pullback_leads(
    history: DataFrame, *, start: date, min_days: int = V.MIN_PULLBACK_DAYS
) -> DataFrame:
    """One row per award pulled back, with its first texts and dates, by one aggregation."""
    # A null order key sorts last, and is told apart from a blank one.
    order = F.struct(
        "action_date", F.col("sort_key").isNull().alias("keyless"), "sort_key", "ingest_seq"
    )
    dated = F.when(F.col("end_date").isNotNull(), order)
    per_award = history.groupBy("award_id").agg(
        F.max("native_award_id").alias("native_award_id"),
        F.max("generated_unique_award_id").alias("generated"),
        F.max("award_type_code").alias("type_code"),
        F.bool_or("is_fpds").alias("is_fpds"),
        F.max("recipient_name").alias("recipient_name"),
        F.min_by("end_date", dated).alias("original_end_date"),
        F.max_by("end_date", dated).alias("current_end_date"),
        F.max("end_date").alias("max_end_date"),
        F.max("action_date").alias("last_action_date"),
        F.count("*").alias("transaction_count"),
    )
    return per_award.withColumn(
        "days_shortened", F.datediff("max_end_date", "current_end_date")
    ).where(
        (F.col("last_action_date") >= F.lit(start))
        & (F.col("days_shortened") > min_days)
        & (F.col("current_end_date") >= F.lit(start))
    )


def pullbacks(
    history: DataFrame,
    rollup: DataFrame,
    *,
    start: date,
    min_days: int = V.MIN_PULLBACK_DAYS,
) -> DataFrame:
    """Awards active since `start` whose end date was pulled back by more than `min_days`.

    Undated rows are ignored when picking the first and current end dates, but count
    as transactions. Two phases: dates and numbers of all awards, by hash; then texts and the
    exact order of rows for the few awards that remain, whose slots limit the second read.
    Both combine before they shuffle; the rollup joins only the awards that are published.
    """
    possible = may_be_pulled_back(history, start=start, min_days=min_days)
    leads = pullback_leads(
        among(history, possible, ["award_id"]), start=start, min_days=min_days
    )
    facts = award_rollup(rollup).withColumnRenamed("award_id", "internal_award_id")
    named = leads.withColumnRenamed("award_id", "internal_award_id").join(
        facts, "internal_award_id", "left"
    )
    blanks = {
        f.name: S.blank(f.name)
        for f in PULLBACK.fields
        if f.name in facts.columns and f.dataType.typeName() == "string"
    }
    return conform(
        named.withColumns(
            {
                **blanks,
                "award_id": S.strip(S.blank("native_award_id")),
                "generated_award_id": S.strip(S.blank("generated")),
                "award_type": S.award_type("type_code", "generated", "is_fpds"),
                "award_type_code": S.code("type_code"),
                "recipient_name": S.blank("recipient_name"),
            }
        ),
        PULLBACK,
    )


def pullback_order(rows: DataFrame) -> DataFrame:
    """Longest pull-back first; ties by award id, then generated id."""
    return rows.orderBy(F.desc("days_shortened"), F.asc("award_id"), F.asc("generated_award_id"))


def fiscal_year_start(first_fiscal_year: int) -> date:
    """The day the first counted fiscal year opens."""
    return date(first_fiscal_year - 1, 10, 1)


def count_by_fiscal_year(
    rows: DataFrame, overrides: DataFrame, *, first_fiscal_year: int, today: date
) -> DataFrame:
    """Terminated awards per fiscal year of their anchor, zero-filled through `today`'s.

    `rows` are published rows, one per award, judged from `fiscal_year_start` on.
    Rulings and the de-scope routing apply first. Years outside the range drop out.
    """
    ruled = apply_overrides(rows, overrides)
    counts = (
        ruled.where(~P.is_descoped())
        .groupBy(S.fiscal_year("action_date").alias("fiscal_year"))
        .agg(F.count("*").alias("counted"))
    )
    last = today.year + (1 if today.month >= 10 else 0)
    years = rows.sparkSession.range(first_fiscal_year, last + 1).select(
        F.col("id").cast("int").alias("fiscal_year")
    )
    filled = years.join(counts, "fiscal_year", "left").select(
        "fiscal_year", F.coalesce("counted", F.lit(0)).alias("terminated_awards")
    )
    return conform(filled, FISCAL_YEAR)
