"""Claims beside what the ledger says about the same award. Facts, no verdicts."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anchorline import vocabulary as V
from anchorline.functions import predicates as P
from anchorline.functions import scalars as S
from anchorline.operators.filters import among
from anchorline.schemas import CLAIM, conform
from anchorline.sources.ledger import rollup_facts
from anchorline.sources.staging import Staging


def award_facts(rollup: DataFrame) -> DataFrame:
    """One award per native id: the facts a claim is set beside.

    A native id several awards share resolves to the highest award_id. The lookup is
    not limited to an agency. Awards of an unknown category have a blank type.
    """
    rows = rollup.select(
        F.col("award_id").alias("internal_award_id"),
        S.blank(S.native_id("piid", "fain", "uri")).alias("doge_award_id"),
        S.blank("generated_unique_award_id").alias("generated_award_id"),
        S.award_category("category").alias("award_type"),
        S.code("type").alias("award_type_code"),
        F.col("period_of_performance_current_end_date").alias("current_end_date"),
        *rollup_facts(reported=True),
    ).where(F.col("doge_award_id") != "")
    facts = [c for c in rows.columns if c != "doge_award_id"]
    return (
        rows.groupBy("doge_award_id")
        .agg(F.max_by(F.struct(*facts), "internal_award_id").alias("fact"))
        .select("doge_award_id", "fact.*")
        .withColumnRenamed("total_obligated", "current_obligation")
    )


#: Awards asked about, up to which their ids go to every task that reads the ledger; beyond,
#: the slots that they fall into do, of so many.
ASKED_EVERYWHERE = 500_000
ASKED_SLOTS = 1 << 22


def claim_facts(
    ledger: DataFrame, awards: DataFrame, *, start: date, asked_everywhere: int = ASKED_EVERYWHERE
) -> DataFrame:
    """Per award of `awards`: terminated, vacated, and its latest action.

    The latest action is by day, then by the modification number as raw text, the
    first to arrive on ties; its code is reported as it came. `awards` supplies the
    awards' type.

    The ledger is classified and reduced to a row per award and task before anything
    is shuffled, so its texts do not travel. Where `awards` is few enough its ids
    limit the ledger first, else their slots do; the aggregate is the same without.
    """
    asked = awards.select("internal_award_id", F.col("award_type").alias("asked_type"))
    ids = asked.select(F.col("internal_award_id").alias("award_id"))
    if ids.limit(asked_everywhere + 1).count() <= asked_everywhere:
        ledger = ledger.join(F.broadcast(ids), "award_id", "left_semi")
    else:
        ledger = among(ledger, ids, ["award_id"], slots=ASKED_SLOTS)
    rows = ledger.select(
        F.col("award_id").alias("internal_award_id"),
        "action_date",
        S.blank("action_type").alias("action_type"),
        S.blank("modification_number").alias("modification_number"),
        S.blank("transaction_description").alias("description"),
        "ingest_seq",
    )
    latest = F.struct("action_date", "modification_number", -F.col("ingest_seq"))
    # The award's type is the same for all its rows, so it can decide after the aggregate. The
    # text decides for either type and is looked at once.
    by_code = (
        P.in_window("action_date", start)
        & P.has_standalone_code(F.lit(V.CODED_AWARD_TYPES[0]), S.code("action_type"))
        & ~P.is_cause("description")
    )
    by_text = P.is_explicit_termination(
        start, award_type=F.lit(""), action_type=S.code("action_type")
    )
    facts = rows.groupBy("internal_award_id").agg(
        F.bool_or(by_code).alias("by_code"),
        F.bool_or(by_text).alias("by_text"),
        F.bool_or(P.is_vacatur("description")).alias("termination_vacated"),
        F.max_by(F.struct("action_date", "action_type", "description"), latest).alias("last"),
    )
    coded = F.col("asked_type").isin(*V.CODED_AWARD_TYPES)
    return facts.join(asked, "internal_award_id").select(
        "internal_award_id",
        (F.col("by_text") | (coded & F.col("by_code"))).alias("has_explicit_termination"),
        "termination_vacated",
        F.col("last.action_date").alias("latest_action_date"),
        F.col("last.action_type").alias("latest_action_type"),
        F.col("last.description").alias("latest_description"),
    )


def enrich_claims(
    claims: DataFrame,
    ledger: DataFrame,
    rollup: DataFrame,
    *,
    start: date,
    today: date,
    staging: Staging,
) -> DataFrame:
    """Claims with award facts; an award that is not there leaves the facts empty.

    Claims without an id are set aside before the join: they match nothing, and there
    may be very many of them. The asked awards, one per named id at most, are staged:
    their ids limit the ledger, and their facts join what the ledger says.
    """
    named, nameless = claims.where("doge_award_id <> ''"), claims.where("doge_award_id = ''")
    ids = named.select("doge_award_id").distinct()
    awards = staging.table(
        award_facts(rollup).join(ids, "doge_award_id", "left_semi"), "asked"
    )
    facts = awards.join(claim_facts(ledger, awards, start=start), "internal_award_id", "left")
    joined = named.join(facts, "doge_award_id", "left").withColumn(
        "usaspending_found", F.col("internal_award_id").isNotNull()
    )
    return _claim_rows(joined, today).unionByName(_claim_rows(nameless, today))


def _claim_rows(df: DataFrame, today: date) -> DataFrame:
    """On the published claim columns, missing cells empty, checked today."""
    present = set(df.columns)
    filled = {}
    for field in CLAIM.fields:
        if field.name in present and field.dataType.typeName() in ("string", "boolean"):
            empty = "" if field.dataType.typeName() == "string" else False
            filled[field.name] = F.coalesce(field.name, F.lit(empty))
    return conform(df.withColumns({**filled, "checked_date": F.lit(today)}), CLAIM)


def claim_key() -> Column:
    """What tells claims apart: award id and date, a missing date included, as one text. The
    date is what follows the last bar."""
    day = F.coalesce(F.col("doge_claim_date").cast("string"), F.lit(""))
    return F.concat("doge_award_id", F.lit("|"), day)


#: What decides whether a previous row may serve again.
REUSE = (
    "usaspending_found", "has_explicit_termination", "termination_vacated", "current_end_date",
    "checked_date",
)
#: Published claims as they are kept by key.
KEYED_CLAIM = T.StructType(
    [T.StructField("claim_key", T.StringType()), T.StructField("position", T.LongType()), *CLAIM.fields]
)


def keyed_claims(rows: DataFrame) -> DataFrame:
    """Published claims by key, for the next refresh: claim_key, position and the claim.

    Claims without an id serve no other. Of rows that agree in key and in all that decides
    about reuse the last alone can serve, so a key has few.
    """
    named = rows.where(F.col("doge_award_id") != "").withColumn("claim_key", claim_key())
    last = F.max(F.struct("position", F.struct(*CLAIM.names).alias("row"))).alias("last")
    return named.groupBy("claim_key", *REUSE).agg(last).select(
        "claim_key", "last.position", "last.row.*"
    )


def refresh_claims(
    claims: DataFrame,
    existing: DataFrame,
    ledger: DataFrame,
    rollup: DataFrame,
    *,
    start: date,
    today: date,
    refresh_days: int = V.REFRESH_DAYS,
    position: str | None = None,
    staging: Staging,
) -> DataFrame:
    """Claims as published rows, reusing settled and recently checked ones.

    A previous row serves a claim of the same id and date, two missing dates included,
    never one without an id. Of several that could, the last one does: by the `position`
    column of `existing`, else by check date and then by content. Claims beside their
    previous rows are staged: both kinds of claim and the asked ids are read from there.

    Where `existing` is kept by `claim_key`, its rows meet the claims where they lie.
    """
    cutoff = today - timedelta(days=refresh_days)
    recent = F.coalesce(F.col("checked_date") > F.lit(cutoff), F.lit(False))
    if "claim_key" not in existing.columns:
        existing = existing.withColumn("claim_key", claim_key())
    reusable = (
        existing.where((F.col("doge_award_id") != "") & (P.is_settled(today) | recent))
        .groupBy("claim_key")
        .agg(
            F.max(
                F.struct(position or "checked_date", F.struct(*CLAIM.names).alias("row"))
            ).alias("last")
        )
        .select("claim_key", F.col("last.row").alias("old"))
    )
    named, nameless = claims.where("doge_award_id <> ''"), claims.where("doge_award_id = ''")
    named = named.withColumn("claim_key", claim_key())
    matched = staging.table(named.join(reusable, "claim_key", "left"), "matched")
    carried = matched.where("old IS NOT NULL").select("old.*")
    stale = matched.where("old IS NULL").select(claims.columns).unionByName(nameless)
    fresh = enrich_claims(stale, ledger, rollup, start=start, today=today, staging=staging)
    return carried.unionByName(fresh)


def claim_order(rows: DataFrame) -> DataFrame:
    """Newest claim first, missing dates last, then by award id."""
    return rows.orderBy(F.desc_nulls_last("doge_claim_date"), F.asc("doge_award_id"))
