"""The recency door: keyword and code sweeps, follow-up, two-key enrichment."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorline import vocabulary as V
from anchorline.functions import predicates as P
from anchorline.functions import scalars as S
from anchorline.operators.adjudicate import history_order, operative_event
from anchorline.operators.filters import among
from anchorline.operators.skew import salted_join
from anchorline.schemas import MONEY
from anchorline.sources.ledger import pop_location, recipient_location, rollup_facts
from anchorline.sources.ledger import since as ledger_since
from anchorline.sources.staging import Staging

# Arrival passes, in the order the rows reach the judge.
KEYWORD_PASS, CODE_PASS, FOLLOW_UP_PASS = 0, 1, 2


def sweep_rows(
    ledger: DataFrame,
    *,
    window: tuple[date, date] | None = None,
    agency_id: int = V.AGENCY_ID,
) -> DataFrame:
    """One agency's actions in the sweep's shape: identity, action, and the sweep they belong to.

    `window` limits them to its days, and the scan to the folders of its years.
    """
    if window is None:
        rows = ledger.where(F.col("awarding_agency_id") == agency_id)
    else:
        rows = ledger_since(ledger, window[0], agency_id, until=window[1])
    return rows.select(
        S.native_id("piid", "fain", "uri").alias("award_identifier"),
        "generated_unique_award_id",
        F.coalesce("is_fpds", F.lit(False)).alias("is_procurement"),
        "type",
        F.lit(None).cast("string").alias("award_type"),
        "recipient_name",
        "action_date",
        "action_type",
        "modification_number",
        "transaction_description",
        "federal_action_obligation",
        "ingest_seq",
    )


def normalise_sweep(rows: DataFrame, *, source: str = V.RECENCY_SOURCE) -> DataFrame:
    """Sweep rows as award actions, ordered within a day by modification number."""
    default = F.when(F.col("is_procurement"), "contract").otherwise("grant")
    cleaned = rows.withColumns(
        {
            "award_identifier": S.strip(S.blank("award_identifier")),
            "generated_award_id": S.strip(S.blank("generated_unique_award_id")),
        }
    )
    return cleaned.select(
        S.award_key("generated_award_id", "award_identifier").alias("award_key"),
        F.col("award_identifier").alias("award_id"),
        "generated_award_id",
        S.sweep_award_type(
            "type", "award_type", F.upper("generated_award_id"), default
        ).alias("award_type"),
        S.blank("recipient_name").alias("recipient_name"),
        "action_date",
        S.code("action_type").alias("action_type"),
        S.blank("modification_number").alias("modification_number"),
        S.blank("transaction_description").alias("description"),
        F.col("federal_action_obligation").cast(MONEY).alias("amount"),
        F.lit(source).alias("source"),
        S.mod_sort_key("modification_number").alias("sort_key"),
        (~F.col("is_procurement")).cast("int").alias("arm"),
        "ingest_seq",
        "is_procurement",
    )


def _in_keyword_sweep(start: date, today: date) -> Column:
    return F.col("action_date").between(F.lit(start), F.lit(today)) & P.matches_sweep_phrase()


def _in_code_sweep(start: date, today: date, lookback_days: int) -> Column:
    since = max(start, today - timedelta(days=lookback_days))
    return (
        F.col("action_date").between(F.lit(since), F.lit(today))
        & F.col("is_procurement")
        & P.has_termination_code()
    )


def keyword_sweep(txn: DataFrame, *, start: date, today: date) -> DataFrame:
    """Every action whose text holds a sweep phrase, over the whole window."""
    return txn.where(_in_keyword_sweep(start, today))


def code_sweep(
    txn: DataFrame, *, start: date, today: date, lookback_days: int = V.LOOKBACK_DAYS
) -> DataFrame:
    """Procurement actions with a termination code, over a bounded recent window."""
    return txn.where(_in_code_sweep(start, today, lookback_days))


def _passes(start: date, today: date, lookback_days: int) -> Column:
    """The sweeps a row belongs to, none or both among them."""
    by_keyword = F.when(_in_keyword_sweep(start, today), KEYWORD_PASS)
    by_code = F.when(_in_code_sweep(start, today, lookback_days), CODE_PASS)
    return F.array_compact(F.array(by_keyword, by_code))


def sweep_union(
    txn: DataFrame, *, start: date, today: date, lookback_days: int = V.LOOKBACK_DAYS
) -> DataFrame:
    """Both sweeps' rows, stamped with the pass they arrive in; a row in both arrives twice.

    One read of the ledger serves both sweeps.
    """
    swept = _in_keyword_sweep(start, today) | _in_code_sweep(start, today, lookback_days)
    arrivals = F.explode(_passes(start, today, lookback_days))
    return txn.where(swept).withColumn("arrival", arrivals)


def events_in_window(
    txn: DataFrame, *, start: date, today: date, lookback_days: int = V.LOOKBACK_DAYS
) -> DataFrame:
    """Every reset and signal of the window, told apart and ranked, with the sweeps that deliver it.

    Neither judgement looks at other rows, swept or followed up, so this is all of the ledger
    that the recency door needs.
    """
    window = F.col("action_date").between(F.lit(start), F.lit(today))
    signal = P.is_explicit_termination(
        start, by_text=F.col("by_text"), by_cause=F.col("by_cause")
    )
    events = txn.where(window & P.may_matter()).select("*", P.looked_at())
    return events.where(F.col("reset") | signal).select(
        *txn.columns,
        "reset",
        signal.alias("signal"),
        P.anchor_rank().alias("rank"),
        _passes(start, today, lookback_days).alias("passes"),
    )


def _judge(events: DataFrame, staging: Staging | None = None) -> DataFrame:
    """`accept_awards` of rows of `events_in_window`, whose texts are not looked at again."""
    return operative_event(
        events,
        ["award_key"],
        order=arrival_order(),
        is_reset=F.col("reset"),
        is_signal=F.col("signal"),
        rank=F.col("rank"),
        staging=staging,
    )


def arrival_order() -> Column:
    """History order for swept rows: ties keep the order in which the passes deliver them."""
    return history_order(extra=("arrival", "arm"))


def follow_up(txn: DataFrame, anchors: DataFrame, *, start: date, today: date) -> DataFrame:
    """The anchored awards' own rows since the earliest anchor, filed under the anchor's key.

    The join is on the native id alone, and a row keeps its own award type. Where
    anchors share a native id the one that anchors last by award key takes the rows.

    The earliest day is read as a value, so that it reaches the scan's filters, and rows of
    ids without an anchor are mostly dropped there, before the join.
    """
    named = anchors.where(F.col("award_id") != "")
    filed = named.groupBy("award_id").agg(F.max("award_key").alias("anchor_key"))
    earliest = anchors.agg(F.min("action_date").alias("day")).first()["day"]
    first = max(start, earliest) if earliest else start
    window = F.col("action_date").between(F.lit(first), F.lit(today))
    since = among(txn.where(window & (F.col("award_id") != "")), filed, ["award_id"])
    return (
        salted_join(since, filed, ["award_id"], "inner", spread=F.col("ingest_seq"))
        .withColumn("award_key", F.col("anchor_key"))
        .drop("anchor_key")
        .select(txn.columns)
        .withColumn("arrival", F.lit(FOLLOW_UP_PASS))
    )


def followup_rejudge(
    txn: DataFrame,
    *,
    start: date,
    today: date,
    lookback_days: int = V.LOOKBACK_DAYS,
    staging: Staging,
) -> DataFrame:
    """Anchors from the sweeps, judged again with their awards' own later history in hand.

    The ledger is read once: its resets and signals are staged with their sweeps, and both
    judgements and the follow-up read those. Anchors are staged too: the follow-up filter,
    the follow-up join and the second judgement read them, and there is at most one per award.
    """
    events = staging.table(
        events_in_window(txn, start=start, today=today, lookback_days=lookback_days), "events"
    )
    swept = events.withColumn("arrival", F.explode("passes")).drop("passes")
    anchors = staging.table(_judge(swept), "anchors")
    seen_again = swept.join(anchors.select("award_key"), "award_key", "left_semi")
    later = follow_up(events.drop("passes"), anchors, start=start, today=today)
    return _judge(seen_again.unionByName(later), staging).drop("reset", "signal", "rank")


def enrich_two_key(
    accepted: DataFrame, rollup: DataFrame, *, agency_id: int = V.AGENCY_ID
) -> DataFrame:
    """Award facts by generated id, else by native id, else blank.

    Only awards of the agency whose native id and type an accepted row carries are
    looked at. Facts filed under one id by several awards resolve to the last in
    (type, native id, award_id) order.
    """
    wanted = accepted.where(F.col("award_id") != "").select("award_id", "award_type").distinct()
    found = (
        rollup.where(F.col("awarding_agency_id") == agency_id)
        .select(
            F.col("award_id").alias("internal_award_id"),
            S.blank(S.native_id("piid", "fain", "uri")).alias("award_id"),
            S.blank("generated_unique_award_id").alias("generated_award_id"),
            S.award_type("type", "generated_unique_award_id", "is_fpds").alias("award_type"),
            S.code("type").alias("award_type_code"),
            *rollup_facts(reported=True),
        )
        .join(wanted, ["award_id", "award_type"], "left_semi")
    )
    type_order = F.when(F.col("award_type") == "contract", 0).when(
        F.col("award_type") == "idv", 1
    ).otherwise(2)
    details = F.struct(
        "award_description",
        recipient_location().alias("recipient_location"),
        pop_location().alias("pop_location"),
        "award_type_code",
        "total_obligated",
        "total_potential_value",
    )
    filed = (
        found.select(
            F.explode(F.array_distinct(F.array("generated_award_id", "award_id"))).alias("id"),
            F.struct(type_order.alias("t"), "award_id", "internal_award_id").alias("place"),
            details.alias("details"),
        )
        .where(F.col("id") != "")
        .groupBy("id")
        .agg(F.max_by("details", "place").alias("details"))
    )
    by_generated = filed.select(
        F.col("id").alias("generated_award_id"), F.col("details").alias("by_generated")
    )
    by_native = filed.select(F.col("id").alias("award_id"), F.col("details").alias("by_native"))
    # Blank ids match nothing and would all meet in one task, so they do not join.
    details_type = by_generated.schema["by_generated"].dataType
    named = accepted.where(F.col("generated_award_id") != "")
    nameless = accepted.where(F.col("generated_award_id") == "")
    chosen = (
        named.join(by_generated, "generated_award_id", "left")
        .unionByName(nameless.withColumn("by_generated", F.lit(None).cast(details_type)))
        .join(by_native, "award_id", "left")
        .withColumn("found", F.coalesce("by_generated", "by_native"))
    )
    keep = [c for c in accepted.columns if c != "award_type_code"]
    return chosen.select(
        *keep,
        S.blank("found.award_description").alias("award_description"),
        F.coalesce("found.recipient_location", S.empty_location()).alias("recipient_location"),
        F.coalesce("found.pop_location", S.empty_location()).alias("pop_location"),
        S.blank("found.award_type_code").alias("award_type_code"),
        F.col("found.total_obligated").alias("total_obligated"),
        F.col("found.total_potential_value").alias("total_potential_value"),
    )
