"""The two doors: the same verdict over two views of the ledger."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from anchorline import vocabulary as V
from anchorline.operators import adjudicate, signals, sweeps
from anchorline.sources import ledger as L
from anchorline.sources.staging import Staging


def depth_index(
    ledger: DataFrame,
    *,
    start: date,
    checked_from: date | None = None,
    agency_id: int = V.AGENCY_ID,
    staging: Staging,
) -> tuple[DataFrame, dict[str, int]]:
    """The signal index of the ledger since `start`, and the standing checks' counts.

    This is all that the depth door, the checks and the fiscal years read of the ledger's texts.
    """
    scan = L.ledger_scan(ledger, start=start, agency_id=agency_id)
    return signals.index_table(
        L.normalise_ledger(scan), start=start, checked_from=checked_from, staging=staging
    )


def depth_rows(
    index: DataFrame, rollup: DataFrame, *, start: date, staging: Staging
) -> DataFrame:
    """The depth door's published rows. Award facts join after the verdict, one row per award."""
    accepted = signals.verdicts(index, start=start, staging=staging)
    return adjudicate.publish_rows(L.as_txn(L.with_rollup(accepted, rollup)))


def depth_part(
    ledger: DataFrame,
    rollup: DataFrame,
    *,
    start: date,
    agency_id: int = V.AGENCY_ID,
    staging: Staging,
) -> DataFrame:
    """`depth_rows` of an index of its own."""
    index, _ = depth_index(ledger, start=start, agency_id=agency_id, staging=staging)
    return depth_rows(index, rollup, start=start, staging=staging)


def recency_part(
    ledger: DataFrame,
    rollup: DataFrame,
    *,
    start: date,
    today: date,
    lookback_days: int = V.LOOKBACK_DAYS,
    agency_id: int = V.AGENCY_ID,
    staging: Staging,
) -> DataFrame:
    """The recency door's published rows: sweeps, follow-up, second judgement, award facts.

    The ledger is read once, and of a ledger laid out by year the window's years alone.
    """
    txn = sweeps.normalise_sweep(
        sweeps.sweep_rows(ledger, window=(start, today), agency_id=agency_id)
    )
    accepted = staging.table(
        sweeps.followup_rejudge(
            txn, start=start, today=today, lookback_days=lookback_days, staging=staging
        ),
        "accepted",
    )
    enriched = sweeps.enrich_two_key(accepted, rollup, agency_id=agency_id)
    return adjudicate.publish_rows(L.as_txn(enriched))


def fiscal_year_rows(index: DataFrame, *, first_day: date, staging: Staging) -> DataFrame:
    """The depth door's rows judged from an earlier bound; award facts are not read here."""
    accepted = signals.verdicts(index, start=first_day, staging=staging)
    return adjudicate.publish_rows(L.as_txn(accepted))
