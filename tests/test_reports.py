"""Pull-backs and fiscal-year counts."""

from datetime import date
from random import Random

from anchorline.operators import adjudicate as A
from anchorline.operators import reports
from anchorline.schemas import FISCAL_YEAR, PULLBACK
from builders import START, action, award, day, ledger, rollup, row, rows, txn, txns, values

TODAY = date(2026, 8, 25)


def dated(number, when, end, *, award=1, ordering=None, **more):
    return action(
        number, when, award=award, piid=f"P{award}", generated=f"CONT_AWD_P{award}",
        period_of_performance_current_end_date=day(end), ordering_period_end_date=ordering, **more,
    )


def test_pullbacks(spark):
    history = [
        # Pulled back by a year; an undated row in between still counts as a transaction.
        dated(1, "2019-05-01", "2026-01-01"),
        dated(2, "2020-05-01", "2027-06-30"),
        dated(3, "2024-05-01", None),
        dated(4, "2025-05-01", "2026-06-30"),
        # The vehicle's end is the ordering period's, which is text.
        dated(5, "2024-01-01", None, award=2, ordering=" 2027-01-01 ", type="IDV_C"),
        dated(6, "2025-03-01", None, award=2, ordering="2026-01-01", type="IDV_C"),
        dated(7, "2025-04-01", None, award=2, ordering="  ", type="IDV_C"),
        # Too small, pulled back to before the window, not active, other agency, no dates.
        dated(8, "2024-01-01", "2026-03-31", award=3), dated(9, "2025-03-01", "2026-01-01", award=3),
        dated(10, "2024-01-01", "2026-01-01", award=4), dated(11, "2025-03-01", "2024-12-31", award=4),
        dated(12, "2020-01-01", "2027-01-01", award=5), dated(13, "2024-12-31", "2025-06-01", award=5),
        dated(14, "2024-01-01", "2027-01-01", award=6, awarding_agency_id=97),
        dated(15, "2025-03-01", "2026-01-01", award=6, awarding_agency_id=97),
        dated(16, "2025-03-01", None, award=7),
        # Before the history starts.
        dated(17, "2007-09-30", "2030-01-01", award=8), dated(18, "2025-03-01", "2026-01-01", award=8),
    ]
    facts = rollup(spark, [award(1, recipient_location_state_code="CA")])
    found = reports.pullbacks(reports.end_date_history(ledger(spark, history)), facts, start=START)
    assert found.columns == PULLBACK.names
    assert values(
        reports.pullback_order(found), "award_id", "award_type", "recipient_state", "original_end_date",
        "max_end_date", "current_end_date", "days_shortened", "last_action_date", "transaction_count",
    ) == [
        ("P1", "contract", "CA", day("2026-01-01"), day("2027-06-30"), day("2026-06-30"), 365, day("2025-05-01"), 4),
        ("P2", "idv", "", day("2027-01-01"), day("2027-01-01"), day("2026-01-01"), 365, day("2025-04-01"), 3),
    ]


def test_rows_without_an_order_key_come_last_within_a_day(spark):
    history = [
        dated(1, "2024-01-01", "2028-01-01"),
        dated(2, "2025-03-01", "2026-01-01", transaction_unique_id=None),
        dated(3, "2025-03-01", "2027-12-31", transaction_unique_id="T9"),
    ]
    found = reports.pullbacks(
        reports.end_date_history(ledger(spark, history)), rollup(spark, []), start=START
    )
    assert values(found, "current_end_date") == [(day("2026-01-01"),)]


def counts(spark, published, overrides=(), first=2010):
    ruled = spark.createDataFrame(list(overrides), "override_id string, status string")
    out = reports.count_by_fiscal_year(published, ruled, first_fiscal_year=first, today=TODAY)
    assert out.columns == FISCAL_YEAR.names
    return {r.fiscal_year: r.terminated_awards for r in out.collect()}


def test_each_award_counts_in_its_anchor_year(spark):
    history = [
        txn(1, "2025-04-08", text="stop work order", key="A"),
        txn(2, "2026-04-14", code="F", text="ended", key="A"),
        txn(3, "2025-06-01", code="F", key="B"),
        txn(4, "2025-05-12", text="termination for convenience", key="C"),
        txn(5, "2026-02-05", text="the termination was vacated", key="C"),
        txn(6, "2010-03-15", code="F", key="D"),
        txn(7, "2009-09-30", code="F", key="E"),
    ]
    first_day = reports.fiscal_year_start(2010)
    published = A.publish_rows(A.accept_awards(txns(spark, history), start=first_day))
    by_year = counts(spark, published)
    assert sorted(by_year) == list(range(2010, 2027))
    assert {y: n for y, n in by_year.items() if n} == {2010: 1, 2025: 1, 2026: 1}


def test_rulings_and_descope_apply(spark):
    published = rows(spark, [
        row("A", source="mirror", when="2025-03-01"),
        row("B", source="mirror", when="2025-04-01", action_type="M",
            transaction_description="stop work, intent to descope"),
        row("C", source="mirror", when="2025-06-01"),
        row("D", source="mirror", when="2030-06-01"),
    ])
    by_year = counts(spark, published, [("A", "excluded_by_design")], first=2025)
    assert by_year == {2025: 1, 2026: 0}


def test_no_history_still_fills_every_year(spark):
    assert counts(spark, rows(spark, []), first=2024) == {2024: 0, 2025: 0, 2026: 0}


def test_pullback_order_with_ties(spark):
    history = []
    for n, end in ((3, "2026-01-01"), (1, "2026-01-01"), (2, "2026-03-01"), (4, "2026-01-01")):
        history += [dated(10 * n, "2024-01-01", "2027-01-01", award=n), dated(10 * n + 1, "2025-03-01", end, award=n)]
    history += [{**h, "award_id": 9, "piid": "P1", "generated_unique_award_id": "CONT_AWD_A"} for h in history[2:4]]
    found = reports.pullbacks(reports.end_date_history(ledger(spark, history)), rollup(spark, []), start=START)
    ordered = reports.pullback_order(found.repartition(3)).collect()
    assert [(r.award_id, r.generated_award_id) for r in ordered] == [
        ("P1", "CONT_AWD_A"), ("P1", "CONT_AWD_P1"), ("P3", "CONT_AWD_P3"), ("P4", "CONT_AWD_P4"), ("P2", "CONT_AWD_P2"),
    ]


def shortened(spark, actions, **more):
    history = reports.end_date_history(ledger(spark, actions))
    one = reports.pullback_leads(history, start=START, **more)
    two = reports.pullbacks(history, rollup(spark, []), start=START, **more)
    short = {r.award_id for r in reports.may_be_pulled_back(history, start=START, **more).collect()}
    return values(one, "native_award_id"), values(two, "award_id"), short


def test_dates_alone_rule_out_no_pullback(spark):
    """Both forms agree on random histories with many ties of day and end date."""
    random = Random(7)
    days = ["2024-05-01", "2025-03-01", "2025-03-02", "2025-09-09"]
    ends = [None, "1900-01-01", "2025-01-19", "2025-06-01", "2025-12-31", "2026-06-01", "9999-12-31"]
    actions = [
        dated(
            n, random.choice(days), random.choice(ends), award=random.randrange(60),
            transaction_unique_id=random.choice([None, "", "a", "b"]),
        )
        for n in range(300)
    ]
    one, two, short = shortened(spark, actions, min_days=30)
    assert one == two and len(one) > 5
    assert {int(x[0][1:]) for x in one} <= short
    assert len(short) < 60


def test_texts_are_aggregated_for_few_awards_alone(spark):
    history = reports.end_date_history(ledger(spark, [action(1, "2025-04-01")]))
    plan = reports.may_be_pulled_back(history, start=START)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    full = reports.pullbacks(history, rollup(spark, []), start=START)
    plan = full._jdf.queryExecution().executedPlan().toString()
    below = plan.split("SortAggregate")[-1]
    assert "LeftSemi" in below  # the sorted aggregation reads what the slots leave
