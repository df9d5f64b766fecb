"""Claims beside award facts, and the incremental refresh."""

import json
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from anchorline import vocabulary as V
from anchorline.operators import claims as C
from anchorline.schemas import CLAIM
from anchorline.sources import claims_feed as feed
from anchorline.sources import tables as files
from anchorline.sources.staging import Staging
from builders import CLAIM_SIDE, LATE, START, action, award, claim, claims, day, ledger, rollup, values

END = "2026-09-30"


def item(piid="A1", agency="NASA", **more):
    parts = {
        "agency": agency, "vendor": "  Lantern & Sons ", "value": 74210, "savings": "8,315",
        "deleted_date": "11/ 9/2025", "fpds_status": " Removed", "description": "buoy repair",
        "fpds_link": f"https://codes.example/find?q=all&PIID={piid}",
    }
    return {**parts, **more}


def test_landed_pages_become_claims(spark, tmp_path):
    grant = {
        "agency": "National Aeronautics and Space Administration", "recipient": "Fjord College",
        "value": 31.25, "savings": None, "date": "2025-12-17",
        "link": "https://awards.example/award/ASST_NON_G1_8000",
    }
    (tmp_path / "c.json").write_text(json.dumps(
        {"success": True, "page": 1, "meta": {"pages": 1},
         "result": {"contracts": [item(), item("X", agency="Energy"), item("Y", agency=None)]}}))
    (tmp_path / "g.json").write_text(json.dumps(
        {"success": True, "page": 1, "meta": {"pages": 1},
         "result": {"grants": [grant, {**grant, "agency": "Education"}]}}))
    out = feed.claims_scan(
        feed.read_pages(spark, str(tmp_path / "c.json"), feed.CONTRACT_PAGE),
        feed.read_pages(spark, str(tmp_path / "g.json"), feed.GRANT_PAGE),
    )
    assert out.columns == CLAIM_SIDE
    found = values(out, "claim_type", "doge_award_id", "recipient", "doge_value", "doge_savings", "doge_claim_date", "doge_status")
    assert [tuple(map(str, f)) for f in found] == [
        ("contract", "A1", "Lantern & Sons", "74210.00", "8315.00", "2025-11-09", "Removed"),
        ("grant", "G1", "Fjord College", "31.25", "None", "2025-12-17", ""),
    ]


def enrich(spark, claim_rows, actions, awards):
    frame = claims(spark, claim_rows).select(CLAIM_SIDE)
    out = C.enrich_claims(frame, ledger(spark, actions), rollup(spark, awards), start=START, today=LATE, staging=Staging(spark))
    assert out.columns == CLAIM.names
    return out


def test_facts_of_a_found_award(spark):
    out = enrich(
        spark, [claim("A1"), claim("none"), claim(""), claim("", recipient="Beta")],
        [
            action(1, "2025-04-01", code="C", text="admin", modification_number="9"),
            action(2, "2025-04-01", code="c ", text="later", modification_number="10"),
            action(3, "2025-03-01", code="F", text="ended", modification_number="1"),
            action(4, "2025-08-01", award=7, code="F", piid="", generated=""),
        ],
        [award(1, period_of_performance_current_end_date=day(END), recipient_location_city_name="Oslo"),
         award(7, piid="", generated="CONT_AWD_BLANK")],
    )
    shown = (
        "doge_award_id", "recipient", "usaspending_found", "award_type", "has_explicit_termination",
        "termination_vacated", "latest_action_date", "latest_action_type", "latest_description",
        "current_end_date", "recipient_city", "checked_date",
    )
    # Modifications order as raw text here: 9 comes after 10. Codes are reported as they came.
    assert values(out, *shown) == [
        ("", "Beta", False, "", False, False, None, "", "", None, "", LATE),
        ("", "Orbit Ltd", False, "", False, False, None, "", "", None, "", LATE),
        ("A1", "Orbit Ltd", True, "contract", True, False, day("2025-04-01"), "C", "admin", day(END), "Oslo", LATE),
        ("none", "Orbit Ltd", False, "", False, False, None, "", "", None, "", LATE),
    ]


@pytest.mark.parametrize(
    ("category", "code", "text", "explicit", "vacated"),
    [
        ("contract", "F", "change", True, False),
        ("contract", "N", "change", False, False),
        ("contract", "N", "terminate for convenience", True, False),
        ("contract", "F", "termination for cause", False, False),
        ("loans", "F", "change", False, False),
        ("grant", "", "termination vacated and set aside", False, True),
    ],
)
def test_explicit_and_vacated(spark, category, code, text, explicit, vacated):
    out = enrich(spark, [claim()], [action(1, "2025-06-01", code=code, text=text)], [award(1, category=category)])
    assert values(out, "has_explicit_termination", "termination_vacated") == [(explicit, vacated)]


def test_an_award_without_actions_is_found(spark):
    out = enrich(spark, [claim()], [], [award(1)])
    assert values(out, "usaspending_found", "latest_action_date", "latest_action_type") == [(True, None, "")]


def refreshed(spark, claim_rows, before, **more):
    out = C.refresh_claims(
        claims(spark, claim_rows).select(CLAIM_SIDE), claims(spark, before),
        ledger(spark, [action(1, "2025-04-01", code="C", text="now")]),
        rollup(spark, [award(1, period_of_performance_current_end_date=day(END))]),
        start=START, today=LATE, staging=Staging(spark), **more,
    )
    return values(out, "doge_award_id", "recipient", "latest_description", "checked_date")


def days_before(n):
    return LATE - timedelta(days=n)


#: A found claim's previous row: checked so many days ago, and what else it says.
@pytest.mark.parametrize(
    ("checked", "facts", "reused"),
    [
        (0, {}, True),
        (V.REFRESH_DAYS - 1, {}, True),
        (V.REFRESH_DAYS, {}, False),
        (V.REFRESH_DAYS + 40, {}, False),
        (400, {"has_explicit_termination": True}, True),
        (400, {"has_explicit_termination": True, "termination_vacated": True}, False),
        (400, {"current_end_date": days_before(1)}, True),
        (400, {"current_end_date": LATE}, False),
        (400, {"usaspending_found": False, "current_end_date": days_before(1)}, False),
        (400, {"termination_vacated": True, "has_explicit_termination": True,
               "current_end_date": days_before(300)}, True),
    ],
)
def test_reuse(spark, checked, facts, reused):
    seen = days_before(checked)
    before = claim(**{"usaspending_found": True, **facts}, checked_date=seen, latest_description="before")
    found = refreshed(spark, [claim()], [before])
    assert found == [("A1", "Orbit Ltd", "before", seen) if reused else ("A1", "Orbit Ltd", "now", LATE)]


def test_reuse_keys(spark):
    fresh = dict(usaspending_found=True, checked_date=date(2026, 8, 19), latest_description="before")
    # Another date is another claim; two missing dates are the same one.
    found = refreshed(
        spark, [claim(when="2025-03-05"), claim(when=None, recipient="Undated")],
        [claim(**fresh), claim(when=None, recipient="Undated", **fresh)],
    )
    assert [f[1:3] for f in found] == [("Orbit Ltd", "now"), ("Undated", "before")]
    # Claims without an id never share a row.
    nameless = [claim("", recipient="One"), claim("", recipient="Two")]
    found = refreshed(spark, nameless, [claim("", recipient="Two", **fresh)])
    assert [f[1] for f in found] == ["One", "Two"] and all(f[3] == LATE for f in found)


def test_claim_order(spark):
    frame = claims(spark, [claim("B"), claim("A"), claim("C", when=None), claim("D", when="2026-01-01")])
    assert [r.doge_award_id for r in C.claim_order(frame).collect()] == ["D", "A", "B", "C"]


def test_claim_order_with_ties_and_nulls(spark):
    frame = claims(spark, [
        claim("B", when=None), claim("", when="2025-08-08"), claim("A", when=None), claim("Z", when="2025-08-08"),
        claim("Z", when="2025-08-08", recipient="Twin"), claim("M", when="2024-02-29"),
    ]).repartition(4)
    got = [(r.doge_award_id, str(r.doge_claim_date)) for r in C.claim_order(frame).collect()]
    assert got == [
        ("", "2025-08-08"), ("Z", "2025-08-08"), ("Z", "2025-08-08"), ("M", "2024-02-29"), ("A", "None"), ("B", "None"),
    ]


def test_one_read_of_the_old_rows_the_rollup_and_the_ledger(spark, tmp_path):
    """Each input is read from disk by one job of the refresh."""
    inputs = {
        "old": claims(spark, [claim("A1", checked_date=date(2020, 1, 1))]),
        "book": ledger(spark, [action(1, "2025-04-01")]), "facts": rollup(spark, [award(1)]),
    }
    read = {}
    for name, frame in inputs.items():
        frame.write.parquet(str(tmp_path / name))
        read[name] = spark.read.schema(frame.schema).parquet(str(tmp_path / name))
    staged = []

    class Recording(Staging):
        def table(self, df, name):
            staged.append(df._jdf.queryExecution().executedPlan().toString())
            return super().table(df, name)

    out = C.refresh_claims(
        claims(spark, [claim()]).select(CLAIM_SIDE), read["old"], read["book"], read["facts"],
        start=START, today=LATE, staging=Recording(spark),
    )
    plans = "".join([*staged, out._jdf.queryExecution().executedPlan().toString()])
    for name in inputs:
        assert len(re.findall(rf"FileScan[^\n]*{tmp_path.name}/{name}", plans)) == 1, name
    assert values(out, "doge_award_id", "usaspending_found") == [("A1", True)]


def test_previous_rows_kept_by_key_are_not_moved(spark, tmp_path):
    """The match reads the stored buckets without an exchange, in a session told of them."""
    fresh = dict(usaspending_found=True, checked_date=date(2026, 8, 19))
    before = [
        claim("A1", latest_description="first", **fresh), claim("A1", latest_description="last", **fresh),
        claim("A1", when=None, latest_description="undated", **fresh),
        claim("A1", latest_description="too old", usaspending_found=True, checked_date=date(2020, 1, 1)),
        claim("", latest_description="nameless", **fresh),
    ]
    rows = claims(spark, before).coalesce(1).withColumn("position", F.monotonically_increasing_id())
    kept = C.keyed_claims(rows)
    assert values(kept, "claim_key", "latest_description") == [
        ("A1|", "undated"), ("A1|2025-03-04", "last"), ("A1|2025-03-04", "too old"),
    ]
    path = str(tmp_path / "keyed")
    files.write_bucketed(kept, path, "claim_key", buckets=8)
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("anchorline_")]:
        spark.sql(f"DROP TABLE {name}")  # as in a new session; the folder stays
    stored = files.read_bucketed(spark, path, C.KEYED_CLAIM, "claim_key", buckets=8)
    plans = []

    class Recording(Staging):
        def table(self, df, name):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return super().table(df, name)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = C.refresh_claims(
            claims(spark, [claim("A1"), claim("A1", when=None), claim("B1"), claim("")]).select(CLAIM_SIDE),
            stored, ledger(spark, []), rollup(spark, []), start=START, today=LATE,
            position="position", staging=Recording(spark),
        )
        got = values(out, "doge_award_id", "latest_description", "checked_date")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    day_before = date(2026, 8, 19)
    assert got == [("", "", LATE), ("A1", "last", day_before), ("A1", "undated", day_before), ("B1", "", LATE)]
    assert "SelectedBucketsCount: 8 out of 8" in plans[0]
    # One exchange, of the claims: the stored rows are grouped and joined in their buckets.
    assert plans[0].count("Exchange") == 1 and "Exchange hashpartitioning(claim_key" in plans[0]


def test_asked_awards_limit_the_ledger_on_both_sides_of_the_bound(spark):
    book = ledger(spark, [
        action(n, "2025-06-01", award=n % 50, piid=f"P{n % 50}", generated="", code="F" if n % 3 else "",
               text="termination for convenience" if n % 7 == 0 else "termination for cause" if n % 5 == 0 else "x")
        for n in range(400)
    ])
    awards = spark.createDataFrame(
        [(n, kind) for n, kind in zip(range(0, 60, 2), ["contract", "grant", "idv", ""] * 15, strict=False)],
        "internal_award_id long, award_type string",
    )
    few = C.claim_facts(book, awards, start=START)
    many = C.claim_facts(book, awards, start=START, asked_everywhere=3)
    assert values(few) == values(many) and few.count() == 25
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (few, many)]
    assert "_slot" not in plans[0] and "_slot" in plans[1]
    assert all("LeftSemi" in plan for plan in plans)
