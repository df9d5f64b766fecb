"""Published tables on disk, rulings files, guards, staging and the whole publication."""

import os
from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from anchorline.operators import guards as G
from anchorline.operators.reports import end_date_history
from anchorline.plans import doors, publish
from anchorline.schemas import CLAIM, FISCAL_YEAR, PULLBACK, TERMINATION
from anchorline.sources import claims_feed as feed
from anchorline.sources import ledger as L
from anchorline.sources import tables as files
from anchorline.sources.overrides import load_overrides
from anchorline.sources.staging import Staging, shared_folder
from anchorline.sources.store import StaleInputError, Store
from builders import (
    LATE, START, action, award, claim, claims, day, ledger, rollup, row, rows, values,
)


def lines(path):
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    return [line for p in parts for line in open(f"{path}/{p}", encoding="utf-8").read().splitlines()]


def test_published_columns():
    assert len(TERMINATION) == 27 and len(CLAIM) == 31 and len(PULLBACK) == 24 and len(FISCAL_YEAR) == 2
    assert TERMINATION.names[:3] == ["award_key", "award_id", "generated_award_id"]
    assert TERMINATION.names[-3:] == ["detected_by", "sources", "override_status"]
    assert CLAIM.names[-1] == "checked_date" and PULLBACK.names[-1] == "transaction_count"


def test_rendering(spark, tmp_path):
    frame = rows(spark, [row(
        "K", source="api", transaction_amount=Decimal("-1234567.89"), recipient_district="04",
        transaction_description='LINE "ONE",\nLINE TWO\r\n  THREE ', total_obligated=None,
    )]).coalesce(1)
    files.write_csv(frame, str(tmp_path / "t"), TERMINATION)
    header, body = lines(tmp_path / "t")
    assert header == ",".join(TERMINATION.names)
    assert '"LINE ""ONE"", LINE TWO THREE"' in body
    assert ",2025-06-01,F,P3,-1234567.89," in body and ",04," in body and "null" not in body.lower()
    back = files.read_csv(spark, str(tmp_path / "t"), TERMINATION).first()
    assert back.transaction_description == 'LINE "ONE", LINE TWO THREE'
    assert back.transaction_amount == Decimal("-1234567.89")
    assert back.total_obligated is None and back.award_description == "" and back.recipient_district == "04"


def test_round_trip_of_every_table(spark, tmp_path):
    frames = {
        "t": (rows(spark, [row("A", source="api"), row("B", source="api", when=None)]), TERMINATION),
        "c": (claims(spark, [claim(doge_value=Decimal("10000000.00"), usaspending_found=True), claim(when=None)]), CLAIM),
        "f": (spark.createDataFrame([(2010, 7)], FISCAL_YEAR), FISCAL_YEAR),
    }
    for name, (frame, schema) in frames.items():
        path = str(tmp_path / name)
        files.write_csv(frame, path, schema)
        back = files.read_csv(spark, path, schema)
        assert back.dtypes == frame.dtypes
        assert values(back) == values(frame)
    text = "\n".join(lines(tmp_path / "c"))
    assert "10000000.00" in text and ",true," in text and ",false," in text


def test_a_table_without_rows(spark, tmp_path):
    path = str(tmp_path / "none")
    files.write_csv(rows(spark, []), path, TERMINATION)
    assert lines(path) == []
    assert files.read_csv(spark, path, TERMINATION).count() == 0
    assert files.read_csv(spark, str(tmp_path / "absent"), TERMINATION).schema == TERMINATION


def test_a_malformed_cell_is_an_error(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("fiscal_year,terminated_awards\n2010,many\n")
    with pytest.raises(PySparkException):
        files.read_csv(spark, str(tmp_path / "bad.csv"), FISCAL_YEAR).collect()


def test_rulings_file(spark, tmp_path):
    path = tmp_path / "rulings.csv"
    path.write_text(
        "Award ID,Tracking Status,Verified Date,Evidence\n"
        ' A1 , vacated ,2026-01-01,"seen,\nand noted"\n,closed_out,,\nB1,,,\n'
        "A1,closed_out,2026-02-01,later\n C1,continued,,\n"
    )
    assert values(load_overrides(spark, str(path))) == [("A1", "closed_out"), ("B1", ""), ("C1", "continued")]
    assert load_overrides(spark, str(tmp_path / "absent.csv")).count() == 0


def test_guards(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("b",), ("d",)], "slice string")
    manifest = spark.createDataFrame([("a", 2), ("b", 3), ("c", 1)], "slice string, expected long")
    wrong = G.count_mismatches(frame, manifest, "slice")
    assert values(wrong) == [("b", 1, 3), ("c", 0, 1), ("d", 1, 0)]
    with pytest.raises(G.IncompleteInputError):
        G.refuse(wrong, "counts")
    G.refuse(wrong.where("slice = 'x'"), "counts")
    with pytest.raises(G.IncompleteInputError):
        G.refuse_none(0, "table")
    G.refuse_none(1, "table")


def pages(spark, *documents):
    """Contract pages from (page, success, advertised pages, number of items)."""
    return spark.createDataFrame(
        [
            (ok, page, (advertised,), ([("NASA",) + (None,) * 7] * items,))
            for page, ok, advertised, items in documents
        ],
        feed.CONTRACT_PAGE,
    )


@pytest.mark.parametrize(
    ("documents", "problems"),
    [
        ([(1, True, 2, 1), (2, True, 2, 1)], []),
        ([(1, True, 3, 1), (2, True, 3, 0)], [(2, "empty"), (3, "missing")]),
        ([(1, False, 1, 1)], [(1, "unsuccessful")]),
        ([(1, True, None, 1)], [(None, "unusable page count")]),
        ([(1, True, 0, 1)], [(None, "unusable page count")]),
        ([(2, True, 2, 1)], [(None, "unusable page count")]),
        ([(1, True, 2, 1), (2, True, 2, 1), (2, True, 2, 1)], [(2, "duplicate")]),
        ([(1, True, 1, 1), (2, True, 1, 1), (None, True, 1, 1)], [(2, "unexpected"), (None, "unexpected")]),
        ([(1, True, 2, 1), (2, True, 3, 1)], [(None, "disagreeing page counts")]),
    ],
)
def test_page_completeness(spark, documents, problems):
    assert values(G.page_problems(pages(spark, *documents), "contracts")) == problems


def test_lines_that_do_not_parse_are_unreadable(spark, tmp_path):
    good = '{"success": true, "page": 1, "meta": {"pages": 2}, "result": {"contracts": [{"agency": "NASA"}]}}'
    (tmp_path / "pages.json").write_text("\n".join([good, good.replace('"page": 1', '"page": 2')[:-9], "not json"]))
    landed = feed.read_pages(spark, str(tmp_path / "pages.json"), feed.CONTRACT_PAGE)
    assert values(G.page_problems(landed, "contracts")) == [(2, "missing"), (None, "unreadable")]
    assert feed.contract_claims(landed).count() == 1


def test_staging_uses_the_session_folder(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    staged = Staging(spark).table(spark.range(5), "five")
    assert staged.count() == 5 and folder.removeprefix("file:") in staged.inputFiles()[0]


def test_ledger_layout_prunes_folders_and_pushes_filters(spark, tmp_path):
    actions = [action(i, f"20{20 + i % 6}-05-01", awarding_agency_id=862 if i % 2 else 97) for i in range(60)]
    path = str(tmp_path / "ledger")
    L.write_ledger(ledger(spark, actions), path)
    scan = L.ledger_scan(L.read_ledger(spark, path), start=START)
    assert scan.count() == 10
    plan = scan.select("sort_key")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(awarding_agency_id" in plan and "(action_year#" in plan.split("PushedFilters")[0]
    history = end_date_history(L.read_ledger(spark, path), since=START)
    assert "action_year" in history._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1].split("]")[0]
    assert "GreaterThanOrEqual(action_date,2025-01-20)" in plan
    assert "transaction_description" not in plan


def test_publish_a_ledger(spark, tmp_path):
    actions = [
        action(1, "2025-06-01", code="F", text="admin"),
        action(2, "2026-08-01", award=2, piid="B1", generated="", code="F"),
        action(3, "2025-06-01", award=3, piid="C1", generated="CONT_AWD_C1", text="stop work, intent to descope"),
        action(4, "2025-06-01", award=4, piid="D1", generated="CONT_AWD_D1", code="F"),
        action(5, "2012-06-01", award=5, piid="E1", generated="CONT_AWD_E1", code="F"),
        action(6, "2024-06-01", award=6, piid="F1", generated="CONT_AWD_F1",
               period_of_performance_current_end_date=day("2028-01-01")),
        action(7, "2025-06-01", award=6, piid="F1", generated="CONT_AWD_F1",
               period_of_performance_current_end_date=day("2026-01-01")),
    ]
    overrides = spark.createDataFrame([("D1", "vacated"), ("Z", "closed_out")], "override_id string, status string")
    out = str(tmp_path / "out")
    store = Store(spark, out)
    publish.publish_ledger(
        spark, ledger(spark, actions), rollup(spark, [award(1)]), overrides, out, today=date(2026, 8, 20)
    )

    def published(name, schema):
        stored = store.read(name, schema)
        rendered = files.read_csv(spark, f"{store.path(name)}.csv", schema)
        assert [tuple(r) for r in rendered.collect()] == [tuple(r) for r in stored.collect()]
        return stored

    terminations = published("terminations", TERMINATION)
    assert values(terminations, "award_key", "sources", "award_description") == [
        ("CONT_AWD_A1", "mirror", "relay"), ("PIID:B1", "api;mirror", ""),
    ]
    assert values(published("descoped", TERMINATION), "award_key") == [("CONT_AWD_C1",)]
    assert values(published("pullbacks", PULLBACK), "award_id", "days_shortened") == [("F1", 730)]
    years = {r.fiscal_year: r.terminated_awards for r in published("fiscal_years", FISCAL_YEAR).collect()}
    assert {y: n for y, n in years.items() if n} == {2012: 1, 2025: 1, 2026: 1}
    unmatched = spark.read.parquet(f"{store.path('unmatched_rulings')}.parquet")
    assert values(unmatched) == [("Z", "closed_out")]
    assert spark.read.parquet(f"{store.path('summary')}.parquet").first().asDict() == {
        "recency_rows": 2, "depth_rows": 4, "published_rows": 2, "both_rows": 1, "descoped_rows": 1,
    }
    checks = spark.read.parquet(f"{store.path('checks')}.parquet")
    assert {r.check: r.found for r in checks.collect()} == {
        "accepted, not candidates": 0, "phrase without termination": 0, "without any id": 0,
    }


NO_RULINGS = "override_id string, status string"


def published_keys(spark, out):
    return [r.award_key for r in Store(spark, out).read("terminations", TERMINATION).collect()]


def test_a_daily_run_meets_the_stored_depth_part(spark, tmp_path):
    none, out = spark.createDataFrame([], NO_RULINGS), str(tmp_path / "out")
    book = [action(1, "2025-06-01", code="F", text="admin")]
    publish.publish_depth(spark, ledger(spark, book), rollup(spark, []), none, out, today=LATE)
    assert published_keys(spark, out) == ["CONT_AWD_A1"]
    news = [action(9, "2026-08-19", award=9, piid="N1", generated="CONT_AWD_N1", code="F")]
    publish.publish_recency(spark, ledger(spark, news), rollup(spark, []), none, out, today=LATE)
    assert published_keys(spark, out) == ["CONT_AWD_N1", "CONT_AWD_A1"]
    stored = Store(spark, out)
    assert stored.read("depth_part", TERMINATION).count() == stored.read("recency_part", TERMINATION).count() == 1
    folders = [d for d in os.listdir(shared_folder(spark).removeprefix("file:")) if d.startswith("anchorline-")]
    before = set(folders)
    publish.publish_recency(spark, ledger(spark, news), rollup(spark, []), none, out, today=LATE)
    after = {d for d in os.listdir(shared_folder(spark).removeprefix("file:")) if d.startswith("anchorline-")}
    assert after == before  # a run's staged tables go with it


def test_the_monthly_run_reads_the_ledgers_texts_once(spark, tmp_path, monkeypatch):
    """The part, the checks and the fiscal years come from one pass over the texts."""
    L.write_ledger(
        ledger(spark, [action(1, "2025-06-01", code="F"), action(2, "2012-06-01", award=2, piid="B", generated="", code="F")]),
        str(tmp_path / "book"),
    )
    plans = []

    def recorded(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())

    class Recording(publish.Staging):
        def table(self, df, name):
            recorded(df)
            return super().table(df, name)

    class RecordingStore(Store):
        def publish(self, tables, **more):
            for frame in tables.values():
                recorded(frame)
            return super().publish(tables, **more)

    monkeypatch.setattr(publish, "Staging", Recording)
    monkeypatch.setattr(publish, "Store", RecordingStore)
    none, out = spark.createDataFrame([], NO_RULINGS), str(tmp_path / "out")
    publish.publish_depth(spark, L.read_ledger(spark, str(tmp_path / "book")), rollup(spark, []), none, out, today=LATE)
    scans = [scan for plan in plans for scan in plan.split("FileScan")[1:] if "/book]" in scan]
    assert sum("transaction_description:string" in scan for scan in scans) == 1
    years = Store(spark, out).read("fiscal_years", FISCAL_YEAR).where("terminated_awards > 0")
    assert values(years) == [(2012, 1), (2025, 1)]


def test_a_failing_year_scan_leaves_the_rest_published(spark, tmp_path, monkeypatch):
    none, out = spark.createDataFrame([], NO_RULINGS), str(tmp_path / "out")

    def fail(*args, **more):
        raise RuntimeError("scan lost")

    monkeypatch.setattr(publish, "count_by_fiscal_year", fail)
    with pytest.raises(RuntimeError):
        publish.publish_depth(
            spark, ledger(spark, [action(1, "2025-06-01", code="F")]), rollup(spark, []), none, out, today=LATE
        )
    assert published_keys(spark, out) == ["CONT_AWD_A1"]
    assert Store(spark, out).path("fiscal_years") is None


def test_a_failure_halfway_leaves_the_old_version(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.publish({"a": spark.range(3), "b": spark.range(1)})
    bad = spark.range(2).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(PySparkException):
        store.publish({"a": spark.range(9), "b": bad})
    schema = spark.range(1).schema
    assert store.read("a", schema).count() == 3 and store.read("b", schema).count() == 1
    store.publish({"a": spark.range(4)})
    assert store.read("a", schema).count() == 4 and store.read("b", schema).count() == 1
    assert store.read("c", schema).count() == 0


def test_of_two_writers_the_later_one_builds_on_the_earlier(spark, tmp_path):
    store, ids = Store(spark, str(tmp_path)), spark.range(1).schema
    store.publish({"part": spark.range(1), "other": spark.range(2)})
    base = store.snapshot()
    assert (base.number, base.rows) == (1, {"part": 1, "other": 2})
    Store(spark, str(tmp_path)).publish({"part": spark.range(3)})  # another writer
    with pytest.raises(StaleInputError):
        store.publish({"merged": spark.range(4)}, base=base, built_on=["part"])
    assert store.path("merged") is None and store.read("part", ids).count() == 3
    assert len(os.listdir(tmp_path / "versions")) == 2  # what was refused is gone
    store.publish({"merged": spark.range(4)}, base=base, built_on=["other"])
    assert store.snapshot().rows == {"part": 3, "other": 2, "merged": 4}
    assert store.read("part", ids, base).count() == 1


def test_a_writer_that_loses_the_number_follows(spark, tmp_path):
    """Another publication becomes current between a writer's look and its pointer."""
    other = Store(spark, str(tmp_path))

    class Late(Store):
        overtaken = False

        def _point(self, number, text):
            if not self.overtaken:
                self.overtaken = True
                other.publish({"a": spark.range(5)})
            return super()._point(number, text)

    Late(spark, str(tmp_path)).publish({"b": spark.range(6)})
    assert other.snapshot().rows == {"a": 5, "b": 6} and other.snapshot().number == 2


def test_unfinished_pointers_are_waited_for_or_passed_over(spark, tmp_path, monkeypatch):
    store, ids = Store(spark, str(tmp_path)), spark.range(1).schema
    store.publish({"a": spark.range(2)})
    unfinished = tmp_path / "current" / f"{2:012}.json"
    unfinished.write_text('{"a": ')
    assert store.read("a", ids).count() == 2
    whole = (tmp_path / "current" / f"{1:012}.json").read_text()
    monkeypatch.setattr("time.sleep", lambda _: unfinished.write_text(whole.replace('"a"', '"z"')))
    store.publish({"b": spark.range(3)})  # waits until the other writer has finished
    assert store.snapshot().rows == {"z": 2, "b": 3}
    given_up = tmp_path / "current" / f"{4:012}.json"
    given_up.write_text("")
    os.utime(given_up, (0, 0))
    store.publish({"c": spark.range(1)})
    assert store.snapshot().number == 5 and set(store.snapshot().rows) == {"z", "b", "c"}


def test_old_versions_are_pruned(spark, tmp_path):
    store, ids = Store(spark, str(tmp_path)), spark.range(1).schema
    store.publish({"a": spark.range(1), "b": spark.range(7)})
    versions = [store.publish({"a": spark.range(n)}) for n in (2, 3, 4)]
    assert store.prune(keep=2) == []  # all are young
    assert store.prune(keep=2, grace=0) == [versions[0]]  # the first one still holds b
    assert store.read("a", ids).count() == 4 and store.read("b", ids).count() == 7
    assert store.read("a", ids, store.snapshot(3)).count() == 3
    assert len(os.listdir(tmp_path / "current")) >= 2 and store.snapshot(2).number == 0


def test_a_merge_is_made_again_when_its_part_was_replaced(spark, tmp_path, monkeypatch):
    none, out = spark.createDataFrame([], NO_RULINGS), str(tmp_path / "out")
    book = [action(1, "2025-06-01", code="F"), action(2, "2026-08-01", award=2, piid="B1", generated="", code="F")]
    publish.publish_depth(spark, ledger(spark, book[:1]), rollup(spark, []), none, out, today=LATE)
    again, made = publish.prepare_terminations, []

    def overtaken(*parts, **more):
        made.append(1)
        if len(made) == 1:  # the depth part is replaced while the daily run merges
            newer = doors.depth_part(ledger(spark, book), rollup(spark, []), start=START, staging=more["staging"])
            Store(spark, out).publish({"depth_part": newer})
        return again(*parts, **more)

    monkeypatch.setattr(publish, "prepare_terminations", overtaken)
    publish.publish_recency(spark, ledger(spark, book), rollup(spark, []), none, out, today=LATE)
    assert len(made) == 2
    found = Store(spark, out).read("terminations", TERMINATION)
    assert values(found, "award_key", "sources") == [("CONT_AWD_A1", "mirror"), ("PIID:B1", "api;mirror")]


def test_a_table_is_sorted_once(spark, tmp_path, monkeypatch):
    from anchorline.sources import store as stores

    plans = []

    def recorded(df, path, schema, **more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return files.write_csv(df, path, schema, **more)

    monkeypatch.setattr(stores, "write_csv", recorded)
    store = Store(spark, str(tmp_path))
    store.publish({"a": spark.range(1000).repartition(7).orderBy(F.desc("id"))})
    assert "Exchange" not in plans[0] and "Sort" not in plans[0]
    stored = [r.id for r in spark.read.csv(store.path("a") + ".csv", header=True, schema="id long").collect()]
    assert stored == list(range(999, -1, -1))


def test_a_ledger_short_of_its_manifest_is_refused(spark, tmp_path):
    none = spark.createDataFrame([], NO_RULINGS)
    manifest = spark.createDataFrame([(day("2025-06-01"), 2)], "action_date date, expected long")
    with pytest.raises(G.IncompleteInputError):
        publish.publish_depth(
            spark, ledger(spark, [action(1, "2025-06-01", code="F")]), rollup(spark, []), none,
            str(tmp_path / "out"), today=LATE, manifest=manifest,
        )
    assert not (tmp_path / "out").exists()


def test_nothing_is_written_when_a_part_is_empty(spark, tmp_path):
    nothing = spark.createDataFrame([], NO_RULINGS)
    with pytest.raises(G.IncompleteInputError):
        publish.publish_ledger(
            spark, ledger(spark, [action(1, "2025-06-01")]), rollup(spark, []), nothing,
            str(tmp_path / "out"), today=date(2026, 8, 20),
        )
    assert not (tmp_path / "out").exists()


def test_publish_two_parts(spark, tmp_path):
    recency, depth, out = (str(tmp_path / n) for n in ("api", "depth", "out"))
    files.write_csv(rows(spark, [row("K", source="api"), row("A", source="api", native="A")]), recency, TERMINATION)
    files.write_csv(rows(spark, [row("K", source="mirror")]), depth, TERMINATION)
    (tmp_path / "r.csv").write_text("Award ID,Tracking Status\nA,continued\n")
    publish.publish_parts(spark, recency, depth, str(tmp_path / "r.csv"), out)
    found = Store(spark, out).read("terminations", TERMINATION)
    assert values(found, "award_key", "sources") == [("K", "api;mirror")]
    # A missing part counts as one without rows; two of them are refused.
    with pytest.raises(G.IncompleteInputError):
        publish.publish_parts(spark, recency + "x", depth + "x", str(tmp_path / "r.csv"), out)


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("terminated_awards,fiscal_year\n7,2020\n", [(2020, 7)]),
        ("note,fiscal_year,more,terminated_awards\nx,2020,y,7\n", [(2020, 7)]),
        ("fiscal_year,awards\n2020,7\n", None),
        ("", []),
    ],
)
def test_tables_are_read_by_name(spark, tmp_path, text, wanted):
    (tmp_path / "years.csv").write_text(text)
    if wanted is None:
        with pytest.raises(G.IncompleteInputError):
            files.read_csv(spark, str(tmp_path / "years.csv"), FISCAL_YEAR)
    else:
        assert values(files.read_csv(spark, str(tmp_path / "years.csv"), FISCAL_YEAR)) == wanted


def test_publish_claims_refuses_a_missing_page_and_reuses_its_output(spark, tmp_path):
    item = ("NASA", "Orbit", "1", "1", "2025-03-04", "x", "https://f.example/?PIID=A1", "d")
    contracts = spark.createDataFrame([(True, 1, (1,), ([item],))], feed.CONTRACT_PAGE)
    grants = spark.createDataFrame(
        [(True, 1, (1,), ([("NASA", "U", "1", "1", "2025-03-05", "https://u.example/award/G1")],))], feed.GRANT_PAGE)
    book, facts, out = ledger(spark, [action(1, "2025-06-01", code="F")]), rollup(spark, [award(1)]), str(tmp_path / "out")

    def run(existing, today):
        return publish.publish_claims(spark, contracts, grants, existing, book, facts, out, today=today)

    run(publish.stored_claims(spark, out), date(2026, 1, 1))
    first = publish.stored_claims(spark, out)
    assert values(first, "doge_award_id", "has_explicit_termination") == [("A1", True), ("G1", False)]
    run(first, date(2026, 6, 1))
    second = publish.stored_claims(spark, out)
    # The terminated award is settled and keeps its row; the other one is checked again.
    assert values(second, "doge_award_id", "checked_date") == [("A1", date(2026, 1, 1)), ("G1", date(2026, 6, 1))]
    short = grants.withColumn("meta", F.struct(F.lit(2).alias("pages")))
    with pytest.raises(G.IncompleteInputError):
        publish.publish_claims(spark, contracts, short, first, book, facts, out, today=date(2026, 6, 1))
