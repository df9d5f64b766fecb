"""One query per operator: a Spark plan over the driver tables and its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from anchorline import vocabulary as V
from anchorline.functions import predicates as P
from anchorline.functions import scalars as S
from anchorline.operators import adjudicate as A
from anchorline.operators import claims as C
from anchorline.operators import guards as G
from anchorline.operators import merge as M
from anchorline.operators import overrides as R
from anchorline.operators import reports, sweeps
from anchorline.plans import doors
from anchorline.plans.publish import prepare_terminations
from anchorline.schemas import CLAIM, TERMINATION
from anchorline.sources import claims_feed as feed
from anchorline.sources import ledger as L
from anchorline.sources import overrides as O
from anchorline.sources import tables as files
from anchorline.sources.staging import Staging
from workload import oracle as Q
from workload import tables as T
from workload.tables import LOOKBACK_DAYS, START, TODAY, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str):
    """Register a query over `Tables` under `name` with its oracle."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        ORACLES[name] = sql
        return build

    return register


# --- shared steps -------------------------------------------------------------------


def depth_txn(t: Tables) -> DataFrame:
    return L.normalise_ledger(L.ledger_scan(t.ledger(), start=START))


def sweep_txn(t: Tables, window: tuple[date, date] | None = (START, TODAY)) -> DataFrame:
    return sweeps.normalise_sweep(sweeps.sweep_rows(t.ledger(), window=window))


def recency(t: Tables, staging: Staging) -> DataFrame:
    return doors.recency_part(
        t.ledger(), t.rollup(), start=START, today=TODAY, lookback_days=LOOKBACK_DAYS,
        staging=staging,
    )


def depth(t: Tables, staging: Staging) -> DataFrame:
    return doors.depth_part(t.ledger(), t.rollup(), start=START, staging=staging)


def part(t: Tables, name: str, door: Callable[[Tables, Staging], DataFrame]) -> DataFrame:
    """A door's part as the merge meets it: a table the door has written."""
    path = t.land(name, lambda path: door(t, Staging(t.spark)).write.parquet(path))
    return t.spark.read.schema(TERMINATION).parquet(path)


def parts(t: Tables) -> tuple[DataFrame, DataFrame]:
    return part(t, "recency_part", recency), part(t, "depth_part", depth)


def land_tables(t: Tables) -> None:
    """Write every derived table, both parts and the previous run's claims."""
    t.land_all()
    parts(t)
    existing_claims(t)


def overrides(t: Tables) -> DataFrame:
    raw = t.raw_overrides().withColumnsRenamed(
        {"award_ref": V.OVERRIDE_ID_COLUMN, "status": V.OVERRIDE_STATUS_COLUMN}
    )
    return O.clean_overrides(raw, "position")


def merged(t: Tables, staging: Staging) -> DataFrame:
    return M.merge(*parts(t), staging=staging)


PARTS = [Q.RAW, Q.RAW_ROLLUP, *Q.recency_ctes(), *[c for c in Q.depth_ctes() if c != Q.FACTS]]
MERGED = [*PARTS, *Q.merged_ctes(), *Q.collapsed_ctes()]
LEDGER = [Q.RAW, Q.scan(Q.START), Q.TXN]
PUBLISHED = ", ".join(Q.COLUMNS)

# --- scans ---------------------------------------------------------------------------


@query("ledger_scan", Q.with_(Q.RAW, Q.scan(Q.START), select="SELECT * FROM scan"))
def _(t: Tables) -> DataFrame:
    return L.ledger_scan(t.ledger(), start=START)


@query(
    "award_rollup",
    Q.with_(Q.RAW_ROLLUP, Q.FACTS, select="SELECT * RENAME (fact_id AS award_id) FROM facts"),
)
def _(t: Tables) -> DataFrame:
    return L.award_rollup(t.rollup())


@query(
    "claims_scan",
    Q.with_(Q.CLAIM_ITEMS, Q.CLAIMS, select="SELECT * EXCLUDE (o_orderkey) FROM claims"),
)
def _(t: Tables) -> DataFrame:
    return feed.claims_scan(*t.landed_claims())


@query(
    "csv_roundtrip",
    Q.with_(
        *PARTS,
        select=f"""SELECT {PUBLISHED.replace("transaction_description, ",
            "trim(regexp_replace(transaction_description, '[[:space:]]+', ' ', 'g'))"
            " AS transaction_description, ")} FROM depth""",
    ),
)
def _(t: Tables) -> DataFrame:
    """Written with the columns the other way round, read by name."""
    path = Staging(t.spark).path("csv")
    files.write_csv(A.publish_order(parts(t)[1]), path, StructType(TERMINATION.fields[::-1]))
    return files.read_csv(t.spark, path, TERMINATION)


@query("overrides_load", Q.with_(*Q.OVERRIDES, select="SELECT * FROM overrides"))
def _(t: Tables) -> DataFrame:
    path = Staging(t.spark).path("rulings")
    (
        t.raw_overrides()
        .orderBy("position")
        .select(
            F.col("award_ref").alias(V.OVERRIDE_ID_COLUMN),
            F.col("status").alias(V.OVERRIDE_STATUS_COLUMN),
            F.lit("seen,\nand noted").alias("Evidence"),
        )
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return O.load_overrides(t.spark, path)


_RENDERED = ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}"
    if c == "action_date"
    else f"coalesce(CAST({c} AS VARCHAR), '') AS {c}"
    if c in ("transaction_amount", "total_obligated", "total_potential_value")
    else f"trim(regexp_replace({c}, '\\s+', ' ', 'g')) AS {c}"
    for c in Q.COLUMNS
)


@query("render_rows", Q.with_(*PARTS, select=f"SELECT {_RENDERED} FROM depth"))
def _(t: Tables) -> DataFrame:
    return files.render(parts(t)[1], TERMINATION)


# --- scalar expressions -----------------------------------------------------------------

_ITEMS = [Q.CLAIM_ITEMS]


@query(
    "date_coerce",
    Q.with_(
        *_ITEMS,
        select=f"SELECT o_orderkey, date_text, {Q.iso_date('date_text')} AS day FROM items",
    ),
)
def _(t: Tables) -> DataFrame:
    return t.claim_items().select("o_orderkey", "date_text", S.as_date("date_text").alias("day"))


@query(
    "claim_date",
    Q.with_(
        *_ITEMS,
        select=f"SELECT o_orderkey, date_text, {Q.claim_date('date_text')} AS day FROM items",
    ),
)
def _(t: Tables) -> DataFrame:
    return t.claim_items().select("o_orderkey", "date_text", S.claim_date("date_text").alias("day"))


@query(
    "money_coerce",
    Q.with_(
        *_ITEMS, select=f"SELECT o_orderkey, {Q.money('value_text')} AS amount FROM items"
    ),
)
def _(t: Tables) -> DataFrame:
    return t.claim_items().select("o_orderkey", S.money("value_text").alias("amount"))


@query(
    "url_param_id",
    Q.with_(
        *_ITEMS,
        select=f"""SELECT o_orderkey, {Q.param_id('link')} AS param_id FROM items""",
    ),
)
def _(t: Tables) -> DataFrame:
    return t.claim_items().select("o_orderkey", S.url_param("link", "PIID").alias("param_id"))


@query(
    "url_path_id",
    Q.with_(
        *_ITEMS,
        f"""links AS (SELECT 'claim' AS origin, o_orderkey AS id, link FROM items
            UNION ALL SELECT 'page' AS origin, page_id AS id, url AS link FROM pages)""",
        select=f"SELECT origin, id, {Q.path_id('link')} AS path_id FROM links",
    ),
)
def _(t: Tables) -> DataFrame:
    claims = t.claim_items().select(
        F.lit("claim").alias("origin"), F.col("o_orderkey").alias("id"), "link"
    )
    pages = t.read("pages").select(
        F.lit("page").alias("origin"), F.col("page_id").alias("id"), F.col("url").alias("link")
    )
    return claims.unionByName(pages).select("origin", "id", S.url_path_id("link").alias("path_id"))


@query(
    "code_norm",
    Q.with_(
        Q.RAW,
        select="""SELECT ingest_seq, upper(trim(coalesce(action_type, ''))) AS action_code,
            upper(trim(coalesce(type, ''))) AS type_code FROM raw""",
    ),
)
def _(t: Tables) -> DataFrame:
    return t.ledger().select(
        "ingest_seq", S.code("action_type").alias("action_code"), S.code("type").alias("type_code")
    )


@query(
    "award_key",
    Q.with_(
        *LEDGER,
        select="""SELECT ingest_seq, award_key, starts_with(award_key, 'PIID:') AS is_fallback
            FROM txn""",
    ),
)
def _(t: Tables) -> DataFrame:
    return depth_txn(t).select(
        "ingest_seq", "award_key", S.is_fallback_key("award_key").alias("is_fallback")
    )


@query("award_type", Q.with_(*LEDGER, select="SELECT ingest_seq, award_type FROM txn"))
def _(t: Tables) -> DataFrame:
    return depth_txn(t).select("ingest_seq", "award_type")


@query(
    "mod_sort_key",
    Q.with_(
        Q.RAW,
        select=f"""SELECT ingest_seq, modification_number,
            {Q.mod_key("modification_number")} AS sort_key,
            {Q.mod_key("generated_unique_award_id || '-' || CAST(ingest_seq AS VARCHAR)")} AS id_key
            FROM raw""",
    ),
)
def _(t: Tables) -> DataFrame:
    mixed = F.concat("generated_unique_award_id", F.lit("-"), F.col("ingest_seq").cast("string"))
    return t.ledger().select(
        "ingest_seq",
        "modification_number",
        S.mod_sort_key("modification_number").alias("sort_key"),
        S.mod_sort_key(mixed).alias("id_key"),
    )


_NORMAL = """internal_award_id award_key award_id generated_award_id award_type recipient_name
    action_date action_type modification_number description award_type_code amount source
    sort_key ingest_seq""".split()


@query(
    "normalise_txn",
    Q.with_(
        *LEDGER,
        Q.SWEEP_TXN,
        select=f"""SELECT {", ".join(_NORMAL)} FROM txn UNION ALL BY NAME
            SELECT {", ".join(c for c in _NORMAL if c not in ("internal_award_id", "award_type_code"))}
            FROM stxn""",
    ),
)
def _(t: Tables) -> DataFrame:
    swept = sweep_txn(t, window=None)
    return (
        depth_txn(t)
        .select(_NORMAL)
        .unionByName(
            swept.select([c for c in _NORMAL if c in swept.columns]), allowMissingColumns=True
        )
    )


@query(
    "location_struct",
    Q.with_(
        Q.RAW_ROLLUP,
        Q.FACTS,
        select="""SELECT fact_id AS award_id, recipient_address1 AS r_address1,
            recipient_address2 AS r_address2, recipient_city AS r_city, recipient_state AS r_state,
            recipient_zip AS r_zip, recipient_district AS r_district, '' AS p_address1,
            '' AS p_address2, pop_city AS p_city, pop_state AS p_state, pop_zip AS p_zip,
            pop_district AS p_district FROM facts""",
    ),
)
def _(t: Tables) -> DataFrame:
    places = L.award_rollup(t.rollup()).select(
        "award_id", L.recipient_location().alias("r"), L.pop_location().alias("p")
    )
    parts = "address1 address2 city state zip district".split()
    return places.select(
        "award_id",
        *[F.col(f"{s}.{part}").alias(f"{s}_{part}") for s in "rp" for part in parts],
    )


@query(
    "collapse_ws",
    r"""SELECT doc_id, trim(regexp_replace(text, '[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) AS line
        FROM documents""",
)
def _(t: Tables) -> DataFrame:
    return t.read("documents").select("doc_id", S.collapse_ws("text").alias("line"))


@query(
    "fiscal_year",
    """SELECT l_orderkey, l_linenumber, l_partkey,
        CAST(year(l_shipdate) + CASE WHEN month(l_shipdate) >= 10 THEN 1 ELSE 0 END AS INTEGER)
            AS fiscal_year FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    return t.read("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", S.fiscal_year("l_shipdate").alias("fiscal_year")
    )


# --- predicates ----------------------------------------------------------------------------


@query(
    "in_window",
    Q.with_(
        *_ITEMS,
        select=f"""SELECT o_orderkey,
            coalesce({Q.iso_date('date_text')} >= DATE '1998-07-01', false) AS in_window FROM items""",
    ),
)
def _(t: Tables) -> DataFrame:
    bound = T.date(1998, 7, 1)
    return t.claim_items().select(
        "o_orderkey", P.in_window(S.as_date("date_text"), bound).alias("in_window")
    )


_TEXTS = """texts AS (
    SELECT 'ledger' AS origin, ingest_seq AS id, transaction_description AS body FROM raw
    UNION ALL SELECT 'document' AS origin, doc_id AS id, text AS body FROM documents
    UNION ALL SELECT 'turn' AS origin, conv_id * 100000 + turn AS id, text AS body FROM conversations
    UNION ALL SELECT 'page' AS origin, page_id AS id, html AS body FROM pages)"""


@query(
    "text_classify",
    Q.with_(
        Q.RAW,
        _TEXTS,
        select=f"""SELECT origin, id, {Q.termination("body")} AS termination,
            {Q.cause("body")} AS cause, {Q.descope("body")} AS descope,
            {Q.reversal("body")} AS reversal, {Q.vacatur("body")} AS vacatur FROM texts""",
    ),
)
def _(t: Tables) -> DataFrame:
    def texts(df: DataFrame, origin: str, key, body: str) -> DataFrame:
        return df.select(F.lit(origin).alias("origin"), key.alias("id"), F.col(body).alias("body"))

    every = (
        texts(t.ledger(), "ledger", F.col("ingest_seq"), "transaction_description")
        .unionByName(texts(t.read("documents"), "document", F.col("doc_id"), "text"))
        .unionByName(
            texts(t.read("conversations"), "turn", F.col("conv_id") * 100000 + F.col("turn"), "text")
        )
        .unionByName(texts(t.read("pages"), "page", F.col("page_id"), "html"))
    )
    return every.select(
        "origin",
        "id",
        P.is_termination("body").alias("termination"),
        P.is_cause("body").alias("cause"),
        P.is_descope("body").alias("descope"),
        P.is_reversal("body").alias("reversal"),
        P.is_vacatur("body").alias("vacatur"),
    )


@query(
    "action_code",
    Q.with_(
        *LEDGER,
        select=f"SELECT ingest_seq, {Q.CODED} AS coded, {Q.STANDALONE} AS standalone FROM txn",
    ),
)
def _(t: Tables) -> DataFrame:
    return depth_txn(t).select(
        "ingest_seq",
        P.has_termination_code().alias("coded"),
        P.has_standalone_code().alias("standalone"),
    )


@query(
    "explicit_events",
    Q.with_(
        *LEDGER,
        select=f"""SELECT award_key, action_date, sort_key, ingest_seq, description
            FROM txn WHERE {Q.explicit(Q.START)}""",
    ),
)
def _(t: Tables) -> DataFrame:
    return (
        depth_txn(t)
        .where(P.is_explicit_termination(START))
        .select("award_key", "action_date", "sort_key", "ingest_seq", "description")
    )


_SWEPT = "award_key, award_type, action_date, action_type, description, ingest_seq"


@query(
    "keyword_sweep",
    Q.with_(Q.RAW, Q.SWEEP_TXN, select=f"SELECT {_SWEPT} FROM ({Q.KEYWORD_ROWS})"),
)
def _(t: Tables) -> DataFrame:
    return sweeps.keyword_sweep(sweep_txn(t), start=START, today=TODAY).select(_SWEPT.split(", "))


@query(
    "code_sweep", Q.with_(Q.RAW, Q.SWEEP_TXN, select=f"SELECT {_SWEPT} FROM ({Q.CODE_ROWS})")
)
def _(t: Tables) -> DataFrame:
    return sweeps.code_sweep(
        sweep_txn(t), start=START, today=TODAY, lookback_days=LOOKBACK_DAYS
    ).select(_SWEPT.split(", "))


@query(
    "sweep_union",
    Q.with_(Q.RAW, Q.SWEEP_TXN, Q.SWEPT, select=f"SELECT {_SWEPT}, arrival FROM swept"),
)
def _(t: Tables) -> DataFrame:
    return sweeps.sweep_union(
        sweep_txn(t), start=START, today=TODAY, lookback_days=LOOKBACK_DAYS
    ).select(*_SWEPT.split(", "), "arrival")


@query(
    "detected_by",
    Q.with_(*LEDGER, select=f"SELECT ingest_seq, {Q.DETECTED} AS detected_by FROM txn"),
)
def _(t: Tables) -> DataFrame:
    return depth_txn(t).select("ingest_seq", P.detected_by().alias("detected_by"))


@query(
    "candidates",
    Q.with_(
        *LEDGER, select=f"SELECT DISTINCT internal_award_id FROM txn WHERE {Q.candidate()}"
    ),
)
def _(t: Tables) -> DataFrame:
    return A.candidate_awards(depth_txn(t))


# --- adjudication ------------------------------------------------------------------------------

_EVENT = """award_key award_id award_type action_date action_type description sort_key
    ingest_seq""".split()


@query(
    "candidate_history",
    Q.with_(
        *LEDGER, Q.CANDIDATE_TXN, select=f"SELECT internal_award_id, {', '.join(_EVENT)} FROM history"
    ),
)
def _(t: Tables) -> DataFrame:
    return A.candidate_history(depth_txn(t)).select("internal_award_id", *_EVENT)


@query(
    "operative_event",
    Q.with_(
        *LEDGER,
        *Q.adjudicate("txn", "accepted", Q.START),
        select=f"SELECT {', '.join(_EVENT)}, {Q.RANK} AS anchor_rank FROM accepted",
    ),
)
def _(t: Tables) -> DataFrame:
    return A.accept_awards(depth_txn(t), start=START, staging=Staging(t.spark)).select(
        *_EVENT, P.anchor_rank().alias("anchor_rank")
    )


_LINES_START = f"DATE '{T.LINES_START}'"


@query(
    "operative_event_lines",
    Q.with_(
        Q.RAW_LINES,
        Q.scan(_LINES_START),
        Q.TXN,
        *Q.adjudicate("txn", "accepted", _LINES_START),
        select=f"SELECT {', '.join(_EVENT)} FROM accepted",
    ),
)
def _(t: Tables) -> DataFrame:
    txn = L.normalise_ledger(L.ledger_scan(t.lines_ledger(), start=T.LINES_START))
    return A.accept_awards(txn, start=T.LINES_START, staging=Staging(t.spark)).select(_EVENT)


@query("adjudicated", Q.with_(*PARTS, select=f"SELECT {PUBLISHED} FROM depth"))
def _(t: Tables) -> DataFrame:
    return depth(t, Staging(t.spark))


@query(
    "enrich_rollup",
    Q.with_(
        *LEDGER,
        Q.RAW_ROLLUP,
        Q.FACTS,
        select=f"""SELECT a.ingest_seq, a.award_key, {Q.fact_cells()}
            FROM txn a LEFT JOIN facts f ON f.fact_id = a.internal_award_id""",
    ),
)
def _(t: Tables) -> DataFrame:
    joined = L.with_rollup(depth_txn(t), t.rollup())
    return joined.select(
        "ingest_seq",
        "award_key",
        "award_description",
        *[
            F.col(f"{s}_location.{p}").alias(f"{s}_{p}")
            for s in ("recipient", "pop")
            for p in "address1 address2 city state zip district".split()
            if s == "recipient" or not p.startswith("address")
        ],
        "total_obligated",
        "total_potential_value",
    )


@query(
    "followup_rejudge",
    Q.with_(
        Q.RAW, *Q.rejudge_ctes(), select=f"SELECT {', '.join(_EVENT)}, arrival FROM rejudged"
    ),
)
def _(t: Tables) -> DataFrame:
    return sweeps.followup_rejudge(
        sweep_txn(t), start=START, today=TODAY, lookback_days=LOOKBACK_DAYS,
        staging=Staging(t.spark),
    ).select(*_EVENT, "arrival")


@query("enrich_two_key", Q.with_(*PARTS, select=f"SELECT {PUBLISHED} FROM recency"))
def _(t: Tables) -> DataFrame:
    return recency(t, Staging(t.spark))


# --- reports -----------------------------------------------------------------------------------


def _pullback_sql(raw: str, rollup: str, start: str, since: str) -> str:
    """Pull-backs by rank: an award's dated actions numbered once, the ends of that numbering
    taken by number, and its totals joined to them."""
    return Q.with_(
        raw,
        rollup,
        Q.FACTS,
        f"""history AS (
            SELECT *, coalesce(period_of_performance_current_end_date,
                TRY_CAST(nullif(trim(ordering_period_end_date), '') AS DATE)) AS ends_on
            FROM raw WHERE awarding_agency_id = 862 AND action_date >= {since})""",
        """dated AS (
            SELECT award_id, ends_on, count(*) OVER (PARTITION BY award_id) AS seats,
                row_number() OVER (PARTITION BY award_id
                    ORDER BY action_date, transaction_unique_id NULLS LAST, ingest_seq) AS seat
            FROM history WHERE ends_on IS NOT NULL)""",
        f"""shortened AS (
            SELECT award_id, min(CASE WHEN seat = 1 THEN ends_on END) AS original_end_date,
                min(CASE WHEN seat = seats THEN ends_on END) AS current_end_date,
                max(ends_on) AS max_end_date
            FROM dated GROUP BY award_id
            HAVING max(ends_on) - min(CASE WHEN seat = seats THEN ends_on END) > {V.MIN_PULLBACK_DAYS}
                AND min(CASE WHEN seat = seats THEN ends_on END) >= {start})""",
        f"""totals AS (
            SELECT award_id AS id, trim(coalesce(max({Q.NATIVE}), '')) AS native,
                coalesce(max(generated_unique_award_id), '') AS generated, max(type) AS kind,
                coalesce(bool_or(is_fpds), false) AS procured,
                coalesce(max(recipient_name), '') AS recipient_name,
                max(action_date) AS last_action_date, count(*) AS transaction_count
            FROM history GROUP BY award_id)""",
        select=f"""SELECT native AS award_id, trim(generated) AS generated_award_id,
                {Q.award_type("kind", "generated", "procured")} AS award_type,
                upper(trim(coalesce(kind, ''))) AS award_type_code, recipient_name, {Q.fact_cells()},
                original_end_date, max_end_date, current_end_date,
                CAST(max_end_date - current_end_date AS INTEGER) AS days_shortened,
                last_action_date, transaction_count
            FROM shortened s JOIN totals t ON t.id = s.award_id
            LEFT JOIN facts f ON f.fact_id = s.award_id
            WHERE last_action_date >= {start}""",
    )


@query("pullbacks", _pullback_sql(Q.RAW, Q.RAW_ROLLUP, Q.START, "DATE '2007-10-01'"))
def _(t: Tables) -> DataFrame:
    history = reports.end_date_history(t.ledger())
    return reports.pullback_order(reports.pullbacks(history, t.rollup(), start=START))


@query(
    "pullbacks_lines",
    _pullback_sql(Q.RAW_LINES, Q.RAW_LINES_ROLLUP, _LINES_START, f"DATE '{T.LINES_HISTORY}'"),
)
def _(t: Tables) -> DataFrame:
    history = reports.end_date_history(t.lines_ledger(), since=T.LINES_HISTORY)
    return reports.pullbacks(history, t.lines_rollup(), start=T.LINES_START)


_FIRST_DAY = f"DATE '{reports.fiscal_year_start(T.FIRST_FISCAL_YEAR)}'"
_LAST_YEAR = T.LINES_TODAY.year + (1 if T.LINES_TODAY.month >= 10 else 0)


@query(
    "fiscal_year_counts",
    Q.with_(
        Q.RAW_LINES,
        Q.scan(_FIRST_DAY),
        Q.TXN,
        Q.CANDIDATE_TXN,
        *Q.adjudicate("history", "accepted", _FIRST_DAY),
        *Q.OVERRIDES,
        """yearly AS (SELECT *, description AS transaction_description, '' AS override_status
            FROM accepted)""",
        """ruled AS (
            SELECT y.* REPLACE (CASE WHEN i.override_id IS NOT NULL THEN i.status
                WHEN k.override_id IS NOT NULL THEN k.status ELSE '' END AS override_status)
            FROM yearly y LEFT JOIN overrides i ON i.override_id = y.award_id
            LEFT JOIN overrides k ON k.override_id = y.award_key)""",
        f"""counted AS (
            SELECT year(action_date) + CASE WHEN month(action_date) >= 10 THEN 1 ELSE 0 END AS fy,
                count(*) AS n FROM ruled
            WHERE override_status NOT IN ('excluded_by_design', 'vacated', 'continued')
                AND NOT ({Q.DESCOPED}) GROUP BY 1)""",
        select=f"""SELECT CAST(y AS INTEGER) AS fiscal_year, coalesce(n, 0) AS terminated_awards
            FROM range({T.FIRST_FISCAL_YEAR}, {_LAST_YEAR + 1}) years(y) LEFT JOIN counted ON fy = y""",
    ),
)
def _(t: Tables) -> DataFrame:
    staging, first_day = Staging(t.spark), reports.fiscal_year_start(T.FIRST_FISCAL_YEAR)
    index, _ = doors.depth_index(t.lines_ledger(), start=first_day, staging=staging)
    rows = doors.fiscal_year_rows(index, first_day=first_day, staging=staging)
    rulings = staging.table(overrides(t), "rulings")
    return reports.count_by_fiscal_year(
        rows, rulings, first_fiscal_year=T.FIRST_FISCAL_YEAR, today=T.LINES_TODAY
    )


# --- merge and rulings ----------------------------------------------------------------------------


@query(
    "merge_parts",
    Q.with_(*PARTS, *Q.merged_ctes(), select=f"SELECT {PUBLISHED} FROM merged"),
)
def _(t: Tables) -> DataFrame:
    return M.merge_parts(*parts(t)).select(TERMINATION.names)


@query("collapse_fallback", Q.with_(*MERGED, select=f"SELECT {PUBLISHED} FROM collapsed"))
def _(t: Tables) -> DataFrame:
    return merged(t, Staging(t.spark))


@query("publish_order", Q.with_(*MERGED, select=f"SELECT {PUBLISHED} FROM collapsed"))
def _(t: Tables) -> DataFrame:
    staging = Staging(t.spark)
    return A.publish_order(staging.table(merged(t, staging), "merged"))


_RULED = [*MERGED, *Q.OVERRIDES, *Q.ruled_ctes("collapsed")]


@query("apply_overrides", Q.with_(*_RULED, select=f"SELECT {PUBLISHED} FROM ruled"))
def _(t: Tables) -> DataFrame:
    return R.apply_overrides(merged(t, Staging(t.spark)), overrides(t))


@query(
    "unmatched_overrides",
    Q.with_(
        *MERGED,
        *Q.OVERRIDES,
        select="""SELECT * FROM overrides WHERE override_id NOT IN (SELECT award_id FROM collapsed)
            AND override_id NOT IN (SELECT award_key FROM collapsed)""",
    ),
)
def _(t: Tables) -> DataFrame:
    return R.unmatched_overrides(merged(t, Staging(t.spark)), overrides(t))


@query(
    "descoped_split",
    Q.with_(
        *_RULED,
        select=f"""SELECT award_key, override_status, transaction_description,
            CASE WHEN {Q.DESCOPED} THEN 'descoped' ELSE 'terminations' END AS published_in FROM ruled""",
    ),
)
def _(t: Tables) -> DataFrame:
    staging = Staging(t.spark)
    ruled = staging.table(R.apply_overrides(merged(t, staging), overrides(t)), "ruled")
    kept, descoped = R.partition_descoped(ruled)
    columns = ["award_key", "override_status", "transaction_description"]
    return kept.select(*columns, F.lit("terminations").alias("published_in")).unionByName(
        descoped.select(*columns, F.lit("descoped").alias("published_in"))
    )


@query(
    "run_summary",
    Q.with_(
        *_RULED,
        select=f"""SELECT (SELECT count(*) FROM recency) AS recency_rows,
            (SELECT count(*) FROM depth) AS depth_rows,
            (SELECT count(*) FROM ruled WHERE NOT ({Q.DESCOPED})) AS published_rows,
            (SELECT count(*) FROM ruled WHERE NOT ({Q.DESCOPED}) AND contains(sources, ';'))
                AS both_rows,
            (SELECT count(*) FROM ruled WHERE {Q.DESCOPED}) AS descoped_rows""",
    ),
)
def _(t: Tables) -> DataFrame:
    staging = Staging(t.spark)
    return prepare_terminations(*parts(t), overrides(t), staging=staging).summary


# --- claims ------------------------------------------------------------------------------------------


def claims_with_key(t: Tables) -> DataFrame:
    """Every claim in scope with the order it comes from."""
    staging = Staging(t.spark)
    claims = feed.claims_scan(*t.landed_claims())
    # Every item's savings figure is its order key.
    return staging.table(
        claims.withColumn("position", F.col("doge_savings").cast("long")), "claims"
    )


def enriched(t: Tables, claims: DataFrame) -> DataFrame:
    return C.enrich_claims(
        claims, t.ledger(), t.rollup(), start=START, today=TODAY, staging=Staging(t.spark)
    )


def existing(t: Tables, claims: DataFrame) -> DataFrame:
    """A previous run's rows, checked on spread-out days."""
    position = F.col("doge_savings").cast("long")
    return (
        enriched(t, claims)
        .where(F.col("doge_claim_date") < F.lit("2000-01-01").cast("date"))
        .withColumns(
            {
                "position": position,
                "checked_date": F.date_sub(F.lit(TODAY), (position % 40).cast("int")),
                "latest_description": F.lit("as checked before"),
            }
        )
    )


def existing_claims(t: Tables) -> DataFrame:
    """The previous run's rows as that run has kept them: by key."""

    def keep(path: str) -> None:
        rows = C.keyed_claims(existing(t, claims_with_key(t).drop("position")))
        files.write_bucketed(rows, path, "claim_key")

    return files.read_bucketed(t.spark, t.land("existing_claims", keep), C.KEYED_CLAIM, "claim_key")


_CLAIM = ", ".join(Q.CLAIM_COLUMNS)


@query(
    "claim_facts",
    Q.with_(
        *Q.CLAIM_BASE,
        select="SELECT * FROM claim_facts",
    ),
)
def _(t: Tables) -> DataFrame:
    ids = feed.claims_scan(*t.landed_claims()).select("doge_award_id").distinct()
    awards = Staging(t.spark).table(
        C.award_facts(t.rollup()).join(ids, "doge_award_id", "left_semi"), "asked"
    )
    return C.claim_facts(t.ledger(), awards, start=START)


@query(
    "claims_enriched",
    Q.with_(*Q.CLAIM_BASE, Q.enriched("claims", "enriched"), select=f"SELECT {_CLAIM} FROM enriched"),
)
def _(t: Tables) -> DataFrame:
    return C.claim_order(enriched(t, claims_with_key(t).drop("position")))


@query(
    "claim_settled",
    Q.with_(
        *Q.CLAIM_BASE,
        Q.enriched("claims", "enriched"),
        select=f"""SELECT claim_type, doge_award_id, doge_savings, {Q.SETTLED} AS settled
            FROM enriched""",
    ),
)
def _(t: Tables) -> DataFrame:
    return enriched(t, claims_with_key(t).drop("position")).select(
        "claim_type", "doge_award_id", "doge_savings", P.is_settled(TODAY).alias("settled")
    )


@query(
    "claims_refresh",
    Q.with_(
        *Q.CLAIM_BASE,
        Q.enriched("claims", "enriched"),
        Q.EXISTING,
        f"""reusable AS (SELECT * FROM existing
            WHERE doge_award_id <> '' AND ({Q.SETTLED}
                OR checked_date > CAST({Q.TODAY} - {V.REFRESH_DAYS} AS DATE))
            QUALIFY row_number() OVER (PARTITION BY doge_award_id, doge_claim_date
                ORDER BY o_orderkey DESC) = 1)""",
        f"""refreshed AS (
            SELECT r.* FROM claims c JOIN reusable r ON c.doge_award_id = r.doge_award_id
                AND c.doge_claim_date IS NOT DISTINCT FROM r.doge_claim_date
            UNION ALL
            SELECT e.* FROM enriched e LEFT JOIN reusable r ON e.doge_award_id = r.doge_award_id
                AND e.doge_claim_date IS NOT DISTINCT FROM r.doge_claim_date
            WHERE r.doge_award_id IS NULL)""",
        select=f"SELECT {_CLAIM} FROM refreshed",
    ),
)
def _(t: Tables) -> DataFrame:
    staging = Staging(t.spark)
    claims = claims_with_key(t).drop("position")
    before = existing_claims(t)
    rows = C.refresh_claims(
        claims, before, t.ledger(), t.rollup(), start=START, today=TODAY, position="position",
        staging=staging,
    )
    return C.claim_order(rows).select(CLAIM.names)


# --- guards -------------------------------------------------------------------------------------------


@query(
    "guard_nonempty",
    Q.with_(
        *_RULED,
        select=f"""SELECT 'descoped' AS table_name, count(*) AS row_count,
                count(*) > 0 AS publishable FROM ruled WHERE {Q.DESCOPED}
            UNION ALL
            SELECT 'terminations', count(*), count(*) > 0 FROM ruled WHERE NOT ({Q.DESCOPED})
            UNION ALL
            SELECT 'late', count(*), count(*) > 0 FROM ruled WHERE action_date > {Q.TODAY}""",
    ),
)
def _(t: Tables) -> DataFrame:
    staging = Staging(t.spark)
    publication = prepare_terminations(*parts(t), overrides(t), staging=staging)
    every = publication.terminations.unionByName(publication.descoped)
    return G.row_counts(
        {
            "descoped": publication.descoped,
            "terminations": publication.terminations,
            "late": every.where(F.col("action_date") > F.lit(TODAY)),
        }
    )


@query(
    "guard_counts",
    f"""SELECT day, CAST(sum(found) AS BIGINT) AS found, CAST(sum(expected) AS BIGINT) AS expected FROM (
            SELECT CAST(ts AS DATE) AS day, 1 AS found, 0 AS expected FROM events
                WHERE event_type <> 'error'
            UNION ALL SELECT CAST(ts AS DATE), 0, 1 FROM events)
        GROUP BY day HAVING sum(found) <> sum(expected)""",
)
def _(t: Tables) -> DataFrame:
    """A landing that lost the rows of one event type, against the full manifest."""
    events = t.read("events").withColumn("day", F.col("ts").cast("date"))
    manifest = events.groupBy("day").agg(F.count("*").alias("expected"))
    return G.count_mismatches(events.where("event_type <> 'error'"), manifest, "day")


@query(
    "guard_pages",
    Q.with_(
        *_ITEMS,
        f"""numbered AS (SELECT CAST(floor(o_orderkey / {T.PAGE_SIZE}) AS INTEGER) + 1 AS page, agency
            FROM items)""",
        """seen AS (SELECT page, count(*) FILTER (WHERE agency = 'Department of Energy') AS listed
            FROM numbered GROUP BY page)""",
        """last AS (SELECT max(page) AS last FROM numbered)""",
        """judged AS (SELECT CAST(p AS INTEGER) AS page, CASE WHEN s.page IS NULL THEN 'missing'
                WHEN p = 1 THEN 'duplicate'
                WHEN p % 3 = 0 THEN 'unsuccessful' WHEN listed = 0 THEN 'empty' END AS problem
            FROM range(1, (SELECT last FROM last) + 3) pages(p) LEFT JOIN seen s ON s.page = p)""",
        select="""SELECT * FROM judged WHERE problem IS NOT NULL
            UNION ALL SELECT CAST(last + 3 AS INTEGER), 'unexpected' FROM last
            UNION ALL SELECT CAST(NULL AS INTEGER), 'unreadable' FROM last""",
    ),
)
def _(t: Tables) -> DataFrame:
    """A feed that advertises two pages too many, whose every third page reports failure, with
    its first page landed twice, one page beyond the advertised ones, and one cut off halfway."""
    items = t.claim_items().withColumn("page", (F.col("o_orderkey") / T.PAGE_SIZE).cast("int") + 1)
    last = items.agg(F.max("page").alias("last")).select((F.col("last") + 2).alias("pages")).scalar()
    entry = F.when(F.col("agency") == "Department of Energy", F.struct("agency"))
    pages = items.groupBy("page").agg(
        (F.first("page") % 3 != 0).alias("success"),
        F.struct(F.collect_list(entry).alias("contracts")).alias("result"),
    ).withColumn("meta", F.struct(last.alias("pages")))
    first = pages.where("page = 1")
    beyond = first.withColumn("page", F.col("meta.pages") + 1)
    lines = pages.unionByName(first).unionByName(beyond).select(F.to_json(F.struct("*")).alias("value"))
    half = first.select(F.to_json(F.struct("*")).alias("value")).select(
        F.expr("substring(value, 1, length(value) DIV 2)").alias("value")
    )
    path = Staging(t.spark).path("damaged")
    lines.unionByName(half).write.text(path)
    return G.page_problems(feed.read_pages(t.spark, path, feed.CONTRACT_PAGE), "contracts")


@query(
    "guard_containment",
    Q.with_(
        *LEDGER,
        select=f"""SELECT
            count(*) FILTER (WHERE {Q.explicit(Q.START)}) AS accepted_rows,
            count(*) FILTER (WHERE {Q.explicit(Q.START)} AND NOT {Q.candidate()}) AS missed_rows,
            count(*) FILTER (WHERE {Q.PHRASE_HIT} AND NOT {Q.termination()}) AS rejected_phrases,
            count(*) FILTER (WHERE {Q.explicit(Q.START)} AND NOT {Q.PHRASE_HIT} AND NOT {Q.STANDALONE})
                AS language_only_unswept FROM txn""",
    ),
)
def _(t: Tables) -> DataFrame:
    """Both breach counts (zero), beside what the phrase sweep alone would miss."""
    txn = depth_txn(t)
    accepted = P.is_explicit_termination(START)
    return txn.agg(
        F.count_if(accepted).alias("accepted_rows"),
        F.count_if(accepted & ~P.is_candidate()).alias("missed_rows"),
        F.count_if(P.matches_sweep_phrase() & ~P.is_termination("description")).alias(
            "rejected_phrases"
        ),
        F.count_if(accepted & ~P.matches_sweep_phrase() & ~P.has_standalone_code()).alias(
            "language_only_unswept"
        ),
    )


