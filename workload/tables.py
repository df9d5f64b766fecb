"""Ledgers derived from the driver tables.

Each derivation is one SQL text that both Spark and the SQL oracle run, so the two
start from identical rows and differ only in how they compute the operators. Every
derivation reads its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorline.sources import claims_feed as feed
from anchorline.sources import tables as files
from anchorline.sources.staging import Staging

# Bounds for the events ledger, which spans 2024-01-01 to 2024-01-30.
START = date(2024, 1, 5)
TODAY = date(2024, 1, 31)
LOOKBACK_DAYS = 12
# Bounds for the lineitem ledger, which spans 1995-01 to 2001-11.
LINES_START = date(1999, 1, 1)
LINES_HISTORY = date(1996, 1, 1)
FIRST_FISCAL_YEAR = 1996
LINES_TODAY = date(2001, 12, 31)

PHRASES = (
    "TERMINATE FOR CONVENIENCE of the buyer",
    "Exercise option period three",
    "STOP-WORK ORDER sent to vendor",
    "Incremental funding added",
    "termination for connivence, see letter",
    "Contract TERMINATED FOR CAUSE",
    "Administrative change only",
    "Stop work notice with intent to DESCOPE task four",
    "Rescission of the stop work order",
    "Telescope dome maintenance",
    "A court vacated the termination",
    "Flight termination receiver purchase",
    "terminate forconvenience",
    "Small business set aside, 100%",
    "Finalize partial termination settlement",
    "Address change",
    "T4C effective today",
    "De-scoped work element two",
    "LEGAL  CONTRACT CANCELLATION",
    "Suspension lifted, contract reinstated",
    "TERMINATION NOTICE issued: print shop",
    "Termination for default under clause 9",
    "Reduce scope of delivery",
    "Cancellation of partial stop work notice",
    "Board ruled the termination set aside",
    "Stopwork lifted? no, stop work stands",
    "Notice of termination mailed",
    "Resumption of work after suspension",
    "legal contract cancellation",
    "termination settlement paid",
    "Rescind the small business designation",
    "vacating leased rooms",
)
PHRASE_SLOTS = 64


def _phrase(number: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{text}'" for i, text in enumerate(PHRASES))
    return f"CASE {number} % {PHRASE_SLOTS} {arms} ELSE 'Funding action ' || CAST({number} AS STRING) END"


def _native(a: str) -> str:
    return f"'W' || lpad(CAST({a} AS STRING), 8, '0')"


def _generated(a: str) -> str:
    return f"""CASE WHEN {a} % 3 = 0 THEN 'ASST_NON_' WHEN {a} % 4 IN (1, 2) THEN 'CONT_IDV_'
        ELSE 'CONT_AWD_' END || {_native(a)} || '_8000'"""


def _type(a: str) -> str:
    return f"""CASE WHEN {a} % 3 = 0 THEN CASE WHEN {a} % 2 = 0 THEN '04' ELSE '05' END
        WHEN {a} % 4 = 1 THEN 'IDV_C' WHEN {a} % 4 = 2 THEN ' idv_b' WHEN {a} % 4 = 3 THEN 'A' END"""


def _ledger(a: str, n: str, day: str, action: str, amount: str, agency: str, key: str, source: str):
    """A raw ledger over `source`: award number `a`, row number `n`."""
    end = f"CAST({day} + CAST(({n} * 37) % 400 AS INT) AS DATE)"
    vehicle = f"({a} % 3 <> 0 AND {a} % 4 IN (1, 2))"
    return f"""
        SELECT
            {a} AS award_id,
            CASE WHEN {a} % 3 <> 0 THEN {_native(a)} END AS piid,
            CASE WHEN {a} % 3 = 0 AND {a} % 2 = 0 THEN ' ' || {_native(a)} || ' ' END AS fain,
            CASE WHEN {a} % 3 = 0 AND {a} % 2 <> 0 THEN {_native(a)} END AS uri,
            CASE WHEN {n} % 20 = 0 THEN '' WHEN {n} % 10 = 0 THEN NULL ELSE {_generated(a)} END
                AS generated_unique_award_id,
            {key} AS transaction_unique_id,
            CASE WHEN {a} % 3 = 0 THEN false WHEN NOT {vehicle} THEN true
                 WHEN {n} % 11 = 0 THEN NULL ELSE {n} % 13 <> 0 END AS is_fpds,
            {_type(a)} AS type,
            {day} AS action_date,
            {action} AS action_type,
            CASE WHEN {n} % 9 = 0 THEN NULL
                 WHEN {n} % 2 = 0 THEN 'P' || lpad(CAST({n} % 120 AS STRING), 5, '0')
                 ELSE CAST({n} % 120 AS STRING) END AS modification_number,
            {_phrase(n)} AS transaction_description,
            CAST({amount} AS DECIMAL(23, 2)) AS federal_action_obligation,
            CASE WHEN {n} % 50 = 0 THEN NULL ELSE 'Vendor ' || CAST({a} AS STRING) END
                AS recipient_name,
            {agency} AS awarding_agency_id,
            CASE WHEN {vehicle} OR {n} % 7 = 0 THEN NULL ELSE {end} END
                AS period_of_performance_current_end_date,
            CASE WHEN NOT {vehicle} THEN NULL WHEN {n} % 7 = 0 THEN '  '
                 ELSE ' ' || CAST({end} AS STRING) END AS ordering_period_end_date,
            {n} AS ingest_seq
        FROM {source}"""


EVENTS_LEDGER = _ledger(
    "user_id",
    "event_id",
    "CAST(ts AS DATE)",
    """CASE event_type
        WHEN 'purchase' THEN CASE WHEN value > 60 THEN 'F' WHEN value > 50 THEN ' f' ELSE 'M' END
        WHEN 'signup' THEN 'N' WHEN 'view' THEN 'M' WHEN 'click' THEN 'C' END""",
    "value",
    "CASE WHEN value < 1 THEN 97 ELSE 862 END",
    "'T' || lpad(CAST((event_id * 37) % 1000 AS STRING), 4, '0')",
    "{events}",
)

_LINE_NUMBER = "(l_linenumber * 100000000000 + l_suppkey * 10000000 + l_partkey)"
LINES_LEDGER = _ledger(
    "l_orderkey",
    "line_seq",
    "CAST(l_shipdate AS DATE)",
    """CASE WHEN l_linestatus = 'F' AND l_discount > 0.065 THEN 'F'
        WHEN l_returnflag = 'N' THEN 'N' ELSE l_returnflag END""",
    "l_extendedprice",
    "CASE WHEN l_quantity < 2 THEN 97 ELSE 862 END",
    "'L' || CAST(l_linenumber AS STRING)",
    f"(SELECT *, {_LINE_NUMBER} AS line_seq FROM {{lineitem}}) numbered",
)


def _rollup(a: str, name: str, money: str, end: str, source: str) -> str:
    place = f"lpad(CAST({a} % 100000 AS STRING), 5, '0')"
    return f"""
        SELECT
            {a} AS award_id,
            CASE WHEN {a} % 3 <> 0 THEN {_native(a)} END AS piid,
            CASE WHEN {a} % 3 = 0 AND {a} % 2 = 0 THEN {_native(a)} END AS fain,
            CASE WHEN {a} % 3 = 0 AND {a} % 2 <> 0 THEN {_native(a)} END AS uri,
            CASE WHEN {a} % 6 = 1 THEN NULL ELSE {_generated(a)} END AS generated_unique_award_id,
            {a} % 3 <> 0 AS is_fpds,
            {_type(a)} AS type,
            CASE WHEN {a} % 3 = 0 THEN CASE WHEN {a} % 2 = 0 THEN 'grant' ELSE 'loans' END
                 WHEN {a} % 4 IN (1, 2) THEN 'idv' ELSE 'contract' END AS category,
            862 AS awarding_agency_id,
            CASE WHEN n_nationkey = 3 THEN NULL ELSE 'Award to ' || {name} END AS description,
            CAST({a} AS STRING) || ' Main St' AS recipient_location_address_line1,
            CASE WHEN n_nationkey = 5 THEN 'Suite 5' END AS recipient_location_address_line2,
            n_name AS recipient_location_city_name,
            CASE WHEN n_nationkey = 7 THEN NULL ELSE 'S' || CAST(n_regionkey AS STRING) END
                AS recipient_location_state_code,
            {place} AS recipient_location_zip5,
            CASE WHEN n_nationkey % 2 = 0 THEN lpad(CAST(n_nationkey AS STRING), 2, '0') END
                AS recipient_location_congressional_code_current,
            CASE WHEN n_nationkey % 5 <> 1 THEN '0' || CAST(n_regionkey AS STRING) END
                AS recipient_location_congressional_code,
            CASE WHEN n_nationkey = 9 THEN NULL ELSE 'City of ' || n_name END AS pop_city_name,
            'P' || CAST(n_regionkey AS STRING) AS pop_state_code,
            {place} AS pop_zip5,
            CASE WHEN n_nationkey % 3 = 0 THEN lpad(CAST(n_nationkey AS STRING), 2, '0') END
                AS pop_congressional_code_current,
            '9' || CAST(n_regionkey AS STRING) AS pop_congressional_code,
            CAST({money} AS DECIMAL(23, 2)) AS total_obligation,
            CASE WHEN {a} % 3 <> 0 THEN CAST({money} * 2 AS DECIMAL(23, 2)) END
                AS base_and_all_options_value,
            {end} AS period_of_performance_current_end_date
        FROM {source}"""


EVENTS_ROLLUP = _rollup(
    "c_custkey",
    "c_name",
    "c_acctbal",
    """CASE WHEN c_mktsegment = 'BUILDING' THEN NULL
        ELSE CAST(DATE '2024-01-01' + CAST(c_custkey % 60 AS INT) AS DATE) END""",
    "{customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey",
)
LINES_ROLLUP = _rollup(
    "o_orderkey",
    "c_name",
    "o_totalprice",
    "CAST(o_orderdate AS DATE)",
    """{orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
       JOIN {nation} n ON c.c_nationkey = n.n_nationkey""",
)

#: The rulings file: one line per customer, some ids blank, some named twice.
RAW_OVERRIDES = f"""
    SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN '  '
                WHEN c_mktsegment = 'MACHINERY' THEN {_generated("c_custkey")}
                ELSE ' ' || {_native("c_custkey")} END AS award_ref,
           CASE WHEN c_acctbal < 500 THEN ' excluded_by_design ' WHEN c_acctbal < 1500 THEN 'descoped'
                WHEN c_acctbal < 2500 THEN 'closed_out' WHEN c_acctbal < 3000 THEN ''
                WHEN c_acctbal < 3500 THEN 'vacated' WHEN c_acctbal < 5000 THEN 'needs_manual_review'
                ELSE 'termination_confirmed' END AS status,
           c_custkey AS position
    FROM {{customer}}
    UNION ALL
    SELECT {_native("c_custkey")} AS award_ref, 'continued' AS status,
           1000000000000 + c_custkey AS position
    FROM {{customer}} WHERE c_acctbal > 9000
"""

_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
_DAY = "CAST(o_orderdate AS DATE)"
_Y, _M, _D = f"year({_DAY})", f"month({_DAY})", f"day({_DAY})"
_MONTHS = "CASE month({d}) " + " ".join(
    f"WHEN {i} THEN '{m}'"
    for i, m in enumerate("Jan Feb Mar APR May Jun jul Aug Sep Oct Nov Dec".split(), 1)
) + " END"


def _str(x: str) -> str:
    return f"CAST({x} AS STRING)"


_US_DATE = f"{_str(_M)} || '/' || {_str(_D)} || '/'"
#: Claim items over every order: one claim each, contracts and grants by order status.
CLAIM_ITEMS = f"""
    SELECT
        o_orderkey, o_custkey, o_orderstatus,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'NASA' WHEN '2-HIGH'
            THEN ' National Aeronautics and Space Administration' WHEN '3-MEDIUM' THEN 'nasa'
            WHEN '4-NOT SPECIFIED' THEN 'Department of Energy' END AS agency,
        ' Claimant ' || {_str("o_custkey")} AS party,
        CASE o_orderkey % 5 WHEN 0 THEN '$' || {_str(f"CAST(floor({_CENTS} / 100000) AS BIGINT)")}
                || ',' || lpad({_str(f"CAST(floor(({_CENTS} % 100000) / 100) AS BIGINT)")}, 3, '0')
                || '.' || lpad({_str(f"{_CENTS} % 100")}, 2, '0')
            WHEN 1 THEN {_str(f"CAST(floor({_CENTS} / 100) AS BIGINT)")}
            WHEN 2 THEN ' ' || {_str(f"CAST(o_totalprice AS DECIMAL(23, 2))")} || ' '
            WHEN 3 THEN 'unknown' ELSE '' END AS value_text,
        CASE o_orderkey % 7 WHEN 0 THEN {_str(_DAY)}
            WHEN 1 THEN {_US_DATE} || {_str(_Y)}
            WHEN 2 THEN {_US_DATE} || substring({_str(_Y)}, 3, 2)
            WHEN 3 THEN {_str(_D)} || '-' || {_MONTHS.format(d=_DAY)} || '-' || {_str(_Y)}
            WHEN 4 THEN {_str(_DAY)} || 'T10:11:12'
            WHEN 5 THEN ' ' || lpad({_str(_M)}, 2, '0') || '/' || lpad({_str(_D)}, 2, '0') || '/'
                || {_str(_Y)} || ' '
            ELSE CASE o_orderkey % 4 WHEN 0 THEN {_str(_M)} || '/ ' || {_str(f"{_D} % 9 + 1")} || '/' || {_str(_Y)}
                WHEN 1 THEN {_str(_Y)} || '-W' || lpad({_str(f"{_D} + 20")}, 2, '0') || '-' || {_str(f"{_D} % 7 + 1")}
                WHEN 2 THEN ' ' || {_str(f"{_D} % 9 + 1")} || '-' || {_MONTHS.format(d=_DAY)} || '-' || {_str(_Y)}
                ELSE 'Q3 ' || {_str(_Y)} END END AS date_text,
        CASE WHEN o_orderstatus = 'F' THEN
            CASE o_orderkey % 6 WHEN 0 THEN 'https://usaspending.example/award/ASST_NON_'
                    || {_native("o_custkey")} || '_8000'
                WHEN 1 THEN 'https://usaspending.example/award/' || {_native("o_custkey")} || '/'
                WHEN 2 THEN 'https://usaspending.example/award/CONT_AWD_' || {_native("o_custkey")}
                    || '_8000_-NONE-_-NONE-/?tab=history#top'
                WHEN 3 THEN 'https://usaspending.example' WHEN 4 THEN NULL
                ELSE 'https://usaspending.example/award/ASST_AGG_' || {_native("o_custkey")}
                    || '_080;v=2' END
        ELSE
            CASE o_orderkey % 6 WHEN 0 THEN 'https://fpds.example/search?PIID='
                    || {_native("o_custkey")} || '&s=FPDS'
                WHEN 1 THEN 'https://fpds.example/search?s=FPDS&PIID=' || {_native("o_custkey")}
                    || '#top'
                WHEN 2 THEN 'https://fpds.example/search?s=FPDS&XPIID=9'
                WHEN 3 THEN 'https://fpds.example/search?PIID=%57'
                    || lpad({_str("o_custkey")}, 8, '0') || '&PIID=second'
                WHEN 4 THEN CASE WHEN o_orderkey % 5 = 0 THEN 'https://fpds.example/search?PIID=%57'
                    || lpad({_str("o_custkey")}, 8, '0') || '%ZZ%4' END
                ELSE 'https://fpds.example/no/query' END
        END AS link,
        CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE ' Deleted' END AS status_text
    FROM {{orders}}
"""

PAGE_SIZE = 500
#: Bytes of a driver table per core from which its own row groups keep all cores busy: a group
#: of a million rows takes some twenty megabytes.
BYTES_PER_CORE = 1 << 24


#: Folders of landed tables, by application, source folder and table.
_LANDED: dict[tuple[str, str, str], str] = {}


class Tables:
    """The driver tables of one folder, and the tables landed from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, name: str) -> DataFrame:
        """A driver table over the session's cores: dealt anew if it is small, as it may be one
        row group; a large one is read in the splits it has, and none of its rows moves."""
        cores = self.spark.sparkContext.defaultParallelism
        files_of = self.spark.read.format("binaryFile").load(f"{self.folder}/{name}.parquet")
        size = files_of.agg(F.sum("length")).first()[0] or 0
        rows = self.read(name)
        return rows if size >= cores * BYTES_PER_CORE else rows.repartition(cores)

    def derive(self, sql: str) -> DataFrame:
        names = "region nation customer supplier orders lineitem events documents pages".split()
        return self.spark.sql(sql, **{n: self.spread(n) for n in names if "{" + n + "}" in sql})

    def land(self, name: str, build: Callable[[str], None]) -> str:
        """The folder of a derived table, which `build` writes once per session.

        It is written again when the folder is gone.
        """
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        path = _LANDED.get(key)
        if path is None or not files.path_exists(self.spark, path):
            path = _LANDED[key] = Staging(self.spark).path(name)
            build(path)
        return path

    def table(self, name: str, sql: str) -> DataFrame:
        """A derived table as the operators meet it: a folder of Parquet files."""
        return self.spark.read.parquet(
            self.land(name, lambda path: self.derive(sql).write.parquet(path))
        )

    def ledger(self) -> DataFrame:
        return self.table("ledger", EVENTS_LEDGER)

    def rollup(self) -> DataFrame:
        return self.table("rollup", EVENTS_ROLLUP)

    def lines_ledger(self) -> DataFrame:
        return self.table("lines_ledger", LINES_LEDGER)

    def lines_rollup(self) -> DataFrame:
        return self.table("lines_rollup", LINES_ROLLUP)

    def raw_overrides(self) -> DataFrame:
        return self.derive(RAW_OVERRIDES)

    def claim_items(self) -> DataFrame:
        return self.table("claim_items", CLAIM_ITEMS)

    def land_all(self) -> None:
        """Land every derived table."""
        self.ledger(), self.rollup(), self.lines_ledger(), self.lines_rollup()
        self.claim_items(), self.landed_claims()

    def _pages(self, items: DataFrame, key: str, fields: dict[str, str]) -> DataFrame:
        """Claim items as page documents of at most `PAGE_SIZE` items, by order key."""
        numbered = items.withColumn("page", (F.col("o_orderkey") / PAGE_SIZE).cast("int") + 1)
        pages = self.read("orders").agg(
            ((F.max("o_orderkey") / PAGE_SIZE).cast("int") + 1).alias("pages")
        )
        item = F.struct(*[F.expr(sql).alias(name) for name, sql in fields.items()])
        slices = self.spark.sparkContext.defaultParallelism
        return numbered.repartition(slices, "page").groupBy("page").agg(
            F.lit(True).alias("success"),
            F.first(F.struct(pages.scalar().alias("pages"))).alias("meta"),
            F.struct(F.collect_list(item).alias(key)).alias("result"),
        )

    def claim_pages(self) -> tuple[DataFrame, DataFrame]:
        """Contract and grant page documents, before landing."""
        items = self.claim_items()
        contracts = self._pages(
            items.where("o_orderstatus <> 'F'"),
            "contracts",
            {
                "agency": "agency", "vendor": "party", "value": "value_text",
                "savings": "CAST(o_orderkey AS STRING)", "deleted_date": "date_text",
                "fpds_status": "status_text", "fpds_link": "link", "description": "'claim'",
            },
        )
        grants = self._pages(
            items.where("o_orderstatus = 'F'"),
            "grants",
            {
                "agency": "agency", "recipient": "party", "value": "value_text",
                "savings": "CAST(o_orderkey AS STRING)", "date": "date_text", "link": "link",
            },
        )
        return contracts, grants

    def landed_claims(self) -> tuple[DataFrame, DataFrame]:
        """The page documents as landed: JSON lines."""
        contracts, grants = self.claim_pages()
        landed = {
            name: self.land(name, pages.write.json)
            for name, pages in (("contracts", contracts), ("grants", grants))
        }
        return (
            feed.read_pages(self.spark, landed["contracts"], feed.CONTRACT_PAGE),
            feed.read_pages(self.spark, landed["grants"], feed.GRANT_PAGE),
        )
