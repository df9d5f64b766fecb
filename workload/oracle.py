"""The queries' oracle: the same results as plain SQL, written without the library.

The SQL starts from the same derived rows as the queries and computes every operator
its own way: row numbers and joins instead of the library's aggregations.
"""

from __future__ import annotations

from anchorline import vocabulary as V
from workload import tables as T

START, TODAY = f"DATE '{T.START}'", f"DATE '{T.TODAY}'"
TABLE_NAMES = "region nation customer supplier orders lineitem events documents pages".split()


def derived(sql: str) -> str:
    return sql.format(**{n: n for n in TABLE_NAMES})


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def match(column: str, pattern: str) -> str:
    return f"regexp_matches({column}, '{pattern}', 'i')"


def termination(c: str = "description") -> str:
    return match(c, V.TERMINATION_PATTERN)


def cause(c: str = "description") -> str:
    return match(c, V.CAUSE_PATTERN)


def descope(c: str = "description") -> str:
    return match(c, V.DESCOPE_PATTERN)


def reversal(c: str = "description") -> str:
    return f"({match(c, V.REVERSAL_PATTERN)} AND {match(c, V.SUBJECT_PATTERN)})"


def vacatur(c: str = "description") -> str:
    return (
        f"({match(c, V.VACATUR_PATTERN)} OR "
        f"({match(c, V.SET_ASIDE_PATTERN)} AND {match(c, V.SUBJECT_PATTERN)}))"
    )


CODED = "(award_type IN ('contract', 'idv') AND upper(action_type) IN ('F', 'N'))"
STANDALONE = "(award_type IN ('contract', 'idv') AND upper(action_type) = 'F')"


def explicit(start: str) -> str:
    return (
        f"(coalesce(action_date >= {start}, false) AND NOT {cause()} "
        f"AND ({STANDALONE} OR {termination()}))"
    )


def candidate() -> str:
    return (
        f"((coalesce(is_fpds, false) AND upper(trim(action_type)) IN ('F', 'N')) "
        f"OR {termination()} OR {cause()})"
    )


DETECTED = (
    f"CASE WHEN {CODED} AND {termination()} THEN 'both' WHEN {CODED} THEN 'action_code' "
    "ELSE 'description' END"
)
RANK = f"CASE WHEN {CODED} THEN 2 WHEN {descope()} THEN 0 ELSE 1 END"
PHRASE_HIT = "(" + " OR ".join(f"contains(lower(description), '{p}')" for p in V.SWEEP_PHRASES) + ")"


def award_type(code: str, generated: str, fpds: str) -> str:
    return (
        f"CASE WHEN starts_with(upper(trim(coalesce({code}, ''))), 'IDV_') "
        f"OR starts_with(upper(trim(coalesce({generated}, ''))), 'CONT_IDV_') THEN 'idv' "
        f"WHEN coalesce({fpds}, false) THEN 'contract' ELSE 'grant' END"
    )


NATIVE = "coalesce(piid, fain, uri)"


def mod_key(c: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(coalesce({c}, ''), '[0-9]+|[^0-9]+'), "
        "lambda x: CASE WHEN regexp_matches(x, '^[0-9]') AND length(x) < 8 "
        "THEN lpad(x, 8, '0') ELSE x END), '')"
    )


# --- common tables ----------------------------------------------------------------

RAW = f"raw AS ({derived(T.EVENTS_LEDGER)})"
RAW_ROLLUP = f"raw_rollup AS ({derived(T.EVENTS_ROLLUP)})"
RAW_LINES = f"raw AS ({derived(T.LINES_LEDGER)})"
RAW_LINES_ROLLUP = f"raw_rollup AS ({derived(T.LINES_ROLLUP)})"


def scan(start: str) -> str:
    return f"""scan AS (
        SELECT award_id, {NATIVE} AS native_award_id, generated_unique_award_id,
            transaction_unique_id AS sort_key, is_fpds, type AS award_type_code, action_date,
            coalesce(action_type, '') AS action_type,
            coalesce(modification_number, '') AS modification_number,
            coalesce(transaction_description, '') AS description,
            federal_action_obligation AS amount, recipient_name, ingest_seq
        FROM raw WHERE awarding_agency_id = 862 AND action_date >= {start})"""


TXN = f"""txn AS (
    SELECT award_id AS internal_award_id, is_fpds,
        CASE WHEN trim(coalesce(generated_unique_award_id, '')) <> ''
            THEN trim(generated_unique_award_id)
            ELSE 'PIID:' || trim(coalesce(native_award_id, '')) END AS award_key,
        trim(coalesce(native_award_id, '')) AS award_id,
        trim(coalesce(generated_unique_award_id, '')) AS generated_award_id,
        {award_type("award_type_code", "generated_unique_award_id", "is_fpds")} AS award_type,
        coalesce(recipient_name, '') AS recipient_name, action_date,
        upper(trim(action_type)) AS action_type, modification_number, description,
        upper(trim(coalesce(award_type_code, ''))) AS award_type_code, amount,
        'mirror' AS source, sort_key, ingest_seq
    FROM scan)"""


def adjudicate(source: str, out: str, start: str, order: str = "sort_key, ingest_seq") -> list[str]:
    """The verdict by row number: last reset, survivors, strongest earliest."""
    p = out
    return [
        f"""{p}_flags AS (SELECT *, ({reversal()} OR {vacatur()}) AS is_reset,
            {explicit(start)} AS is_signal, {RANK} AS strength,
            row_number() OVER (PARTITION BY award_key
                ORDER BY action_date NULLS FIRST, {order}) AS place FROM {source})""",
        f"{p}_reset AS (SELECT award_key, max(place) AS last FROM {p}_flags WHERE is_reset GROUP BY 1)",
        f"""{p} AS (SELECT f.* EXCLUDE (is_reset, is_signal, strength, place)
            FROM {p}_flags f LEFT JOIN {p}_reset r ON f.award_key = r.award_key
            WHERE is_signal AND NOT is_reset AND (r.last IS NULL OR place > r.last)
            QUALIFY row_number() OVER (PARTITION BY f.award_key ORDER BY strength DESC, place) = 1)""",
    ]


CANDIDATE_TXN = f"""history AS (SELECT * FROM txn WHERE internal_award_id IN
    (SELECT internal_award_id FROM txn WHERE {candidate()}))"""

FACTS = """facts AS (
    SELECT award_id AS fact_id, coalesce(description, '') AS award_description,
        coalesce(recipient_location_address_line1, '') AS recipient_address1,
        coalesce(recipient_location_address_line2, '') AS recipient_address2,
        coalesce(recipient_location_city_name, '') AS recipient_city,
        coalesce(recipient_location_state_code, '') AS recipient_state,
        coalesce(recipient_location_zip5, '') AS recipient_zip,
        coalesce(recipient_location_congressional_code_current,
            recipient_location_congressional_code, '') AS recipient_district,
        coalesce(pop_city_name, '') AS pop_city, coalesce(pop_state_code, '') AS pop_state,
        coalesce(pop_zip5, '') AS pop_zip,
        coalesce(pop_congressional_code_current, pop_congressional_code, '') AS pop_district,
        total_obligation AS total_obligated, base_and_all_options_value AS total_potential_value
    FROM raw_rollup)"""
FACT_COLUMNS = """recipient_address1 recipient_address2 recipient_city recipient_state recipient_zip
    recipient_district pop_city pop_state pop_zip pop_district""".split()


#: The same with the districts as reported, for the doors that publish those.
REPORTED = """reported AS (
    SELECT f.* REPLACE (coalesce(r.recipient_location_congressional_code, '') AS recipient_district,
        coalesce(r.pop_congressional_code, '') AS pop_district)
    FROM facts f JOIN raw_rollup r ON r.award_id = f.fact_id)"""


def fact_cells(prefix: str = "f") -> str:
    texts = ["award_description", *FACT_COLUMNS]
    return ", ".join(f"coalesce({prefix}.{c}, '') AS {c}" for c in texts) + (
        f", {prefix}.total_obligated, {prefix}.total_potential_value"
    )


def published(source: str, out: str, join: str, type_code: str = "a.award_type_code") -> str:
    return f"""{out} AS (
        SELECT a.award_key, a.award_id, a.generated_award_id, a.award_type,
            {type_code} AS award_type_code,
            a.recipient_name, a.action_date, a.action_type, a.modification_number,
            a.amount AS transaction_amount, a.description AS transaction_description,
            {fact_cells()},
            CASE WHEN {CODED.replace("award_type", "a.award_type")} AND {termination()} THEN 'both'
                WHEN {CODED.replace("award_type", "a.award_type")} THEN 'action_code'
                ELSE 'description' END AS detected_by,
            a.source AS sources, '' AS override_status
        FROM {source} a {join})"""


def depth_ctes(start: str = START) -> list[str]:
    return [
        scan(start), TXN, CANDIDATE_TXN, *adjudicate("history", "accepted", start), FACTS,
        published("accepted", "depth", "LEFT JOIN facts f ON f.fact_id = a.internal_award_id"),
    ]


# --- the recency door -------------------------------------------------------------

SWEEP_TXN = f"""stxn AS (
    SELECT CASE WHEN trim(coalesce(generated_unique_award_id, '')) <> ''
            THEN trim(generated_unique_award_id)
            ELSE 'PIID:' || trim(coalesce({NATIVE}, '')) END AS award_key,
        trim(coalesce({NATIVE}, '')) AS award_id,
        trim(coalesce(generated_unique_award_id, '')) AS generated_award_id,
        CASE WHEN starts_with(trim(coalesce(generated_unique_award_id, '')), 'CONT_IDV_') THEN 'idv'
            WHEN lower(trim(coalesce(type, ''))) IN ('02', '03', '04', '05') THEN 'grant'
            WHEN trim(coalesce(type, '')) <> '' THEN 'contract'
            WHEN is_fpds THEN 'contract' ELSE 'grant' END AS award_type,
        coalesce(recipient_name, '') AS recipient_name, action_date,
        upper(trim(coalesce(action_type, ''))) AS action_type,
        coalesce(modification_number, '') AS modification_number,
        coalesce(transaction_description, '') AS description,
        federal_action_obligation AS amount, 'api' AS source,
        {mod_key("modification_number")} AS sort_key,
        CASE WHEN is_fpds THEN 0 ELSE 1 END AS arm, ingest_seq, is_fpds AS is_procurement
    FROM raw WHERE awarding_agency_id = 862)"""
CODE_SINCE = f"greatest({START}, CAST({TODAY} - {T.LOOKBACK_DAYS} AS DATE))"
KEYWORD_ROWS = f"""SELECT *, 0 AS arrival FROM stxn
    WHERE action_date BETWEEN {START} AND {TODAY} AND {PHRASE_HIT}"""
CODE_ROWS = f"""SELECT *, 1 AS arrival FROM stxn
    WHERE action_date BETWEEN {CODE_SINCE} AND {TODAY} AND is_procurement AND {CODED}"""
SWEPT = f"swept AS ({KEYWORD_ROWS} UNION ALL {CODE_ROWS})"
ARRIVAL = "sort_key, arrival, arm, ingest_seq"


def rejudge_ctes() -> list[str]:
    return [
        SWEEP_TXN, SWEPT, *adjudicate("swept", "anchors", START, ARRIVAL),
        "filed AS (SELECT award_id, max(award_key) AS k FROM anchors WHERE award_id <> '' GROUP BY 1)",
        f"""again AS (
            SELECT * FROM swept WHERE award_key IN (SELECT award_key FROM anchors)
            UNION ALL
            SELECT s.* REPLACE (f.k AS award_key), 2 AS arrival FROM stxn s JOIN filed f
                ON s.award_id = f.award_id
            WHERE s.action_date BETWEEN
                greatest({START}, (SELECT min(action_date) FROM anchors)) AND {TODAY})""",
        *adjudicate("again", "rejudged", START, ARRIVAL),
    ]


def two_key_ctes() -> list[str]:
    return [
        FACTS,
        REPORTED,
        f"""found AS (
            SELECT trim(coalesce({NATIVE}, '')) AS native,
                coalesce(generated_unique_award_id, '') AS generated,
                {award_type("type", "generated_unique_award_id", "is_fpds")} AS kind,
                upper(trim(coalesce(type, ''))) AS award_type_code, f.*
            FROM raw_rollup r JOIN reported f ON f.fact_id = r.award_id
            WHERE awarding_agency_id = 862)""",
        """asked AS (SELECT found.*,
                CASE kind WHEN 'contract' THEN 0 WHEN 'idv' THEN 1 ELSE 2 END AS turn
            FROM found WHERE EXISTS (SELECT 1 FROM rejudged j
                WHERE j.award_id = native AND j.award_id <> '' AND j.award_type = kind))""",
        """filing AS (SELECT generated AS id, * FROM asked WHERE generated <> ''
            UNION ALL SELECT native AS id, * FROM asked WHERE native <> '')""",
        """details AS (SELECT * FROM filing
            QUALIFY row_number() OVER (PARTITION BY id ORDER BY turn DESC, native DESC, fact_id DESC) = 1)""",
        """chosen AS (SELECT j.award_key AS for_key, d.* FROM rejudged j JOIN details d
            ON d.id = CASE WHEN EXISTS (SELECT 1 FROM details x WHERE x.id = j.generated_award_id)
                THEN j.generated_award_id ELSE j.award_id END)""",
    ]


def recency_ctes() -> list[str]:
    return [
        *rejudge_ctes(), *two_key_ctes(),
        published(
            "rejudged", "recency", "LEFT JOIN chosen f ON f.for_key = a.award_key",
            "coalesce(f.award_type_code, '')",
        ),
    ]


# --- merge and rulings ------------------------------------------------------------

COLUMNS = """award_key award_id generated_award_id award_type award_type_code recipient_name
    action_date action_type modification_number transaction_amount transaction_description
    award_description recipient_address1 recipient_address2 recipient_city recipient_state
    recipient_zip recipient_district pop_city pop_state pop_zip pop_district total_obligated
    total_potential_value detected_by sources override_status""".split()
UNITE = "array_to_string(list_sort(list_distinct(list_filter(string_split({x}, ';'), lambda p: p <> ''))), ';')"


def merged_ctes() -> list[str]:
    both = UNITE.format(x="r.sources || ';' || d.sources")
    from_depth = ", ".join(f"d.{c}" for c in COLUMNS if c not in ("sources", "override_status"))
    from_recency = ", ".join(f"r.{c}" for c in COLUMNS)
    place = "row_number() OVER (ORDER BY {0}.action_date DESC NULLS LAST, {0}.award_key)"
    return [
        f"recency_at AS (SELECT r.*, {place.format('r')} AS seat FROM recency r)",
        f"depth_at AS (SELECT d.*, 1000000000000 + {place.format('d')} AS seat FROM depth d)",
        f"""merged AS (
            SELECT {from_depth},
                CASE WHEN r.award_key IS NULL THEN d.sources ELSE {both} END AS sources,
                d.override_status, coalesce(r.seat, d.seat) AS seat
            FROM depth_at d LEFT JOIN recency_at r ON r.award_key = d.award_key
            UNION ALL
            SELECT {from_recency}, r.seat FROM recency_at r
            WHERE r.award_key NOT IN (SELECT award_key FROM depth))""",
    ]


def collapsed_ctes() -> list[str]:
    is_fallback = "starts_with(award_key, 'PIID:')"
    has_depth = "list_contains(string_split(sources, ';'), 'mirror')"
    kept = ("award_key", "generated_award_id", "sources")
    cells = ", ".join(
        f"g.{c}" if c in kept[:2] else f"CASE WHEN takes THEN b.{c} ELSE g.{c} END AS {c}"
        for c in COLUMNS
        if c != "sources"
    )
    return [
        f"""targets AS (SELECT award_id, award_type, award_key AS target FROM merged
            WHERE NOT {is_fallback}
            QUALIFY row_number() OVER (PARTITION BY award_id, award_type ORDER BY seat DESC) = 1)""",
        f"""folds AS (SELECT m.*, t.target, {has_depth} AS has_depth FROM merged m
            JOIN targets t ON m.award_id = t.award_id AND m.award_type = t.award_type
            WHERE {is_fallback.replace("award_key", "m.award_key")})""",
        """fold_sources AS (SELECT target, string_agg(sources, ';') AS more,
            bool_or(has_depth) AS any_depth FROM folds GROUP BY 1)""",
        """fold_best AS (SELECT * FROM folds WHERE has_depth
            QUALIFY row_number() OVER (PARTITION BY target ORDER BY seat) = 1)""",
        f"""absorbed AS (
            SELECT g.*, s.more,
                coalesce(s.any_depth, false) AND NOT {has_depth.replace("sources", "g.sources")} AS takes
            FROM merged g LEFT JOIN fold_sources s ON s.target = g.award_key
            WHERE NOT {is_fallback.replace("award_key", "g.award_key")})""",
        f"""collapsed AS (
            SELECT {cells}, CASE WHEN g.more IS NULL THEN g.sources
                ELSE {UNITE.format(x="g.sources || ';' || g.more")} END AS sources
            FROM absorbed g LEFT JOIN fold_best b ON b.target = g.award_key
            UNION ALL BY NAME
            SELECT {", ".join(COLUMNS)} FROM merged
            WHERE {is_fallback} AND award_key NOT IN (SELECT award_key FROM folds))""",
    ]


OVERRIDES = [
    f"raw_overrides AS ({derived(T.RAW_OVERRIDES)})",
    """overrides AS (SELECT trim(award_ref) AS override_id, trim(status) AS status
        FROM raw_overrides WHERE trim(award_ref) <> ''
        QUALIFY row_number() OVER (PARTITION BY trim(award_ref) ORDER BY position DESC) = 1)""",
]


def ruled_ctes(source: str, out: str = "ruled") -> list[str]:
    cells = ", ".join(f"p.{c}" for c in COLUMNS if c != "override_status")
    return [
        f"""{out}_status AS (SELECT p.*, CASE WHEN i.override_id IS NOT NULL THEN i.status
                WHEN k.override_id IS NOT NULL THEN k.status ELSE '' END AS ruling
            FROM {source} p LEFT JOIN overrides i ON i.override_id = p.award_id
            LEFT JOIN overrides k ON k.override_id = p.award_key)""",
        f"""{out} AS (SELECT {cells},
                CASE WHEN ruling <> '' THEN ruling ELSE p.override_status END AS override_status
            FROM {out}_status p
            WHERE ruling NOT IN ('excluded_by_design', 'vacated', 'continued'))""",
    ]


DESCOPED = (
    "CASE WHEN override_status = 'descoped' THEN true WHEN override_status <> '' THEN false "
    f"ELSE {descope('transaction_description')} AND NOT {STANDALONE} END"
)

# --- claims -----------------------------------------------------------------------

CLAIM_ITEMS = f"items AS ({derived(T.CLAIM_ITEMS)})"


def iso_date(c: str) -> str:
    head = f"substring(trim({c}), 1, 10)"
    return (
        f"CASE WHEN regexp_matches({head}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') "
        f"THEN CAST(try_strptime({head}, '%Y-%m-%d') AS DATE) "
        f"WHEN regexp_matches({head}, '^[0-9]{{8}}$') "
        f"THEN CAST(try_strptime({head}, '%Y%m%d') AS DATE) "
        f"WHEN regexp_matches({head}, '^[0-9]{{4}}-W[0-9]{{2}}-[1-7]$') "
        f"THEN CAST(try_strptime({head}, '%G-W%V-%u') AS DATE) END"
    )


def claim_date(c: str) -> str:
    day, month = "(3[01]|[12][0-9]|0?[1-9])", "(1[0-2]|0?[1-9])"
    forms = [
        (f"^{month}/{day}/[0-9]{{4}}$", "%m/%d/%Y"),
        (f"^{month}/{day}/[0-9]{{2}}$", "%m/%d/%y"),
        (f"^{day}-[A-Za-z]{{3}}-[0-9]{{4}}$", "%d-%b-%Y"),
    ]
    arms = ", ".join(
        f"CASE WHEN regexp_matches(replace(trim({c}), '/ ', '/'), '{shape}') "
        f"THEN CAST(try_strptime(replace(trim({c}), '/ ', '/'), '{form}') AS DATE) END"
        for shape, form in forms
    )
    return f"coalesce({iso_date(c)}, {arms})"


def money(c: str) -> str:
    return (
        f"TRY_CAST(nullif(replace(replace(trim({c}), '$', ''), ',', ''), '') AS DECIMAL(23, 2))"
    )


def param_id(c: str) -> str:
    raw = (
        f"regexp_extract(regexp_extract(coalesce({c}, ''), '^[^?#]*[?]([^#]*)', 1), "
        "'(^|&)PIID=([^&]+)', 2)"
    )
    # Every percent sign escaped, then those of good escapes taken back.
    escaped = f"replace({raw}, '%', '%25')"
    return f"url_decode(regexp_replace({escaped}, '%25([0-9A-Fa-f]{{2}})', '%\\1', 'g'))"


def path_id(c: str) -> str:
    bare = f"split_part(split_part(coalesce({c}, ''), '#', 1), '?', 1)"
    path = f"regexp_replace(regexp_replace({bare}, '^[a-z]+://[^/]*', ''), ';[^/]*$', '')"
    last = f"coalesce(list_last(list_filter(string_split({path}, '/'), lambda s: s <> '')), '')"
    shape = V.COMPOSITE_ID_PATTERN
    return (
        f"CASE WHEN regexp_matches({last}, '{shape}') "
        f"THEN regexp_extract({last}, '{shape}', 1) ELSE {last} END"
    )


CLAIMS = f"""claims AS (
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'grant' ELSE 'contract' END AS claim_type,
        CASE WHEN o_orderstatus = 'F' THEN {path_id("link")} ELSE {param_id("link")} END AS doge_award_id,
        trim(party) AS recipient, {money("value_text")} AS doge_value,
        CAST(o_orderkey AS DECIMAL(23, 2)) AS doge_savings, {claim_date("date_text")} AS doge_claim_date,
        CASE WHEN o_orderstatus = 'F' THEN '' ELSE trim(coalesce(status_text, '')) END AS doge_status,
        trim(coalesce(link, '')) AS source_url
    FROM items WHERE lower(trim(coalesce(agency, ''))) IN
        ('nasa', 'national aeronautics and space administration'))"""

AWARD_FACTS = """award_facts AS (
    SELECT r.award_id AS internal_award_id, coalesce(piid, fain, uri) AS native,
        coalesce(generated_unique_award_id, '') AS generated_award_id,
        CASE WHEN category IN ('grant', 'idv', 'contract') THEN category ELSE '' END AS award_type,
        upper(trim(coalesce(type, ''))) AS award_type_code,
        period_of_performance_current_end_date AS current_end_date, f.* EXCLUDE (fact_id)
    FROM raw_rollup r JOIN reported f ON f.fact_id = r.award_id
    WHERE coalesce(piid, fain, uri) <> ''
    QUALIFY row_number() OVER (PARTITION BY coalesce(piid, fain, uri) ORDER BY r.award_id DESC) = 1)"""

CLAIM_FACTS = f"""claim_rows AS (
    SELECT a.internal_award_id, a.award_type, action_date, coalesce(action_type, '') AS raw_code,
        upper(trim(coalesce(action_type, ''))) AS action_type,
        coalesce(modification_number, '') AS modification_number,
        coalesce(transaction_description, '') AS description, ingest_seq
    FROM raw JOIN award_facts a ON a.internal_award_id = raw.award_id
    WHERE a.native IN (SELECT doge_award_id FROM claims)),
claim_last AS (SELECT * FROM claim_rows QUALIFY row_number() OVER (PARTITION BY internal_award_id
    ORDER BY action_date DESC NULLS LAST, modification_number DESC, ingest_seq) = 1),
claim_facts AS (
    SELECT g.*, l.action_date AS latest_action_date, l.raw_code AS latest_action_type,
        l.description AS latest_description
    FROM (SELECT internal_award_id, bool_or({explicit(START)}) AS has_explicit_termination,
            bool_or({vacatur()}) AS termination_vacated FROM claim_rows GROUP BY 1) g
    JOIN claim_last l USING (internal_award_id))"""

CLAIM_COLUMNS = f"""claim_type doge_award_id recipient doge_value doge_savings doge_claim_date
    doge_status source_url usaspending_found generated_award_id award_type award_type_code
    has_explicit_termination termination_vacated latest_action_date latest_action_type
    latest_description current_obligation current_end_date {" ".join(FACT_COLUMNS)}
    total_potential_value checked_date""".split()


def enriched(source: str, out: str) -> str:
    texts = ", ".join(f"coalesce(a.{c}, '') AS {c}" for c in FACT_COLUMNS)
    return f"""{out} AS (
        SELECT c.o_orderkey, c.claim_type, c.doge_award_id, c.recipient, c.doge_value, c.doge_savings,
            c.doge_claim_date, c.doge_status, c.source_url,
            a.internal_award_id IS NOT NULL AS usaspending_found,
            coalesce(a.generated_award_id, '') AS generated_award_id,
            coalesce(a.award_type, '') AS award_type, coalesce(a.award_type_code, '') AS award_type_code,
            coalesce(t.has_explicit_termination, false) AS has_explicit_termination,
            coalesce(t.termination_vacated, false) AS termination_vacated,
            t.latest_action_date, coalesce(t.latest_action_type, '') AS latest_action_type,
            coalesce(t.latest_description, '') AS latest_description,
            a.total_obligated AS current_obligation, a.current_end_date, {texts},
            a.total_potential_value, {TODAY} AS checked_date
        FROM {source} c LEFT JOIN award_facts a ON a.native = c.doge_award_id AND c.doge_award_id <> ''
        LEFT JOIN claim_facts t ON t.internal_award_id = a.internal_award_id)"""


CLAIM_BASE = [RAW, RAW_ROLLUP, CLAIM_ITEMS, CLAIMS, FACTS, REPORTED, AWARD_FACTS, CLAIM_FACTS]
SETTLED = (
    f"(usaspending_found AND ((has_explicit_termination AND NOT termination_vacated) "
    f"OR coalesce(current_end_date < {TODAY}, false)))"
)
#: The previous run's rows: claims dated before 2000, checked on spread-out days.
EXISTING = f"""existing AS (
    SELECT * REPLACE (CAST({TODAY} - CAST(o_orderkey % 40 AS INT) AS DATE) AS checked_date,
        'as checked before' AS latest_description)
    FROM enriched WHERE doge_claim_date < DATE '2000-01-01')"""
