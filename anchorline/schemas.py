"""Declared schemas. Field order is column order in every published table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(23, 2)

_TYPES = {
    "str": T.StringType(),
    "date": T.DateType(),
    "money": MONEY,
    "bool": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
}


def _schema(spec: str) -> T.StructType:
    """`name:type` words into a StructType; a bare word is text."""
    fields = []
    for word in spec.split():
        name, _, kind = word.partition(":")
        fields.append(T.StructField(name, _TYPES[kind or "str"], True))
    return T.StructType(fields)


_PLACES = """
    recipient_address1 recipient_address2 recipient_city recipient_state recipient_zip
    recipient_district pop_city pop_state pop_zip pop_district
"""

#: Raw transaction ledger, one row per award action.
LEDGER = _schema("""
    award_id:long piid fain uri generated_unique_award_id transaction_unique_id is_fpds:bool
    type action_date:date action_type modification_number transaction_description
    federal_action_obligation:money recipient_name awarding_agency_id:int
    period_of_performance_current_end_date:date ordering_period_end_date ingest_seq:long
""")

#: Raw award rollup, one row per award_id.
ROLLUP = _schema("""
    award_id:long piid fain uri generated_unique_award_id is_fpds:bool type category
    awarding_agency_id:int description
    recipient_location_address_line1 recipient_location_address_line2
    recipient_location_city_name recipient_location_state_code recipient_location_zip5
    recipient_location_congressional_code_current recipient_location_congressional_code
    pop_city_name pop_state_code pop_zip5 pop_congressional_code_current
    pop_congressional_code total_obligation:money base_and_all_options_value:money
    period_of_performance_current_end_date:date
""")

LOCATION = _schema("address1 address2 city state zip district")

#: One award action, whichever source it came from.
TXN = T.StructType(
    _schema("""
        award_key award_id generated_award_id award_type recipient_name action_date:date
        action_type modification_number description award_description
    """).fields
    + [
        T.StructField("recipient_location", LOCATION, True),
        T.StructField("pop_location", LOCATION, True),
    ]
    + _schema("""
        award_type_code total_obligated:money total_potential_value:money amount:money
        source sort_key ingest_seq:long
    """).fields
)

TERMINATION = _schema(f"""
    award_key award_id generated_award_id award_type award_type_code recipient_name
    action_date:date action_type modification_number transaction_amount:money
    transaction_description award_description {_PLACES}
    total_obligated:money total_potential_value:money detected_by sources override_status
""")

CLAIM = _schema(f"""
    claim_type doge_award_id recipient doge_value:money doge_savings:money
    doge_claim_date:date doge_status source_url usaspending_found:bool generated_award_id
    award_type award_type_code has_explicit_termination:bool termination_vacated:bool
    latest_action_date:date latest_action_type latest_description current_obligation:money
    current_end_date:date {_PLACES} total_potential_value:money checked_date:date
""")

PULLBACK = _schema(f"""
    award_id generated_award_id award_type award_type_code recipient_name award_description
    {_PLACES} total_obligated:money total_potential_value:money original_end_date:date
    max_end_date:date current_end_date:date days_shortened:int last_action_date:date
    transaction_count:long
""")

FISCAL_YEAR = _schema("fiscal_year:int terminated_awards:long")

PLACE_COLUMNS = _PLACES.split()


def empty_value(field: T.StructField) -> Column:
    """A missing cell: blank text, false, else null."""
    if isinstance(field.dataType, T.StringType):
        return F.lit("")
    if isinstance(field.dataType, T.BooleanType):
        return F.lit(False)
    return F.lit(None).cast(field.dataType)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` as exactly this schema: its columns in order, missing ones as empty cells."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in present else empty_value(f)).alias(f.name)
            for f in schema.fields
        ]
    )
