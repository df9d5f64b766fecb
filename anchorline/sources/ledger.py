"""The raw ledger and award rollup, and their normalisation into award actions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorline import vocabulary as V
from anchorline.functions import scalars as S
from anchorline.schemas import LEDGER, MONEY, ROLLUP, TXN, conform


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """A ledger kept as Parquet, best as `write_ledger` lays it out; then `action_year` is read too."""
    found = spark.read.schema(LEDGER).parquet(path)
    return found.withColumn("action_year", F.col("action_year").cast("int")) if (
        "action_year" in found.columns
    ) else found


def read_ledger_jdbc(
    spark: SparkSession, url: str, table: str, *, partitions: int, lower: int, upper: int, **options
) -> DataFrame:
    """A ledger kept in a database, read in `partitions` ranges of award_id."""
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", "award_id")
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .options(**options)
        .load()
    )


def write_ledger(df: DataFrame, path: str) -> None:
    """The ledger laid out for pruning: agency and action year as folders.

    The round-robin salt keeps a hot agency-year from becoming one task's file.
    """
    year = F.year("action_date")
    salt = F.pmod(F.xxhash64("transaction_unique_id", "ingest_seq"), F.lit(64))
    (
        df.withColumn("action_year", year)
        .repartition("awarding_agency_id", "action_year", salt)
        .sortWithinPartitions("awarding_agency_id", "action_year", "award_id")
        .write.partitionBy("awarding_agency_id", "action_year")
        .parquet(path)
    )


def since(
    ledger: DataFrame, start: date, agency_id: int, until: date | None = None
) -> DataFrame:
    """One agency's actions from `start` to `until`; of a ledger laid out by year, only those
    folders."""
    rows = ledger.where(
        (F.col("awarding_agency_id") == agency_id) & (F.col("action_date") >= F.lit(start))
    )
    if until is not None:
        rows = rows.where(F.col("action_date") <= F.lit(until))
    if "action_year" in ledger.columns:
        rows = rows.where(F.col("action_year") >= start.year)
        if until is not None:
            rows = rows.where(F.col("action_year") <= until.year)
    return rows


def ledger_scan(
    ledger: DataFrame,
    *,
    start: date,
    agency_id: int = V.AGENCY_ID,
) -> DataFrame:
    """One agency's actions since `start`, named as the rest of the package reads them."""
    return since(ledger, start, agency_id).select(
        "award_id",
        S.native_id("piid", "fain", "uri").alias("native_award_id"),
        "generated_unique_award_id",
        F.col("transaction_unique_id").alias("sort_key"),
        "is_fpds",
        F.col("type").alias("award_type_code"),
        "action_date",
        S.blank("action_type").alias("action_type"),
        S.blank("modification_number").alias("modification_number"),
        S.blank("transaction_description").alias("description"),
        F.col("federal_action_obligation").cast(MONEY).alias("amount"),
        "recipient_name",
        "ingest_seq",
    )


def rollup_facts(*, reported: bool = False) -> list[Column]:
    """The award-level columns every published table shares, nulls as blanks.

    The district is the current one, else the one reported at the time; with `reported`
    the latter alone.
    """

    def district(place: str) -> Column:
        given = [] if reported else [f"{place}_congressional_code_current"]
        return F.coalesce(*given, f"{place}_congressional_code", F.lit(""))

    place = "recipient_location_"
    return [
        S.blank("description").alias("award_description"),
        S.blank(place + "address_line1").alias("recipient_address1"),
        S.blank(place + "address_line2").alias("recipient_address2"),
        S.blank(place + "city_name").alias("recipient_city"),
        S.blank(place + "state_code").alias("recipient_state"),
        S.blank(place + "zip5").alias("recipient_zip"),
        district("recipient_location").alias("recipient_district"),
        S.blank("pop_city_name").alias("pop_city"),
        S.blank("pop_state_code").alias("pop_state"),
        S.blank("pop_zip5").alias("pop_zip"),
        district("pop").alias("pop_district"),
        F.col("total_obligation").cast(MONEY).alias("total_obligated"),
        F.col("base_and_all_options_value").cast(MONEY).alias("total_potential_value"),
    ]


def award_rollup(rollup: DataFrame) -> DataFrame:
    """The rollup's shared columns, one row per award."""
    return rollup.select("award_id", *rollup_facts())


def recipient_location() -> Column:
    """The flat recipient columns of a rollup row as a location struct."""
    p = "recipient_"
    return S.location(
        p + "city", p + "state", p + "zip", p + "district", p + "address1", p + "address2"
    )


def pop_location() -> Column:
    """The flat place-of-performance columns as a location struct."""
    return S.location("pop_city", "pop_state", "pop_zip", "pop_district")


def normalise_ledger(scan: DataFrame, *, source: str = V.DEPTH_SOURCE) -> DataFrame:
    """Rows of `ledger_scan` as award actions, ordered within a day by transaction id.

    The internal `award_id` stays beside the action as `internal_award_id`: rollups
    join on it, and one award key may span several of them.
    """
    cleaned = scan.withColumns(
        {
            "native_award_id": S.strip(S.blank("native_award_id")),
            "generated_award_id": S.strip(S.blank("generated_unique_award_id")),
            "award_type_code": S.code("award_type_code"),
        }
    )
    return cleaned.select(
        F.col("award_id").alias("internal_award_id"),
        "is_fpds",
        S.award_key("generated_award_id", "native_award_id").alias("award_key"),
        F.col("native_award_id").alias("award_id"),
        "generated_award_id",
        S.clean_award_type(
            "award_type_code", F.upper("generated_award_id"), "is_fpds"
        ).alias("award_type"),
        S.blank("recipient_name").alias("recipient_name"),
        "action_date",
        S.code("action_type").alias("action_type"),
        S.blank("modification_number").alias("modification_number"),
        S.blank("description").alias("description"),
        "award_type_code",
        F.col("amount").cast(MONEY).alias("amount"),
        F.lit(source).alias("source"),
        S.blank("sort_key").alias("sort_key"),
        "ingest_seq",
    )


def with_rollup(txn: DataFrame, rollup: DataFrame) -> DataFrame:
    """Actions with their award's current facts; an award the rollup lacks keeps blank cells."""
    facts = award_rollup(rollup).withColumnRenamed("award_id", "internal_award_id")
    joined = txn.join(facts, "internal_award_id", "left")
    return joined.select(
        *txn.columns,
        S.blank("award_description").alias("award_description"),
        recipient_location().alias("recipient_location"),
        pop_location().alias("pop_location"),
        "total_obligated",
        "total_potential_value",
    )


def as_txn(df: DataFrame) -> DataFrame:
    """Exactly the action schema; facts a source does not have stay empty."""
    places = {
        c: S.empty_location()
        for c in ("recipient_location", "pop_location")
        if c not in df.columns
    }
    return conform(df.withColumns(places) if places else df, TXN)


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROLLUP).parquet(path)
