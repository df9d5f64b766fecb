"""Adjudication of award-action ledgers on Spark: DataFrame in, DataFrame out."""
