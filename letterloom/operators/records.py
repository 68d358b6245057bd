"""Record shaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterloom.functions.addresses import join_addresses
from letterloom.functions.text import strip_blank
from letterloom.schemas import MESSAGE_COLUMNS

LISTS = ("to_addresses", "cc_addresses", "bcc_addresses")


def date_text(date: Column) -> Column:
    """An instant as text, empty when missing."""
    return F.coalesce(F.date_format(date, "yyyy-MM-dd HH:mm:ss"), F.lit(""))


def flat_record(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """All eight message columns as strings, address lists joined by ", "."""
    shaped = {name: F.col(name) for name in MESSAGE_COLUMNS}
    shaped["date"] = date_text(F.col("date"))
    shaped.update({name: join_addresses(F.col(name)) for name in LISTS})
    return df.select(*keep, *[column.cast("string").alias(name) for name, column in shaped.items()])


def render_message(df: DataFrame, name: str = "eml") -> DataFrame:
    """Add the message as text: seven headers, a blank line, the body."""

    def line(label: str, column: Column) -> Column:
        return F.concat(F.lit(f"{label}: "), F.coalesce(column, F.lit("")))

    return df.withColumn(
        name,
        strip_blank(
            F.concat_ws(
                "\n",
                line("Message-Id", F.col("message_id")),
                line("Date", date_text(F.col("date"))),
                line("From", F.col("from_address")),
                line("To", F.col("to_addresses")),
                line("Cc", F.col("cc_addresses")),
                line("Bcc", F.col("bcc_addresses")),
                line("Subject", F.col("subject")),
                F.lit(""),
                F.coalesce("body", F.lit("")),
            )
        ),
    )


def tidy(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which one of the columns is null or empty."""
    return df.replace("", None, list(columns)).na.drop("any", subset=list(columns))
