"""A day of messages to sparse features in two halves."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterloom.operators.bow import lemma_vectors, lemma_vectors_in_row, long_texts
from letterloom.operators.lookup import Lookup
from letterloom.operators.ranking import half_split
from letterloom.operators.tokens import add_lemmas, explode_token_counts
from letterloom.plans.messages import ROW_KEY

FIELDS = ("subject", "body")


def number_rows(messages: DataFrame, key: str = "message_id", fields: Sequence[str] = FIELDS) -> DataFrame:
    """(row_id, row_key, key, fields): stored rows named by where they came from, the same in every run.

    Message ids can repeat, so rows are counted by ``row_id`` and put in order by ``row_key``, the message
    id followed by the position.
    """
    place = [F.lpad(F.hex(F.col(name).cast("long")), 16, "0") for name in ("partition", "offset")]
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return messages.select(
        F.concat_ws("/", *ROW_KEY).alias("row_id"),
        F.concat_ws("\0", name, "topic", *place).alias("row_key"),
        key,
        *fields,
    )


def daily_features(
    messages: DataFrame,
    vocabulary: Lookup,
    lemmas: Lookup,
    day: dt.date,
    key: str = "message_id",
    fields: Sequence[str] = FIELDS,
    unique: bool = False,
) -> DataFrame:
    """(row_id, key, matrix_date, field, split, indices, values), one row per text.

    ``messages`` holds each row's topic, partition and offset, its position in the source, which becomes
    the row id. ``unique`` says that no two rows share a key; the key is then the row id.
    """
    if unique:
        rows = half_split(messages.select(F.col(key).alias("row_id"), key, *fields), "row_id")
    else:
        rows = half_split(number_rows(messages, key, fields), "row_key")
    row = ("row_id", key, "split")
    if lemmas.fits and vocabulary.fits:
        vectors = lemma_vectors_in_row(long_texts(rows, row, fields), row, lemmas, vocabulary)
    else:
        vectors = lemma_vectors(add_lemmas(explode_token_counts(rows, row, fields), lemmas), row, vocabulary)
    return vectors.select(
        "row_id", key, F.lit(day).alias("matrix_date"), "field", "split", "indices", "values"
    )
