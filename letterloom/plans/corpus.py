"""A folder of message files to messages, text export and features in one batch run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from letterloom.operators.entities import Gazetteer
from letterloom.operators.lookup import Lookup
from letterloom.options import MailOptions
from letterloom.plans.features import daily_features
from letterloom.plans.messages import ROW_KEY, accepted_messages, classify_messages, rejected_messages
from letterloom.schemas import MESSAGE_COLUMNS
from letterloom.sources.readers import read_mail_dir, read_messages
from letterloom.sources.writers import write_eml_text, write_features, write_messages


def run_corpus(
    spark: SparkSession,
    folder: str,
    out: str,
    vocabulary: Lookup,
    lemmas: Lookup,
    day: dt.date,
    options: MailOptions = MailOptions(strip_payload=False),
    gazetteer: Gazetteer | None = None,
    rejects: str | None = None,
) -> DataFrame:
    """Write ``messages``, ``eml`` and ``features`` below ``out``; return the messages.

    ``rejects`` names a folder for the messages left out, where they came from and why.
    """
    outcomes = classify_messages(read_mail_dir(spark, folder), options, gazetteer)
    if rejects:
        outcomes = outcomes.persist()  # both writes read it; a part that is lost is made again
        write_messages(rejected_messages(outcomes), rejects)
    write_messages(accepted_messages(outcomes, keep=ROW_KEY).select(*ROW_KEY, *MESSAGE_COLUMNS), f"{out}/messages")
    outcomes.unpersist()
    messages = read_messages(spark, f"{out}/messages")
    write_eml_text(messages, f"{out}/eml")
    write_features(daily_features(messages, vocabulary, lemmas, day), f"{out}/features")
    return messages
