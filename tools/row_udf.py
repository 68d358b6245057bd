"""The comparison baseline: the message job as one row-at-a-time Python function.

This is the shape the job has when every message is parsed by a scalar UDF. It
keeps the same gates and fields with plain string handling; it exists to be
timed against the DataFrame plan.
"""

from __future__ import annotations

import re
import sys
from email import message_from_string
from email.policy import strict
from email.utils import getaddresses, mktime_tz, parsedate_tz
from html.parser import HTMLParser

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterloom.functions.headers import REQUIRED_HEADERS, SUBJECT_MARKS
from letterloom.options import FINAL_GATE, HEADER_HINT_PATTERN, PRE_GATE, SEPARATOR_PATTERN

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FIELDS = (
    "message_id string, date string, from_address string, to_addresses string, cc_addresses string, bcc_addresses string, "
    "subject string, body string"
)


BREAK = re.compile(rf"(?m)^.*(?:{SEPARATOR_PATTERN}|(?i:{HEADER_HINT_PATTERN}))")
QUOTED = re.compile(r"(?s)\n(?:>[^\n]*|On [^\n]* wrote:)(?:\n.*)?$")


def _shown(markup: str) -> str:
    texts: list[str] = []
    reader = HTMLParser()
    reader.handle_data = texts.append
    reader.feed(markup)
    return "".join(texts).strip()


def _body(message) -> str | None:
    """The text before the first break line, if its length passes both gates."""
    part = message.get_body()
    if part is None:
        return None
    text = BREAK.split("\n".join(part.get_content().splitlines()), maxsplit=1)[0].removesuffix("\n")
    if not PRE_GATE[0] <= len(text) <= PRE_GATE[1]:
        return None
    text = QUOTED.sub("", _shown(text) if part.get_content_subtype() == "html" else text)
    return text if FINAL_GATE[0] <= len(text) <= FINAL_GATE[1] else None


def parse(raw: str):
    try:
        message = message_from_string(raw.strip(), policy=strict)
        body = _body(message)
    except Exception:  # a defect: the message is left out
        return None
    head = {name.lower(): str(value) for name, value in message.raw_items()}
    if body is None or any(name not in head for name in REQUIRED_HEADERS):
        return None
    people = [", ".join(a for _, a in getaddresses([head.get(name, "")]) if "@" in a) for name in ("from", "to", "cc", "bcc")]
    when = parsedate_tz(head.get("date", ""))
    subject = re.sub(f"(?i){SUBJECT_MARKS}", "", head["subject"])
    return (head.get("message-id", ""), str(mktime_tz(when)) if when else None, *people, subject, body)


def parse_messages(raw: DataFrame) -> DataFrame:
    row = F.udf(parse, FIELDS, useArrow=False)
    return raw.select("offset", row(F.col("value").cast("string")).alias("m")).select("offset", "m.*")
