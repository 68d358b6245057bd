"""Header expressions over the head of a raw message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from letterloom.functions.text import constant_list

# The header names that are read, and those that must be present.
READ_HEADERS = ("message-id", "date", "from", "to", "cc", "bcc", "subject")
REQUIRED_HEADERS = ("to", "from", "subject")

HEADER_LINE = r"(?s)^([!-9;-~]+):[ \t]*(.*)$"
READ_HEADER_LINE = rf"(?is)^({'|'.join(READ_HEADERS)}):[ \t]*(.*)$"

# Reply and forward marks in subjects, matched anywhere and in
# any case.
SUBJECT_MARKS = r"([\[\(] *)?(RE?S?|FYI|RIF|I|FS|VB|RV|ENC|ODP|PD|YNT|ILT|SV|VS|VL|AW|WG|ΑΠ|ΣΧΕΤ|ΠΡΘ|תגובה|הועבר|主题|转发|FWD?) *([-:;)\]][ :;\])-]*|$)|\]+ *$"  # noqa: E501

# The same matches in linear time: closing brackets are read from the first of a run only, and once.
LINEAR_MARKS = SUBJECT_MARKS.replace(r"|\]+ *$", r"|(?<!\])\]++ *+$")


def split_message(text: Column) -> Column:
    """[head, rest]: cut at the first blank line."""
    return F.split(text, r"^\r?\n|\r?\n\r?\n", 2)


def unfold(head: Column) -> Column:
    """Join continuation lines to the line they continue."""
    return F.regexp_replace(head, r"\r?\n[ \t]+", " ")


def _header_structs(head: Column, pattern: str) -> Column:
    lines = F.filter(F.split(unfold(head), r"\r?\n"), lambda line: line.rlike(pattern))
    return F.transform(
        lines,
        lambda line, pos: F.struct(
            pos.cast("long").alias("pos"),
            F.regexp_extract(line, pattern, 1).alias("name"),
            F.regexp_extract(line, pattern, 2).alias("value"),
        ),
    )


def all_headers(head: Column) -> Column:
    """array<struct<pos, name, value>> of every header, in order, undecoded."""
    return _header_structs(head, HEADER_LINE)


def read_headers(head: Column) -> Column:
    """The same for the seven headers that are read; other lines cost one match."""
    return _header_structs(head, READ_HEADER_LINE)


def header_value(headers: Column, name: str) -> Column:
    """Value of the last header of that name, null when there is none."""
    hits = F.filter(headers, lambda h: F.lower(h["name"]) == name)
    return F.try_element_at(hits, F.lit(-1))["value"]


def header_values(headers: Column) -> Column:
    """The last value of each header that is read, in the order of the names."""
    return F.transform(
        constant_list(READ_HEADERS),
        lambda name: F.try_element_at(F.filter(headers, lambda h: F.lower(h["name"]) == name), F.lit(-1))["value"],
    )


def has_required(headers: Column) -> Column:
    """Whether every required header is present; an empty value counts."""
    names = F.transform(headers, lambda h: F.lower(h["name"]))
    return F.size(F.array_intersect(constant_list(REQUIRED_HEADERS), names)) == len(REQUIRED_HEADERS)


def clean_subject(subject: Column, anchored: bool = False) -> Column:
    """Drop reply and forward marks; a missing subject is empty.

    Marks match anywhere in the subject. ``anchored`` limits them to its start.
    """
    subject = F.coalesce(subject, F.lit(""))
    if anchored:
        return F.regexp_replace(subject, rf"(?iu)^(?:(?:{LINEAR_MARKS}) *)++", "")
    return F.regexp_replace(subject, f"(?iu){LINEAR_MARKS}", "")


def message_id(header: Column, value: Column) -> Column:
    """The id without its brackets or quotes; a missing id is made from the bytes."""
    given = F.nullif(F.btrim(header), F.lit(""))
    name = F.coalesce(given, F.concat(F.lit("gen-"), F.sha2(value.cast("binary"), 256)))
    return F.regexp_replace(name, r'(?s)^<(.*)>$|^"(.*)"$', "$1$2")
