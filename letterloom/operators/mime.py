"""The one Python step: MIME decoding and encoded header words.

Both functions see only the rows that need them, one Arrow batch at a time.
What is chosen from their output is decided by column expressions.
"""

from __future__ import annotations

import re
import sys
from email import message_from_bytes
from email.errors import HeaderParseError
from email.header import decode_header
from email.headerregistry import HeaderRegistry
from email.policy import EmailPolicy, strict
from functools import lru_cache

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from letterloom.functions.headers import unfold
from letterloom.functions.text import bind, valid_text
from letterloom.schemas import PARSED
from letterloom.session import stage

# Workers get these functions by value, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ENCODED_RUN = re.compile(r"=\?[^?\s]+\?[bBqQ]\?[^?]*\?=(?:\s*=\?[^?\s]+\?[bBqQ]\?[^?]*\?=)*")
_PARSED_ARROW = to_arrow_type(PARSED)
_WORDS_ARROW = pa.list_(pa.string())


def _decode_run(match: re.Match) -> str:
    try:
        chunks = decode_header(match[0])
        return "".join(
            c if isinstance(c, str) else c.decode(charset or "ascii", "replace") for c, charset in chunks
        )
    except (HeaderParseError, LookupError, ValueError):
        return match[0]


def _storable(text: str | None) -> str | None:
    """Lone surrogates cannot be stored as UTF-8."""
    return None if text is None else text.encode("utf-8", "replace").decode("utf-8")


def _describe(part, number: int, depth: int, parent: int | None, reachable: bool, in_related: bool) -> dict:
    content_type = part.get_content_type()
    row = {
        "part_no": number,
        "depth": depth,
        "parent": parent,
        "content_type": content_type,
        "disposition": _storable(str(part.get("content-disposition", ""))),
        "charset": _storable(part.get_content_charset()),
        "multipart": part.is_multipart(),
        "reachable": reachable,
        "in_related": in_related,
        "payload": None,
        "error": None,
    }
    if content_type.startswith("text/") and not part.is_multipart():
        try:
            row["payload"] = _storable(part.get_content())
        except LookupError:
            row["error"] = "charset"
        except Exception as failure:  # a defect of this part only
            row["error"] = type(failure).__name__
    return row


def _related_root(part):
    """The child a related part is read from: the one its start names, else the first."""
    start = part.get_param("start")
    children = part.get_payload()
    named = [c for c in children if start and c["content-id"] == start]
    return (named or children or [None])[0]


def _parts(message) -> list[dict]:
    """Every part in document order. A part is reachable when it can be the body."""
    rows: list[dict] = []
    # part, depth, parent, reachable, inside the first related part
    stack = [(message, 0, None, True, False)]
    related_seen = False
    while stack:
        part, depth, parent, reachable, in_related = stack.pop()
        reachable = reachable and not part.is_attachment()
        number = len(rows)
        row = _describe(part, number, depth, parent, reachable, in_related)
        rows.append(row)
        if not row["multipart"]:
            continue
        is_related = row["content_type"] == "multipart/related"
        if is_related and reachable and not related_seen:
            related_seen = in_related = True
        root = _related_root(part) if is_related else None
        opens = reachable and row["content_type"].startswith("multipart/")
        children = [
            (child, depth + 1, number, opens and (root is None or child is root), in_related)
            for child in part.get_payload()
        ]
        stack.extend(reversed(children))
    return rows


def _parse_one(raw: bytes | None, policy: EmailPolicy) -> dict | None:
    if raw is None:
        return None
    try:
        return {"defect": None, "parts": _parts(message_from_bytes(raw, policy=policy))}
    except Exception as failure:  # a malformed message is data, not a task failure
        return {"defect": type(failure).__name__, "parts": []}


@F.arrow_udf(PARSED)
def parse_mime(value: pa.Array) -> pa.Array:
    """Message bytes to its parts, or the defect that makes it unreadable."""
    # The library parses a header at every access, and most content headers repeat.
    policy = strict.clone(header_factory=lru_cache(4096)(HeaderRegistry()))
    return pa.array([_parse_one(raw, policy) for raw in value.to_pylist()], type=_PARSED_ARROW)


@F.arrow_udf(T.ArrayType(T.StringType()))
def decode_words(values: pa.Array) -> pa.Array:
    """Header values with every encoded word decoded, whatever its charset."""
    decoded = [
        None if row is None else [v and _storable(_ENCODED_RUN.sub(_decode_run, v)) for v in row]
        for row in values.to_pylist()
    ]
    return pa.array(decoded, type=_WORDS_ARROW)


# One UTF-8 base64 word and nothing else: decoded without Python.
_PLAIN_WORD = r"^=\?(?i:utf-8)\?[bB]\?((?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?)\?=$"


def decode_simple_word(value: Column) -> Column:
    decoded = F.unbase64(F.regexp_extract(value, _PLAIN_WORD, 1))
    return F.when(value.startswith("=?") & value.rlike(_PLAIN_WORD), valid_text(decoded)).otherwise(value)


def with_decoded_headers(df: DataFrame, raw: str, out: str) -> DataFrame:
    """Add array<struct<pos, name, value>> with decoded values.

    Values without encoded words never leave the JVM.
    """
    df = df.withColumn(
        out, F.transform(raw, lambda h: h.withField("value", decode_simple_word(h["value"])))
    )
    df = df.withColumn("_left_over", F.exists(out, lambda h: F.contains(h["value"], F.lit("=?"))))
    decoded = decode_words(F.when(F.col("_left_over"), F.transform(out, lambda h: h["value"])))
    joined = F.zip_with(
        out, decoded, lambda h, value: h.withField("value", F.coalesce(value, h["value"]))
    )
    return df.withColumn(out, F.when(F.col("_left_over"), joined).otherwise(F.col(out))).drop("_left_over")


# The shape of a message whose body needs no MIME parser.
_ANY_HEADER = r"^[!-9;-~]+:"
_SIMPLE_TYPE = r"(?i)^text/(plain|html)\s*(?:;\s*charset=\"?(utf-8|us-ascii)\"?\s*)?$"
_BASE64_BODY = r"\A[A-Za-z0-9+/]*={0,2}\z"


def with_body_source(df: DataFrame, raw: str, split: str, wanted: Column) -> DataFrame:
    """Add ``body_source``: struct<text, content_type, reason> of the core body.

    A single-part UTF-8 or ASCII text message is read with column expressions.
    Only other messages reach the parser, and none for which ``wanted`` is
    false. ``split`` holds the head and the rest of ``raw`` as text.
    """
    head, rest = F.get(split, F.lit(0)), F.coalesce(F.get(split, F.lit(1)), F.lit(""))
    lines = F.split(unfold(head), r"\r?\n")
    df = df.withColumn("_lines", lines)
    mime_lines = F.filter("_lines", lambda line: line.rlike(r"(?i)^content-"))
    named = F.transform(
        mime_lines,
        lambda line: F.struct(
            F.lower(F.substring_index(line, ":", 1)).alias("name"),
            F.lower(F.btrim(F.regexp_extract(line, r"(?s)^[^:]*:(.*)$", 1))).alias("value"),
        ),
    )
    df = df.withColumn("_mime", named)

    def only(name: str) -> Column:
        """Value of a header, null when absent."""
        return F.get(F.filter("_mime", lambda h: h["name"] == name), F.lit(0))["value"]

    repeats = F.size(F.array_distinct(F.transform("_mime", lambda h: h["name"]))) != F.size("_mime")
    tidy = (
        F.is_valid_utf8(F.col(raw).cast("string"))
        & F.forall("_lines", lambda line: line.rlike(_ANY_HEADER))
        & ~head.rlike(r"\r(?!\n)")
        & ~repeats
        & only("content-disposition").isNull()
    )
    df = df.withColumn("_kind", only("content-type")).withColumn(
        "_encoding", F.coalesce(only("content-transfer-encoding"), F.lit("7bit"))
    )
    kind = F.col("_kind")
    df = df.withColumn(
        "_shape",
        F.struct(
            (tidy & (kind.isNull() | kind.rlike(_SIMPLE_TYPE))).alias("simple"),
            F.when(kind.contains("html"), "text/html").otherwise("text/plain").alias("content_type"),
            F.coalesce(kind.contains("utf-8"), F.lit(False)).alias("utf8"),
            F.col("_encoding").alias("encoding"),
        ),
    )
    packed = F.regexp_replace(rest, r"[\r\n]+", "")
    encoding = F.col("_shape.encoding")
    body = F.when(encoding.isin("7bit", "8bit", "binary"), rest.cast("binary")).when(
        encoding == "base64",
        bind(packed, lambda p: F.when(p.rlike(_BASE64_BODY) & (F.length(p) % 4 == 0), F.unbase64(p))),
    )
    df = df.withColumn("_bytes", F.when(wanted & F.col("_shape.simple"), body))
    as_text = F.col("_bytes").cast("string")
    # UTF-8 text must be valid; without a charset it must be ASCII.
    readable = F.coalesce(
        F.when(F.col("_shape.utf8"), F.is_valid_utf8(as_text)).otherwise(
            F.length(as_text) == F.octet_length(as_text)
        ),
        F.lit(False),
    )
    df = df.withColumn("_native", readable)
    parsed = parse_mime(F.when(wanted & ~F.col("_native"), F.col(raw)))
    df = df.withColumn("_parsed", parsed)
    df = df.withColumn("_best", core_part(F.col("_parsed.parts")))
    best = F.col("_best")
    found = F.struct(
        best["payload"].alias("text"),
        best["content_type"].alias("content_type"),
        F.when(F.col("_parsed.defect").isNotNull(), F.concat(F.lit("defect:"), F.col("_parsed.defect")))
        .when(best.isNull() | (best["error"] == "charset"), "no_body")
        .when(best["error"].isNotNull(), F.concat(F.lit("defect:"), best["error"]))
        .alias("reason"),
    )
    native = F.struct(
        as_text.alias("text"),
        F.col("_shape.content_type").alias("content_type"),
        F.lit(None).cast("string").alias("reason"),
    )
    df = df.withColumn("body_source", F.when(F.col("_native"), native).when(wanted, found))
    df = df.drop("_lines", "_mime", "_kind", "_encoding", "_shape", "_bytes", "_native", "_parsed", "_best")
    return stage(df, "bodies")


def core_part(parts: Column) -> Column:
    """The part that holds the message body, null when no part can.

    Plain text inside a related part comes first, then HTML, then plain text;
    within a rank the earliest part wins. Attachments never count.
    """

    def rank(part: Column) -> Column:
        inline = ~F.contains(F.lower(part["disposition"]), F.lit("attachment"))
        plain, html = part["content_type"] == "text/plain", part["content_type"] == "text/html"
        return (
            F.when(part["in_related"] & plain & inline, 0)
            .when(part["reachable"] & html, 1)
            .when(part["reachable"] & plain, 2)
        )

    ranked = F.transform(
        parts,
        lambda p: F.struct(
            rank(p).alias("rank"), p["part_no"].alias("part_no"), p["content_type"].alias("content_type"),
            p["payload"].alias("payload"), p["error"].alias("error"),
        ),
    )
    return F.array_min(F.filter(ranked, lambda p: p["rank"].isNotNull()))


def explode_parts(df: DataFrame, key: str, raw: str) -> DataFrame:
    """One row per MIME part; a message that cannot be read gives one row with its ``defect`` and no part.

    The generator infers a filter on its array, which without the stage would parse every message again.
    """
    parsed = stage(df.select(key, parse_mime(F.col(raw)).alias("_parsed")), "parts")
    return parsed.select(key, F.col("_parsed.defect").alias("defect"), F.inline_outer("_parsed.parts"))
