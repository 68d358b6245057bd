"""MIME decoding, the choice of the body, and the native path beside the parser."""

from __future__ import annotations

import base64
import random
from email import message_from_bytes
from email.policy import strict

import pytest
from pyspark.sql import functions as F

from letterloom.functions.headers import split_message
from letterloom.functions.text import valid_text
from letterloom.operators.mime import core_part, explode_parts, parse_mime, with_body_source, with_decoded_headers
from tests.mail_samples import HEAD, LONG, kafka_frame, multipart, part, simple

UTF8 = "text/plain; charset=utf-8"


def bodies(spark, messages):
    df = kafka_frame(spark, messages).withColumn("split", split_message(valid_text(F.col("value"))))
    rows = with_body_source(df, "value", "split", F.lit(True)).orderBy("offset").collect()
    return [(r["body_source"]["text"], r["body_source"]["reason"]) for r in rows]


CASES = {
    "plain": (simple("hi\n"), ("hi\n", None)),
    "no body": (HEAD.encode(), ("", None)),
    "html beats plain": (multipart("alternative", part(UTF8, "p"), part("text/html", "<b>h</b>")), ("<b>h</b>", None)),
    "attached html": (
        multipart("mixed", part("text/html", "no", "Content-Disposition: attachment"), part(UTF8, "yes")), ("yes", None),
    ),
    "related plain": (multipart("related", part(UTF8, "inside"), part("image/png", "x")), ("inside", None)),
    "related html only": (multipart("related", part("text/html", "<i>h</i>"), part("image/png", "x")), ("<i>h</i>", None)),
    "related beside plain": (
        multipart("alternative", part(UTF8, "plain"),
                  'Content-Type: multipart/related; boundary="in"\n\n--in\nContent-Type: image/png\n\nx\n--in--'),
        ("plain", None),
    ),
    "related start": (
        multipart("related", part("image/png", "x"), part("text/html", "<u>s</u>", "Content-ID: <s>"), params='; start="<s>"'),
        ("<u>s</u>", None),
    ),
    "image only": (multipart("mixed", part("image/png", "x")), (None, "no_body")),
    "charset unknown": (simple("x", extra="Content-Type: text/plain; charset=what\n"), (None, "no_body")),
    "latin-1": (HEAD.encode() + b"Content-Type: text/plain; charset=iso-8859-1\n\ncaf\xe9", ("café", None)),
    "quoted printable": (
        simple("caf=C3=A9 =\nx", extra=f"Content-Type: {UTF8}\nContent-Transfer-Encoding: quoted-printable\n"), ("café x", None),
    ),
    "base64": (
        simple(base64.b64encode("é☃".encode() * 100).decode(), extra=f"Content-Type: {UTF8}\nContent-Transfer-Encoding: base64\n"),
        ("é☃" * 100, None),
    ),
    "bad padding": (
        simple("QUJDRA", extra=f"Content-Type: {UTF8}\nContent-Transfer-Encoding: base64\n"),
        (None, "defect:InvalidBase64PaddingDefect"),
    ),
    "ascii default": (HEAD.encode() + b"\ncaf\xc3\xa9", ("caf��", None)),
    "broken head": (b"From: a@b.c\nbroken line\nTo: x@y.z\nSubject: s\n\nbody", (None, "defect:MissingHeaderBodySeparatorDefect")),
    "no boundary": (simple("x", extra="Content-Type: multipart/mixed\n"), (None, "defect:NoBoundaryInMultipartDefect")),
    "nested message": (
        multipart("mixed", part(UTF8, "outer"), part("message/rfc822", HEAD + "\ninner")), ("outer", None),
    ),
}


def test_core_body(spark):
    got = bodies(spark, [message for message, _ in CASES.values()])
    assert dict(zip(CASES, got)) == {name: expected for name, (_, expected) in CASES.items()}


def test_native_path_agrees_with_parser(spark):
    """Random single-part messages give the same body by expressions and by the parser."""
    rng = random.Random(7)
    types = ["", "Content-Type: text/plain\n", f"Content-Type: {UTF8}\n", "Content-Type: TEXT/HTML; charset=\"UTF-8\"\n",
             "Content-Type: text/plain; charset=us-ascii\n", "Content-Type: text/plain;\n charset=utf-8\n",
             "Content-Type: text/plain\nContent-Type: text/html\n", "Content-Type: text/plain; name=\"a:text/html\"\n"]
    encodings = ["", "Content-Transfer-Encoding: 8bit\n", "Content-Transfer-Encoding: base64\n", "Content-Disposition: inline\n"]
    texts = ["plain\n\nmore\n", "café ☃\n", "", "a\r\nb\r\n\r\nc", "QUJD\nREVG\n", "QUJDRA==", "QUJDRA=", "\n\nlead"]
    messages = []
    for _ in range(300):
        ends = rng.choice(["\n", "\r\n"])
        head = HEAD + rng.choice(types) + rng.choice(encodings)
        raw = head.replace("\n", ends) + ends + rng.choice(texts)
        messages.append(raw.encode() + rng.choice([b"", b"", b"\xff", b"tail"]))
    parsed = kafka_frame(spark, messages).withColumn("p", parse_mime("value")).withColumn("best", core_part(F.col("p.parts")))
    rows = parsed.orderBy("offset").select("p.defect", "best.payload", "best.error").collect()
    want = [(r["payload"], r["defect"] or r["error"]) for r in rows]
    got = bodies(spark, messages)
    assert [t for t, _ in got] == [t for t, _ in want]
    assert [r is None for _, r in got] == [e is None for _, e in want]


@pytest.mark.parametrize("name", ["plain", "html beats plain", "attached html", "latin-1", "quoted printable", "nested message"])
def test_parser_agrees_with_library(spark, name):
    message = CASES[name][0]
    part = message_from_bytes(message, policy=strict).get_body()
    assert bodies(spark, [message])[0][0] == part.get_content()


def test_explode_parts(spark):
    message = multipart("mixed", part(UTF8, "a"), part("image/png", "x"), part("message/rfc822", HEAD + "\ninner"))
    rows = explode_parts(kafka_frame(spark, [message, b"bad\n\nx"]), "offset", "value").orderBy("part_no").collect()
    shape = [(r["part_no"], r["depth"], r["parent"], r["content_type"], r["payload"]) for r in rows if r["offset"] == 0]
    assert shape == [
        (0, 0, None, "multipart/mixed", None), (1, 1, 0, "text/plain", "a"), (2, 1, 0, "image/png", None),
        (3, 1, 0, "message/rfc822", None), (4, 2, 3, "text/plain", "inner"),
    ]
    (unread,) = [r for r in rows if r["offset"] == 1]
    assert unread["defect"] and unread["part_no"] is None


def test_explode_parts_parses_once(spark):
    parts = explode_parts(kafka_frame(spark, [b"a: b\n\nx"]), "offset", "value").where("part_no >= 0")
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_decode_headers(spark):
    values = {
        "plain": "plain",
        "=?UTF-8?B?w6k=?=": "é",
        "=?utf-8?q?caf=C3=A9_x?= tail": "café x tail",
        "=?ISO-8859-1?Q?=E9?= =?ISO-8859-1?Q?=E8?=": "éè",
        "=?utf-8?B?4pg=?= =?utf-8?B?gw==?=": "☃",
        "Foo =?koi8-r?B?8NLJ?= baz ☃": "Foo При baz ☃",
        "=?no-such?Q?x?=": "=?no-such?Q?x?=",
        "=?utf-8?B?w6k?=": "é",
    }
    rows = [(i, [{"pos": 0, "name": "subject", "value": v}]) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, raw array<struct<pos: bigint, name: string, value: string>>")
    got = with_decoded_headers(df, "raw", "out").orderBy("i").select(F.col("out")[0]["value"]).collect()
    assert [r[0] for r in got] == list(values.values())


def test_long_text_survives(spark):
    body = (LONG + "\n") * 2000
    assert bodies(spark, [simple(body)])[0][0] == body
