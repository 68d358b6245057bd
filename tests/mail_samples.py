"""Raw messages for the tests."""

from __future__ import annotations

import datetime as dt

from letterloom.schemas import KAFKA_ROW

WORDS = "The quick brown fox jumps over the lazy dog while nine men watch it run away. "
LONG = WORDS * 5
HEAD = "From: Ann <ann@example.com>\nTo: bob@example.org\nSubject: Re: hello\n"


def simple(body: str = LONG, head: str = HEAD, extra: str = "") -> bytes:
    return f"{head}{extra}\n{body}".encode()


def multipart(subtype: str, *parts: str, params: str = "") -> bytes:
    inner = "".join(f"--cut\n{p}\n" for p in parts)
    return f'{HEAD}MIME-Version: 1.0\nContent-Type: multipart/{subtype}; boundary="cut"{params}\n\n{inner}--cut--\n'.encode()


def part(kind: str, body: str, *headers: str) -> str:
    return "\n".join([f"Content-Type: {kind}", *headers, "", body])


def kafka_frame(spark, messages: list[bytes]):
    day = dt.datetime(2024, 5, 1, 12)
    rows = [
        (str(i).encode(), bytearray(m), "mail", 0, i, day + dt.timedelta(days=i % 3), 0) for i, m in enumerate(messages)
    ]
    return spark.createDataFrame(rows, KAFKA_ROW)
