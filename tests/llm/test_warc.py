from __future__ import annotations

import hashlib
import io
import random

import pytest

from letterloom.llm import warc
from letterloom.llm.common import work_folder
from letterloom.llm.warc import _member, list_archives, page_records, read_archives, record, salvage, write_archives

ROWS = [
    (5, "http://a/\nb", "x" * 200), (3, "http://b", "x" * 200), (9, None, "x" * 200), (1, "u", "short"), (2, "u", "short"),
    (4, "u", None), (6, "u", ""), (7, "u", "é" * 50), (8, "u", "é" * 50), (10, "u", "\r\n\r\nWARC/1.1\r\n" * 30), (3, "http://b", "x" * 200),
    (None, "u", "lone" * 40), (11, "u", "y" * 3_000_000),
]


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame([(*r, "c") for r in ROWS], "page_id long, url string, html string, path string").repartition(3)


def want():
    out = []
    for k, _, html in ROWS:
        data = (html or "").encode()
        same = [i for i, _, h in ROWS if (h or "") == (html or "") and i is not None]
        first = min(same, default=None)
        again = len(data) >= 100 and k is not None and k != first
        out.append((k, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def test_round_trip(spark, pages, monkeypatch):
    got = page_records(pages, work_folder(spark, "warc-test"))
    assert sorted(map(tuple, got.collect()), key=repr) == want()
    assert page_records(pages.where("false"), work_folder(spark, "warc-test")).collect() == []


def test_archives_hold_the_pages(spark, pages):
    folder = work_folder(spark, "warc-test")
    assert write_archives(pages, folder).agg({"records": "sum"}).first()[0] == len(ROWS)
    records = read_archives(list_archives(spark, folder)).collect()
    assert all(r["problem"] is None for r in records)
    held = {r["record_id"]: bytes(r["payload"]) for r in records if r["record_type"] == "response"}
    assert held["5" if "5" in held else "3"] == b"x" * 200 and held["10"] == ROWS[9][2].encode()


def sample(plain):
    made = [record("response", str(k), f"http://{k}", (f"page {k} " * (20 + k)).encode(), "", 0, None) for k in range(12)]
    made = [m.replace(b"WARC-Payload-Digest: sha256:\r\n", b"WARC-Payload-Digest: sha256:" + hashlib.sha256(m.split(b"\r\n\r\n", 1)[1][:-4]).hexdigest().encode() + b"\r\n") for m in made]
    return [m if plain else _member(m) for m in made]


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("read", [1 << 20, 700])
def test_salvage(plain, read, monkeypatch):
    monkeypatch.setattr(warc, "READ", read)
    rng = random.Random(1)
    for trial in range(60):
        parts = sample(plain)
        hurt = set()
        # not side by side: the head of one torn record and the rest of the next can make a valid one
        for k in rng.sample(range(rng.randint(0, 1), 12, 2), rng.randint(0, 4)):
            kind, part = rng.randrange(4), parts[k]
            if kind == 0:  # a byte flipped in the payload or the packed data
                at = len(part) - 12
                part = part[:at] + bytes([part[at] ^ 0x55]) + part[at + 1 :]
            elif kind == 1:
                part = part[: len(part) // 2]
            elif kind == 2:
                part = rng.randbytes(50) + part[60:]
            else:
                part = b"\x1f\x8b\x08junk" + part[9:]
            hurt.add(k)
            parts[k] = part
        data = b"".join(parts)
        rows = list(salvage(io.BytesIO(data), "p"))
        good = [r for r in rows if r["problem"] is None]
        assert {int(r["record_id"]) for r in good} == set(range(12)) - hurt, (trial, hurt)
        # records and gaps cover the file
        assert [r["start"] for r in rows] == [0, *[r["end"] for r in rows[:-1]]][: len(rows)] and rows[-1]["end"] == len(data)


def test_only_garbage(monkeypatch):
    assert list(salvage(io.BytesIO(b""), "p")) == []
    (gap,) = salvage(io.BytesIO(b"WARC/1.0\r\nContent-Length: 99999999999\r\n\r\nx" + b"z" * 5000), "p")
    assert (gap["start"], gap["problem"]) == (0, "no valid record")


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("size", [70_000, 5_000_000])
def test_a_long_url_is_kept(plain, size):
    url = "http://long/" + "x y" * (size // 3)
    whole = record("response", "1", url, b"payload", "", 7, None).replace(b"sha256:\r\n", b"sha256:" + hashlib.sha256(b"payload").hexdigest().encode() + b"\r\n")
    rows = list(salvage(io.BytesIO((whole if plain else _member(whole)) * 2), "p"))
    assert [(r["problem"], r["record_id"], r["payload"]) for r in rows] == [(None, "1", b"payload")] * 2
    assert rows[0]["target"] == url.replace(" ", "%20")


def test_pages_with_long_urls_come_back(spark, tmp_path):
    rows = [(1, "http://a/" + "u" * 70_000, "<p>one</p>" * 30), (2, "http://b/" + "é " * 2_500_000, "<p>two</p>" * 30), (3, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r["page_id"], r["payload_bytes"]) for r in page_records(pages, str(tmp_path / "w")).collect())
    assert got == [(1, 300), (2, 300), (3, 0)]


def test_a_damaged_archive_raises(spark, tmp_path):
    pages = spark.createDataFrame([(k, "u", f"<p>{k}</p>" * 50) for k in range(5)], "page_id long, url string, html string").repartition(1)
    listed = write_archives(pages, str(tmp_path / "w")).collect()
    (name, count) = next((r["path"], r["records"]) for r in listed if r["records"])
    archives = spark.createDataFrame([(name, count), (None, 3)], "path string, records long")
    assert read_archives(archives, records="records").count() == count
    place = name.removeprefix("file:")
    data = open(place, "rb").read()
    for hurt in (data[:-30], data[: len(data) // 2] + b"\0" * 40 + data[len(data) // 2 + 40 :]):
        open(place, "wb").write(hurt)
        assert read_archives(archives).where("problem is not null").count() > 0
        with pytest.raises(Exception, match="no valid record|records instead of"):
            read_archives(archives, records="records").collect()
