"""The message plan, the streaming jobs, sources and sinks, and the plans Spark makes of them."""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from letterloom.jobs import run
from letterloom.operators.entities import read_gazetteer
from letterloom.operators.lookup import measure
from letterloom.operators.vocabulary import build_vocabulary
from letterloom.options import MailOptions
from letterloom.plans.corpus import run_corpus
from letterloom.plans.messages import ROW_KEY, accepted_messages, classify_messages, rejected_messages
from letterloom.schemas import MESSAGE_COLUMNS
from letterloom.session import ensure_checkpoint_dir
from letterloom.sources.readers import (
    read_day,
    read_file_stream,
    read_mail_dir,
    read_messages,
    read_vocabulary,
)
from letterloom.sources.message_files import MessageFileWriter, Written
from letterloom.sources.writers import write_files, write_messages
from letterloom.streaming.ingest import (
    ingest_stream,
    tagged_batch_writer,
    write_outcome_stream,
)
from tests.mail_samples import HEAD, LONG, WORDS, kafka_frame, multipart, part, simple

MESSAGES = [
    simple(extra="Date: Mon, 6 Jun 2005 22:21:22 +0200\nMessage-ID: <one@x>\nCc: bad, Carl <carl@example.net>\n"),
    simple("short"),
    simple("x" * 6000),
    simple(head="From: a@b.c\nSubject: no recipient\n"),
    simple("<p>" + LONG + "</p>", extra="Content-Type: text/html; charset=utf-8\n"),
    simple(LONG + "\n-----Original Message-----\nold"),
    simple("<p>" + WORDS * 2 + "</p>" + "<br>" * 40, extra="Content-Type: text/html; charset=utf-8\n"),
    multipart("alternative", part("text/plain; charset=utf-8", LONG), part("text/html; charset=utf-8", f"<b>{LONG}</b>")),
    simple("QUJDRA", extra="Content-Type: text/plain\nContent-Transfer-Encoding: base64\n"),
    multipart("mixed", part("image/png", "x")),
]
REASONS = [None, "length_pre", "length_pre", "missing_header", None, None, "length_final", None,
           "defect:InvalidBase64PaddingDefect", "no_body"]


@pytest.fixture(scope="module")
def raw(spark):
    return kafka_frame(spark, MESSAGES).repartition(3)


def key(rows):
    return sorted(str(r) for r in rows)


def test_outcomes(raw):
    rows = classify_messages(raw).orderBy("offset").collect()
    assert [r["reason"] for r in rows] == REASONS
    first = rows[0]
    assert first["message_id"] == "one@x" and first["subject"] == "hello" and first["body"] == LONG.strip()
    assert first["date"] == dt.datetime(2005, 6, 6, 20, 21, 22)
    assert (first["from_address"], first["to_addresses"], first["cc_addresses"], first["bcc_addresses"]) == (
        "ann@example.com", "bob@example.org", "carl@example.net", "",
    )
    assert rows[4]["message_id"] == "gen-" + hashlib.sha256(MESSAGES[4].strip()).hexdigest()
    assert all(r[c] is None for r in rows for c in MESSAGE_COLUMNS if r["reason"])


def test_accepted_and_rejected(raw):
    outcomes = classify_messages(raw)
    assert accepted_messages(outcomes).count() == 4
    assert accepted_messages(outcomes, null_rows=True).count() == len(MESSAGES)
    assert {r["offset"]: r["reason"] for r in rejected_messages(outcomes).collect()} == {
        i: r for i, r in enumerate(REASONS) if r
    }


def test_options(raw, spark):
    hashed = classify_messages(raw, MailOptions(hash_addresses=True, salt="s", hash_mode="pbkdf2")).orderBy("offset").first()
    mac = [hashlib.pbkdf2_hmac("sha512", t, b"s", 1, 8).hex() for t in (b"ann", b"example.com")]
    assert hashed["from_address"] == "@".join(mac) and hashed["body"] == LONG.strip()
    tagged = classify_messages(raw, MailOptions(tag_content=True)).orderBy("offset").first()
    assert "NUM men" in tagged["body"]
    table = spark.createDataFrame([("brown fox", "PRODUCT"), ("hello", "PERSON")], "surface string, label string")
    gazetteer = read_gazetteer(table)
    both = classify_messages(raw, MailOptions(tag_content=True), gazetteer).orderBy("offset").first()
    assert "quick PRODUCT jumps" in both["body"] and both["subject"] == "PERSON"
    filled = classify_messages(raw, MailOptions(tag_content=True, fill_surrogates=True, salt="s"), gazetteer)
    first = filled.orderBy("offset").first()
    assert "PRODUCT" not in first["body"] and " Ltd" in first["body"] and "NUM" not in first["body"]
    assert MailOptions.from_mapping({"DO_CONTENT_TAGGING": "true", "DO_FAKER_REPLACEMENT": "true"}, "s").fill_surrogates
    assert not MailOptions.from_mapping({"DO_FAKER_REPLACEMENT": "true"}).fill_surrogates
    for wrong in ({"hash_addresses": True}, {"hash_mode": "md5"}, {"fill_surrogates": True, "salt": "s"}):
        with pytest.raises(ValueError):
            MailOptions(**wrong)


def test_stream_equals_batch(spark, raw, tmp_path):
    """One batch, or one per file, or a plain batch job: the same table."""
    source = str(tmp_path / "raw")
    raw.repartition(4).write.parquet(source)
    want = key(accepted_messages(classify_messages(raw)).collect())
    for files in (None, 1):
        out = str(tmp_path / f"out{files}")
        ingest_stream(read_file_stream(spark, source, files), out, out + "-check", every=None).awaitTermination()
        table = spark.read.parquet(out).select(*MESSAGE_COLUMNS, "processed_date")
        assert key(table.collect()) == want
    assert (tmp_path / "out1" / "processed_date=2024-05-01").is_dir()


def test_outcome_stream(spark, raw, tmp_path):
    source, out = str(tmp_path / "raw"), str(tmp_path / "out")
    raw.write.parquet(source)
    outcomes = classify_messages(read_file_stream(spark, source))
    write_outcome_stream(outcomes, out, out + "-check", every=None).awaitTermination()
    counts = {r["outcome"]: r["count"] for r in spark.read.parquet(out).groupBy("outcome").count().collect()}
    assert counts == {"accepted": 4, "rejected": 6}


def test_tagged_batches_can_be_repeated(spark, raw, tmp_path):
    gazetteer = read_gazetteer(spark.createDataFrame([("lazy dog", "NORP")], "surface string, label string"))
    write = tagged_batch_writer(str(tmp_path / "t"), MailOptions(tag_content=True), gazetteer)
    for batch_id in (0, 1, 1):
        write(raw.where(F.col("offset") % 2 == batch_id), batch_id)
    table = spark.read.parquet(str(tmp_path / "t"))
    assert table.count() == 4 and table.where(F.col("body").contains("NORP")).count() == 4


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_stream_leaves_no_checkpoints(spark, raw, tmp_path):
    """Three batches with names beyond the limit: the same rows as in one batch, and no file of the frames between."""
    names = spark.createDataFrame([("lazy dog", "NORP")], "surface string, label string")
    options, path = MailOptions(tag_content=True), str(tmp_path / "t")
    large, small = read_gazetteer(names, 0), read_gazetteer(names)
    ensure_checkpoint_dir(spark)
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(folder.iterdir())
    write = tagged_batch_writer(path, options, large)
    for batch in range(3):
        write(raw.where(F.col("offset") % 3 == batch), batch)
    assert set(folder.iterdir()) == before
    want = accepted_messages(classify_messages(raw, options, small), keep=ROW_KEY)
    got = spark.read.parquet(path).select(*want.columns)
    assert key(got.collect()) == key(want.collect()) and got.where("body like '%NORP%'").count() > 0


def test_a_broken_batch_is_written_once(spark, raw, tmp_path):
    """What is written before a failure is replaced when the batch runs again."""
    calls = []

    def broken(batch_id):
        calls.append(batch_id)
        if len(calls) == 1:
            raise InterruptedError

    write = tagged_batch_writer(str(tmp_path / "a"), MailOptions(), None, str(tmp_path / "r"), broken)
    with pytest.raises(InterruptedError):
        write(raw, 0)
    assert not (tmp_path / "a").exists()
    write(raw, 0)
    outcomes = classify_messages(raw)
    assert spark.read.parquet(str(tmp_path / "r")).count() == rejected_messages(outcomes).count() > 0
    assert spark.read.parquet(str(tmp_path / "a")).count() == accepted_messages(outcomes).count() > 0


def test_message_plan_shape(raw, spark, tmp_path):
    """One Python step, no shuffle, and filters that repeat none of it."""
    path = str(tmp_path / "raw")
    raw.write.parquet(path)
    outcomes = classify_messages(spark.read.parquet(path))
    text = plan(accepted_messages(outcomes).where(F.length("body") > 300))
    assert len(re.findall(r"ArrowEvalPython \[", text)) == 1
    assert "Exchange" not in text


def test_day_scan_prunes(spark, raw, tmp_path):
    path = str(tmp_path / "table")
    write_messages(accepted_messages(classify_messages(raw)), path, ["processed_date"])
    day = read_day(spark, path, dt.date(2024, 5, 2))
    text = plan(day)
    assert re.search(r"PartitionFilters: \[.*processed_date", text)
    assert "ReadSchema: struct<subject:string,body:string>" in text
    assert day.count() == 2 and read_day(spark, path).count() == 0


def test_missing_path_is_empty(spark, tmp_path):
    table = read_messages(spark, str(tmp_path / "none"), ["message_id"])
    assert table.columns == ["message_id"] and table.count() == 0


def test_read_vocabulary(spark, tmp_path):
    (tmp_path / "words.txt").write_text("Beta\n alpha \n\nbeta\n")
    rows = build_vocabulary(read_vocabulary(spark, str(tmp_path / "words.txt"))).collect()
    assert {r["term"]: r["idx"] for r in rows} == {"alpha": 0, "beta": 1}


def test_corpus_run(spark, tmp_path):
    folder = tmp_path / "mail" / "deep"
    folder.mkdir(parents=True)
    for number, message in enumerate(MESSAGES):
        (folder / f"m{number}.eml").write_bytes(message)
    (tmp_path / "mail" / "latin.eml").write_bytes(HEAD.encode() + b"\n" + LONG.encode() + b"\xe9")
    assert read_mail_dir(spark, str(tmp_path / "mail")).count() == len(MESSAGES) + 1
    vocabulary = measure(build_vocabulary(spark.createDataFrame([("fox",), ("dog",)], "term string")))
    lemmas = measure(spark.createDataFrame([("men", "man")], "token string, lemma string"))
    out = str(tmp_path / "out")
    messages = run_corpus(spark, str(tmp_path / "mail"), out, vocabulary, lemmas, dt.date(2024, 1, 1))
    assert messages.count() == 5
    features = spark.read.parquet(out + "/features")
    assert features.count() == 10 and {r[0] for r in features.select("split").distinct().collect()} == {"train", "test"}
    text = "\n".join(r[0] for r in spark.read.text(out + "/eml").collect())
    assert text.count("Message-Id: ") == 5


def test_command_line(spark, raw, tmp_path, monkeypatch):
    table, out = str(tmp_path / "table"), str(tmp_path / "out")
    write_messages(accepted_messages(classify_messages(raw), keep=ROW_KEY), table, ["processed_date"])
    (tmp_path / "words.txt").write_text("fox\ndog\n")
    words = ["--vocabulary", str(tmp_path / "words.txt"), "--day", "2024-05-02"]
    run(spark, ["features", "--table", table, "--out", out, *words])
    rows = spark.read.parquet(out)
    assert rows.count() == 4 and {str(r[0]) for r in rows.select("matrix_date").distinct().collect()} == {"2024-05-02"}
    (tmp_path / "mail").mkdir()
    (tmp_path / "mail" / "one").write_bytes(MESSAGES[0])
    run(spark, ["corpus", "--folder", str(tmp_path / "mail"), "--out", out + "2", *words])
    assert spark.read.parquet(out + "2/messages").count() == 1
    monkeypatch.setenv("DO_CONTENT_TAGGING", "true")
    monkeypatch.setenv("DO_ADDRESS_HASHING", "true")
    corpus = ["corpus", "--folder", str(tmp_path / "mail"), "--out", out + "3", *words, "--salt", "s"]
    with pytest.raises(SystemExit):  # names would stay in the clear
        run(spark, corpus)
    (tmp_path / "mail" / "two").write_bytes(b"To: a@b.co")
    spark.createDataFrame([("fox", "PERSON")], "surface string, label string").write.parquet(str(tmp_path / "names"))
    run(spark, [*corpus, "--gazetteer", str(tmp_path / "names"), "--rejects", out + "4"])
    (row,) = spark.read.parquet(out + "3/messages").collect()
    assert "fox" not in row["body"].split() and not row["from_address"].endswith("@example.com")
    assert [r["reason"] for r in spark.read.parquet(out + "4").collect()] == ["missing_header"]
    with pytest.raises(SystemExit):
        run(spark, ["stream", "--hosts", "h"])


def test_hostile_messages(spark):
    """Nothing a message holds may fail the job."""
    many = 100_000
    hostile = [
        b"", b"\n", b"\x00", b":", b"\xff\xfe" * 50, b"From: a\nTo: b\nSubject: c", HEAD.encode() + b"Date: " + b"9" * 500 + b"\n\nx",
        HEAD.encode() + b"Content-Type: multipart/mixed; boundary=\n\n--\n--", HEAD.encode() + b"Content-Type: /;;=\n\nx",
        HEAD.encode() + b"Content-Type: text/plain; charset=\xff\n\nx", (HEAD + "\n" + "<" * 4000).encode(),
        HEAD.encode() + b"Content-Type: text/html\n\n" + b"<a href='" * 500, HEAD.encode() + b"\n" + b"&#x110000;" * 100,
        HEAD.encode() + b"Content-Type: text/html\n\n" + b"&#xD800;&#99999999; " * 100,
        b"Subject: =?utf-8?B?!!!?=\nFrom: =?x?q?=\nTo: =?utf-8?Q?=ZZ?=\n\n" + LONG.encode(),
        *(b"From: a@b.co\nSubject: x\nTo: " + to for to in (b"a." * many + b"a@b.co", b"a@" + b"b." * many + b"co", b'"q" ' * many + b"x@y.co", b'"' + b"," * many)),
        *((HEAD + "\n" + body).encode() for body in ("x " * 200 + "a@b" + ".c" * 1500, "x " * 200 + "www" + ".c" * 1500 + ".com", "x " * 200 + "1" + ".2" * 2000)),
        *((HEAD + "Content-Type: text/html\n\n" + "x " * 200 + body).encode() for body in ("<a" + " b='c'" * 600 + ">", "<a" + ' b="c"' * 600, "<script>" * 500, "&#" + "9" * 3000)),
        HEAD.encode() + b"\n" + b"a@" * 2000, HEAD.encode() + b"\n" + b"(" * 3000 + b"> " * 500,
    ]
    options = MailOptions(tag_content=True, fill_surrogates=True, hash_addresses=True, salt="s")
    assert classify_messages(kafka_frame(spark, hostile), options).count() == len(hostile)
    assert len(classify_messages(kafka_frame(spark, hostile), options).collect()) == len(hostile)


def test_message_files(spark, tmp_path):
    """Null, empty and repeated rows are files; appending adds, overwriting replaces, a failed write leaves nothing."""
    path = str(tmp_path / "out")
    rows = [(b"a",), (b"a",), (None,), (b"",), ("é\n".encode() * 9,)] * 700
    frame = spark.createDataFrame(rows, "content binary").repartition(2)

    def contents():
        files = [p for p in (tmp_path / "out").rglob("*.eml") if not any(part.startswith("_") for part in p.parts)]
        return sorted(p.read_bytes() for p in files)

    want = sorted(r[0] or b"" for r in rows)
    for mode, times in (("overwrite", 1), ("append", 2), ("overwrite", 1)):
        write_files(frame, F.col("content"), path, mode=mode)
        assert Counter(contents()) == Counter(want * times), mode
    read = read_mail_dir(spark, path, "*.eml").select("value").collect()
    assert sorted(bytes(r[0]) for r in read) == [c for c in want if c]  # Spark's reader passes over empty files
    assert max(len(list(p.iterdir())) for p in (tmp_path / "out").rglob("*") if p.is_dir()) <= 1_000
    broken = frame.withColumn("content", F.when(F.col("content") == b"", F.raise_error(F.lit("broken"))).otherwise(F.col("content")))
    with pytest.raises(Exception, match="broken"):
        write_files(broken, F.col("content"), path, mode="append")
    assert contents() == want and not [p for p in (tmp_path / "out").iterdir() if p.name.startswith("_")]
    with pytest.raises(Exception, match="first column"):
        frame.select(F.lit("x")).write.format("message_files").mode("append").save(path)
    write_files(frame.where("false"), F.col("content"), path)
    assert [p for p in (tmp_path / "out").rglob("*") if p.is_file() and p.suffix == ".eml"] == []


def test_uncommitted_attempts_go(tmp_path):
    """What a lost attempt wrote does not outlive the commit."""
    writer = MessageFileWriter(str(tmp_path), False, "job-1", ".eml")
    for folder in ("part-000000-1", "part-000000-2"):
        (tmp_path / "_job-1" / folder).mkdir(parents=True)
        (tmp_path / "_job-1" / folder / "000.eml").write_bytes(b"x")
    writer.commit([Written("part-000000-2", 1), None])
    assert [str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*.eml")] == ["job-1/part-000000-2/000.eml"]


def test_files_are_listed_and_read_by_tasks(spark, tmp_path):
    """The rows of Spark's reader of binary files, without a list of files on the driver."""
    root = tmp_path / "mail"
    for place in ("a.eml", "in/b.eml", "in/deep=1/c d.eml", "in/deep=1/_x=1.eml", "in/_hidden/d.eml", "in/.e.eml", "_f.eml",
                  "in/g.txt", "in/_metadata/h.eml", "in/i._COPYING_", "in/empty.eml"):
        (root / place).parent.mkdir(parents=True, exist_ok=True)
        (root / place).write_bytes(b"" if "empty" in place else place.encode() * 3 + b"\xff")
    (root / "in/nothing").mkdir()
    for glob in ("*.eml", None, "?.t*", "{a,b}.eml", "none"):
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        want = (reader.option("pathGlobFilter", glob) if glob else reader).load(str(root))
        want = sorted(want.select("path", "modificationTime", "content").collect())
        for place in (str(root), f"file://{root}/"):
            got = read_mail_dir(spark, place, glob)
            assert sorted(got.select("path", "timestamp", "value").collect()) == want, glob
            assert ("binaryFile" in plan(got)) == (glob == "{a,b}.eml")
    assert read_mail_dir(spark, str(root), "*.eml").count() == 5
    assert read_mail_dir(spark, f"{root}/in/b.eml").count() == 1  # a file, read by Spark


def test_named_files(spark, tmp_path):
    """Rows of one name are one file, also a null one, and folders stay bounded however many names there are."""
    path = str(tmp_path / "out")
    rows = [(i % 2500, b"%d\n" % i) for i in range(3000)] + [(None, b"x\n"), (None, b"x\n")]
    frame = spark.createDataFrame(rows, "id int, content binary").repartition(5)
    write_files(frame, F.col("content"), path, ".txt", name=F.concat(F.lit("id="), F.col("id").cast("string")))
    files = {p.stem: sorted(p.read_text().split()) for p in (tmp_path / "out").rglob("*.txt")}
    want = {f"id={i}": sorted(str(k) for k in range(3000) if k % 2500 == i) for i in range(2500)}
    assert files == want | {"unnamed": ["x", "x"]}
    folders = [p for p in (tmp_path / "out").rglob("*") if p.is_dir()]
    assert len(folders) < 60 and max(len(list(p.iterdir())) for p in folders) <= 1_000
