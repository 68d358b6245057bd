"""Command line jobs: ``spark-submit letterloom/jobs.py {stream,features,corpus} ...``."""

from __future__ import annotations

import argparse
import datetime as dt
import os
from dataclasses import replace
from collections.abc import Sequence

from pyspark.sql import SparkSession

from letterloom.operators.entities import Gazetteer, read_gazetteer
from letterloom.operators.lookup import Lookup, measure
from letterloom.operators.vocabulary import build_vocabulary
from letterloom.options import MailOptions
from letterloom.plans.corpus import run_corpus
from letterloom.plans.features import daily_features
from letterloom.plans.messages import ROW_KEY
from letterloom.session import apply_runtime_conf
from letterloom.sources.readers import read_day, read_mail_stream, read_vocabulary
from letterloom.sources.writers import write_features
from letterloom.streaming.ingest import TRIGGER, ingest_stream, ingest_stream_in_batches


def _day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def _yesterday() -> dt.date:
    return dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)
    private = argparse.ArgumentParser(add_help=False)
    private.add_argument("--salt", help="for address hashes and surrogates")
    private.add_argument("--gazetteer", help="Parquet with surface and label; content tagging needs it")
    private.add_argument("--rejects", help="folder for messages left out and why")
    stream = jobs.add_parser("stream", parents=[private], help="topic to message table")
    for name in ("hosts", "topic", "table", "checkpoint"):
        stream.add_argument(f"--{name}", required=True)
    stream.add_argument("--every", default=TRIGGER)
    words = argparse.ArgumentParser(add_help=False)
    words.add_argument("--vocabulary", required=True, help="text file, one term per line")
    words.add_argument("--lemmas", help="Parquet with token and lemma")
    words.add_argument("--day", type=_day, default=None, help="default: yesterday")
    features = jobs.add_parser("features", parents=[words], help="one day of the table to features")
    features.add_argument("--table", required=True)
    features.add_argument("--out", required=True)
    corpus = jobs.add_parser("corpus", parents=[words, private], help="folder of message files to table and features")
    corpus.add_argument("--folder", required=True)
    corpus.add_argument("--out", required=True)
    return top


def _lookups(spark: SparkSession, args: argparse.Namespace) -> tuple[Lookup, Lookup]:
    vocabulary = measure(build_vocabulary(read_vocabulary(spark, args.vocabulary)))
    lemmas = spark.read.parquet(args.lemmas) if args.lemmas else spark.createDataFrame([], "token string, lemma string")
    return vocabulary, measure(lemmas.select("token", "lemma"))


def _privacy(spark: SparkSession, args: argparse.Namespace) -> tuple[MailOptions, Gazetteer | None]:
    """The switches of the environment, "true" or anything else; one that cannot be honoured is an error."""
    options = MailOptions.from_mapping(os.environ, args.salt)
    if options.tag_content and not args.gazetteer:
        raise SystemExit("content tagging is on: name a --gazetteer, or names stay in the clear")
    if not options.tag_content:
        return options, None
    return options, read_gazetteer(spark.read.parquet(args.gazetteer).select("surface", "label"))


def run(spark: SparkSession, argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    apply_runtime_conf(spark)
    if args.job == "stream":
        options, gazetteer = _privacy(spark, args)
        raw = read_mail_stream(spark, args.hosts, args.topic)
        if gazetteer is None and not args.rejects:
            query = ingest_stream(raw, args.table, args.checkpoint, options, args.every)
        else:
            query = ingest_stream_in_batches(
                raw, args.table, args.checkpoint, options, gazetteer, args.every, args.rejects
            )
        query.awaitTermination()
        return
    vocabulary, lemmas = _lookups(spark, args)
    day = args.day or _yesterday()
    if args.job == "features":
        messages = read_day(spark, args.table, day, (*ROW_KEY, "message_id", "subject", "body"))
        write_features(daily_features(messages, vocabulary, lemmas, day), args.out)
    else:
        options, gazetteer = _privacy(spark, args)
        options = replace(options, strip_payload=False)
        run_corpus(spark, args.folder, args.out, vocabulary, lemmas, day, options, gazetteer, args.rejects)


if __name__ == "__main__":
    run(SparkSession.builder.appName("letterloom").getOrCreate())
