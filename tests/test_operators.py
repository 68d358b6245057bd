"""Joins, ranks, entities, tokens and features against brute force."""

from __future__ import annotations

import datetime as dt
import random
import time
import tracemalloc
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from letterloom.functions.tagging import segments
from letterloom.operators.bow import bow_counts, bow_vectors, long_texts
from letterloom.functions.names import Trie, keep_longest, portions, tagged
from letterloom.operators.entities import FILTER_BITS, find_entities, read_gazetteer, tag_entities
from letterloom.functions.tokens import counted
from letterloom.operators.lookup import Lookup, hot_keys, lookup_join, measure
from letterloom.operators import ranking
from letterloom.operators.ranking import global_rank, half_split, last_of_first_half
from letterloom.operators.recipients import explode_recipients
from letterloom.operators.records import flat_record, render_message, tidy
from letterloom.operators.tokens import add_lemmas, explode_tokens, filter_tokens, processed_text
from letterloom.operators.vocabulary import build_vocabulary
from letterloom.plans.features import daily_features


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_large_lookup_equals_broadcast(spark, how):
    """One key holds half of the rows; the salted join keeps every one of them."""
    rng = random.Random(1)
    rows = [(i, "hot" if i % 2 else rng.choice(["a", "b", None, "z"])) for i in range(2000)]
    left = spark.createDataFrame(rows, "i int, k string").repartition(5)
    table = measure(spark.createDataFrame([("hot", 1), ("a", 2), ("b", 3)], "k string, n int"))
    assert table.fits and table.rows == 3
    large = Lookup(table.table, table.rows, table.bytes, limit=0)
    small_plan = lookup_join(left, table, "k", how)
    large_plan = lookup_join(left, large, "k", how)
    assert "BroadcastHashJoin" in small_plan._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, small_plan.collect())) == sorted(map(str, large_plan.collect()))


def test_a_frequent_key_is_spread_by_its_share(spark):
    """One word in 30 % of the rows: no task of the join has more than twice the rows of the median task."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")
    kept = {n: spark.conf.get(n) for n in names}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        word = F.when(F.col("id") % 10 < 3, "hot").when(F.col("id") % 97 == 5, None).otherwise(F.concat(F.lit("w"), F.col("id") % 5000))
        left = spark.range(40_000).select("id", word.alias("k"))
        table = left.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k is not null")
        lookup = Lookup(table, 0, 1, limit=0)
        hot = {r["k"]: r["_salts"] for r in hot_keys(left, "k", 16).collect()}
        assert set(hot) == {"hot"} and 30 <= hot["hot"] <= 50
        joined = lookup_join(left, lookup, "k", "left")
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert sum(sizes) == 40_000 and len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]
    finally:
        for n, v in kept.items():
            spark.conf.set(n, v)


def test_counted(column):
    lists = [["b", "a", "b", "é", "b"], [], None, ["x"]]
    assert column(lists, lambda c: F.to_json(counted(c)), "array<string>") == [
        '[{"word":"a","cnt":1},{"word":"b","cnt":3},{"word":"é","cnt":1}]', "[]", "[]", '[{"word":"x","cnt":1}]'
    ]


def test_global_rank(spark):
    keys = random.Random(2).sample(range(10**6), 5000)
    df = spark.createDataFrame([(k, k % 7) for k in keys], "k long, w long").repartition(6)
    ranked = {r["k"]: (r["rank"], r["n"]) for r in global_rank(df, "k", total="n").collect()}
    assert ranked == {k: (i + 1, 5000) for i, k in enumerate(sorted(keys))}
    upto, running = 0, {}
    for k in sorted(keys):
        upto += k % 7
        running[k] = upto
    assert {r["k"]: r["rank"] for r in global_rank(df, "k", weight="w").collect()} == running


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000])
def test_half_split(spark, n):
    df = spark.createDataFrame([(f"k{i:05}",) for i in range(n)], "k string").repartition(4)
    split = sorted((r["k"], r["split"]) for r in half_split(df, "k").collect())
    assert [s for _, s in split] == ["train"] * (n // 2) + ["test"] * (n - n // 2)


@pytest.mark.parametrize("kind", ["even", "hot", "few", "nulls", "words"])
def test_half_split_by_bounds(spark, monkeypatch, kind):
    """Selection in many rounds gives the key that sorting all rows would."""
    monkeypatch.setattr(ranking, "FEW", 5)
    monkeypatch.setattr(ranking, "BOUNDS", 4)
    monkeypatch.setattr(ranking, "SAMPLE", 16)
    rng = random.Random(kind)
    keys = {
        "even": rng.sample(range(10**9), 3001),
        "hot": [rng.randrange(50) if rng.random() < 0.4 else 25 for _ in range(2000)],
        "few": [rng.choice([1, 2, 3]) for _ in range(1000)],
        "nulls": [None if rng.random() < 0.3 else rng.randrange(10**6) for _ in range(1000)],
        "words": ["".join(rng.choices("abé🙂z", k=rng.randint(0, 5))) for _ in range(1500)],
    }[kind]
    df = spark.createDataFrame([(k,) for k in keys], "key string" if kind == "words" else "key long").repartition(3)
    upto, want = sum(k is None for k in keys), None
    for k in sorted({k for k in keys if k is not None}):
        upto += keys.count(k) if kind != "even" else 1
        if upto <= len(keys) // 2:
            want = k
    assert last_of_first_half(df) == (want is not None, want)


def test_half_split_keeps_no_copy_of_all_keys(spark, tmp_path):
    """Keys between two bounds alone are ranked."""
    keys = spark.range(400_000).select(F.xxhash64("id").alias("k"))
    split = half_split(keys, "k")
    assert "checkpoint" not in split._jdf.queryExecution().toString().lower() and "Exchange" not in split._jdf.queryExecution().executedPlan().toString()
    assert {r["split"]: r["count"] for r in split.groupBy("split").count().collect()} == {"train": 200_000, "test": 200_000}


def test_half_split_keeps_hot_key_whole(spark):
    rows = [("a",)] * 10 + [("hot",)] * 60 + [("z",)] * 30
    out = half_split(spark.createDataFrame(rows, "k string"), "k").groupBy("k", "split").count().collect()
    assert {(r["k"], r["split"], r["count"]) for r in out} == {("a", "train", 10), ("hot", "test", 60), ("z", "test", 30)}


def test_vocabulary(spark):
    terms = [" Zeta", "alpha", "ALPHA ", "", "  ", "éclair", "beta"]
    rows = build_vocabulary(spark.createDataFrame([(t,) for t in terms], "term string")).collect()
    want = sorted({t.strip().lower() for t in terms} - {""})
    assert {r["term"]: r["idx"] for r in rows} == {t: i for i, t in enumerate(want)}


def cut_up(text: str) -> list[str]:
    return regex.findall(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+", text)


def brute_places(text: str, names: dict[str, str]) -> list[tuple]:
    """(at, span, size, label) of every name at every place."""
    segs, found = cut_up(text), []
    for surface, label in names.items():
        span = len(cut_up(surface))
        for i in range(len(segs) - span + 1):
            if "".join(segs[i : i + span]) == surface:
                found.append((i, span, len(surface), label))
    return found


def brute_entities(text: str, names: dict[str, str]) -> str:
    segs, kept = cut_up(text), []
    for i, span, _, label in sorted(brute_places(text, names), key=lambda m: (-m[2], m[0])):
        if all(i >= j + s or j >= i + span for j, s, _ in kept):
            kept.append((i, span, label))
    for i, span, label in sorted(kept, reverse=True):
        segs[i : i + span] = [label]
    return "".join(segs)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_entities(spark, limit):
    rng = random.Random(3)
    pool = ["New", "York", "City", "ann", "Bob", "Straße", "x_1", "a"]
    names = {"New York": "GPE", "New York City": "GPE", "York City": "FAC", "Bob": "PERSON", "ann Bob": "ORG",
             "City ann Bob New": "EVENT", "Straße": "LOC", "Bob-ann": "PRODUCT", "a": "LAW"}
    texts = ["".join(rng.choice(pool) + rng.choice([" ", " ", "-", ", ", "  "]) for _ in range(rng.randint(0, 40)))
             for _ in range(120)]
    rows = [(i, t, texts[-i]) for i, t in enumerate(texts)] + [(999, None, "Bob")]
    df = spark.createDataFrame(rows, "i int, one string, two string").repartition(3)
    gazetteer = read_gazetteer(spark.createDataFrame(list(names.items()), "surface string, label string"), limit)
    assert gazetteer.in_row == (limit > 0)
    assert gazetteer.in_row or len(gazetteer.prefixes.value.bits) * 64 == FILTER_BITS[0]
    places = {tuple(r) for r in find_entities(df, ["i"], ["one", "two"], gazetteer).collect()}
    assert places == {(i, f, *p) for i, a, b in rows for f, t in (("one", a), ("two", b)) for p in brute_places(t or "", names)}
    got = {r["i"]: (r["one"], r["two"]) for r in tag_entities(df, ["i"], ["one", "two"], gazetteer).collect()}
    assert got == {i: (a and brute_entities(a, names) if a else a, brute_entities(b, names)) for i, a, b in rows}


def test_entities_of_rows_that_share_a_key(spark):
    gazetteer = read_gazetteer(spark.createDataFrame([("Bob", "PERSON")], "surface string, label string"))
    rows = [(1, "Bob is here"), (1, "there is Bob"), (1, "Bob is here"), (None, "to Bob"), (None, None), (2, "")]
    got = tag_entities(spark.createDataFrame(rows, "k int, text string"), ["k"], ["text"], gazetteer)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(k, t and t.replace("Bob", "PERSON")) for k, t in rows], key=repr)


def test_many_names_in_one_text(spark):
    """50,000 names that overlap, in well under the time that comparing each with each would take."""
    names = {"New York": "GPE", "York New": "LOC", "New York New York": "ORG", "New": "LAW"}
    gazetteer = read_gazetteer(spark.createDataFrame(list(names.items()), "surface string, label string"))
    text = "New York " * 25_000
    tagged(["warm up"], gazetteer.trie.value, gazetteer.longest)
    started = time.monotonic()
    assert tagged([text], gazetteer.trie.value, gazetteer.longest) == ["ORG " * 12_500]
    assert time.monotonic() - started < 2
    assert keep_longest(5, [(0, 3, 9, "a"), (2, 3, 9, "b"), (2, 1, 3, "c"), (3, 1, 3, "d")]) == [(0, 3, "a"), (3, 1, "d")]


def test_entities_move_no_text(spark):
    """No shuffle and one Python step for a gazetteer within its limit; none at all of texts."""
    gazetteer = read_gazetteer(spark.createDataFrame([("Bob", "PERSON")], "surface string, label string"))
    df = spark.createDataFrame([(1, "Bob", "to Bob")], "i int, one string, two string")
    plan = tag_entities(df, ["i"], ["one", "two"], gazetteer)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1


def test_names_beyond_the_limit_move_few_texts(spark):
    """Texts without a candidate stay where they are."""
    gazetteer = read_gazetteer(spark.createDataFrame([("Bob Ray", "PERSON")], "surface string, label string"), 0)
    rows = [(i, "nobody here") for i in range(500)] + [(900, "see Bob Ray"), (901, "see Bob Roy"), (902, None), (903, "Bob")]
    df = spark.createDataFrame(rows, "i int, text string").repartition(3)
    spots = find_entities(df, ["i"], ["text"], gazetteer)
    assert [tuple(r) for r in spots.collect()] == [(900, "text", 2, 3, 7, "PERSON")]
    got = {r["i"]: r["text"] for r in tag_entities(df, ["i"], ["text"], gazetteer).collect()}
    assert got == {i: t and t.replace("Bob Ray", "PERSON") for i, t in rows}


def test_no_names(spark):
    for limit in (0, 1 << 20):
        gazetteer = read_gazetteer(spark.createDataFrame([("!", "x")], "surface string, label string"), limit)
        df = spark.createDataFrame([(1, "Bob")], "i int, text string")
        assert [tuple(r) for r in tag_entities(df, ["i"], ["text"], gazetteer).collect()] == [(1, "Bob")]


def test_segments_join_back(column):
    texts = ["", "a b", "  x--é_1 !", "\n\n"]
    assert column(texts, lambda c: F.array_join(segments(c), "")) == texts


@pytest.fixture(scope="module")
def lookups(spark):
    lemmas = measure(spark.createDataFrame([("was", "be"), ("men", "man")], "token string, lemma string"))
    terms = spark.createDataFrame([(t,) for t in ("man", "horse", "café", "running", "day")], "term string")
    return lemmas, measure(build_vocabulary(terms))


TEXTS = [(1, "Men, horses!", "The men was running 42 days; a horse. Café cafe"), (2, None, ""), (3, "none here", "xyz")]


def test_token_steps(spark, lookups):
    lemmas, vocabulary = lookups
    df = spark.createDataFrame(TEXTS, "id int, subject string, body string")
    tokens = add_lemmas(explode_tokens(df, ("id",), ("subject", "body")), lemmas)
    kept = filter_tokens(tokens, vocabulary).orderBy("id", "field", "pos").collect()
    assert [(r["field"], r["lemma"]) for r in kept if r["id"] == 1] == [
        ("body", "man"), ("body", "running"), ("body", "day"), ("body", "horse"), ("body", "café"),
        ("subject", "man"), ("subject", "horse"),
    ]
    texts = processed_text(df, ("id",), ("subject", "body"), lemmas, vocabulary).collect()
    assert {(r["id"], r["field"]): r["text"] for r in texts} == {
        (1, "subject"): "man horse", (1, "body"): "man running day horse café",
        (2, "subject"): "", (2, "body"): "", (3, "subject"): "", (3, "body"): "",
    }


def test_bow(spark, lookups):
    _, vocabulary = lookups
    texts = spark.createDataFrame([(1, "f", "CAFÉ cafe a day-day horse"), (2, "f", None), (3, "f", "none")], "id int, field string, text string")
    idx = {r["term"]: r["idx"] for r in vocabulary.table.collect()}
    want = Counter({idx["café"]: 2, idx["day"]: 2, idx["horse"]: 1})
    counts = bow_counts(texts, ("id",), vocabulary).collect()
    assert {r["idx"]: r["cnt"] for r in counts} == want and {r["id"] for r in counts} == {1}
    vectors = {r["id"]: (r["indices"], r["values"]) for r in bow_vectors(texts, ("id",), vocabulary).collect()}
    assert vectors == {1: (sorted(want), [float(want[i]) for i in sorted(want)]), 2: ([], []), 3: ([], [])}


def test_bow_vectors_shuffle_tokens_once(spark, lookups):
    """Only counted rows of known words move, and one row for each text."""
    texts = spark.createDataFrame([(1, "body", "horse day unknown " * 500)], "id int, field string, text string")
    vectors = bow_vectors(texts, ("id",), lookups[1])
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(id#") == 1 and plan.count("posexplode") == 1
    assert [r["values"] for r in vectors.collect()] == [[500.0, 500.0]]
    assert bow_counts(texts, ("id",), lookups[1]).count() == 2


def test_daily_features_with_repeated_ids(spark, lookups):
    """A message id that repeats must not merge its messages."""
    lemmas, vocabulary = lookups
    rows = [("same", "men", "horse horse")] * 5 + [("other", "day", "")]
    placed = [("t", n % 2, n, *row) for n, row in enumerate(rows)]
    schema = "topic string, partition int, offset long, message_id string, subject string, body string"
    features = daily_features(spark.createDataFrame(placed, schema), vocabulary, lemmas, dt.date(2024, 1, 1))
    out = features.collect()
    assert len(out) == 12
    names = {(r["row_id"], r["message_id"]) for r in out}
    assert names == {(f"t/{n % 2}/{n}", row[0]) for n, row in enumerate(rows)}
    again = daily_features(spark.createDataFrame(placed[::-1], schema), vocabulary, lemmas, dt.date(2024, 1, 1))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out))
    assert Counter(r["split"] for r in out) == {"train": 6, "test": 6}
    assert sum(sum(r["values"]) for r in out) == 5 * 3 + 1


def test_records(spark):
    row = ("m", dt.datetime(2024, 1, 2, 3, 4, 5), "a@b.c", ["x@y.z", "u@v.w"], None, ["", ""], "s", "body ")
    schema = ("message_id string, date timestamp, from_address string, to_addresses array<string>, "
              "cc_addresses array<string>, bcc_addresses array<string>, subject string, body string")  # fmt: skip
    flat = flat_record(spark.createDataFrame([row], schema))
    assert tuple(flat.first()) == ("m", "2024-01-02 03:04:05", "a@b.c", "x@y.z, u@v.w", "", "", "s", "body ")
    table = spark.createDataFrame([("m", None, None, "x@y.z", "", "", "s", "body ")], "message_id string, date timestamp, from_address string, to_addresses string, cc_addresses string, bcc_addresses string, subject string, body string")
    assert render_message(table).first()["eml"] == (
        "Message-Id: m\nDate: \nFrom: \nTo: x@y.z\nCc: \nBcc: \nSubject: s\n\nbody"
    )


def test_tidy(spark):
    df = spark.createDataFrame([("a", "b"), ("", "b"), (None, "b"), ("a", "")], "subject string, body string")
    assert [tuple(r) for r in tidy(df, ["subject", "body"]).collect()] == [("a", "b")]


def test_recipients(spark):
    df = spark.createDataFrame([(1, "a@b.cd, x, e@f.gh", None, "i@j.kl")], "id int, t string, c string, b string")
    rows = explode_recipients(df, "id", to="t", cc="c", bcc="b").collect()
    assert {(r["role"], r["pos"], r["address"]) for r in rows} == {("to", 0, "a@b.cd"), ("to", 1, "e@f.gh"), ("bcc", 0, "i@j.kl")}


def test_vectors_in_the_row_equal_joined_ones(spark, lookups):
    """Vocabularies that fit are looked up in the text's row: no join, a row per text shuffled, the same vectors."""
    lemmas, vocabulary = lookups
    large = [Lookup(lookup.table, lookup.rows, lookup.bytes, 0) for lookup in lookups]
    texts = [(1, "Foxes, men & dogs. Men!", None), (2, "", "horse " * 300 + "days"), (2, "day", "mens horse 12 the"), (None, "café", "x"), (None, None, "cafe running")]
    rows = spark.createDataFrame(texts, "id long, subject string, body string").repartition(3)
    shape = lambda df: df._jdf.queryExecution().executedPlan().toString()
    by = lambda df: sorted(map(tuple, df.collect()), key=repr)
    long = long_texts(rows, ("id",), ("subject", "body"))
    got = bow_vectors(long, ("id",), vocabulary, in_row=True)
    assert by(got) == by(bow_vectors(long, ("id",), large[1])) and got.count() == 6
    assert "posexplode" not in shape(got)
    days = [daily_features(rows, v, w, dt.date(2024, 1, 1), key="id", unique=True) for w, v in (lookups, large)]
    assert by(days[0]) == by(days[1]) and days[0].count() >= 6
    assert "posexplode" not in shape(days[0]) and "Join" not in shape(days[0])


def test_texts_are_tagged_a_portion_at_a_time():
    """The segments of a batch are never all held, and portions change no text."""
    texts = [None, "", "x" * 50, *["Ann met Bob Lee, " * 20] * 30, "Ann"]
    assert [texts[p] for p in portions(texts, 400)][0] == texts[:4]
    assert [t for p in portions(texts, 400) for t in texts[p]] == texts
    assert max(sum(len(t or "") for t in texts[p]) for p in portions(texts, 400)) <= 400
    assert [t for p in portions([]) for t in p] == []
    trie = Trie.of(["Ann", "Bob Lee"], ["P", "Q"])
    long = ["Ann met Bob Lee, " * 20_000] * 12
    tracemalloc.start()
    assert tagged(long, trie, 3) == ["P met Q, " * 20_000] * 12
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
