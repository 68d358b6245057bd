from __future__ import annotations

import hashlib
import json
import random
import time

import numpy as np
import pytest
from public_tokenizers import PATTERN
from tokenizers import Tokenizer

from letterloom.llm.byte_pairs import BytePairs, byte_symbols, encode_byte_pairs, merge
from letterloom.llm.common import table
from letterloom.llm.queries import BYTE_BPE, op13_byte_pairs

FILE = BYTE_BPE["tokenizer_json"]
PARTS = ["a", "b", "the", " the", " ", "  ", "\n", "\t", "'s", " 've", "é", "🙂", "<|endoftext|>", "<|endof", "1", "23", "...", "　", "\x85", "\x1c", "\x00"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def pairs():
    return BytePairs(FILE, PATTERN, cached=40)


def plain_merge(symbols, ranks):
    """All pairs looked at anew for each merge."""
    while True:
        found = [(ranks[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        if not found:
            return symbols
        at = min(found)[1]
        symbols = [*symbols[:at], ranks[symbols[at], symbols[at + 1]][1], *symbols[at + 2 :]]


def test_merges_follow_rank_and_place():
    rng = random.Random(2)
    for _ in range(300):
        pool = [(a, b) for a in range(8) for b in range(8)]
        chosen = rng.sample(pool, 12)
        ranks = {p: (rank, 4 + rank % 4) for rank, p in enumerate(chosen)}
        symbols = [rng.randrange(4) for _ in range(rng.randint(0, 40))]
        assert merge(list(symbols), ranks) == plain_merge(list(symbols), ranks)


def test_every_byte_has_a_symbol():
    assert len(set(byte_symbols())) == 256
    assert set(byte_symbols()) <= set(json.load(open(FILE, encoding="utf-8"))["model"]["vocab"])


def test_texts_as_the_library(pairs, library):
    rng = random.Random(1)
    for text in ["", *("".join(rng.choices(PARTS, k=rng.randint(1, 30))) for _ in range(3000))]:
        ids = pairs.encode(text)
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert pairs.decode(ids) == text


def test_every_kind_of_character(pairs, library):
    """Each 7th code point beside letters, digits, spaces and itself."""
    points = [c for c in range(0, 0x110000, 7) if not 0xD800 <= c <= 0xDFFF]
    texts = [f"a{chr(c)}b {chr(c)} c1{chr(c)}1  {chr(c)}{chr(c)} ." for c in points]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert pairs.encode(text).tolist() == want.ids


def test_any_ids_decode_as_in_the_library(pairs, library):
    rng = random.Random(4)
    for _ in range(500):
        ids = [rng.randrange(50_257) for _ in range(rng.randint(0, 20))]
        assert pairs.decode(np.array(ids, np.uint32)) == library.decode(ids, skip_special_tokens=False)


def test_a_long_word_takes_little_more_than_its_length(pairs, library):
    text = "ab" * 100_000
    started = time.monotonic()
    ids = pairs.encode(text)
    assert time.monotonic() - started < 20
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_other_models_raise(tmp_path):
    spec = json.load(open(FILE, encoding="utf-8"))
    spec["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "other.json").write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError):
        BytePairs(str(tmp_path / "other.json"), PATTERN)


def test_documents(docs, texts, no_docs, library):
    got = [(r["doc_id"], r["ids"], r["decoded"]) for r in encode_byte_pairs(docs, FILE, PATTERN).collect()]
    want = [(k, library.encode(t or "", add_special_tokens=False).ids, t or "") for k, t in texts]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert encode_byte_pairs(no_docs, FILE, PATTERN).collect() == []
    assert encode_byte_pairs(docs, FILE, PATTERN, decoded=False).columns == ["doc_id", "ids"]


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in op13_byte_pairs(spark, sf).collect()}
    rows = table(spark, sf, "documents").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        told = got[r["doc_id"]]
        assert told["n_tokens"] == len(ids)
        assert told["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert told["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
