from __future__ import annotations

import random

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as schema

from letterloom.llm.pieces import Normaliser, Pieces, encode_pieces
from letterloom.llm.queries import PIECE_MODEL

PARTS = ["a", "Wort", " ", "  ", "\n", "é", "🙂", "▁", "x.", "\x00", "<s>", "<0x41>", "ﬁ", "ｱ", "　", "\t", "é", "Ⅷ"]


def made(seed, count=200):
    rng = random.Random(seed)
    return ["", " ", "▁", *["".join(rng.choices(PARTS, k=rng.randint(1, 25))) for _ in range(count)]]


def test_documents(docs, texts, no_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    got = {r["doc_id"]: r for r in encode_pieces(docs, PIECE_MODEL).collect()}
    for k, t in texts:
        if k not in (0, None):
            ids = library.encode(t or "")
            assert (got[k]["ids"], got[k]["decoded"]) == (ids, library.decode(ids))
            assert len(got[k]["ends"]) == len(ids) and (not ids or got[k]["ends"][-1] == len(t.encode()))
    assert encode_pieces(no_docs, PIECE_MODEL).collect() == []


def test_spans_are_the_library_s():
    pieces = Pieces(PIECE_MODEL)
    for text in made(1):
        ids, ends = pieces.encode(text)
        assert ids.tolist() == pieces.model.encode(text)
        data, starts = text.encode(), [0, *ends.tolist()[:-1]]
        rebuilt = b"".join(data[a:b] for a, b in zip(starts, ends.tolist()))
        assert rebuilt == (data if len(ids) else b"")
        for k, a, b in zip(ids.tolist(), starts, ends.tolist()):
            if not pieces.model.is_byte(k):
                shown = pieces.model.id_to_piece(k).replace("▁", " ")
                # the added space covers nothing
                assert data[a:b].decode().replace("▁", " ") in (shown, shown[1:] if a == 0 else shown)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("squeeze", [False, True])
def test_normaliser_follows_compiled_maps(rule, squeeze):
    library = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=False, escape_whitespaces=False, remove_extra_whitespaces=squeeze
    )
    proto = schema.ModelProto()
    proto.ParseFromString(library.serialized_model_proto())
    own = Normaliser(proto.normalizer_spec)
    own.prefix, own.escape, own.squeeze = False, False, squeeze
    for text in made(2):
        value, borders = own(text.encode())
        assert value.decode() == library.normalize(text)
        assert len(borders) == len(value) + 1 and (np.diff(borders) >= 0).all() and borders[-1] <= len(text.encode())
