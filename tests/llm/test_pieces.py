from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from silsila.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.load_model(PATH)


def odd_texts():
    random.seed(1)
    signs = list("aaabbcdeehilnorst  \n\t▁éß中日本\U0001f600\x00<>0x41")
    yield from ("", " ", "  ", " a", "a ", "▁", "a▁▁b", "<s> hi <unk> </s>", "<0x41>", "ab" * 3000, "a b" * 500, " " * 5000 + "b")
    yield from (" " * k + "a" + " " * (k // 2) for k in range(150))
    yield from (c * k for c in "a-=*.\n#é" for k in (1, 2, 3, 5, 17, 33, 64, 100, 257))
    yield from ("".join(random.choice(signs) for _ in range(random.randint(0, 40))) for _ in range(5000))
    yield from ("".join(random.choice("ab") for _ in range(random.randint(0, 200))) for _ in range(500))


def test_ids_and_round_trip(library, model, texts):
    encoder = pieces.PieceEncoder(model, remember=2000)                 # forgets often
    some = [*texts.values(), *odd_texts()]
    for low in range(0, len(some), 700):
        part = some[low:low + 700]
        for text, (n, ids, decoded), want in zip(part, encoder.encode(part), library.encode(part, num_threads=1)):
            assert ids == ",".join(map(str, want)) and n == len(want)
            assert decoded == library.decode(want)


def test_decoding_broken_bytes(library, model):
    ids = [model.byte_id[0xE4], model.byte_id[0xB8]]
    assert set(pieces.decode(model, ids)) == {"�"}
    assert pieces.decode(model, [1, *library.encode("a b"), 2]) == " a b"


def test_rows(odd, nothing, library):
    got = [tuple(r) for r in pieces.encode_documents(odd, PATH).collect()]
    want = []
    for r in odd.collect():
        ids = library.encode(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert pieces.encode_documents(nothing, PATH).count() == 0
