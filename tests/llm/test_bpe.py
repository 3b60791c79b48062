"""Byte-level BPE against the tokenizer library, on words and texts that its
classes, added tokens and white space make awkward."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "A", " ", "  ", "\n", "\r\n", "é", "中", "\U0001F600", "'s", "'re", "'S", "1", "12", "١", "!",
          "--", "՘", " ", "\t", "\x00", "\x1c", "e", "th", "ing", "<|endoftext|>", "<|endoftext", "　", "\x85",
          "\xa0", "aaaa", "====", "\U00031350", "ᲊ", "�"]


@pytest.fixture(scope="module")
def model():
    return bpe.load_model(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _texts():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 40))) for _ in range(4000)]
    texts += ["".join(chr(rnd.choice([rnd.randint(0, 127), rnd.randint(0, 0x2FF), rnd.randint(0, 0xD7FF),
                                      rnd.randint(0xE000, 0x10FFFF)])) for _ in range(rnd.randint(0, 30)))
              for _ in range(4000)]
    for letters in ("ab", "etaoinshr", "0123456789"):
        texts += ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    return texts + [c * k for c in "=a -\n" for k in range(200)] + ["x" * 20_000, "word " * 30_000, " lead", "trail "]


def test_encoding_and_decoding_equal_the_library(model, library):
    texts = _texts()
    encoder = bpe.Encoder(model)
    coded = [c for part in bpe.slices([t.encode() for t in texts], 20_000)
             for c in encoder.encode([t.decode() for t in part])]
    for text, ids, ref in zip(texts, coded, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == ref.ids, text
        assert bpe.decode(ids, model.bytes_of) == library.decode(ref.ids, skip_special_tokens=False)


def test_small_caches_change_nothing(model, monkeypatch):
    texts = [t for t in _texts() if len(t) < 500][:2000]
    want = bpe.Encoder(model).encode(texts)
    monkeypatch.setattr(bpe, "_CACHE_CHUNKS", 50)
    monkeypatch.setattr(bpe, "_LONG_CHUNK", 3)
    encoder = bpe.Encoder(model)
    assert [i for at in range(0, len(texts), 7) for i in encoder.encode(texts[at:at + 7])] == want


def test_fits_agrees_with_plain_merging(model):
    rnd = random.Random(2)
    tokens = [i for i in model.size_of if model.size_of[i] <= 6]
    for _ in range(4000):
        a, b = rnd.choice(tokens), rnd.choice(tokens)
        assert model.fits(a, b) == (model.merge(model.bytes_of[a] + model.bytes_of[b]) == [a, b])


def test_shared_prefixes_are_worked_out_once(model):
    words = sorted({w.encode() for w in ("car", "care", "cart", "cat", "dog", "do", "carefully")})
    trie = bpe.insert(words)
    assert [w for _, w in trie] == words
    new_nodes = sum(len(w) - fork for fork, w in trie)
    assert new_nodes == len({w[:i] for w in words for i in range(1, len(w) + 1)})
    assert {w: ids for w, ids in bpe.walk(trie, model)} == {w: model.merge(w) for w in words}


def test_frames(spark, model, library):
    rows = [(1, "Hello  world's\né<|endoftext|>", "k"), (2, None, "k"), (3, "", "k"), (None, "x " * 5000, "k"),
            (1, "Hello  world's\né<|endoftext|>", "k"), (1, "other", "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    coded = bpe.encode_texts(docs, model)
    assert coded.columns == ["doc_id", "ids"]
    want = sorted(((d, library.encode(t or "", add_special_tokens=False).ids, t or "") for d, t, _ in rows), key=str)
    got = sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.text) for r in bpe.decode_ids(coded, model).collect()),
                 key=str)
    assert got == want
    both = bpe.encode_texts(docs, model, decoded=True)
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.text) for r in both.collect()), key=str) == want
    assert bpe.encode_texts(docs.limit(0), model, decoded=True).count() == 0
    broken = spark.createDataFrame([(1, bytearray(b"a\xff\xc3"))], "doc_id int, text binary")
    assert bpe.encode_texts(broken, model, decoded=True).first().text == "a��"
    assert docs.select(F.max("doc_id")).first()[0] == 3


def test_chunks_of_a_slice_before_are_not_worked_out_again(model, monkeypatch):
    encoder, walked = bpe.Encoder(model), []
    insert = bpe.insert
    monkeypatch.setattr(bpe, "insert", lambda words: insert(walked.append(len(w := list(words))) or w))
    first, other = [" ".join(f"{i:x}q" for i in range(at, at + 180_000)) for at in (0, 180_000)]
    ids = encoder.encode([first])
    encoder.encode([other])
    assert encoder.encode([first]) == ids and walked[2] == 0
