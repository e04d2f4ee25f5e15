import hashlib
import random
import struct

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tessera.llm import sentencepiece_codec
from tessera.llm.sentencepiece_codec import Codec, digests, encode_documents, read_model

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec():
    return Codec(read_model(PATH))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def unpacked(ids):
    return list(struct.unpack(f"<{len(ids) // 4}I", ids))


def check(codec, library, text):
    ids, decoded = codec.encode(text)
    want = library.encode(text, add_bos=True, add_eos=True)
    assert unpacked(ids) == want, text[:80]
    assert decoded == library.decode(want) == codec.decode(unpacked(ids))


def test_runs_of_one_character(codec, library):
    for n in range(0, 70):
        for c in (" ", "▁", "\n", "\t", "=", "a", "é", "𠮷"):
            check(codec, library, c * n)
            check(codec, library, "a" + c * n + "b")


def test_random_texts(codec, library):
    rng = random.Random(4)
    alphabet = "abcdefghijklmnop eeetttaaa  \n\t.,;:<>#!0123456789éèñüß日本𠮷▁\x00  "
    for _ in range(4000):
        check(codec, library, "".join(rng.choice(alphabet) for _ in range(rng.randrange(50))))


def test_whole_table_equals_the_library(spark, documents, library):
    want = {}
    for r in documents.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        text = library.decode(ids)
        want[r.doc_id] = (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    df = digests(encode_documents(documents, read_model(PATH)))
    assert df.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {r.doc_id: tuple(r)[1:] for r in df.collect()} == want


def test_nulls_long_texts_repeated_rows_and_clashing_columns(make_docs, library):
    texts = [None, "", "one two", "one two", "x" * 30_000 + " " + "long words " * 20_000]
    docs = make_docs(texts, ids=[1, None, 3, 3, 4]).withColumns({"ids": F.lit("i"), "n_tokens": F.lit(0), "decoded": F.lit("d")})
    rows = encode_documents(docs, read_model(PATH)).collect()
    assert len(rows) == 5
    for r in rows:
        want = library.encode(r.row.text or "", add_bos=True, add_eos=True)
        assert r.n_tokens == len(want) and unpacked(r.ids) == want and r.decoded == library.decode(want)
        assert r.row["ids"] == "i" and r.row["n_tokens"] == 0
    assert encode_documents(docs.limit(0), read_model(PATH)).count() == 0


def test_words_are_remembered_for_two_generations(monkeypatch, library):
    """What a full memory drops is only what was not met since the last time; ids and texts stay those of the library."""
    monkeypatch.setattr(sentencepiece_codec, "_MAX_WORDS", 20)
    monkeypatch.setattr(sentencepiece_codec, "_MAX_PAIRS", 20)
    c = Codec(read_model(PATH))
    for n in range(40):
        text = f"the word zq{n}x{n * 7} of\u0001 a  memory{'a' * n} 世界"
        ids, decoded = c.encode(text)
        want = library.encode(text, add_bos=True, add_eos=True)
        assert unpacked(ids) == want and decoded == library.decode(want)
        assert "▁the" in c.known
    assert c.older and len(c.known) + len(c.older) <= 60


def test_short_texts_merge_as_long_ones(monkeypatch):
    c = Codec(read_model(PATH))
    texts = ["▁interesting", "aaaaaaa", "▁▁▁x", "", "q", "zzyzx-9", "▁unbelievably"]
    short = [c._merged_short(t) for t in texts]
    monkeypatch.setattr(sentencepiece_codec, "_SHORT", -1)
    assert [c.merged(t) for t in texts] == short
