import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from tessera.llm.word_bpe import Memory, WordBpe, digests, encode_documents, read_tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def codec():
    return WordBpe(read_tokenizer(PATH))


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def check(codec, library, texts):
    found = codec.encode_batch(texts)
    for text, ids, want in zip(texts, found, library.encode_batch(texts, add_special_tokens=False), strict=True):
        got = np.frombuffer(ids, dtype=np.int32).tolist()
        assert got == want.ids, text[:80]
        assert codec.decode(got) == library.decode(want.ids, skip_special_tokens=False)


def test_runs_of_one_character(codec, library):
    for c in ("a", " ", "=", "é", "𠮷", "1", "😂", "\n", "'", "s", "́"):
        check(codec, library, [c * n for n in range(60)] + ["a" + c * n + "b" for n in range(60)])


def test_random_texts(codec, library):
    rng = random.Random(13)
    plain = "abcdefghijklmnop eeetttaaa  \n\t.,;:<>#!0123456789'sreve"
    hostile = "éèñüßÀΣςİıﬁ日本𠮷😂́ͅ\x00\x1c\x85  ​Ａ가각ᄀ" + plain
    for alphabet, size in ((plain, 60), (hostile, 40)):
        check(codec, library, ["".join(rng.choice(alphabet) for _ in range(rng.randrange(size))) for _ in range(6000)])


def test_words_of_joined_tokens(codec, library):
    """Texts of tokens that often merge across their border: the verification must refuse them."""
    rng = random.Random(5)
    tokens = [t.removesuffix("</w>") for t in library.get_vocab() if re.fullmatch("[a-z]+(</w>)?", t)]
    texts = ["".join(rng.choice(tokens) for _ in range(rng.randrange(1, 6))) for _ in range(20_000)]
    check(codec, library, texts)
    codec.runs, codec.spelled = Memory(), Memory()
    symbols = [[codec.symbol[ord(c)] for c in t[:-1]] + [codec.symbol[512 + ord(t[-1])]] for t in texts[:500]]
    merged = [codec.ids[codec.merged(s)].tolist() for s in symbols]
    assert merged == [codec.encode(t) for t in texts[:500]]


def test_pairs_are_refused_exactly_when_their_symbols_merge_otherwise(codec):
    rng = np.random.default_rng(3)
    sound = np.unique(codec.token_at[codec.token_at >= 0])
    inner = np.array([t for t in sound if not codec.decode([codec.ids[t]]).endswith("</w>")])
    first, second = rng.choice(inner, 4000), rng.choice(sound, 4000)

    def spelled(t):
        return [t] if codec.left[t] == t else spelled(codec.left[t]) + spelled(codec.right[t])

    want = [codec.merged([int(s) for s in spelled(a) + spelled(b)]) == [a, b] for a, b in zip(first, second, strict=True)]
    assert codec.compatible(first, second).tolist() == want
    assert 0 < sum(want) < len(want)


def test_special_tokens_in_a_text(codec, library):
    end = "<|endoftext|>"
    check(codec, library, [end, f"a{end}b", f"{end}{end}", f"e{end}́", "<|endoftext|", f" {end} <|startoftext|>x", end.upper()])


def test_every_code_point(codec, library):
    check(codec, library, [f"a{chr(c)}b {chr(c)}" for c in range(0x3000) if not 0xD800 <= c < 0xE000])


def test_whole_table_equals_the_library(spark, documents, library):
    want = {}
    for r in documents.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        joined = " ".join(map(str, ids))
        want[r.doc_id] = (len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    df = digests(encode_documents(documents, read_tokenizer(PATH)))
    assert df.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {r.doc_id: tuple(r)[1:] for r in df.collect()} == want


def test_nulls_long_texts_repeated_rows_and_clashing_columns(make_docs, library):
    texts = [None, "", "one two", "one two", "x" * 30_000 + " " + "ab" * 150_000 + " " + "long words " * 20_000]
    docs = make_docs(texts, ids=[1, None, 3, 3, 4]).withColumns({"ids": F.lit("i"), "row": F.lit(0), "decoded": F.lit("d")})
    rows = encode_documents(docs, read_tokenizer(PATH)).collect()
    assert len(rows) == 5
    for r in rows:
        want = library.encode(r.row.text or "", add_special_tokens=False).ids
        assert r.ids == want and r.decoded == library.decode(want, skip_special_tokens=False)
        assert r.row["ids"] == "i" and r.row["row"] == 0
    assert encode_documents(docs.limit(0), read_tokenizer(PATH)).count() == 0


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError):
        WordBpe(read_tokenizer(public_tokenizers.path("byte_bpe_50k.json")))
