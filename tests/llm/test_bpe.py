import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from provena.llm.bpe import WordBpe, bpe_decode, bpe_encode
from provena.llm.queries import tokenizer_path

from ..conftest import SF_SMALL
from .cases import no_docs, odd_docs


@pytest.fixture(scope="module")
def own():
    with open(tokenizer_path(), "rb") as f:
        return WordBpe(f.read())


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


def ids(b):
    return np.frombuffer(b, "<u4").tolist()


def test_odd_strings_as_the_library(own, library):
    rng = random.Random(1)
    alphabet = "abcdefghij thequicking ''sdtrellvem 0123 <|endoftext|> ΣσİıßÉé́ü \x1c\x85 \x01\0😀漢字 \t\n!!??..."
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(rng.choice("aehnrt") for _ in range(rng.randint(1, 14))) for _ in range(5000)]
    texts += ["", "a<|endoftext|>b", "<|startoftext|><|endoftext|>", "a" * 3000, "\n<|endoftext|>", "\0"]
    want = library.encode_batch_fast(texts, add_special_tokens=False)
    for t, a, b in zip(texts, own.encode(texts), want):
        assert ids(a) == b.ids, t
        assert own.decode(a).decode() == library.decode(b.ids, skip_special_tokens=False)


def test_compatibility_is_what_merging_says(own):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, own.size - 2, 4000), rng.integers(0, own.size - 2, 4000)
    back = {c: i for i, c in enumerate(__import__("provena.llm.bpe", fromlist=["x"]).byte_alphabet())}
    inner = [i for i in range(4000) if not own.texts[a[i]].endswith(own.end)]
    got = own._test_pairs(a[inner], b[inner])
    for i, ok in zip(inner, got):
        symbols = own._symbols(own.texts[a[i]], back) + own._symbols(own.texts[b[i]], back)
        merged, _ = own._merge(own.base[np.array(symbols)], np.array([0, len(symbols)]))
        assert (merged.tolist() == [a[i], b[i]]) == ok


def test_table(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = bpe_decode(bpe_encode(docs, tokenizer_path()), tokenizer_path()).collect()
    assert len(out) == docs.count()
    for r in out:
        want = library.encode(r.text, add_special_tokens=False).ids
        assert ids(r.token_ids) == want and r.n_tokens == len(want)
        assert r.decoded == library.decode(want, skip_special_tokens=False)


def test_odd_rows(spark, library):
    out = bpe_decode(bpe_encode(odd_docs(spark), tokenizer_path()), tokenizer_path()).collect()
    assert len(out) == 13
    for r in out:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert ids(r.token_ids) == want and r.decoded == library.decode(want, skip_special_tokens=False)
    assert bpe_encode(no_docs(spark), tokenizer_path()).count() == 0
