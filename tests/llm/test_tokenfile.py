import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from provena.llm.queries import op5_token_files, tokenizer_path
from provena.llm.tokenfile import BLOCK, FileReader, FileWriter, decode_blocks, encode_blocks, read_token_files, token_folder, write_token_files

from ..conftest import SF_SMALL
from .cases import no_docs, odd_docs


def test_blocks():
    rng = np.random.default_rng(0)
    for top in (1, 2, 300, 49408, 2**32 - 1):
        v = rng.integers(0, top, 4 * BLOCK, dtype=np.uint64).astype(np.uint32)
        v[::97] = 0
        v[5] = 2**32 - 1  # an outlier goes to the exception list
        parts = encode_blocks(v)
        assert (decode_blocks(b"".join(parts), np.cumsum([0, *map(len, parts[:-1])])) == v).all()


def test_random_access(tmp_path):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50_000, int(n)).astype(np.uint32) for n in rng.integers(0, 5000, 60)] + [np.zeros(0, np.uint32)]
    w = FileWriter(str(tmp_path), "a.pfor")
    for i, d in enumerate(docs):
        w.add(i, d)
    assert w.close() == (61, sum(map(len, docs)))
    r = FileReader(str(tmp_path), "a.pfor")
    for i in (0, 17, 59, 60):
        assert (r.ids(int(r.first[i]), int(r.first[i] + r.count[i])) == docs[i]).all()
    (tmp_path / "b.pfor").write_bytes((tmp_path / "a.pfor").read_bytes()[:-1])
    with pytest.raises(ValueError):
        FileReader(str(tmp_path), "b.pfor")


def test_query_as_the_library(spark):
    t = Tokenizer.from_file(tokenizer_path())
    at = 0
    got = {r.doc_id: r for r in op5_token_files(spark, SF_SMALL).collect()}
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect():
        ids = [*t.encode(r.text, add_special_tokens=False).ids, 2]
        g = got[r.doc_id]
        assert (g.start, g.n_tokens, g.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


@pytest.mark.parametrize("encoder", ["own", "library"])
def test_odd_rows(spark, encoder):
    t = Tokenizer.from_file(tokenizer_path())
    folder = token_folder(spark)
    got = read_token_files(write_token_files(odd_docs(spark), tokenizer_path(), folder, files=3, encoder=encoder), folder).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 0, 1, 2, 3, 4, 5, 6, 6, 7, 8, 9]
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()
    text = {r.doc_id: r.text for r in odd_docs(spark).where("doc_id IS NOT NULL").collect()}
    for r in got[2:]:
        assert np.frombuffer(r.token_ids, "<u4").tolist() == [*t.encode(text[r.doc_id] or "", add_special_tokens=False).ids, 2]
    empty = token_folder(spark)
    assert read_token_files(write_token_files(no_docs(spark), tokenizer_path(), empty), empty).count() == 0
