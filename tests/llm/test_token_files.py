import os
import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from obligato.llm import token_files
from obligato.llm.common import table
from obligato.llm.queries import op10_token_files

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
ODD = ["Don't, STOP. x'l, <|endoftext|>, A<|startoftext|>b FOO Bar. <|ENDOFTEXT|>", "İstanbul, ΣΑΣ. ΟΔΟΣ á, e b. c, Éa É. ﬁ, Å. K ½ x² ⅷ",
       "1,234.5, ...,. é., \x01 a\x01b, foo\x1cbar, a b c d\u0085e", "", None, " \t\n", "a,b.c, d., it's, we'LL. 'tis '. ''", "w###, ***x*** foo-bar (baz) [q]? \"hi!\"",
       "日本語 テスト, ไทย кириллица. 🙂🙂, 🇩🇪.", "word " * 30_000]


@pytest.fixture(scope="module")
def tokenizer_json():
    with open(public.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def tokenizer(tokenizer_json):
    return tokenizers.Tokenizer.from_str(tokenizer_json)


def test_word_by_word_gives_the_ids_of_the_whole_text(tokenizer_json, monkeypatch):
    rng = random.Random(1)
    alphabet = "abcXYZéßñÇö 0123.,'#*-\"!?\n\t́|<>"
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randint(0, 200))) for _ in range(400)]
    data = [None if t is None else t.encode() for t in texts]
    whole, words = token_files.Encoder(tokenizer_json), token_files.Encoder(tokenizer_json, split_words=True)
    monkeypatch.setattr(token_files, "CACHE", 50)  # several generations
    for i in range(0, len(data), 16):
        some = pa.array([None, *data[i:i + 16]], pa.binary())[1:]
        (a, m), (b, n) = words(some), whole(some)
        assert a.tolist() == b.tolist() and m.tolist() == n.tolist() and len(n) == len(some)


@pytest.mark.parametrize("split_words", [True, False])
def test_matches_brute_force(spark, tmp_path, monkeypatch, tokenizer_json, tokenizer, split_words):
    monkeypatch.setattr(token_files, "FILE_BYTES", 20_000)
    rows = [(i * 7 % 31, t) for i, t in enumerate(ODD)] + [(100, "same"), (100, "same"), (None, "none"), (-4, "minus"), (None, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start int").repartition(3)
    token_files.write_token_files(df, tokenizer_json, str(tmp_path / "t"), 2, split_words)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(spark, str(tmp_path / "t")).collect()]
    assert sorted(got, key=lambda r: r[1]) == brute.tokens(rows, tokenizer)


def test_sequences_are_read_in_place(tmp_path):
    ids = np.arange(10_000, dtype="<u2")
    content = token_files.to_file(3, pa.array([5, None], pa.int64()), [4000, 6000], ids, length=128, batch=16)
    path = tmp_path / "f"
    path.write_bytes(content + b"\n")
    mapped = pa.memory_map(str(path)).read_buffer()
    before = pa.total_allocated_bytes()
    number, sequences, docs = token_files.from_file(mapped)
    assert (number, docs.to_pydict()) == (3, {"doc_id": [5, None], "n_tokens": [4000, 6000]})
    column = sequences.column("ids")
    assert all(len(c) == 16 for c in column.chunks[:-1])
    for at in (0, 17, 77):
        view = column.chunk(at // 16).flatten().to_numpy(zero_copy_only=True)[at % 16 * 128:][:128]
        assert not view.flags.owndata and (view == ids[at * 128:][:128]).all()
        base = column.chunk(at // 16).flatten().buffers()[1]
        assert mapped.address <= base.address < mapped.address + mapped.size
    assert pa.total_allocated_bytes() - before < 4096
    mask = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in sequences.column("mask").chunks])
    assert mask.sum() == 10_000 and not mask[10_000:].any() and len(mask) % 128 == 0
    assert (token_files.token_ids(sequences) == ids).all()


def test_empty_table(spark, tmp_path, tokenizer_json):
    df = spark.createDataFrame([], "doc_id long, text string")
    token_files.write_token_files(df, tokenizer_json, str(tmp_path / "t"), 2, True)
    assert token_files.read_token_files(spark, str(tmp_path / "t")).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_query_on_given_documents(spark, tokenizer):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in op10_token_files(spark, SF).collect()]
    assert sorted(got) == brute.tokens(rows, tokenizer)
