import base64
import random

import numpy as np
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from navlake.llm import bpe
from llm_odd import ODD


@pytest.fixture(scope="module")
def library():
    with open(bpe.RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check(frame, library, text_of):
    ranks = bpe.read_ranks(frame.sparkSession)
    rows = bpe.encode(frame, ranks, decoded=True).withColumn("back", bpe.decode(F.col("ids"), ranks)).collect()
    for r in rows:
        text = text_of(r) or ""
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(text)
        assert bytes(r["back"]) == bytes(r["decoded"]) == text.encode()
    return len(rows)


def test_odd_rows(odd, library):
    assert check(odd, library, lambda r: r["text"]) == len(ODD)


def test_given(given, library):
    assert check(given, library, lambda r: r["text"]) == given.count()


@pytest.mark.parametrize("chunk, overlap", [(40, 12), (200, 60), (1000, 300)])
def test_chunks_of_long_texts(docs_of, library, monkeypatch, chunk, overlap):
    monkeypatch.setattr(bpe, "CHUNK", chunk)
    monkeypatch.setattr(bpe, "OVERLAP", overlap)
    rng = random.Random(chunk)
    texts = ["".join(rng.choices("ab  \n\t'stre12é世🙂., ", k=n)) for n in (chunk, chunk + 1, 3000, 5000)]
    texts += ["a" * 3000, " " * 3000 + "b", "don't " * 600, "x" * (chunk * 2) + " y" * 500 + "1" * (chunk * 3), texts[3]]
    frame = docs_of(*enumerate(texts))
    assert check(frame, library, lambda r: texts[r["doc_id"]]) == len(texts)


def test_cuts_are_where_scans_meet(docs_of, monkeypatch, spark):
    monkeypatch.setattr(bpe, "CHUNK", 50)
    monkeypatch.setattr(bpe, "OVERLAP", 20)
    rows = [(b"a", "word and word " * 30), (b"b", "a" * 400)]
    pieces = bpe._pieces(spark.createDataFrame(rows, "same binary, text string")).collect()
    of = lambda key: [p["piece"] for p in sorted(pieces, key=lambda p: p["number"]) if bytes(p["same"]) == key]
    assert "".join(of(b"a")) == rows[0][1] and len(of(b"a")) > 5
    assert of(b"b") == [rows[1][1]]


def test_pattern_splits_as_the_library_does(library):
    find = bpe.pattern().findall
    for start in range(0, 0x3000, 7):
        for c in map(chr, range(start, start + 7)):
            for text in (f"a{c}b 1{c} {c}", f"{c}{c}x"):
                ids = [i for t in find(text) for i in library.encode_ordinary(t)]
                assert ids == library.encode_ordinary(text)


def test_empty(empty):
    ranks = bpe.read_ranks(empty.sparkSession)
    assert bpe.digest(bpe.encode(empty, ranks, decoded=True)).collect() == []


def test_columns_are_kept_whatever_their_names(docs_of, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 30)
    names = ["_long", "_same", "doc", "coded", "same", "number", "decoded", "piece"]
    frame = docs_of((1, "a b c"), (2, "long text " * 9), (2, "long text " * 9), (None, None)).selectExpr(
        "*", *[f"concat('{n}', doc_id) as {n}" for n in names])
    out = bpe.encode(frame, bpe.read_ranks(frame.sparkSession))
    assert out.columns == [c for c in frame.columns if c != "ids"] + ["ids"]
    assert out.drop("ids").exceptAll(frame.drop("ids")).isEmpty() and out.count() == 4
