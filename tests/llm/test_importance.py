import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_odd import ODD, SF_DIR
from navlake.llm import importance, queries


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def buckets_of(text, buckets=10_000):
    w = words_of(text)
    return [zlib.crc32(f.encode()) % buckets for f in w + [" ".join(p) for p in zip(w, w[1:])]]


@pytest.mark.parametrize("reach", [importance.REACH])
def test_crcs_of_spans_of_all_lengths(reach):
    rng = np.random.default_rng(1)
    stream = rng.integers(0, 256, 6000, dtype=np.uint8)
    lens = [1, 2, reach - 1, reach, reach + 1, 2 * reach - 1, 2 * reach, 2 * reach + 1, 5 * reach + 7, 4000] * 5
    starts = np.array([rng.integers(0, 6000 - n) for n in lens])
    ends = starts + lens
    want = [zlib.crc32(stream[a:b].tobytes()) for a, b in zip(starts, ends)]
    assert importance.span_crcs(stream, starts, ends).tolist() == want


def test_crcs_laid_out_in_steps(monkeypatch):
    monkeypatch.setattr(importance, "STEP", 50)
    rng = np.random.default_rng(2)
    stream = rng.integers(0, 256, 3000, dtype=np.uint8)
    starts = rng.integers(0, 2900, 400)
    ends = starts + rng.integers(1, 100, 400)
    want = [zlib.crc32(stream[a:b].tobytes()) for a, b in zip(starts, ends)]
    assert importance.span_crcs(stream, starts, ends).tolist() == want


def test_features_are_the_runs_of_words():
    rng = random.Random(3)
    texts = ["", "x", "A b-C d", "é É_1\x00ß", "日本 語", " ", "\n", "w" * 500 + " z"] + [
        "".join(rng.choice("aB1 -é日\n") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    found, owner, n_words = importance.features(texts)
    assert n_words.tolist() == [len(words_of(t)) for t in texts]
    for i, t in enumerate(texts):
        assert sorted(found[owner == i].tolist()) == sorted(buckets_of(t))


def brute_force(docs, target):
    """doc_id, n_features, weight, score, rank by plain counting."""
    held, wanted = Counter(), Counter()
    for _, t in docs:
        held.update(buckets_of(t))
    for t in target:
        wanted.update(buckets_of(t))
    s, t = sum(held.values()), sum(wanted.values())
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (s + 10_000) / ((held[b] + 1) * (t + 10_000)))) for b in range(10_000)}
    rows, able = [], []
    for doc_id, text in docs:
        f = buckets_of(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(f), weight, score, None])
        if len(words_of(text)) >= 20:
            able.append(rows[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0], -r[2], -r[1]))
    for rank, row in enumerate(able[:25 * len(able) // 100], 1):
        row[4] = rank
    return rows


def as_rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_query_against_brute_force(spark, given):
    docs = [(r["doc_id"], r["text"]) for r in given.collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    got = as_rows(queries.QUERIES["op12_importance"](spark, SF_DIR))
    want = sorted(map(tuple, brute_force(docs, target)), key=repr)
    assert got == want and max(r[4] or 0 for r in got) > 10


def test_odd_rows_ties_and_the_drawn_documents(spark, docs_of):
    texts = [f"word{i % 7} " * 25 + f"tail{i}" for i in range(40)]
    rows = ODD + [(100 + i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (100, texts[0])]
    docs = docs_of(*rows).selectExpr("*", "'y' as doc", "'y' as n_features", "'y' as rank", "'y' as found")
    target = spark.createDataFrame([("word3 word3",), (None,), ("",)], "text string")
    numbers = importance.ranked(docs, target)
    want = brute_force([(r[0], r[1]) for r in rows], ["word3 word3", None, ""])
    assert as_rows(importance.digest(numbers)) == sorted(map(tuple, want), key=repr)
    drawn = importance.draw(docs, target)
    assert drawn.columns == docs.columns
    assert Counter(r["doc_id"] for r in drawn.collect()) == Counter(r[0] for r in want if r[4])


def test_empty_tables(spark, empty, docs_of):
    target = spark.createDataFrame([], "text string")
    assert importance.digest(importance.ranked(empty, target)).isEmpty()
    assert importance.draw(empty, target).isEmpty()
    assert importance.ranked(docs_of((1, "a b")), target).first()["rank"] is None
