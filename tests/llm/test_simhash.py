import random

import pytest
import xxhash
from pyspark.sql import functions as F

from navlake.llm import simhash
from navlake.llm.components import components
from llm_odd import ODD


def words(text):
    out, word = [], b""
    for c in (text or "").encode():
        if c == 0x20 or 0x09 <= c <= 0x0D:
            out.append(word)
            word = b""
        else:
            word += bytes([c + 32 if 0x41 <= c <= 0x5A else c])
    return [w for w in [*out, word] if w]


def print_by_hand(text, n=3):
    w = words(text)
    parts = [b" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def by_hand(texts, distance=2):
    prints = [print_by_hand(t) for _, t in texts]
    label = list(range(len(texts)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                label[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(texts):
        ids = least.setdefault(find(i), [])
        if d is not None:
            ids.append(d)
    return sorted(((d, f"{prints[i]:016x}", min(least[find(i)], default=None)) for i, (d, _) in enumerate(texts)), key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.mark.parametrize("dense", [1, 2, simhash.DENSE])
def test_odd_rows(odd, dense):
    texts = [r[:2] for r in ODD if len(r[1] or "") < 20_000]
    frame = odd.where("coalesce(length(text), 0) < 20000")
    assert got(simhash.digest(simhash.near_groups(frame, dense=dense))) == by_hand(texts)


def test_given(given):
    texts = [(r["doc_id"], r["text"]) for r in given.collect()]
    assert got(simhash.digest(simhash.near_groups(given))) == by_hand(texts)


def test_long_text_equals_its_parts_by_hand():
    text = " ".join(random.Random(3).choices("abcdefgh", k=70_000))
    w = words(text)
    assert simhash.fingerprint(text, 3) % (1 << 64) == print_by_hand(text) and len(w) == 70_000


@pytest.mark.parametrize("distance, segments", [(0, 3), (2, 3), (2, 5), (2, 7), (4, 9)])
@pytest.mark.parametrize("dense", [1, 1000])
def test_links_connect_as_all_pairs_do(spark, distance, segments, dense):
    rng = random.Random(segments)
    prints = {rng.getrandbits(64) for _ in range(30)}
    for p in list(prints):
        for _ in range(4):
            q = p
            for b in rng.sample(range(64), rng.randint(1, 5)):
                q ^= 1 << b
            prints.add(q)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    found = simhash.links(frame, distance, segments, dense)
    roots = {r["node"]: r["root"] for r in components(found, "a", "b").collect()}
    label = {p: p for p in signed}

    def find(p):
        while label[p] != p:
            p = label[p]
        return p

    for p in signed:
        for q in signed:
            if bin((p ^ q) & (1 << 64) - 1).count("1") <= distance:
                a, b = sorted((find(p), find(q)))
                label[b] = a
    assert {p: roots.get(p, p) for p in signed} == {p: find(p) for p in signed}
    if dense == 1000:
        pairs = {(r["a"], r["b"]) for r in found.collect()}
        want = {(p, q) for p in signed for q in signed
                if p < q and bin((p ^ q) & (1 << 64) - 1).count("1") <= distance}
        assert pairs == want


def test_long_chain_of_links(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {tuple(r) for r in components(links, "a", "b").collect()} == {(i, 0) for i in range(1, 201)}
    assert components(links.where("a < 0"), "a", "b").collect() == []


def test_bad_parameters(spark):
    frame = spark.createDataFrame([(1,)], "fingerprint long")
    with pytest.raises(ValueError):
        simhash.links(frame, 3, 5)
    with pytest.raises(ValueError):
        simhash.links(frame, 4, 4)


def test_one_of_each_group_stays(docs_of, empty):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(5, base), (2, base.upper()), (9, base), (9, base), (None, base), (1, "other words stand here now"),
            (7, None), (8, ""), (None, "lonely text without an id at all")]
    frame = docs_of(*rows)
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [
        (False, 1), (False, 2), (False, 7), (True, 0)]
    assert simhash.keep_one(empty).collect() == []
    assert simhash.near_groups(empty).collect() == []
