import hashlib
import re
from collections import defaultdict

import pytest

from navlake.llm import mixing
from llm_odd import ODD


def by_hand(texts):
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in texts]
    total = defaultdict(int)
    for (_, _, s), n in zip(texts, sizes):
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(sizes)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] >= 2 * total[s]}
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        for s in full:
            target[s] = 2.0 * total[s]
            left -= target[s]
        free -= full
    rows = []
    for (d, t, s), n in zip(texts, sizes):
        rate = target[s] / total[s] if total[s] else 0.0
        key = str(d) if d is not None else hashlib.md5((t or "").encode()).hexdigest()
        draw = int(hashlib.md5(f"{mixing.SEED}|{key}".encode()).hexdigest()[:13], 16) / 2 ** 52
        rows.append((d, n, total[s], round(target[s], 6), n * (int(rate) + (draw < rate - int(rate)))))
    return sorted(rows, key=str)


def got(frame):
    return sorted(((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["size"] * r["copies"])
                   for r in mixing.with_copies(frame).collect()), key=str)


def test_given(given):
    texts = [(r["doc_id"], r["text"], r["source"]) for r in given.collect()]
    assert got(given) == by_hand(texts)


def test_odd_rows_and_null_source(docs_of):
    rows = [(*r[:2], s) for r, s in zip(ODD, ["b", "a", None, "B", "b", None, "é", "a"] * 2)]
    assert got(docs_of(*rows)) == by_hand(rows)


def test_ceiling_is_shared_again(docs_of):
    rows = [(1, "x " * 100, "a"), (2, "y " * 5, "b"), (3, "z " * 1000, "c"), (4, None, "d"), (5, "w " * 40, "e")]
    assert got(docs_of(*rows)) == by_hand(rows)
    assert got(docs_of((1, None, "a"), (2, "", None))) == by_hand([(1, None, "a"), (2, "", None)])


def test_near_target_and_rows_of_the_mix(given):
    planned = mixing.with_copies(given)
    mixed = mixing.mix(given)
    assert mixed.columns == given.columns
    assert mixed.count() == sum(r["copies"] for r in planned.collect())
    assert max(r["copies"] for r in planned.collect()) <= 2


@pytest.mark.parametrize("rows", [1, 100_000])
def test_join_with_and_without_broadcast(given, monkeypatch, rows):
    monkeypatch.setattr("navlake.llm.common.SMALL_ROWS", rows)
    texts = [(r["doc_id"], r["text"], r["source"]) for r in given.collect()]
    assert got(given) == by_hand(texts)


def test_empty(empty):
    assert mixing.with_copies(empty).collect() == [] and mixing.mix(empty).collect() == []
