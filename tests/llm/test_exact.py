import hashlib
from collections import defaultdict

import pytest

from navlake.llm import exact
from llm_odd import ODD


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def by_hand(texts):
    groups = defaultdict(list)
    for d, t in texts:
        groups[lower(t)].append(d)
    rows = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        first = True
        for d in sorted(ids, key=lambda i: (i is None, -(i or 0))):
            rows.append((d, keep, len(ids), d == keep and first, hashlib.sha256(text.encode()).hexdigest()))
            first = first and d != keep
    return sorted(rows, key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.mark.parametrize("blocks", [1, exact.FEWEST, None])
def test_odd_rows_with_any_size_of_filter(odd, blocks):
    assert got(exact.exact_groups(odd, blocks)) == by_hand([r[:2] for r in ODD])


def test_given(given):
    assert got(exact.exact_groups(given)) == by_hand([(r["doc_id"], r["text"]) for r in given.collect()])


def test_hot_group_and_empty(docs_of, empty):
    texts = [(i, "Hot") for i in range(400)] + [(500 + i, f"t{i}") for i in range(300)]
    assert got(exact.exact_groups(docs_of(*texts))) == by_hand(texts)
    assert exact.exact_groups(empty).collect() == []


def test_only_possible_repeats_are_kept_for_the_shuffle(docs_of):
    texts = [(i, f"t{i}") for i in range(500)] + [(600, "T1")]
    digests = docs_of(*texts, clash=False).selectExpr("doc_id", "unhex(sha2(lower(text), 256)) as digest")
    maybe = {r["doc_id"] for r in exact.possibly_repeated(digests).where("maybe").collect()}
    assert {1, 600} <= maybe and len(maybe) < 10


def test_a_full_filter_changes_nothing(docs_of):
    texts = [(i, f"t{i % 900}") for i in range(1000)]
    assert got(exact.exact_groups(docs_of(*texts), blocks=1)) == by_hand(texts)


def test_kept_documents_and_plan(docs_of):
    kept = exact.drop_copies(docs_of((1, "a"), (2, "A"), (3, "b")))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_one_row_of_each_text_is_kept_with_its_columns(docs_of):
    rows = [(None, "only null"), (1, "Twice"), (1, "Twice"), (1, "twice"), (None, None), (None, ""), (2, "x"), (None, "X")]
    docs = docs_of(*rows).selectExpr("*", "'y' as maybe_", "'y' as doc", "'y' as bits")
    kept = exact.drop_copies(docs)
    assert kept.columns == docs.columns and kept.exceptAll(docs).isEmpty()
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(
        [(None, "only null"), (1, "twice"), (None, ""), (2, "x")], key=repr)


def test_filters_grow_with_the_rows():
    sizes = [exact.blocks_for(n) for n in (0, 1, 200_000, 10_000_000, 10 ** 12)]
    assert sizes == [exact.FEWEST, exact.FEWEST, 98, 4883, exact.MOST]


def test_members_of_a_set_are_never_missed(spark):
    rows = spark.range(2000).selectExpr("id", "'x' as text")
    marked = exact.possibly_among(rows, spark.range(0, 2000, 50).toDF("id"), "id").where("maybe")
    ids = {r["id"] for r in marked.collect()}
    assert set(range(0, 2000, 50)) <= ids and len(ids) < 60
    assert exact.possibly_among(rows, spark.range(0).toDF("id"), "id").where("maybe").isEmpty()
