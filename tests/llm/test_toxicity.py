import math
import time
import zlib

import pytest
from pyspark.sql import functions as F

from navlake.llm import toxicity
from llm_odd import ODD, SF_DIR


def test_folding_undoes_disguise():
    assert toxicity.fold("You 1d10t, m0r\u043en!") == " you idiot moron "
    assert toxicity.fold("ｉｄｉｏｔ i\u200bdiot") == " idiot idiot "
    assert toxicity.fold(None) == toxicity.fold("") == "  "


def test_folding_of_signs_marks_and_other_scripts():
    for text in ("“idiot”", "idiot…", "idiot—really", "idïot", "«IDIOT»", "id\u0456ot", "ᴵᴰᴵᴼᵀ", "1di0t", "idiot、"):
        assert toxicity.fold(text).split()[0] == "idiot", text
    assert toxicity.fold("Über\u00a0die Straße") == " uber die straße "
    assert len(toxicity.LOOK_ALIKE) < 200


def features_by_hand(folded, lexicon):
    """Total weight by looking at every word and every exception in turn."""
    words = folded.split()
    spared = set()
    for phrase in toxicity.EXCEPTIONS:
        p = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(p)] == p:
                spared |= set(range(i, i + len(p)))
    total = 0.0
    for i, word in enumerate(words):
        weights = [lexicon.words.get(word, 0.0)] + [w for stem, w in lexicon.stems.items() if word.startswith(stem)]
        total += 0.0 if i in spared else max(weights)
    return total, len(words)


def test_matches_against_brute_force():
    rng = __import__("random").Random(6)
    lexicon = toxicity.Lexicon({"trash": 2.0, "clown": 3.0, "pig": 1.5}, {"clow": 1.0, "tra": 0.5, "garbage": 2.5, "clown": 3.5})
    automaton = lexicon.automaton()
    words = ["trash", "can", "bag", "clown", "clowns", "class", "fish", "pig", "iron", "guinea", "garbage", "truck", "trap", "a", "collection"]
    for _ in range(400):
        folded = toxicity.fold(" ".join(rng.choices(words, k=rng.randrange(12))))
        total, n = features_by_hand(folded, lexicon)
        got = toxicity.features(folded, automaton)
        want = (math.log1p(total), math.log1p(100 * total / max(1, n)), math.log1p(max(1, n)))
        assert all(abs(a - b) < 1e-9 for a, b in zip(got, want)), folded


def test_many_exceptions_take_little_time():
    automaton = toxicity.Lexicon({"trash": 2.0}, {}).automaton()
    begin = time.time()
    assert toxicity.features(toxicity.fold("trash can trash " * 40_000), automaton)[0] > 0
    assert time.time() - begin < 5


def test_columns_of_any_name_are_kept(docs_of, spark):
    none = spark.createDataFrame([(None, 1)], "doc_id long, toxic int")
    docs = docs_of((1, "a"), (None, None)).selectExpr("*", "'y' as doc", "'y' as x", "'y' as toxic")
    assert toxicity.keep_clean(docs, none).exceptAll(docs).isEmpty()
    out = toxicity.score_documents(docs, none)
    own = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    assert out.select(*own).exceptAll(docs.select(*own)).isEmpty()


def test_weights_exceptions_and_length():
    found = toxicity.Lexicon({"trash": 2.0, "clown": 3.0}, {"clow": 1.0}).automaton()
    total = lambda text: round(float(pytest.importorskip("numpy").expm1(toxicity.features(toxicity.fold(text), found)[0])), 6)
    assert total("trash and trashy") == 2.0
    assert total("clown clowns") == 4.0
    assert total("a trash can, a clown fish") == 0.0
    assert total("trash") == 2.0
    short, long = (toxicity.features(toxicity.fold("trash" + " word" * n), found)[1] for n in (3, 300))
    assert short > long


def test_held_out_fold(odd):
    for r in odd.select("doc_id", toxicity.fold_of(F.col("doc_id")).alias("f")).collect():
        assert r["f"] == (None if r["doc_id"] is None else zlib.crc32(str(r["doc_id"]).encode()) % 5)


def test_odd_rows_and_no_labels(odd, empty, spark):
    none = spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int")
    rows = toxicity.score_documents(odd, none).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert toxicity.keep_clean(odd, none).columns == odd.columns
    assert toxicity.score_documents(empty, none).collect() == []


def auc(rows):
    """Odds that a toxic document scores above a clean one."""
    bad = [s for s, y in rows if y]
    good = [s for s, y in rows if not y]
    return sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(bad) * len(good))


def test_held_out_documents_are_told_apart(spark):
    given, labels = (spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score_documents(given, labels).join(labels, "doc_id").where("held_out")
    rows = [(r["score"], r["toxic"]) for r in scored.collect()]
    assert len(rows) > 50 and auc(rows) > 0.85
    kept = toxicity.keep_clean(given, labels).join(labels, "doc_id").where("toxic = 0").count()
    assert kept >= 0.97 * labels.where("toxic = 0").count()


def test_labels_of_held_out_rows_change_nothing(spark):
    given, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(
        toxicity.fold_of(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = (sorted((r["doc_id"], r["score"]) for r in toxicity.score_documents(given, x).collect())
                     for x in (labels, turned))
    assert first == second
