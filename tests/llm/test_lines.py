import random

import pytest

from navlake.llm import lines, passages, queries
from llm_odd import ODD, SF_DIR

RNG = random.Random(11)
WORDS = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in "lmnrst"]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def test_chains_keep_both_orders_and_take_each_run_once():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randrange(1, 15)
        early, late = rng.sample(range(40), n), rng.sample(range(40), n)
        piles = lines.chains(early, late)
        assert sorted(i for p in piles for i in p) == list(range(n))
        for p in piles:
            assert all(early[a] < early[b] and late[a] < late[b] for a, b in zip(p, p[1:]))
        # As few as the longest run of places that fall while the others rise.
        fall, best = [early[i] for i in sorted(range(n), key=late.__getitem__)], [1] * n
        for i in range(n):
            best[i] = 1 + max((best[j] for j in range(i) if fall[j] > fall[i]), default=0)
        assert len(piles) == max(best)
    assert lines.chains([0, 1, 2], [5, 6, 7]) == [[0, 1, 2]]
    assert lines.blocks([0, 1, 4, 5], [3, 4, 5, 9]) == [[0, 1], [2], [3]]


def test_many_moved_runs_take_little_time():
    n = 200_000
    assert len(lines.chains(list(range(n, 0, -1)), list(range(n)))) == n


def by_hand(texts, least=lines.BLOCK_WORDS):
    """Texts less what earlier ids hold, with a dictionary of runs and words put together one by one."""
    def place(d):
        return lines.NO_ID if d is None else d

    first = {}
    for d, t in sorted(texts, key=lambda r: place(r[0])):
        for key in passages.Runs([t or ""], least).keys.tolist():
            first.setdefault(key, place(d))
    out = []
    for d, t in texts:
        text, gone = t or "", set()
        runs = passages.Runs([text], least)
        for a, b, key in zip(runs.first, runs.past, runs.keys.tolist()):
            if first[key] < place(d):
                gone |= set(range(a, b))
        kept, k, at, removed = [], 0, 0, []
        for number, line in enumerate(text.split("\n")):
            left, since, cut, some, last = "", at, False, False, False
            while k < len(runs.starts) and runs.starts[k] < at + len(line):
                if k in gone:
                    left += text[since:runs.starts[k]] if not last else ""
                    cut = True
                else:
                    if last:
                        since = runs.starts[k]
                    some = True
                last = k in gone
                k += 1
            left += "" if last else text[since:at + len(line)]
            if cut and not some:
                removed.append(number)
            else:
                kept.append(left.rstrip(" ") if last else left)
            at += len(line) + 1
        out.append((d, "\n".join(kept) if t is not None else None, removed))
    return sorted(out, key=repr)


def got(frame):
    return sorted(((r["doc_id"], r["text"], r["removed_lines"]) for r in lines.dedup_lines(frame).collect()), key=repr)


def test_query_against_brute_force(spark, given):
    texts = [(r["doc_id"], r["text"]) for r in given.collect()]
    rows = queries.QUERIES["op4_line_dedup"](spark, SF_DIR).collect()
    want = by_hand(texts)
    assert sorted(((r["doc_id"], r["text"], r["removed_lines"]) for r in rows), key=repr) == [
        (d, t, ",".join(map(str, g))) for d, t, g in sorted(want, key=lambda x: repr((x[0], x[1], ",".join(map(str, x[2])))))]
    assert all(r["n_lines"] == len((t or "").split("\n")) or t is None
               for r, (_, t) in zip(sorted(rows, key=lambda r: r["doc_id"]), sorted(texts)))
    assert sum(len(t or "") for _, t, _ in want) < sum(len(t or "") for _, t in texts)


def test_odd_rows(odd):
    assert got(odd) == by_hand([r[:2] for r in ODD])


LONG = " ".join(f"word{i}" for i in range(60))


def test_a_passage_goes_from_later_documents_only(docs_of):
    rows = docs_of(
        (1, f"first line here\n{LONG}\nlast line here"), (2, f"other start\n{LONG}"), (3, LONG),
        (4, "other start\nsomething else"), (5, f"  {LONG}  \nmore of it"))
    kept = {r["doc_id"]: (r["text"], r["removed_lines"], r["n_lines"]) for r in lines.dedup_lines(rows).collect()}
    assert kept[1] == (f"first line here\n{LONG}\nlast line here", [], 3)
    assert kept[2] == ("other start", [1], 2)
    assert kept[3] == ("", [0], 1)
    assert kept[4][0] == "other start\nsomething else"
    assert kept[5][0] == "more of it"


def test_hot_passage_meets_its_first_holder_only(docs_of):
    rows = docs_of(*[(i, f"own line number {i}\n{LONG}") for i in range(150)])
    kept = {r["doc_id"]: r["text"] for r in lines.dedup_lines(rows).collect()}
    assert kept[0].endswith(LONG)
    assert all(kept[i] == f"own line number {i}" for i in range(1, 150))
    assert lines.document_pairs(lines._keyed(rows)).count() < 2 * 150


def test_columns_are_kept_whatever_their_names(docs_of):
    names = ["_id", "_mark", "_keys", "doc", "keys", "less", "early", "late", "first", "key", "at", "places"]
    docs = docs_of((1, LONG), (2, LONG), (2, LONG), (None, None)).selectExpr("*", *[f"concat('{n}', doc_id) as {n}" for n in names])
    out = lines.dedup_lines(docs)
    own = [c for c in docs.columns if c not in ("n_lines", "removed_lines")]
    assert out.columns == [*own, "n_lines", "removed_lines"]
    rest = [c for c in own if c != "text"]
    assert out.select(*rest).exceptAll(docs.select(*rest)).isEmpty() and out.count() == 4
    assert sorted((r["text"] for r in out.collect()), key=repr) == ["", "", LONG, None]


@pytest.mark.parametrize("words, least_share", [(8, 0.0), (16, 0.15), (24, 0.5), (32, 0.75), (50, 0.95)])
def test_recall_of_passages_inside_lines_by_length(docs_of, words, least_share):
    rng = random.Random(words)
    rows = []
    for i in range(120):
        shared = prose(words, rng)
        rows += [(2 * i, f"{prose(30, rng)} {shared} {prose(30, rng)}"), (2 * i + 1, f"{prose(30, rng)} {shared} {prose(30, rng)}")]
    before = dict(rows)
    kept = {d: t for d, t, _ in got(docs_of(*rows))}
    assert all(kept[2 * i] == before[2 * i] for i in range(120))
    share = sum(len(kept[2 * i + 1]) < len(before[2 * i + 1]) for i in range(120)) / 120
    print(f"passages of {words} words found: {share:.2f}")
    assert share >= least_share


def test_empty(empty):
    assert lines.dedup_lines(empty).collect() == []
