import random

from navlake.llm import lines, passages
from llm_odd import ODD

RNG = random.Random(11)
WORDS = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in "lmnrst"]


def prose(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


def runs_of(texts, n=50):
    """How many documents hold a run of n words that an earlier one holds."""
    seen, count = set(), 0
    for text in texts:
        w = text.split()
        own = {" ".join(w[i:i + n]) for i in range(len(w) - n + 1)}
        count += bool(own & seen)
        seen |= own
    return count


def got(frame):
    return {r["doc_id"]: (r["text"], r["removed_lines"]) for r in lines.dedup_lines(frame).collect()}


def test_edited_and_embedded_passages_go(docs_of):
    passage, own = prose(120), [prose(70) for _ in range(4)]
    edited = passage.split()
    edited[60] = "edited"
    rows = [(1, passage), (2, " ".join(edited)), (3, f"{own[0]} {passage} {own[1]}"), (4, f"{own[2]}\n{own[3]}")]
    frame = docs_of(*rows)
    kept = got(frame)
    assert runs_of([t for _, t in rows]) == 2
    assert runs_of([kept[i][0] for i in range(1, 5)]) == 0
    assert kept[1][0] == passage and kept[4][0] == rows[3][1] and "edited" in kept[2][0]
    left = kept[3][0]
    assert left.startswith(own[0]) and left.endswith(own[1]) and len(left) < len(rows[2][1]) - len(passage) // 2


def test_frequent_lines_twice_in_a_document_go(docs_of):
    hot = prose(20)
    rows = [(i, f"{prose(12)}\n{hot}\n{prose(12)}\n{hot}") for i in range(70)]
    kept = got(docs_of(*rows))
    assert kept[0][0] == rows[0][1]
    assert all(kept[i] == (rows[i][1].replace("\n" + hot, ""), [1, 3]) for i in range(1, len(rows)))


def test_block_of_short_lines_with_different_first_holders_goes(docs_of):
    short = [prose(4) for _ in range(4)]
    block = "\n".join(short)
    holders = [(i, f"{prose(9)}\n{short[i % 4]}\n{prose(9)}") for i in range(250)]
    rows = [*holders, (1000, f"{block}\n{prose(9)}"), *[(1001 + i, f"{prose(9)}\n{block}\n{prose(9)}") for i in range(3)]]
    kept = got(docs_of(*rows))
    assert all(kept[i] == (t, []) for i, t in rows[:-3])
    for i, t in rows[-3:]:
        assert kept[i] == (t.replace(block + "\n", ""), [1, 2, 3, 4])


def test_scripts_without_spaces(docs_of):
    line = "".join(chr(0x4E00 + RNG.randrange(5000)) for _ in range(40))
    kept = got(docs_of((1, line), (2, f"先头\n{line}\n末尾")))
    assert kept[1][0] == line and kept[2] == ("先头\n末尾", [1])


def test_runs_are_those_of_plain_loops():
    texts = [t or "" for _, t in ODD if len(t or "") < 100_000] + [f"{prose(30)}\n\n {prose(3)}  {prose(40)}\n" for _ in range(20)]
    together = passages.run_keys(texts, 8)
    assert [list(k) for k in together] == [list(passages.run_keys([t], 8)[0]) for t in texts]
    assert all(len(set(k.tolist())) == len(k) for k in together)
    for text in texts:
        runs = passages.Runs([text], 8)
        words = [text[a:b] for a, b in zip(runs.starts, runs.ends)]
        assert words == text.split() or any(ord(c) in (0x1C, 0x1D, 0x1E, 0x1F, 0x85) for c in text)
        assert all(b - a >= 8 for a, b in zip(runs.first, runs.past))
        covered = {k for a, b in zip(runs.first, runs.past) for k in range(a, b)}
        assert len(words) < 8 or covered == set(range(len(words)))


def test_differing_line_breaks(docs_of):
    w = prose(80).split()
    broken = "\n".join(" ".join(w[i:i + 11]) for i in range(0, 80, 11))
    kept = got(docs_of((1, " ".join(w)), (2, broken)))
    assert runs_of([kept[1][0], kept[2][0]]) == 0 and len(kept[2][0]) < len(broken) // 2


def test_odd_and_empty(odd, empty):
    assert lines.dedup_lines(odd).count() == len(ODD)
    assert lines.dedup_lines(empty).collect() == []


def test_given_holds_no_repeated_run_of_fifty_words(given):
    before = [r["text"] or "" for r in given.orderBy("doc_id").collect()]
    after = [r["text"] or "" for r in lines.dedup_lines(given).orderBy("doc_id").collect()]
    assert runs_of(after) == 0 <= runs_of(before)
    assert sum(map(len, after)) <= sum(map(len, before))
