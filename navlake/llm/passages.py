"""Words of a text, cut into units that an edit elsewhere does not move.

A text's words are cut into units where a hash of two words in a row says so, whatever the line
breaks. From each unit the shortest run of units with enough words is taken; the same is done with
lines as units, forwards and backwards, which covers every longer run of lines. A passage that two
documents share, and is long enough, is made of runs that both have.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

#: One of so many words starts a unit.
UNIT = 8

#: Characters that are looked at together; bounds the memory of a batch.
STEP = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

#: Scripts without spaces, each character of which counts as a word: Thai, Lao, Myanmar, Khmer,
#: kana, Chinese signs.
UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF),
            (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(0, n - 1), base, dtype=np.uint64)]), dtype=np.uint64)


def _runs(cuts: np.ndarray, owner: np.ndarray, least: int, backward: bool) -> np.ndarray:
    """First word and one past the last of the shortest runs of ``least`` words from each unit.

    ``cuts`` marks the words that start a unit; ``backward`` adds the runs that end with it.
    """
    units = np.append(np.flatnonzero(cuts), len(cuts))
    n = len(units) - 1
    i, j = np.arange(n), np.searchsorted(units, units[:-1] + least)
    i, j = i[j <= n], j[j <= n]
    if backward:
        past = np.arange(1, n + 1)
        begin = np.searchsorted(units, units[1:] - least, side="right") - 1
        i, j = np.concatenate([i, begin[begin >= 0]]), np.concatenate([j, past[begin >= 0]])
    good = owner[units[i]] == owner[units[j] - 1]
    return np.stack([units[i[good]], units[j[good]]], axis=1)


class Runs:
    """The words of some texts, and the runs of units with at least ``least`` words.

    ``starts, ends``: places of words in ``"\\n".join(texts)``; ``first, past, keys``: first
    word, one past the last word and hash of each run; ``owner``: the text of each run.
    """

    def __init__(self, texts: list[str], least: int):
        # A line end before the first text, so that every word has a character before it.
        points = np.frombuffer(("\n" + "\n".join(texts)).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        blank = (points == 32) | ((points >= 9) & (points <= 13))
        solid = np.zeros(len(points), dtype=bool)
        if len(points) and points.max() >= UNSPACED[0][0]:
            for low, high in UNSPACED:
                solid |= (points >= low) & (points <= high)
        begins = ~blank
        begins[1:] &= blank[:-1] | solid[1:] | solid[:-1]
        at = np.flatnonzero(begins)
        self.starts = at - 1
        self.first = self.past = self.owner = np.zeros(0, dtype=np.int64)
        self.keys = np.zeros(0, dtype=np.uint64)
        self.ends = np.zeros(0, dtype=np.int64)
        if not len(at):
            return
        limits = np.append(at[1:], len(points))
        inside = np.flatnonzero(~blank)
        word_of = np.cumsum(begins)[inside] - 1
        offset = inside - at[word_of]
        values = _mixed(points[inside].astype(np.uint64)) * _powers(_BASE, int(offset.max()) + 1)[offset]
        edges = np.searchsorted(inside, at)
        words = _mixed(np.add.reduceat(values, edges))
        self.ends = at + np.diff(np.append(edges, len(inside))) - 1

        # Places in the texts, which a run never crosses.
        begin_of = np.cumsum([0] + [len(t) + 1 for t in texts])
        owner = np.searchsorted(begin_of, self.starts, side="right") - 1
        first = np.ones(len(at), dtype=bool)
        first[1:] = owner[1:] != owner[:-1]
        by_hash = first.copy()
        by_hash[1:] |= _mixed(words[:-1] * _BASE + words[1:]) % np.uint64(UNIT) == 0
        lines = np.cumsum(points == 10)[at]
        by_line = first.copy()
        by_line[1:] |= lines[1:] != lines[:-1]
        both = np.unique(np.concatenate([_runs(by_hash, owner, least, False), _runs(by_line, owner, least, True)]), axis=0)
        self.first, self.past = both[:, 0], both[:, 1]
        self.owner = owner[self.first]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(words * _powers(_BASE, len(words)), dtype=np.uint64)])
        self.keys = _mixed((sums[self.past] - sums[self.first]) * _powers(_BACK, len(words))[self.first]
                           + (self.past - self.first).astype(np.uint64))


def _steps(texts: list[str]) -> Iterator[list[int]]:
    """Numbers of the texts, as many together as have STEP characters."""
    part, held = [], 0
    for i, t in enumerate(texts):
        if part and held + len(t) > STEP:
            yield part
            part, held = [], 0
        part.append(i)
        held += len(t)
    if part:
        yield part


def run_keys(texts: list[str], least: int) -> list[np.ndarray]:
    """The distinct keys of each text's runs, as signed numbers, by where they first begin."""
    out = []
    for part in _steps(texts):
        runs = Runs([texts[i] for i in part], least)
        edges = np.searchsorted(runs.owner, np.arange(len(part) + 1))
        for a, b in zip(edges, edges[1:]):
            keys, first = np.unique(runs.keys[a:b], return_index=True)
            out.append(keys[np.argsort(first)].view(np.int64))
    return out


def without(text: str, keys, least: int) -> tuple[str, list[int]]:
    """The text less the runs of ``keys``, and the lines deleted whole.

    What stays of a line keeps its place; a line without words stays.
    """
    runs = Runs([text], least)
    hit = np.isin(runs.keys.view(np.int64), np.asarray(keys, dtype=np.int64))
    turns = np.zeros(len(runs.starts) + 1, dtype=np.int64)
    np.add.at(turns, runs.first[hit], 1)
    np.add.at(turns, runs.past[hit], -1)
    removed = np.cumsum(turns)[:-1] > 0
    kept, deleted, at = [], [], 0
    for number, line in enumerate(text.split("\n")):
        a, b = np.searchsorted(runs.starts, [at, at + len(line)])
        here = removed[a:b]
        if b > a and here.all():
            deleted.append(number)
        elif not here.any():
            kept.append(line)
        else:
            stays, since = [], at
            for k in range(a, b):
                if removed[k]:
                    stays.append(text[since:runs.starts[k]] if since < runs.starts[k] else "")
                    since = runs.starts[k + 1] if k + 1 < b else at + len(line)
            stays.append(text[since:at + len(line)])
            kept.append("".join(stays).rstrip(" ") if removed[b - 1] else "".join(stays))
        at += len(line) + 1
    return "\n".join(kept), deleted


def listed_runs(text: Column, least: int) -> Column:
    """The distinct keys of a text's runs, in order."""

    @F.pandas_udf("array<long>")
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(run_keys(batch.tolist(), least), dtype=object)

    return of_batches(text)


def less(text: Column, keys: Column, least: int) -> Column:
    """Struct of the text less the runs of ``keys`` and the numbers of the lines deleted whole."""

    @F.pandas_udf("text string, gone array<int>")
    def of_batches(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, keyed in batches:
            rows = [(None, None) if k is None else without(t, k, least) for t, k in zip(texts, keyed)]
            yield pd.DataFrame(rows, columns=["text", "gone"])

    return of_batches(text, keys)
