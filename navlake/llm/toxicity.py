"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded text.

Folding undoes look-alike letters and digit substitutions. Words and word beginnings that
labelled documents show to be toxic carry a weight; words inside an exception phrase do not
count. The sum of the weights, taken by length, is calibrated to a score between 0 and 1.
"""

import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F

from navlake.llm.common import cut

#: Labelled rows used to learn the lexicon, about; chosen by a hash of doc_id.
SAMPLE_ROWS = 20_000

#: Least toxic documents with an entry, and least log-odds, to enter the lexicon.
LEAST_TOXIC = 5
LEAST_WEIGHT = 2.0

#: Lengths of word beginnings that may enter.
STEMS = range(4, 11)

# Words that are abusive in themselves, with the weight they have where labels say nothing.
BASE_WEIGHT = 2.5
BASE_WORDS = (
    "idiot moron loser scum trash pathetic worthless stupid disgusting clown imbecile dumbass "
    "bastard asshole bitch crap cretin degenerate dimwit dipshit douchebag dunce fool freak "
    "garbage halfwit hideous jackass jerk lowlife maggot nitwit parasite pig retard scumbag "
    "shithead shit slut sucker twat vermin whore wanker"
).split()

# Phrases in which such words are harmless.
EXCEPTIONS = (
    "trash can", "trash bag", "trash bin", "garbage collection", "garbage collector",
    "garbage truck", "clown fish", "class clown", "idiot proof", "guinea pig", "pig iron",
    "sore loser", "control freak", "nothing stupid", "host parasite", "parasite host",
)

# Letters that look like a Latin one (Cyrillic, Greek, small capitals, others), and digits or signs written for one.
LOOK_ALIKE = dict(zip(
    "авекмнорстухіјѕԁԛԝһӏғгпицѵ" "αβεικνορτυχγηκρωϲ" "ᴀʙᴄᴅᴇɢʜɪᴊᴋʟᴍɴᴏᴘʀᴛᴜᴠᴡʏᴢ" "ıȷøłđħŧɑɡɩαο",
    "abekmhopctyxijsdqwhlfrnucv" "abeikvoptuxynkpwc" "abcdeghijklmnoprtuvwyz" "ijoldhtagiao"))
SUBSTITUTED = dict(zip("0134578@$€£¢", "oieastbaselc"))


def _fold_table() -> dict[int, str]:
    table = {i: " " for i in range(128) if not chr(i).isalpha()}
    table |= {ord(k): v for k, v in {**LOOK_ALIKE, **SUBSTITUTED}.items()}
    table |= {i: "" for i in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}  # invisible
    return table


FOLD = _fold_table()
_MARKS = regex.compile(r"\p{M}+")
_GAPS = regex.compile(r"[^\p{L}]+")


def fold(text: str | None) -> str:
    """Words in lower case with look-alikes undone, one space before, between and after.

    Full-width and other compatible forms become plain, accents and other marks go, and whatever is no
    letter separates words, in any script.
    """
    low = (text or "").lower()
    if not low.isascii():
        low = _MARKS.sub("", unicodedata.normalize("NFKD", low)).lower()
    low = low.translate(FOLD)
    return f" {' '.join(low.split() if low.isascii() else _GAPS.sub(' ', low).split())} "


@dataclass(frozen=True)
class Lexicon:
    """``words`` and word beginnings (``stems``) with weights; ``line`` scores the features."""

    words: dict[str, float]
    stems: dict[str, float]
    line: tuple[float, ...] = ()

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for phrase in EXCEPTIONS:
            found.add_word(f" {phrase} ", (len(phrase) + 2, None))
        for stem, weight in self.stems.items():
            found.add_word(f" {stem}", (len(stem) + 1, weight))
        for word, weight in self.words.items():
            found.add_word(f" {word} ", (len(word) + 2, weight))
        found.make_automaton()
        return found


def features(folded: str, automaton: ahocorasick.Automaton) -> tuple[float, float, float]:
    """Log of the summed weights, the same per 100 words, and the log of the word count.

    Of the entries that match at one word the heaviest counts; a word inside an exception
    phrase does not.
    """
    best, spared = {}, []
    for end, (length, weight) in automaton.iter(folded):
        start = end - length + 1
        if weight is None:
            spared.append((start, end))
        elif weight > best.get(start, 0.0):
            best[start] = weight
    if spared:
        # Found by their ends; where one begins after another has begun, the furthest end so far counts.
        spared.sort()
        begins, reach = [a for a, _ in spared], list(accumulate((b for _, b in spared), max))
        best = {s: w for s, w in best.items() if (i := bisect_right(begins, s)) == 0 or reach[i - 1] <= s}
    total, words = sum(best.values()), max(1, folded.count(" ") - 1)
    return np.log1p(total), np.log1p(100 * total / words), np.log1p(words)


def _features(lexicon: Lexicon, text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = lexicon.automaton()
        for batch in batches:
            yield pd.Series([list(features(fold(t), automaton)) for t in batch])

    return of_batches(text)


def _folded_words(text: Column) -> Column:
    @F.pandas_udf("array<string>")
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([sorted(set(fold(t).split())) for t in batch])

    return of_batches(text)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression by Newton's method; the last is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fold_of(doc_id: Column) -> Column:
    """0 to 4 by the checksum of the id as text; 0 is held out."""
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(5))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Lexicon:
    """A lexicon and its calibration from labelled documents outside fold 0.

    Every word and stem of the sample that enough toxic texts hold is in it, if its odds are high; the
    sample bounds how many there are. About ``sample_rows`` labelled rows are used, those with the smallest hashes. Equal texts
    count once, so a much-copied document does not make its words look toxic. Only entries of
    the lexicon and three numbers per sampled document reach the driver. Labels without an id
    or a value are left out; without usable labels the base words score by a fixed line.
    """
    usable = (
        labels.where("doc_id is not null and toxic is not null").where(fold_of(F.col("doc_id")) != 0)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    share = sample_rows / max(1, usable.count())
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    # A bounded number of rows of two numbers each.
    chosen = F.broadcast(usable.where(draw < share))
    texts = docs.select("doc_id", "text").join(chosen, "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))
    sample = cut(texts.groupBy(F.xxhash64("text").alias("same")).agg(
        F.first("text").alias("text"), F.max("toxic").alias("toxic")))
    base = {w: BASE_WEIGHT for w in BASE_WORDS}
    size = sample.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    toxic, clean = (int(n or 0) for n in size)
    if not toxic or not clean:
        return Lexicon(base, {}, (1.0, 0.5, 0.0, -3.0))

    words = sample.select("toxic", F.explode(_folded_words(F.col("text"))).alias("word"))
    counted = words.groupBy("word").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    whole = F.array(F.struct(F.col("word").alias("entry"), F.lit(False).alias("stem")))
    begins = F.array(*[
        F.when(F.length("word") > n, F.struct(F.substring("word", 1, n).alias("entry"), F.lit(True).alias("stem")))
        for n in STEMS])
    entries = counted.select("t", "c", F.explode(F.array_compact(F.concat(whole, begins))).alias("e"))
    odds = (F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1)))
    kept = (
        entries.groupBy("e.entry", "e.stem").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
        .where(F.col("t") >= LEAST_TOXIC).withColumn("weight", odds)
        .where(F.col("weight") >= LEAST_WEIGHT).collect())
    known = Lexicon(
        base | {r["entry"]: r["weight"] for r in kept if not r["stem"]},
        {r["entry"]: r["weight"] for r in kept if r["stem"]})
    rows = sample.select("toxic", _features(known, F.col("text")).alias("x")).collect()
    line = _logistic(np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows], dtype=float))
    return Lexicon(known.words, known.stems, tuple(float(v) for v in line))


def scores(text: Column, lexicon: Lexicon) -> Column:
    """The probability, by the lexicon, that a label would say toxic."""

    @F.pandas_udf("double")
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = lexicon.automaton()
        line = np.array(lexicon.line)
        for batch in batches:
            x = np.array([features(fold(t), automaton) for t in batch]).reshape(-1, 3)
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ line[:-1] + line[-1], -30, 30))))

    return of_batches(text)


def score_documents(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``held_out, score, predicted``.

    Null and empty texts have no matches and score what the calibration gives for that; a null
    doc_id is not held out; repeated rows score alike; an empty table gives no rows. Input
    columns with one of the three names are replaced.
    """
    lexicon = learn(docs, labels, sample_rows)
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("held_out", "score", "predicted")]
    text_score = scores(F.col("text"), lexicon)
    return docs.select(
        *own, F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), text_score.alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not judged toxic, with their own columns whatever their names.

    Null and empty texts are judged by the calibration; repeated rows go or stay alike; an empty table
    gives no rows.
    """
    lexicon = learn(docs, labels)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    judged = whole.select("doc", scores(F.col("doc.text"), lexicon).alias("score"))
    return judged.where("score < 0.5").select("doc.*")
