"""URL filter by the ratio of two character language models.

Two smoothed models of variable order, one of accepted and one of rejected URLs, give every
character a probability from the longest context they have seen, mixed with the shorter ones.
A URL's score is the mean over its characters of the difference of the log-probabilities; the
cut between accepted and rejected is calibrated on labelled URLs that the models did not see.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from navlake.llm.common import ascii_lower, cut

#: Characters of context at most.
ORDER = 4

#: Weight of the shorter context's estimate against seen characters.
SMOOTHING = 2.0

#: Probability of a character in no context at all.
UNIFORM = 1.0 / 256

#: Width of the score bins in which the cut is sought.
BIN = 0.02

# Host, path, verdict.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

# Words in a host that mark a URL as rejected when the models are trained.
REJECTED_HOST_WORDS = (
    "ads", "adult", "bet", "bets", "betting", "bingo", "casino", "cheap", "cialis", "clickbait", "crack", "cracked",
    "dating", "escort", "escorts", "forex", "gambling", "hookup", "jackpot", "keygen", "loan", "loans", "lottery",
    "malware", "nude", "nudes", "payday", "pharma", "phishing", "pills", "poker", "popunder", "porn", "roulette",
    "sex", "slots", "spam", "torrent", "torrents", "viagra", "warez", "webcam", "xxx")

START, END = "\x02", "\x03"


def host_of(url: Column) -> Column:
    """Up to ``/``, ``?`` or ``#`` after the first ``://``, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?`` or ``#``; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct of the longest fitting rule's name and verdict, null where none fits."""
    chosen = F.lit(None)
    for name, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(start))
        chosen = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def judged_text(url: Column, host: Column) -> Column:
    """What the models read: the whole URL behind its scheme, the host in lower case."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    return F.coalesce(F.when(F.contains(url, F.lit("://")), F.concat(host, rest)).otherwise(url), F.lit(""))


def _grams(text: str) -> Column:
    """Each character of the text and its end, with the ORDER characters before it."""
    padded = F.concat(F.lit(START * ORDER), F.col(text), F.lit(END))
    return F.transform(
        F.sequence(F.lit(1), F.length(text) + 1), lambda i: padded.substr(i, F.lit(ORDER + 1)))


def gram_scores(counted: DataFrame) -> DataFrame:
    """``gram, ratio``: log-probability under the accepted model less that under the rejected.

    ``counted`` has a row per gram to be scored, with how often ``accepted`` and ``rejected``
    training URLs hold it (0 for unseen ones). Each order's estimate is its counts mixed with
    the next shorter order's; every table here has one row per distinct gram or context.
    """
    lower = None
    for k in range(ORDER + 1):
        tails = counted.groupBy(F.expr(f"right(gram, {k + 1})").alias("tail")).agg(
            F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
        tails = tails.withColumn("context", F.expr(f"left(tail, {k})"))
        totals = tails.groupBy("context").agg(
            F.sum("accepted").alias("all_accepted"), F.sum("rejected").alias("all_rejected"))
        level = tails.join(totals, "context")
        if lower is None:
            level = level.withColumn("below_a", F.lit(UNIFORM)).withColumn("below_r", F.lit(UNIFORM))
        else:
            level = level.withColumn("shorter", F.expr(f"right(tail, {k})")).join(lower, "shorter")
        lower = level.select(
            F.col("tail").alias("shorter"),
            ((F.col("accepted") + SMOOTHING * F.col("below_a")) / (F.col("all_accepted") + SMOOTHING)).alias("below_a"),
            ((F.col("rejected") + SMOOTHING * F.col("below_r")) / (F.col("all_rejected") + SMOOTHING)).alias("below_r"),
        )
    # A decimal, so that sums do not depend on the order in which rows arrive.
    ratio = (F.log("below_a") - F.log("below_r")).cast("decimal(12,9)")
    return lower.select(F.col("shorter").alias("gram"), ratio.alias("ratio"))


def text_scores(texts: DataFrame) -> DataFrame:
    """``judged, score`` for each row of ``texts``: ``judged, accepted, rejected``.

    The models are trained on every text, as often as it counts for either side.
    """
    placed = texts.select("judged", "accepted", "rejected", F.explode(_grams("judged")).alias("gram"))
    counted = cut(placed.groupBy("gram").agg(
        F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")))
    return (
        placed.select("judged", "gram").join(gram_scores(counted), "gram")
        .groupBy("judged").agg((F.sum("ratio").cast("double") / F.count("ratio")).alias("score"))
    )


def best_cut(scored: DataFrame) -> float:
    """The score from which to accept: most balanced accuracy over ``accepted, rejected`` rows.

    Only the counts per score bin reach the driver; without labelled rows of both kinds it is 0.
    """
    bins = scored.groupBy(F.floor(F.col("score") / BIN).alias("bin")).agg(
        F.sum("accepted").alias("a"), F.sum("rejected").alias("r")).where("a + r > 0").orderBy("bin").collect()
    accepted, rejected = sum(b["a"] for b in bins), sum(b["r"] for b in bins)
    if not accepted or not rejected:
        return 0.0
    best, edge, left_a, left_r = -1.0, 0.0, 0, 0
    for b in bins:
        gain = (accepted - left_a) / accepted + left_r / rejected
        if gain > best:
            best, edge = gain, b["bin"] * BIN
        left_a, left_r = left_a + b["a"], left_r + b["r"]
    return edge


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
               rejected_words: Sequence[str] = REJECTED_HOST_WORDS) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict, score``.

    Where a rule fits, it gives the verdict. Accepted URLs, for training, are those a rule allows
    or no rule knows, rejected ones those with a rejected word in the host and those a rule blocks;
    an allowed URL with such a word trains neither. Every URL counts, as often as it occurs: four of
    five judged texts (by a hash) train the models, the fifth calibrates the cut, by the URLs
    without a rule, as only those are judged by it. A null url is judged by the empty text, one
    without ``://`` by what it is, with empty host and path. Repeated rows are judged alike; an
    empty table gives no rows; input columns with one of the five names are replaced, all others kept
    whatever their names.
    """
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "score")]
    parsed = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("page"), "url",
        host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    named = parsed.select(
        "page", "host", "path", rule_for(F.col("host"), F.col("path"), rules).alias("found"),
        judged_text(F.col("url"), F.col("host")).alias("judged"))
    bad_word = F.col("host").rlike(rf"(^|[.-])({'|'.join(rejected_words)})([.-]|$)")
    verdict, unruled = F.col("found.verdict"), F.col("found.verdict").isNull()

    def times(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    per_text = cut(named.groupBy("judged").agg(
        times((unruled | (verdict == "allow")) & ~bad_word).alias("accepted"),
        times((verdict == "block") | (unruled & bad_word)).alias("rejected"),
        times(unruled & ~bad_word).alias("good"), times(unruled & bad_word).alias("bad")))
    trains = F.pmod(F.xxhash64("judged"), F.lit(5)) != 0
    scored = cut(text_scores(per_text.select(
        "judged", F.when(trains, F.col("accepted")).otherwise(0).alias("accepted"),
        F.when(trains, F.col("rejected")).otherwise(0).alias("rejected"))))
    edge = best_cut(scored.join(per_text, "judged").where(~trains).select(
        "score", F.col("good").alias("accepted"), F.col("bad").alias("rejected")))
    spread = F.xxhash64("judged").alias("spread")
    by_model = F.when(F.col("score") >= edge, "allow").otherwise("block")
    return named.select("*", spread).join(scored.select("*", spread), ["judged", "spread"]).select(
        *[F.col("page")[c].alias(c) for c in own], "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(verdict, by_model).alias("verdict"), "score")
