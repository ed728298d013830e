"""Personal data by anchor expansion.

One Aho-Corasick pass finds the anchors: at-signs, schemes, digits, signs before digits, and cues such as
``IBAN`` or ``password=``. From each anchor a small parser walks left and right to the bounds of what
stands there and checks it. A parser never walks over what its kind has already taken, so a text takes
time in proportion to its length.
"""

from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

#: Kinds in the order they are listed. The first four have fixed patterns.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "userinfo", "iban", "ssn", "account", "key", "password")

DIGITS = frozenset("0123456789")
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
WORD = DIGITS | LETTERS
LOCAL = WORD | frozenset("._%+-")
LABEL = WORD | {"-"}
OF_PHONE = DIGITS | frozenset(" ().-")
BLANK = frozenset(" \t:=#.")
USER = WORD | frozenset("._~%!$&'*+;=:-")
UPPER = DIGITS | frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")

#: A parser gets the text, the anchor's first place and the place after it, and the place before
#: which its kind has taken everything. It gives the span or None, and how far the kind has taken.
Found = tuple[tuple[int, int] | None, int]
Parser = Callable[[str, int, int, int], Found]


def _right(text: str, at: int, of: frozenset) -> int:
    n = len(text)
    while at < n and text[at] in of:
        at += 1
    return at


def _left(text: str, at: int, low: int, of: frozenset) -> int:
    while at > low and text[at - 1] in of:
        at -= 1
    return at


def _labels(text: str, at: int) -> tuple[int, int]:
    """Past the last of the labels joined by dots that begin at ``at``, and how many there are."""
    end, count = _right(text, at, LABEL), 0
    while end > at:
        count += 1
        if text[end:end + 1] != ".":
            break
        further = _right(text, end + 1, LABEL)
        if further == end + 1:
            break
        at, end = end + 1, further
    return end, count


def email(text: str, at: int, past: int, low: int) -> Found:
    start = _left(text, at, low, LOCAL)
    if start == at:
        return None, low
    end, labels = _labels(text, past)
    return ((start, end), end) if labels > 1 else (None, low)


def ip(text: str, at: int, past: int, low: int) -> Found:
    """The anchor is a dot before a digit; four numbers joined by dots are taken, right or wrong."""
    begin = start = _left(text, at, low, DIGITS)
    if start == at:
        return None, low
    sound, end = True, at
    for part in range(4):
        end = _right(text, begin, DIGITS)
        if end == begin:
            return None, low
        number = text[begin:end].lstrip("0")
        sound = sound and (len(number) < 3 or len(number) == 3 and number <= "255")
        if part < 3:
            if text[end:end + 1] != ".":
                return None, low
            begin = end + 1
    return ((start, end) if sound else None), end


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def card(text: str, at: int, past: int, low: int) -> Found:
    """Digits with one space or hyphen between two at most; the anchor is the first of them."""
    end = _right(text, at, DIGITS)
    while text[end:end + 1] in (" ", "-") and text[end + 1:end + 2] in DIGITS:
        end = _right(text, end + 1, DIGITS)
    if end - at < 40:  # 19 digits and what may lie between
        digits = text[at:end].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            return (at, end), end
    return None, end


def phone(text: str, at: int, past: int, low: int) -> Found:
    """The anchor is a plus sign and a digit; a digit ends it, with one sign between at least."""
    end = _right(text, past, OF_PHONE)
    while end > past + 1 and text[end - 1] not in DIGITS:
        end -= 1
    if end < past + 2:
        return None, low
    count = sum(c in DIGITS for c in text[at:end])
    return ((at, end) if 8 <= count <= 15 else None), end


def userinfo(text: str, at: int, past: int, low: int) -> Found:
    """Name and password between a scheme and the host: ``://name:password@host``."""
    end = _right(text, past, USER)
    inside = text[past:end]
    if text[end:end + 1] == "@" and ":" in inside[1:-1] and text[end + 1:end + 2] in LABEL:
        return (past, end), end
    return None, low


def _after_cue(text: str, past: int, most: int = 12) -> int:
    """Past the separators that may follow a cue."""
    end = past
    while end - past < most and text[end:end + 1] in BLANK and end < len(text):
        end += 1
    return end


def _whole(text: str, start: int, end: int) -> bool:
    """Whether no word goes on beyond either end."""
    return (start == 0 or text[start - 1] not in WORD) and text[end:end + 1] not in WORD


def iban(text: str, at: int, past: int, low: int) -> Found:
    start = end = _after_cue(text, past)
    letters = ""
    while end < len(text) and len(letters) < 35:
        if text[end] in UPPER:
            letters += text[end]
        elif text[end] != " " or len(letters) % 4 or text[end + 1:end + 2] not in UPPER:
            break
        end += 1
    sound = (15 <= len(letters) <= 34 and letters[:2].isalpha() and letters[2:4].isdigit() and _whole(text, start, end)
             and int("".join(str(int(c, 36)) for c in letters[4:] + letters[:4])) % 97 == 1)
    return ((start, end), end) if sound else (None, low)


def ssn(text: str, at: int, past: int, low: int) -> Found:
    start = _after_cue(text, past)
    number = text[start:start + 11]
    area, group, serial = number[:3], number[4:6], number[7:]
    sound = (len(number) == 11 and number[3] == number[6] and number[3] in "- " and set(area + group + serial) <= DIGITS
             and area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
             and _whole(text, start, start + 11))
    return ((start, start + 11), start + 11) if sound else (None, low)


def account(text: str, at: int, past: int, low: int) -> Found:
    start = _after_cue(text, past)
    end = _right(text, start, DIGITS)
    sound = 6 <= end - start <= 17 and _whole(text, start, end)
    return ((start, end), end) if sound else (None, low)


def key(text: str, at: int, past: int, low: int) -> Found:
    """Twenty capitals and digits that begin with the cue."""
    end = _right(text, past, UPPER)
    return ((at, end), end) if end - at == 20 and _whole(text, at, end) else (None, end)


def password(text: str, at: int, past: int, low: int) -> Found:
    end = past
    while end < len(text) and not text[end].isspace() and text[end] not in "\"'<>,;":
        end += 1
    return ((past, end), end) if end - past >= 6 and text[at - 1:at] not in WORD else (None, low)


PARSERS: dict[str, Parser] = {f.__name__: f for f in (
    email, ip, card, phone, userinfo, iban, ssn, account, key, password)}

# What calls for a parser. Words are looked for in lower case, capitalised and in capitals.
SIGNS = {
    "email": ["@"], "ip": [f".{d}" for d in "0123456789"], "card": list("0123456789"),
    "phone": [f"+{d}" for d in "0123456789"], "userinfo": ["://"], "key": ["AKIA", "ASIA"],
}
CUES = {
    "iban": ["iban"],
    "ssn": ["ssn", "social security number", "social security no"],
    "account": ["account number", "account no", "acct no", "acct", "kontonummer", "account #"],
    "password": ["password=", "password: ", "passwd=", "pwd=", "api_key=", "apikey=", "secret=", "token="],
}


def automaton() -> ahocorasick.Automaton:
    called: dict[str, str] = {s: kind for kind, signs in SIGNS.items() for s in signs}
    for kind, cues in CUES.items():
        called |= {spelt: kind for cue in cues for spelt in (cue, cue.capitalize(), cue.title(), cue.upper())}
    found = ahocorasick.Automaton()
    for sign, kind in called.items():
        found.add_word(sign, (len(sign), kind))
    found.make_automaton()
    return found


def spans(text: str, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """``kind, start, end`` (code points, end exclusive), by kind as listed, then by start."""
    found: dict[str, list[tuple[int, int]]] = {}
    taken = dict.fromkeys(KINDS, 0)
    for last, (length, kind) in anchors.iter(text):
        at = last + 1 - length
        if at >= taken[kind]:
            span, taken[kind] = PARSERS[kind](text, at, last + 1, taken[kind])
            if span is not None:
                found.setdefault(kind, []).append(span)
    return [(kind, *span) for kind in KINDS for span in sorted(found.get(kind, ()))]


def redact(text: str, found: list[tuple[str, int, int]]) -> str:
    """The text with each stretch that spans cover replaced by the first one's kind in brackets."""
    parts, at = [], 0
    for start, end, kind in sorted((s, -e, k) for k, s, e in found):
        if start >= at:
            parts += [text[at:start], f"[{kind}]"]
        at = max(at, -end)
    return "".join([*parts, text[at:]])


SPANS = "array<struct<kind: string, start: int, end: int>>"


def _found(text: Column, redacted: bool) -> Column:
    @F.pandas_udf(f"spans {SPANS}, redacted string")
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        anchors = automaton()
        for batch in batches:
            rows, texts = [], []
            for t in batch:
                found = spans(t or "", anchors)
                rows.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
                texts.append(redact(t, found) if redacted and found else None)
            yield pd.DataFrame({"spans": rows, "redacted": texts})

    return of_batches(text)


def find_personal(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc`` (all columns of ``docs``) and ``spans``, the personal data of the whole text.

    Null and empty texts have none. Repeated rows are scanned alike, other columns are carried whatever
    their names, and an empty table gives no rows. No row moves.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    return whole.select("doc", _found(F.col("doc")[text], False)["spans"].alias("spans"))


def redact_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced by its kind in brackets; nulls stay null."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    found = whole.withColumn("found", _found(F.col("doc")[text], True))
    return found.select(*[
        (F.coalesce("found.redacted", F.col("doc")[c]) if c == text else F.col("doc")[c]).alias(c) for c in docs.columns])


def _written(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts and a checksum of the four fixed kinds, and all spans as text."""
    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = of(*BASE_KINDS)
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.select(
        "doc.doc_id", *counts, F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))
