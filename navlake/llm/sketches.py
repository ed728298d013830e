"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A sketch is a table of cells; each paragraph digest is added to one cell in each of three
sections, as a count and an exclusive-or sum. Cells of two versions subtract, which leaves
what differs; a cell with one digest left gives it up, and peeling it from its other cells frees
more. Digests are dealt into parts by hash, so a part is small however long the text is. A
fingerprint has as many parts as its text's digests ask for, and a part too dense to be peeled by
itself is sketched larger: two fingerprints alone tell which digests differ.
"""

from pyspark.sql import Column, DataFrame, functions as F

from navlake.llm.common import cut, number_rows, repeat_rows


def _spread_class(low: int, high: int, step: int, width: int) -> str:
    """A class of characters: the first ``width`` of every ``step`` code points."""
    return "".join(f"\\u{c:04x}-\\u{c + width - 1:04x}" for c in range(low, high, step))


#: Signs that end a sentence where a space follows, and those that do so by themselves. A text is cut
#: into paragraphs behind them and at line ends.
SENTENCE_ENDS = (". ", "! ", "? ")
FULL_STOPS = ("\u3002", "\uff01", "\uff1f")

#: A paragraph of so many characters is cut further, at places that the character before them
#: decides, so that an insertion moves no other cut: at some spaces, then, in scripts without
#: spaces, behind some signs.
LONG_PARAGRAPH = 400
#: A sign of one byte is not held against the many ranges of the others.
AT_SPACES = (
    r" (?:(?<=[bcdfgBCDFG05] )|(?<=[^\u0000-\u007f] )(?<=[" + _spread_class(0x370, 0x2000, 64, 16) + "] ))")
BEHIND_SIGNS = "(?<=[" + _spread_class(0x3000, 0xD700, 256, 12) + "])"

SECTIONS = 3

#: Cells per section of a part, by level: each level is a larger sketch for parts that the one before fails for.
CELLS = (16, 64, 512)

#: Digests a part should hold.
PART_DIGESTS = 10

#: Parts that are dealt out in one step; more are dealt in two.
DEAL = 16

ROUNDS = 4

#: Low bits of a key that are a check sum of the others.
CHECK_BITS = 16


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is referred to.

    That is the start and the end of an aggregate of nothing: unlike a transform, it makes no copy of an array.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda same, _: same, use)


def paragraphs(text: Column) -> Column:
    ended = text
    for sign in SENTENCE_ENDS:
        ended = F.replace(ended, F.lit(sign), F.lit(sign[0] + "\n"))
    plain = ended
    for sign in FULL_STOPS:
        ended = F.replace(ended, F.lit(sign), F.lit(sign + "\n"))
    # Characters of one byte each hold no such stop.
    ended = F.when(F.octet_length(text) == F.length(text), plain).otherwise(ended)

    def further(pieces: Column, pattern: str) -> Column:
        return F.when(F.exists(pieces, lambda p: F.length(p) > LONG_PARAGRAPH), F.flatten(F.transform(
            pieces, lambda p: F.when(F.length(p) > LONG_PARAGRAPH, F.split(p, pattern, -1)).otherwise(F.array(p))
        ))).otherwise(pieces)

    return _bound(F.split(ended, "\n", -1), lambda pieces: _bound(
        further(pieces, AT_SPACES), lambda some: further(some, BEHIND_SIGNS)))


def _checked(bits: Column) -> Column:
    """A key from a hash: its upper bits, and in the lower ones a check sum of them."""
    upper = F.shiftleft(F.shiftrightunsigned(bits, CHECK_BITS), CHECK_BITS)
    return upper.bitwiseOR(F.xxhash64(upper).bitwiseAND((1 << CHECK_BITS) - 1))


def _is_key(value: Column) -> Column:
    return value == _checked(value)


def digests(text: Column) -> Column:
    """Distinct digests of a text's paragraphs, as checked keys: a repeated one counts by its occurrence."""

    def occurrence(all_: Column, h: Column, i: Column) -> Column:
        # Equal hashes stand together: the distance to the first of them, by halving steps.
        return F.when(F.get(all_, i - 1) == h, F.aggregate(
            F.array(*[F.lit(1 << j) for j in range(30, -1, -1)]), F.lit(0),
            lambda t, step: F.when((i - t - step >= 0) & (F.get(all_, i - t - step) == h), t + step).otherwise(t))).otherwise(0)

    def keys(all_: Column) -> Column:
        return F.when(
            F.size(F.array_distinct(all_)) == F.size(all_), F.transform(all_, lambda h: _checked(F.xxhash64(h, F.lit(0))))
        ).otherwise(F.transform(all_, lambda h, i: _checked(F.xxhash64(h, occurrence(all_, h, i)))))

    return _bound(F.sort_array(F.transform(paragraphs(text), lambda p: F.xxhash64(p))), keys)


def parts_of(*keys: Column) -> Column:
    """How many parts sets of digests are dealt into."""
    total = F.size(keys[0])
    for more in keys[1:]:
        total = total + F.size(more)
    return F.greatest(F.lit(1), F.ceil(total / PART_DIGESTS).cast("int"))


def _part_number(key: Column, parts: Column) -> Column:
    """The part by the key's upper bits."""
    return F.shiftright(F.shiftrightunsigned(key, 33) * parts, 31).cast("int")


def dealt(keys: Column, parts: Column) -> Column:
    """Array of the digests of each part; many parts by way of groups of neighbouring ones."""

    def direct(some: Column, low: Column, count: Column) -> Column:
        numbered = F.transform(some, lambda k: F.struct(k.alias("k"), _part_number(k, parts).alias("n")))
        return _bound(numbered, lambda all_: F.transform(
            F.sequence(low, low + count - 1), lambda n: F.filter(all_, lambda k: k["n"] == n)["k"]))

    def by_groups() -> Column:
        return F.flatten(F.transform(F.sequence(F.lit(0), F.floor((parts - 1) / DEAL).cast("int")), lambda g: direct(
            F.filter(keys, lambda k: F.floor(_part_number(k, parts) / DEAL) == g),
            g * DEAL, F.least(F.lit(DEAL), parts - g * DEAL))))

    return F.when(parts == 1, F.array(keys)).when(
        parts <= DEAL, direct(keys, F.lit(0), parts)).otherwise(by_groups())


def _place(key: Column, level: int) -> Column:
    """The key's cells in all sections, sixteen bits for each."""
    mask = sum(CELLS[level] - 1 << 16 * section for section in range(SECTIONS))
    return F.xxhash64(key, F.lit(level)).bitwiseAND(F.lit(mask).cast("long"))


def _placed(keys: Column, level: int) -> Column:
    """Each key with its cells ``s0, s1, s2``, one in each section."""
    return F.transform(
        F.transform(keys, lambda k: F.struct(k.alias("key"), _place(k, level).alias("place"))),
        lambda k: F.struct(k["key"].alias("key"), *[
            F.shiftrightunsigned(k["place"], 16 * section).bitwiseAND(CELLS[level] - 1).cast("int").alias(f"s{section}")
            for section in range(SECTIONS)]))


def _sum(keys: Column) -> Column:
    return F.aggregate(keys, F.lit(0).cast("long"), lambda total, k: total.bitwiseXOR(k["key"]))


def _cell(n: Column, key: Column) -> Column:
    return F.struct(n.alias("n"), key.alias("key"))


def _empty() -> Column:
    return _cell(F.lit(0), F.lit(0).cast("long"))


def sketch(keys: Column, level: int = 0) -> Column:
    """Array of cells ``n, key``, section by section.

    Bits of the positions taken in a section, modulo 64, spare most of its empty cells a look at the keys.
    """

    def filled(placed: Column, section: int) -> Column:
        at = f"s{section}"
        taken = F.aggregate(placed, F.lit(0).cast("long"), lambda bits, k: bits.bitwiseOR(
            F.call_function("shiftleft", F.lit(1).cast("long"), k[at])))
        return _bound(taken, lambda bits: F.transform(
            F.transform(F.sequence(F.lit(0), F.lit(CELLS[level] - 1)), lambda c: F.call_function(
                "shiftleft", F.lit(1).cast("long"), c)), lambda bit, c: F.when(bits.bitwiseAND(bit) == 0, _empty()
            ).otherwise(_bound(F.filter(placed, lambda k: k[at] == c), lambda some: _cell(F.size(some), _sum(some))))))

    return _bound(_placed(keys, level), lambda placed: F.concat(*[
        filled(placed, section) for section in range(SECTIONS)]))


def subtract(left: Column, right: Column) -> Column:
    """The cells of sketches subtracted; one with no digest in either stays empty."""
    return F.zip_with(left, right, lambda a, b: F.when((a["n"] == 0) & (b["n"] == 0), _empty()).otherwise(
        _cell(a["n"] - b["n"], a["key"].bitwiseXOR(b["key"]))))


def peel(difference: Column, level: int = 0) -> Column:
    """Array of ``key, n`` (1 only left, -1 only right) that differ; null if peeling gets stuck.

    Only cells that hold something are gone through. In a turn, the cells left with a single key give it
    up, and these keys are taken out of the others. Each must be ``met`` in all its sections, else the sum
    of several keys was taken for one, and the sketch is stuck.
    """

    def cell(n: Column, key: Column, of: Column, met: Column) -> Column:
        return F.struct(
            n.alias("n"), key.alias("key"), of["section"].alias("section"), of["at"].alias("at"), met.alias("met"))

    def holding(cells: Column) -> Column:
        return F.filter(cells, lambda c: (c["n"] != 0) | (c["key"] != 0))

    def belongs(place: Column, to: Column) -> Column:
        own = F.call_function("shiftrightunsigned", place, to["section"] * 16)
        return own.bitwiseAND(CELLS[level] - 1) == to["at"]

    def single(c: Column) -> Column:
        return (F.abs(c["n"]) == 1) & _is_key(c["key"]) & belongs(_place(c["key"], level), c)

    def turn(state: Column, _: Column) -> Column:
        return F.when(F.size(state["cells"]) == 0, state).otherwise(taking(state))

    def taking(state: Column) -> Column:
        return _bound(F.filter(state["cells"], single), lambda alone: _bound(
            F.concat(found(alone, 1), found(alone, -1)), lambda keys: _bound(
                taken(state["cells"], keys), lambda left: F.struct(
                    holding(left).alias("cells"), F.concat(state["found"], keys).alias("found"),
                    (state["right"] & (F.aggregate(left, F.size(alone), lambda met, c: met + c["met"])
                                       == SECTIONS * F.size(keys))).alias("right")))))

    def found(alone: Column, n: int) -> Column:
        return F.transform(F.array_distinct(F.filter(alone, lambda c: c["n"] == n)["key"]), lambda k: F.struct(
            k.alias("key"), F.lit(n).alias("n"), _place(k, level).alias("place")))

    def taken(cells: Column, keys: Column) -> Column:
        others = _bound(keys["key"], lambda gone: F.filter(
            cells, lambda c: (F.abs(c["n"]) != 1) | ~F.array_contains(gone, c["key"])))
        return F.transform(others, lambda c: F.aggregate(
            keys, cell(c["n"], c["key"], c, F.lit(0)), lambda c, k: F.when(belongs(k["place"], c), cell(
                c["n"] - k["n"], c["key"].bitwiseXOR(k["key"]), c, c["met"] + 1)).otherwise(c)))

    def numbered(c: Column, i: Column) -> Column:
        return F.when((c["n"] != 0) | (c["key"] != 0), F.struct(
            c["n"].alias("n"), c["key"].alias("key"), F.floor(i / CELLS[level]).cast("int").alias("section"),
            (i % CELLS[level]).alias("at"), F.lit(0).alias("met")))

    start = F.struct(
        F.array_compact(F.transform(difference, numbered)).alias("cells"),
        F.array().cast("array<struct<key:bigint,n:int,place:bigint>>").alias("found"), F.lit(True).alias("right"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS * (level + 1))), start, turn,
        lambda s: F.when(s["right"] & (F.size(s["cells"]) == 0), s["found"]))


def _differing(left: Column, right: Column, level: int = 0) -> Column:
    """How many digests of a part differ: its sketches are subtracted and peeled, larger ones on failure."""
    if level == len(CELLS):
        # Stuck in every size, which no part is expected to be: counted without a sketch.
        return F.size(F.array_except(left, right)) + F.size(F.array_except(right, left))
    found = peel(subtract(sketch(left, level), sketch(right, level)), level)
    return F.coalesce(F.array_size(found), _differing(left, right, level + 1))


def likeness(left: Column, right: Column) -> Column:
    """1 less the share of digests that differ, among those of both texts.

    Both are dealt into as many parts as the digests of the two together ask for.
    """
    parts = parts_of(left, right)

    def of(count: Column) -> Column:
        each = F.arrays_zip(dealt(left, count).alias("l"), dealt(right, count).alias("r"))
        differing = F.aggregate(
            F.transform(each, lambda p: _differing(p["l"], p["r"])), F.lit(0), lambda total, n: total + n)
        return 1 - differing / (F.size(left) + F.size(right))

    return _bound(parts, of)


def _cell_bytes(cells: Column) -> Column:
    """The cells as text: nine bytes each, a count and a key, in base 64."""
    lines = F.base64(F.unhex(F.array_join(F.transform(cells, lambda c: F.when(c["n"] == 0, "0" * 18).otherwise(F.concat(
        F.lpad(F.hex(c["n"].cast("long")), 2, "0"), F.lpad(F.hex(c["key"]), 16, "0")))), "")))
    return F.replace(lines, F.lit("\r\n"), F.lit(""))


def _part_text(keys: Column, level: int = 0) -> Column:
    """A part's sketch, of the first level at which it is sparse and no two digests share all their cells.

    Such a sketch gives its digests back, but for rare circles of more than two.
    """
    if level == len(CELLS) - 1:
        return _cell_bytes(sketch(keys, level))
    places = F.transform(keys, lambda k: _place(k, level))
    fits = (F.size(keys) <= 2 * CELLS[level]) & (F.size(F.array_distinct(places)) == F.size(keys))
    return F.when(fits, _cell_bytes(sketch(keys, level))).otherwise(_part_text(keys, level + 1))


def fingerprint(keys: Column) -> Column:
    """The sketches of all parts, by part, with dots between them."""
    return F.array_join(F.transform(dealt(keys, parts_of(keys)), lambda part: _part_text(part)), ".")


#: Stands for a null doc_id, which comes last.
NO_ID = -(1 << 63)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("id"),
        F.xxhash64(text).alias("mark"), text.alias("text"))


def next_documents(docs: DataFrame) -> DataFrame:
    """``id, mark, copies, owner_id, owner_mark, owner_chars``: whose next document each is.

    The order is by falling doc_id, null last, then by falling hash of the text; the first
    document comes after the last. Rows that repeat both are one place with ``copies``.
    """
    narrow = _keyed(docs).groupBy("id", "mark", F.length("text").alias("n_chars")).agg(F.count(F.lit(1)).alias("copies"))
    numbered = number_rows(narrow, [F.desc("id"), F.desc("mark")], "place", "total")
    owner = numbered.select(
        F.pmod(F.col("place") + 1, F.col("total")).alias("place"), F.col("id").alias("owner_id"),
        F.col("mark").alias("owner_mark"), F.col("n_chars").alias("owner_chars"))
    return numbered.join(owner, "place").select(
        "id", "mark", "copies", "owner_id", "owner_mark", "owner_chars")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness.

    The edited text has its last half replaced by the beginning of the next document, by
    falling doc_id. Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. A null text counts as empty, a null doc_id comes last; of rows
    that repeat doc_id and text each has the next as its successor. A single document follows
    itself; an empty table gives no rows. Other columns are not read.

    Each text moves once, to meet its own successor's beginning, and each beginning once more,
    as long as it is needed: both sides ask for the same columns, so Spark shuffles the texts
    for the two of them together.
    """
    order = cut(next_documents(docs))
    once = _keyed(docs).dropDuplicates(["id", "mark"])
    placed = once.join(order, ["id", "mark"])
    own = placed.select("id", "mark", "text", "copies")
    heads = placed.select(
        F.col("owner_id").alias("id"), F.col("owner_mark").alias("mark"),
        F.expr("left(text, cast(floor(owner_chars / 2) as int))").alias("head"),
        digests(F.col("text")).alias("next_keys"))
    met = own.join(heads, ["id", "mark"])
    # A repeated row's next is its repetition, but for the last.
    again = own.where("copies > 1").select(
        *own.columns, F.expr("left(text, cast(floor(length(text) / 2) as int))").alias("head"),
        digests(F.col("text")).alias("next_keys"))
    pairs = met.withColumn("copies", F.lit(1).cast("long")).unionByName(
        again.withColumn("copies", F.col("copies") - 1))
    edited = pairs.withColumn(
        "edited", F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))"), "head")
    ).select(
        F.nullif(F.col("id"), F.lit(NO_ID).cast("long")).alias("doc_id"),
        F.length("text").alias("n_chars"), "copies", "next_keys", F.sha2("edited", 256).alias("edited_sha256"),
        digests(F.col("text")).alias("keys"), digests(F.col("edited")).alias("edited_keys"))
    result = edited.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
        fingerprint(F.col("keys")).alias("fingerprint"),
        fingerprint(F.col("edited_keys")).alias("edited_fingerprint"),
        likeness(F.col("keys"), F.col("edited_keys")).alias("near_edited"),
        likeness(F.col("keys"), F.col("next_keys")).alias("near_next"),
        "copies")
    return repeat_rows(result, "copies", "copy").drop("copies", "copy")
