"""Fingerprints of documents as invertible Bloom lookup tables of paragraph digests.

A paragraph is a run of words that ends with its line, or after a word whose last letter is one of a set,
so that an edit changes the paragraphs around it and no others. A digest has 48 bits and a check of 16. A sketch has three rows of cells; a digest is added to one cell of each row, which counts
digests and keeps their exclusive or. Sketches of equal width subtract cell by cell, which leaves the sketch of the
difference of the sets; peeling takes out a digest wherever a cell holds a single one. A fingerprint holds
two sketches: one with a cell in each row per digest, and one four times as wide, for a second try when peeling gets stuck.

Cells are rows of a table, and a round of peeling is one aggregation by cell. Documents stay in the
partition that their slice of ids has put them into, so no round moves a row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir

# Least width of a sketch's rows, and how much wider that of each try is.
LEAST, WIDER = 8, (1, 4)
# Rounds of peeling by try. A round looks at one of the three rows of cells, so three make a pass.
# After the first passes most pairs have no cells left; those that only counts are wanted of go on as one row each.
ROUNDS, PASSED = (15, 9), 6
# Words in a paragraph at most; ids in one slice of the order of documents.
LONGEST, SLICE = 24, 256
# Bytes of text that a partition is to have. There is a row of cells for each seven of them, and rounds of peeling that have to spill those cost far more.
PORTION = 1 << 23


def _ends() -> str:
    """The characters, in a class, that end a paragraph as a word's last: one of eight, in Latin, Greek and Cyrillic.

    Java tries the characters of a class one by one beyond Latin-1, so these stand behind the ranges that they are in.
    """
    some = lambda low, high: "".join(rf"\u{code:04x}" for code in range(low, high) if code % 8 == 3)
    beyond = "".join(rf"[\u{low:04x}-\u{low + 0x7F:04x}&&[{some(low, min(low + 0x80, 0x530))}]]" for low in range(0x100, 0x530, 0x80))
    return rf"{some(0x21, 0x100)}[\u0100-\u052f&&[{beyond}]]"


ENDS = _ends()

# What a row of the peeling table is: a cell of the difference, a cell of the narrower side, a recovered digest, or how many of them a pair without cells has.
MAIN, NARROW, FOUND, COUNTED = 0, 1, 2, 3
# Rows meet by cell and ``at``, which is pair, kind and the bits of both widths in one number: a short key is what rounds cost least with.
CELL = ["at", "cell"]


def digests(text: Column) -> Column:
    """The distinct digests of a text's paragraphs."""
    word, blank = r"[^\x20\x09-\x0D]++", r"[\x20\x09\x0B-\x0D]"
    goes_on = rf"{word}(?<![{ENDS}]){blank}++"
    paragraph = rf"(?:{goes_on}){{1,{LONGEST - 1}}}+(?:{word})?+|{word}"
    found = F.regexp_extract_all(text, F.lit(paragraph), F.lit(0))
    return F.array_distinct(F.transform(found, lambda p: checked(F.xxhash64(F.rtrim(p, F.lit(" \t\x0b\x0c\r"))))))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def checked(value: Column) -> Column:
    """48 bits of a hash and a check of them in the other 16."""
    upper = value.bitwiseAND(F.lit(~0xFFFF))
    return upper.bitwiseOR(F.xxhash64(upper).bitwiseAND(F.lit(0xFFFF)))


def bits(size: Column, turn: int) -> Column:
    """Bits of a cell's number in a row of a sketch of so many digests."""
    return F.length(F.bin(F.greatest(size, F.lit(LEAST)).cast("long") - 1)) + (WIDER[turn].bit_length() - 1)


def width(size: Column, turn: int) -> Column:
    """Cells in a row of a sketch of so many digests: a power of two."""
    return _cells(bits(size, turn))


def _cells(of_bits: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), of_bits.cast("int"))


def _at(pair: Column, kind: Column, wide: Column, narrow: Column) -> Column:
    """A pair's number (48 bits), what the row is, and the bits of the wider and the narrower side's widths."""
    return pair.cast("long") * (1 << 14) + kind * (1 << 12) + wide * (1 << 6) + narrow


def _pair() -> Column:
    return F.shiftright("at", 14)


def _kind() -> Column:
    return F.shiftright("at", 12).bitwiseAND(F.lit(3))


def _cell(digest: Column, wide: Column, row: int, turn: int) -> Column:
    """The cell of a digest in one row; a cell's number modulo 3 is its row."""
    return F.xxhash64(F.lit(3 * turn + row), digest).bitwiseAND(wide - 1) * 3 + row


def _round(cells: DataFrame, keys: list[str], row: int, turn: int) -> DataFrame:
    """Take out every digest that is alone in a cell of one row. A digest has one cell there, so none is taken twice."""
    wide, narrow = (_cells(F.shiftright("at", low).bitwiseAND(F.lit(63))) for low in (6, 0))
    alone = (
        (_kind() < FOUND)
        & (F.col("cell") % 3 == row)
        & (F.abs("n") == 1)
        & (checked(F.col("x")) == F.col("x"))
        & (_cell(F.col("x"), F.when(_kind() == MAIN, wide).otherwise(narrow), row, turn) == F.col("cell"))
    )

    # What a row becomes, by number: itself; a digest and what it takes out of two cells; the same in the
    # narrower sketch, and what it adds to the three cells of the difference. Numbers keep generated code short.
    after, last = (row + 1) % 3, (row + 2) % 3
    becomes = F.when(~alone, F.expr("array(0)")).when(_kind() == MAIN, F.expr("array(1, 2, 3)")).otherwise(F.expr("array(2, 3, 4, 5, 6)"))
    rows = cells.select(*keys, *CELL, "n", "x", F.explode(becomes).alias("j"))
    j = F.col("j")
    to_main = (j >= 4) | (_kind() == MAIN)
    at = F.when(j >= 4, j - 4).when(j == 2, after).otherwise(last)
    hashed = F.xxhash64(at + 3 * turn, F.col("x")).bitwiseAND(F.when(to_main, wide).otherwise(narrow) - 1) * 3 + at
    rows = rows.select(
        *keys,
        F.when(j == 1, F.col("at") + (FOUND - MAIN) * (1 << 12)).when(j >= 4, F.col("at") + (MAIN - NARROW) * (1 << 12)).otherwise(F.col("at")).alias("at"),
        F.when(j == 0, F.col("cell")).when(j == 1, F.col("x")).otherwise(hashed).alias("cell"),
        F.when((j == 2) | (j == 3), -F.col("n")).otherwise(F.col("n")).alias("n"),
        F.when(j == 1, 0).otherwise(F.col("x")).alias("x"),
    )
    return _summed(rows, keys)


def _summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    sums = rows.groupBy(*keys, *CELL).agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"))
    return sums.where("n != 0 OR x != 0")


def _peeled(cells: DataFrame, keys: list[str], turn: int, counted: bool = False) -> DataFrame:
    """Recovered digests as rows of kind FOUND (``cell`` is the digest, ``n`` its side), and cells that are left.

    With ``counted``, pairs that are done early have their number of digests as ``n`` of one row of kind COUNTED instead.
    """
    cells = _summed(cells, keys)
    for i in range(ROUNDS[turn]):
        if counted and i == PASSED:
            cells = _done_as_counts(cells, keys)
        cells = _round(cells, keys, i % 3, turn)
    return cells


def _done_as_counts(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Nothing becomes of a pair without cells, so its digests need not be carried through further rounds."""
    done = F.min(_kind()).over(Window.partitionBy(*keys, _pair())) == FOUND
    rows = cells.select(*keys, *CELL, "n", "x", done.alias("done"))
    return rows.select(
        *keys,
        F.when(F.col("done"), F.col("at").bitwiseOR(F.lit(0x3FFF))).otherwise(F.col("at")).alias("at"),
        *[F.when(F.col("done"), F.lit(value).cast("long")).otherwise(F.col(name)).alias(name) for name, value in (("cell", 0), ("n", 1), ("x", 0))],
    )


def _counts(peeled: DataFrame, keys: list[str]) -> DataFrame:
    """keys, pair, found, left: digests recovered, and (at least) how many are stuck."""
    # Cells without a count hold a digest of either side.
    stuck = [
        F.coalesce(F.sum(F.when((_kind() < FOUND) & (F.col("cell") % 3 == r), F.greatest(F.abs("n"), F.when(F.col("n") == 0, 2).otherwise(1)))), F.lit(0))
        for r in range(3)
    ]
    return peeled.groupBy(*keys, _pair().alias("pair")).agg(
        F.sum(F.when(_kind() == FOUND, 1).when(_kind() == COUNTED, F.col("n")).otherwise(0)).alias("found"), F.greatest(*stuck).alias("left")
    )


def _as_pairs(sides: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the peeling table from keys, pair, own, other (bits of the widths), sign, cell, n, x."""
    wide, narrow = F.greatest("own", "other"), F.least("own", "other")
    kind = F.when(F.col("own") < F.col("other"), NARROW).otherwise(MAIN)
    return sides.select(*keys, _at(F.col("pair"), kind, wide, narrow).alias("at"), "cell", (F.col("n") * F.col("sign")).cast("long").alias("n"), "x")


def differing(pairs: DataFrame, key: str, left: str = "left", right: str = "right") -> DataFrame:
    """Subtract fingerprints given as text: key, likeness, only_left, only_right (the digests that peeling recovers), complete.

    Nothing but the two texts is read. Pairs whose narrower sketches do not peel are tried again with
    the wider ones. ``complete`` is false where these are stuck too; ``likeness`` then counts what their
    cells hold. Keys are taken to be unique; a NULL fingerprint is that of an empty text. An empty table gives no rows.
    """
    ensure_checkpoint_dir(pairs.sparkSession)
    empty = F.lit("0")
    rows = pairs.select(F.col(key).alias("key"), F.coalesce(left, empty).alias("l"), F.coalesce(right, empty).alias("r"))
    size = lambda c: F.conv(F.substring_index(c, " ", 1), 16, 10).cast("long")
    rows = rows.withColumn("nl", size(F.col("l"))).withColumn("nr", size(F.col("r")))

    def attempt(some: DataFrame, turn: int) -> DataFrame:
        side = lambda c, own, other, sign: F.struct(
            c.alias("print"), bits(own, turn).alias("own"), bits(other, turn).alias("other"), F.lit(sign).alias("sign")
        )
        both = F.array(side(F.col("l"), F.col("nl"), F.col("nr"), 1), side(F.col("r"), F.col("nr"), F.col("nl"), -1))
        sides = some.select("key", F.lit(0).alias("pair"), F.inline(both))
        sides = sides.select("key", "pair", "own", "other", "sign", F.explode(F.split("print", " ")).alias("cell"))
        part = F.split("cell", "\\.")
        number = lambda i: F.conv(part[i], 16, -10).cast("long")
        sides = sides.where((F.size(part) == 4) & (part[0] == str(turn)))
        sides = sides.select("key", "pair", "own", "other", "sign", number(1).alias("cell"), number(2).alias("n"), number(3).alias("x"))
        peeled = _peeled(_as_pairs(sides, ["key"]), ["key"], turn)
        named = lambda sign: F.collect_list(F.when((_kind() == FOUND) & (F.signum("n") == sign), F.col("cell")))
        only = peeled.groupBy("key").agg(F.array_sort(named(1)).alias("only_left"), F.array_sort(named(-1)).alias("only_right"))
        return only.join(_counts(peeled, ["key"]).drop("pair"), "key")

    first = attempt(rows, 0).checkpoint()
    stuck = first.where("left > 0").select("key")
    second = attempt(rows.join(stuck, "key", "left_semi"), 1)
    told = first.where("left = 0").unionByName(second)
    none = F.array().cast("array<bigint>")
    apart = F.coalesce(F.col("found") + F.col("left"), F.lit(0))
    return rows.join(told, "key", "left").select(
        F.col("key").alias(key),
        likeness(F.col("nl"), F.col("nr"), apart).alias("likeness"),
        F.coalesce("only_left", none).alias("only_left"),
        F.coalesce("only_right", none).alias("only_right"),
        (F.coalesce("left", F.lit(0)) == 0).alias("complete"),
    )


def likeness(a: Column, b: Column, apart: Column) -> Column:
    """Digests in common by digests in either, from both sizes and the size of the difference; 1 for two empty sets."""
    return F.when(a + b == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), (a + b - apart) / (a + b + apart)))


def _following(rows: DataFrame) -> DataFrame:
    """slice, after: the next slice that has rows; after the last comes the first. No task gets more than a few thousand slices."""
    slices = rows.select("slice").distinct().withColumn("group", F.floor(F.col("slice") / 4096))
    groups = slices.groupBy("group").agg(F.min("slice").alias("first"))
    whole = Window.partitionBy(F.lit(1))
    groups = groups.select(
        "group", F.coalesce(F.lead("first").over(whole.orderBy("group")), F.min("first").over(whole)).alias("beyond")
    )
    inside = Window.partitionBy("group").orderBy("slice")
    return (
        slices.withColumn("lead", F.lead("slice").over(inside))
        .join(groups, "group")
        .select("slice", F.coalesce("lead", "beyond").alias("after"))
    )


def portions(docs: DataFrame, text: str) -> int:
    """Partitions that texts are dealt to, by their size."""
    size = F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long") + 64
    return (docs.agg(F.sum(size)).first()[0] or 0) // PORTION + 1


def with_next(docs: DataFrame, doc_id: str, text: str, n: int | None = None) -> DataFrame:
    """doc_id, text, set, following, following_set, slice, row: the text of the next document by ascending id; after the last comes the first.

    Documents lie in slices of neighbouring ids. The first document of a slice is also put at the end of
    the slice before, so no slice needs to see another. ``set`` and ``following_set`` are the digests of both texts.
    Slices are dealt to ``n`` partitions; what is dealt like this too can be joined by slice without moving a text again.
    """
    n = n or portions(docs, text)
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63)).cast("long"))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), key.alias("key")
    ).withColumn("slice", F.coalesce(F.floor(F.col("key") / SLICE), F.lit(0)))
    order = F.struct("key", F.xxhash64("text"))
    firsts = rows.groupBy("slice").agg(F.min_by("text", order).alias("text"))
    ends = _following(rows).join(firsts.withColumnRenamed("slice", "after"), "after")
    ends = ends.select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(None).cast("long").alias("key"), "slice", F.lit(True).alias("end"))
    both = rows.withColumn("end", F.lit(False)).unionByName(ends).repartition(n, "slice").withColumn("set", digests(F.col("text")))
    # All that read these rows read all columns that are dealt, so that one plan deals them once: hence the id in the order, and slices that are never NULL.
    by_id = Window.partitionBy("slice").orderBy("end", "key", F.xxhash64("text"), "doc_id")
    after = {"following": F.lead("text").over(by_id), "following_set": F.lead("set").over(by_id), "row": F.row_number().over(by_id)}
    return both.withColumns(after).where("NOT end").select("doc_id", "text", "set", "following", "following_set", "slice", "row")


KEYS = ["slice", "row"]


def edited_fingerprints(
    docs: DataFrame, shown: Callable[[Column], Column] = lambda edited: edited, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Fingerprint every text and its edited form: doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last half replaced by the first characters of the next document; ``edited`` is
    ``shown`` of it. ``near_edited`` is the likeness of the text's fingerprint to that of the edited text, ``near_next`` to that of
    the next document: shared paragraphs by all paragraphs of both. Each follows from cells of the two
    fingerprints alone, and ``differing`` gives the same from their texts. Where two sketches of a pair do not peel, the wider ones
    are subtracted; where these do not either (never seen), what their cells count stands for what is stuck.

    NULL and empty texts have no paragraphs; two of them are alike (1.0), and equal texts have equal
    fingerprints. A NULL id comes before all others. Rows that repeat an id stand in the order of a hash of
    their texts and are answered one by one. A single document is its own next. An empty table gives
    no rows. Very long texts are whole; their cells are rows, but a fingerprint is one value. Other columns do not matter.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    n = portions(docs, text)
    rows = with_next(docs, doc_id, text, n)
    half = F.expr("length(text) div 2").cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("following", F.lit(1), half))
    rows = rows.withColumn("edited", edited)
    first = _sizes(rows, 0).checkpoint()
    # Rows of a slice are told together, so that texts need not move to meet them.
    stuck = first.where("left > 0").groupBy("slice").agg(F.collect_set("row").alias("stuck")).repartition(n, "slice")
    again = rows.join(stuck, "slice").where(F.array_contains("stuck", F.col("row"))).drop("stuck")
    return _printed(rows, first, _sizes(again, 1), shown, n)


def _three() -> Column:
    """The digests of a row's text, its edited text and the next text."""
    return F.array(F.col("set"), digests(F.col("edited")), F.col("following_set"))


def _pairs(rows: DataFrame, turn: int) -> DataFrame:
    """The peeling table of text and edited text (pair 2 * row), and of text and next text (pair 2 * row + 1)."""

    def of_sides(sets: Column) -> Column:
        own = [bits(F.size(sets[i]), turn) for i in range(3)]
        side = lambda pair, i, other, sign: F.struct(
            (F.col("row").cast("long") * 2 + pair).alias("pair"), sets[i].alias("set"), own[i].alias("own"), own[other].alias("other"), F.lit(sign).alias("sign")
        )
        return F.array(side(0, 0, 1, 1), side(1, 0, 2, 1), side(0, 1, 0, -1), side(1, 2, 0, -1))

    sides = rows.select("slice", F.inline(_bound(_three(), of_sides)))
    digest = sides.select("slice", "pair", "own", "other", "sign", F.explode("set").alias("x"))
    each = F.array(*[_cell(F.col("x"), _cells(F.col("own")), r, turn) for r in range(3)])
    # Sums by cell make the sketches of the texts, which are those of their fingerprints, and subtract them in one go.
    placed = digest.select("slice", "pair", "own", "other", "sign", F.explode(each).alias("cell"), F.lit(1).alias("n"), "x")
    return _as_pairs(placed, ["slice"])


def _sizes(rows: DataFrame, turn: int) -> DataFrame:
    """slice, row, pair (0: edited text, 1: next text), found, left."""
    counts = _counts(_peeled(_pairs(rows, turn), ["slice"], turn, counted=True), ["slice"])
    return counts.select("slice", F.shiftright("pair", 1).cast("int").alias("row"), (F.col("pair") % 2).cast("int").alias("pair"), "found", "left")


def _printed(rows: DataFrame, first: DataFrame, second: DataFrame, shown: Callable[[Column], Column], n: int) -> DataFrame:
    """The result, from texts and the sizes of their differences."""
    # Both pairs of a row are tried again where one is stuck.
    told = first.where("left = 0").unionByName(second).groupBy(*KEYS, "pair").agg(F.min_by(F.col("found") + F.col("left"), "left").alias("apart"))
    told = told.groupBy("slice").agg(F.map_from_entries(F.collect_list(F.struct(F.struct("row", "pair"), "apart"))).alias("told")).repartition(n, "slice")
    rows = rows.join(told, "slice", "left").withColumn("edited_shown", shown(F.col("edited")))
    apart = [F.coalesce(F.col("told")[F.struct(F.col("row"), F.lit(pair).alias("pair"))], F.lit(0)).alias(f"apart{pair}") for pair in (0, 1)]
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "edited_shown", *apart, "set", "edited", "following_set")

    def of_sets(sets: Column) -> Column:
        size = [F.size(sets[i]) for i in range(3)]
        near = [likeness(size[0], size[pair + 1], F.col(f"apart{pair}")) for pair in (0, 1)]
        return F.struct(
            as_text(sets[0]).alias("fingerprint"), as_text(sets[1]).alias("edited_fingerprint"),
            near[0].alias("near_edited"), near[1].alias("near_next"),
        )

    return rows.select("doc_id", "n_chars", F.col("edited_shown").alias("edited"), F.inline(F.array(_bound(_three(), of_sets))))


def as_text(digest: Column) -> Column:
    """The fingerprint of a set of digests: its size, and the cells of both sketches in order, as turn.cell.count.digests in hexadecimal.

    Digests are sorted by cell within their row of the table, so cells are runs and meet without a join or an aggregation.
    What is sorted is one number for a cell and the place of a digest in the set, of 28 bits: a set that needs more has no text that a value can hold.
    """
    place = F.lit((1 << 28) - 1)
    digest_at = lambda entry: F.get(digest, entry.bitwiseAND(place).cast("int"))
    cell_of = lambda entry: F.shiftright(entry, 28)

    def sketch(turn: int) -> Column:
        def of_width(wide: Column) -> Column:
            placed = lambda x, i: F.array(*[F.call_function("shiftleft", _cell(x, wide, r, turn), F.lit(28)).bitwiseOR(i) for r in range(3)])
            return _bound(F.sort_array(F.flatten(F.transform(digest, placed))), of_entries)

        def of_entries(entries: Column) -> Column:
            is_first = lambda entry, i: F.when((i > 0) & (cell_of(F.get(entries, i - 1)) == cell_of(entry)), F.lit(None)).otherwise(i)
            return _bound(F.array_compact(F.transform(entries, is_first)), lambda firsts: F.transform(firsts, lambda at, i: one(entries, firsts, at, i)))

        def one(entries: Column, firsts: Column, at: Column, i: Column) -> Column:
            entry = F.get(entries, at)
            n = F.coalesce(F.get(firsts, i + 1), F.size(entries)) - at
            together = F.aggregate(F.slice(entries, at + 1, n), F.lit(0).cast("long"), lambda some, e: some.bitwiseXOR(digest_at(e)))
            shown = lambda n, x: F.concat(F.lit(f"{turn:X}."), F.hex(cell_of(entry)), n, F.lower(F.hex(x)))
            return F.when(n == 1, shown(F.lit(".1."), digest_at(entry))).otherwise(shown(F.concat(F.lit("."), F.hex(n), F.lit(".")), together))

        return _bound(width(F.size(digest), turn), of_width)

    return F.concat_ws(" ", F.hex(F.size(digest)), F.array_join(F.concat(*[sketch(turn) for turn in range(len(WIDER))]), " "))
