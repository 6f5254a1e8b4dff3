"""Document fingerprints: invertible Bloom lookup tables of paragraph digests, in SQL functions only.

A paragraph is a run of words (characters, in scripts without blanks) that a hash of the last few
words closes, or its length. Longer words close more often, so that boundaries follow characters
whatever the script; ``level + 4`` words are hashed, so that texts of few distinct words have
boundaries as well; and no paragraph is longer than the kept half of a text. The level grows with
the length of the text, so that a fingerprint covers the whole text with some seven to twenty
paragraphs, and an edit moves boundaries only until the next that both texts have.

A table adds each distinct paragraph digest to three cells: a count, the digests' xor, and their
checks' xor. A fingerprint holds the tables of a text at its own level and at the next, coarser
one, so that versions whose lengths differ by less than half can be compared. Two tables of one
level subtract cell by cell; peeling, cell by cell with a count of one and the right check,
recovers the digests on either side. If the difference of two fingerprints does not peel, both
texts are asked for larger tables. Texts whose levels are further apart count as unlike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagelens.llm.common import empty_text

# Cells of a fingerprint's table.
CELLS = 30
# A difference starts with this many cells per digest of both sets, and doubles them on failure.
CELLS_PER_DIGEST = 1.5
RETRIES = 2
ROUNDS = 10
# Characters of a text per unit of 2 ** level.
GRAIN = 40

# A word of n characters closes a paragraph with a chance of n to PER_CLOSE * 2 ** level, by a hash of
# the last level + MORE_WORDS words; a paragraph of MOST * 2 ** level characters is closed in any case.
PER_CLOSE = 6
MORE_WORDS = 4
MOST = 18
LONG_WORD = 16
# Text bytes of a range of documents in which the next one is looked up.
RANGE_BYTES = 32 << 20
# All characters but those of words with blanks between them: blanks of any kind, Thai to Myanmar, Khmer,
# Chinese and Japanese, and what lies beyond the basic plane.
CUTS = (
    r"(?<=[^!-~\u00A1-\u0DFF\u10A0-\u167F\u1681-\u177F\u1800-\u1FFF\u2010-\u2027\u2030-\u205E\u2070-\u2E7F\uAC00-\uD7AF\uD800-\uDBFF])"
    rf"|(?<=\S{{{LONG_WORD}}})"
)

CELL = "struct<n: int, k: bigint, c: bigint>"


def no_cell() -> Column:
    zero = F.lit(0).cast("bigint")
    return F.struct(F.lit(0).alias("n"), zero.alias("k"), zero.alias("c")).cast(CELL)


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """The text cut after each blank; an empty text has no words. The words joined are the text.

    Scripts without blanks, and what follows ``LONG_WORD`` characters without one, are cut into
    characters.
    """
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, CUTS, -1))


def level(text: Column) -> Column:
    """Whole power of two of the text's length in grains."""
    return F.greatest(F.lit(0), F.floor(F.log2(F.greatest(F.length(text), F.lit(1)) / GRAIN))).cast("int")


def _shifted(value: Column, by: Column | int) -> Column:
    return F.call_function("shiftleft", value, F.lit(by) if isinstance(by, int) else by)


def _settings(level_: Column) -> Column:
    bits = F.least(2 * (level_ + MORE_WORDS), F.lit(62)).cast("int")
    one = F.lit(1).cast("bigint")
    scale = _shifted(one, F.least(level_, F.lit(40)))
    return F.struct(
        (_shifted(one, bits) - 1).alias("mask"),
        F.when(level_ == 0, F.lit(2).cast("bigint")).otherwise(scale * PER_CLOSE).alias("chance"),
        (scale * MOST).alias("most"),
    )


def paragraphs(words_: Column, level_: Column) -> Column:
    """Distinct digests of the paragraphs at a level (``own``) and at the next (``coarse``), in one pass."""
    zero, none = F.lit(0).cast("bigint"), F.array().cast("array<bigint>")
    start = F.struct(
        zero.alias("run"), zero.alias("h0"), F.lit(0).alias("n0"), none.alias("out0"),
        zero.alias("h1"), F.lit(0).alias("n1"), none.alias("out1"),
    )
    marks = F.transform(words_, lambda w: F.struct(F.xxhash64(w).alias("w"), F.length(w).alias("n")))

    def cut(p: Column) -> Column:
        def step(state: Column, mark: Column) -> Column:
            run = _shifted(state["run"], 2).bitwiseXOR(mark["w"])
            grown = [F.xxhash64(state[f"h{i}"], mark["w"]) for i in (0, 1)]
            lengths = [state[f"n{i}"] + mark["n"] for i in (0, 1)]
            closes = [
                (F.pmod(F.xxhash64(run.bitwiseAND(p[s]["mask"])), p[s]["chance"]) < mark["n"]) | (lengths[i] >= p[s]["most"])
                for i, s in ((0, "own"), (1, "coarse"))
            ]

            def after(closed: tuple[bool, bool]) -> Column:
                parts = [run.alias("run")]
                for i, done in enumerate(closed):
                    out = state[f"out{i}"]
                    parts += [
                        (zero if done else grown[i]).alias(f"h{i}"),
                        (F.lit(0) if done else lengths[i]).alias(f"n{i}"),
                        (F.array_append(out, grown[i]) if done else out).alias(f"out{i}"),
                    ]
                return F.struct(*parts)

            either = lambda first: F.when(closes[1], after((first, True))).otherwise(after((first, False)))
            return F.when(closes[0], either(True)).otherwise(either(False))

        def finish(state: Column) -> Column:
            last = lambda i: F.when(state[f"n{i}"] == 0, state[f"out{i}"]).otherwise(
                F.array_append(state[f"out{i}"], state[f"h{i}"])
            )
            return F.struct(F.array_distinct(last(0)).alias("own"), F.array_distinct(last(1)).alias("coarse"))

        return F.aggregate(marks, start, step, finish)

    return let(F.struct(_settings(level_).alias("own"), _settings(level_ + 1).alias("coarse")), cut)


def digests(words_: Column, level_: Column) -> Column:
    """Distinct digests of the paragraphs at a level, as array of long."""
    return paragraphs(words_, level_)["own"]


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(7))


def _placed(key: Column, sign: Column, cells: Column) -> Column:
    """A digest with its check and its three cells, one in each third of the table."""
    third = (cells / 3).cast("int")
    place = lambda j: (F.pmod(F.xxhash64(key, F.lit(100 + j)), third) + third * j).cast("int")
    return F.struct(
        key.alias("k"), sign.alias("s"), _check(key).alias("c"), place(0).alias("p0"), place(1).alias("p1"), place(2).alias("p2")
    )


def _hits(number: Column, cells: Column, keys: Column) -> Column:
    """The placed digests that fall into a cell."""
    third = (cells / 3).cast("int")
    place = lambda d: F.when(number < third, d["p0"]).when(number < 2 * third, d["p1"]).otherwise(d["p2"])
    return F.filter(keys, lambda d: place(d) == number)


def _changed(cell: Column, keys: Column, sign: int) -> Column:
    """The cell with placed digests added (sign 1) or taken away (-1)."""

    def step(c: Column, d: Column) -> Column:
        n = c["n"] + d["s"] if sign > 0 else c["n"] - d["s"]
        return F.struct(n.alias("n"), c["k"].bitwiseXOR(d["k"]).alias("k"), c["c"].bitwiseXOR(d["c"]).alias("c")).cast(CELL)

    return F.aggregate(keys, cell, step)


def sketch(digests_: Column, cells: Column | int = CELLS) -> Column:
    """The lookup table of the digests: an array of cells, whose number is a multiple of three."""
    cells = F.lit(cells) if isinstance(cells, int) else cells
    keys = F.transform(digests_, lambda d: _placed(d, F.lit(1), cells))
    numbers = F.sequence(F.lit(0), cells - 1)
    return let(keys, lambda k: F.transform(numbers, lambda i: _changed(no_cell(), _hits(i, cells, k), 1)))


def subtract(one: Column, other: Column) -> Column:
    def cell(a: Column, b: Column) -> Column:
        return F.struct(
            (a["n"] - b["n"]).alias("n"), a["k"].bitwiseXOR(b["k"]).alias("k"), a["c"].bitwiseXOR(b["c"]).alias("c")
        ).cast(CELL)

    return F.zip_with(one, other, cell)


FOUND = "array<struct<k: bigint, n: int>>"
STATE = f"struct<cells: array<{CELL}>, found: {FOUND}>"


def peel(difference: Column, cells: Column, rounds: int = ROUNDS) -> Column:
    """Digests of a difference of tables, with n = 1 (only in the first) or -1; null if it fails."""

    def one_round(state: Column, _: Column) -> Column:
        pure = F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (c["c"] == _check(c["k"])))
        keys = F.array_distinct(F.transform(pure, lambda c: F.struct(c["k"].alias("k"), c["n"].alias("n"))))

        def apply(found: Column) -> Column:
            placed = F.transform(found, lambda d: _placed(d["k"], d["n"], cells))
            left = let(placed, lambda p: F.transform(state["cells"], lambda c, i: _changed(c, _hits(i, cells, p), -1)))
            more = F.struct(left.alias("cells"), F.concat(state["found"], found.cast(FOUND)).alias("found")).cast(STATE)
            return F.when(F.size(found) > 0, more).otherwise(state)

        return let(keys, apply)

    start = F.struct(difference.alias("cells"), F.array().cast(FOUND).alias("found")).cast(STATE)

    def finish(state: Column) -> Column:
        return F.when(F.forall(state["cells"], lambda c: (c["n"] == 0) & (c["k"] == 0) & (c["c"] == 0)), state["found"])

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, one_round, finish)


def difference(one: Column, other: Column, retries: int = RETRIES) -> Column:
    """Digests in one set only, by sketch, subtraction and peeling, in larger tables on failure.

    If the largest fails, the sets themselves are compared.
    """
    start = (F.ceil((F.size(one) + F.size(other)) * CELLS_PER_DIGEST / 3) * 3).cast("int")
    start = F.greatest(start, F.lit(6))

    def attempt(number: int) -> Column:
        cells = start * 2**number
        return let(cells, lambda m: peel(subtract(sketch(one, m), sketch(other, m)), m, ROUNDS + 4 * number))

    only = lambda a, b, n: F.transform(
        F.array_except(a, b), lambda k: F.struct(k.alias("k"), F.lit(n).alias("n"))
    )
    plain = F.concat(only(one, other, 1), only(other, one, -1)).cast(FOUND)
    return F.coalesce(*[attempt(k) for k in range(retries + 1)], plain)


def _alike(together: Column, apart: Column) -> Column:
    """Jaccard from the sizes of both sets and of their difference."""
    value = lambda d: (together - d) / (together + d)
    return F.when(together == 0, F.lit(1.0)).otherwise(let(apart.cast("double"), value))


def likeness(one: Column, other: Column) -> Column:
    """Shared share of both digest sets (Jaccard), from their sizes and the peeled difference."""
    return _alike(F.size(one) + F.size(other), F.size(difference(one, other)))


def digest_sets(text: Column) -> Column:
    """Level of a text, and its digests at that level (``own``) and at the next (``coarse``)."""
    whole = lambda p: F.struct(level(text).alias("level"), p["own"].alias("own"), p["coarse"].alias("coarse"))
    return let(paragraphs(words(text), level(text)), whole)


def fingerprint(sets: Column, cells: int = CELLS) -> Column:
    """Level, numbers of digests and tables of both sets: all that a fingerprint holds."""
    return F.struct(
        sets["level"].alias("level"), F.size(sets["own"]).alias("n_own"), F.size(sets["coarse"]).alias("n_coarse"),
        sketch(sets["own"], cells).alias("own"), sketch(sets["coarse"], cells).alias("coarse"),
    )


def pair(one: Column, other: Column, sets: Column, other_sets: Column) -> Column:
    """What ``compared`` needs of two fingerprints and their digest sets, at the coarser of both levels."""

    def at(mark: Column, far: Column, of: Column, name: str = "") -> Column:
        return F.when(mark["level"] >= far["level"], of[f"{name}own"]).otherwise(of[f"{name}coarse"])

    return F.struct(
        (F.abs(one["level"] - other["level"]) <= 1).alias("near"),
        (at(one, other, one, "n_") + at(other, one, other, "n_")).alias("together"),
        at(one, other, one).alias("table"), at(other, one, other).alias("other_table"),
        at(one, other, sets).alias("set"), at(other, one, other_sets).alias("other_set"),
    )


def compared(p: Column, cells: int = CELLS) -> Column:
    """Likeness of a ``pair`` of fingerprints, by their tables.

    Tables that do not peel are taken anew from the digest sets, larger. Fingerprints whose
    levels differ by more than one are unlike, as one text is more than twice as long.
    """
    apart = let(subtract(p["table"], p["other_table"]), lambda d: F.size(peel(d, F.lit(cells))))
    # The size of NULL, a difference that did not peel, is NULL in ANSI mode and -1 otherwise.
    larger = F.size(difference(p["set"], p["other_set"], retries=1))
    counted = let(apart, lambda n: F.when(n >= 0, n).otherwise(larger))
    return F.when(p["near"], _alike(p["together"], counted)).otherwise(F.lit(0.0))


def as_text(mark: Column) -> Column:
    """A fingerprint as text: level, paragraphs at both levels, and the cells of both tables in base 64.

    A cell has two bytes of count, eight of the digests' xor and eight of the checks'.
    """
    cell = lambda c: F.concat(F.lpad(F.hex(c["n"]), 4, "0"), F.lpad(F.hex(c["k"]), 16, "0"), F.lpad(F.hex(c["c"]), 16, "0"))
    cells = F.array_join(F.transform(F.concat(mark["own"], mark["coarse"]), cell), "")
    numbers = [mark[x].cast("string") for x in ("level", "n_own", "n_coarse")]
    return F.concat_ws("-", *numbers, F.regexp_replace(F.base64(F.unhex(cells)), r"\s", ""))


def with_next(docs: DataFrame, parts: int | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, h (hash of the text), text, n and ``next_text``: each row with the text of the next.

    The next row is that by descending doc_id, rows with one doc_id by descending hash of the
    text, a null doc_id last; the last row is followed by the first. Rows are dealt to ranges of
    doc_id, a doc_id with very many rows to ranges of their hash, and the head of each range
    (``copy`` = 1) is copied to the end of the range before it, so no task sees all rows. More
    equal rows than a range should hold are one row with their number n: ``next_text`` is what
    follows the last of them, the others are followed by their like.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), empty_text().alias("text")).withColumn("h", F.xxhash64("text"))
    sums = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text").cast("long")).alias("bytes")).first()
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(sums.bytes or 0) // range_bytes))
    share = max(1, sums.n // parts)
    at = [i / parts for i in range(1, parts)] or [0.5]
    cuts = rows.agg(F.percentile_approx("doc_id", at, 10_000).alias("cuts")).first().cuts or []
    # Fewer than half as many as ranges: each has the rows of two.
    hot = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * share).collect()
    cuts = sorted({*cuts, *(d for r in hot if r.doc_id is not None for d in (r.doc_id - 1, r.doc_id))})
    # Fewer than there are ranges: each fills one.
    many = rows.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > share).collect()
    many = F.broadcast(spark.createDataFrame([tuple(r) for r in many], "many_id long, many_h long, n long"))
    is_many = F.col("doc_id").eqNullSafe(F.col("many_id")) & (F.col("h") == F.col("many_h"))
    single = rows.join(many, is_many, "left_anti").withColumn("n", F.lit(1).cast("bigint"))
    equal = rows.join(many, is_many).groupBy("doc_id", "h", "n").agg(F.first("text").alias("text"))
    equal = single.unionByName(equal.select(*single.columns))
    # Null ids have a range of their own, the last.
    dealt = equal.withColumn("range", F.when(F.col("doc_id").isNull(), -1).otherwise(_search(cuts)))
    pieces = spark.createDataFrame([(r.doc_id, -(-r.n // share)) for r in hot], "hot_id long, pieces long")
    dealt = dealt.join(F.broadcast(pieces), F.col("doc_id").eqNullSafe(F.col("hot_id")) & F.col("pieces").isNotNull(), "left")
    place = F.col("h") / 2.0**64 + 0.5
    piece = F.floor(F.least(place, F.lit(1 - 2.0**-53)) * F.coalesce("pieces", F.lit(1))).cast("int")
    dealt = dealt.withColumn("piece", piece).drop("hot_id", "pieces")
    first = F.max(F.struct("doc_id", "h")).alias("head")
    heads = dealt.groupBy("range", "piece").agg(first).select("range", "piece", "head.doc_id", "head.h").collect()  # a row per range
    order = sorted(((r["range"], r.piece) for r in heads), reverse=True)
    before = {b: a for a, b in zip(order[-1:] + order[:-1], order, strict=True)}
    ids = [(*before[r["range"], r.piece], r.doc_id, r.h) for r in heads]
    wanted = F.broadcast(spark.createDataFrame(ids, "to int, to_piece int, head_id long, head_h long"))
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("h") == F.col("head_h"))
    copies = equal.join(wanted, is_head).withColumns({"range": F.col("to"), "piece": F.col("to_piece")})
    both = dealt.withColumn("copy", F.lit(0)).unionByName(copies.drop(*wanted.columns).withColumn("copy", F.lit(1)))
    return both.withColumn("next_text", F.lead("text").over(_down()))


def _down():
    return Window.partitionBy("range", "piece").orderBy("copy", F.desc_nulls_last("doc_id"), F.desc("h"))


def _search(cuts: list[int]) -> Column:
    """Number of cuts below doc_id, by binary search in a literal array."""
    if not cuts:
        return F.lit(0)
    edges, powers = F.array(*[F.lit(c) for c in cuts]), range(int(math.log2(len(cuts))), -1, -1)

    def step(low: Column, jump: Column) -> Column:
        to = low + jump
        fits = (to <= len(cuts)) & (F.get(edges, to - 1) < F.col("doc_id"))
        return F.when(fits, to).otherwise(low)

    return F.aggregate(F.array(*[F.lit(1 << p) for p in powers]), F.lit(0), step)


def fingerprints(docs: DataFrame, cells: int = CELLS) -> DataFrame:
    """level, digests and sketch of every whole text, beside doc_id and text.

    A null or empty text has no paragraphs and an empty sketch. Other columns are left out.
    """
    rows = docs.select("doc_id", empty_text().alias("text"))
    rows = rows.withColumn("sets", digest_sets(F.col("text")))
    rows = rows.withColumn("mark", fingerprint(F.col("sets"), cells))
    kept = [F.col("sets.level").alias("level"), F.col("sets.own").alias("digests"), F.col("mark.own").alias("sketch")]
    return rows.select("doc_id", "text", *kept)


def edits(docs: DataFrame, cells: int = CELLS) -> DataFrame:
    """Each text beside its edited form: the last half replaced by the start of the next text.

    doc_id, n_chars, edited (text), fingerprint, edited_fingerprint, near_edited, near_next.
    Equal texts have equal fingerprints and likeness 1; so have two empty texts. Equal rows (one
    doc_id, one text) are worked on once and come out as often as they are there. One row is its
    own next row. No rows give no rows.
    """
    rows = with_next(docs)
    rows = rows.withColumn("sets", digest_sets(F.col("text")))
    rows = rows.withColumn("mark", fingerprint(F.col("sets"), cells))
    following = F.struct(F.col("next_text").alias("text"), F.lead("sets").over(_down()).alias("sets"), F.lead("mark").over(_down()).alias("mark"))
    rows = rows.withColumn("after", following).where("copy = 0")
    # All but the last of equal rows are followed by one like them.
    like = F.struct(F.col("text"), F.col("sets"), F.col("mark"))
    last = F.struct(F.lit(1).cast("bigint").alias("times"), F.col("after").alias("after"))
    others = F.struct((F.col("n") - 1).alias("times"), like.alias("after"))
    uses = F.when(F.col("n") == 1, F.array(last)).otherwise(F.array(last, others))
    rows = rows.select("doc_id", "text", "sets", "mark", F.inline(uses))
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("after.text", F.lit(1), half))
    rows = rows.withColumns({"edited": edited, "n_chars": n.cast("long")})
    rows = rows.withColumn("edited_sets", digest_sets(F.col("edited")))
    rows = rows.withColumn("edited_mark", fingerprint(F.col("edited_sets"), cells))
    one, sets = F.col("mark"), F.col("sets")
    both = [pair(one, F.col("edited_mark"), sets, F.col("edited_sets")), pair(one, F.col("after.mark"), sets, F.col("after.sets"))]
    rows = rows.withColumn("pairs", F.array(*both)).withColumn("near", F.transform("pairs", lambda p: compared(p, cells)))
    rows = rows.withColumn("texts", F.transform(F.array("mark", "edited_mark"), as_text))
    found = rows.select(
        "doc_id",
        "n_chars",
        "edited",
        F.col("texts")[0].alias("fingerprint"),
        F.col("texts")[1].alias("edited_fingerprint"),
        F.col("near")[0].alias("near_edited"),
        F.col("near")[1].alias("near_next"),
        "times",
    )
    return found.withColumn("_time", F.explode(F.sequence(F.lit(1).cast("bigint"), "times"))).drop("times", "_time")
