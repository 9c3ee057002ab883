"""Line dedup by a deletion-neighbourhood join, in DataFrame functions only.

Two lines are near when one word replaced, inserted or deleted turns one into the other (edit bound 1,
in words) and the shorter has at least ``min_words`` words. With ``words_per_edit`` the bound grows with
the line: one edit for each so many words of the shorter line, and one at least. A line is dropped when an equal or a near
line stands earlier: in a document with a smaller id, or higher up in the same one. Lines are judged
on the input, so a line also goes when the earlier one is itself dropped. Blank lines always stay.

The variants of a line are the line without its word i, for every i, as hashed keys. Two lines of equal
length are near when they share a variant at one position; lines whose lengths differ by one are near
when a variant of the longer is the shorter. In each group of equal keys only the earliest member
matters to the others, so groups are reduced by a partial minimum and no pairs within them are made.
Every hit is verified on the words themselves.

Variants grow with the words of a line, so lines that cannot have a partner are put aside first: near
lines agree in their first words or in their last, up to nearly half of them, so a line whose ends
occur nowhere else has no near line. The end that does occur elsewhere also says where the edit can be.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.columns import whole_numbers
from corpusmill.session import release, spill

WHITE = " \t\x0b\x0c\r"  # fixed values: white space inside a line
STEP = 16  # words per block of the running exclusive-or
CHUNK = 2000  # lines of a group that are compared together
BITMAPS = 4  # of 64 bits each
FIRST = 6  # lines of a group that all others of the group are compared with


def line_dedup(
    docs: DataFrame, min_words: int = 5, id_col: str = "doc_id", text_col: str = "text", words_per_edit: int | None = None
) -> DataFrame:
    """``docs`` with the surviving lines in the text column, all other columns unchanged.

    Near lines differ by one word, or with ``words_per_edit`` by one for each so many words of the shorter.

    A document keeps its row even if no line is left (its text is then empty). Defined cases: a null
    text stays null; rows with a null id are neither changed nor compared; rows that repeat an id and
    a text count as one document, rows that repeat an id with another text as two at the same place; ids
    must be whole numbers (TypeError);
    further columns are carried along, and none of their names matters.
    """
    mine = [c for c in docs.columns if c not in (id_col, text_col)]
    packed = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.struct(*[F.col(f"`{c}`") for c in mine]).alias("rest")
    ) if mine else docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.lit(None).alias("rest"))
    cleaned = judged_documents(packed, min_words, words_per_edit).withColumn("text", kept_text())
    return cleaned.select(
        *[
            F.col("doc_id").alias(c) if c == id_col else F.col("text").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c)
            for c in docs.columns
        ]
    )


def judged_documents(docs: DataFrame, min_words: int = 5, words_per_edit: int | None = None) -> DataFrame:
    """``docs`` (whose other columns than doc_id and text are not named th or gone) plus ``gone``: the numbers of the lines to drop, or null."""
    found = dropped_lines(docs, min_words, words_per_edit)
    numbers = found.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("line_no")).alias("gone"))
    return docs.withColumn("th", _text_hash()).join(numbers, ["doc_id", "th"], "left").drop("th")


def kept_text() -> Column:
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda _, i: ~F.array_contains("gone", i))
    return F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))


def _text_hash() -> Column:
    return F.xxhash64("text")


def _end_length(n: Column) -> Column:
    """Words of a line's beginning and end that serve as keys: (n - 1) / 2 with all but its three leading bits cleared.

    Such steps make lines of n and n - 1 words mostly use one length, so that one pair of keys serves both.
    """
    most = F.greatest(F.floor((n - 1) / 2), F.lit(1)).cast("int")
    shift = F.greatest(F.length(F.bin(most)) - 3, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", most, shift), shift)


def _words(line: Column) -> Column:
    """The words of a line, none if it is blank; splitting at one plain character takes no regular expression."""
    for c in WHITE[1:]:
        line = F.replace(line, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(line, " ", -1), "")


def dropped_lines(docs: DataFrame, min_words: int = 5, words_per_edit: int | None = None) -> DataFrame:
    """``(doc_id, th, line_no)`` of every line that goes; ``th`` is the hash of the document's text."""
    if min_words < 3:
        raise ValueError("min_words must be at least 3")
    if words_per_edit is not None and words_per_edit < 6:
        raise ValueError("words_per_edit must be at least 6")
    base = docs.select(whole_numbers(docs, "doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"))
    base = base.filter("doc_id is not null and text is not null").withColumn("th", _text_hash())
    lines = spill(_occurrences(base, min_words))
    first = F.min(F.struct("doc_id", "line_no", "th")).alias("first")
    firsts = lines.groupBy("h1", "h2").agg(first)
    late = spill(_late_lines(base, lines, min_words))
    if words_per_edit is not None:
        late = spill(late.unionByName(_far_lines(base, lines, late, min_words, words_per_edit)))
    placed = lines.join(firsts, ["h1", "h2"]).join(late.withColumn("late", F.lit(True)), ["h1", "h2"], "left")
    again = (F.col("doc_id") > F.col("first.doc_id")) | (F.col("line_no") > F.col("first.line_no"))
    return placed.filter(again | F.col("late").isNotNull()).select("doc_id", "th", "line_no")


def _occurrences(base: DataFrame, min_words: int) -> DataFrame:
    """Every line that is not blank: place, 128-bit identity, number of words, hashed halves."""
    lines = base.select("doc_id", "th", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    lines = lines.filter(F.ltrim("line", F.lit(WHITE)) != "").withColumn("w", _words(F.col("line")))
    lines = lines.withColumn("n", F.size("w"))
    lines = lines.withColumns({"k": _end_length(F.col("n")), "less": _end_length(F.col("n") - 1)})

    def ends(k: str) -> list[Column]:
        first, last = F.slice("w", F.lit(1), F.col(k)), F.slice("w", F.col("n") - F.col(k) + 1, F.col(k))
        return [F.xxhash64(F.lit(0), first), F.xxhash64(F.lit(1), last)]

    also = (F.col("n") > min_words) & (F.col("k") != F.col("less"))
    keys = F.when(also, F.array(*ends("k"), *ends("less"))).when(F.col("n") >= min_words, F.array(*ends("k")))
    return lines.select(
        "doc_id", "th", "line_no", "n", F.xxhash64("w").alias("h1"), F.xxhash64(F.lit(1), "w").alias("h2"), keys.alias("keys")
    )


def _late_lines(base: DataFrame, lines: DataFrame, min_words: int) -> DataFrame:
    """``(h1, h2)`` of the distinct lines that have an earlier near line."""
    held = lines.select("h1", F.posexplode("keys").alias("slot", "key"))
    shared = held.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).filter("lo < hi").select("key")
    sides = held.join(shared, "key").groupBy("h1").agg(F.bit_or(F.expr("shiftleft(1, slot)")).alias("sides"))
    near = lines.filter("keys is not null").join(sides, "h1")
    near = near.groupBy("h1", "h2").agg(
        F.min(F.struct("doc_id", "line_no", "th")).alias("first"), F.bit_or("sides").alias("sides")
    )
    words = spill(_with_words(base, near, "sides"))

    members = _variants(words, min_words)
    place = F.struct("doc_id", "line_no", "h1", "pos")
    group = Window.partitionBy("v", "slot")  # variants are made and moved once, not for groups and again for their members
    met = members.withColumns({
        "n": F.count("*").over(group),
        "other": F.min(F.when(~F.col("short"), place)).over(group),
        "bare": F.min(F.when(F.col("short"), place)).over(group),
    }).filter("n > 1")
    met = met.withColumn("p", F.when((F.col("slot") >= 0) | F.col("short"), F.col("other")).otherwise(F.col("bare")))
    met = met.filter(F.struct("p.doc_id", "p.line_no") < F.struct("doc_id", "line_no"))
    pairs = met.groupBy("h1", F.col("p.h1").alias("q1")).agg(
        F.first(F.struct("slot", "short", "pos", F.col("p.pos").alias("q_pos"))).alias("how")
    )
    pairs = pairs.join(words.select("h1", "h2", "w"), "h1")
    pairs = pairs.join(words.select(F.col("h1").alias("q1"), F.col("w").alias("q")), "q1")
    at = F.col("how.pos")
    replaced = (F.size("w") == F.size("q")) & (_without("w", at) == _without("q", at))
    inserted, deleted = _without("w", at) == F.col("q"), _without("q", F.col("how.q_pos")) == F.col("w")
    near = F.when(F.col("how.slot") >= 0, replaced).when(F.col("how.short"), deleted).otherwise(inserted)
    return pairs.filter(near).select("h1", "h2").distinct()


def _with_words(base: DataFrame, near: DataFrame, *more: str) -> DataFrame:
    """The words of each line in ``near`` (h1, h2, first), with its place."""
    asked = near.groupBy("first.doc_id", "first.th").agg(
        F.array_sort(F.collect_list(F.struct("first.line_no", "h1", "h2", *more))).alias("asked")
    )
    asked = spill(asked)
    texts = base.join(asked, ["doc_id", "th"])
    picked = F.filter(F.split("text", "\n", -1), lambda _, i: F.array_contains(F.col("asked.line_no"), i))
    texts = texts.select("doc_id", F.explode(F.arrays_zip("asked", picked.alias("line"))).alias("x"))
    return texts.select(
        "doc_id", "x.asked.line_no", "x.asked.h1", "x.asked.h2", *[f"x.asked.{m}" for m in more],
        _words(F.col("x.line")).alias("w"),
    )


def _far_lines(base: DataFrame, lines: DataFrame, late: DataFrame, min_words: int, per_edit: int) -> DataFrame:
    """``(h1, h2)`` of the distinct lines, not in ``late``, that have an earlier one within a bound over one edit.

    Lines without any run that such a pair must share are put aside first, and of those that
    share one each is judged against the first ones of its group. That settles small groups. Lines that have others
    before them then meet by their rarest runs: k edits leave all but so many runs of a line as they are.
    """
    long = max(min_words, 2 * per_edit)
    near = _sharing(base, long, per_edit)
    firsts = lines.filter(F.col("n") >= long).join(near, "h1").groupBy("h1", "h2").agg(
        F.min(F.struct("doc_id", "line_no", "th")).alias("first")
    )
    firsts = firsts.join(late.withColumn("late", F.lit(True)), ["h1", "h2"], "left").withColumn("open", F.col("late").isNull())
    words = spill(_with_words(base, firsts, "open").withColumn("n", F.size("w")))
    met = spill(_placed(near, words))
    settled = spill(_within(_behind_first(met, words, per_edit), words, per_edit))
    left = spill(_unsettled(met, settled))
    release(met, near)
    late = spill(settled.unionByName(_far_behind(words.drop("open").join(left, "h1"), per_edit)))
    release(words, settled, left)
    return late


def _placed(near: DataFrame, words: DataFrame) -> DataFrame:
    """The lines of each group of equal runs with their ``rank`` by place, from 1; lines at one place share ``place``."""
    group = Window.partitionBy("key", "band").orderBy("doc_id", "line_no", "h1")
    held = near.select("h1", F.explode("keys").alias("x")).select("h1", "x.key", "x.band")
    held = held.join(words.select("h1", "n", "open", "doc_id", "line_no"), "h1")
    place = Window.partitionBy("key", "band").orderBy("doc_id", "line_no")
    return held.withColumns({"rank": F.row_number().over(group), "place": F.rank().over(place)}).drop("doc_id", "line_no")


def _close(a: str, b: str, per_edit: int) -> Column:
    return F.abs(F.col(a) - F.col(b)) <= F.floor(F.least(a, b) / per_edit)


def _behind_first(met: DataFrame, words: DataFrame, per_edit: int) -> DataFrame:
    """``(h1, q1)`` of open lines and earlier ones among the first of their groups, if their bitmaps leave room for a pair."""
    first = met.filter(F.col("rank") <= FIRST).select("key", "band", *[F.col(c).alias(q) for c, q in (("h1", "q1"), ("n", "q_n"), ("place", "q_place"))])
    behind = met.filter(F.col("open") & (F.col("rank") > 1)).join(first, ["key", "band"])
    pairs = behind.filter((F.col("place") > F.col("q_place")) & _close("n", "q_n", per_edit)).select("h1", "q1").distinct()
    bits = spill(words.select("h1", "n", *[_bits(i).alias(f"bits{i}") for i in range(BITMAPS)]))
    both = pairs.alias("p").join(bits.alias("a"), F.col("p.h1") == F.col("a.h1")).join(bits.alias("b"), F.col("p.q1") == F.col("b.h1"))
    bound = F.floor(F.least("a.n", "b.n") / per_edit).cast("int")
    return both.filter(_alike(bound)).select("p.h1", "p.q1")


def _unsettled(met: DataFrame, settled: DataFrame) -> DataFrame:
    """``(h1, open)``: the open lines that have others than the first before them in a group, and the lines before them there."""
    open_ = met.filter(F.col("open")).join(settled.select("h1"), "h1", "left_anti").filter(F.col("rank") > FIRST + 1)
    groups = open_.groupBy("key", "band").agg(F.max("rank").alias("upto"))
    left = met.drop("open").join(groups, ["key", "band"]).filter("rank <= upto").select("h1").distinct()
    asking = open_.select("h1", F.lit(True).alias("open")).distinct()
    return left.join(asking, "h1", "left").select("h1", F.coalesce("open", F.lit(False)).alias("open"))


def _far_behind(words: DataFrame, per_edit: int) -> DataFrame:
    """``(h1, h2)`` of the open lines that have an earlier one within the bound in ``words``, found by their rarest runs."""
    words = spill(words)
    place = F.struct("doc_id", "line_no")
    members = _part_variants(words, per_edit).join(words.select("h1", "n", "open", "doc_id", "line_no"), "h1")
    group = Window.partitionBy("v")
    met = members.withColumns({"head": F.min(place).over(group), "last": F.max(F.when(F.col("open"), place)).over(group)})
    met = spill(met.filter((F.col("head") < F.col("last")) & (place <= F.col("last"))).drop("last"))
    rest = met.filter(F.col("open") & (place > F.col("head")))
    more = spill(_behind_others(rest, met, words, per_edit))
    found = spill(words.join(more, "h1", "left_semi").select("h1", "h2"))
    release(met, words, more)
    return found


def _sharing(base: DataFrame, long: int, per_edit: int) -> DataFrame:
    """``(h1, keys)`` of the lines of at least ``long`` words that share a run with another line of about their length.

    k edits leave k + 1 stretches of the shorter line as they are, so one has (n - k) / (k + 1) words at least. Of
    that many words in a row each line takes the run with the least hash; two lines within the bound so
    take one in common. The keys are the hashes of these runs, with bands of lengths.
    """
    run = _run(per_edit)
    lines = base.select(F.explode(F.split("text", "\n", -1)).alias("line"))
    lines = lines.select(_words(F.col("line")).alias("w")).withColumn("n", F.size("w")).filter(F.col("n") >= long)
    hashed = lines.select(F.xxhash64("w").alias("h1"), "n", F.transform("w", lambda w: F.xxhash64(w)).alias("hw"))
    least = _least(_with_runs(hashed, run), _intact(F.col("n"), per_edit) - run + 1, per_edit - run)
    held = least.select("h1", "n", F.explode(F.array_distinct("least")).alias("key"))
    several = (F.min("h1").alias("lo"), F.max("h1").alias("hi"))
    alone = Window.partitionBy("key")  # one shuffle of the runs; counting and joining them would make and move them twice
    held = held.withColumns({"lo": F.min("h1").over(alone), "hi": F.max("h1").over(alone)}).filter("lo < hi")
    # lengths within the bound lie in one band or in neighbouring ones; the divisor allows for rounding
    band = F.floor(F.log("n") / (1.001 * math.log(1 + 1 / per_edit))).cast("int")
    held = spill(held.select("h1", "key", band.alias("own")).distinct())
    banded = held.select("h1", "key", F.explode(F.array("own", F.col("own") + 1)).alias("band"))
    alike = banded.groupBy("key", "band").agg(*several).filter("lo < hi").select("key", "band")
    near = banded.join(alike, ["key", "band"])
    near = spill(near.groupBy("h1").agg(F.collect_list(F.struct("key", "band")).alias("keys")))
    release(held)
    return near


def _run(per_edit: int) -> int:
    """Words of a run: one less than lines within the bound have in common in a row, as two edits at least are allowed."""
    return -(-2 * (per_edit - 1) // 3) - 1


def _intact(n: Column, per_edit: int) -> Column:
    """Words in a row that a line of ``n`` shares with any line within the bound: s (p - 1) / (s + p) for a shorter line of s words.

    The shorter line has two parts at least, and n * p / (p + 1) words if the other has n.
    """
    p = per_edit
    shorter = F.greatest(F.lit(2 * p), F.ceil(n * p / (p + 1)))
    return F.ceil(shorter * (p - 1) / (shorter + p)).cast("int")


def _least(rows: DataFrame, window: Column, most: int) -> DataFrame:
    """``least``: the least of each ``window`` hashes in a row of ``runs``, by doubling up to ``most``."""
    rows, size = rows.withColumns({"least": F.col("runs"), "window": window}), 1
    while size < most:
        shift = F.least(F.lit(size), F.col("window") - size)
        left = F.size("least") - shift
        lower = F.zip_with(F.slice("least", F.lit(1), left), F.slice("least", shift + 1, left), lambda x, y: F.least(x, y))
        rows, size = rows.withColumn("least", F.when(shift > 0, lower).otherwise(F.col("least"))), 2 * size
    return rows


def _with_runs(rows: DataFrame, k: int) -> DataFrame:
    """``runs``: hashes of all runs of k words from the words' hashes ``hw``, by doubling and slices.

    A lookup inside a lambda would compute the array for every element.
    """
    held, size = "hw", 1
    for bit in bin(k)[3:]:
        for more, shift in ((held, size), *[("hw", 2 * size)] * (bit == "1")):
            grown = shift + (size if more == held and shift == size else 1)
            count = F.col("n") - grown + 1
            pair = F.zip_with(F.slice(held, F.lit(1), count), F.slice(more, F.lit(shift + 1), count), lambda x, y: F.xxhash64(x, y))
            held = f"runs{grown}"
            rows = rows.withColumn(held, pair)
        size = grown
    return rows.withColumn("runs", F.col(held))


def _part_variants(words: DataFrame, per_edit: int) -> DataFrame:
    """``(h1, v)``: runs of each line of which it has one in common with any line within its bound.

    An edit takes as many of a line's runs as a run has words. In any order of all runs the first one that two lines have in
    common so comes, in each of them, after no more runs than k edits take. Runs are ordered by the lines that hold them: a
    line with too many runs of its own has no partner, whatever passage it shares, and common runs are hardly asked for.
    """
    run = _run(per_edit)
    hashed = words.select("h1", "n", F.transform("w", lambda w: F.xxhash64(w)).alias("hw"))
    runs = _with_runs(hashed, run).select("h1", "n", F.array_distinct("runs").alias("runs"))
    taken = F.floor(F.col("n") / per_edit).cast("int") * run
    each = runs.select("h1", (taken + 1 - F.size("runs")).alias("over"), F.explode("runs").alias("v"))
    held = each.withColumn("met", F.count("*").over(Window.partitionBy("v"))).filter("met > 1")
    held = held.groupBy("h1", "over").agg(F.array_sort(F.collect_list(F.struct("met", "v"))).alias("runs"))
    room = F.greatest(F.col("over") + F.size("runs"), F.lit(0))  # the line's runs that no other has come first
    return held.select("h1", F.explode(F.slice("runs", F.lit(1), room)["v"]).alias("v"))


def _behind_others(rest: DataFrame, met: DataFrame, words: DataFrame, per_edit: int) -> DataFrame:
    """``h1`` of the lines in ``rest`` that have a line within the bound, earlier and not the first, in a group of ``met``.

    Groups of the same lines are looked at once. Pairs are judged where they meet and never given out: first
    by bitmaps of their words alone, then, for lines that pass on either side, also by letters that stand for
    word hashes and by numbers that stand for the words. Large groups meet in chunks.
    """
    bits = words.select("h1", *[_bits(i).alias(f"bits{i}") for i in range(BITMAPS)])
    held = _once(met.select("v", "h1", "n", "doc_id", "line_no").join(rest.select("v").distinct(), "v", "left_semi"))
    held = spill(held.join(bits, "h1"))
    asking = held.join(rest.select("h1").distinct(), "h1", "left_semi")
    late = spill(_pairs(asking, held, per_edit, _alike).select("h1").distinct())
    asking = asking.join(late, "h1", "left_semi")
    early = _pairs(held, asking, per_edit, _alike, later=True).select("h1").distinct()
    some = spill(late.union(early).distinct())
    hashes = F.transform("w", lambda w: F.xxhash64(w))
    known = words.join(some, "h1", "left_semi").select("h1", hashes.alias("hw"), _letters(F.transform(hashes, _code_point)).alias("code"))
    left = spill(_once(held.drop("held").join(some, "h1", "left_semi")).join(known, "h1"))

    def near(bound: Column) -> Column:
        return _alike(bound) & (F.call_function("levenshtein", F.col("a.code"), F.col("b.code"), bound) >= 0) & _within_words(
            F.col("a.hw"), F.col("b.hw"), bound
        )

    found = spill(_pairs(left.join(late, "h1", "left_semi"), left, per_edit, near).select("h1").distinct())
    release(held, left, some, late)
    return found


def _once(members: DataFrame) -> DataFrame:
    """``members`` of only one of the groups ``v`` that hold the same lines."""
    mix = F.xxhash64("h1")
    sets = members.groupBy("v").agg(F.count("*").alias("c"), F.sum(F.shiftright(mix, 20)).alias("s"), F.bit_xor(mix).alias("x"))
    one = sets.filter("c > 1").groupBy("c", "s", "x").agg(F.min("v").alias("v"))
    return members.join(one.select("v", F.col("c").alias("held")), "v")


def _pairs(a: DataFrame, b: DataFrame, per_edit: int, judge: Callable[[Column], Column], later: bool = False) -> DataFrame:
    """The rows of ``a`` that meet an earlier one (or ``later``) of ``b`` in a group and pass the judge, given their bound."""
    last = F.floor((F.col("held") - 1) / CHUNK).cast("int")
    a = a.withColumn("chunk", F.explode(F.sequence(F.lit(0), last))).alias("a")
    b = b.withColumn("chunk", F.pmod("h1", last + 1).cast("int")).alias("b")
    bound = F.floor(F.least("a.n", "b.n") / per_edit).cast("int")
    here, there = (F.struct(f"{x}.doc_id", f"{x}.line_no") for x in "ab")
    order = there > here if later else there < here
    meet = (F.col("a.v") == F.col("b.v")) & (F.col("a.chunk") == F.col("b.chunk")) & order
    return a.join(b, meet & (F.abs(F.col("a.n") - F.col("b.n")) <= bound) & judge(bound), "left_semi")


def _alike(bound: Column) -> Column:
    """An edit takes a word and brings one, so it changes two bits of a line's bitmap at most."""
    apart = [F.bit_count(F.col(f"a.bits{i}").bitwiseXOR(F.col(f"b.bits{i}"))) for i in range(BITMAPS)]
    return sum(apart[1:], apart[0]) <= 2 * bound


def _bits(i: int) -> Column:
    """The i-th 64 bits of a bitmap of the line's words."""
    places = F.transform("w", lambda w: F.pmod(F.xxhash64(w), F.lit(64 * BITMAPS)).cast("int"))
    mine = F.filter(places, lambda x: (x >= 64 * i) & (x < 64 * i + 64))
    one = F.lit(1).cast("long")
    return F.aggregate(mine, F.lit(0).cast("long"), lambda upto, x: upto.bitwiseOR(F.call_function("shiftleft", one, x - 64 * i)))


def _code_point(h: Column) -> Column:
    """One of a million letters for a word's hash, none of them a surrogate."""
    i = F.pmod(h, F.lit(1_000_000)) + 256
    return i + F.when(i < 0xD800, 0).otherwise(0x800)


def _letters(codes: Column) -> Column:
    return F.decode(F.unhex(F.array_join(F.transform(codes, lambda x: F.lpad(F.hex(x), 8, "0")), "")), "UTF-32")


def _within_words(w: Column, q: Column, bound: Column) -> Column:
    """Whether two word arrays are within the bound: the edit distance of strings with a letter per word of the pair."""

    def exact(known: Column) -> Column:
        def numbers(of: Column) -> Column:
            at = F.transform(of, lambda x: F.array_position(known, x))
            return _letters(F.transform(at, lambda i: i + F.when(i < 0xD800, 0).otherwise(0x800)))  # past the surrogates

        return F.call_function("levenshtein", numbers(w), numbers(q), bound) >= 0

    known = F.array(F.array_distinct(F.concat(w, q)))  # one element, so that it is computed once
    return F.get(F.transform(known, exact), F.lit(0))


def _within(pairs: DataFrame, words: DataFrame, per_edit: int) -> DataFrame:
    """``(h1, h2)`` of lines whose pair (h1, q1) lies within the bound."""
    held = words.select("h1", "w")  # the same for both lines of a pair, so that it is moved once
    both = pairs.alias("p").join(held.alias("a"), F.col("p.h1") == F.col("a.h1")).join(held.alias("b"), F.col("p.q1") == F.col("b.h1"))
    bound = F.floor(F.least(F.size("a.w"), F.size("b.w")) / per_edit).cast("int")
    near = both.filter(_within_words(F.col("a.w"), F.col("b.w"), bound)).select("p.h1").distinct()
    return words.select("h1", "h2").join(near, "h1", "left_semi")


def _without(words: str, at: Column) -> Column:
    return F.concat(F.slice(words, F.lit(1), at), F.slice(words, at + 2, F.size(words)))


def _variants(words: DataFrame, min_words: int) -> DataFrame:
    """``(slot, v, short, doc_id, line_no, h1, pos)``: the group's keys, then the line and the word left out.

    Slot i from 0: lines of equal length without word i, with the length hashed into ``v``. Slot -n:
    lines of n words as they are (``short``), and lines of one word more without any one word. A line's
    hash is the exclusive-or of hashes of (word, place), so all variants of a line follow from one
    running total.
    """
    n = F.size("w")
    zero = F.lit(0).cast("long")

    def xor(a: Column, b: Column) -> Column:
        return a.bitwiseXOR(b)

    here = F.transform("w", lambda w, i: F.xxhash64(w, i))
    back = F.transform("w", lambda w, i: F.xxhash64(w, i - 1))
    line = ["doc_id", "line_no", "h1"]
    rows = words.select(*line, "sides", n.alias("n"), back.alias("back"), here.alias("here"))
    rows = rows.select(
        *line, "sides", "n", "back", _end_length(F.col("n")).alias("k"), _end_length(F.col("n") - 1).alias("less"),
        F.zip_with("here", "back", xor).alias("d"),
        F.aggregate("here", zero, xor).alias("whole"), F.aggregate("back", zero, xor).alias("shifted"),
    )
    start = F.struct(zero.alias("x"), F.array().cast("array<long>").alias("upto"))
    upto = F.aggregate(
        F.sequence(F.lit(0), F.floor((F.col("n") - 1) / STEP).cast("int")),
        start,
        lambda s, b: F.struct(
            xor(s["x"], F.aggregate(F.slice("d", b * STEP + 1, F.lit(STEP)), zero, xor)).alias("x"),
            F.concat(s["upto"], F.array(s["x"])).alias("upto"),
        ),
        lambda s: s["upto"],
    )
    rows = rows.withColumn("upto", upto)
    each = rows.select(*line, "sides", "n", "k", "less", "d", "shifted", "upto", F.posexplode("back").alias("pos", "own"))
    block = F.floor(F.col("pos") / STEP).cast("int")
    running = xor(F.get("upto", block), F.aggregate(F.slice("d", block * STEP + 1, F.col("pos") % STEP), zero, xor))
    v = xor(xor(F.col("shifted"), running), F.col("own"))

    def side(bit: int) -> Column:
        return F.col("sides").bitwiseAND(F.lit(1 << bit)) != 0

    def reached(k: str, bit: int) -> Column:
        """Whether an edit at this word leaves a beginning or an end of k words that another line has too."""
        return ((F.col("pos") >= F.col(k)) & side(bit)) | ((F.col("pos") < F.col("n") - F.col(k)) & side(bit + 1))

    as_equal = reached("k", 0)
    as_longer = (F.col("n") > min_words) & F.when(F.col("k") == F.col("less"), as_equal).otherwise(reached("less", 2))

    def key(slot: Column, v: Column) -> Column:
        return F.struct(slot.cast("int").alias("slot"), v.alias("v"))

    roles = F.array(
        F.when(as_equal, key(F.col("pos"), F.xxhash64("n", "v"))), F.when(as_longer, key(1 - F.col("n"), F.col("v")))
    )
    each = each.select(*line, "pos", "sides", "n", "k", "less", v.alias("v"))
    each = each.select(F.explode(F.filter(roles, lambda x: x.isNotNull())).alias("k"), *line, "pos")
    each = each.select("k.slot", "k.v", F.lit(False).alias("short"), *line, "pos")
    shorter = rows.filter(side(0) | side(1)).select(
        (-F.col("n")).alias("slot"), F.col("whole").alias("v"), F.lit(True).alias("short"), *line, F.lit(-1).alias("pos")
    )
    return each.unionByName(shorter)
