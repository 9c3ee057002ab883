"""Mixing sources to target weights by whole and partial epochs, in DataFrame functions only.

Each source gets a share of all words by its weight, at most ``max_epochs`` times what it holds; what
is over goes to the other sources by weight. Documents get hash-random keys; within a source they are
ordered by key, running sums of sizes are taken, and the source is cut where its budget ends. Whole
multiples of a source are whole epochs; the rest is a prefix of the random order, and the document
on the cut gives only the words that are missing, so every source meets its budget exactly.

A source may hold any share of the rows. Its order is cut into ranges of the key, sums per range are
prefix-summed per source, and documents are only ever ordered within their range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY_BITS, RANGE_BITS = 60, 12  # 4,096 key ranges per source; 10**9 documents of a source put some 250,000 in each
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"  # fixed values: what separates words


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mixed_documents(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    max_epochs: int = 3,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, one row per row of ``docs``.

    Sources in code-point order, null last, take the weights in turn. ``target`` is the source's share
    in words, ``taken`` how many words of the document the mix takes, repeats counted; the taken words of
    a source add up to its target rounded down. The order within a source depends on ``seed`` and the
    document only, so reruns agree. Defined cases: null or empty text has size 0 and is taken 0 times;
    null is a source of its own; a null id is ordered like any other value; rows that repeat an id and
    a text tie, which changes no result as they are equal; no document, no row; further columns are not
    read, whatever their names.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).cast("string").alias("source")
    )
    taken = _taken(rows, weights, max_epochs, seed)
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def mixture(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    max_epochs: int = 3,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, once per epoch that takes them.

    A document on a cut comes once more with its first words only, joined by one space. Rows without
    words, and those the budget does not reach, are left out. Other cases as in ``mixed_documents``.
    """
    names = docs.columns
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.col(source_col).cast("string").alias("source"),
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
    )
    taken = _taken(rows, weights, max_epochs, seed).filter("taken > 0")
    whole = F.expr("array_repeat(size, cast(taken div size as int))")
    part = F.col("taken") % F.col("size")
    taken = taken.withColumn("words", F.explode(F.concat(whole, F.when(part > 0, F.array(part)).otherwise(F.array()))))
    first = F.slice(F.split(F.btrim("text", F.lit(WHITE)), "[\\x20\\x09-\\x0D]+"), 1, F.col("words").cast("int"))
    text = F.when(F.col("words") < F.col("size"), F.array_join(first, " ")).otherwise(F.col("text"))
    return taken.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in names])


def _taken(rows: DataFrame, weights: tuple[int, ...], max_epochs: int, seed: int) -> DataFrame:
    """``rows`` (doc_id, text, source, ...) with size, source_size, target and taken."""
    keyed = rows.withColumn("size", word_count(F.col("text"))).withColumn("group", _group())
    keyed = keyed.withColumn("key", _key(seed)).withColumn("th", F.xxhash64("text"))
    keyed = keyed.withColumn("part", F.shiftright("key", KEY_BITS - RANGE_BITS).cast("int"))
    parts = keyed.groupBy("group", "part").agg(F.sum("size").alias("part_size"))
    within = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.withColumn("before", F.coalesce(F.sum("part_size").over(within), F.lit(0)))
    sums = sums.join(_targets(parts, weights, max_epochs), "group").drop("part_size")
    placed = keyed.join(sums, ["group", "part"])
    order = Window.partitionBy("group", "part").orderBy("key", "doc_id", "th")
    running = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = placed.withColumn("start", F.col("before") + running - F.col("size"))
    epochs = F.expr("case when source_size > 0 then floor(target) div source_size else 0L end")
    placed = placed.withColumn("epochs", epochs)
    rest = F.floor("target") - F.col("epochs") * F.col("source_size")
    partial = F.greatest(F.lit(0), F.least("size", rest - F.col("start")))
    return placed.withColumn("taken", (F.col("epochs") * F.col("size") + partial).cast("long"))


def _group() -> Column:
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))


def _key(seed: int) -> Column:
    digits = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    return F.conv(F.substring(digits, 1, KEY_BITS // 4), 16, 10).cast("long")


def _targets(parts: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """``(group, source_size, target)``: shares by weight under the cap, found in one pass.

    With sources ordered by cap over weight, those that stop at their cap are a prefix of the order: a
    source does when the words left for it and all after it, dealt by weight, would exceed its cap.
    One row per source goes through one task here, never one per document.
    """
    sources = parts.groupBy("group").agg(F.sum("part_size").alias("source_size"))
    turn = Window.orderBy(F.col("group") == "", "group")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = sources.withColumn("w", F.get(cycle, (F.row_number().over(turn) - 1) % len(weights)))
    sources = sources.withColumn("cap", F.lit(max_epochs) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), "group")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sources = sources.withColumns(
        {
            "left": F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "w_left": F.sum("w").over(after),
        }
    )
    sources = sources.withColumn("capped", F.col("cap") * F.col("w_left") < F.col("left") * F.col("w"))
    # All below their cap share the level of the first of them in the order, which has the most weight left.
    level = F.max(F.when(~F.col("capped"), F.struct("w_left", "left"))).over(every)
    open_target = level["left"].cast("double") * F.col("w") / level["w_left"]
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(open_target)
    return sources.select("group", "source_size", target.alias("target"))
