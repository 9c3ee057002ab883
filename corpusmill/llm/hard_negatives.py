"""Hard negatives of anchor vectors by exact integer scores, several candidates to one multiplication.

Components are scaled to integers. Within a tile of anchors and candidates both sides are raised by a bias so
that nothing is negative, and the d-th components of several candidates are laid side by side into
separated fields of one wide integer. One multiplication per anchor component then serves them all; no
field can carry into the next, as its width holds the largest sum possible in the tile. Unpacking a field and
taking the bias away again gives the exact score. Where the fields together fit a double's 53 exact bits the
products run as one matrix product, else on Python's unbounded integers.

Anchors are a stated share of the rows and meet all rows in tiles of bounded size: anchors in
blocks, candidates in blocks, each block copied once per block it meets. A tile gives at most ``positives``
(``negatives`` per positive) rows per anchor, of which the best are kept by rank. A label with a third of
all rows has more blocks, not larger ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.columns import whole_numbers
from corpusmill.session import spill

ANCHORS, CANDIDATES = 2048, 8192  # rows of a tile
EXACT_BITS = 53  # integers below two to this power are exact doubles
WIDE_BITS = 512  # of the integers beyond that
AT_ONCE = 256  # anchors whose scores with a tile's candidates are held at a time

_PAIR = "anchor_id long, other_id long, score long"
_NEGATIVE = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


@dataclass(frozen=True)
class Band:
    """Negatives score from ``low`` to ``high`` hundredths of the positive's score."""

    low: int = 50
    high: int = 95


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    band: Band = Band(),
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``, ranks from 1.

    ``anchor`` says which rows are anchors, in terms of ``id`` and ``label``. A component x counts as
    floor(scale * x); a score is the inner product, higher first, ties by smaller id. Positives are
    the anchor's first other rows of its label; negatives the first rows of other labels for which
    low * positive score <= 100 * negative score <= high * positive score. Defined cases: rows with a null
    id, a null label, a null or empty vector, or a null or non-finite component take no part; vectors
    of different lengths do not meet; of rows that repeat an id, the one with the smallest
    (label, vector) does; an anchor without positives or negatives has no row; scores that do not fit a
    long raise an error; ids and labels must be whole numbers; further columns are not read.
    """
    rows = _scaled(vectors, scale, id_col, vector_col, label_col)
    rows = spill(rows.withColumn("is_anchor", F.coalesce(anchor, F.lit(False))))
    first = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "other_id")
    found = _tiles(rows, ["dim", "label"], rows.filter("is_anchor")).applyInArrow(_positives(positives), _PAIR)
    chosen = spill(found.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= positives).drop("r"))

    asked = chosen.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("score", "other_id"))).alias("pos"))
    asked = rows.filter("is_anchor").join(asked.withColumnRenamed("anchor_id", "id"), "id")
    met = _tiles(rows, ["dim"], asked).applyInArrow(_negatives(negatives, band), _NEGATIVE)
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _scaled(vectors: DataFrame, scale: float, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``(id, label, dim, v)`` of the rows that take part; ``v`` holds whole numbers as doubles."""
    rows = vectors.select(
        whole_numbers(vectors, id_col).alias("id"),
        whole_numbers(vectors, label_col).alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
    )
    fit = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & fit)
    one = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("x")).select("id", "x.label", "x.v")

    def floored(x: Column) -> Column:
        return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)

    whole = F.transform(F.transform("v", lambda x: x * scale), floored)
    return one.select("id", "label", F.size("v").alias("dim"), whole.alias("v"))


def _tiles(rows: DataFrame, key: list[str], anchors: DataFrame):
    """Anchors and candidates of a key, dealt to blocks of bounded size; every pair of blocks is one group."""
    held = rows.groupBy(*key).agg(
        F.ceil(F.count("*") / CANDIDATES).cast("int").alias("blocks"),
        F.ceil(F.count(F.when(F.col("is_anchor"), True)) / ANCHORS).cast("int").alias("asks"),
    )
    here = [F.col(k).alias(k) for k in key]
    extra = [F.col("pos").alias("pos")] if "pos" in anchors.columns else []
    sized = rows.join(held, key).filter("asks > 0").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    sized = sized.withColumn("ask", F.explode(F.sequence(F.lit(0), F.col("asks") - 1)))
    asked = anchors.join(held, key).withColumn("ask", F.pmod(F.xxhash64(F.lit(1), F.col("id")), "asks").cast("int"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tile = [*key, "block", "ask"]
    inner = [F.col(c).alias(c) for c in ("block", "ask", "id", "v", *[c for c in ("label", "dim") if c not in key])]
    return (
        asked.select(*here, *inner, *extra).groupBy(*tile).cogroup(sized.select(*here, *inner).groupBy(*tile))
    )


def _rows_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """Ids in rising order and their vectors as whole numbers (objects where doubles would not hold them)."""
    table = table.take(pa.array(np.argsort(table.column("id").to_numpy())))
    flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    v = flat.reshape(table.num_rows, -1)
    if np.abs(v).max() >= 2.0**EXACT_BITS:
        v = np.array([[int(x) for x in row] for row in v], object)
    return table.column("id").to_numpy(), v, table


class Packed:
    """Candidates, several to a wide integer, ready to be multiplied by anchors of a known range.

    ``scores`` of an anchor x and a candidate y follow from raised ones x + s, y + t >= 0:
    sum (x + s)(y + t) = sum xy + t sum x + s sum y + d s t, where d is the number of components.
    """

    def __init__(self, candidates: np.ndarray, low: int, high: int) -> None:
        """``low`` and ``high`` bound the anchors' components."""
        self.n, self.dim = candidates.shape
        self.anchor_bias, self.bias = -low, -int(candidates.min())
        raised = candidates + self.bias
        top = self.dim * (high - low) * int(raised.max())
        if self.dim * max(abs(low), abs(high)) * int(np.abs(candidates).max()) >= 1 << 63:
            raise OverflowError("scores do not fit a long")
        self.width = max(1, top.bit_length())
        self.doubles = self.width <= EXACT_BITS
        self.fields = max(1, (EXACT_BITS if self.doubles else WIDE_BITS) // self.width)
        groups = -(-self.n // self.fields)
        kind = np.float64 if self.doubles else object
        wide = np.zeros((groups, self.dim), kind)
        for k in range(self.fields):
            part = raised[k * groups : (k + 1) * groups]
            wide[: len(part)] += (part if self.doubles else _integers(part)) * 2 ** (self.width * k)
        self.wide = wide.T.copy()
        self.groups = groups
        self.sums = _integers(candidates).sum(axis=1) if not self.doubles else candidates.sum(axis=1).astype(np.int64)

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact scores, anchors by candidates."""
        if self.doubles:
            product = ((anchors + self.anchor_bias).astype(np.float64) @ self.wide).astype(np.int64)
            mine = anchors.sum(axis=1).astype(np.int64)
        else:
            product, mine = np.dot(_integers(anchors) + self.anchor_bias, self.wide), _integers(anchors).sum(axis=1)
        mask, out = (1 << self.width) - 1, np.zeros((len(anchors), self.fields * self.groups), np.int64)
        raised = self.bias * mine[:, None] + self.dim * self.anchor_bias * self.bias
        for k in range(self.fields):
            sums = self.sums[k * self.groups : (k + 1) * self.groups]
            field = (product[:, : len(sums)] >> (k * self.width)) & mask
            out[:, k * self.groups : k * self.groups + len(sums)] = field - raised - self.anchor_bias * sums[None, :]
        return out[:, : self.n]


def _integers(values: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in values], object).reshape(values.shape)


def _scored(anchors: pa.Table, candidates: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Table, pa.Table, np.ndarray]]:
    """Some anchors of a tile at a time: their ids, the candidates' ids, both tables in that order, scores."""
    if not anchors.num_rows or not candidates.num_rows:
        return
    a_ids, x, a_rows = _rows_of(anchors)
    c_ids, y, c_rows = _rows_of(candidates)
    packed = Packed(y, int(x.min()), int(x.max()))
    for i in range(0, len(a_ids), AT_ONCE):
        part = slice(i, i + AT_ONCE)
        yield a_ids[part], c_ids, a_rows.slice(i, AT_ONCE), c_rows, packed.scores(x[part])


def _best(scores: np.ndarray, open_: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k highest open scores of every row, ties to the left; -1 where there are fewer.

    The k-th highest value bounds the choice; columns above it all come, those equal to it from the left.
    """
    least = np.iinfo(np.int64).min
    held = np.where(open_, scores, least)
    k = min(k, held.shape[1])
    out = np.full((len(held), k), -1, np.int64)
    floor = np.partition(held, -k, axis=1)[:, -k]
    row, column = np.nonzero((held >= floor[:, None]) & open_)
    order = np.lexsort((column, -held[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    keep = place < k
    out[row[keep], place[keep]] = column[keep]
    return out


def _positives(k: int) -> Callable:
    def rows(key: tuple, anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        out: dict[str, list] = {"anchor_id": [], "other_id": [], "score": []}
        for a_ids, c_ids, _, _, scores in _scored(anchors, candidates):
            best = _best(scores, c_ids[None, :] != a_ids[:, None], k)
            row, place = np.nonzero(best >= 0)
            at = best[row, place]
            for c, v in zip(out, (a_ids[row], c_ids[at], scores[row, at]), strict=True):
                out[c].append(v)
        return _table(out)

    return rows


def _negatives(k: int, band: Band) -> Callable:
    def rows(key: tuple, anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        out: dict[str, list] = {c.split()[0]: [] for c in _NEGATIVE.split(", ")}
        for a_ids, c_ids, a_rows, c_rows, scores in _scored(anchors, candidates):
            pos = a_rows.column("pos").to_pylist()
            other = a_rows.column("label").to_numpy()[:, None] != c_rows.column("label").to_numpy()[None, :]
            for p in range(max(map(len, pos))):
                has = np.array([i for i, x in enumerate(pos) if len(x) > p])
                score = [pos[i][p]["score"] for i in has]
                low = np.array([-(-band.low * s // 100) for s in score], np.int64)[:, None]
                high = np.array([band.high * s // 100 for s in score], np.int64)[:, None]
                best = _best(scores[has], other[has] & (scores[has] >= low) & (scores[has] <= high), k)
                row, place = np.nonzero(best >= 0)
                at = best[row, place]
                ids = np.array([pos[i][p]["other_id"] for i in has], np.int64)
                values = (a_ids[has][row], ids[row], np.array(score, np.int64)[row], c_ids[at], scores[has][row, at])
                for c, v in zip(out, values, strict=True):
                    out[c].append(v)
        return _table(out)

    return rows


def _table(columns: dict[str, list]) -> pa.Table:
    return pa.table({c: np.concatenate([*v, np.zeros(0, np.int64)]).astype(np.int64) for c, v in columns.items()})
