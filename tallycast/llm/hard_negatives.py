"""Hard negatives by segment summaries.

A vector is cut into segments and the mean and deviation of each are stored. Of two vectors,
the inner product of a segment of ``n`` components is ``n * (mean * mean)``, give or take
``n * (deviation * deviation)``, so the summaries bound a score from both sides. Coarse
segments settle what they can, what stays open is bounded by finer ones, and only the rest
is scored exactly.

Anchors are a stated part of the rows. A block of them of bounded size is broadcast and all
rows go past it, once for the positives and once for the negatives of the bands that these
set; a task keeps the best few per anchor and sends on only those. As a start, the anchors
of the block are scored among themselves: no row below what they reach can be returned, so
few rows leave a task however many tasks there are.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallycast.llm.common import per_worker, table
from tallycast.session import cut_lineage, remove, work_path

#: Positives of an anchor, negatives of a positive, and the band of negative scores in
#: hundredths of the positive score (fixed by the contract).
POSITIVES, NEGATIVES, LOWEST, HIGHEST = 5, 10, 30, 90
#: Components are counted in steps of one such part (fixed by the contract).
STEPS = 256
#: Components per segment, from coarse to fine.
SEGMENTS = (8, 2)
#: A vector whose squares sum to more has scores that no 64-bit number holds.
MOST_SQUARES = 2.0**55
#: Components of the anchors in one block: 8 MB.
ANCHOR_COMPONENTS = 1_000_000
#: Share of a bound's scale that rounding may take.
_ROUNDING = 1e-6
_ROWS, _ANCHORS = 1024, 512
_NONE = np.iinfo(np.int64).min


def summaries(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the segments of each row, coarse ones first."""
    size = vectors.shape[1]
    means, deviations = [np.zeros((len(vectors), 0))], [np.zeros((len(vectors), 0))]
    for length in SEGMENTS if size else ():
        edges, sizes = _segments(size, length)
        mean = np.add.reduceat(vectors, edges, axis=1) / sizes
        square = np.add.reduceat(vectors * vectors, edges, axis=1) / sizes
        means.append(mean)
        deviations.append(np.sqrt(np.maximum(0, square - mean * mean)))
    return np.concatenate(means, axis=1), np.concatenate(deviations, axis=1)


def _segments(size: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First component of each segment, and how many it has."""
    edges = np.arange(0, size, length)
    return edges, np.diff(np.append(edges, size))


class Block:
    """Vectors of one length with their summaries, ready to be compared."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, means: np.ndarray, deviations: np.ndarray):
        self.ids, self.labels, self.vectors, self.means, self.deviations = ids, labels, vectors, means, deviations
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))

    def of(self, rows) -> Block:
        part = object.__new__(Block)
        for name, value in self.__dict__.items():
            setattr(part, name, value[rows])
        return part

    def __len__(self) -> int:
        return len(self.ids)


def open_pairs(rows: Block, anchors: Block, allowed: np.ndarray, wanted) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, anchor, score)`` of the allowed pairs whose bounds stay ``wanted`` to the end.

    ``wanted(low, high, anchor)`` says for which anchors a score between the bounds matters.
    """
    i, j = np.nonzero(allowed)
    slack = lambda: _ROUNDING * (rows.norms[i] * anchors.norms[j]) + _ROUNDING
    size, at = rows.vectors.shape[1], 0
    for length in SEGMENTS if size else ():
        if not len(i):
            break
        edges, sizes = _segments(size, length)
        here = slice(at, at + len(edges))
        at += len(edges)
        middle = _products(rows.means[:, here] * sizes, anchors.means[:, here], i, j)
        spread = _products(rows.deviations[:, here] * sizes, anchors.deviations[:, here], i, j) + slack()
        kept = wanted(middle - spread, middle + spread, j)
        i, j = i[kept], j[kept]
    largest = rows.norms.max(initial=0) * anchors.norms.max(initial=0)
    kind = np.float64 if largest < 2.0**52 else np.int64  # whole numbers, exact either way
    score = _products(rows.vectors.astype(kind), anchors.vectors.astype(kind), i, j).astype(np.int64)
    return i, j, score


def _products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the pairs ``(a[i], b[j])``, all at once where most are asked for."""
    if len(i) * 8 >= len(a) * len(b):
        return (a @ b.T)[i, j]
    out = np.empty(len(i), np.result_type(a, b))
    for at in range(0, len(i), 65_536):
        to = slice(at, at + 65_536)
        out[to] = np.einsum("ij,ij->i", a[i[to]], b[j[to]])
    return out


class Best:
    """The ``k`` highest scores of each key, ties by smaller id; a row counts once."""

    def __init__(self, keys: int, k: int, floor: np.ndarray | None = None):
        self.scores = np.full((keys, k), _NONE)
        self.ids = np.zeros((keys, k), np.int64)
        self._floor = np.full(keys, _NONE) if floor is None else floor

    def least(self) -> np.ndarray:
        """The score a row needs to be looked at."""
        return np.maximum(self._floor, self.scores[:, -1])

    def put(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(key):
            return
        touched = np.unique(key)
        k = self.scores.shape[1]
        old = self.scores[touched].reshape(-1)
        there = old != _NONE
        key = np.concatenate([key, np.repeat(touched, k)[there]])
        score = np.concatenate([score, old[there]])
        ids = np.concatenate([ids, self.ids[touched].reshape(-1)[there]])
        order = np.lexsort((ids, -score, key))
        key, score, ids = key[order], score[order], ids[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        key, score, ids = key[new], score[new], ids[new]
        first = np.searchsorted(key, key)
        rank = np.arange(len(key)) - first
        top = rank < k
        self.scores[touched], self.ids[touched] = _NONE, 0
        self.scores[key[top], rank[top]] = score[top]
        self.ids[key[top], rank[top]] = ids[top]


class Anchors:
    """A block of anchors, by vector length, and what is looked for beside each."""

    def __init__(self, blocks: dict[int, tuple[np.ndarray, Block]], count: int):
        self.blocks, self.count = blocks, count
        self.bands: tuple[np.ndarray, np.ndarray] | None = None

    def packed(self) -> bytes:
        """Its arrays; they hold no class of this module, which a worker may know under another name."""
        plain = {size: (numbers, b.__dict__) for size, (numbers, b) in self.blocks.items()}
        return pickle.dumps((plain, self.count, self.bands))

    @classmethod
    def unpacked(cls, raw: bytes) -> Anchors:
        plain, count, bands = pickle.loads(raw)
        blocks = {}
        for size, (numbers, arrays) in plain.items():
            block = object.__new__(Block)
            block.__dict__.update(arrays)
            blocks[size] = (numbers, block)
        made = cls(blocks, count)
        made.bands = bands
        return made

    def positives(self, rows: Block, size: int, best: Best) -> None:
        """Put the rows that share an anchor's label into ``best``."""
        numbers, anchors = self.blocks[size]
        for label in np.unique(rows.labels):
            mine = np.flatnonzero(anchors.labels == label)
            some = rows.of(rows.labels == label)
            for at in range(0, len(mine), _ANCHORS):
                part = mine[at : at + _ANCHORS]
                least = best.least()[numbers[part]]
                asked = anchors.of(part)
                other = some.ids[:, None] != asked.ids[None, :]
                i, j, score = open_pairs(some, asked, other, lambda low, high, k, least=least: high >= least[k])
                good = score >= least[j]
                best.put(numbers[part][j[good]], score[good], some.ids[i[good]])

    def negatives(self, rows: Block, size: int, best: Best) -> None:
        """Put the rows of other labels that lie in a band into ``best``, by anchor and band."""
        lows, highs = self.bands
        width = lows.shape[1]
        numbers, anchors = self.blocks[size]
        for at in range(0, len(anchors), _ANCHORS):
            part = slice(at, at + _ANCHORS)
            asked, own = anchors.of(part), numbers[part]
            low = np.maximum(lows[own], best.least().reshape(-1, width)[own])
            high = highs[own]

            def wanted(least, most, k, low=low, high=high):
                return ((most[:, None] >= low[k]) & (least[:, None] <= high[k])).any(axis=1)

            other = rows.labels[:, None] != asked.labels[None, :]
            i, j, score = open_pairs(rows, asked, other, wanted)
            for band in range(width):
                good = (score >= low[j, band]) & (score <= high[j, band])
                best.put(own[j[good]] * width + band, score[good], rows.ids[i[good]])

    def floors(self, k: int, what: str) -> np.ndarray:
        """The ``k``-th best score that the anchors of the block themselves reach."""
        best = Best(self.count * (1 if self.bands is None else self.bands[0].shape[1]), k)
        for size, (_, anchors) in self.blocks.items():
            for at in range(0, len(anchors), _ROWS):
                getattr(self, what)(anchors.of(slice(at, at + _ROWS)), size, best)
        return best.scores[:, -1]


_PREPARED = "vec_id bigint, label bigint, vector array<double>, means array<double>, deviations array<double>"


def prepared(vectors: DataFrame) -> DataFrame:
    """The rows that take part, components in whole steps, with their summaries."""
    vector = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), vector.alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter("vec_id is not null and label is not null and vector is not null").filter(~bad)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for here, block in _by_size(batch.column(2)):
                with np.errstate(over="ignore"):
                    whole = np.floor(block * STEPS)
                    fits = (whole * whole).sum(axis=1) < MOST_SQUARES
                whole = whole[fits]
                means, deviations = summaries(whole)
                kept = batch.take(pa.array(here[fits]))
                lists = [_lists(m) for m in (whole, means, deviations)]
                yield pa.RecordBatch.from_arrays(
                    [kept.column(0), kept.column(1), *lists], names=["vec_id", "label", "vector", "means", "deviations"]
                )

    return rows.mapInArrow(run, _PREPARED)


def _by_size(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row numbers, matrix)`` of the rows of each length."""
    sizes = np.diff(np.asarray(lists.offsets))
    for size in np.unique(sizes):
        here = np.flatnonzero(sizes == size)
        yield here, _matrix(lists, here)


def _matrix(lists: pa.Array, here: np.ndarray) -> np.ndarray:
    """The rows ``here``, which are of one length."""
    offsets = np.asarray(lists.offsets)
    begins = offsets[here]
    return np.asarray(lists.values)[begins[:, None] + np.arange(offsets[here[0] + 1] - begins[0])]


def _lists(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(matrix.reshape(-1)))


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, Block]]:
    """``(length, row numbers, block)`` of a batch of prepared rows, by length."""
    ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    for here, vectors in _by_size(batch.column(2)):
        means, deviations = _matrix(batch.column(3), here), _matrix(batch.column(4), here)
        yield vectors.shape[1], here, Block(ids[here], labels[here], vectors, means, deviations)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
    anchor_components: int = ANCHOR_COMPONENTS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``vectors`` has ``vec_id, embedding, label``; ``is_anchor`` is a condition on ``vec_id``
    and ``label``. Scores are inner products of the components in whole steps. An anchor's
    positives are its best other rows of the same label; of each, the best rows of another
    label with ``lowest`` to ``highest`` hundredths of its score are its hard negatives. The
    higher score comes first, then the smaller id.

    Rows with a null id or label, a null vector or a null or non-finite component take no
    part, nor do vectors too large for 64-bit scores (:data:`MOST_SQUARES`). Vectors of
    different length are not compared. Anchors that repeat an id, label and vector are one;
    rows that share an id are told apart by their scores, equal ones count once, and none is
    a positive of the other.
    An empty table, and one without anchors, gives no row; other columns play no part.
    """
    spark = vectors.sparkSession
    place = work_path(spark, "segment-summaries")
    prepared(vectors).write.parquet(place)
    rows = spark.read.schema(_PREPARED).parquet(place)
    anchors = rows.filter(is_anchor)
    held = anchors.agg(F.sum(F.size("vector") + 1)).first()[0] or 0
    blocks = -(-held // anchor_components)
    out = None
    for block in range(blocks):
        mine = anchors.filter(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)) == block)
        found = cut_lineage(_one_block(rows, _collected(mine), positives, negatives, lowest, highest))
        out = found if out is None else out.unionByName(found)
    remove(spark, place)
    return spark.createDataFrame([], _FOUND) if out is None else out


_FOUND = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _collected(mine: DataFrame) -> tuple[Anchors, np.ndarray]:
    """The anchors of a block, whose number is bounded, and their ids."""
    rows = mine.dropDuplicates(["vec_id", "label", "vector"]).orderBy("vec_id", "label", "vector").toArrow()
    blocks: dict[int, tuple[np.ndarray, Block]] = {}
    for batch in rows.combine_chunks().to_batches():  # one, or none
        for size, here, block in _blocks(batch):
            blocks[size] = (here, block)
    return Anchors(blocks, len(rows)), rows.column("vec_id").to_numpy()


def _one_block(rows: DataFrame, block: tuple[Anchors, np.ndarray], positives: int, negatives: int, lowest: int, highest: int) -> DataFrame:
    anchors, names = block
    spark = rows.sparkSession
    near = _passed(rows, anchors, positives, "positives")
    first = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    chosen = near.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= positives)
    scores = np.full((anchors.count, positives), _NONE)
    ids = np.zeros((anchors.count, positives), np.int64)
    for row in chosen.collect():  # so many per anchor of the block
        scores[row["key"], row["rank"] - 1], ids[row["key"], row["rank"] - 1] = row["score"], row["vec_id"]
    has = scores != _NONE
    known = np.where(has, scores, 0)
    anchors.bands = (np.where(has, -(-lowest * known // 100), 1), np.where(has, highest * known // 100, 0))
    far = _passed(rows, anchors, negatives, "negatives")
    # as many rows as there are positives
    a, p = np.nonzero(has)
    pairs = pa.table(
        {"key": a * positives + p, "anchor_id": names[a], "positive_id": ids[a, p], "positive_score": scores[a, p]}
    )
    ranked = far.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= negatives)
    full = ranked.join(F.broadcast(spark.createDataFrame(pairs)), "key")
    return full.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def _passed(rows: DataFrame, anchors: Anchors, k: int, what: str) -> DataFrame:
    """``(key, score, vec_id)``: the best ``k`` of every task for each anchor, or anchor and band."""
    packed = rows.sparkSession.sparkContext.broadcast(anchors.packed())
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = per_worker("anchors", lambda: {})
        if name not in held:
            held.clear()
            mine = Anchors.unpacked(packed.value)
            held[name] = (mine, mine.floors(k, what))
        mine, floors = held[name]
        best = Best(len(floors), k, floors)
        for batch in batches:
            for size, _, block in _blocks(batch):
                if size in mine.blocks:
                    for at in range(0, len(block), _ROWS):
                        getattr(mine, what)(block.of(slice(at, at + _ROWS)), size, best)
        key, place = np.nonzero(best.scores != _NONE)
        columns = [key.astype(np.int64), best.scores[key, place], best.ids[key, place]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "score", "vec_id"])

    return rows.mapInArrow(run, "key bigint, score bigint, vec_id bigint").distinct()


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.col("label").cast("bigint").alias("label"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)
