"""Near-duplicate documents by ProbMinHash over weighted word shingles.

A document is the bag of its five-word shingles, weighted by how often each occurs. Every
shingle is a Poisson process of its weight that throws points at random registers; a
register keeps the shingle that reaches it first. Two documents agree in a register with
probability J_P, their probability Jaccard similarity (the plain Jaccard similarity where
no shingle repeats). A shingle's process ends as soon as its next point comes later than
every register is taken, so most shingles need few points.

Registers are cut into bands; documents that agree in a band meet in a bucket and are
verified by their exact J_P. Equal texts are one class from the start. Inside a bucket each
class is first compared with one hub. Where a bucket still holds classes of different
components, all its pairs across components are settled exactly, in tasks of two blocks of
bounded size: an upper bound of J_P by matrix products leaves few pairs to compute.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm.common import components, document_columns, per_worker, slices_of, table
from tallycast.operators.ranking import number_rows
from tallycast.session import cut_lineage, remove, work_path

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: 32 bands of 4 registers: documents of similarity 0.8 share no band with probability
#: (1 - 0.8^4)^32 < 1e-7.
BANDS, ROWS = 32, 4
#: Texts, and bytes of text, in one of the two blocks of a task.
BLOCK, BLOCK_BYTES = 512, 16_000_000
_COLUMNS = 2048
_TEXT_BYTES = 1_000_000
_U64 = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit mixing (the finalizer of splitmix64)."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, as many as needed so far."""
    base = 0x9E3779B97F4A7C15 | 1
    kept = per_worker("powers", lambda: [np.ones(1, _U64), np.ones(1, _U64)])
    if len(kept[0]) < size:
        size = 1 << size.bit_length()
        for k, b in enumerate((base, pow(base, -1, 1 << 64))):
            steps = np.full(size, _U64(b))
            steps[0] = 1
            kept[k] = np.cumprod(steps)
    return kept[0], kept[1]


def shingles(texts: list[str], width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text number, shingle hash, weight)`` of the different shingles of each text.

    A shingle's hash is that of its words joined by blanks, found by differences of running
    sums. A text with fewer words than ``width`` has one shingle of all of them; a text
    without words has none.
    """
    per_byte = _mixed(np.arange(256, dtype=_U64) + _U64(0x632BE59BD9B4E019))
    owners, hashes = [], []
    for number, text in enumerate(texts):
        words = text.encode("utf-8", "replace").split()
        if not words:
            continue
        size = min(width, len(words))
        ends = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=ends[1:])
        raw = np.frombuffer(b" ".join(words) + b" ", np.uint8)
        up, down = _powers(len(raw))
        sums = np.zeros(len(raw) + 1, _U64)
        np.cumsum(per_byte[raw] * up[: len(raw)], out=sums[1:])
        first, last = ends[: len(words) - size + 1], ends[size:]
        own = _mixed((sums[last] - sums[first]) * down[first])
        own.sort()
        hashes.append(own)
        owners.append(np.full(len(own), number))
    if not hashes:
        return np.zeros(0, np.int64), np.zeros(0, _U64), np.zeros(0)
    owner, value = np.concatenate(owners), np.concatenate(hashes)
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    starts = np.flatnonzero(new)
    return owner[starts], value[starts], np.diff(np.append(starts, len(owner))).astype(float)


def prob_min_hash(
    owner: np.ndarray, value: np.ndarray, weight: np.ndarray, count: int, registers: int
) -> np.ndarray:
    """Registers of ``count`` weighted sets: ``[count, registers]`` of element hashes, 0 if empty.

    The elements of all sets go through their arrivals together, some at a time. The j-th gap
    of an element is exponential with its weight as rate and the register it hits is uniform;
    both depend on the element and j alone. An element stops when its last arrival is later
    than the latest register of its set.
    """
    arrival = np.full(count * registers, np.inf)
    holder = np.zeros(count * registers, _U64)
    size = np.bincount(owner, minlength=count)
    active = np.arange(len(owner))
    at, drawn = np.zeros(len(owner)), np.zeros(len(owner), np.int64)
    # a set needs about m ln m arrivals in all to fill its m registers
    share = np.maximum(1, np.ceil(1.5 * registers / np.maximum(1, size))).astype(np.int64)
    while len(active):
        n = share[owner[active]]
        element = np.repeat(active, n)
        first = np.repeat(np.cumsum(n) - n, n)
        step = np.arange(len(element)) - first
        seed = value[element] + (drawn[element] + step + 1).astype(_U64) * _U64(0x9E3779B97F4A7C15)
        bits = _mixed(seed)
        gaps = -np.log(((bits >> _U64(11)).astype(float) + 0.5) * 2.0**-53) / weight[element]
        sums = np.cumsum(gaps)
        before = np.concatenate([[0.0], sums])[first]
        times = at[element] + sums - before
        place = owner[element] * registers + (_mixed(bits ^ _U64(0xD1B54A32D192ED03)) % _U64(registers)).astype(np.int64)
        early = np.flatnonzero(times < arrival[place])
        early = early[np.argsort(-times[early])]  # the earliest is written last and stays
        arrival[place[early]] = times[early]
        holder[place[early]] = value[element[early]]
        ends = np.cumsum(n) - 1
        at[active] += (sums - before)[ends]
        drawn[active] += n
        latest = arrival.reshape(count, registers).max(axis=1)
        active = active[at[active] < latest[owner[active]]]
    return holder.reshape(count, registers)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact J_P of two weighted sets given as sorted hashes and weights.

    It is the sum over shared d of 1 / sum over e of max(a(e)/a(d), b(e)/b(d)). Which of the
    two is larger depends on whether a(e)/b(e) is above a(d)/b(d), so one sort does.
    """
    every = np.union1d(a[0], b[0])
    wa, wb = np.zeros(len(every)), np.zeros(len(every))
    wa[np.searchsorted(every, a[0])] = a[1]
    wb[np.searchsorted(every, b[0])] = b[1]
    if not len(every):
        return 0.0
    with np.errstate(divide="ignore"):
        ratio = np.where(wb > 0, wa / np.where(wb > 0, wb, 1), np.inf)
    order = np.argsort(ratio)
    ratio, wa, wb = ratio[order], wa[order], wb[order]
    both = np.flatnonzero((wa > 0) & (wb > 0))
    if not len(both):
        return 0.0
    above = np.concatenate([np.cumsum(wa[::-1])[::-1], [0.0]])
    up_to = np.concatenate([[0.0], np.cumsum(wb)])
    cut = np.searchsorted(ratio, ratio[both], side="right")
    return float((1 / (above[cut] / wa[both] + up_to[cut] / wb[both])).sum())


def signatures(texts: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(v, text)`` -> ``(v, keys)``: one 64-bit key per band; texts without words have none.

    ``v`` may be of any type.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, column = batch.column(0), batch.column(1)
            for run in slices_of(range(len(column)), pc.binary_length(column).to_pylist(), _TEXT_BYTES):
                plain = column[run.start : run.stop].to_pylist()
                owner, value, weight = shingles(plain)
                filled = np.unique(owner)
                signed = prob_min_hash(np.searchsorted(filled, owner), value, weight, len(filled), bands * rows)
                keys = np.zeros((len(filled), bands), _U64)
                for r in range(rows):
                    keys = _mixed(keys * _U64(31) + signed.reshape(-1, bands, rows)[:, :, r] + _U64(r))
                keys = _mixed(keys + np.arange(1, bands + 1, dtype=_U64))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.reshape(-1).view(np.int64)), bands)
                yield pa.RecordBatch.from_arrays(
                    [names.slice(run.start, len(plain)).take(pa.array(filled)), lists.cast(pa.list_(pa.int64()))],
                    names=["v", "keys"],
                )

    return texts.mapInArrow(sign, f"v {texts.schema['v'].dataType.simpleString()}, keys array<bigint>")


def verified(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs ``(a, b)`` whose texts reach ``similarity``, with it.

    Texts come by two joins on single keys, which AQE splits where one hub has many pairs.
    """
    left = texts.select(F.col("v").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("v").alias("b"), F.col("text").alias("right"))
    full = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int | None, tuple] = (None, ())

        def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
            _, value, weight = shingles([text])
            return value, weight

        for batch in batches:
            kept = []
            for i in range(len(batch)):
                a = batch.column(0)[i].as_py()
                if held[0] != a:
                    held = (a, bag(batch.column(2)[i].as_py()))
                likeness = probability_jaccard(held[1], bag(batch.column(3)[i].as_py()))
                if likeness >= similarity:
                    kept.append((a, batch.column(1)[i].as_py(), likeness))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[c] for k in kept], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.float64()))],
                names=["a", "b", "similarity"],
            )

    return full.mapInArrow(check, "a bigint, b bigint, similarity double")


def _with_hub(members: DataFrame, hub) -> DataFrame:
    """Pairs of every member of a bucket with the bucket's hub."""
    hubs = members.groupBy("key").agg(hub.alias("a"), F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    return members.join(hubs, "key")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``(doc_id, class_id, component_id, kept)``: one row per input row.

    ``class_id`` is the smallest id with an equal text, ``component_id`` the smallest that
    links of ``similarity`` or more lead to, ``kept`` whether the row stands for its
    component: its id is that one and, where this id comes with several texts of the
    component, its text is the one chosen. Null texts and texts without words link with
    nothing and are their own class. Rows that repeat an id and its text share their
    result; an id with different texts is a document for each of them. A null id has null
    ids here and is kept: nothing can stand for it. An empty table gives no row; other
    columns play no part.
    """
    return _labelled(docs, similarity).drop("digest")


def _labelled(docs: DataFrame, similarity: float) -> DataFrame:
    """The rows of ``near_duplicates`` with the digest of their text, null if it has no words."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    worded = _has_word() & F.col("doc_id").isNotNull()
    light = rows.select("doc_id", F.when(worded, F.md5("text")).alias("digest"))
    known, repeated = _classes(light)
    texts = rows.filter(worded).select(F.struct("doc_id", F.md5("text").alias("digest")).alias("v"), "text")
    classes = _rooted(known, texts, similarity)
    best = F.struct(F.col("root").alias("id"), F.col("root").alias("v"))
    if repeated:
        # where a class does not bear its own id, the smallest id is looked for
        wanted = classes.filter("v <> id").select("root").distinct()
        least = classes.join(wanted, "root", "left_semi").groupBy("root").agg(F.min(F.struct("id", "v")).alias("least"))
        at = F.struct("root").alias("at")  # a shuffle of its own for either side, so AQE can split
        classes = classes.withColumn("at", at).join(least.select(at, "least"), "at", "left")
        best = F.coalesce("least", best)
    classes = classes.select("digest", "id", "v", best.alias("best"))
    # rows without a digest match nothing; a key of their own spreads them
    spread = F.coalesce("digest", F.concat(F.lit("#"), F.col("doc_id").cast("string")))
    out = light.select("doc_id", spread.alias("at"), F.col("digest").alias("own")).join(
        classes.withColumnRenamed("digest", "at"), "at", "left"
    )
    stands = (F.col("v") == F.col("best.v")) & (F.col("id") == F.col("doc_id"))
    return out.select(
        "doc_id",
        F.col("own").alias("digest"),
        F.coalesce("id", "doc_id").alias("class_id"),
        F.coalesce("best.id", "doc_id").alias("component_id"),
        F.coalesce(stands, F.lit(True)).alias("kept"),
    )


def _has_word() -> Column:
    return F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")


def _classes(light: DataFrame) -> tuple[DataFrame, bool]:
    """``(digest, id, v)`` of each text, and whether an id has several.

    ``id`` is the smallest with this text and ``v`` a number of the text's own: the id, but
    for the further texts of an id a number that is no id.
    """
    known = cut_lineage(light.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("id")))
    at = F.struct("id").alias("at")
    several = known.groupBy("id").agg(F.min("digest").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = known.select("*", at).join(several.select(at, "first"), "at").filter("digest <> first")
    later = cut_lineage(later.select("digest", "id"))
    count = later.count()
    if not count:
        return known.withColumn("v", F.col("id")), False
    low, high = known.agg(F.min("id"), F.max("id")).first()
    own = F.lit(high + 1) + F.col("n") if high + count < 2**63 else F.lit(low - 1) - F.col("n")
    numbered = number_rows(later, ["id", "digest"], "n").select("digest", own.alias("v"))
    known = known.join(numbered, "digest", "left")
    return cut_lineage(known.select("digest", "id", F.coalesce("v", "id").alias("v"))), True


def _rooted(known: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """``known`` with ``root``, the smallest ``v`` of its component.

    ``texts`` has the texts of all rows, with the struct of id and digest as ``v``.
    """
    spark, place = known.sparkSession, work_path(known.sparkSession, "near-texts")
    keyed = known.select(F.struct(F.col("id").alias("doc_id"), "digest").alias("key"), "v")
    # every text is signed where it is read: moving the texts costs more than signing copies
    signed = signatures(texts).withColumnRenamed("v", "key").join(keyed, "key")
    signed = signed.select("v", "keys").dropDuplicates(["v"])
    banded = signed.select("v", F.explode("keys").alias("key"))
    met = cut_lineage(_with_hub(cut_lineage(banded), F.min("v")).select("key", "v", "a"))
    # the texts that may be compared are moved once, and from then on only they are
    wanted = keyed.join(met.select("v").distinct(), "v", "left_semi")
    moved = texts.withColumnRenamed("v", "key").join(wanted, "key").select("v", "text").dropDuplicates(["v"])
    moved.withColumn("bytes", F.octet_length("text")).write.parquet(place)
    texts = spark.read.parquet(place)
    pairs = met.filter("a <> v").select("a", F.col("v").alias("b")).distinct()
    grouped = components(verified(pairs, texts, similarity).select("a", "b"))
    # buckets that still hold several components
    placed = met.select("key", "v").join(grouped, "v", "left").select("key", "v", F.coalesce("root", "v").alias("root"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    at = F.struct("key").alias("at")  # a shuffle of its own for either side, so AQE can split
    open_ = cut_lineage(placed.select("*", at).join(mixed.select(at), "at", "left_semi").select("key", "v", "root"))
    rest = _settled(_seats(_groups(open_), texts), texts, similarity)
    up = components(rest.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    remove(spark, place)  # `components` has stored what it needs
    rooted = known.join(grouped, "v", "left").withColumn("root", F.coalesce("root", "v"))
    up = up.select(F.col("v").alias("root"), F.col("root").alias("up"))
    return rooted.join(up, "root", "left").select("digest", "id", "v", F.coalesce("up", "root").alias("root"))


def _groups(open_: DataFrame) -> DataFrame:
    """``(group, v, root)``: all of ``(key, v, root)`` that have to be compared with each other.

    A family meets in buckets of many bands. Buckets that share members are one group, so
    that each text moves once, unless to take them one by one moves fewer texts.
    """

    def moved(n):
        return n * F.ceil(n / F.lit(BLOCK))

    buckets = open_.groupBy("key").agg(F.min("v").alias("a"), F.count(F.lit(1)).alias("n"))
    joined = components(open_.join(buckets, "key").select("a", F.col("v").alias("b")))
    joined = joined.select("v", F.col("root").alias("whole"))
    apart = buckets.join(joined, buckets["a"] == joined["v"]).groupBy("whole").agg(F.sum(moved(F.col("n"))).alias("apart"))
    sizes = joined.groupBy("whole").agg(moved(F.count(F.lit(1))).alias("together")).join(apart, "whole")
    # on a struct the sums are dealt anew, so AQE knows their size and can split a hot group
    at = F.struct("whole").alias("at")
    kind = sizes.select(at, (F.col("together") <= F.col("apart")).alias("one"))
    group = F.when(F.col("one"), F.col("whole")).otherwise(F.col("key")).alias("group")
    return open_.join(joined, "v").withColumn("at", at).join(kind, "at").select(group, "v", "root").distinct()


def _seats(members: DataFrame, texts: DataFrame) -> DataFrame:
    """``(task, second, v, root)``: who sits in the first or second block of each task.

    A component that fills several blocks has blocks of its own, which are not compared
    with each other; the other members of a group share blocks.
    """
    members = cut_lineage(members.join(texts.select("v", "bytes"), "v"))
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("bytes") / BLOCK_BYTES))
    large = members.groupBy("group", "root").agg(blocks.alias("own")).filter("own > 1")
    at = F.struct("group", "root").alias("at")
    laid = members.withColumn("at", at).join(large.select(at, "own"), "at", "left").drop("at")
    shared = laid.filter("own is null").groupBy("group").agg(blocks.alias("shared"))
    part = F.pmod(F.xxhash64("v"), F.coalesce("own", "shared"))
    is_large = F.col("own").isNotNull()
    owner = F.when(is_large, F.col("root")).otherwise(F.lit(0))
    block = F.struct(is_large.alias("large"), owner.alias("owner"), part.alias("part"))
    at = F.struct("group").alias("at")
    laid = laid.withColumn("at", at).join(shared.select(at, "shared"), "at", "left")
    laid = cut_lineage(laid.select("group", block.alias("block"), "v", "root"))
    counted = laid.groupBy("group", "block").agg(F.count(F.lit(1)).alias("n"))
    x = counted.select("group", F.col("block").alias("x"), "n")
    y = counted.select("group", F.col("block").alias("y"))
    tasks = x.join(y, "group").filter("x <= y and (x < y or n > 1)")
    tasks = tasks.filter("not (x.large and y.large and x.owner = y.owner)").select("group", "x", "y")
    tasks = cut_lineage(tasks.withColumn("task", F.monotonically_increasing_id()))
    sides = [
        tasks.filter(f"not {second} or x < y").select("task", F.lit(second).alias("second"), "group", F.col(side).alias("block"))
        for side, second in (("x", False), ("y", True))
    ]
    return laid.join(sides[0].unionByName(sides[1]), ["group", "block"]).select("task", "second", "v", "root")


def _settled(seats: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links ``(a, b, similarity, root_a, root_b)`` that join the components which meet in the tasks."""
    dealt = seats.join(texts.select("v", "text"), "v").select("task", "second", "v", "root", "text")
    dealt = dealt.repartition("task").sortWithinPartitions("task", "second", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            task = batch.column(0).to_numpy()
            starts = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist(), len(task)]
            for begin, end in zip(starts, starts[1:]):
                if waiting and begin < end and waiting[0].column(0)[0].as_py() != task[begin]:
                    yield settle(waiting)
                    waiting = []
                if begin < end:
                    waiting.append(batch.slice(begin, end - begin))
        if waiting:
            yield settle(waiting)

    def settle(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts)
        names, roots = rows.column("v").to_numpy(), rows.column("root").to_numpy()
        cut = int(np.searchsorted(rows.column("second").to_numpy(zero_copy_only=False), True))
        found = block_links(rows.column("text").to_pylist(), roots, cut, similarity)
        i, j = (np.array([f[k] for f in found], np.int64) for k in (0, 1))
        likeness = pa.array([f[2] for f in found], pa.float64())
        return pa.RecordBatch.from_arrays(
            [pa.array(names[i]), pa.array(names[j]), likeness, pa.array(roots[i]), pa.array(roots[j])],
            names=["a", "b", "similarity", "root_a", "root_b"],
        )

    return dealt.mapInArrow(run, "a bigint, b bigint, similarity double, root_a bigint, root_b bigint")


def block_links(texts: list[str], roots: np.ndarray, cut: int, similarity: float) -> list[tuple[int, int, float]]:
    """Pairs of ``similarity`` that join all components with a link across two blocks.

    The first ``cut`` texts are compared with the rest, or with each other if there is no
    rest. Pairs that are joined already are left out. With alpha and beta the shares of the
    two weights that lie on common shingles, J_P <= 1 / (1 / alpha + 1 / beta - 1), and equal
    to it where no shingle repeats.
    """
    owner, value, weight = shingles(texts)
    same = cut == len(texts)
    weight_of = weight / np.maximum(1.0, np.bincount(owner, weight, len(texts)))[owner]
    _, column, held = np.unique(value, return_inverse=True, return_counts=True)
    use = held[column] > 1
    if not same:
        left = np.bincount(column[owner < cut], minlength=len(held))
        use &= (left > 0)[column] & (left < held)[column]
    row, share = owner[use], weight_of[use]
    _, column = np.unique(column[use], return_inverse=True)
    order = np.argsort(column, kind="stable")
    row, column, share = row[order], column[order], share[order]
    rest = slice(0, None) if same else slice(cut, None)
    alpha = np.zeros((cut, cut if same else len(texts) - cut))
    beta = np.zeros_like(alpha)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        here = slice(*np.searchsorted(column, [first, first + _COLUMNS]))
        dense = np.zeros((len(texts), _COLUMNS))
        dense[row[here], column[here] - first] = share[here]
        has = (dense > 0).astype(float)
        alpha += dense[:cut] @ has[rest].T
        beta += has[:cut] @ dense[rest].T
    with np.errstate(divide="ignore"):
        bound = 1 / (1 / alpha + 1 / beta - 1)
    bound[roots[:cut, None] == roots[rest][None, :]] = 0
    if same:
        bound = np.triu(bound)
    i, j = np.nonzero(bound >= similarity - 1e-9)
    likely = np.argsort(-bound[i, j], kind="stable")
    starts = np.searchsorted(owner, np.arange(len(texts) + 1))
    bag = lambda k: (value[starts[k] : starts[k + 1]], weight[starts[k] : starts[k + 1]])
    joined, found = {}, []

    def root(k: int) -> int:
        while joined.get(k, k) != k:
            k = joined[k]
        return k

    for a, b in zip(i[likely].tolist(), (j[likely] + rest.start).tolist()):
        ra, rb = root(int(roots[a])), root(int(roots[b]))
        if ra != rb:
            likeness = probability_jaccard(bag(a), bag(b))
            if likeness >= similarity:
                joined[ra] = rb
                found.append((a, b, likeness))
    return found


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, with the columns of documents.

    Rows that repeat an id and its text stay once, texts without words once for each id. All
    texts of an id stay that are no near copies. Rows with a null id stay.
    """
    rows = document_columns(docs)
    digest = F.when(_has_word(), F.md5("text"))
    key = lambda digest: F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(digest, F.lit("")).alias("digest"))
    named = rows.filter("doc_id is not null").withColumn("key", key(digest))
    kept = _labelled(rows, SIMILARITY).filter("kept and doc_id is not null").select(key(F.col("digest")).alias("key")).distinct()
    once = named.join(kept, "key", "left_semi").dropDuplicates(["key"]).drop("key")
    return once.unionByName(rows.filter("doc_id is null"))
