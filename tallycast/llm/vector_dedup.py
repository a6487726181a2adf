"""Near-duplicate vectors by randomised-rotation binary codes.

A unit vector is turned by a random rotation and each coordinate kept as its sign. The code
stores a correction factor ``f``, the inner product of the vector with its own code; the inner
product of code and another vector, divided by ``f``, estimates that of the two vectors without
bias, within ``e * sqrt(1 - f^2) / f / sqrt(d - 1)`` for all but a vanishing share of rotations.
Pairs whose upper bound stays below the threshold are settled; all others are computed again
exactly, in double precision.

Which pairs meet is settled by the codes as well: the signs of further rotations are cut into
bands, and vectors of a label that agree in a band meet in a bucket. Large buckets are cut into
blocks and every two blocks form a task, so no task grows with a bucket. A pair is counted in
the first band that it agrees in and nowhere else; only counts and block-wise components leave
a task, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm.common import components, per_worker, table
from tallycast.session import cut_lineage

THRESHOLD = 0.98
#: Two vectors of cosine 0.98 agree in a sign with probability 1 - acos(0.98) / pi = 0.936,
#: in a band of 20 with 0.27, and in none of 56 bands with 3e-8.
BANDS, BITS = 56, 20
#: Multiple of the standard error that the bound allows for.
ERROR = 6.0
BLOCK = 512
SEED = 20_240_601


def rotations(size: int, count: int, seed: int = SEED) -> np.ndarray:
    """``count`` random orthogonal matrices, ``[count, size, size]``, the same everywhere."""

    def make() -> np.ndarray:
        out = []
        for k in range(count):
            normal = np.random.default_rng([seed, size, k]).standard_normal((size, size))
            q, r = np.linalg.qr(normal)
            out.append(q * np.sign(np.diag(r)))
        return np.stack(out)

    return per_worker(f"rotations:{size}:{count}:{seed}", make)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings the largest component near 1: no square leaves the range of numbers."""
    largest = np.abs(vectors).max(axis=1, keepdims=True, initial=0)
    return np.ldexp(vectors, -np.frexp(largest)[1])


def encode(vectors: np.ndarray, bands: int = BANDS, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(band codes [n, bands], sign code [n, bytes], correction factors [n])`` of rows."""
    n, size = vectors.shape
    vectors = scaled(vectors)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    turned = unit @ np.concatenate(rotations(size, -(-bands * bits // size))).T
    signs = turned[:, : bands * bits].reshape(n, bands, bits) >= 0
    codes = (signs * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)
    own = turned[:, :size]
    return codes, np.packbits(own >= 0, axis=1, bitorder="little"), np.abs(own).sum(axis=1) / math.sqrt(size)


def estimates(code: np.ndarray, factor: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of coded unit vectors with ``others``, and the error bound per code."""
    size = others.shape[1]
    signs = np.unpackbits(code, axis=1, count=size, bitorder="little").astype(np.float64) * 2 - 1
    turned = others @ rotations(size, 1)[0].T
    found = signs @ turned.T / math.sqrt(size) / factor[:, None]
    bound = ERROR * np.sqrt(np.maximum(0, 1 - factor**2)) / factor / math.sqrt(max(1, size - 1))
    return found, bound


def block_links(a: dict, b: dict, same: bool, band: int, threshold: float) -> np.ndarray:
    """Which pairs of two blocks link, of those that agree in no earlier band."""
    new = np.ones((len(a["v"]), len(b["v"])), bool)
    if same:
        new &= np.tri(len(a["v"]), k=-1, dtype=bool)
    for k in range(band):
        new &= a["codes"][:, k][:, None] != b["codes"][:, k][None, :]
    if not new.any():
        return new
    whole_a, whole_b = scaled(a["vector"]), scaled(b["vector"])
    unit_b = whole_b / np.linalg.norm(whole_b, axis=1, keepdims=True)
    found, bound = estimates(a["code"], a["factor"], unit_b)
    open_ = new & (found + bound[:, None] >= threshold)
    if not open_.any():
        return open_
    i, j = np.nonzero(open_)
    link = np.zeros_like(open_)
    for at in range(0, len(i), 65_536):  # what the bounds leave open is computed exactly
        x, y = whole_a[i[at : at + 65_536]], whole_b[j[at : at + 65_536]]
        dots = np.einsum("ij,ij->i", x, y)
        cosine = dots / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y)))
        link[i[at : at + 65_536], j[at : at + 65_536]] = cosine >= threshold
    return link


def _roots(link: np.ndarray, a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id each row and column reaches inside the block."""
    big = np.iinfo(np.int64).max
    ra, rb = a.copy(), (a if same else b).copy()
    full = link | link.T if same else link
    while True:
        na = np.minimum(ra, np.where(full, rb[None, :], big).min(axis=1, initial=big))
        nb = na if same else np.minimum(rb, np.where(full, na[:, None], big).min(axis=0, initial=big))
        if (na == ra).all() and (nb == rb).all():
            return ra, rb
        ra, rb = na, nb


def usable(label, vector):
    """A label, and a vector that is finite throughout and not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(label.isNotNull() & (F.size(vector) > 0) & ~bad & some, F.lit(False))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, bits: int = BITS) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``: one row per row of ``vec_id, embedding, label``.

    Equal vectors of a label are one class, whose members link with each other and share
    their links. Null labels and vectors that are null, empty, zero or hold a null or
    non-finite number link with nothing, as do vectors of different length; so does a row
    with a null id, whose ``component_id`` is null and which is kept. Rows that repeat an id
    and vector count as so many vectors. An empty table gives no row; other columns play no
    part.
    """
    vector = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", vector.alias("vector"))
    rows = rows.withColumn("ok", usable(F.col("label"), F.col("vector")) & F.col("vec_id").isNotNull())
    good = rows.filter("ok")
    classes = good.groupBy("label", "vector").agg(F.min("vec_id").alias("v"), F.count(F.lit(1)).alias("n"))
    coded = cut_lineage(_encoded(classes, bands, bits))
    found = cut_lineage(_tasks(coded, threshold))
    degree = found.groupBy("v").agg(F.sum("links").alias("links"))
    grouped = components(found.filter("v <> root").select(F.col("v").alias("a"), F.col("root").alias("b")))
    several = coded.filter("n > 1").select("label", "vector", F.col("v").alias("__v"), F.col("n").alias("__n"))
    one = rows.filter("ok").join(several, ["label", "vector"], "left")
    one = one.select("vec_id", F.coalesce("__v", "vec_id").alias("v"), F.coalesce("__n", F.lit(1)).alias("n"))
    linked = one.join(degree, "v", "left").join(grouped, "v", "left")
    out = linked.select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("bigint").alias("n_links"),
        F.coalesce("root", "v").alias("component_id"),
    )
    alone = rows.filter("not ok").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    own = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return out.unionByName(alone).withColumn("kept", own)


def _encoded(classes: DataFrame, bands: int, bits: int) -> DataFrame:
    """Add ``codes``, ``code`` and ``factor`` to ``(label, vector, v, n)`` rows."""
    schema = classes.schema
    names = classes.columns
    at = names.index("vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(at)
            sizes = np.diff(np.asarray(lists.offsets))
            flat, begins = np.asarray(lists.values), np.asarray(lists.offsets)[:-1]
            codes = np.zeros((len(batch), bands), np.int32)
            factor = np.zeros(len(batch))
            signs: list[bytes] = [b""] * len(batch)
            for size in np.unique(sizes):
                here = np.flatnonzero(sizes == size)
                block = flat[begins[here][:, None] + np.arange(size)]
                codes[here], packed, factor[here] = encode(block, bands, bits)
                for k, row in zip(here, packed):
                    signs[k] = row.tobytes()
            lists_of = pa.FixedSizeListArray.from_arrays(pa.array(codes.reshape(-1)), bands).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lists_of, pa.array(signs, pa.binary()), pa.array(factor)],
                names=[*names, "codes", "code", "factor"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return classes.mapInArrow(run, f"{kinds}, codes array<int>, code binary, factor double")


def _tasks(coded: DataFrame, threshold: float) -> DataFrame:
    """``(v, links, root)`` rows, one per vector and block task in which it links."""
    size = F.size("vector").alias("size")
    placed = coded.select("v", "label", size, F.posexplode("codes").alias("band", "key"))
    buckets = placed.groupBy("label", "size", "band", "key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    buckets = buckets.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    met = placed.join(buckets, ["label", "size", "band", "key"])
    own = F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")
    met = met.withColumn("own", own)
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    bucket = F.xxhash64("label", "size", "band", "key").alias("bucket")
    seats = met.select(
        "v",
        bucket,
        "band",
        F.least("own", "other").alias("x"),
        F.greatest("own", "other").alias("y"),
        (F.col("own") > F.col("other")).alias("second"),
    )
    full = seats.join(coded.select("v", "n", "vector", "codes", "code", "factor"), "v")
    dealt = full.repartition(F.col("bucket"), F.col("x"), F.col("y"))
    dealt = dealt.sortWithinPartitions("bucket", "x", "y", "second", "v")
    columns = ["bucket", "x", "y", "second", "band", "v", "n", "vector", "codes", "code", "factor"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        for batch in batches:
            part = pa.Table.from_batches([batch])
            whole = pa.concat_tables([*waiting, part]) if waiting else part
            starts = _starts(whole)
            last = starts[-1]
            yield from _settle(whole.slice(0, last), starts[:-1])
            waiting = [whole.slice(last)]
        if waiting:
            whole = pa.concat_tables(waiting)
            yield from _settle(whole, _starts(whole))

    def _starts(rows: pa.Table) -> list[int]:
        """First rows of the block tasks, which are sorted together."""
        changed = np.zeros(len(rows), bool)
        changed[:1] = True
        for name in ("bucket", "x", "y"):
            values = rows.column(name).to_numpy()
            changed[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(changed).tolist()

    def _settle(rows: pa.Table, starts: list[int]) -> Iterator[pa.RecordBatch]:
        vs, links, roots = [], [], []
        for begin, end in zip(starts, [*starts[1:], len(rows)]):
            if end - begin < 2:
                continue
            group = rows.slice(begin, end - begin).combine_chunks()
            second = group.column("second").to_numpy()
            cut = int(np.searchsorted(second, True))
            same = group.column("x")[0].as_py() == group.column("y")[0].as_py()
            every = _arrays(group)
            a = {k: x[:cut] for k, x in every.items()}
            b = a if same else {k: x[cut:] for k, x in every.items()}
            if not len(a["v"]) or not len(b["v"]):
                continue
            link = block_links(a, b, same, group.column("band")[0].as_py(), threshold)
            if not link.any():
                continue
            ra, rb = _roots(link, a["v"], b["v"], same)
            full = link | link.T if same else link
            sides = [(a, full @ b["n"], ra)] if same else [(a, full @ b["n"], ra), (b, full.T @ a["n"], rb)]
            for side, degree, root in sides:
                some = degree > 0
                vs.append(side["v"][some])
                links.append(degree[some])
                roots.append(root[some])
        if vs:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).astype(np.int64)) for x in (vs, links, roots)], names=["v", "links", "root"]
            )

    def _arrays(group: pa.Table) -> dict[str, np.ndarray]:
        def matrix(name: str) -> np.ndarray:
            column = group.column(name).combine_chunks()
            return np.asarray(column.flatten()).reshape(len(group), -1)

        codes = b"".join(group.column("code").to_pylist())
        return {
            "v": group.column("v").to_numpy(),
            "n": group.column("n").to_numpy(),
            "vector": matrix("vector"),
            "codes": matrix("codes"),
            "code": np.frombuffer(codes, np.uint8).reshape(len(group), -1),
            "factor": group.column("factor").to_numpy(),
        }

    return dealt.select(*columns).mapInArrow(run, "v bigint, links bigint, root bigint")


def op5_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
