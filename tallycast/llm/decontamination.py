"""Benchmark decontamination by a generalised suffix automaton of the test items.

Items are cut into words and all their substrings put into one automaton. The words of a
document are streamed through it; the state after each word gives the longest suffix of what
was read that occurs in some item. Where that length reaches the window, the window that
ends there occurs in an item, and the state knows in which ones; an item shorter than the
window counts where it occurs as a whole. Stretches in which not even two words stand side
by side as in an item have matches of one word at most and are passed over.

The automaton of a bounded number of item words is broadcast. A larger benchmark is cut into
blocks of that size, each built in a task of its own, and the documents go past one block
after the other.
"""

from __future__ import annotations

import pickle
import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm.common import per_worker, slices_of, table
from tallycast.session import cut_lineage

#: Words of a window (fixed by the contract).
WINDOW = 10
#: A document with at least this share of its words hit is no training text at all.
COVERAGE = 0.5
#: Item words in one automaton: some 10 MB broadcast, 100 MB in a Python worker.
BLOCK_WORDS = 200_000
#: Longer items are cut into overlapping pieces of so many words.
PIECE_WORDS = 4096
_TEXT_BYTES = 4_000_000
_PAIR_SLOTS = 1 << 22

#: Lower case for A-Z, a blank for every other ASCII character but digits and letters.
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: Stands between documents; no word holds this byte.
_BETWEEN = b"\x00"


def item_words(text: bytes) -> list[bytes]:
    """The normalised words of a text in UTF-8."""
    return text.translate(_NORMAL).split()


class SuffixAutomaton:
    """All substrings of ``(item, words)`` rows, with the items of every window."""

    def __init__(self, rows: list[tuple[str | None, list[bytes]]], width: int = WINDOW):
        self.width = width
        self.words: dict[bytes, int] = {}
        coded = [(item, [self.words.setdefault(w, len(self.words)) for w in words]) for item, words in rows]
        self._build([words for _, words in coded])
        self._mark(coded)

    def _build(self, texts: list[list[int]]) -> None:
        step: list[dict[int, int]] = [{}]
        link, length = [-1], [0]

        def split(p: int, q: int, word: int) -> int:
            """The state of the longest match of ``p`` and ``word``, apart from longer ones of ``q``."""
            if length[q] == length[p] + 1:
                return q
            clone = len(step)
            step.append(dict(step[q]))
            link.append(link[q])
            length.append(length[p] + 1)
            link[q] = clone
            while p >= 0 and step[p].get(word) == q:
                step[p][word] = clone
                p = link[p]
            return clone

        for words in texts:
            last = 0
            for word in words:
                known = step[last].get(word)
                if known is not None:
                    last = split(last, known, word)
                    continue
                here = len(step)
                step.append({})
                link.append(0)
                length.append(length[last] + 1)
                p = last
                while p >= 0 and word not in step[p]:
                    step[p][word] = here
                    p = link[p]
                if p >= 0:
                    link[here] = split(p, step[p][word], word)
                last = here
        self.link, self.length = link, length
        size = len(self.words)
        self.step = {state * size + word: to for state, out in enumerate(step) for word, to in out.items()}
        self.pairs = np.array(
            sorted(first * size + word for first, state in step[0].items() for word in step[state]), np.int64
        )

    def _mark(self, coded: list[tuple[str | None, list[int]]]) -> None:
        """Note where windows and short items end, and of which items they are."""
        size, width = len(self.words), self.width
        order = sorted(range(len(self.link)), key=self.length.__getitem__)
        #: The state that holds the window at the end of each state's strings.
        self.window = [-1] * len(order)
        for v in order[1:]:
            if self.length[v] >= width:
                up = self.link[v]
                self.window[v] = v if self.length[up] < width else self.window[up]
        found: dict[int, set] = defaultdict(set)
        short: dict[int, set] = defaultdict(set)
        for item, words in coded:
            v = 0
            for read, word in enumerate(words, 1):
                v = self.step[v * size + word]
                if read >= width:
                    found[self.window[v]].add(item)
            if 0 < len(words) < width:
                short[v].add((len(words), item))
        self.items, self.short = dict(found), dict(short)
        #: The nearest state with short items on the way to the root, itself included.
        self.short_up = [-1] * len(order)
        for v in order[1:]:
            self.short_up[v] = v if v in short else self.short_up[self.link[v]]
        self.singles = {words[0]: set() for _, words in coded if len(words) == 1}
        for item, words in coded:
            if len(words) == 1:
                self.singles[words[0]].add(item)
        self.short_firsts = np.array(sorted({words[0] for _, words in coded if 1 < len(words) < width}), np.int64)

    def packed(self) -> bytes:
        """Its tables; they hold no class of this module, which a worker may know under another name."""
        return pickle.dumps(self.__dict__)

    @classmethod
    def unpacked(cls, raw: bytes) -> SuffixAutomaton:
        made = object.__new__(cls)
        made.__dict__.update(pickle.loads(raw))
        return made

    def stream(self, words: list[int]) -> Iterator[tuple[int, int, set]]:
        """``(begin, end, items)`` of every window and short item that ends in ``words``."""
        step, link, length, size, width = self.step, self.link, self.length, len(self.words), self.width
        v = matched = 0
        for at, word in enumerate(words, 1):
            to = step.get(v * size + word)
            while to is None and v:
                v = link[v]
                matched = length[v]
                to = step.get(v * size + word)
            if to is None:
                continue
            v, matched = to, matched + 1
            if matched >= width:
                yield at - width, at, self.items[self.window[v]]
            s = self.short_up[v]
            while s >= 0:
                for n, item in self.short[s]:
                    if n <= matched:
                        yield at - n, at, {item}
                s = self.short_up[link[s]]


class Scanner:
    """Streams documents, many at a time, through one automaton."""

    def __init__(self, automaton: SuffixAutomaton):
        self._a = automaton
        size = self._size = len(automaton.words)
        self._ids = {**automaton.words, _BETWEEN: -2}
        self._maybe = np.zeros(_PAIR_SLOTS, bool)
        self._maybe[automaton.pairs % _PAIR_SLOTS] = True
        self._single = np.zeros(size + 2, bool)  # the last two places are those of -1 and -2
        self._single[list(automaton.singles)] = True
        self._first = np.zeros(size + 2, bool)
        self._first[automaton.short_firsts] = True

    def scan(self, texts: list[bytes]) -> tuple[np.ndarray, dict[int, list[tuple[int, int]]], dict[int, set]]:
        """``(words of each text, hit spans of words by text, items by text)``."""
        raw = (b" " + _BETWEEN + b" ").join([text.translate(_NORMAL) for text in texts]).split()
        ids = np.fromiter(map(self._ids.get, raw, repeat(-1)), np.int64, len(raw))
        between = np.flatnonzero(ids == -2)
        begins = np.concatenate([[0], between + 1])
        counts = np.append(between, len(ids)) - begins
        spans: dict[int, list[tuple[int, int]]] = defaultdict(list)
        items: dict[int, set] = defaultdict(set)
        for begin, end in self._stretches(ids):
            text = int(np.searchsorted(begins, begin, side="right")) - 1
            first = begin - int(begins[text])
            for b, e, found in self._a.stream(ids[begin:end].tolist()):
                spans[text].append((first + b, first + e))
                items[text] |= found
        lone = np.flatnonzero(self._single[ids])
        owner = np.searchsorted(begins, lone, side="right") - 1
        for text, at, word in zip(owner.tolist(), (lone - begins[owner]).tolist(), ids[lone].tolist()):
            spans[text].append((at, at + 1))
            items[text] |= self._a.singles[word]
        return counts, spans, items

    def _stretches(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of words, each two of which stand side by side in an item, that may hold a window."""
        if len(ids) < 2 or not len(self._a.pairs):
            return
        a, b = ids[:-1], ids[1:]
        code = a * self._size + b
        side = (a >= 0) & (b >= 0)
        side &= self._maybe[np.where(side, code, 0) % _PAIR_SLOTS]
        open_ = np.flatnonzero(side)
        place = np.minimum(np.searchsorted(self._a.pairs, code[open_]), len(self._a.pairs) - 1)
        side[open_] = self._a.pairs[place] == code[open_]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], side, [False]]).astype(np.int8)))
        begins, ends = edges[::2], edges[1::2] + 1
        wanted = ends - begins >= self._a.width
        starts = np.flatnonzero(self._first[ids])
        wanted |= np.searchsorted(starts, ends) > np.searchsorted(starts, begins)
        yield from zip(begins[wanted].tolist(), ends[wanted].tolist())


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap or touch, put together."""
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(b, e) for b, e in out]


def places(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words as spans of code points of the text, end exclusive."""
    body = np.frombuffer(raw.translate(_NORMAL), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], body, [False]]).astype(np.int8)))
    points = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [(int(points[edges[2 * b]]), int(points[edges[2 * e - 1]])) for b, e in spans]


def automata(items: DataFrame, width: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(block, automaton)`` rows over ``items(item_id, text)``; none if no item has a word."""
    rows = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forward = max(1, PIECE_WORDS - width + 1)
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = item_words(text or b"")
                cut = [words[i : i + forward + width - 1] for i in range(0, max(1, len(words) - width + 1), forward)]
                cut = [(item, b" ".join(part), len(part)) for part in cut if part]
                columns = list(zip(*cut)) if cut else [[], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.int64())],
                    names=["item", "body", "words"],
                )

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        held = [(item, bytes(body).split()) for item, body in zip(part["item"], part["body"])]
        return pd.DataFrame({"block": [key[0]], "automaton": [SuffixAutomaton(held, width).packed()]})

    cut = cut_lineage(rows.mapInArrow(pieces, "item string, body binary, words bigint"))
    total = cut.agg(F.sum("words")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    placed = cut.withColumn("block", F.pmod(F.xxhash64("item", "body"), F.lit(blocks)).cast("int"))
    return placed.groupBy("block").applyInPandas(build, "block int, automaton binary")


_SCANNED = (
    "doc_id bigint, text string, n_words bigint, spans array<struct<begin:bigint,end:bigint>>, items array<string>"
)


def hit_spans(
    docs: DataFrame, items: DataFrame, width: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``(doc_id, text, n_words, spans, items)``: one row per row of ``docs``.

    ``spans`` are the merged spans of hit words, counted in words, ``items`` the ids of the
    items whose windows occur, sorted as text. ``text`` stays only where something is hit.
    A null or empty text has no words. An item with a null id hits words but has no place in
    ``items``; rows that repeat an item id are one item. Rows that repeat a document id, or
    have none, each give a row. Without documents there is no row, without items no hit.
    Only one text is held whole at a time beyond a few MB; other columns play no part.
    """
    spark = docs.sparkSession
    built = cut_lineage(automata(items, width, block_words))
    numbers = sorted(row["block"] for row in built.select("block").collect())
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast("array<struct<begin:bigint,end:bigint>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    if not numbers:
        rows = _past(rows, spark.sparkContext.broadcast(SuffixAutomaton([], width).packed()), True)
    for number in numbers:
        packed = built.filter(F.col("block") == number).first()["automaton"]
        rows = _past(rows, spark.sparkContext.broadcast(bytes(packed)), number == numbers[-1])
        if number != numbers[-1]:  # one automaton at a time in a worker
            rows = cut_lineage(rows)
    return rows


def _past(rows: DataFrame, packed, last: bool) -> DataFrame:
    """Stream all documents past one automaton and add what it finds."""
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = per_worker("automaton", lambda: {})
        if name not in held:
            held.clear()
            held[name] = Scanner(SuffixAutomaton.unpacked(packed.value))
        scanner = held[name]
        for batch in batches:
            texts = batch.column(1)
            for part in slices_of(range(len(texts)), pc.binary_length(texts).to_pylist(), _TEXT_BYTES):
                size = part.stop - part.start
                counts, spans, items = scanner.scan(texts.slice(part.start, size).cast(pa.binary()).to_pylist())
                before = batch.slice(part.start, size)
                old_spans, old_items = before.column(3), before.column(4)
                every, named = [], []
                for i in range(size):
                    own = [(s["begin"], s["end"]) for s in old_spans[i].as_py()] if len(old_spans[i]) else []
                    all_ = merged(own + spans[i]) if i in spans else own
                    every.append([{"begin": b, "end": e} for b, e in all_])
                    met = set(old_items[i].as_py()) if len(old_items[i]) else set()
                    named.append(sorted((met | items.get(i, set())) - {None}))
                shown = before.column(1)
                if last:
                    shown = pa.array([shown[i].as_py() if s else None for i, s in enumerate(every)], pa.string())
                kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [before.column(0), shown, pa.array(counts, pa.int64()), pa.array(every, kind), pa.array(named, pa.list_(pa.string()))],
                    names=["doc_id", "text", "n_words", "spans", "items"],
                )

    return rows.mapInArrow(run, _SCANNED)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    width: int = WINDOW,
    longest: int = 0,
    coverage: float = COVERAGE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``(doc_id, n_words, n_hit, items, spans, clean, dropped)`` by the rules of :func:`hit_spans`.

    ``spans`` are in code points of the text, end exclusive. ``clean`` is the text without
    the spans of more than ``longest`` words, null where nothing is taken out; ``dropped``
    says that at least the share ``coverage`` of the words is hit, so the whole text goes.
    """
    hit = hit_spans(docs, items, width, block_words)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, texts = batch.column(3), batch.column(1)
            spans, rest = [], []
            for i in range(len(batch)):
                if not len(found[i]):
                    spans.append([])
                    rest.append(None)
                    continue
                words = [(s["begin"], s["end"]) for s in found[i].as_py()]
                text = texts[i].as_py()
                at = places(text.encode(), words)
                spans.append([{"begin": b, "end": e} for b, e in at])
                out = [(b, e) for (b, e), (first, last) in zip(at, words) if last - first > longest]
                edges = [0, *[x for span in out for x in span], len(text)]
                rest.append("".join(text[b:e] for b, e in zip(edges[::2], edges[1::2])) if out else None)
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), found, batch.column(4), pa.array(spans, kind), pa.array(rest, pa.string())],
                names=["doc_id", "n_words", "hit", "items", "spans", "clean"],
            )

    span = "array<struct<begin:bigint,end:bigint>>"
    full = hit.mapInArrow(
        clean, f"doc_id bigint, n_words bigint, hit {span}, items array<string>, spans {span}, clean string"
    )
    n_hit = F.aggregate("hit", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["begin"])
    shown = full.select("doc_id", "n_words", n_hit.alias("n_hit"), "items", "spans", "clean")
    share = F.col("n_hit") >= F.lit(coverage) * F.col("n_words")
    return shown.withColumn("dropped", (F.col("n_hit") > 0) & share)


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("spans").cast("bigint").alias("n_spans"),
        "dropped",
    )
