"""Alignment of the tokens of two tokenizers, by anchors at white space.

A single blank ahead of something that is no white space is an anchor: a token of each
tokenizer begins there, whatever stands around it, so the anchors cut a text into units that
are encoded apart. Units come again and again, so each different one is encoded and aligned
once and kept: its groups (bytes between two ends that both sides share), its text form, and
the pairs of ids that it links. That both sides spell a unit, and that a token of each ends
where it ends, is looked at when it is learned; a text for which this does not hold is
encoded whole.

How many documents hold a pair is counted over the corpus. Documents keep their pairs in
compact lists, which meet the counts in the tasks that read them while the table of pairs is
of bounded size, and by a join beyond.
"""

from __future__ import annotations

import gc
import hashlib
import os
import pickle
import re
import uuid
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm.common import per_worker, slices_of, table
from tallycast.session import work_path

BLANK = "▁"
#: Pairs of ids whose counts are broadcast: 16 bytes each. More are joined.
BROADCAST_PAIRS = 2_000_000
#: Units kept aligned per Python worker.
_CACHED_WINDOWS = 300_000
#: Units of more characters do not come again.
_LONG_UNIT = 128
#: New units that are encoded as one line.
_LINE_UNITS = 20
_TEXT_BYTES = 1_000_000
#: Characters of a text that the quicker library is given.
_QUICK = 200_000
#: Units kept encoded by the second tokenizer, and where one begins: at a single blank before
#: something that is no white space.
_CACHED_UNITS = 300_000
_UNIT = re.compile(r"(?<! )(?= \S)")
#: A blank that begins no unit.
_NO_UNIT = re.compile(r" (?:\s|\Z)")
#: Entries of pairs that may lie free beside those kept.
_SPARE_PAIRS = 4_000_000
#: Links of a group that are counted one by one.
_SMALL_GROUP = 256
#: Pairs are coded as one number, the id of the first side times this and that of the second.
SIDE = 1 << 32


class ByteTokenizer:
    """A byte-level tokenizer file: ids of texts and the bytes of each id.

    The entries of the file, in the order in which they were merged, are ranks for a quicker
    library. It cuts texts by the same pattern, and both agree on every code point; what it
    cannot take, very long runs of white space, goes to the file's own library.
    """

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        # printable characters stand for themselves, the other bytes for those from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in plain}
        byte_of |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(plain))}
        self.bytes: list[bytes] = []
        for i in range(self._tokenizer.get_vocab_size()):
            entry = self._tokenizer.id_to_token(i) or ""
            spelt = [byte_of.get(c) for c in entry]
            self.bytes.append(entry.encode() if None in spelt else bytes(spelt))
        special = self._tokenizer.get_added_tokens_decoder()
        ranks = {spelt: i for i, spelt in enumerate(self.bytes) if i not in special}
        self._quick = tiktoken.Encoding("quick", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of a blank and each text."""
        quick = self._quick.encode_to_numpy
        return [
            np.array(self._whole(" " + text), "<u4") if len(text) > _QUICK else quick(" " + text, disallowed_special=())
            for text in texts
        ]

    def _whole(self, text: str) -> list[int]:
        return self._tokenizer.encode(text, add_special_tokens=False).ids


class PieceTokenizer:
    """A sentence-piece model, which puts a blank before each text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes: list[bytes] = []
        for i in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[1:-1], 16)]) if self._model.is_byte(i) else piece.replace(BLANK, " ").encode())

        self._units: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts, each different unit between single blanks encoded once.

        No piece goes on after a letter with a blank, so texts fall apart there; one that
        holds the mark for a blank itself is encoded whole.
        """
        if len(self._units) > _CACHED_UNITS:
            self._units = {}
        look, new, split = self._units.get, set(), []
        for text in texts:
            units = _units(text) if BLANK not in text else []
            found = list(map(look, units))
            open_ = [n for n, ids in enumerate(found) if ids is None] if None in found else []
            new.update([units[n] for n in open_])
            split.append((units, found, open_))
        learned = list(new)
        for unit, ids in zip(learned, self._model.encode(learned, num_threads=1)):
            self._units[unit] = array("I", ids).tobytes()
        out = []
        for text, (units, found, open_) in zip(texts, split):
            for n in open_:
                found[n] = self._units[units[n]]
            out.append(np.frombuffer(b"".join(found), "<u4") if units else np.array(self._model.encode(text), "<u4"))
        return out


    def lines(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts that do not come again."""
        return [np.array(ids, "<u4") for ids in self._model.encode(texts, num_threads=1)]


def _units(text: str) -> list[str]:
    """The units of a text, without the blanks they begin with."""
    if text[:1].isspace() or _NO_UNIT.search(text):
        return [unit[1:] for unit in _UNIT.split(" " + text)]
    return text.split(" ")


def align(
    ids: list[np.ndarray], upto: list[np.ndarray], sizes: list[np.ndarray], shown: list[np.ndarray]
) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Group the ids of many units by shared ends: ``(forms, groups, links, pairs, times)``.

    The units are laid end to end: ``ids`` are those of either side, ``upto`` the number of
    them up to the end of each unit, ``sizes`` the bytes of each id, ``shown`` its digits. Both sides spell
    the same bytes in each unit. ``links`` and ``pairs`` are two numbers per unit: links, and
    entries of the two last arrays, which hold the linked pairs in the order of the units and
    how often each entry stands for a link.
    """
    ends = [np.cumsum(size[i]) for size, i in zip(sizes, ids)]
    held = [np.zeros(int(ends[0][-1]) + 1, bool) for _ in ends]
    for mark, end in zip(held, ends):
        mark[end] = True
    to = [np.flatnonzero(other[end]) + 1 for end, other in zip(ends, held[::-1])]  # ids up to each shared end
    begin = [np.concatenate([[0], t[:-1]]) for t in to]
    count = [t - b for t, b in zip(to, begin)]
    group_ends = np.searchsorted(to[0], upto[0]) + 1
    groups = np.diff(group_ends, prepend=0)
    owner = np.repeat(np.arange(len(groups)), groups)
    here = count[0] * count[1]
    links = np.diff(np.concatenate([[0], np.cumsum(here)])[group_ends], prepend=0)
    pairs, times, entries = _linked(ids, begin, count, here, owner, len(groups))
    return _forms(ids, count, group_ends, shown), groups, links, entries, pairs, times


def _linked(ids, begin, count, here, owner, units: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked pairs in the order of units, how often each entry counts, and each unit's entries."""
    large = np.flatnonzero(here > _SMALL_GROUP)
    few = np.where(here > _SMALL_GROUP, 0, here)
    group = np.repeat(np.arange(len(few)), few)
    within = np.arange(len(group)) - np.repeat(np.cumsum(few) - few, few)
    left, right = np.divmod(within, count[1][group])
    pairs = ids[0][begin[0][group] + left].astype(np.int64) * SIDE + ids[1][begin[1][group] + right]
    of, times = owner[group], np.ones(len(group), np.int64)
    if len(large):  # repeated ids are counted, not paired one by one
        found = [(of, pairs, times)]
        for g in large.tolist():
            (u, n), (v, m) = (
                np.unique(i[b[g] : b[g] + c[g]].astype(np.int64), return_counts=True) for i, b, c in zip(ids, begin, count)
            )
            codes = (u[:, None] * SIDE + v[None, :]).reshape(-1)
            found.append((np.full(len(codes), owner[g]), codes, (n[:, None] * m[None, :]).reshape(-1)))
        of, pairs, times = (np.concatenate(c) for c in zip(*found))
        order = np.argsort(of, kind="stable")
        of, pairs, times = of[order], pairs[order], times[order]
    return pairs, times, np.bincount(of, minlength=units)


def digits(ids: int) -> np.ndarray:
    """The decimal digits of all ids below ``ids``, right-aligned after zero bytes, and a free last byte."""
    width = len(str(ids))
    rows = np.zeros((ids, width + 1), np.uint8)
    left = np.arange(ids)
    for place in range(width - 1, -1, -1):
        rows[:, place] = np.where((left > 0) | (place == width - 1), 48 + left % 10, 0)
        left = left // 10
    return rows


def _forms(ids, count, group_ends, shown) -> list[bytes]:
    """``a1,a2|b1;a3|b2`` of each unit, cut from one text of all of them."""
    width = max(rows.shape[1] for rows in shown)
    ends = np.cumsum(np.stack(count, axis=1).reshape(-1))  # after each group's ids of either side
    laid = np.zeros((len(ids[0]) + len(ids[1]), width), np.uint8)
    second = np.repeat(np.arange(len(ends)) % 2 == 1, np.diff(ends, prepend=0))
    for side, rows, own in zip((~second, second), shown, ids):
        laid[side, width - rows.shape[1] :] = rows[own]
    laid[:, -1] = 44
    laid[ends[::2] - 1, -1] = 124
    laid[ends[1::2] - 1, -1] = 59
    used = laid != 0
    text = laid[used].tobytes()
    upto = np.cumsum(np.count_nonzero(used, axis=1))[ends[2 * group_ends - 1] - 1].tolist()
    return [text[b : e - 1] for b, e in zip([0, *upto], upto)]


def summed(pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different pairs in order, with the sum of their times."""
    if not len(pairs):
        return pairs, times
    once = int(times.max()) == 1
    if once:
        pairs = np.sort(pairs)
    else:
        order = np.argsort(pairs, kind="stable")
        pairs, times = pairs[order], times[order]
    starts = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    return pairs[starts], np.diff(starts, append=len(pairs)) if once else np.add.reduceat(times, starts)


_NONE = np.zeros(0, np.int64)
#: What a text without tokens has.
_NO_TOKENS = (0, 0, 0, 0, "", _NONE, _NONE)
#: The number of all units that are not well spelt; texts that hold one are encoded whole.
_APART = 0


class Aligner:
    """Encodes texts with both tokenizers and aligns them unit by unit.

    Each unit has a number, under which its alignment is kept: its form in a list, numbers
    in columns, pairs in one long array.
    """

    def __init__(self, first, second):
        self._first, self._second = first, second
        self._sizes = [np.array([len(x) for x in side.bytes], np.int64) for side in (first, second)]
        self._shown = [digits(len(side.bytes)) for side in (first, second)]
        self._spelt = (first.bytes, second.bytes)
        self._forget()

    def documents(self, texts: list[str]) -> Iterator[tuple]:
        """``(n_a, n_b, n_groups, n_links, digest, pairs, times)`` of each text."""
        if len(self._windows) > _CACHED_WINDOWS:
            self._forget()
        split = [[unit for unit in _units(text) if unit] if BLANK not in text else [] for text in texts]
        units = list(chain.from_iterable(split))
        found = list(map(self._windows.get, units))
        if None in found:
            open_ = [n for n, number in enumerate(found) if number is None]
            new = list(dict.fromkeys([units[n] for n in open_]))
            self._learn(new)
            for n in open_:
                found[n] = self._windows[units[n]]
        ends = np.cumsum(list(map(len, split)), dtype=np.int64)
        out = self._summaries(np.array(found, np.int64), ends)
        for n, (text, summary) in enumerate(zip(texts, out)):
            if text and summary is None:
                out[n] = self._of_whole(text)
        self._drop_long()
        return iter([summary or _NO_TOKENS for summary in out])

    def _forget(self) -> None:
        """No units are known."""
        self._windows: dict[str, int] = {}
        self._forms = [b""]
        self._long: list[str] = []
        self._kept = 1  # units that are not long
        self._numbers = np.zeros((6, 1024), np.int64)  # ids of either side, groups, links, pairs, where the pairs begin
        self._pairs, self._times = np.zeros(1024, np.int64), np.zeros(1024, np.int64)

    def _drop_long(self) -> None:
        """Forget the last units, which are long."""
        for unit in self._long:
            del self._windows[unit]
        del self._forms[self._kept :]
        self._long = []
        held = int(self._numbers[4:, self._kept - 1].sum())
        if len(self._pairs) > _SPARE_PAIRS + 4 * held:  # a very long unit has stretched them
            self._pairs, self._times = self._pairs[: 2 * held + 1024].copy(), self._times[: 2 * held + 1024].copy()

    def _learn(self, new: list[str]) -> None:
        """Encode and align new units, the long ones last.

        Units that need no care at their ends are encoded by the line. Where a line is not
        spelt unit by unit, each unit is tried alone, and again in a line of those that are
        well spelt alone, as the library must encode a unit alike alone and among others.
        """
        short = [unit for unit in new if len(unit) <= _LONG_UNIT]
        self._long = [unit for unit in new if len(unit) > _LONG_UNIT]
        easy = [unit for unit in short if not (unit[0].isspace() or unit[-1] == " ")]
        alone = [unit for unit in short if unit[0].isspace() or unit[-1] == " "] + self._long
        lines = [easy[n : n + _LINE_UNITS] for n in range(0, len(easy), _LINE_UNITS)] + [[unit] for unit in alone]
        coded = self._encoded(lines)
        if not self._well_spelt(lines, *coded):
            lines, coded = self._sorted_out(lines, coded)
        known = list(chain.from_iterable(lines))
        begin = len(self._forms)
        self._windows.update(dict.fromkeys(new, _APART))
        self._windows.update(zip(known, range(begin, begin + len(known))))
        self._kept = begin + sum(len(unit) <= _LONG_UNIT for unit in known)
        if known:
            self._keep(known, [np.concatenate(side) for side in coded])

    def _encoded(self, lines: list[list[str]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        texts = [" ".join(line) for line in lines]
        return self._first.encode(texts), self._second.lines(texts)

    def _well_spelt(self, lines: list[list[str]], *coded: list[np.ndarray]) -> bool:
        """Whether both sides spell these lines, with an end after each line and each unit."""
        raw = b"".join([b" " + " ".join(line).encode("utf-8", "surrogatepass") for line in lines])
        unit_ends = self._unit_ends(chain.from_iterable(lines))
        line_ends = unit_ends[np.cumsum(list(map(len, lines))) - 1]
        for side, spelt, sizes in zip(coded, self._spelt, self._sizes):
            ids = np.concatenate(side)
            if b"".join([spelt[i] for i in ids.tolist()]) != raw:
                return False
            ends = np.concatenate([[0], np.cumsum(sizes[ids])])
            held = np.zeros(len(raw) + 1, bool)
            held[ends] = True
            if not held[unit_ends].all() or (ends[np.cumsum(list(map(len, side)))] != line_ends).any():
                return False
        return True

    @staticmethod
    def _unit_ends(units) -> np.ndarray:
        return np.cumsum([len(unit.encode("utf-8", "surrogatepass")) + 1 for unit in units])

    def _sorted_out(self, lines: list[list[str]], coded) -> tuple[list[list[str]], list[list[np.ndarray]]]:
        """Lines that are well spelt, with their ids; what is well spelt nowhere is left out."""
        kept = []
        for line, a, b in zip(lines, *coded):
            if self._well_spelt([line], [a], [b]):
                kept.append((line, a, b))
            elif len(line) > 1:
                good = [unit for unit in line if self._well_spelt([[unit]], *self._encoded([[unit]]))]
                again = self._encoded([good]) if 0 < len(good) < len(line) else None
                if again and self._well_spelt([good], *again):
                    kept.append((good, again[0][0], again[1][0]))
        lines, *coded = map(list, zip(*kept)) if kept else ([], [], [])
        return lines, coded

    def _keep(self, units: list[str], ids: list[np.ndarray]) -> None:
        unit_ends = self._unit_ends(units)
        upto = [np.searchsorted(np.cumsum(sizes[side]), unit_ends) + 1 for sizes, side in zip(self._sizes, ids)]
        forms, groups, links, entries, pairs, times = align(ids, upto, self._sizes, self._shown)
        begin, end = len(self._forms), len(self._forms) + len(units)
        if end > self._numbers.shape[1]:
            self._numbers = np.pad(self._numbers, ((0, 0), (0, 2 * end - self._numbers.shape[1])))
        at = int(self._numbers[4:, begin - 1].sum())
        self._numbers[:, begin:end] = *(np.diff(u, prepend=0) for u in upto), groups, links, entries, at + np.cumsum(entries) - entries
        self._forms += forms
        to = at + len(pairs)
        if to > len(self._pairs):
            self._pairs, self._times = (np.pad(x, (0, 2 * to - len(x))) for x in (self._pairs, self._times))
        self._pairs[at:to], self._times[at:to] = pairs, times

    def _summaries(self, numbers: np.ndarray, ends: np.ndarray) -> list[tuple | None]:
        """What the texts have whose units end at ``ends``; none where a unit is apart or there is no unit."""
        upto = lambda values: np.concatenate([np.zeros((*values.shape[:-1], 1), np.int64), np.cumsum(values, axis=-1)], axis=-1)
        begins = np.concatenate([[0], ends[:-1]])
        apart = upto((numbers == _APART).astype(np.int64))
        good = ((apart[ends] == apart[begins]) & (ends > begins)).tolist()
        sums = upto(self._numbers[:5, numbers])
        totals = (sums[:, ends] - sums[:, begins]).T.tolist()
        size, start = self._numbers[4:, numbers]
        places = np.repeat(start - sums[4, :-1], size) + np.arange(int(sums[4, -1]))
        pairs, times = self._pairs[places], self._times[places]
        edges = sums[4, ends].tolist()
        forms = list(map(self._forms.__getitem__, numbers.tolist()))
        out = []
        for ok, total, b, e, p, q in zip(good, totals, begins.tolist(), ends.tolist(), [0, *edges], edges):
            if not ok:
                out.append(None)
                continue
            digest = hashlib.sha256(b";".join(forms[b:e])).hexdigest()
            out.append((*total[:4], digest, *summed(pairs[p:q], times[p:q])))
        return out

    def _of_whole(self, text: str) -> tuple | None:
        """The same of a text that is one unit, none if a side spells other bytes."""
        raw = b" " + text.encode("utf-8", "surrogatepass")
        ids = [side.encode([text])[0] for side in (self._first, self._second)]
        if any(b"".join([spelt[i] for i in own.tolist()]) != raw for spelt, own in zip(self._spelt, ids)):
            return None
        upto = [np.array([len(own)]) for own in ids]
        forms, groups, links, _, pairs, times = align(ids, upto, self._sizes, self._shown)
        return len(ids[0]), len(ids[1]), int(groups[0]), int(links[0]), hashlib.sha256(forms[0]).hexdigest(), *summed(pairs, times)


def aligned(docs: DataFrame, make: Callable[[], Aligner], name: str) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times)``: one row per row of ``docs``.

    ``pairs`` are the codes of the linked pairs of ids, ``times`` how often each is linked.
    A null or empty text, and one that the tokens of a side do not spell, has no tokens.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = per_worker(f"aligner:{name}", make)
        gc.disable()  # neither what is kept nor what is made on the way has cycles
        try:
            for batch in batches:
                names, texts = batch.column(0), batch.column(1)
                for part in slices_of(range(len(texts)), pc.binary_length(texts).to_pylist(), _TEXT_BYTES):
                    plain = texts[part.start : part.stop].to_pylist()
                    columns = list(zip(*aligner.documents(plain)))
                    numbers = [pa.array(c, pa.int64()) for c in columns[:4]]
                    ends = pa.array(np.cumsum([0, *map(len, columns[5])]).astype(np.int32))
                    lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(c))) for c in columns[5:]]
                    yield pa.RecordBatch.from_arrays(
                        [names.slice(part.start, len(plain)), *numbers, pa.array(columns[4], pa.string()), *lists], names=_NAMES
                    )
        finally:
            gc.enable()

    return rows.mapInArrow(run, _ALIGNED)


_ALIGNED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "pairs array<bigint>, times array<bigint>"
)
_NAMES = [part.split()[0] for part in _ALIGNED.split(", ")]


def pair_counts(rows: DataFrame) -> DataFrame:
    """``(pair, n, best)``: documents that hold each pair, and whether its first id has none in more."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    first = F.shiftright("pair", 32).alias("first")
    highest = counts.groupBy(first).agg(F.max("n").alias("most"))
    return counts.withColumn("first", first).join(highest, "first").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def scored(rows: DataFrame, counts: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Add ``n_best`` and ``count_sum``, sums over all links of a document, and drop the lists.

    ``rows`` and ``counts`` are written tables.
    """
    if counts.count() > broadcast_pairs:
        return _scored_by_join(rows, counts)
    held = counts.orderBy("pair").toArrow().combine_chunks()
    table_ = tuple(np.ascontiguousarray(held.column(c).to_numpy()) for c in ("pair", "n", "best"))
    packed = rows.sparkSession.sparkContext.broadcast(pickle.dumps(table_))
    name = uuid.uuid4().hex
    kept = _NAMES[:6]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = per_worker("pair-counts", lambda: {})
        if name not in every:
            every.clear()
            every[name] = pickle.loads(packed.value)
        pairs, n, best = every[name]
        for batch in batches:
            lists, times = batch.column(6), np.asarray(batch.column(7).flatten())
            place = np.searchsorted(pairs, np.asarray(lists.flatten()))
            sizes = np.asarray(lists.value_lengths())
            owner = np.repeat(np.arange(len(sizes)), sizes)
            sums = [np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)]
            if len(place):
                np.add.at(sums[0], owner, times * best[place])
                np.add.at(sums[1], owner, times * n[place])
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], *map(pa.array, sums)], names=[*kept, "n_best", "count_sum"])

    return rows.mapInArrow(run, _ALIGNED.split(", pairs")[0] + ", n_best bigint, count_sum bigint")


def _scored_by_join(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """The same by shuffles; a row is named by its place in the written table."""
    named = rows.withColumn("row", F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index")))
    links = named.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("row", "link.pairs", "link.times")
    met = links.join(counts, links["pairs"] == counts["pair"])
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return named.join(sums, "row", "left").select(*_NAMES[:6], *zero)


def align_tokens(
    docs: DataFrame, make: Callable[[], Aligner], name: str = "default", broadcast_pairs: int = BROADCAST_PAIRS
) -> tuple[DataFrame, DataFrame]:
    """``(documents, pairs)`` of ``docs(doc_id, text)``.

    Documents: ``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum``, one
    row per row, repeated ids and null ones included. Pairs: ``pair, n, best``, where ``pair``
    is the first id times :data:`SIDE` plus the second. A null or empty text, and one whose
    tokens spell other bytes, has zeros and an empty digest. An empty table gives no rows;
    other columns play no part. Texts are handled whole, some at a time.
    """
    spark = docs.sparkSession
    places = [work_path(spark, purpose) for purpose in ("aligned", "pair-counts")]
    aligned(docs, make, name).write.parquet(places[0])
    rows = spark.read.schema(_ALIGNED).parquet(places[0])
    pair_counts(rows).write.parquet(places[1])
    counts = spark.read.schema("pair bigint, n bigint, best boolean").parquet(places[1])
    return scored(rows, counts, broadcast_pairs), counts


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    first, second = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    make = lambda: Aligner(ByteTokenizer(first, public_tokenizers.PATTERN), PieceTokenizer(second))
    return align_tokens(table(spark, sf_dir, "documents"), make, f"{first}:{second}")[0]
