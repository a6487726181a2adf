"""Language identification by a bit-sliced Bloom filter over character trigrams.

Each slot of the filter is a mask with one bit per language. Adding a trigram of a language
sets that language's bit in the trigram's slots; the AND of the slots of a trigram is the
set of languages that may contain it, all of them in one look-up. A document is given to
the language with the most trigrams contained, each count freed of the false positives
that the fill of the language's slice makes us expect.

Trigrams are three letters, or two with the blank before or after a word; they are exact
numbers (three code points of 21 bits), no hashes.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm.common import per_worker, slices_of, table
from tallycast.session import cut_lineage

UNKNOWN = "und"
#: A trigram is contained in a language that uses it for this share of its trigrams, and
#: at least this share of what its heaviest user does: at most 1 / MIN_RATE per language.
MIN_RATE, MIN_RATIO = 1e-4, 0.3
#: Every language is learned; more than this many are refused, none is left out.
MAX_LANGUAGES = 1000
HASHES = 3
_TEXT_BYTES = 2_000_000
_BLANK = 32


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text number, trigram)`` of every trigram, and which texts have a letter."""
    letter = per_worker("letters", _letters)
    lowered = [" " + text.lower() + " " for text in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), "<u4")
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    is_letter = letter[codes]
    # of several non-letters in a row the first stays, as a blank
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    keep[:1] = True
    begins = np.flatnonzero(np.diff(owner, prepend=-1))
    keep[begins] = True
    packed = np.where(is_letter, codes, _BLANK)[keep].astype(np.uint64)
    owner, is_letter = owner[keep], is_letter[keep]
    has = np.zeros(len(texts), bool)
    has[owner[is_letter]] = True
    if len(packed) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), has
    grams = packed[:-2] << np.uint64(42) | packed[1:-1] << np.uint64(21) | packed[2:]
    good = is_letter[1:-1] & (owner[:-2] == owner[2:])
    return owner[1:-1][good], grams[good], has


def _mixed(values: np.ndarray, seed: int) -> np.ndarray:
    """64-bit mixing (the finalizer of splitmix64)."""
    x = values + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class LanguageFilter:
    """Languages (by falling share of the training text) and their bit-sliced filter."""

    languages: list[str]
    slots: np.ndarray  # [slots, words of 64 languages]

    @classmethod
    def build(cls, languages: list[str], members: list[np.ndarray]) -> LanguageFilter:
        most = max([len(m) for m in members], default=1)
        size = 1 << max(10, int(np.ceil(np.log2(max(1, most) * 8))))
        slots = np.zeros((size, max(1, -(-len(languages) // 64))), np.uint64)
        for k, grams in enumerate(members):
            for place in cls._places(grams, size):
                slots[place, k // 64] |= np.uint64(1 << (k % 64))
        return cls(languages, slots)

    @staticmethod
    def _places(grams: np.ndarray, size: int) -> list[np.ndarray]:
        return [(_mixed(grams, seed) & np.uint64(size - 1)).astype(np.int64) for seed in range(HASHES)]

    def false_positive_rates(self) -> np.ndarray:
        """Per language: chance that a trigram outside it passes all look-ups."""
        fill = [
            np.count_nonzero(self.slots[:, k // 64] & np.uint64(1 << (k % 64))) / len(self.slots)
            for k in range(len(self.languages))
        ]
        return np.array(fill) ** HASHES

    def containing(self, grams: np.ndarray) -> np.ndarray:
        """Mask of all languages that may contain each trigram."""
        places = self._places(grams, len(self.slots))
        masks = self.slots[places[0]]
        for place in places[1:]:
            masks &= self.slots[place]
        return masks

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        owner, grams, has = trigrams(texts)
        total = np.bincount(owner, minlength=len(texts)).astype(float)
        masks = self.containing(grams)
        rates = self.false_positive_rates()
        shares = np.zeros((len(texts), max(1, len(self.languages))))
        for k, rate in enumerate(rates):
            bit = (masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)
            found = np.bincount(owner, weights=bit.astype(float), minlength=len(texts))
            shares[:, k] = (found - total * rate) / np.maximum(1.0, total * (1 - rate))
        if not self.languages:
            has[:] = False
        best = shares.argmax(axis=1)  # of equal ones the language with more training text
        names = [self.languages[b] if h else UNKNOWN for b, h in zip(best, has)]
        return names, np.where(has, np.clip(shares[np.arange(len(texts)), best], 0, 1), 0.0)


def held_out(id_column: str) -> Column:
    """Rows that may not be learned from (the remainder is fixed by the contract)."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 3 == 1, F.lit(False))


def learn(rows: DataFrame) -> LanguageFilter:
    """Filter from all ``lang, text`` rows.

    Tasks count the trigrams of their own rows, so what is shuffled is the different
    trigrams of each task. What reaches the driver is bounded by the rates and the number of
    languages, which is logged; more than ``MAX_LANGUAGES`` raise an error.
    """
    known = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, parts in sums.items():
                grams, n = _merged(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(n)],
                    names=["lang", "gram", "n"],
                )

        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            texts = batch.column(1)
            for run in slices_of(range(len(texts)), pc.binary_length(texts).to_pylist(), _TEXT_BYTES):
                owner, grams, _ = trigrams(texts[run.start : run.stop].to_pylist())
                here = langs[run]
                for lang in set(here):
                    part = np.unique(grams[(here == lang)[owner]], return_counts=True)
                    sums.setdefault(lang, []).append(part)
                    if len(sums[lang]) >= 16:
                        sums[lang] = [_merged(sums[lang])]
            held = sum(len(g) for parts in sums.values() for g, _ in parts)
            if held > 4_000_000:
                yield from out()
                sums = {}
        yield from out()

    counted = known.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counted = cut_lineage(counted)
    sizes = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    count_of = sizes.count()
    if count_of > MAX_LANGUAGES:
        raise ValueError(f"{count_of} languages to learn, at most {MAX_LANGUAGES} are possible")
    logging.getLogger(__name__).info("learning %d languages", count_of)
    kept = sorted(sizes.collect(), key=lambda r: (-r["total"], r["lang"]))
    totals = {r["lang"]: r["total"] for r in kept}
    if not totals:
        return LanguageFilter.build([], [])
    total = F.element_at(F.create_map(*[F.lit(x) for pair in totals.items() for x in pair]), F.col("lang"))
    often = counted.filter(F.col("lang").isin(*totals)).filter(F.col("n") >= MIN_RATE * total)
    found = often.toArrow().to_pydict()
    return _filter_from(found, totals)


def _filter_from(found: dict, totals: dict[str, int]) -> LanguageFilter:
    # the rates of a language with little text are chance; they may not drive out another's
    heaviest: dict[int, float] = {}
    sure = [n / max(totals[lang], 1 / MIN_RATE) for lang, n in zip(found["lang"], found["n"])]
    rates = [n / totals[lang] for lang, n in zip(found["lang"], found["n"])]
    for gram, rate in zip(found["gram"], sure):
        heaviest[gram] = max(rate, heaviest.get(gram, 0.0))
    members: dict[str, list[int]] = {lang: [] for lang in totals}
    for lang, gram, rate in zip(found["lang"], found["gram"], rates):
        if rate >= MIN_RATIO * heaviest[gram]:
            members[lang].append(gram)
    return LanguageFilter.build(list(totals), [np.array(members[lang], np.int64).astype(np.uint64) for lang in totals])


def _merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
    grams = np.concatenate([g for g, _ in parts])
    counts = np.concatenate([n for _, n in parts])
    out, where = np.unique(grams, return_inverse=True)
    return out, np.bincount(where, weights=counts, minlength=len(out)).astype(np.int64)


def predict_languages(docs: DataFrame, known: LanguageFilter) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row from its text alone.

    ``score`` is the share of the text's trigrams that the language contains, false
    positives taken off. A text that is null or has no letter is ``und`` with score 0, and
    so is every text when nothing was learned; of equal languages the one with more
    training text is taken. Repeated rows and ids each give a row, an empty table none.
    """
    rows = docs.select("doc_id", held_out("doc_id").alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    # a few MB: bounded by MAX_LANGUAGES languages and 1 / MIN_RATE trigrams of each
    sent = docs.sparkSession.sparkContext.broadcast((known.languages, known.slots))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageFilter(*sent.value)
        for batch in batches:
            texts = batch.column(2)
            for run in slices_of(range(len(texts)), pc.binary_length(texts).to_pylist(), _TEXT_BYTES):
                names, scores = model.predict(texts[run.start : run.stop].to_pylist())
                part = batch.slice(run.start, len(names))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(scores)],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = learn(docs.filter(~held_out("doc_id")).select("lang", "text"))
    return predict_languages(docs, known)
