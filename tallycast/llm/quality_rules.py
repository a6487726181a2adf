"""Quality rules: counts with fixed limits, and distance from the language's usual text.

For every language two reference histograms are learned from the whole table: character
classes, and the common words (those that make up at least ``common_share`` of the
language's words). A document is rejected when the Jensen-Shannon distance of its own
histograms from the reference of its language is above a limit; documents too short for
a histogram to mean anything are judged by the fixed limits only.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm.common import SPACES, document_columns, filter_late, let, table, word_array
from tallycast.session import cut_lineage

# Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Character classes, each removed from what the ones before it left; the rest is one more.
CLASSES = (("lower", r"\p{Ll}+"), ("upper", r"\p{Lu}+"), ("digit", r"\p{N}+"), ("punctuation", r"[\p{P}]+"))
BINS = (*[name for name, _ in CLASSES], "other")

#: Words of a language that are counted one by one hold at least this share of it,
#: so a language has at most 1 / share of them.
COMMON_SHARE = 0.004
#: A language has a reference when it holds this share of all words: at most 1 / share do.
LANGUAGE_SHARE = 0.001
#: Documents with fewer words than this are not compared by common words / characters.
GUARD_WORDS, GUARD_CHARS = 100, 200
#: Largest distances (square root of the divergence in bits) that are kept.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.29, 0.4

_BUCKETS = 4096
_WORDS = "__words"


def with_counts(rows: DataFrame) -> DataFrame:
    """Add words and the counts of the fixed rules to rows with a ``text``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    shaped = rows.withColumn(_WORDS, word_array(F.col("text")))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    return shaped.withColumns(
        {
            "n_words": F.size(_WORDS).cast("bigint"),
            "word_chars": F.length(F.array_join(_WORDS, "")).cast("bigint"),
            "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("bigint"),
            "n_dup_lines": let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("bigint"),
            "n_repeat_words": _repeated(F.col(_WORDS)).cast("bigint"),
        }
    )


def _repeated(words: Column) -> Column:
    """Words inside 3-word windows that the text has twice or more."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )

    def repeats(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        return F.transform(F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"])

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = let(placed, repeats)
        return let(
            F.sort_array(again),
            lambda at: F.aggregate(
                F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1), p + 3) - p)),
                F.lit(0),
                lambda a, b: a + b,
            ),
        )

    return F.when(F.size(words) < 3, 0).otherwise(
        let(
            windows,
            lambda hashes: F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(covered(hashes)),
        )
    )


def with_class_counts(rows: DataFrame) -> DataFrame:
    """Add ``__classes``: code points per class of :data:`BINS`, white space left out."""
    names = [f"__left{k}" for k in range(len(CLASSES) + 1)]
    out = rows.withColumn(names[0], F.coalesce(F.col("text"), F.lit("")))
    for before, after, (_, pattern) in zip(names, names[1:], CLASSES):
        out = out.withColumn(after, F.regexp_replace(before, pattern, ""))
    counts = [F.length(a) - F.length(b) for a, b in zip(names, names[1:])]
    rest = F.length(F.translate(F.col(names[-1]), SPACES, ""))
    return out.withColumn("__classes", F.array(*counts, rest)).drop(*names)


def learn_references(docs: DataFrame, common_share: float = COMMON_SHARE) -> dict[str, dict]:
    """Language -> ``{"classes": shares, "words": {word: share}}``; key "" has all text.

    Character classes are summed per language. Common words are found exactly in two
    passes: words are first counted in 4096 hash buckets per language, then one by one,
    but only those in a bucket that is large enough to hold a common word. Both passes
    combine ahead of the shuffle. What comes to the driver is bounded: ``1 /
    LANGUAGE_SHARE`` languages with ``1 / common_share`` buckets and words each.
    """
    rows = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), "text")
    words = rows.select("lang", F.explode(word_array(F.col("text"))).alias("word"))
    bucket = F.pmod(F.xxhash64("word"), F.lit(_BUCKETS)).cast("int")
    counted = cut_lineage(words.groupBy("lang", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")))
    sizes = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    everything = sizes.agg(F.sum("total")).first()[0] or 0
    totals = {r["lang"]: r["total"] for r in sizes.filter(F.col("total") >= LANGUAGE_SHARE * everything).collect()}
    needed = F.element_at(F.create_map(*[F.lit(x) for pair in totals.items() for x in pair]), F.col("lang")) if totals else F.lit(None)
    frequent = F.col("n") >= common_share * needed
    known = F.col("lang").isin(*totals)
    heavy = [r["bucket"] for r in counted.filter(known & frequent).select("bucket").distinct().collect()]
    exact = words.filter(known & bucket.isin(*heavy)).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    found: dict[str, dict] = {
        lang: {"sizes": [0] * len(BINS), "total": total, "words": {}} for lang, total in totals.items()
    }
    sums = [F.sum(F.get("__classes", F.lit(k))).alias(f"c{k}") for k in range(len(BINS))]
    for row in with_class_counts(rows.filter(known)).groupBy("lang").agg(*sums).collect():
        found[row["lang"]]["sizes"] = [row[f"c{k}"] or 0 for k in range(len(BINS))]
    for row in exact.filter(frequent).collect():
        found[row["lang"]]["words"][row["word"]] = row["n"]
    return _shares(found)


def _shares(found: dict) -> dict[str, dict]:
    """Counts as shares, and all languages together under the key ""."""
    together = {"sizes": [0] * len(BINS), "total": 0, "words": {}}
    for one in found.values():
        together["sizes"] = [a + b for a, b in zip(together["sizes"], one["sizes"])]
        together["total"] += one["total"]
        for word, n in one["words"].items():
            together["words"][word] = together["words"].get(word, 0) + n
    named = {lang: one for lang, one in found.items() if lang}
    out = {}
    for lang, one in [*sorted(named.items()), ("", together)]:
        chars, words = max(1, sum(one["sizes"])), max(1, one["total"])
        out[lang] = {
            "classes": [n / chars for n in one["sizes"]],
            "words": {w: n / words for w, n in sorted(one["words"].items())},
        }
    return out


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares."""

    def half(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    parts = F.zip_with(p, q, lambda x, y: half(x, y) + half(y, x))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda a, b: a + b) / 2))


def judge(docs: DataFrame, references: dict[str, dict]) -> DataFrame:
    """Add the counts, ``class_distance``, ``word_distance``, ``base_failed`` and ``kept``.

    ``docs`` needs ``text`` and ``lang``. A text whose language is null or has no reference
    takes the smallest distance over the references of all languages; common words say
    nothing of a named language without a reference, so its ``word_distance`` is null. The
    mixture of all text (key "") is a reference for classes only where no language has one,
    and for words nowhere. Null and empty texts have no words and fail the
    fixed limits; a distance that the length guards rule out is null and rejects nothing.
    Columns of the input with the names of added ones are replaced.
    """
    shape = "struct<classes:array<double>,words:array<string>,shares:array<double>>"
    as_rows = {
        lang: {"classes": r["classes"], "words": list(r["words"]), "shares": list(r["words"].values())}
        for lang, r in references.items()
    }
    every_word = sorted({w for r in references.values() for w in r["words"]})
    known = F.from_json(F.lit(json.dumps(as_rows)), f"map<string,{shape}>")
    named = [lang for lang in references if lang]
    others = [as_rows[lang] for lang in named] or list(as_rows.values())
    every = F.from_json(F.lit(json.dumps(others)), f"array<{shape}>")
    learned = F.coalesce(F.col("lang").isin(*named), F.lit(False)) if named else F.lit(False)
    fitting = F.when(learned, F.array(F.element_at(known, F.col("lang")))).otherwise(every)
    by_words = (learned | F.col("lang").isNull()) if named else F.lit(False)
    rows = with_class_counts(with_counts(docs)).withColumn("__references", fitting)

    common = F.filter(_WORDS, lambda w: w.isin(*every_word)) if every_word else F.array().cast("array<string>")
    joined = F.concat(F.lit(" "), F.array_join(common, "  "), F.lit(" "))
    rows = rows.withColumn("__common", joined)
    counts = lambda words: F.transform(
        words,
        lambda w: let(
            F.concat(F.lit(" "), w, F.lit(" ")),
            lambda key: (F.length("__common") - F.length(F.replace("__common", key))) / F.length(key),
        ),
    )
    nearest = lambda of: F.array_min(F.transform("__references", of))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    with_rest = lambda a: F.concat(a, F.array(F.greatest(F.lit(0.0), 1 - total(a))))
    of_words = nearest(
        lambda r: let(
            F.transform(counts(r["words"]), lambda n: n / F.greatest(F.lit(1), F.col("n_words"))),
            lambda p: _distance(with_rest(p), with_rest(r["shares"])),
        )
    )
    chars = F.greatest(F.lit(1), F.col("word_chars"))
    of_classes = nearest(lambda r: _distance(F.transform("__classes", lambda n: n / chars), r["classes"]))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    rows = rows.withColumns(
        {
            "class_distance": F.when(F.col("word_chars") >= GUARD_CHARS, of_classes),
            "word_distance": F.when((F.col("n_words") >= GUARD_WORDS) & by_words, of_words),
            "base_failed": failed,
        }
    )
    near = (F.coalesce("class_distance", F.lit(0.0)) <= MAX_CLASS_DISTANCE) & (
        F.coalesce("word_distance", F.lit(0.0)) <= MAX_WORD_DISTANCE
    )
    return rows.withColumn("kept", ~F.col("base_failed") & near).drop(
        _WORDS, "__classes", "__references", "__common"
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge(docs, learn_references(docs)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "class_distance",
        "word_distance",
    )


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass; columns of documents."""
    rows = document_columns(docs)
    judged = judge(rows, learn_references(rows))
    return filter_late(judged, "kept").select(*rows.columns)
