"""Personal data: fixed patterns, and contexts learned from what the patterns find.

The pattern matches are seeds. The words around a seed make lexical patterns; an unseen
token that looks like an identifier and stands in such a pattern may be one. Spark scores
the graph of patterns and instances in turns: a pattern is as good as the instances it is
seen with, an unseen instance as good as its patterns together. Occurrences in patterns
that end up above the threshold are added to the spans.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm.common import document_columns, table
from tallycast.session import cut_lineage

# Fixed values of the contract.
KINDS = ("email", "ip", "card", "phone", "context")
# Those of a kind that begin inside a run of digits or letters would be tried at each of its
# characters; these forms have the same matches and are tried once per run.
EMAIL_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_PLACE = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = range(13, 20), range(9, 16)

#: A token that may be an identifier: this many digits, or an at sign.
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_EDGES = "\"'`.,;:!?()[]{}<>|*#$%&=-"
_MIN_DIGITS, _MIN_LENGTH = 4, 6
_ANY = re.compile(r"[0-9@]")
#: A pattern counts with this many different seeds, and is trusted above this confidence.
MIN_SEEDS, CONFIDENCE = 3, 0.6
ROUNDS = 3
#: Longer runs of characters are no words of a context.
_LONGEST_WORD = 64

_SPAN = "struct<kind:int,start:int,end:int>"
_HIT = "struct<start:int,end:int,value:string,seed:boolean,around:array<string>>"


def _luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d)
        if place % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the fixed patterns, by kind, then start."""
    out = []
    out += [(0, start, end) for start, end in _emails(text)]
    for m in IP.finditer(text):
        if all(int(part[-4:]) <= 255 and len(part.lstrip("0")) <= 3 for part in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if len(digits) in CARD_DIGITS and _luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if len(_digits(m[0])) in PHONE_DIGITS:
                out.append((3, m.start(), m.end()))
    return out


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from each at sign to both sides."""
    done, at = 0, text.find("@")
    while at >= 0:
        place = EMAIL_PLACE.match(text, at)
        start = at
        while place and start > done and text[start - 1] in EMAIL_NAME:
            start -= 1
        if place and start < at:
            yield start, place.end()
        done = place.end() if place and start < at else at + 1
        at = text.find("@", done)


class _Words:
    """The words of a text, for the contexts of places in it."""

    def __init__(self, text: str):
        self._text = text
        self._begins, self._ends = [], []
        for m in re.finditer(r"\S+", text):
            self._begins.append(m.start())
            self._ends.append(m.end())

    def around(self, start: int, end: int) -> list[str]:
        """Lexical patterns of a place: the two words before it, and the words next to it.

        Every word of a pattern has a letter: marks alone say nothing about what follows. A
        word that goes on beyond :data:`_LONGEST_WORD` characters makes no pattern, so none
        is ever cut.
        """
        last = bisect_left(self._begins, start) - 1  # the last word that begins before the place
        first = bisect_left(self._ends, end + 1)  # the first one that ends after it
        before = [(b, min(e, start)) for b, e in zip(self._begins[max(0, last - 1) : last + 1], self._ends[max(0, last - 1) : last + 1])]
        after = [(max(b, end), e) for b, e in zip(self._begins[first : first + 1], self._ends[first : first + 1])]
        whole = [e - b <= _LONGEST_WORD for b, e in [*before, *after]]
        shown = [self._text[b:e].lower() if ok else "" for (b, e), ok in zip([*before, *after], whole)]
        lettered = [any(c.isalpha() for c in w) for w in shown]
        shape = lambda words: " ".join(re.sub("[0-9]+", "0", w) for w in words)
        out = []
        if len(before) == 2 and all(lettered[:2]):
            out.append(f"{shape(shown[:2])} _")
        if before and after and all(lettered[-2:]):
            out.append(f"{shape(shown[-2:-1])} _ {shape(shown[-1:])}")
        return out


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple]]:
    """Base spans of a text, and its seeds and unseen candidates with their patterns."""
    if not _ANY.search(text):
        return [], []
    base, words = base_spans(text), _Words(text)
    hits = [(s, e, text[s:e].lower(), True, words.around(s, e)) for _, s, e in base]
    taken = sorted((s, e) for _, s, e in base)
    at = 0
    for m in _TOKEN.finditer(text):
        word = m[0]
        if not _ANY.search(word):
            continue
        core = word.strip(_EDGES)
        if len(core) < _MIN_LENGTH or ("@" not in core and len(_digits(core)) < _MIN_DIGITS):
            continue
        start = m.start() + len(word) - len(word.lstrip(_EDGES))
        end = start + len(core)
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if any(s < end and e > start for s, e in taken[at : at + 4]):
            continue
        hits.append((start, end, core.lower(), False, words.around(start, end)))
    return base, hits


def _scanned(rows: DataFrame, keys: str) -> DataFrame:
    """Scan ``(<keys>, text)`` rows; adds ``base`` and ``hits``, drops the text."""
    names = [f.name for f in rows.schema.fields if f.name != "text"]
    at = rows.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
        hit = pa.list_(
            pa.struct(
                [
                    ("start", pa.int32()),
                    ("end", pa.int32()),
                    ("value", pa.string()),
                    ("seed", pa.bool_()),
                    ("around", pa.list_(pa.string())),
                ]
            )
        )
        fields = [f.name for f in hit.value_type]
        for batch in batches:
            found = [scan(text.as_py()) for text in batch.column(at)]
            bases = [[dict(zip(("kind", "start", "end"), s)) for s in base] for base, _ in found]
            hits = [[dict(zip(fields, h)) for h in some] for _, some in found]
            kept = [batch.column(k) for k in range(batch.num_columns) if k != at]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(bases, span), pa.array(hits, hit)], names=[*names, "base", "hits"]
            )

    return rows.mapInArrow(run, f"{keys}, base array<{_SPAN}>, hits array<{_HIT}>")


def trusted_patterns(hits: DataFrame) -> DataFrame:
    """``(pattern, confidence)`` above :data:`CONFIDENCE` from ``(value, seed, pattern)`` rows.

    Repeats are dropped first, so copies of a text add nothing and an edge is light. Sums
    combine ahead of the shuffle; joins are on one key, which AQE splits when it is hot.
    """
    edges = cut_lineage(hits.groupBy("pattern", "value").agg(F.max("seed").alias("seed")))
    scores = None
    for _ in range(ROUNDS):
        if scores is not None:
            # what stands in a trusted pattern is a seed of others from now on
            trusted = scores.filter(F.col("confidence") >= CONFIDENCE).select("pattern")
            accepted = edges.join(trusted, "pattern", "left_semi").select("value").distinct().withColumn("__new", F.lit(True))
            edges = edges.join(accepted, "value", "left")
            edges = cut_lineage(edges.select("pattern", "value", (F.col("seed") | F.coalesce("__new", F.lit(False))).alias("seed")))
        scores = _scores(edges)
    return scores.filter(F.col("confidence") >= CONFIDENCE)


def _scores(edges: DataFrame) -> DataFrame:
    """``(pattern, confidence)`` of the patterns with enough seeds.

    An unseen instance is as good as its patterns together, and adds that to each of them.
    """
    seeds = edges.groupBy("pattern").agg(
        F.sum(F.col("seed").cast("int")).alias("seeds"), F.count(F.lit(1)).alias("values")
    )
    seeds = seeds.filter(F.col("seeds") >= MIN_SEEDS)
    own = F.col("seeds") / F.col("values")
    # a pattern without enough seeds scores nothing, whatever its other instances are worth
    met = cut_lineage(edges.join(seeds, "pattern"))
    miss = F.log1p(-F.least(own, F.lit(0.999)))
    worth = met.filter("not seed").groupBy("value").agg((1 - F.exp(F.sum(miss))).alias("worth"))
    found = met.join(worth, "value", "left").groupBy("pattern").agg(
        F.max("values").alias("values"), F.max("seeds").alias("seeds"), F.sum(F.when(~F.col("seed"), F.col("worth"))).alias("gain")
    )
    total = F.col("seeds") + F.coalesce("gain", F.lit(0.0)) * own
    return cut_lineage(found.select("pattern", (total / F.col("values")).alias("confidence")))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``(doc_id, digest, base, spans)``: one row per input row.

    ``base`` are the matches of the fixed patterns, ``spans`` these and the learned ones
    (kind ``context``), both by kind, then start, in code points, ends exclusive. ``digest``
    is the MD5 of the text. Null and empty texts have no spans. Repeated rows and ids (null
    ones too) each give a row with the same spans, an empty table gives none, and other
    columns play no part. Texts are scanned whole; what is kept of them is their hits.
    """
    text = F.coalesce("text", F.lit("")).alias("text")
    rows = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("digest"), text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    scanned = cut_lineage(
        _scanned(rows, f"doc_id {kind}, digest string").withColumn("__row", F.monotonically_increasing_id())
    )
    hits = scanned.select("__row", F.explode("hits").alias("hit")).select("__row", "hit.*")
    placed = hits.withColumn("pattern", F.explode("around"))
    trusted = trusted_patterns(placed.select("value", "seed", "pattern")).select("pattern")
    added = placed.filter(~F.col("seed")).join(trusted, "pattern", "left_semi")
    number = F.lit(KINDS.index("context")).alias("kind")
    added = added.groupBy("__row").agg(F.collect_set(F.struct(number, "start", "end")).alias("more"))
    none = F.array().cast(f"array<{_SPAN}>")
    return scanned.join(added, "__row", "left").select(
        "doc_id", "digest", "base", F.array_sort(F.concat("base", F.coalesce("more", none))).alias("spans")
    )


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ","
    )


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in angle brackets.

    Spans that overlap are replaced together, by the kind that begins first.
    """
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    by_start = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"], x["kind"], x["end"])))
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    state = F.aggregate(
        by_start,
        begin,
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(x["start"] < s["at"], s["out"])
            .otherwise(F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.get(names, x["kind"])))
            .alias("out"),
        ),
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, state).otherwise(text)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        number = KINDS.index(kind)
        return F.size(F.filter("spans", lambda x: x["kind"] == number)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS[:4]],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
        count("context"),
    )


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced and ``n_chars`` brought in line."""
    rows = document_columns(docs)
    found = find_personal_data(rows).filter(F.size("spans") > 0).dropDuplicates(["doc_id", "digest"])
    found = found.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "spans")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.md5("text") == F.col("__digest"))
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(redacted(F.col("text"), F.col("spans")))
    joined = rows.join(found, same, "left").withColumn("text", text)
    length = F.when(F.col("spans").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return joined.withColumn("n_chars", length.cast(rows.schema["n_chars"].dataType)).select(*rows.columns)
