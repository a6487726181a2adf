"""Secrets in text: fixed patterns, and sliding-window entropy over candidate strings.

Everything is column functions. A candidate is a run of one character class; a window
slides over it while the counts of the characters inside are kept up to date, one
character in and one out per step. With ``S`` the sum of ``c * log2(c)`` over the counts,
the entropy of a window of ``w`` characters is ``log2(w) - S / w``, and a step changes
``S`` by the terms of two counts only. Neighbouring windows above the threshold of the
class become one span. Spans inside a pattern match and candidates on the allow list are
left out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm.common import let, running_sums, table

# Fixed values of the contract.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16
KINDS = ("assign", "access", "hex", "entropy")

#: Stretches that are no secrets: UUIDs, plain numbers, plain words and paths or slugs of
#: words, published examples, counting runs. No pattern repeats a group that may be long:
#: Java's matcher would recurse once for each round.
ALLOWED = (
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"^[0-9]*+$",
    r"^[A-Za-z/_=+-]*+$",
    r"EXAMPLE|example",
    r"0123456789|123456789|abcdefghijklm|ABCDEFGHIJKLM",
)
#: The same for whole candidates, of which more than a stretch may have to be looked at.
ALLOWED_WHOLE = ALLOWED[:3]
#: Small letters and separators up to the last separator: a path ahead of a secret.
_PATH = r"^[a-z/_=+-]*[/_=+-]"
#: Shorter candidates are not scanned. A candidate shorter than the window of its class is
#: one window, and its limit is lower in proportion to the most its length can reach.
SHORTEST = 16


@dataclass(frozen=True)
class CharacterClass:
    """A class of characters with its window and the bits of entropy that count as secret."""

    characters: str
    window: int
    bits: float


HEXADECIMAL = CharacterClass("0123456789abcdefABCDEF", 20, 3.0)
BASE64 = CharacterClass(
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-", 24, 4.0
)


#: What rounding may add to a sum of terms.
_ROUNDING = 1e-9


def _located(text: Column, pattern: str, ok, group: int = 0) -> Column:
    """Spans of the leftmost non-overlapping matches whose ``group`` is ``ok``.

    The pieces between matches and the matches themselves alternate, so their running
    lengths are the positions, in code points.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else None
    gaps = F.split(text, pattern, -1)

    def spans(m: Column) -> Column:
        lengths = F.zip_with(
            F.slice(gaps, F.lit(1), F.size(m)), m, lambda gap, hit: F.length(gap) + F.length(hit)
        )
        hits = F.zip_with(
            running_sums(lengths),
            m,
            lambda end, hit: F.struct((end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("hit")),
        )
        if values is None:
            return F.filter(hits, lambda x: ok(x["hit"]))
        pairs = F.zip_with(hits, values, lambda hit, value: F.struct(hit.alias("x"), value.alias("value")))
        return F.transform(F.filter(pairs, lambda p: ok(p["value"])), lambda p: p["x"])

    return let(matches, spans)


def _only_if(condition: Column, spans: Column) -> Column:
    """Skip the costly form for texts that a cheap look shows to have no match."""
    return F.when(condition, spans).otherwise(
        F.array().cast("array<struct<start:int,end:int,hit:string>>")
    )


def _kind(spans: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.transform(
        spans,
        lambda x: F.struct(
            x["start"].alias("start"), F.lit(number).alias("kind"), x["end"].alias("end")
        ),
    )


def window_spans(candidate: Column, of: CharacterClass) -> Column:
    """``array<struct<start, end>>`` of the high-entropy stretches of one candidate.

    A candidate shorter than the window is one window of its length.
    """
    width = F.least(F.lit(of.window), F.length(candidate))
    limit = F.log2(width) - F.lit(of.bits / math.log2(of.window)) * F.log2(width)
    term = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(of.window + 2)])
    nothing = F.array().cast("array<struct<start:int,end:int>>")
    start = F.struct(
        F.array_repeat(F.lit(0), len(of.characters)).alias("counts"),
        F.lit(0.0).alias("s"),
        F.lit(0).alias("at"),
        nothing.alias("spans"),
    )
    codes = F.transform(
        F.filter(F.split(candidate, ""), lambda c: c != ""),
        lambda c: F.instr(F.lit(of.characters), c) - 1,
    )

    def step(code_array: Column, setting: Column):
        width, most = setting["width"], setting["most"]

        def move(state: Column, code: Column) -> Column:
            gone = F.coalesce(F.get(code_array, state["at"] - width), F.lit(-1))
            counts = state["counts"]
            entering = F.get(counts, code)
            leaving = F.coalesce(F.get(counts, gone), F.lit(0)) + F.when(gone == code, 1).otherwise(0)
            changed = F.get(term, entering + 1) - F.get(term, entering)
            changed = changed + F.when(
                gone >= 0, F.get(term, leaving - 1) - F.get(term, leaving)
            ).otherwise(0.0)
            updated = F.transform(
                counts,
                lambda c, k: c + F.when(k == code, 1).otherwise(0) - F.when(k == gone, 1).otherwise(0),
            )
            s = state["s"] + changed
            begin, end = state["at"] - (width - 1), state["at"] + 1
            high = (begin >= 0) & (s <= most)
            return F.struct(
                updated.alias("counts"),
                s.alias("s"),
                end.alias("at"),
                F.when(high, _extended(state["spans"], begin, end)).otherwise(state["spans"]).alias("spans"),
            )

        return F.aggregate(code_array, start, move)["spans"]

    # the window, and the S at which its entropy is the limit
    settings = F.struct(width.alias("width"), (limit * width + _ROUNDING).alias("most"))
    return let(settings, lambda setting: let(codes, lambda code_array: step(code_array, setting)))


def _extended(spans: Column, begin: Column, end: Column) -> Column:
    """Add a window to merged spans; windows come in order, so only the last may touch it."""
    last = F.get(spans, F.size(spans) - 1)
    touching = F.coalesce(last["end"] >= begin, F.lit(False))
    first = F.when(touching, last["start"]).otherwise(begin)
    kept = F.when(touching, F.size(spans) - 1).otherwise(F.size(spans))
    return F.concat(
        F.slice(spans, F.lit(1), kept), F.array(F.struct(first.alias("start"), end.alias("end")))
    )


def _entropy_spans(text: Column, of: CharacterClass, allowed: Sequence[str], allowed_values: Sequence[str]) -> Column:
    members = "".join("\\" + c if c in "+/=-" else c for c in of.characters)
    run = f"[{members}]{{{SHORTEST},}}"

    def unknown(value: Column, patterns: Sequence[str]) -> Column:
        ok = ~value.isin(*allowed_values) if allowed_values else F.lit(True)
        for pattern in patterns:
            ok = ok & ~value.rlike(pattern)
        return ok

    candidates = _located(text, run, lambda hit: unknown(hit, ALLOWED_WHOLE if allowed else ()))

    def spans(x: Column) -> Column:
        placed = F.transform(
            window_spans(x["hit"], of),
            lambda y: F.struct(
                (x["start"] + y["start"]).alias("start"),
                (x["start"] + y["end"]).alias("end"),
                F.substring(x["hit"], y["start"] + 1, y["end"] - y["start"]).alias("hit"),
            ),
        )
        return F.filter(placed, lambda y: unknown(_without_path(y["hit"]), allowed))

    return _only_if(text.rlike(run), F.flatten(F.transform(candidates, spans)))


def _without_path(stretch: Column) -> Column:
    """A stretch without the path of small letters that it may begin or end with."""
    ahead = F.regexp_replace(stretch, _PATH, "")
    return F.reverse(F.regexp_replace(F.reverse(ahead), _PATH, ""))


def scan_secrets(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    classes: Sequence[CharacterClass] = (HEXADECIMAL, BASE64),
    allowed: Sequence[str] = ALLOWED,
    allowed_values: Sequence[str] = (),
) -> DataFrame:
    """``(<id>, base, spans)``: one row per input row, both arrays of ``(start, kind, end)``.

    ``base`` has the pattern matches, ``spans`` also the entropy stretches that no
    pattern match contains. ``kind`` is the place in :data:`KINDS`, positions are code
    points, ends exclusive, order is by start, then kind. A null or empty text has no
    spans. Rows are independent: repeated rows and ids (null ones too) each give a row, an
    empty table gives none, and other columns of the input play no part. Time grows with
    the length of a text also where one run of characters spans all of it.
    """
    text = F.col("text")
    rows = docs.select(
        F.col(id_column).alias(id_column), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    assign = _only_if(
        text.rlike(r"(?i)passw|secret|token|api_?key"),
        _located(text, ASSIGN, lambda v: F.length(v) >= ASSIGN_LENGTH, group=2),
    )
    access = _only_if(text.contains("AKIA"), _located(text, ACCESS, lambda v: F.length(v) >= ACCESS_LENGTH))
    # a run is located by its long form: shorter runs fail anyway and overlap none
    digits = f"{HEX[:-1]}{{{HEX_LENGTH},}}"
    hexes = _only_if(text.rlike(digits), _located(text, digits, lambda v: F.lit(True)))
    base = F.array_sort(F.concat(_kind(assign, "assign"), _kind(access, "access"), _kind(hexes, "hex")))
    more = F.array_distinct(F.concat(*[_kind(_entropy_spans(text, c, allowed, allowed_values), "entropy") for c in classes]))
    found = rows.select(id_column, base.alias("base"), more.alias("more"))
    outside = F.filter(
        "more",
        lambda e: ~F.exists("base", lambda b: (b["start"] <= e["start"]) & (b["end"] >= e["end"])),
    )
    return found.select(id_column, "base", F.array_sort(F.concat("base", outside)).alias("spans"))


def span_text(spans: Column, kinds: Sequence[str]) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ","
    )


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        number = KINDS.index(kind)
        return F.size(F.filter("spans", lambda x: x["kind"] == number)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS[:3]],
        F.sha2(span_text(F.col("base"), KINDS), 256).alias("base_sha256"),
        span_text(F.col("spans"), KINDS).alias("spans"),
        count("entropy"),
    )
