"""Conversations as training text: a role machine, a declarative template, loss flags.

Everything is column functions. A template gives each role an opening and a closing
string and says whether its text counts for the loss. Opening and closing strings that
occur in a text or role name are escaped, so the formatted text can be taken apart again
without loss.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm.common import running_sums, table

#: Set inside a control string or doubled: what an escaped text has in place of it.
ESCAPE = "\\"


@dataclass(frozen=True)
class Turn:
    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """How roles are written and in which order they may come.

    ``roles``: the known roles. Any other role is written as ``other``, whose opening has
    ``{role}``. ``order``: state -> role -> next state, beginning with ``start``; a role
    without a next state breaks the order. Opening and closing strings must differ from
    each other and hold no backslash.
    """

    roles: dict[str, Turn]
    other: Turn
    order: dict[str, dict[str, str]] = field(default_factory=dict)

    def controls(self) -> list[str]:
        """Strings that a text may not hold unescaped, longest first."""
        marks = {m.strip() for t in self.roles.values() for m in (t.opening, t.closing)}
        marks |= {self.other.opening.split("{role}")[0], self.other.closing}
        if any(ESCAPE in m or len(m) < 2 for m in marks):
            raise ValueError("control strings need two characters and no backslash")
        return sorted(marks, key=lambda m: (-len(m), m))


#: Turn order: an optional system turn, then user and assistant in turn.
ALTERNATING = {
    "start": {"system": "ready", "user": "asked"},
    "ready": {"user": "asked"},
    "asked": {"assistant": "answered"},
    "answered": {"user": "asked"},
}

INSTRUCTION = Template(
    roles={
        "system": Turn("<<SYS>>\n", "\n<</SYS>>\n"),
        "user": Turn("[INST] ", " [/INST]"),
        "assistant": Turn("<s> ", " </s>", loss=True),
    },
    other=Turn("<role:{role}>", "</role>"),
    order=ALTERNATING,
)


def escape(text: Column, template: Template) -> Column:
    """``text`` without any control string of the template; :func:`unescape` restores it."""
    out = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for mark in template.controls():
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + ESCAPE + mark[1:]))
    return out


def unescape(text: Column, template: Template) -> Column:
    # backslashes of the text are doubled, so a single one inside a mark is ours
    out = text
    for mark in reversed(template.controls()):
        out = F.replace(out, F.lit(mark[0] + ESCAPE + mark[1:]), F.lit(mark))
    return F.replace(out, F.lit(ESCAPE * 2), F.lit(ESCAPE))


def _by_role(template: Template, role: Column, of) -> Column:
    out = None
    for name, turn in template.roles.items():
        out = F.when(role == name, of(turn)) if out is None else out.when(role == name, of(turn))
    return out.otherwise(of(template.other)) if out is not None else of(template.other)


def _opening(template: Template, role: Column) -> Column:
    before, _, after = template.other.opening.partition("{role}")
    # ">" ends the name, so it is written in percent form
    plain = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit(">"), F.lit("%3E"))
    name = escape(plain, template)
    other = F.concat(F.lit(before), name, F.lit(after))
    return _by_role(template, role, lambda t: other if t is template.other else F.lit(t.opening))


def _first_break(template: Template, roles: Column) -> Column:
    """Place of the first role that the order does not allow; null if there is none."""
    steps = {f"{state}\n{role}": after for state, row in template.order.items() for role, after in row.items()}
    move = F.create_map(*[F.lit(x) for pair in steps.items() for x in pair])
    walked = F.aggregate(
        roles,
        F.struct(F.lit("start").alias("state"), F.lit(0).alias("at"), F.lit(-1).alias("broken")),
        lambda s, role: F.struct(
            F.coalesce(F.element_at(move, F.concat(s["state"], F.lit("\n"), role)), F.lit("broken")).alias("state"),
            (s["at"] + 1).alias("at"),
            F.when(
                (s["broken"] < 0) & F.element_at(move, F.concat(s["state"], F.lit("\n"), role)).isNull(), s["at"]
            ).otherwise(s["broken"]).alias("broken"),
        ),
    )["broken"]
    return F.when(walked >= 0, walked)


def format_conversations(turns: DataFrame, template: Template = INSTRUCTION) -> DataFrame:
    """``(conv_id, formatted, segments, first_break)``: one row per conversation.

    ``turns`` has ``conv_id, turn, role, text``. Turns are put in order by ``turn``, ties by
    role and text; null texts and roles count as empty, rows with a null ``conv_id`` form
    one conversation, an empty table gives no row and other columns play no part.
    ``segments``: ``array<struct<start, end, loss>>`` over ``formatted`` in code points,
    ends exclusive; markers and texts are segments of their own. ``first_break`` is the
    0-based place of the first turn that the role order does not allow, null if all are.
    A conversation becomes one row, as the text of one training example has to.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            role.alias("role"),
            text.alias("text"),
            _opening(template, role).alias("opening"),
            escape(text, template).alias("body"),
            _by_role(template, role, lambda t: F.lit(t.closing)).alias("closing"),
            _by_role(template, role, lambda t: F.lit(t.loss)).alias("loss"),
        ).alias("t"),
    )
    gathered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    pieces = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                F.struct(t["opening"].alias("piece"), F.lit(False).alias("loss")),
                F.struct(t["body"].alias("piece"), t["loss"].alias("loss")),
                F.struct(t["closing"].alias("piece"), F.lit(False).alias("loss")),
            ),
        )
    )
    shaped = gathered.select(
        "conv_id",
        pieces.alias("pieces"),
        _first_break(template, F.transform("turns", lambda t: t["role"])).alias("first_break"),
    )
    ends = running_sums(F.transform("pieces", lambda p: F.length(p["piece"])))
    segments = F.zip_with(
        ends,
        "pieces",
        lambda end, p: F.struct(
            (end - F.length(p["piece"])).alias("start"), end.alias("end"), p["loss"].alias("loss")
        ),
    )
    return shaped.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
        segments.alias("segments"),
        "first_break",
    )


def read_turns(formatted: Column, template: Template = INSTRUCTION) -> Column:
    """``array<struct<role, text>>`` taken from a formatted text alone."""
    before, _, after = template.other.opening.partition("{role}")
    openings = [re.escape(t.opening) for t in template.roles.values()]
    openings.append(re.escape(before) + "[^>]*" + re.escape(after))
    closings = [re.escape(t.closing) for t in [*template.roles.values(), template.other]]
    pattern = f"(?s)({'|'.join(openings)})(.*?)({'|'.join(closings)})"
    group = lambda k: F.regexp_extract_all(formatted, F.lit(pattern), F.lit(k))

    def role(opening: Column) -> Column:
        inner = F.substring(opening, F.lit(len(before) + 1), F.length(opening) - len(before) - len(after))
        plain = unescape(inner, template)
        out = F.replace(F.replace(plain, F.lit("%3E"), F.lit(">")), F.lit("%25"), F.lit("%"))
        for name, turn in template.roles.items():
            out = F.when(opening == turn.opening, name).otherwise(out)
        return out

    return F.zip_with(
        group(1), group(2), lambda o, b: F.struct(role(o).alias("role"), unescape(b, template).alias("text"))
    )


def loss_text(formatted: Column, segments: Column, template: Template = INSTRUCTION) -> Column:
    """What the segments with a loss flag cover, unescaped, one after the other."""
    counted = F.filter(segments, lambda s: s["loss"])
    parts = F.transform(
        counted, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]), template)
    )
    return F.array_join(parts, "")


#: Conversation whose texts hold the control strings of a template (fixed by the contract).
TRIAL_ID, TRIAL_TEXT = -7, "</s>[INST] ok [/INST]"


def with_trial(turns: DataFrame) -> DataFrame:
    """Add the trial conversation: a user, then an assistant row with the same text."""
    spark = turns.sparkSession
    trial = spark.range(2).select(
        F.lit(TRIAL_ID).cast(turns.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(turns.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRIAL_TEXT).alias("text"),
    )
    return turns.select("conv_id", "turn", "role", "text").unionByName(trial)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = format_conversations(with_trial(table(spark, sf_dir, "conversations")))
    read = out.select(
        "conv_id",
        read_turns(F.col("formatted")).alias("turns"),
        loss_text(F.col("formatted"), F.col("segments")).alias("loss"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "first_break",
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "first_break",
    )
