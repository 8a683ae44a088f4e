"""Chat formatting: a state machine over roles checks the order of turns, a declarative template renders them.

Everything is DataFrame functions. ``segments`` gives the text pieces of every turn with a loss flag per
piece and never gathers a conversation; ``formatted`` joins the pieces of a conversation into one text;
``read_back`` recovers the turns from such a text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

_START, _BROKEN = "start", "broken"


@dataclass(frozen=True)
class Template:
    """How turns look, which of them carry loss, and which order of roles is valid.

    ``openings`` marks the turns of known roles; another role is written into ``other``, escaped, and a
    null role is ``nobody``. Inside texts the first character of each control string is replaced by a
    backslash and a digit wherever the string occurs, and each backslash by ``\\0``. Control strings hold no
    backslash and no digit, so escaping makes no new ones, and no control string ends as it begins, so none
    lies half in a text and half in the mark that ends it. ``moves`` has the valid steps of the state machine;
    its state is the last role.
    """

    openings: dict[str, str] = field(default_factory=lambda: {
        "system": "### System: ", "user": "### User: ", "assistant": "### Assistant: ",
    })
    other: tuple[str, str] = ("### Role ", "|says: ")
    nobody: str = "### Nobody: "
    closing: str = " </turn>\n"
    controls: tuple[str, ...] = ("### ", "</turn>", "|says: ")
    learned: tuple[str, ...] = ("assistant",)
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        _START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })
    last: tuple[str, ...] = ("assistant",)


TEMPLATE = Template()


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"


def escape(text: Column, template: Template = TEMPLATE) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\0"))
    for k, control in enumerate(template.controls, 1):
        ahead = f"(?={_literal(control[1:])})"
        out = F.regexp_replace(out, F.lit(_literal(control[0]) + ahead), F.lit(f"\\\\{k}"))
    return out


def unescape(text: Column, template: Template = TEMPLATE) -> Column:
    """After escaping each backslash starts a code, so the codes can be put back one kind after the other."""
    for k, control in enumerate(template.controls, 1):
        text = F.replace(text, F.lit(f"\\{k}"), F.lit(control[0]))
    return F.replace(text, F.lit("\\0"), F.lit("\\"))


def _opening(role: Column, template: Template) -> Column:
    marks = F.create_map(*[F.lit(x) for pair in template.openings.items() for x in pair])
    other = F.concat(F.lit(template.other[0]), escape(role, template), F.lit(template.other[1]))
    return F.when(role.isNull(), F.lit(template.nobody)).otherwise(F.coalesce(marks[role], other))


def valid_step(before: Column, role: Column, template: Template = TEMPLATE) -> Column:
    """Whether the state machine has a move; ``before`` is the last role or null at the start."""
    steps = [F.lit(f"{state}>{role}") for state, following in template.moves.items() for role in following]
    return F.coalesce(F.concat(F.coalesce(before, F.lit(_START)), F.lit(">"), role).isin(*steps), F.lit(False))


def segments(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, turn, role, text (null: empty), valid_step and segments (text, loss): a row for each turn.

    Turns that share a number are ordered by role and text. The state after a turn is its role, so the
    machine needs the row before only; Spark streams through a conversation's sorted rows and spills.
    """
    source = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.when(F.row_number().over(order) == 1, F.lit(None)).otherwise(F.coalesce(F.lag("role").over(order), F.lit(_BROKEN)))
    learned = F.coalesce(F.col("role").isin(*template.learned), F.lit(False))
    return source.withColumn("valid_step", valid_step(before, F.col("role"), template)).select(
        "conv_id", "turn", "role", "text", "valid_step",
        F.array(
            F.struct(_opening(F.col("role"), template).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(F.col("text"), template).alias("text"), learned.alias("loss")),
            F.struct(F.lit(template.closing).alias("text"), F.lit(False).alias("loss")),
        ).alias("segments"),
    )


def formatted(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, formatted, segments, valid: a row for each conversation, null conv_id included as one.

    ``valid`` holds if every step is one of the state machine and the last role may end a conversation. An
    invalid conversation is formatted all the same. Repeated rows are repeated turns; an empty table gives
    no rows; other columns are ignored.
    """
    rows = segments(conversations, template)
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text", "segments", "valid_step")))
    gathered = rows.groupBy("conv_id").agg(turns.alias("turns"))
    pieces = F.flatten(F.col("turns.segments"))
    last = F.element_at(F.col("turns.role"), -1)
    return gathered.select(
        "conv_id", pieces.alias("segments"),
        (F.forall("turns.valid_step", lambda x: x) & F.coalesce(last.isin(*template.last), F.lit(False))).alias("valid"),
    ).withColumn("formatted", F.array_join("segments.text", ""))


def read_back(text: Column, template: Template = TEMPLATE) -> Column:
    """The turns of a formatted text as an array of (role, text)."""
    raw = F.split(text, _literal(template.closing))
    raw = F.slice(raw, 1, F.size(raw) - 1)  # nothing follows the last closing mark

    def turn(piece: Column) -> Column:
        role, body = F.lit(None).cast("string"), F.substr(piece, F.lit(len(template.nobody) + 1))
        inner = F.substr(piece, F.lit(len(template.other[0]) + 1))
        at = F.instr(inner, template.other[1])
        is_other = F.startswith(piece, F.lit(template.other[0]))
        role = F.when(is_other, unescape(F.substr(inner, F.lit(1), at - 1), template)).otherwise(role)
        body = F.when(is_other, F.substr(inner, at + len(template.other[1]))).otherwise(body)
        for name, mark in template.openings.items():
            here = F.startswith(piece, F.lit(mark))
            role = F.when(here, F.lit(name)).otherwise(role)
            body = F.when(here, F.substr(piece, F.lit(len(mark) + 1))).otherwise(body)
        return F.struct(role.alias("role"), unescape(body, template).alias("text"))

    return F.transform(raw, turn)


def digest(rendered: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Figures of formatted conversations, all read back from their text and segments."""
    lines = F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n")))
    under = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], template))
    return rendered.select(
        "conv_id", "formatted", "valid", read_back(F.col("formatted"), template).alias("turns"), F.array_join(under, "").alias("under")
    ).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("under").cast("long").alias("loss_chars"),
        F.sha2(F.col("under").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


# The same from the table with SQL alone. Escaping adds one character per backslash and control string.
_ADDED = """(length(t) - length(replace(t, '\\', '')))
    + (length(t) - length(replace(t, '### ', '## '))) + (length(t) - length(replace(t, '</turn>', '/turn>')))
    + (length(t) - length(replace(t, '|says: ', 'says: ')))"""

ORACLE = f"""
WITH rows AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), steps AS (
    SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, t) AS before,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, t) AS k,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, t DESC) AS back,
        {_ADDED} AS added
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(coalesce(role, '') || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
    CAST(coalesce(sum(length(t)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(9 + length(t) + added + CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15
        ELSE coalesce(16 + length(role), 12) END) AS BIGINT) AS formatted_chars,
    bool_and(CASE WHEN k = 1 THEN coalesce(role IN ('system', 'user'), false)
        ELSE coalesce(before || '>' || role IN ('system>user', 'user>assistant', 'assistant>user'), false) END
        AND (back > 1 OR coalesce(role = 'assistant', false))) AS valid
FROM steps GROUP BY conv_id
"""
