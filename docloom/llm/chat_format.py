r"""Chat formatting with a grammar round trip.

A conversation is rendered as one string of turns, ``### role: text</turn>``
and a newline each. The grammar reserves three strings inside texts: the
backslash, ``</turn>`` and ``### ``. A deterministic parser reads the rendered
string back. Texts are first rendered as they are; where the recovered turns
differ from the source, the texts that do not survive the parser are escaped,
and if that isn't enough every text is, until source and recovered turns are
identical. Escapes are \s (backslash), \t (</turn>), \h (### ) and, in roles
only, \c (colon); each is one backslash and a letter, so undoing them is exact.

Only DataFrame and SQL functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.arrays import let, sums_before

HEAD, SEP, END = "### ", ": ", "</turn>"
TURNS = "array<struct<role: string, text: string>>"


def lit(s: str) -> Column:
    return F.lit(s)


def escape(text: Column) -> Column:
    for raw, code in (("\\", "\\s"), (END, "\\t"), (HEAD, "\\h")):
        text = F.replace(text, lit(raw), lit(code))
    return text


def unescape(text: Column) -> Column:
    for raw, code in ((HEAD, "\\h"), (END, "\\t"), ("\\", "\\s")):
        text = F.replace(text, lit(code), lit(raw))
    return text


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), lit(":"), lit("\\c"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, lit("\\c"), lit(":")))


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(lit(HEAD), escape_role(role), lit(SEP), text, lit(END + "\n"))


def pieces(formatted: Column) -> Column:
    """The rendered turns without their end marks. A string ends with an end mark, so the last piece, which is empty, goes."""
    parts = F.split(formatted, END + "\n", -1)
    return F.slice(parts, 1, F.size(parts) - 1)


def head_chars(piece: Column) -> Column:
    """Code points of a piece before its text."""
    return F.locate(SEP, piece) + len(SEP) - 1


def parse_piece(piece: Column) -> Column:
    """role and text of a piece, or nulls if it breaks the grammar."""
    at = F.locate(SEP, piece)
    role, text = piece.substr(lit(len(HEAD) + 1), at - (len(HEAD) + 1)), piece.substr(at + len(SEP), F.length(piece))
    sound = F.startswith(piece, lit(HEAD)) & (at > 0) & ~F.contains(text, lit(HEAD)) & ~F.contains(text, lit(END))
    return F.struct(F.when(sound, unescape_role(role)).alias("role"), F.when(sound, unescape(text)).alias("text"))


def parse(formatted: Column) -> Column:
    return F.transform(pieces(formatted), parse_piece)


def render(turns: Column, change) -> Column:
    """turns: array of (role, text); change: what is done to a text."""
    return F.concat_ws("", F.transform(turns, lambda t: render_turn(t["role"], change(t["text"]))))


def survives(text: Column) -> Column:
    return (unescape(text) == text) & ~F.contains(text, lit(HEAD)) & ~F.contains(text, lit(END))


def format_chats(turns: DataFrame, learn_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, turns (the source), formatted, escaped, parsed, loss_spans.

    escaped tells how far the round trip had to go: 0 none, 1 the conflicting
    texts, 2 every text. parsed is what the parser recovers from formatted; a
    conversation whose turns can't be recovered raises an error. loss_spans are
    (start, end) code points in formatted, end exclusive, of the texts to learn
    from (those of learn_role). Null texts and roles count as empty. Rows are
    ordered by turn (null first), then role and text, repeated rows included. A row
    with a null conv_id belongs to no other and is a conversation of its own.
    Other columns are ignored; an empty table gives an empty result. A conversation is one string and so one row:
    what has to fit a task is one conversation, not the table; time grows with its
    length, not with the square of its turns.
    """
    row = F.struct(F.col("turn"), F.coalesce("role", lit("")).alias("role"), F.coalesce("text", lit("")).alias("text"))
    own = turns.select("conv_id", row.alias("row"), F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).alias("alone"))
    chats = own.groupBy("conv_id", "alone").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    chats = chats.select("conv_id", F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("turns"))
    steps = [
        render(F.col("turns"), lambda t: t),
        render(F.col("turns"), lambda t: F.when(survives(t), t).otherwise(escape(t))),
        render(F.col("turns"), escape),
    ]
    chats = chats.withColumn("formatted", steps[0]).withColumn("escaped", F.lit(0))
    for n in (1, 2):
        chats = chats.withColumn("_same", parse(F.col("formatted")).eqNullSafe(F.col("turns")))
        chats = chats.withColumns({"formatted": F.when(F.col("_same"), F.col("formatted")).otherwise(steps[n]), "escaped": F.when(F.col("_same"), F.col("escaped")).otherwise(F.lit(n))})
    chats = chats.withColumn("parsed", parse(F.col("formatted")))
    failed = F.raise_error(F.concat(lit("no round trip for conversation "), F.coalesce(F.col("conv_id").cast("string"), lit("null"))))
    chats = chats.withColumn("parsed", F.when(F.col("parsed").eqNullSafe(F.col("turns")), F.col("parsed")).otherwise(failed.cast(TURNS)))
    return chats.withColumn("loss_spans", loss_spans(learn_role)).drop("_same")


def loss_spans(learn_role: str) -> Column:
    """Where the texts to learn from stand: turns follow one another, so a turn begins where the lengths before it end."""
    def spans(parts: Column) -> Column:
        begins = sums_before(F.transform(parts, lambda p: (F.length(p) + len(END) + 1).cast("bigint")))
        turns = F.filter(F.arrays_zip(parts.alias("piece"), F.col("parsed").alias("turn"), begins.alias("at")), lambda z: z["turn"]["role"] == lit(learn_role))
        return F.transform(turns, lambda z: F.struct((z["at"] + head_chars(z["piece"])).alias("start"), (z["at"] + F.length(z["piece"])).alias("end")))

    return let(pieces(F.col("formatted")), spans)


def loss_text(learn_role: str = "assistant") -> Column:
    """What the loss mask covers, unescaped: the texts of the turns to learn from, cut out of formatted."""
    turns = F.filter(F.arrays_zip(pieces(F.col("formatted")).alias("piece"), F.col("parsed").alias("turn")), lambda z: z["turn"]["role"] == lit(learn_role))
    return F.concat_ws("", F.transform(turns, lambda z: unescape(z["piece"].substr(head_chars(z["piece"]) + 1, F.length(z["piece"])))))
