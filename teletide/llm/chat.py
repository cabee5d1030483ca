"""Chat formatting: typed content parts to one training text, with a loss mask and attachments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Marks of the template. Inside texts and roles every "<|" is escaped, so the marks stand nowhere else.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
# Tokens that a part of a kind other than text stands for, unless the part says otherwise.
EXPANSION = {"image": 576, "audio": 250, "document": 1024}
PARTS = "array<struct<type:string,text:string,ref:string,tokens:bigint>>"
# Turns joined in a first step, so that a long conversation is not collected turn by turn.
TURNS = 64


def escape(text: Column) -> Column:
    """Make control strings plain: each backslash is doubled, then ``<|`` becomes ``<\\|``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """Undo :func:`escape`; ``<\\`` before another character than a backslash only comes from there."""
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\."))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\."), F.lit("\n")))


def text_part(text: Column) -> Column:
    """The parts of a message that is a text and nothing else."""
    return F.array(F.struct(F.lit("text"), text, F.lit(None).cast("string"), F.lit(None).cast("bigint"))).cast(PARTS)


def _of(parts: Column) -> Column:
    return F.coalesce(parts.cast(PARTS), F.array().cast(PARTS))


def _attached(part: Column) -> Column:
    return F.coalesce(part["type"].isin(list(EXPANSION)), F.lit(False))


def visit(parts: Column) -> Column:
    """The text of a message: its parts in order, attachments as placeholders ``<|image|>`` and so on."""
    return F.array_join(F.transform(_of(parts), lambda part: F.when(
        _attached(part), F.concat(F.lit("<|"), part["type"], F.lit("|>"))).otherwise(
            escape(F.coalesce(part["text"], F.lit(""))))), "")


def attachments(parts: Column) -> Column:
    """The attachments of a message in order: type, ref and the tokens their placeholder expands to."""
    def one(part):
        usual = F.coalesce(*[F.when(part["type"] == kind, F.lit(n)) for kind, n in EXPANSION.items()])
        return F.struct(part["type"].alias("type"), part["ref"].alias("ref"),
                        F.greatest(F.coalesce(part["tokens"], usual.cast("bigint")), F.lit(0)).alias("tokens"))
    return F.transform(F.filter(_of(parts), _attached), one)


def _starts(sizes: Column) -> Column:
    """The sum of the sizes before each one."""
    return F.transform(sizes, lambda _, i: F.aggregate(
        F.slice(sizes, F.lit(1), i), F.lit(0).cast("bigint"), lambda total, n: total + n))


def _shifted(ranges: Column, by: Column) -> Column:
    return F.transform(ranges, lambda r: F.struct((r["start"] + by).alias("start"), (r["end"] + by).alias("end")))


def format_chats(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One training text for each conversation.

    ``messages`` has conv_id, turn, role and ``parts``, an array of typed parts (see PARTS): a ``text`` part
    gives its text, an ``image``, ``audio`` or ``document`` part a placeholder, a reference and the tokens it
    expands to; a part of another type counts as text. Returns

    * ``formatted``: for each turn OPEN, role, newline, text and CLOSE, with text and role escaped;
    * ``loss``: the ranges [start, end) of ``formatted``, in code points, that hold texts of ``loss_role``;
    * ``attachments``: type, ref and tokens of every attachment in order;
    * ``n_turns`` and ``expanded_tokens``, the sum over the attachments.

    Turns are ordered by turn (null first), then role, then text: repeated turns are kept and ties have one
    order. A null role or text and null or empty parts read as empty; rows without a conv_id form one
    conversation with a null id. An empty table gives no rows. Other columns are not read.

    A conversation is put together in two steps, TURNS turn numbers at a time first, so a huge one is
    collected as few long pieces.
    """
    role = F.coalesce("role", F.lit(""))
    turns = messages.select(
        "conv_id", F.floor(F.col("turn") / TURNS).alias("block"), F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"), _escape_role(role).alias("named"), visit(F.col("parts")).alias("body"),
        attachments(F.col("parts")).alias("attached"))
    lead = F.length("named") + len(OPEN) + 1
    turns = turns.select("conv_id", "block", F.struct(
        "turn", "role", "body", "attached",
        F.concat(F.lit(OPEN), "named", F.lit("\n"), "body", F.lit(CLOSE)).alias("text"),
        F.when(F.col("role") == loss_role, F.struct(
            lead.cast("bigint").alias("start"), (lead + F.length("body")).cast("bigint").alias("end"))).alias("loss"),
    ).alias("t"))
    sizes = F.transform("ts.text", lambda x: F.length(x).cast("bigint"))
    losses = F.flatten(F.zip_with(F.col("ts.loss"), _starts(F.col("sizes")), lambda r, by: F.when(
        r.isNotNull(), _shifted(F.array(r), by)).otherwise(_shifted(F.slice(F.array(r), 1, 0), by))))
    blocks = (turns.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list("t")).alias("ts"))
              .withColumn("sizes", sizes)
              .select("conv_id", F.struct(
                  "block", F.array_join("ts.text", "").alias("text"), losses.alias("loss"),
                  F.flatten("ts.attached").alias("attached"), F.size("ts").cast("bigint").alias("n")).alias("b")))
    total = F.aggregate("bs.n", F.lit(0).cast("bigint"), lambda x, n: x + n)
    return (blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list("b")).alias("bs"))
            .withColumn("sizes", F.transform("bs.text", lambda x: F.length(x).cast("bigint")))
            .select("conv_id", F.array_join("bs.text", "").alias("formatted"),
                    F.flatten(F.zip_with("bs.loss", _starts(F.col("sizes")), _shifted)).alias("loss"),
                    F.flatten("bs.attached").alias("attachments"), total.alias("n_turns"))
            .withColumn("expanded_tokens", F.aggregate(
                "attachments.tokens", F.lit(0).cast("bigint"), lambda x, n: x + n)))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text), unescaped."""
    pieces = F.split(formatted, OPEN.replace("|", "\\|"))

    def one(piece):
        named = F.substring_index(piece, "\n", 1)
        body = F.substr(piece, F.length(named) + 2, F.length(piece) - F.length(named) - 1 - len(CLOSE))
        return F.struct(_unescape_role(named).alias("role"), unescape(body).alias("text"))
    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces) - 1), one)


def loss_text(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda r: unescape(
        F.substr(formatted, (r["start"] + 1).cast("int"), (r["end"] - r["start"]).cast("int")))), "")
