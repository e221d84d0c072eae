"""Chat formatting of typed content parts.

A message is a list of parts (text, image, audio, document). A visitor turns
each part, in order, into template text: a text part is escaped, any other part
becomes a numbered placeholder whose reference and expanded token count are
recorded. Turns are framed by control strings; a backslash escapes what could
read as one, within a part or across two, so every message comes back exactly.
The loss mask covers the assistants' texts.

The result is a row a turn: the conversation is the turns' strings end to end,
and no conversation has to fit into memory.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

START, END = "<|im_start|>", "<|im_end|>"
PART = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
#: Tokens that stand for a part: an image's patches, an audio's frames, a document's pages.
PATCH, FRAMES_A_SECOND, TOKENS_A_PAGE = 28, 25, 256


def escaped(text: Column) -> Column:
    r"""Doubles backslashes, and puts one into every <| and before a leading |.

    So no control string is left, nor made by a text whose end is < and one
    behind it whose start is |.
    """
    inner = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))
    return F.when(inner.startswith("|"), F.concat(F.lit("\\"), inner)).otherwise(inner)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


class Visitor:
    """What each kind of part becomes: ``text`` in the template, and expanded ``tokens`` for attachments."""

    def text(self, p: Column) -> Column:
        return escaped(F.coalesce(p["text"], F.lit("")))

    def image_tokens(self, p: Column) -> Column:
        return F.ceil(F.coalesce(p["width"], F.lit(PATCH)) / PATCH) * F.ceil(F.coalesce(p["height"], F.lit(PATCH)) / PATCH)

    def audio_tokens(self, p: Column) -> Column:
        return F.ceil(F.coalesce(p["seconds"], F.lit(0.0)) * FRAMES_A_SECOND)

    def document_tokens(self, p: Column) -> Column:
        return F.coalesce(p["pages"], F.lit(1)) * TOKENS_A_PAGE

    kinds = ("image", "audio", "document")

    def placeholder(self, p: Column, i: Column) -> Column:
        """<|image:0|>: the kind and the part's number in its message; other kinds, null too, are <|part:0|>."""
        return F.concat(F.lit("<|"), F.when(p["type"].isin(*self.kinds), p["type"]).otherwise("part"), F.lit(":"), i.cast("string"), F.lit("|>"))

    def tokens(self, p: Column) -> Column:
        out = F.lit(0)
        for kind in self.kinds:
            out = F.when(p["type"] == kind, getattr(self, f"{kind}_tokens")(p)).otherwise(out)
        return out.cast("bigint")

    def flat(self, parts: Column) -> Column:
        return F.array_join(F.transform(parts, lambda p, i: F.when(p["type"].eqNullSafe(F.lit("text")), self.text(p)).otherwise(self.placeholder(p, i))), "")

    def attachments(self, parts: Column) -> Column:
        """array<struct<part, type, uri, tokens>>, in order: all parts but texts; those of unknown kinds count no tokens."""
        numbered = F.transform(parts, lambda p, i: F.struct(i.alias("part"), p["type"].alias("type"), p["uri"].alias("uri"), self.tokens(p).alias("tokens")))
        return F.filter(numbered, lambda a: ~a["type"].eqNullSafe(F.lit("text")))


def text_part(text: Column) -> Column:
    """A message that is one text: the array of parts with it. A null text is an empty one."""
    part = F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), *(F.lit(None).cast(k).alias(n) for n, k in (("uri", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))))
    return F.array(part.cast(PART))


def format_turns(turns: DataFrame, visitor: Visitor | None = None) -> DataFrame:
    """(conv_id, turn, role, formatted, low, high, attachments, expanded_tokens), a row a turn.

    ``turns`` has conv_id, turn, role and parts. ``low`` and ``high`` bound the
    loss mask in ``formatted`` (code points); both are null but for assistants.
    A null role is an empty one; null parts are an empty message; a null turn
    comes first. Repeated turns are formatted each, texts of any length whole.
    An empty table gives no rows, and no other column is read.
    """
    visitor = visitor or Visitor()
    parts = F.coalesce("parts", F.lit(None).cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
    role = F.coalesce("role", F.lit(""))
    out = turns.select("conv_id", "turn", role.alias("role"), visitor.flat(parts).alias("body"), visitor.attachments(parts).alias("attachments"))
    head = F.concat(F.lit(START), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    masked = F.col("role") == "assistant"
    return out.select(
        "conv_id", "turn", "role", F.concat(head, "body", F.lit(END + "\n")).alias("formatted"),
        F.when(masked, F.length(head)).alias("low"), F.when(masked, F.length(head) + F.length("body")).alias("high"),
        "attachments", F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def conversation_masks(formatted: DataFrame) -> DataFrame:
    """format_turns() with ``offset``: where the turn's string starts in its conversation's (code points)."""
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "formatted").rowsBetween(Window.unboundedPreceding, -1)
    return formatted.withColumn("offset", F.coalesce(F.sum(F.length("formatted")).over(before), F.lit(0)))


def parse_turn(formatted: str) -> tuple[str, list[str | tuple[str, int]]]:
    """(role, parts) of a formatted turn: texts, and (kind, number) of each attachment. Texts that met are one."""
    if not formatted.startswith(START) or not formatted.endswith(END + "\n"):
        raise ValueError("not a formatted turn")
    head, _, rest = formatted[len(START) :].partition("\n")
    # Escaped texts hold no <|, so each one is a placeholder.
    pieces = re.split(r"<\|(\w+):(\d+)\|>", rest[: -len(END) - 1])
    parts: list[str | tuple[str, int]] = []
    for k in range(0, len(pieces), 3):
        if pieces[k]:
            parts.append(unescape(pieces[k]))
        if k + 2 < len(pieces):
            parts.append((pieces[k + 1], int(pieces[k + 2])))
    return unescape(head), parts


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from formatted turns alone.

    Turns stream past in order, a conversation's digests are kept up to date,
    and memory doesn't grow with its length. An attachment is no text. An
    empty table gives no rows; other columns may have any name.
    """

    def read(batches):
        import pyarrow as pa

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        at, state, done = None, None, []

        def close():
            if state is not None:
                done.append((at, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for batch in batches:
            for conv, text, low, high in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if state is None or conv != at:
                    close()
                    at, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, parts = parse_turn(text)
                body = "".join(p for p in parts if isinstance(p, str))
                state[0] += 1
                state[1].update(f"{role}\n{body}\n".encode())
                state[4] += len(text)
                if low is not None:
                    loss = unescape(text[low:high])
                    state[2] += len(loss)
                    state[3].update(loss.encode())
            if len(done) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names).cast(target)
                done = []
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names).cast(target)

    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    kind = formatted.schema["conv_id"].dataType
    target = pa.schema([("conv_id", to_arrow_type(kind)), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    order = ["conv_id", "turn", "role", "formatted"]
    rows = formatted.select(*order, "low", "high").repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "formatted", "low", "high")
    return rows.mapInArrow(read, f"conv_id {kind.simpleString()}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def op9_chat(spark, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = END + START + "assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    both = turns.unionByName(extra)
    return read_back(format_turns(both.withColumn("parts", text_part(F.col("text")))))
