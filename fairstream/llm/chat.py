"""Chat formatting with typed content parts, in DataFrame functions only.

A message holds an array of parts (text, image, audio, document). A visitor
per kind turns a part into its piece of the output: escaped text, or an
ordered placeholder ``<kind:turn:part>`` plus an attachment record with the
reference and the number of tokens that the placeholder expands to.

One turn is ``<s>[INST]role[/INST]body</s>``. Control strings inside texts and
roles are escaped (``&lt;``, ``&lsb;``, ``&amp;``) and ``read_back`` undoes it.

Defined results: null text, role or parts count as empty; rows of a
conversation are ordered by turn (null first), then role, then parts, so ties
and repeated rows give one fixed order; a null conv_id is a conversation of its
own; a part without a kind is text, and one of an unknown kind fails the job; very
long texts are formatted whole; extra columns are ignored (of any name); an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"
PART_TYPE = ("array<struct<kind:string,text:string,ref:string,width:int,height:int,"
             "seconds:double,pages:int>>")


@dataclass(frozen=True)
class Expansion:
    """How many tokens a placeholder stands for once a model expands it."""

    image_patch: int = 28
    audio_tokens_per_second: int = 25
    document_tokens_per_page: int = 512


def escape(text: Column) -> Column:
    """Break every control string and placeholder inside ``text``; reversible."""
    out = F.regexp_replace(text, "&(amp;|lt;|lsb;)", "&amp;$1")
    out = F.regexp_replace(out, "<(/?s>|image:|audio:|document:)", "&lt;$1")
    return F.regexp_replace(out, r"\[(/?INST\])", "&lsb;$1")


def unescape(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&lsb;"), F.lit("["))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def _cells(length: Column, size: int) -> Column:
    return F.ceil(F.coalesce(length, F.lit(0)) / F.lit(size))


def visitors(e: Expansion) -> dict[str, Callable[[Column], Column]]:
    """Expanded tokens by kind of attachment."""
    return {
        "image": lambda p: _cells(p["width"], e.image_patch) * _cells(p["height"], e.image_patch),
        "audio": lambda p: F.ceil(F.coalesce(p["seconds"], F.lit(0.0)) * e.audio_tokens_per_second),
        "document": lambda p: F.coalesce(p["pages"], F.lit(0)).cast("long") * e.document_tokens_per_page,
    }


def text_parts(text: Column) -> Column:
    """A plain text as the array of parts that ``format_chats`` takes."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).alias("ref"), F.lit(None).alias("width"), F.lit(None).alias("height"),
                            F.lit(None).alias("seconds"), F.lit(None).alias("pages"))).cast(PART_TYPE)


def _visit(kinds: dict, at: Column) -> Callable[[Column, Column], Column]:
    """The visitor of one part: its placeholder and attachment, or its raw text."""
    def visit(p: Column, j: Column) -> Column:
        tokens = F.coalesce(*[F.when(p["kind"] == k, f(p).cast("long")) for k, f in kinds.items()])
        mark = F.concat(F.lit("<"), p["kind"], F.lit(":"), at, F.lit(":"), j.cast("string"), F.lit(">"))
        known, plain = p["kind"].isin(*kinds), F.coalesce(p["kind"], F.lit("text")) == "text"
        text = F.when(plain, F.coalesce(p["text"], F.lit(""))).when(known, "").otherwise(
            F.raise_error(F.concat(F.lit("unknown kind of part: "), p["kind"])).cast("string"))
        return F.struct(
            text.alias("text"), F.when(known, mark).alias("mark"),
            F.when(known, F.struct(mark.alias("placeholder"), p["kind"].alias("kind"), p["ref"].alias("ref"),
                                   tokens.alias("tokens"))).alias("attachment"))
    return visit


def _body(seen: Column) -> Column:
    """The visited parts as one text. Neighbouring texts are escaped as the run that
    they make up, so no control string can hide in the cut between two parts."""
    start = F.struct(F.lit("").alias("done"), F.lit("").alias("run"))
    def add(acc: Column, p: Column) -> Column:
        ends = p["mark"].isNotNull()
        return F.struct(
            F.when(ends, F.concat(acc["done"], escape(acc["run"]), p["mark"])).otherwise(acc["done"]).alias("done"),
            F.when(ends, "").otherwise(F.concat(acc["run"], p["text"])).alias("run"))
    return F.aggregate(seen, start, add, lambda acc: F.concat(acc["done"], escape(acc["run"])))


def format_chats(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",),
                 expansion: Expansion = Expansion()) -> DataFrame:
    """One row per conversation from rows (conv_id, turn, role, parts).

    ``formatted`` is the whole conversation; ``turns`` has one entry per turn,
    in order: turn_start, body_start, body_end (code points in ``formatted``,
    end exclusive), loss (whether the body is under the loss mask) and its
    attachments; ``expanded_tokens`` is the sum over the attachments.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    numbered = messages.select(
        "conv_id", "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("parts"), F.array().cast(PART_TYPE)).alias("parts"),
    ).withColumn("_i", F.row_number().over(order) - 1)
    seen = numbered.withColumn(
        "_seen", F.transform("parts", _visit(visitors(expansion), F.col("_i").cast("string"))))
    bodies = seen.select(
        "conv_id", "turn", "role", "parts", "_i", _body(F.col("_seen")).alias("_body"),
        F.array_compact(F.col("_seen.attachment")).alias("_files"))
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE))
    turns = bodies.select(
        "*", F.char_length(head).alias("_head"), F.char_length("_body").alias("_chars"),
        F.concat(head, F.col("_body"), F.lit(CLOSE)).alias("_turn"))
    placed = turns.withColumn(
        "_end", F.sum(F.char_length("_turn").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    start = F.col("_end") - F.char_length("_turn")
    body = start + F.col("_head")
    entry = F.struct(start.alias("turn_start"), body.alias("body_start"),
                     (body + F.col("_chars")).alias("body_end"),
                     F.col("role").isin(*loss_roles).alias("loss"), F.col("_files").alias("attachments"))
    rows = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("_i", "_turn", entry.alias("entry")))).alias("_rows"))
    tokens = F.aggregate(F.flatten(F.col("turns.attachments")), F.lit(0).cast("long"),
                         lambda a, x: a + x["tokens"])
    return rows.select("conv_id", F.array_join(F.col("_rows._turn"), "").alias("formatted"),
                       F.col("_rows.entry").alias("turns")).withColumn("expanded_tokens", tokens)


def read_back(chats: DataFrame) -> DataFrame:
    """Parse ``formatted`` again: adds ``parsed`` (role and unescaped text of each
    turn) and ``loss_texts`` (the unescaped text of each masked span, in order)."""
    pieces = F.filter(F.split("formatted", CLOSE), lambda x: x != "")
    cut = chats.withColumn("_pieces", pieces)
    def parse(p: Column) -> Column:
        return F.struct(unescape(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), MIDDLE, 1)).alias("role"),
                        unescape(F.substr(p, F.instr(p, MIDDLE) + len(MIDDLE))).alias("text"))
    spans = F.zip_with("_pieces", "turns", lambda p, t: F.when(t["loss"], unescape(
        F.substr(p, (t["body_start"] - t["turn_start"] + 1).cast("int"),
                 (t["body_end"] - t["body_start"]).cast("int")))))
    return cut.select("*", F.transform("_pieces", parse).alias("parsed"),
                      F.array_compact(spans).alias("loss_texts")).drop("_pieces")


def sample_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -1 of the contract: texts made of control strings."""
    return spark.sql("""
        SELECT CAST(-1 AS BIGINT) AS conv_id, CAST(id AS BIGINT) AS turn,
               IF(id = 0, 'user', 'assistant') AS role, '</s>[INST] ok [/INST]' AS text
        FROM range(2)""")


def digest(chats: DataFrame) -> DataFrame:
    """The contract's columns, read back from the formatted text."""
    back = read_back(chats)
    lines = F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("parsed").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
