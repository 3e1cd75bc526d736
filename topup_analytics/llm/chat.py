"""Chat formatting with Spark expressions: conversations to one marked text, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topup_analytics.llm.common import bound, filled, read_table

#: Marks around the turns of the usual roles.
MARKS = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
}
#: Marks around the turns of any other role, whose name comes first.
OTHER = ("<<ROLE>>", "<<TEXT>>", "<</ROLE>>")
#: Between the texts of adjacent turns of one role, which share their marks.
NEXT = "<<NEXT>>"
#: Turns whose lengths are added up in one fold, and code points that a span is looked up among.
SLICE = 512
PIECE = 4096
#: The role whose texts are learned from.
LEARNED = "assistant"

#: All marks without their first character, which is < or [.
_REST = r"(<(?:SYS|/SYS|ROLE|TEXT|/ROLE|NEXT)>>|/?INST\]|/?s>)"
_ENDS = r"<</SYS>>|\[/INST\]|</s>|<</ROLE>>"


def escape(text: Column) -> Column:
    """Puts a backslash into each mark of a text, after its first character.

    A mark that already has backslashes there gets one more, so nothing is
    ambiguous. The result holds no mark.
    """
    return F.regexp_replace(text, r"([<\[])(\\*)" + _REST, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """The inverse of :func:`escape`."""
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _REST, "$1$2$3")


def _opening(role: Column) -> Column:
    named = F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1]))
    return F.coalesce(*[F.when(role == name, F.lit(start)) for name, (start, _) in MARKS.items()], named)


def _closing(role: Column) -> Column:
    return F.coalesce(*[F.when(role == name, F.lit(end)) for name, (_, end) in MARKS.items()], F.lit(OTHER[2]))


def _with_starts(parts: DataFrame) -> DataFrame:
    """Adds ``starts``, where each text begins: the sums of all ``marks`` and ``lengths`` before it, and its own mark.

    A fold that appends copies its array at every step. So slices of ``SLICE`` turns are folded
    each for itself, and then the slices' totals: time stays in proportion to the turns.
    """

    def fold(amounts: Column, before, after) -> Column:
        """The running ``before`` of each amount, and the total of ``after``."""
        return F.aggregate(
            amounts,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
            lambda state, x: F.struct(
                (state["at"] + after(x)).alias("at"), F.concat(state["starts"], F.array(state["at"] + before(x))).alias("starts")
            ),
        )

    def within(zipped: Column) -> Column:
        """The folds of the slices of all turns."""
        numbers = F.sequence(F.lit(0), ((F.size(zipped) - 1) / SLICE).cast("int"))
        part = lambda i: F.slice(zipped, i * SLICE + 1, SLICE)
        return F.transform(numbers, lambda i: fold(part(i), lambda x: x["marks"], lambda x: x["marks"] + x["lengths"]))

    def placed(inner: Column) -> Column:
        offsets = fold(inner, lambda x: F.lit(0), lambda x: x["at"])["starts"]
        return bound(
            offsets, lambda all: F.flatten(F.transform(inner, lambda x, i: F.transform(x["starts"], lambda at: at + F.get(all, i))))
        )

    return parts.withColumn("starts", bound(bound(F.arrays_zip("marks", "lengths"), within), placed))


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One marked text for each conversation.

    The turns of a conversation are collected as structs, sorted by turn (null
    first; ties by role, then text), and folded into blocks of adjacent turns of
    one role. A block is its role's marks around its escaped texts, which
    ``NEXT`` separates, so every turn can be read back.

    Returns ``conv_id``, ``formatted``, and ``loss_spans``: structs of ``start``
    (code points, from 0) and ``length`` of each assistant text in ``formatted``. A
    null text or role is empty. Turns with a null conversation are one conversation.
    Repeated rows are turns like any other, and an empty table gives no rows. A
    conversation is one row of the result, and so must fit into one; time grows with its
    turns and its characters. Other columns of ``turns``, whatever their names are, are not read.
    """
    one = F.struct(
        F.col(turn).alias("turn"), filled(F.col(role).cast("string")).alias("role"), filled(F.col(text)).alias("text")
    )
    rows = turns.select(F.col(conv).alias("conv_id"), one.alias("one"))
    collected = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    # Each turn brings what precedes it: the end of the block before and its own opening, or NEXT.
    marked = F.transform(
        "turns",
        lambda t, i: F.struct(
            t["role"].alias("role"),
            F.when(i == 0, _opening(t["role"]))
            .when(F.get("turns", i - 1)["role"] == t["role"], F.lit(NEXT))
            .otherwise(F.concat(_closing(F.get("turns", i - 1)["role"]), _opening(t["role"])))
            .alias("before"),
            escape(t["text"]).alias("text"),
        ),
    )
    measured = collected.select("conv_id", marked.alias("parts")).select(
        "conv_id",
        "parts",
        F.transform("parts", lambda p: F.char_length(p["before"])).alias("marks"),
        F.transform("parts", lambda p: F.char_length(p["text"])).alias("lengths"),
    )
    placed = _with_starts(measured)
    spans = F.filter(
        F.transform(
            F.arrays_zip("parts", "starts", "lengths"),
            lambda x: F.when(
                x["parts"]["role"] == LEARNED, F.struct(x["starts"].alias("start"), x["lengths"].alias("length"))
            ),
        ),
        lambda x: x.isNotNull(),
    )
    body = F.array_join(F.transform("parts", lambda p: F.concat(p["before"], p["text"])), "")
    return placed.select(
        "conv_id",
        F.concat(body, _closing(F.element_at("parts", -1)["role"])).alias("formatted"),
        spans.alias("loss_spans"),
    )


def read_chats(formatted: Column | str) -> Column:
    """The turns of a formatted conversation: an array of ``role`` and ``text``."""
    body = F.col(formatted) if isinstance(formatted, str) else formatted
    blocks = F.filter(F.split(body, _ENDS), lambda b: F.char_length(b) > 0)

    def parsed(block: Column) -> Column:
        known = [
            F.when(
                block.startswith(start),
                F.struct(F.lit(name).alias("role"), F.substring(block, F.lit(len(start) + 1), F.char_length(block)).alias("text")),
            )
            for name, (start, _) in MARKS.items()
        ]
        named = F.struct(
            unescape(F.substring(F.substring_index(block, OTHER[1], 1), len(OTHER[0]) + 1, 2**31 - 1)).alias("role"),
            F.substring(
                block, F.char_length(F.substring_index(block, OTHER[1], 1)) + F.lit(len(OTHER[1]) + 1), F.char_length(block)
            ).alias("text"),
        )
        return F.coalesce(*known, named)

    return F.flatten(
        F.transform(
            F.transform(blocks, parsed),
            lambda b: F.transform(
                F.split(b["text"], NEXT), lambda t: F.struct(b["role"].alias("role"), unescape(t).alias("text"))
            ),
        )
    )


def learned_text(formatted: Column | str, spans: Column | str) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    body = F.col(formatted) if isinstance(formatted, str) else formatted
    # A span is taken from the pieces it lies in: from the whole text, all that stands before it would be counted again.
    pieces = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def spoken(piece: Column, span: Column) -> Column:
        first = (span["start"] / PIECE).cast("int")
        last = ((span["start"] + span["length"]) / PIECE).cast("int")
        near = F.array_join(F.slice(piece, first + 1, last - first + 1), "")
        return unescape(F.substring(near, span["start"] - first * PIECE + 1, span["length"]))

    return F.array_join(bound(pieces, lambda piece: F.transform(spans, lambda s: spoken(piece, s))), "")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, and of one that quotes marks, read back from their formatted texts."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    quoting = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    chats = format_chats(turns.unionByName(quoting))
    read = chats.select(
        "conv_id", "formatted", read_chats("formatted").alias("turns"), learned_text("formatted", "loss_spans").alias("learned")
    )
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.char_length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


#: The twin digests the tables' own turns, and counts what the marks and backslashes add.
OP5_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
),
marked AS (
  SELECT *, role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS opens,
    regexp_replace(text, '([<\[])(\\*)(<(?:SYS|/SYS|ROLE|TEXT|/ROLE|NEXT)>>|/?INST\]|/?s>)', '\1\\\2\3', 'g') AS escaped,
    regexp_replace(role, '([<\[])(\\*)(<(?:SYS|/SYS|ROLE|TEXT|/ROLE|NEXT)>>|/?INST\]|/?s>)', '\1\\\2\3', 'g') AS escaped_role
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length(escaped) + CASE WHEN NOT opens THEN 8 WHEN role = 'system' THEN 15 WHEN role = 'user' THEN 13
    WHEN role = 'assistant' THEN 7 ELSE 25 + length(escaped_role) END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""
