"""Fill-in-the-middle training texts, cut and put in order by one regular expression for each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topup_analytics.llm.common import filled, read_table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A unit that a text is cut between: a run of ASCII letters, or any other code point.
UNIT = "[A-Za-z]+|[^A-Za-z]"
#: The same without a way back into a run, so that no unit is ever split to make a match.
_WHOLE_UNIT = "(?:[A-Za-z]++|[^A-Za-z])"
#: Of 100 documents, those left as they are, and of the others those whose suffix comes first.
PLAIN_PERCENT = 10
SPM_PERCENT = 20
PLAIN, PSM, SPM = "plain", "psm", "spm"


def _number(digest: Column, group: int) -> Column:
    """One of the digest's groups of eight hexadecimal digits as an unsigned integer."""
    return F.conv(F.substring(digest, 1 + 8 * (group - 1), 8), 16, 10).cast("bigint")


def _holds_mark(text: Column) -> Column:
    return text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)


def infill(
    docs: DataFrame, id: str = "doc_id", text: str = "text", seed: int = 1,
    plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """Each text with its middle part moved to the end: ``row`` (the document), ``n``, ``form``,
    ``prefix_chars, middle_chars`` and ``output``.

    A text has ``n`` units (``UNIT``). Two cuts between units, drawn by a hash of seed and id, part it into
    prefix, middle and suffix. A pattern made for the row counts the units off, ``unit{a}+`` and
    ``unit{b-a}+``, and its one match puts the three groups behind their marks. The counted groups are
    possessive: Java runs them as a loop, without recursion and without a state to go back to, so a text
    of millions of units takes time in proportion and no stack. ``form`` is ``psm``, ``spm`` or ``plain``;
    a plain text is unchanged, and its lengths are null. A text that is empty or holds a mark is plain.

    A null text counts as empty, a null id as the empty string. Equal rows give equal results; no row is
    dropped, and an empty table gives no rows. The document's own columns stay inside ``row``, whatever their
    names are. Only Spark expressions; one pass, no shuffle.
    """
    content = filled(text)
    rows = docs.select(
        F.struct("*").alias("row"),
        content.alias("content"),
        F.sha2(F.concat(F.lit(f"{seed}:"), filled(F.col(id).cast("string"))), 256).alias("digest"),
        F.regexp_count(content, F.lit(UNIT)).cast("bigint").alias("n"),
    )
    first, second = (_number(F.col("digest"), i) % (F.col("n") + 1) for i in (1, 2))
    plain = (F.col("n") == 0) | _holds_mark(F.col("content"))
    plain = plain | (_number(F.col("digest"), 3) % 100 >= 100 - plain_percent)
    ahead = _number(F.col("digest"), 4) % 100 < spm_percent
    cuts = rows.select(
        "row",
        "content",
        "n",
        F.least(first, second).alias("a"),
        F.greatest(first, second).alias("b"),
        F.when(plain, PLAIN).when(ahead, SPM).otherwise(PSM).alias("form"),
    )
    counted = lambda units: F.concat(F.lit(f"({_WHOLE_UNIT}{{"), units.cast("string"), F.lit("}+)"))
    pattern = F.concat(F.lit("(?s)^"), counted(F.col("a")), counted(F.col("b") - F.col("a")), F.lit(r"(.*)\z"))
    order = F.when(F.col("form") == PSM, f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    moved = F.regexp_replace("content", pattern, order)
    done = cuts.select("row", "n", "form", F.when(F.col("form") == PLAIN, F.col("content")).otherwise(moved).alias("output"))
    # The text holds no mark, and no mark begins as another ends: the first place of each is its own.
    place = lambda mark: F.locate(mark, F.col("output"))
    length = F.char_length("output")
    before_suffix, before_middle = place(SUFFIX) - len(PREFIX) - 1, place(MIDDLE) - place(PREFIX) - len(PREFIX)
    chars = lambda value: value.cast("bigint")
    moved_form = F.col("form") != PLAIN
    return done.select(
        "row",
        "n",
        "form",
        F.when(moved_form, chars(F.when(F.col("form") == PSM, before_suffix).otherwise(before_middle))).alias("prefix_chars"),
        F.when(moved_form, chars(length - place(MIDDLE) - len(MIDDLE) + 1)).alias("middle_chars"),
        "output",
    )


def restored(output: Column, form: Column) -> Column:
    """The text that ``infill`` made an output of."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    in_order = {PSM: (1, 3, 2), SPM: (2, 3, 1)}
    whole = {name: F.concat(*[F.get(parts, F.lit(i)) for i in order]) for name, order in in_order.items()}
    return F.when(form == PSM, whole[PSM]).when(form == SPM, whole[SPM]).otherwise(output)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an infilling example, and the digest of the text read back from it."""
    digest = lambda text: F.sha2(text, 256)
    return infill(read_table(spark, sf_dir, "documents")).select(
        "row.doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


OP13_SQL = f"""
WITH rows AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS digest,
         regexp_extract_all(coalesce(text, ''), '{UNIT}') AS units
  FROM documents
),
drawn AS (
  SELECT *, len(units) AS n, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(digest, i, 8))::BIGINT) AS h FROM rows
),
cut AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}')
                   OR h[3] % 100 >= {100 - PLAIN_PERCENT} THEN '{PLAIN}'
              WHEN h[4] % 100 < {SPM_PERCENT} THEN '{SPM}' ELSE '{PSM}' END AS form
  FROM drawn
),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS prefix,
         array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix
  FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> '{PLAIN}' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> '{PLAIN}' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN '{PLAIN}' THEN text
                        WHEN '{PSM}' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
                        ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
