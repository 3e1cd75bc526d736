"""Quality rules: repetition counts and divergence from what is usual in a language."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topup_analytics.llm.common import bound, filled, read_table, stored, words

#: Rules of the base.
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"

#: Character classes counted by pattern; letters beyond ASCII, and all the rest, are two more.
CLASSES = {
    "upper": "[A-Z]+",
    "lower": "[a-z]+",
    "digit": "[0-9]+",
    "space": r"\s+",
    "mark": r"[.,;:'\"()!?-]+",
}
#: So many words stand for each language: those found in most of its texts.
N_COMMON = 12
#: What the mean of all languages adds to each language's reference: so many characters, and so many words.
SMOOTH_CHARS, SMOOTH_WORDS = 20, 4
#: Words are first ranked in so many parts of a language's vocabulary.
WORD_PARTS = 64
#: Shorter texts are not judged by their histograms.
JUDGED_WORDS = 40
#: A text further (Jensen-Shannon distance, base 2) than this from every reference is rejected.
MOST_DISTANCE = 0.235


def repeated_words(word_list: Column, window: int = WINDOW) -> Column:
    """How many words lie in a window of words that occurs twice or more in the list.

    Windows are compared by 64-bit hashes. Where all differ nothing is sorted;
    else the starts of repeated windows are found by sorting (hash, start), and
    each start adds the words up to the next start, at most a window.
    """
    none = F.lit(0).cast("bigint")

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(found: Column) -> Column:
            same = lambda x, i: (x["h"] == F.get(found, i - 1)["h"]) | (x["h"] == F.get(found, i + 1)["h"])
            at = F.filter(found, lambda x, i: F.coalesce(same(x, i), F.lit(False)))
            return F.sort_array(F.transform(at, lambda x: x["i"]))

        def length(at: Column) -> Column:
            steps = F.transform(at, lambda x, i: F.least(F.coalesce(F.get(at, i + 1) - x, F.lit(window)), F.lit(window)))
            return F.aggregate(steps, none, lambda total, x: total + x)

        return bound(bound(pairs, starts), length)

    def of_hashes(hashes: Column) -> Column:
        differ = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(differ, none).otherwise(covered(hashes))

    return F.when(F.size(word_list) <= window, none).otherwise(bound(_hashed_windows(word_list, window), of_hashes))


def _hashed_windows(word_list: Column, window: int) -> Column:
    """A hash of every window of words, put together from those of its halves; ``window`` is a power of two."""
    hashes, width = F.transform(word_list, lambda w: F.xxhash64(w)), 1
    while width < window:
        # Neither half is a slice: each hash is made of two numbers.
        join = lambda half, k=width: F.transform(
            F.slice(half, 1, F.size(half) - k), lambda h, i: F.xxhash64(h, F.get(half, i + k))
        )
        hashes, width = bound(hashes, _one(join)), 2 * width
    return hashes


def _one(body):
    """A function of one argument; Spark counts the arguments of what it is given."""
    return lambda value: body(value)


def _count(text: Column, pattern: str) -> Column:
    """Bytes of an ASCII class in a text."""
    return F.octet_length(text) - F.octet_length(F.regexp_replace(text, pattern, ""))


def common_words(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, tuple[str, ...]]:
    """For each language of ``docs`` the words found in most of its texts, one rule for all.

    Counted over all texts. Ties go by spelling; a language of fewer words has empty ones, which no text holds.
    ``N_COMMON`` words for each label come to the driver.
    """
    rows = docs.select(F.col(lang).cast("string").alias("lang"), filled(text).alias("text")).where("lang is not null")
    names = sorted(row["lang"] for row in rows.select("lang").distinct().collect())
    each = rows.select("lang", F.explode(F.array_distinct(words(F.col("text")))).alias("word"))
    # Ranked in parts first, so that no task orders a language's whole vocabulary.
    counted = each.groupBy("lang", "word").count().withColumn("part", F.pmod(F.xxhash64("word"), F.lit(WORD_PARTS)))
    for group in (["lang", "part"], ["lang"]):
        best = Window.partitionBy(*group).orderBy(F.desc("count"), "word")
        counted = counted.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= N_COMMON)
    found: dict[str, list[str]] = {name: [] for name in names}
    for row in counted.orderBy("lang", "rank").collect():
        found[row["lang"]].append(row["word"])
    return {name: tuple([*group, *[""] * (N_COMMON - len(group))]) for name, group in found.items()}


def _occurrences(common: Column, groups: dict[str, tuple[str, ...]]) -> Column:
    """How often each word of the groups occurs, one group after the other."""
    # Each word that the text has is counted once, however many languages there are.
    times = lambda found: F.transform(found, lambda w: F.size(common) - F.size(F.array_remove(common, w)))
    every = F.array(*[F.lit(w) for group in groups.values() for w in group]).cast("array<string>")
    look_up = lambda of: F.transform(every, lambda w: F.coalesce(F.try_element_at(of, w), F.lit(0)))
    return bound(bound(F.array_distinct(common), lambda found: F.map_from_arrays(found, times(found))), look_up)


def text_counts(
    docs: DataFrame, keep: list[str], groups: dict[str, tuple[str, ...]], text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The base counts and both histograms of every whole text, in one pass without a shuffle.

    ``classes`` counts the characters of each class, and ``common`` the words of each list of
    ``groups``, one list after the other. Both stand beside ``lang`` and, in ``row``, the ``keep`` columns.
    """
    rows = docs.select(F.struct(*keep).alias("row"), F.col(lang).cast("string").alias("lang"), filled(text).alias("text"))
    rows = rows.withColumn("words", words(F.col("text")))
    every = sorted({w for group in groups.values() for w in group})
    body = F.col("text")
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"\S"))
    n_symbols = sum((F.octet_length(body) - F.octet_length(F.replace(body, F.lit(s), F.lit("")))) for s in SYMBOLS)
    foreign = F.char_length(F.regexp_replace(body, r"[\x00-\x7F]+", ""))
    counted = rows.select(
        "row",
        "lang",
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        n_symbols.cast("bigint").alias("n_symbols"),
        bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        bound(F.col("words"), lambda w: repeated_words(w)).alias("n_repeat_words"),
        F.char_length(body).alias("n_chars"),
        F.array(*[_count(body, p) for p in CLASSES.values()], foreign).alias("counted"),
        bound(F.filter("words", lambda w: w.isin(every)), lambda w: _occurrences(w, groups)).alias("common"),
    )
    known = F.aggregate("counted", F.lit(0), lambda total, x: total + x)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return counted.select(
        "row",
        "lang",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        F.concat("counted", F.array(F.col("n_chars") - known)).alias("classes"),
        "common",
    )


#: A language's shares of character classes, and of its common words and all others.
Reference = tuple[list[float], list[float]]


def references(counts: DataFrame, groups: dict[str, tuple[str, ...]]) -> dict[str, Reference]:
    """Shares of character classes and of common words in the texts of each language that has any among ``counts``.

    One partial aggregation to a row for each language. Every language's counts get a little of the mean of
    all, ``SMOOTH_CHARS`` and ``SMOOTH_WORDS``, so that a single text is a reference too, if a vague one.
    """
    if not groups:
        return {}
    places = F.create_map(*[F.lit(x) for at, name in enumerate(groups) for x in (name, at * N_COMMON + 1)])
    of_language = counts.where(F.col("lang").isin(*groups)).withColumn(
        "own", F.slice("common", F.element_at(places, F.col("lang")), N_COMMON)
    )
    sums = of_language.groupBy("lang").agg(
        F.sum("n_words").alias("n"),
        F.array(*[F.sum(F.col("classes")[i].cast("bigint")) for i in range(len(CLASSES) + 2)]).alias("classes"),
        F.array(*[F.sum(F.col("own")[i].cast("bigint")) for i in range(N_COMMON)]).alias("own"),
    )
    rows = sorted(sums.collect(), key=lambda row: row["lang"])
    chars = [row["classes"] for row in rows]
    common = [[*row["own"], row["n"] - sum(row["own"])] for row in rows]
    return {row["lang"]: (c, w) for row, c, w in zip(rows, _smoothed(chars, SMOOTH_CHARS), _smoothed(common, SMOOTH_WORDS))}


def _smoothed(counts: list[list[int]], amount: int) -> list[list[float]]:
    """Shares in each list, with an amount of the mean of all lists added."""
    sums = [sum(column) for column in zip(*counts)]
    mean = [n / max(1, sum(sums)) for n in sums]
    return [[(n + amount * m) / (sum(own) + amount) for n, m in zip(own, mean)] for own in counts]


def _divergence(shares: Column, reference: Column) -> Column:
    """Jensen-Shannon divergence in base 2 of two histograms of shares."""

    def term(p: Column, q: Column) -> Column:
        part = lambda x: F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(0.0)
        return part(p) + part(q)

    terms = F.zip_with(shares, reference, term)
    total = F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)
    return F.greatest(total / 2, F.lit(0.0))


def _measured(counts: DataFrame, found: dict[str, Reference], groups: dict[str, tuple[str, ...]]) -> DataFrame:
    """Adds the distance from the nearest reference; null for short texts and where the text's language has no reference.

    The references are one literal array, so the expression is as long for a hundred languages as for one.
    """
    if not found:
        return counts.withColumn("distance", F.lit(None).cast("double"))
    places = {name: at * N_COMMON + 1 for at, name in enumerate(groups)}
    rows = [{"at": places[name], "classes": classes, "words": shares} for name, (classes, shares) in found.items()]
    every = F.from_json(F.lit(json.dumps(rows)), "array<struct<at: int, classes: array<double>, words: array<double>>>")
    n_chars = F.aggregate("classes", F.lit(0), lambda total, x: total + x)
    class_shares = F.transform("classes", lambda n: n / n_chars)

    def word_shares(at: Column) -> Column:
        own = F.slice("common", at, N_COMMON)
        rest = F.col("n_words") - F.aggregate(own, F.lit(0), lambda total, x: total + x)
        return F.transform(F.concat(own, F.array(rest.cast("int"))), lambda n: n / F.col("n_words"))

    def distances(shares: Column) -> Column:
        mean = lambda r: (_divergence(shares, r["classes"]) + _divergence(word_shares(r["at"]), r["words"])) / 2
        return F.transform(every, lambda r: F.sqrt(mean(r)))

    has_reference = F.col("lang").isNull() | F.col("lang").isin(*found)
    judged_here = (F.col("n_words") >= JUDGED_WORDS) & has_reference
    return counts.withColumn("distance", F.when(judged_here, F.array_min(bound(class_shares, distances))))


def _far() -> Column:
    return F.coalesce(F.col("distance") > MOST_DISTANCE, F.lit(False))


def judged(docs: DataFrame, keep: list[str] | None = None, text: str = "text", lang: str = "lang") -> DataFrame:
    """The base counts of every text, its distances from the nearest reference, and whether it is kept.

    References are the shares of character classes and of common words in all
    texts of a language that pass the base rules and are not far from the same
    shares with those far texts included. The distance of a text from a reference
    is the root of the mean divergence of the two histograms; a text is far if it
    is further than ``MOST_DISTANCE`` from each reference, so another language's
    label does not reject it, and a text without a label is held against all. Every
    language with a text that passes the base has a reference, by one rule: its common words are those found in
    most of its texts (``common_words``), its shares are smoothed towards the mean of all (``references``).
    Texts under ``JUDGED_WORDS`` words, and those of a language without a text that passes,
    are not judged so, and their distance is null.

    Returns ``row`` (a struct of the ``keep`` columns, all by default, whatever their names are), the
    counts, ``base_failed``, ``distance`` and ``kept``. A
    null or blank text has no words and fails the base. Rows are judged one by
    one, so ids may be null or repeated; an empty table gives no rows. Whole texts are read, and time
    grows with their length, but for the sorting of windows in a text that repeats itself.
    """
    keep = docs.columns if keep is None else keep
    groups = common_words(docs, text, lang)
    counts = stored(text_counts(docs, keep, groups, text, lang))
    usable = counts.where(~F.col("base_failed"))
    rough = _measured(usable, references(usable, groups), groups)
    rows = _measured(counts, references(rough.where(~_far()), groups), groups)
    kept = ~F.col("base_failed") & ~_far()
    return rows.select(
        "row",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "distance",
        kept.alias("kept"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all whole documents."""
    rows = judged(read_table(spark, sf_dir, "documents"), ["doc_id"])
    return rows.withColumn("distance", F.round("distance", 6)).select("row.doc_id", *[c for c in rows.columns if c != "row"])


def _distances(name: str, use: str) -> str:
    """SQL of the distances from the references of the documents that ``use`` selects."""
    return f"""
{name}_sums AS (
  SELECT kind, ref, bin, sum(n) AS n, CASE kind WHEN 'c' THEN {SMOOTH_CHARS} ELSE {SMOOTH_WORDS} END AS amount
  FROM histograms JOIN base USING (nr) WHERE lang = ref AND nr IN ({use}) GROUP BY kind, ref, bin
),
{name}_mean AS (SELECT kind, bin, sum(n) / sum(sum(n)) OVER (PARTITION BY kind) AS m FROM {name}_sums GROUP BY kind, bin),
{name}_references AS (
  SELECT kind, ref, bin, (n + amount * m) / (sum(n) OVER (PARTITION BY kind, ref) + amount) AS q
  FROM {name}_sums JOIN {name}_mean USING (kind, bin)
),
{name} AS (
  SELECT nr, min(d) AS distance FROM (
    SELECT nr, ref, sqrt(sum(j) / 2) AS d FROM (
      SELECT nr, ref, kind, greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
        + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2) AS j
      FROM shares JOIN {name}_references USING (kind, ref, bin) GROUP BY nr, ref, kind
    ) GROUP BY nr, ref
  ) JOIN base USING (nr) WHERE lang IS NULL OR lang IN (SELECT ref FROM {name}_references) GROUP BY nr
)"""


#: DuckDB's \\s lacks the vertical tab.
_PATTERNS = [p.replace(r"\s", r"[\x20\x09-\x0D]").replace("'", "''") for p in CLASSES.values()]
_CLASSES = ", ".join(f"length(text) - length(regexp_replace(text, '{p}', '', 'g'))" for p in _PATTERNS)

OP9_SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS nr, doc_id, lang, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs),
windows AS (
  SELECT nr, i, array_to_string(list_slice(words, i + 1, i + {WINDOW}), ' ') AS w
  FROM (SELECT nr, words, unnest(range(len(words) - {WINDOW - 1})) AS i FROM split)
),
covered AS (
  SELECT nr, count(DISTINCT i + k) AS n
  FROM (SELECT *, count(*) OVER (PARTITION BY nr, w) AS times FROM windows), range({WINDOW}) r(k)
  WHERE times > 1 GROUP BY nr
),
base AS (
  SELECT nr, doc_id, lang, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))
      - len(list_distinct(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words,
    len(words) < {LEAST_WORDS} OR 100 * coalesce(covered.n, 0) > {MOST_REPEATED_PERCENT} * len(words) AS base_failed
  FROM split LEFT JOIN covered USING (nr)
),
texts_with AS (
  SELECT lang AS ref, word, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) - 1 AS bin
  FROM (SELECT lang, unnest(list_distinct(words)) AS word FROM split WHERE lang IS NOT NULL) GROUP BY lang, word
),
common AS (
  SELECT ref, bin, word FROM (SELECT DISTINCT lang AS ref FROM split WHERE lang IS NOT NULL) CROSS JOIN range({N_COMMON}) r(bin)
  LEFT JOIN texts_with USING (ref, bin)
),
classes AS (
  SELECT nr, length(text) AS n_chars, [{_CLASSES}, length(regexp_replace(text, '[\x00-\x7F]', '', 'g'))] AS c FROM docs
),
occurrences AS (SELECT nr, word, count(*) AS n FROM (SELECT nr, unnest(words) AS word FROM split) GROUP BY nr, word),
of_common AS (
  SELECT nr, ref, bin, coalesce(n, 0) AS n FROM docs CROSS JOIN common LEFT JOIN occurrences USING (nr, word)
),
histograms AS (
  SELECT 'c' AS kind, nr, ref, bin, n
  FROM (SELECT nr, unnest(c || [n_chars - list_sum(c)]) AS n, unnest(range(len(c) + 1)) AS bin FROM classes),
    (SELECT DISTINCT ref FROM common)
  UNION ALL SELECT 'w', nr, ref, bin, n FROM of_common
  UNION ALL SELECT 'w', nr, ref, 99, any_value(n_words) - sum(n) FROM of_common JOIN base USING (nr) GROUP BY nr, ref
),
shares AS (
  SELECT *, n / sum(n) OVER (PARTITION BY kind, nr, ref) AS p
  FROM histograms WHERE nr IN (SELECT nr FROM base WHERE n_words >= {JUDGED_WORDS})
),
{_distances("rough", "SELECT nr FROM base WHERE NOT base_failed")},
{_distances("final", f"SELECT nr FROM base LEFT JOIN rough USING (nr) WHERE NOT base_failed AND coalesce(distance, 0) <= {MOST_DISTANCE}")}
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, round(distance, 6) AS distance,
  NOT base_failed AND coalesce(distance, 0) <= {MOST_DISTANCE} AS kept
FROM base LEFT JOIN final USING (nr)
"""
