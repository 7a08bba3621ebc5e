"""Quality rules: a table of thresholds compiled into one projection of Spark functions.

Nothing here leaves the JVM and nothing shuffles: every measure of a document is an expression
over its own text, so the plan is a scan and projections at any size.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.texts import WHITE_SPACE, table

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that it for was on are as with be this by from "
    "le la les de des du et un une que qui en dans pour au sur est "
    "der die das und den dem von zu mit ist ein eine nicht auf "
    "el los las y del se con por al su para es"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep a document only if low <= numerator / denominator <= high (null: no bound)."""

    name: str
    numerator: str
    denominator: str | None
    low: float | None
    high: float | None


#: The thresholds. A denominator of zero makes a ratio of zero.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 14.0),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 0.3),
    Rule("exclamation_ratio", "n_exclamations", "n_words", None, 0.5),
    Rule("stop_words", "n_stop_words", None, 1.0, None),
    Rule("dup_line_ratio", "n_dup_lines", "n_lines", None, 0.5),
    Rule("bullet_line_ratio", "n_bullet_lines", "n_lines", None, 0.9),
    Rule("ellipsis_line_ratio", "n_ellipsis_lines", "n_lines", None, 0.5),
)


def let(value: Column, use) -> Column:
    """use(value) with value computed once, also where use reads it in inner lambdas."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def count_of(text: Column, characters: str) -> Column:
    """How often any of these ASCII characters stands in a text."""
    without = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), characters, text)
    return (F.octet_length(text) - F.octet_length(without)).cast("long")


def repeated_words(words: Column) -> Column:
    """Words inside windows of eight words that the text has at least twice.

    Equal windows have equal hashes, so a text whose window hashes all differ has none. Only
    the other texts compare their windows, as joined strings, so the count is exact.
    """

    def paired(hashes: Column, step: int) -> Column:
        later = F.slice(hashes, F.lit(step + 1), F.size(hashes))
        return F.zip_with(hashes, later, lambda a, b: F.xxhash64(a, b))

    def all_differ(w: Column) -> Column:
        two = let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: paired(h, 1))
        eight = let(let(two, lambda h: paired(h, 2)), lambda h: paired(h, 4))
        inside = F.slice(eight, F.lit(1), F.size(w) - F.lit(WINDOW - 1))
        return let(inside, lambda h: F.size(F.array_distinct(h)) == F.size(h))

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - F.lit(WINDOW - 1))
        return F.transform(starts, lambda i: F.array_join(F.slice(w, i, F.lit(WINDOW)), " "))

    def covered(sorted_windows: Column) -> Column:
        def twin(x: Column, j: Column) -> Column:
            before = F.when(j > 0, F.get(sorted_windows, j - 1)["v"])
            after = F.get(sorted_windows, j + 1)["v"]
            return F.coalesce(before == x["v"], F.lit(False)) | F.coalesce(
                after == x["v"], F.lit(False)
            )

        places = F.array_sort(F.transform(F.filter(sorted_windows, twin), lambda x: x["p"]))
        start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))
        return F.aggregate(
            places, start,
            lambda a, p: F.struct(
                (a["total"] + p + WINDOW - F.greatest(a["end"], p)).alias("total"),
                (p + WINDOW).alias("end"),
            ),
            lambda a: a["total"],
        )

    def total(v: Column) -> Column:
        placed = F.array_sort(
            F.transform(v, lambda x, p: F.struct(x.alias("v"), p.alias("p")))
        )
        return let(placed, covered)

    return let(
        words,
        lambda w: F.when(F.size(w) < WINDOW, 0)
        .when(all_differ(w), 0)
        .otherwise(let(windows(w), total)),
    ).cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """The measures that rules speak of, as columns added to docs."""
    text = F.coalesce(F.col("text"), F.lit(""))
    stop = F.array(*[F.lit(form) for w in STOP_WORDS for form in (w, w.capitalize(), w.upper())])
    lines = F.filter(
        F.split(text, "\n"), lambda line: F.length(F.btrim(line, F.lit(WHITE_SPACE))) > 0
    )
    opening = lambda line: F.substring(F.btrim(line, F.lit(WHITE_SPACE)), 1, 1)
    facts = let(
        F.struct(words_of(text).alias("w"), lines.alias("l")),
        lambda x: F.struct(
            F.size(x["w"]).cast("long").alias("n_words"),
            F.length(F.array_join(x["w"], "")).cast("long").alias("word_chars"),
            (F.size(x["l"]) - F.size(F.array_distinct(x["l"]))).cast("long").alias("n_dup_lines"),
            repeated_words(x["w"]).alias("n_repeat_words"),
            F.size(F.array_intersect(x["w"], stop)).cast("long").alias("n_stop_words"),
            F.size(x["l"]).cast("long").alias("n_lines"),
            F.size(F.filter(x["l"], lambda line: opening(line).isin("-", "*", "•")))
            .cast("long").alias("n_bullet_lines"),
            F.size(F.filter(x["l"], lambda line: F.endswith(line, F.lit("..."))))
            .cast("long").alias("n_ellipsis_lines"),
        ),
    )
    return docs.withColumn("facts", facts).withColumns(
        {"n_symbols": count_of(text, SYMBOLS), "n_exclamations": count_of(text, "!")}
    ).select("*", "facts.*").drop("facts")


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """All rules of a table as one condition."""
    passed = F.lit(True)
    for rule in rules:
        value = F.col(rule.numerator).cast("double")
        if rule.denominator:
            size = F.col(rule.denominator)
            value = F.when(size > 0, value / size).otherwise(0.0)
        if rule.low is not None:
            passed = passed & (value >= rule.low)
        if rule.high is not None:
            passed = passed & (value <= rule.high)
    return passed


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: the measures, base_failed and kept.

    docs needs doc_id and text; other columns are ignored, whatever their names. A null or
    empty text has no words, fails the base rule and is not kept. Repeated rows and equal ids
    give one row each. An empty table gives no rows. Texts of any length are measured whole.
    """
    measured = measure(docs.select("doc_id", "text"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & verdict(rules)
    )


OUTPUT = (
    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "base_failed", "kept",
)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(*OUTPUT)


def _sql_rules() -> str:
    parts = []
    for rule in RULES:
        value = f"{rule.numerator}::DOUBLE"
        if rule.denominator:
            value = f"(CASE WHEN {rule.denominator} > 0 THEN {value} / {rule.denominator} ELSE 0 END)"
        parts += [f"{value} >= {rule.low}"] * (rule.low is not None)
        parts += [f"{value} <= {rule.high}"] * (rule.high is not None)
    return " AND ".join(parts)


_STOP_SQL = ", ".join(f"'{f}'" for w in STOP_WORDS for f in (w, w.capitalize(), w.upper()))
_SPACE = r"[\x20\x09-\x0D]"

OP8_SQL = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), win AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c FROM (
    SELECT doc_id, p, array_to_string(list_slice(w, p, p + 7), ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM t))
), rep AS (
  SELECT doc_id, count(DISTINCT q) AS n
  FROM (SELECT doc_id, unnest(range(p, p + 8)) AS q FROM win WHERE c > 1) GROUP BY doc_id
), m AS (
  SELECT t.doc_id, len(w)::BIGINT AS n_words,
         length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (length(text) - length(replace(text, '!', '')))::BIGINT AS n_exclamations,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         len(list_intersect(w, [{_STOP_SQL}]))::BIGINT AS n_stop_words,
         len(l)::BIGINT AS n_lines,
         len(list_filter(l, lambda x: regexp_matches(x, '^{_SPACE}*[-*•]')))::BIGINT AS n_bullet_lines,
         len(list_filter(l, lambda x: x LIKE '%...'))::BIGINT AS n_ellipsis_lines
  FROM t LEFT JOIN rep USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       (NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND {_sql_rules()}) AS kept
FROM m
"""
