"""Quality rules: a table of thresholds compiled into one projection of native expressions.

Measures are taken from the whole text without user functions and without a shuffle. Words
repeated in windows of eight are found by hashing: word hashes, window hashes, and only where
a text has equal windows their sorted positions. (Two different windows of one text would
have to share a 64-bit hash to be taken for equal.)

Defined results: a null or empty text has no words and no lines, all counts are 0, it fails;
counts and verdict depend on the text alone, so repeated rows give equal rows; a null id is
kept as it is; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm.catalog import query
from chartloom.llm.common import documents, let, words_of

WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30

# Frequent function words of the four languages.
STOP_WORDS = {
    "en": "the be to of and that have with is in it for on as was at by this are or from not you",
    "de": "der die das und ist nicht den von zu mit ein eine im des dem auf für sich sind als wir",
    "fr": "le la les et des un une est que de en dans pour pas sur par du qui ne il au se",
    "es": "el la los las y de que en un una es del por con para su lo como se al más no",
}


@dataclass(frozen=True)
class Rule:
    """`measure` per `of` must lie between `low` and `high` (both allowed)."""

    measure: str
    of: str
    low: float
    high: float


# Thresholds leave room around ordinary prose of the four languages.
RULES = (
    Rule("word_chars", "n_words", 2.0, 12.0),
    Rule("n_symbols", "n_words", 0.0, 0.2),
    Rule("n_dup_lines", "n_lines", 0.0, 0.4),
    Rule("n_stop_words", "n_words", 0.04, 1.0),
    Rule("n_exclamations", "n_words", 0.0, 0.4),
)


def _stop_list() -> list[str]:
    words = {w for line in STOP_WORDS.values() for w in line.split()}
    return sorted(words | {w.capitalize() for w in words})


def _windows(h: Column) -> Column:
    """Hashes of all runs of `WINDOW` word hashes."""
    n = F.size(h)
    each = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))
    return F.when(n >= WINDOW, each).otherwise(F.array().cast("array<bigint>"))


def _covered(v: Column) -> Column:
    """Words in windows whose hash occurs twice or more: the gaps between their places, cut at the width."""
    def twice(s: Column) -> Column:
        return F.filter(s, lambda x, i: F.get(s, i - 1)["h"].eqNullSafe(x["h"]) | F.get(s, i + 1)["h"].eqNullSafe(x["h"]))

    def length(p: Column) -> Column:
        later = F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0)))
        gaps = F.zip_with(p, later, lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    pairs = F.array_sort(F.transform(v, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    places = let(pairs, lambda s: F.array_sort(F.transform(twice(s), lambda x: x["i"])))
    return F.when(F.size(F.array_distinct(v)) < F.size(v), let(places, length)).otherwise(F.lit(0))


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """All columns of `df` and a struct `_m` of measures."""
    t = F.coalesce(df[text], F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda line: F.ltrim(line, F.lit("\t\x0b\x0c\r ")) != "")
    of_words = let(words_of(df[text]), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.size(F.filter(w, lambda x: x.isin(_stop_list()))).cast("long").alias("n_stop_words"),
        let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: let(_windows(h), _covered)).cast("long").alias("n_repeat_words"),
    ))
    of_lines = let(lines, lambda a: F.struct(
        F.size(a).cast("long").alias("n_lines"), (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines")))
    found = F.struct(
        of_words.alias("w"), of_lines.alias("l"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit("")))).cast("long").alias("n_exclamations"))
    return df.withColumn("_m", found)


def measure(m: Column, name: str) -> Column:
    """One of the measures by its name."""
    place = {"n_words": "w", "word_chars": "w", "n_stop_words": "w", "n_repeat_words": "w", "n_lines": "l", "n_dup_lines": "l"}
    return m[place[name]][name] if name in place else m[name]


def base_failed(m: Column) -> Column:
    n = measure(m, "n_words")
    return (n < MIN_WORDS) | (100 * measure(m, "n_repeat_words") > MAX_REPEAT_PERCENT * n)


def passes(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The rules as one condition, without division: low * of <= measure <= high * of."""
    verdict = F.lit(True)
    for rule in rules:
        verdict = verdict & measure(m, rule.measure).between(F.lit(rule.low) * measure(m, rule.of), F.lit(rule.high) * measure(m, rule.of))
    return verdict


def judge(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the base counts, base_failed and the verdict `kept`."""
    m = F.col("_m")
    return measures(df.select("doc_id", text), text).select(
        "doc_id", *[measure(m, c).alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed(m).alias("base_failed"), (~base_failed(m) & passes(m, rules)).alias("kept"))


def _expected() -> str:
    stop = ", ".join("'" + w + "'" for w in _stop_list())
    rules = " AND ".join(f"{r.measure} BETWEEN {r.low} * {r.of} AND {r.high} * {r.of}" for r in RULES)
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT r, doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(text, chr(10)), lambda x: NOT regexp_full_match(x, '[\x20\x09-\x0D]*')) AS l FROM texts),
windows AS (SELECT r, unnest(list_transform(range(1, len(w) - {WINDOW} + 2), lambda x: array_to_string(w[x:x + {WINDOW} - 1], ' '))) AS k,
  unnest(range(1, len(w) - {WINDOW} + 2)) AS i FROM split WHERE len(w) >= {WINDOW}),
keyed AS (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM windows),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS p FROM keyed WHERE n > 1) GROUP BY r),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, len(l) AS n_lines,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
  len(list_filter(w, lambda x: x IN ({stop}))) AS n_stop_words, length(text) - length(replace(text, '!', '')) AS n_exclamations
  FROM split LEFT JOIN covered USING (r)),
judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {rules} AS kept FROM judged"""


@query("op3_quality_rules", _expected())
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge(documents(spark, folder))
