"""Line-first cleaning with built-in functions only.

Every line is judged by itself: navigation (two or more of | > ›), boilerplate (a phrase of BOILERPLATE, in four
languages), symbols (over a tenth of its characters), capitals (over half of its characters), shouting (three or
more exclamation marks, and one in twenty characters) and missing punctuation (200 characters or more without a
sentence mark). Failing lines are removed; a document whose remaining lines have less than half of the characters
of all its lines with a word is rejected. Phrases are looked for in single lines only if the whole text may have one.

The statistics of a whole text come with it: words, their characters, symbols, repeated lines, and words
in three-word windows that occur twice or more. Windows are compared as 64-bit hashes within one text:
the hashes are sorted, equal neighbours are repeats. Nothing is exploded or shuffled; each row is judged
in the scan's own task in O(n log n) of its length.

Defined results: null or empty texts have no words and fail (``base_failed``); texts of any length are judged whole; repeated
rows are judged alike; an empty table gives no rows; columns other than doc_id and text, whatever their names, are not read
by ``judge``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

SYMBOLS = "#*$%&|<>"
_UPPER, _ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Phrases in small letters.
# fmt: off
PHRASES = [
    "cookie", "javascript", "all rights reserved", "terms of use", "terms of service", "privacy policy", "licensed under", "released under", "lorem ipsum", "click here", "subscribe",
    "alle rechte vorbehalten", "nutzungsbedingungen", "datenschutzerkl", "impressum", "hier klicken",
    "tous droits r", "conditions d.utilisation", "mentions l.gales", "cliquez ici",
    "todos los derechos reservados", "condiciones de uso", "aviso legal", "haga clic",
]
# fmt: on
BOILERPLATE = "|".join(PHRASES)
NAVIGATION = "|>›"

#: Up to this many repeated windows are looked up one by one, more by sorting windows with their places.
FEW = 32


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _count(text: Column, characters: str) -> Column:
    """How many characters of a class there are."""
    return F.length(F.regexp_replace(text, f"[^{characters}]+", ""))


_SPACES = r"\x20\x09-\x0D"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{_SPACES}]"))


def repeated_words(words: Column) -> Column:
    """How many words lie in three-word windows that occur at least twice."""

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, k: F.when(k == F.size(places) - 1, F.lit(3)).otherwise(F.least(F.lit(3), F.get(places, k + 1) - p)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

    def by_lookup(hashes: Column, repeated: Column) -> Column:
        marked = F.transform(hashes, lambda h, i: F.when(F.array_contains(repeated, h), i))
        return F.filter(marked, lambda i: i.isNotNull())

    def by_sorting(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            ordered,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(s, lambda x, k: (x.h == F.get(s, k + 1).h).eqNullSafe(True) | (F.when(k > 0, F.get(s, k - 1).h) == x.h).eqNullSafe(True)),
                    lambda x: x.i,
                )
            ),
        )

    def of(hashes: Column) -> Column:
        repeated = let(F.sort_array(hashes), lambda s: F.array_distinct(F.filter(s, lambda h, k: F.when(k > 0, F.get(s, k - 1)) == h)))
        return let(
            repeated,
            lambda r: F.when(F.size(r) == 0, F.lit(0).cast("long")).when(F.size(r) <= FEW, let(by_lookup(hashes, r), covered)).otherwise(let(by_sorting(hashes), covered)),
        )

    def windows(w: Column) -> Column:
        places = F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    return let(let(F.transform(words, lambda w: F.xxhash64(w)), windows), of)


def may_have_phrases(text: Column) -> Column:
    """False only if the text has no phrase of BOILERPLATE: a plain search for the longest literal part of each."""
    return let(F.lower(text), lambda x: reduce(lambda a, b: a | b, [F.contains(x, F.lit(max(p.split("."), key=len))) for p in PHRASES]))


def line_passes(line: Column, phrases: Column) -> Column:
    """``phrases`` tells whether the whole text may have a phrase of BOILERPLATE."""
    size = F.length(line)
    shouts = _count(line, "!")
    fails = (
        (_count(line, NAVIGATION) >= 2)
        | (_count(line, SYMBOLS) * 10 > size)
        | (_count(line, "A-Z") * 2 > size)
        | ((shouts >= 3) & (shouts * 20 > size))
        | ((size >= 200) & ~line.rlike("[.,;:!?]"))
        | (phrases & line.rlike(f"(?i){BOILERPLATE}"))
    )
    return ~fails


def _characters(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0).cast("long"), lambda a, x: a + F.length(x))


def judge(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Statistics and verdict of every row.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    n_failed_lines, and cleaned (the remaining lines) if asked for.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    facts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.length(F.regexp_replace(text, f"[{_SPACES}]+", "")).cast("long").alias("word_chars"),
        _count(text, SYMBOLS).cast("long").alias("n_symbols"),
        let(words_of(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("repeated"))).alias("words"),
        let(
            lines_with_words(text),
            lambda x: let(
                let(may_have_phrases(text), lambda phrases: F.filter(x, lambda line: line_passes(line, phrases))),
                lambda kept: F.struct(
                    (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dups"),
                    (F.size(x) - F.size(kept)).cast("long").alias("failed"),
                    (_characters(kept) * 2 >= _characters(x)).alias("enough"),
                    *([F.array_join(kept, "\n").alias("cleaned")] if with_text else []),
                ),
            ),
        ).alias("lines"),
    )
    n, repeated = F.col("words.n"), F.col("words.repeated")
    failed = (n < 50) | (100 * repeated > 50 * n)
    return facts.select(
        "doc_id",
        n.alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("lines.dups").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"),
        failed.alias("base_failed"),
        (~failed & F.col("lines.enough")).alias("kept"),
        F.col("lines.failed").alias("n_failed_lines"),
        *([F.col("lines.cleaned").alias("cleaned")] if with_text else []),
    )


def oracle_sql() -> str:
    letters = f"'{_UPPER}', '{_ASCII_LOWER}'"

    def count(x: str, characters: str) -> str:
        # equally many replacements: an empty one would delete too, but not in every engine
        return f"(length({x}) - length(regexp_replace({x}, '[{characters}]', '', 'g')))"

    shouts = count("x", "!")
    fails = f"""({count("x", NAVIGATION)} >= 2 OR regexp_matches(translate(x, {letters}), '{BOILERPLATE}')
        OR ({shouts} >= 3 AND {shouts} * 20 > length(x)) OR {count("x", SYMBOLS)} * 10 > length(x) OR {count("x", "A-Z")} * 2 > length(x)
        OR (length(x) >= 200 AND NOT regexp_matches(x, '[.,;:!?]')))"""
    return rf"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    w AS (
      SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
    windows AS (SELECT doc_id, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS win FROM w, unnest(range(1, len(w) - 1)) AS r(i)),
    many AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows),
    covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM many, unnest([0, 1, 2]) AS o(k) WHERE n >= 2 GROUP BY doc_id),
    judged AS (
      SELECT w.doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
        length(regexp_replace(text, '[^{SYMBOLS}]+', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(c.n, 0) AS n_repeat_words,
        list_filter(lines, lambda x: {fails}) AS failing,
        coalesce(list_sum(list_transform(lines, lambda x: length(x))), 0) AS all_chars
      FROM w LEFT JOIN covered c ON c.doc_id = w.doc_id)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
      (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
      NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
        AND 2 * (all_chars - coalesce(list_sum(list_transform(failing, lambda x: length(x))), 0)) >= all_chars AS kept,
      len(failing)::BIGINT AS n_failed_lines
    FROM judged"""
