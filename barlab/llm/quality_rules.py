"""Quality rules as voters: each says good, bad or nothing, and a posterior decides. DataFrame functions only.

No rule has a veto beyond the two base tests of the contract. The rules' reliabilities are estimated
without labels from how they vote over all documents (``votes.fit``). A bad vote that good documents rarely
get weighs much, a good vote that junk gets as well weighs little.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.llm.common import whole_text
from barlab.llm.votes import beginners, fit, patterns
from barlab.session import stage

# Fixed values of the contract: white space, and the characters that count as symbols.
SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"

#: Per rule, when it votes bad and when it votes good, in SQL over a document's counts.
RULES = {
    "symbols": ("10 * n_symbols > n_words", "50 * n_symbols < n_words"),
    "repetition": ("100 * n_repeat_words > 40 * n_words", "100 * n_repeat_words < 20 * n_words"),
    "repeated_lines": ("n_lines >= 3 AND 10 * n_dup_lines > 4 * n_lines", "n_lines >= 3 AND 10 * n_dup_lines < 2 * n_lines"),
    "capitals": ("10 * n_capitals > 3 * word_chars", "10 * n_capitals < word_chars"),
    "exclamations": ("10 * n_exclamations > 2 * n_words", "20 * n_exclamations < n_words"),
    "word_length": ("word_chars < 2 * n_words OR word_chars > 12 * n_words", "10 * word_chars BETWEEN 35 * n_words AND 90 * n_words"),
    "length": ("n_words < 20", "n_words >= 100"),
}
VOTES = [f"vote_{r}" for r in RULES]
#: Before the estimation: one document in ten is bad, and a rule finds its own kind of badness nine times in ten.
START = beginners(VOTES, calm=0.9, own=0.9, other=0.1, false=0.005, edge=40.0)
KEEP_AT = 0.5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(pairs: str) -> Column:
    """Positions covered by 3-word windows whose hash occurs twice, from windows sorted by hash; 0 for null."""
    at = lambda i: F.get(F.col(pairs), i)["h"]
    twice = F.filter(F.col(pairs), lambda p, i: (p["h"] == at(i - 1)) | (p["h"] == at(i + 1)))
    starts = F.sort_array(F.transform(twice, lambda p: p["i"]))
    empty = F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(0).alias("reach"))
    covered = F.aggregate(starts, empty, lambda held, s: F.struct(
        (held["total"] + (s + 3 - F.greatest(s, held["reach"]))).alias("total"), (s + 3).alias("reach")
    ))
    return F.coalesce(covered["total"], F.lit(0).cast("bigint"))


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` and the counts that the rules read, one row per row of ``docs``.

    A 3-word window counts as found twice if two of them share a 64-bit hash of their
    words. The arrays stay inside a row, and nothing is shuffled.
    """
    body = F.col("__text")
    trimmed = F.btrim(body, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE}+"))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    cut = docs.select("doc_id", whole_text(text).alias("__text")).select(
        "doc_id", words.alias("words"), lines.alias("lines"),
        F.regexp_count(body, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.regexp_count(body, F.lit("[A-ZÀ-ÖØ-Þ]")).cast("bigint").alias("n_capitals"),
        (F.length(body) - F.length(F.replace(body, F.lit("!"), F.lit("")))).cast("bigint").alias("n_exclamations"),
    )
    nth = lambda i: F.get(F.col("words"), i)
    windows = F.transform("words", lambda w, i: F.xxhash64(w, nth(i + 1), nth(i + 2)))
    counted = cut.select(
        "*", F.size("words").cast("bigint").alias("n_words"), F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.slice(windows, F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))).alias("hashes"),
    ).drop("words", "lines")
    repeated = F.size(F.array_distinct("hashes")) < F.size("hashes")
    sort = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    paired = counted.withColumn("pairs", F.when(repeated, sort))
    return paired.withColumn("n_repeat_words", _repeat_words("pairs")).drop("hashes", "pairs")


def cast_votes(counts: DataFrame) -> DataFrame:
    """``counts`` with a column ``vote_...`` per rule: 0 good, 1 bad (an alarm), 2 abstains."""
    votes = {f"vote_{r}": F.expr(f"CASE WHEN {bad} THEN 1 WHEN {good} THEN 0 ELSE 2 END") for r, (bad, good) in RULES.items()}
    return counts.withColumns(votes)


def quality_verdicts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``p_good`` and ``kept`` per row of ``docs``.

    ``base_failed``: fewer than 50 words, or over half of them in repeated windows; such a document is never
    kept. The others are kept if the posterior that they are good is at least ``KEEP_AT``. A null or empty text
    has no words and fails. Rows count by themselves, whether they repeat or lack an id. Other columns are
    ignored, whatever their names. An empty table gives an empty one.
    """
    voted = cast_votes(text_counts(docs, text))
    counted = stage(voted.select("doc_id", *COUNTS, *VOTES), "votes")
    model = fit(stage(patterns(counted, VOTES), "patterns"), START)
    failed = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    judged = counted.select("doc_id", *COUNTS, failed.alias("base_failed"), model.calm().alias("p_good"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= KEEP_AT))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`quality_verdicts` would keep, with all their columns.

    The rows are written once with their votes: a filter on the votes' expressions would be pushed below the
    projections that build their arrays, and would build them once per element.
    """
    columns = docs.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in columns])
    voted = cast_votes(text_counts(docs.select(whole.alias("doc_id"), F.col(f"`{text}`").alias("text"))))
    written = stage(voted.select("doc_id", "n_words", "n_repeat_words", *VOTES), "votes")
    model = fit(stage(patterns(written, VOTES), "patterns"), START)
    good = F.expr("n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words") & (model.calm() >= KEEP_AT)
    return written.where(good).select(*[F.col("doc_id").getField(c).alias(c) for c in columns])
