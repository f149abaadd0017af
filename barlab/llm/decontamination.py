"""Benchmark decontamination by a prefix-filtered join of shingles. DataFrame functions only.

An item's windows (``window`` consecutive words; a shorter item is one window) are looked for in documents. A
window of ``n`` words is a sequence of word shingles. A document that contains the window contains every
one of them, so a prefix of one shingle is enough to find it:

1. Count over all documents every shingle that occurs in a window, in one pass that keeps the places.
2. Order each window's shingles by rarity and take the rarest. A window with a shingle that no document has is done.
3. Join the places of these shingles. The shingle's offset in the window gives
   the place where the window would start; it must not lie before the first word, nor end after the last.
4. Verify: the document's words there are the window's words, one by one.

Arrays are exploded with their ``outer`` forms: the plain ones let Spark add a filter on the array's size, which
would evaluate its expressions once more per element. Shingles are compared by hash up to step 3, and words in step 4. Texts are named by 128 bits,
so copies of a text are looked at once from step 2 on.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barlab.llm.common import broadcast_if_small, row_keys, whole_text
from barlab.session import stage

WINDOW = 10
SHINGLE = 3
# Fixed values of the contract: a word, after and before A-Z are lower-cased. The classes are written by what they
# hold; Java takes nearly three times as long for the same ones written by what they leave out.
WORD = r"[0-9a-z\x80-\x{10FFFF}]+"
ANY_CASE_WORD = r"[0-9A-Za-z\x80-\x{10FFFF}]+"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else; ``lower`` does that, faster, for texts of single bytes."""
    single = F.octet_length(text) == F.char_length(text)
    return F.when(single, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


#: Windows, in rows, that are sent to every task at most: some 30 MB with their words.
WINDOW_ROWS = 100_000


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``win, words, item_id``: the different windows of every item, numbered by a hash of their words."""
    listed = items.select("item_id", word_list(whole_text()).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    cut = listed.select("item_id", "words", F.explode_outer(starts).alias("at"))
    words = cut.select("item_id", F.slice("words", F.col("at"), F.lit(window)).alias("words")).distinct()
    return words.select(F.sha2(F.array_join("words", " "), 256).alias("win"), "words", "item_id")


def _shingles(words: str, length: int) -> Column:
    """Hashes of all shingles of ``length`` words, by position; the last ones run over the end and match none."""
    following = lambda i: [F.get(F.col(words), i + k) for k in range(1, length)]
    return F.transform(F.col(words), lambda w, i: F.xxhash64(F.lit(length), w, *following(i), F.get(F.col(words), i)))


def window_shingles(windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``win, n, length, offset, h``: the shingles of every window; one that is shorter than a shingle is one itself."""
    sized = windows.select("win", "words", F.size("words").alias("n")).dropDuplicates(["win"])
    parts = []
    for length in range(1, shingle + 1):
        fits = F.col("n") == length if length < shingle else F.col("n") >= length
        listed = sized.where(fits).select("win", "n", F.posexplode_outer(_shingles("words", length)).alias("offset", "h"))
        parts.append(listed.where(F.col("offset") <= F.col("n") - length).withColumn("length", F.lit(length)))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found


def shingle_places(docs: DataFrame, wanted: DataFrame, lengths: list[int]) -> DataFrame:
    """``k1, k2, n_words, pos, h``: every place in ``docs`` of a shingle in ``wanted(h)``."""
    listed = docs.select(*row_keys(F.col("text")), word_list(F.col("text")).alias("words"))
    found = None
    for length in lengths:
        hashes = listed.select("k1", "k2", F.size("words").alias("n_words"), _shingles("words", length).alias("hashes"))
        places = hashes.select("k1", "k2", "n_words", F.posexplode_outer("hashes").alias("pos", "h")).join(wanted, "h", "left_semi")
        found = places if found is None else found.unionByName(places)
    return found


def window_matches(docs: DataFrame, windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``k1, k2, start, n, win``: every occurrence of a window in the different texts of ``docs(text)``."""
    shingles = stage(window_shingles(windows, shingle), "shingles")
    lengths = sorted(r.length for r in shingles.select("length").distinct().collect())  # at most ``shingle`` numbers
    if not lengths:
        return docs.select(*row_keys(F.col("text"))).limit(0).select(
            "k1", "k2", F.lit(0).alias("start"), F.lit(0).alias("n"), F.lit("").alias("win")
        )
    wanted = broadcast_if_small(stage(shingles.select("h").distinct(), "wanted"))
    places = stage(shingle_places(docs, wanted, lengths), "places")
    counts = places.groupBy("h").agg(F.count(F.lit(1)).alias("found"))
    rarest = Window.partitionBy("win").orderBy(F.coalesce("found", F.lit(0)), "h", "offset")
    ordered = shingles.join(counts, "h", "left").withColumn("nth", F.row_number().over(rarest))
    prefixes = stage(ordered.where("nth = 1 and found is not null").select("win", "n", "offset", "h"), "prefixes")
    near = places.join(broadcast_if_small(prefixes), "h").select(
        "k1", "k2", (F.col("pos") - F.col("offset")).alias("start"), "n", "win", "n_words"
    )
    bounded = near.where("start >= 0 and start + n <= n_words").select("k1", "k2", "start", "n", "win").distinct()
    candidates = stage(bounded, "candidates")
    # Only the texts with a candidate are split again, each once.
    named = docs.select(*row_keys(F.col("text")), "text")
    texts = named.join(broadcast_if_small(stage(candidates.select("k1", "k2").distinct(), "named")), ["k1", "k2"], "left_semi")
    listed = texts.dropDuplicates(["k1", "k2"]).select("k1", "k2", word_list(F.col("text")).alias("words"))
    of_text = candidates.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "n", "win")).alias("near"))
    cut = F.transform("near", lambda c: F.struct(
        c["start"].alias("start"), c["n"].alias("n"), c["win"].alias("win"),
        F.slice(F.col("words"), c["start"] + 1, c["n"]).alias("seen"),
    ))
    seen = listed.join(of_text, ["k1", "k2"]).select("k1", "k2", F.inline_outer(cut))
    # A window's key and its words take some 300 bytes, ten times as much as other tables' rows.
    different = broadcast_if_small(stage(windows.dropDuplicates(["win"]).select("win", "words"), "windows"), WINDOW_ROWS)
    return seen.join(different, "win").where(F.col("seen") == F.col("words")).select("k1", "k2", "start", "n", "win")


def _covered(spans: Column) -> Column:
    """Positions covered by sorted spans ``(start, end)``."""
    empty = F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(0).alias("reach"))
    return F.aggregate(spans, empty, lambda held, s: F.struct(
        (held["total"] + F.greatest(s["end"] - F.greatest(s["start"], held["reach"]), F.lit(0))).alias("total"),
        F.greatest(held["reach"], s["end"]).alias("reach"),
    ))["total"]


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` and the list ``items`` per row of ``docs``.

    A word is hit if it lies in an occurrence of a window of any item. ``items`` are the ids, as
    strings and sorted as such, of the items with a window in the text. A null or empty text has no
    words and is clean. Rows of ``items`` may repeat; one without an id hits words but is not listed, one without words
    hits none. Each row of ``docs`` keeps its line, also when ids repeat or are null. Other
    columns are ignored. Either table may be empty.
    """
    texts = docs.select("doc_id", whole_text().alias("text"))
    windows = stage(item_windows(items, window), "windows")
    matches = stage(window_matches(texts, windows, shingle), "matches")
    spans = F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end"))))
    hits = matches.groupBy("k1", "k2").agg(spans.alias("spans")).select("k1", "k2", _covered(F.col("spans")).alias("n_hit"))
    owners = windows.where("item_id is not null").select("win", F.col("item_id").cast("string").alias("item"))
    listed = matches.select("k1", "k2", "win").distinct().join(broadcast_if_small(stage(owners, "owners")), "win")
    named = listed.groupBy("k1", "k2").agg(F.sort_array(F.collect_set("item")).alias("items"))
    found = stage(hits.join(named, ["k1", "k2"], "left"), "hits")
    rows = texts.select("doc_id", *row_keys(F.col("text")), F.regexp_count("text", F.lit(ANY_CASE_WORD)).cast("bigint").alias("n_words"))
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(broadcast_if_small(found, 100_000), ["k1", "k2"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(ids).cast("bigint").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), ids.alias("items"),
    )


def keep_clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` without a hit word, all columns as they are; repeated rows stay or go together."""
    windows = stage(item_windows(items, window), "windows")
    texts = docs.select(whole_text().alias("text"))
    dirty = stage(window_matches(texts, windows, shingle).select("k1", "k2").distinct(), "dirty")
    k1, k2 = row_keys(whole_text())
    named = docs.withColumns({"__k1": k1, "__k2": k2})
    dirty = broadcast_if_small(dirty.select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")))
    return named.join(dirty, ["__k1", "__k2"], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


# Where an occurrence of a window is, in plain SQL: all windows of a document against all windows of the items.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[p : p + 9], ' ') AS t, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
dw AS (
  SELECT r, p, n, array_to_string(w[p : p + n - 1], ' ') AS t
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
m AS (SELECT dw.r, dw.p, dw.n, win.item_id FROM dw JOIN win USING (t, n)),
h AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM m) GROUP BY r),
s AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN s USING (r)
"""
