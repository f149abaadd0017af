"""Phrase collocation mining with an FM-index per shard.

Each task turns the texts it reads into shards: the words of one language as local numbers, with a zero between
pieces and between texts. A shard is kept as two Burrows-Wheeler strings, of the sequence and of its reverse, whose
suffixes are sorted by their first ``depth`` words only; with the word counts each is a complete FM-index. An
interval of such an index is a phrase, its length the phrase's count, and the symbols in it are the words the phrase
can be extended by: to the left in the index of the sequence, to the right in that of the reverse. Both intervals of a
phrase are carried along, so steps to either side alternate without a search.

Counts are summed across shards, one phrase length after the other. A phrase that occurs often consists of phrases
that do, so a shard goes on only with phrases that may be among the frequent ones of the length before. It asks a Bloom
filter of fixed size; what passes by mistake is dropped after the sum, so results are exact however full the filter is.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.llm.common import ship_package, slices, whole_text
from barlab.operators.panel import number_rows
from barlab.session import stage

#: Words and breaks of a shard, at least while a task has that many of a language; more go to a further shard.
SHARD_WORDS = 500_000
SHARDS_PER_FILE = 2
#: Bits of the filter that shards ask. It is sent to every task (4 MB), whatever the corpus.
FILTER_BITS = 1 << 25
#: What an end of a piece becomes before the text is cut at white space.
BREAK = b"."
_FROM = bytes(range(65, 91)) + b"\t" + b".,;:!?\n\x0b\x0c\r"
_TO = bytes(range(97, 123)) + b" " + BREAK * 10
LETTERS = bytes.maketrans(_FROM, _TO)


# Shards -------------------------------------------------------------------------


class Words:
    """Texts of one language as numbers, in the order in which words are first seen; 0 is a break."""

    def __init__(self) -> None:
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.numbers[BREAK]
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, texts: list[bytes]) -> None:
        found = BREAK.join([b"", *texts, b""]).translate(LETTERS).replace(BREAK, b" . ").split()
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found)))
        self.size += len(found)

    def sequence(self) -> np.ndarray:
        return np.concatenate(self.parts)


def suffix_order(sequence: np.ndarray, depth: int, kinds: int) -> np.ndarray:
    """Positions in the order of the ``depth`` symbols from each on; the sequence is read as a ring."""
    key, top = sequence.astype(np.int64), kinds
    for d in range(1, depth):
        if top * kinds >= 1 << 62:
            key, top = np.unique(key, return_inverse=True)[1].astype(np.int64), len(sequence)
        key, top = key * kinds + np.roll(sequence, -d), top * kinds
    return np.argsort(key)


def transform(sequence: np.ndarray, depth: int, kinds: int) -> np.ndarray:
    """The symbol before each suffix, in the order of the suffixes."""
    return sequence[suffix_order(sequence, depth, kinds) - 1]


def packed(symbols: np.ndarray, kinds: int) -> bytes:
    """As many bytes a symbol as the largest one needs, lowest byte first."""
    return symbols.astype("<i4").view(np.uint8).reshape(-1, 4)[:, : _width(kinds)].tobytes()


def unpacked(data: bytes, kinds: int) -> np.ndarray:
    width = _width(kinds)
    out = np.zeros((len(data) // width, 4), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<i4").ravel()


def _width(kinds: int) -> int:
    return 2 if kinds <= 1 << 16 else 3 if kinds <= 1 << 24 else 4


def build_shards(docs: DataFrame, depth: int, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``lang, words, counts, before, after``: an FM-index per shard of ``docs(lang, text)``.

    ``words[i]`` and ``counts[i]`` belong to number ``i + 1``; ``before`` and ``after`` are the transforms of the
    sequence and of its reverse, packed by :func:`packed`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, Words] = {}

        def closed(lang: str) -> pa.RecordBatch:
            held = open_.pop(lang)
            sequence, kinds = held.sequence(), len(held.numbers)
            words = [w.decode() for w in held.numbers][1:]
            columns = [
                pa.array([lang]), pa.array([words], pa.list_(pa.string())),
                pa.array([np.bincount(sequence, minlength=kinds)[1:]], pa.list_(pa.int64())),
                *(pa.array([packed(transform(s, depth, kinds), kinds)], pa.binary()) for s in (sequence, sequence[::-1])),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "words", "counts", "before", "after"])

        for batch in slices(batches):
            texts: dict[str, list[bytes]] = defaultdict(list)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                texts[lang].append(text)
            for lang, some in texts.items():
                open_.setdefault(lang, Words()).add(some)
                if open_[lang].size >= shard_words:
                    yield closed(lang)
            while sum(w.size for w in open_.values()) >= 2 * shard_words:  # very many languages
                yield closed(max(open_, key=lambda k: open_[k].size))
        for lang in list(open_):
            yield closed(lang)

    ship_package(docs.sparkSession)
    return docs.select("lang", "text").mapInArrow(
        run, "lang string, words array<string>, counts array<bigint>, before binary, after binary"
    )


# Intervals ----------------------------------------------------------------------


@dataclass
class Phrases:
    """Phrases of one length: their words, and their intervals in the index of the sequence and of its reverse."""

    words: list[np.ndarray]
    low: np.ndarray
    size: np.ndarray
    other: np.ndarray

    def where(self, kept: np.ndarray) -> Phrases:
        return Phrases([w[kept] for w in self.words], self.low[kept], self.size[kept], self.other[kept])

    def turned(self) -> Phrases:
        return Phrases(self.words, self.other, self.size, self.low)


class Index:
    """One Burrows-Wheeler string: where its symbols lead."""

    def __init__(self, string: np.ndarray, kinds: int) -> None:
        n = len(string)
        self.counts = np.bincount(string, minlength=kinds)
        self.first = np.cumsum(self.counts) - self.counts
        order = np.sort(string.astype(np.int64) * n + np.arange(n)) % n
        self.to = np.empty(n, np.int32)
        self.to[order] = np.arange(n, dtype=np.int32)
        self.symbol = np.repeat(np.arange(kinds, dtype=np.int32), self.counts)

    def extend(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Every interval extended by every symbol found in it: parent, symbol, low, size, other low.

        All positions of the intervals are led on at once. Those of one symbol and parent then lie together: that run
        is the interval of the longer phrase.
        """
        start = np.cumsum(phrases.size) - phrases.size
        inside = np.repeat((phrases.low - start).astype(np.int32), phrases.size)
        inside += np.arange(len(inside), dtype=np.int32)
        owner = np.full(len(self.to), -1, np.int32)
        owner[self.to[inside]] = np.repeat(np.arange(len(phrases.low), dtype=np.int32), phrases.size)
        del inside
        at = np.flatnonzero(owner >= 0)
        parents, symbols = owner[at], self.symbol[at]
        new = np.ones(len(at), bool)
        new[1:] = (parents[1:] != parents[:-1]) | (symbols[1:] != symbols[:-1])
        first = np.flatnonzero(new)
        parent, symbol, low = parents[first], symbols[first], at[first]
        size = np.diff(np.append(first, len(at)))
        # On the other side a parent's extensions lie one after the other, in the order of their symbols.
        order = np.argsort(parent, kind="stable")
        sizes = size[order]
        ahead = np.cumsum(sizes) - sizes
        ahead -= start[parent[order]]
        other = np.empty(len(parent), np.int64)
        other[order] = phrases.other[parent[order]] + ahead
        return parent, symbol, low, size, other


class Shard:
    def __init__(self, before: bytes, after: bytes, kinds: int) -> None:
        self.sides = [Index(unpacked(x, kinds), kinds) for x in (before, after)]

    def single(self) -> Phrases:
        """All words, without the break."""
        index = self.sides[0]
        words = np.flatnonzero(index.counts[1:]) + 1
        return Phrases([words.astype(np.int32)], index.first[words], index.counts[words], self.sides[1].first[words])

    def to_left(self, phrases: Phrases) -> Phrases:
        parent, symbol, low, size, other = self.sides[0].extend(phrases)
        longer = Phrases([symbol, *(w[parent] for w in phrases.words)], low, size, other)
        return longer.where(symbol > 0)

    def to_right(self, phrases: Phrases) -> Phrases:
        parent, symbol, low, size, other = self.sides[1].extend(phrases.turned())
        longer = Phrases([*(w[parent] for w in phrases.words), symbol], other, size, low)
        return longer.where(symbol > 0)

    def phrases(self, length: int, filters: Sequence[Filter], ids: np.ndarray) -> Phrases:
        """Phrases of ``length`` whose shorter parts all pass the filters of their lengths."""
        found = self.single()
        for n in range(1, length + 1):
            if n > 1:
                found = (self.to_left if n % 2 == 0 else self.to_right)(found)
                # The part without the new word was asked before; the other one of that length is new.
                part = found.words[:-1] if n % 2 == 0 else found.words[1:]
                found = found.where(filters[n - 2].holds([ids[w] for w in part]))
            if n < length:
                found = found.where(filters[n - 1].holds([ids[w] for w in found.words]))
        return found


# The filter ---------------------------------------------------------------------


def places(ids: Sequence[np.ndarray], bits: int) -> list[np.ndarray]:
    """Three places in a filter of ``bits`` bits (a power of two) for phrases given by their words' ids."""
    h = np.zeros(len(ids[0]), np.uint64)
    for x in ids:
        h = (h ^ x.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return [((h >> np.uint64(s)) & np.uint64(bits - 1)).astype(np.int64) for s in (0, 18, 36)]


@dataclass
class Filter:
    cells: np.ndarray
    bits: int

    def holds(self, ids: Sequence[np.ndarray]) -> np.ndarray:
        kept = np.ones(len(ids[0]), bool)
        for p in places(ids, self.bits):
            kept &= (self.cells[p >> 6] >> (p & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
        return kept


def make_filter(frequent: DataFrame, length: int, bits: int = FILTER_BITS) -> Filter:
    """The filter of ``frequent(w1, ..., wn)``, put together by cells; the driver gets ``bits / 8`` bytes at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.concatenate(places([c.to_numpy() for c in batch.columns], bits))
            yield pa.RecordBatch.from_arrays([pa.array(found >> 6), pa.array(np.left_shift(1, found & 63))], names=["cell", "bit"])

    set_ = frequent.select(*_names(length)).mapInArrow(run, "cell bigint, bit bigint")
    rows = set_.groupBy("cell").agg(F.bit_or("bit").alias("bit")).toArrow()
    cells = np.zeros(bits >> 6, np.uint64)
    cells[rows.column("cell").to_numpy()] = rows.column("bit").to_numpy().view(np.uint64)
    return Filter(cells, bits)


# Counts over all shards -----------------------------------------------------------


def _names(length: int, first: int = 1) -> list[str]:
    return [f"w{i}" for i in range(first, first + length)]


def count_words(shards: DataFrame) -> tuple[DataFrame, int]:
    """``lang, word, id, n`` over all shards, and the seed under which no two words share an id.

    The id is a hash of language and word. Two words with the same one would be counted as one, so such a seed is
    passed over.
    """
    each = shards.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("e"))
    total = stage(each.groupBy("lang", F.col("e.words").alias("word")).agg(F.sum("e.counts").alias("n")), "words")
    seed = 0
    while True:
        words = total.withColumn("id", _word_id(seed, F.col("word")))
        if words.groupBy("id").agg(F.count(F.lit(1)).alias("same")).where("same > 1").isEmpty():
            return words, seed
        seed += 1


def _word_id(seed: int, word: Column) -> Column:
    return F.xxhash64(F.lit(seed), F.col("lang"), word)


def count_phrases(shards: DataFrame, length: int, filters: Sequence[Filter], seed: int) -> DataFrame:
    """``w1, ..., wn, a``: phrases of ``length`` words and their counts over all shards.

    Phrases with a part that is not frequent may be missing.
    """
    sent = shards.sparkSession.sparkContext.broadcast(list(filters))
    names = _names(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.append(0, batch.column(0)[i].values.to_numpy())
                shard = Shard(batch.column(1)[i].as_py(), batch.column(2)[i].as_py(), len(ids))
                found = shard.phrases(length, sent.value, ids)
                rows = [pa.array(ids[w]) for w in found.words] + [pa.array(found.size.astype(np.int64))]
                whole = pa.RecordBatch.from_arrays(rows, names=[*names, "a"])
                for start in range(0, whole.num_rows, 100_000):
                    yield whole.slice(start, 100_000)

    ids = F.transform("words", lambda w: _word_id(seed, w)).alias("ids")
    found = shards.select(ids, "before", "after").mapInArrow(run, ", ".join(f"{c} bigint" for c in [*names, "a"]))
    return found.groupBy(*names).agg(F.sum("a").alias("a"))


def frequent_phrases(
    docs: DataFrame, longest: int, fewest: int, shard_words: int = SHARD_WORDS, filter_bits: int = FILTER_BITS
) -> list[DataFrame]:
    """Staged tables of the words and phrases with at least ``fewest`` occurrences, by length.

    The first has ``lang, word, w1, a`` of every word; the others ``w1, ..., wn, a``.
    """
    # Small files, so that a task that counts phrases takes few shards and holds few counts before they are shuffled.
    shards = stage(build_shards(docs, longest, shard_words), "shards", maxRecordsPerFile=SHARDS_PER_FILE)
    words, seed = count_words(shards)
    tables = [words.select("lang", "word", F.col("id").alias("w1"), F.col("n").alias("a"))]
    filters: list[Filter] = []
    for n in range(2, longest + 1):
        filters.append(make_filter(tables[-1].where(F.col("a") >= fewest), n - 1, filter_bits))
        found = count_phrases(shards, n, filters, seed)
        tables.append(stage(found.where(F.col("a") >= fewest), f"phrases{n}"))
    return tables


# Collocations ---------------------------------------------------------------------


def _exact(*factors: str | int) -> Column:
    """A product as a whole number of up to 38 digits."""
    out = F.lit(1).cast("decimal(38,0)")
    for f in factors:
        out = (out * (F.lit(f) if isinstance(f, int) else F.col(f)).cast("decimal(18,0)")).cast("decimal(38,0)")
    return out


def scored(tables: Sequence[DataFrame], length: int) -> DataFrame:
    """Phrases of one length with the parts and the score of their weakest cut: ``w1, ..., a, l, r, score``."""
    rows = tables[length - 1].select(*_names(length), "a")
    for k in range(1, length):
        left = tables[k - 1].select(*_names(k), F.col("a").alias(f"l{k}"))
        right = tables[length - k - 1].select(
            *[F.col(f"w{i}").alias(f"w{i + k}") for i in range(1, length - k + 1)], F.col("a").alias(f"r{k}")
        )
        rows = rows.join(left, _names(k)).join(right, _names(length - k, k + 1))
        rows = rows.withColumns({"_up": _exact(1_000_000, "a", "a"), "_down": _exact(f"l{k}", f"r{k}")})
        rows = rows.withColumn(f"s{k}", F.expr("_up div _down"))
    cuts = [F.struct(F.col(f"s{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
            for k in range(1, length)]
    least = F.array_min(F.array(*cuts))
    return rows.select(*_names(length), "a", least.alias("_cut")).select(*_names(length), "a", "_cut.l", "_cut.r", "_cut.score")


def without_absorbed(rows: DataFrame, longer: DataFrame, length: int, percent: int) -> DataFrame:
    """Rows less those of which an extension by one word has ``percent`` of the occurrences or more.

    If a phrase longer by several words has that many, so has the one between, so one word is enough.
    """
    sides = [
        longer.select(*[F.col(f"w{i + s}").alias(f"w{i}") for i in range(1, length + 1)], F.col("a").alias("_longer")) for s in (0, 1)
    ]
    most = sides[0].unionByName(sides[1]).groupBy(*_names(length)).agg(F.max("_longer").alias("_longer"))
    taken = F.coalesce(F.col("_longer") * 100 >= F.col("a") * percent, F.lit(False))
    return rows.join(most, _names(length), "left").where(~taken).drop("_longer")


def mine_collocations(
    docs: DataFrame,
    longest: int = 3,
    fewest: int = 10,
    percent: int = 50,
    top: int | None = 2_000,
    text: str = "text",
    lang: str = "lang",
    shard_words: int = SHARD_WORDS,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """The ``top`` phrases of each language by score: ``lang, rank, phrase, a, l, r, n, score``; all of them for None.

    Phrases of 2 to ``longest`` words with ``a >= fewest`` occurrences compete. ``l`` and ``r`` are the counts of the two parts of
    the cut with the lowest score, ``floor(10^6 a^2 / (l r))``, and ``n`` the language's words. Phrases that an
    extension with at least ``percent`` of their occurrences contains are left out. Ties: more occurrences first, then byte order.

    A null text is empty, a null language is ``und`` (and counts with a language of that name). Empty texts and an
    empty table have no phrases. Repeated rows count as often as they are there. A text of any length is read whole. Other
    columns are not looked at, whatever their names.
    """
    rows = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), whole_text(text).alias("text"))
    tables = frequent_phrases(rows, longest, fewest, shard_words, filter_bits)
    words = tables[0]
    sizes = words.groupBy("lang").agg(F.sum("a").alias("n"))
    known = words.where(F.col("a") >= fewest)
    found = []
    for n in range(2, longest + 1):
        kept = scored([known, *tables[1:]], n)
        if n < longest:
            kept = without_absorbed(kept, tables[n], n, percent)
        for i in range(1, n + 1):
            name = known.select(F.col("w1").alias(f"w{i}"), F.col("word").alias(f"_word{i}"), *["lang"][: i == 1])
            kept = kept.join(name, f"w{i}")
        phrase = F.concat_ws(" ", *[f"_word{i}" for i in range(1, n + 1)])
        found.append(kept.select("lang", phrase.alias("phrase"), "a", "l", "r", "score"))
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    # Ranked by a sort over all tasks: a language may hold most of the phrases.
    order = {"_low": -F.col("score"), "_few": -F.col("a")}
    ranked = number_rows(whole.withColumns(order), ["lang"], [*order, "phrase"], out="_place", total="_all", name="ranked")
    if top is not None:
        ranked = ranked.where(F.col("_place") < top)
    return ranked.join(sizes, "lang").select("lang", (F.col("_place") + 1).alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: The same by SQL, for three words at most; ``phrase`` is unique since words hold no spaces.
ORACLE = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (
  SELECT lang, d, ws[i:i + d - 1] AS g
  FROM (SELECT lang, ws, d, unnest(range(1, len(ws) - d + 2)) AS i FROM w, (VALUES (1), (2), (3)) v(d))),
f AS (SELECT lang, d, array_to_string(g, ' ') AS phrase, any_value(g) AS g, CAST(count(*) AS HUGEINT) AS a FROM g GROUP BY ALL),
size AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE d = 1 GROUP BY lang),
cand AS (SELECT * FROM f WHERE d > 1 AND a >= 10),
cut AS (
  SELECT c.lang, c.phrase, c.d, c.a, k, x.a AS l, y.a AS r, (CAST(1000000 AS HUGEINT) * c.a * c.a) // (x.a * y.a) AS score
  FROM (SELECT *, unnest(range(1, d)) AS k FROM cand) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.g[1:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.g[c.k + 1:c.d], ' ')),
weakest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (
  SELECT lang, array_to_string(g[1:2], ' ') AS phrase, a FROM cand WHERE d = 3
  UNION ALL SELECT lang, array_to_string(g[2:3], ' '), a FROM cand WHERE d = 3),
longer AS (SELECT lang, phrase, max(a) AS most FROM parts GROUP BY lang, phrase)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM weakest LEFT JOIN longer USING (lang, phrase) JOIN size USING (lang)
WHERE coalesce(100 * most < 50 * a, true)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000"""
