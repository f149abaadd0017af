"""Token ids as Parquet files: list columns, dictionary and delta encoding, page indexes.

A token store is a folder with two tables:

``tokens``  one row per document in ascending order of ``doc_id``: ``part``, ``doc_id``,
            ``local_start`` (ids before it in its part), ``n_tokens``, ``tokens`` (a list of ids).
            Ids are dictionary encoded; the other columns, which rise slowly or vary
            little, are delta encoded. Row groups and pages are small and pages
            carry an index, so a read of some documents opens few pages, and a read of the metadata
            opens no page of ids.
``parts``   one row per part: ``part``, ``base`` (ids in the parts before it), ``n_docs``, ``n_ids``.

A document's start in the whole stream is ``base + local_start``, so no pass over
the ids is needed to number them, and no task sees more than its part.

Encoding keeps, in each Python worker, a table of the distinct lower-cased words between white space and
their ids. Words that the table lacks are split by the tokenizer's own pattern
and the distinct pieces go through the tokenizer's merges once. Only texts
made of the letters in ``PLAIN`` take that way, since for them the tokenizer's
normaliser is a lower-casing; all others are encoded by the tokenizer as a whole.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit

from barlab.llm.common import ship_package, slices, whole_text

#: Words and pieces in a worker's table before a new one is begun: some 120 MB. It outlives a task, since much of
#: the time goes into words that a worker sees for the first time.
TABLE_WORDS = 600_000
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 128 << 10
PAGE_ROWS = 2_000
#: Words joined into one text for the merges.
JOINED_WORDS = 64

# The split pattern of the word vocabulary, for texts of the letters in PLAIN.
LETTERS = "a-zß-öø-ÿĀ-ſ"
PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\\s0-9{LETTERS}]+")
#: Characters that are only lower-cased by the normaliser, and white space that every library sees alike.
NOT_PLAIN = re.compile("[^\t\n\x0b\x0c\r -~À-ÖØ-öø-įıĲ-ňŊ-ž]")
#: A sign before a full stop or comma at a word's end: they are one piece then, and must not be cut apart.
STUCK = re.compile("[!-/:-@\\[-`{-~][.,][ \n]")
#: How the vocabulary's special tokens begin.
SPECIAL = "<|"
#: Stands for the end of a text among its words; no word is white space.
END = "\n"


class WordIds:
    """Ids of lower-cased words between white space.

    Words are numbered as they come; a number's ids are a run in one array, so that the ids of a slice of texts are gathered
    from it without an object per word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; idle threads would wait busily
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = False
        self.merges = Tokenizer(self.whole.model)
        self.merges.pre_tokenizer = WhitespaceSplit()
        if hasattr(self.merges.model, "_resize_cache"):
            self.merges.model._resize_cache(0)  # a piece comes once: the table is the cache
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        suffix = self.whole.model.end_of_word_suffix
        self.ends = np.zeros(max(self.whole.get_vocab().values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        self.shapes = str.maketrans({chr(b): _shape(b) for b in range(256) if b != 32})  # a space stands between pieces
        self.plain = self._splits_alike()
        self.forget()

    def forget(self) -> None:
        """An empty table: words and their pieces by number, and where the ids of each number lie."""
        self.numbers: defaultdict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.numbers[END]
        self.size, self.used = 1, 0  # numbers that have ids, and ids in use
        self.flat = np.empty(1 << 16, np.int32)
        self.start, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _splits_alike(self) -> bool:
        """Whether this vocabulary is of the kind that ``PIECE`` describes."""
        probe = "It's a Täst, 42 of THEM'LL\n(x)--y ŒUVRE I'd"
        pieces = PIECE.findall(probe.lower())
        return self.whole.encode(probe, add_special_tokens=False).ids == [
            i for p in pieces for i in self.merges.encode(p.encode().decode("latin-1").translate(self.shapes)).ids
        ]

    def merged(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, many in one text, and how many each has; a piece ends with a token that ends a word."""
        joined = [
            " ".join(pieces[i : i + JOINED_WORDS]).encode().decode("latin-1").translate(self.shapes)
            for i in range(0, len(pieces), JOINED_WORDS)
        ]
        found = self.merges.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.concatenate([np.asarray(x.ids, np.int32) for x in found])
        counts = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        if len(counts) != len(pieces) or counts.sum() != len(ids):
            raise ValueError("a word of this vocabulary does not end with the end-of-word suffix")
        return ids, counts

    def store(self, numbers: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Keep the ids of some numbers, which lie one after the other in ``ids``."""
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while len(numbers) and numbers.max() >= len(self.start):
            self.start, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.count))
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[numbers] = self.used + np.cumsum(counts) - counts
        self.count[numbers] = counts
        self.used += len(ids)

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``numbers``, one after the other, and how many each has."""
        counts = self.count[numbers]
        at = np.repeat(self.start[numbers] - (np.cumsum(counts) - counts), counts)
        at += np.arange(len(at))
        return self.flat[at], counts

    def learn(self) -> None:
        """Give ids to the words that have a number since the last call, and to pieces that are new with them."""
        words = list(islice(reversed(self.numbers), len(self.numbers) - self.size))[::-1]
        first, whole, cut = self.size, [], []
        for i, w in enumerate(words, first):
            pieces = None if w.isalpha() else PIECE.findall(w)
            if pieces is None or len(pieces) == 1:
                whole.append(i)
            else:
                cut.append((i, list(map(self.numbers.__getitem__, pieces))))
        more = list(islice(reversed(self.numbers), len(self.numbers) - first - len(words)))[::-1]
        if whole or more:
            new = np.array([*whole, *range(first + len(words), len(self.numbers))])
            self.store(new, *self.merged([*(words[i - first] for i in whole), *more]))
        if cut:
            ids, counts = self.gather(np.concatenate([np.array(c) for _, c in cut]))
            ends = np.cumsum([len(c) for _, c in cut])
            self.store(np.array([i for i, _ in cut]), ids, np.diff(np.cumsum(counts)[ends - 1], prepend=0))
        self.size = len(self.numbers)

    def encode_flat(self, texts: list[str], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other and each with ``end`` behind it, and how many every text has."""
        if len(self.numbers) > TABLE_WORDS:
            self.forget()
        self.store(np.zeros(1, np.int64), np.array([] if end is None else [end], np.int32), np.array([0 if end is None else 1]))
        number, numbered, odd = self.numbers.__getitem__, [], []
        for i, t in enumerate(texts):
            if self.plain and SPECIAL not in t and not NOT_PLAIN.search(t):
                words = _cut(t)
                words.append(END)
                numbered.append(np.fromiter(map(number, words), np.int64, len(words)))
            else:
                numbered.append(None)
                odd.append(i)
        self.learn()
        used = self.used
        # Texts that are encoded as a whole have numbers behind those of the table, for this call only.
        for k, i in enumerate(odd):
            ids = np.asarray(self.whole.encode(texts[i], add_special_tokens=False).ids, np.int32)
            self.store(np.array([self.size + k]), ids, np.array([len(ids)]))
            numbered[i] = np.array([self.size + k, 0])
        ids, counts = self.gather(np.concatenate(numbered)) if numbered else (self.flat[:0], np.zeros(0, np.int64))
        ends = np.cumsum([len(x) for x in numbered], dtype=np.int64)
        self.used = used
        return ids, np.diff(np.cumsum(counts)[ends - 1], prepend=0)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text as bytes of 32-bit integers."""
        ids, counts = self.encode_flat(texts)
        ends = np.cumsum(counts)
        return [ids[b - n : b].astype("<u4").tobytes() for n, b in zip(counts, ends)]


def _cut(text: str) -> list[str]:
    """Lower-cased words between white space, with a full stop or comma at their end as a word of its own.

    Most words are a single piece then, and the table of words holds few of them twice.
    """
    text = text.lower()
    if not STUCK.search(text):
        text = text.replace(". ", " . ").replace(", ", " , ").replace(".\n", " . ")
    return text.split()


def _shape(byte: int) -> str:
    """The visible character by which byte-level vocabularies write a byte."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return chr(byte) if byte in visible else chr(256 + [b for b in range(256) if b not in visible].index(byte))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """The vocabulary, loaded once per Python worker."""
    return WordIds(path)


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, end_id: int, text: str = "text", partitions: int | None = None
) -> None:
    """Write the ids of every text to a token store at ``path``, a folder that all executors share.

    ``vocabulary`` is a file of the tokenizers library that every machine has. Each
    document's ids are followed by ``end_id``. Documents are ordered by
    ``doc_id``, null first; rows of equal ``doc_id`` by a hash of the text, and
    a position spreads rows that are alike over parts. A null or empty text has the end id
    alone. Other columns are not written. An empty table gives an empty store.
    ``partitions`` is the number of parts; by default Spark sizes them.
    """
    ship_package(docs.sparkSession)
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(whole_text(text)).alias("tie"),
        F.monotonically_increasing_id().alias("spread"), whole_text(text).alias("text"),
    )
    keys = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("spread")]
    dealt = source.repartitionByRange(*([partitions] if partitions else []), *keys).sortWithinPartitions(*keys)
    ordered = dealt.select(F.spark_partition_id().alias("part"), "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, start = word_ids(vocabulary), 0
        for batch in slices(batches):
            flat, counts = ids.encode_flat(batch.column(2).to_pylist(), end_id)
            ends = np.cumsum(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(start + ends - counts), pa.array(counts.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(flat)),
                ],
                names=["part", "doc_id", "local_start", "n_tokens", "tokens"],
            )
            start += int(counts.sum())

    rows = ordered.mapInArrow(run, "part int, doc_id bigint, local_start bigint, n_tokens int, tokens array<int>")
    writer = rows.write.option("compression", "snappy").option("parquet.writer.version", "PARQUET_2_0")
    writer = writer.option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
    writer = writer.option("parquet.page.row.count.limit", PAGE_ROWS).option("parquet.enable.dictionary", "true")
    for column in ("part", "doc_id", "local_start", "n_tokens"):
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    writer.parquet(f"{path}/tokens")
    _tokens(docs.sparkSession, path).groupBy("part").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").cast("bigint").alias("n_ids")
    ).select(
        "part",
        # One row per part: the only window without keys, over as many rows as the store has files.
        F.coalesce(
            F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("base"),
        "n_docs", "n_ids",
    ).write.parquet(f"{path}/parts")


def _tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(
        "part int, doc_id bigint, local_start bigint, n_tokens int, tokens array<int>"
    ).parquet(f"{path}/tokens")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, tokens`` of a token store.

    Select columns and filter on ``doc_id`` as on any table: a metadata read leaves the ids' pages unread,
    and a range of documents opens only their row groups and pages. ``parts`` has one row per
    file, so it is broadcast.
    """
    parts = spark.read.schema("part int, base bigint, n_docs bigint, n_ids bigint").parquet(f"{path}/parts")
    return _tokens(spark, path).join(F.broadcast(parts.select("part", "base")), "part").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), F.col("n_tokens").cast("bigint").alias("n_tokens"),
        "tokens",
    )


def with_checksums(stored: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``: the crc32 of each document's ids as little-endian 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<u4")).cast("B")
            ends = lists.offsets.to_numpy()
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    ship_package(stored.sparkSession)
    rows = stored.select("doc_id", "start", "n_tokens", "tokens")
    return rows.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
