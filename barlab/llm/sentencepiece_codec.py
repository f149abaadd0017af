"""SentencePiece encoding and decoding through tables of distinct marked words.

A piece of the models meant here never holds a word's characters followed by the
whitespace marker, so no merge crosses a marker, and a text's ids are the ids of its marked words, one
after the other. Each task keeps a table of the distinct marked words it has met.
A slice of texts is cut into marked words; those that the table lacks are
segmented, and decoded, once, in one call; then ids and characters are joined back
by position. The table is dropped when it has ``TABLE_WORDS`` words, so a task's
memory has a bound and the result does not depend on it; it ends with the task, so that an idle worker holds none.

The table belongs to a task and is not shared through a shuffle: a corpus-wide
table would send all distinct words and then all texts over the network to
meet them, which costs more than segmenting a word once per task.

Texts that the model's normaliser changes in more than the marking of spaces, and
models with a piece across a marker, are encoded as a whole.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlab.llm.common import ship_package, slices, whole_text

MARK = "▁"
#: Words in a task's table before a new one is begun: some 25 MB.
TABLE_WORDS = 100_000
#: Bytes of text that are cut into words at a time: a list of words takes some ten times its text.
SLICE_CHARS = 250_000
MARKED = re.compile(f"{MARK}+[^{MARK}]*")
ACROSS = re.compile(f"[^{MARK}]{MARK}")


class MarkedWords:
    """Ids and decoded characters of marked words; a word is kept without its first marker."""

    def __init__(self, model: str):
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=model)
        names = (self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size()))
        self.by_word = self.pieces.normalize("a") == f"{MARK}a" and not any(map(ACROSS.search, names))
        self.known: dict[str, bytes] = {}
        self.changed: dict[str, str] = {}  # words that do not decode to themselves

    def words(self, text: str) -> list[str] | None:
        """The text's marked words, or None if it has to be encoded as a whole."""
        if not self.by_word:
            return None
        marked = self.pieces.normalize(text)
        if marked != MARK + text.replace(" ", MARK):
            return None
        if MARK * 2 in marked:
            return [w[1:] for w in MARKED.findall(marked)]
        return marked[1:].split(MARK)

    def learn(self, words: set[str]) -> None:
        if len(self.known) > TABLE_WORDS:
            self.forget()
        new = [w for w in words if w and w not in self.known]
        if "" in words:
            self.known[""] = array("i", [self.pieces.piece_to_id(MARK)]).tobytes()
        if new:
            ids = self.pieces.encode(new, num_threads=1)
            texts = self.pieces.decode(ids, num_threads=1)
            self.known.update([(w, array("i", i).tobytes()) for w, i in zip(new, ids)])
            self.changed.update([(w, t) for w, t in zip(new, texts) if w != t])

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Per text its ids, as 32-bit integers, and the text they decode to."""
        cut = [self.words(t) if t else [] for t in texts]
        self.learn(set().union(*(w for w in cut if w)))
        return [self.whole(t) if w is None else self.joined(w) for t, w in zip(texts, cut)]

    def forget(self) -> None:
        self.known, self.changed = {}, {}

    def joined(self, words: list[str]) -> tuple[bytes, str]:
        ids = b"".join(map(self.known.__getitem__, words))
        if not self.changed.keys().isdisjoint(words):
            words = [self.changed.get(w, w) for w in words]
        return ids, " ".join(words)

    def whole(self, text: str) -> tuple[bytes, str]:
        ids = self.pieces.encode(text)
        return array("i", ids).tobytes(), self.pieces.decode(ids)


@lru_cache(maxsize=2)
def marked_words(model: str) -> MarkedWords:
    """The model, loaded once per Python worker."""
    return MarkedWords(model)


def encoded(batches: Iterator[pa.RecordBatch], model: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches with the text as their last column ``__text``; in its place come the ids and the decoded text."""
    words = marked_words(model)
    try:
        for batch in slices(batches, "__text", SLICE_CHARS):
            found = words.encode(batch.column(batch.num_columns - 1).to_pylist())
            texts = pa.array([f[1] for f in found], pa.string())
            columns = [*batch.columns[:-1], id_lists([f[0] for f in found]), texts]
            yield pa.RecordBatch.from_arrays(columns, names=names)
    finally:
        words.forget()


def id_lists(ids: list[bytes]) -> pa.ListArray:
    ends = [0, *accumulate(len(i) // 4 for i in ids)]
    flat = np.frombuffer(b"".join(ids), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def encode_decode(
    docs: DataFrame, model: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """Add the ids of every text and the text that these ids decode to.

    ``model`` is a SentencePiece model file that every machine has. Ids are exactly
    those of the library, without begin, end or sampling. A null or empty text
    has no ids and decodes to an empty text. A column that is already named as one of
    the two new ones is replaced; all others are kept as they are. Each row counts by itself, so
    repeated rows and repeated or null keys need no care, and an empty table
    gives an empty table. Texts of any length are encoded whole.
    """
    ship_package(docs.sparkSession)
    kept = [c for c in docs.columns if c not in (ids, decoded)]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], whole_text(text).alias("__text"))
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema.add(ids, T.ArrayType(T.IntegerType())).add(decoded, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encoded(batches, model, [*kept, ids, decoded])

    return source.mapInArrow(run, schema)


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of every text; see :func:`encode_decode`."""
    found = encode_decode(docs, model, text, ids, "__decoded")
    return found.drop("__decoded")


def decode(rows: DataFrame, model: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Add the text of every list of ids, as the library decodes it; null for null.

    The end of a list is the end of a text: lists are decoded whole.
    """
    ship_package(rows.sparkSession)
    kept = [c for c in rows.columns if c != text]
    source = rows.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{ids}`").alias("__ids"))
    schema = rows.select(*[F.col(f"`{c}`") for c in kept]).schema.add(text, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = marked_words(model).pieces
        for batch in batches:
            lists = batch.column(batch.num_columns - 1).to_pylist()
            texts = [None if x is None else pieces.decode(x) if x else "" for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*kept, text])

    return source.mapInArrow(run, schema)
