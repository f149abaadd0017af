"""Removal of repeated multi-line chunks with content-defined boundaries.

A text is split into lines. A rolling hash over the hashes of the last ``window`` lines decides after
which lines a chunk ends, so that boundaries depend on the lines around them and not on
their number: text that is inserted before a passage does not shift the boundaries in it. A
chunk has at least ``min_lines`` lines that are not blank, but for the last one of a text.

A chunk of two or more such lines that occurs more than once in the corpus stays at
its first occurrence and is removed everywhere else:

1. Count chunk hashes (128 bits) over all documents; only hashes travel, reduced before the shuffle.
2. Fetch the bytes of the chunks whose hash is repeated, and compare those of every later
   occurrence with those of the first.
3. Rebuild the texts that lose a chunk.

Chunks that divide a text (``dedup_lines``) leave the edges of a shared passage, and passages that hold no whole chunk, in
place. ``dedup_passages`` goes by the same steps with boundaries that lie closer, and chunks that run from one boundary line
through the next one: a passage needs two boundary lines to be found, and goes from the first of them to the last. Lines of
some length always are boundaries, of short ones three in four by the rolling hash. What goes has a least number of words, so pairs
of short lines stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlab.llm.collocations import make_filter
from barlab.llm.common import row_keys, ship_package, slices, whole_text
from barlab.llm.key_filter import split_by_keys
from barlab.session import stage

#: Lines in the rolling window; a boundary stands after one line in ``DIVISOR`` on average.
WINDOW = 2
DIVISOR = 2
MIN_LINES = 2
#: A single line of more words than this is a passage by itself.
LONG_WORDS = 50
#: For passages: a line with so many spaces is a boundary, of shorter ones all but one in ``SHORT_DIVISOR``.
LINE_SPACES = 7
SHORT_DIVISOR = 4
#: A run of lines that goes has so many words at least.
LEAST_WORDS = 20
#: Multiplier of the rolling hash (odd, so that every line's hash keeps all its bits).
STEP = np.uint64(0x9E3779B97F4A7C15)


def boundaries(lines: list[bytes], window: int = WINDOW, divisor: int = DIVISOR, min_lines: int = MIN_LINES) -> list[int]:
    """Ends of the chunks: indices into ``lines``, exclusive, ascending, the last one their number."""
    if len(lines) <= min_lines:
        return [len(lines)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(x) for x in lines), dtype=np.uint64, count=len(lines))
    rolling = hashes.copy()
    power = np.uint64(1)
    with np.errstate(over="ignore"):
        for back in range(1, window):
            power = power * STEP
            rolling[back:] += hashes[:-back] * power
    cut_after = (rolling >> np.uint64(17)) % np.uint64(divisor) == 0
    ends, held = [], 0
    for i, (line, cut) in enumerate(zip(lines, cut_after.tolist())):
        held += not line.isspace() and bool(line)
        if cut and held >= min_lines:
            ends.append(i + 1)
            held = 0
    if not ends or ends[-1] != len(lines):
        ends.append(len(lines))
    return ends


def chunks(text: bytes, window: int, divisor: int, min_lines: int) -> list[list[bytes]]:
    lines = text.split(b"\n")
    ends = boundaries(lines, window, divisor, min_lines)
    return [lines[a:b] for a, b in zip([0, *ends], ends)]


def _multi_line(chunk: list[bytes]) -> bool:
    return sum(1 for x in chunk if x and not x.isspace()) > 1


#: Numbered lists of lines of a text that may repeat, and the lines (numbers) that go with some of them.
Units = Callable[[bytes], Iterator[tuple[int, bytes]]]
Lost = Callable[[list[bytes], set[int]], tuple[set[int], int]]


def chunk_units(options: tuple[int, int, int]) -> tuple[Units, Lost]:
    """Multi-line chunks by their number."""

    def units(text: bytes) -> Iterator[tuple[int, bytes]]:
        for k, chunk in enumerate(chunks(text, *options)):
            if _multi_line(chunk):
                yield k, b"\n".join(chunk)

    def lost(lines: list[bytes], numbers: set[int]) -> tuple[set[int], int]:
        ends = boundaries(lines, *options)
        return {i for k, (a, b) in enumerate(zip([0, *ends], ends)) if k in numbers for i in range(a, b)}, len(numbers)

    return units, lost


def _filled(lines: list[bytes]) -> list[int]:
    return [i for i, x in enumerate(lines) if x and not x.isspace()]


def cut_lines(lines: list[bytes], filled: list[int], window: int = WINDOW) -> list[int]:
    """The boundary lines among those that are not blank, by their own content and, if short, that of the line before."""
    cuts = []
    for k, i in enumerate(filled):
        if lines[i].count(b" ") < LINE_SPACES:
            rolling = 0
            for j in filled[max(k - window + 1, 0) : k + 1]:
                rolling = (rolling * int(STEP) + xxhash.xxh64_intdigest(lines[j])) & 0xFFFFFFFFFFFFFFFF
            if (rolling >> 17) % SHORT_DIVISOR == 0:
                continue
        cuts.append(i)
    return cuts


def passage_units(long_words: int = LONG_WORDS, least_words: int = LEAST_WORDS) -> tuple[Units, Lost]:
    """Chunks from a boundary line through the next one under even numbers, by the first's place among boundary
    lines; long single lines under odd ones."""

    def units(text: bytes) -> Iterator[tuple[int, bytes]]:
        lines = text.split(b"\n")
        cuts = cut_lines(lines, _filled(lines))
        for k, i in enumerate(cuts):
            if k + 1 < len(cuts):
                yield 2 * k, b"\n".join(lines[i : cuts[k + 1] + 1])
            if len(lines[i]) > 2 * long_words and len(lines[i].split()) > long_words:
                yield 2 * k + 1, lines[i]

    def lost(lines: list[bytes], numbers: set[int]) -> tuple[set[int], int]:
        filled = _filled(lines)
        cuts, marked = cut_lines(lines, filled), set()
        for number in numbers:
            k = number // 2
            marked.update(range(cuts[k], cuts[k + 1 - number % 2] + 1))
        gone, run, runs = set(), [], 0
        for i in [*filled, -1]:
            if i in marked:
                run.append(i)
                continue
            if run and sum(len(lines[j].split()) for j in run) >= least_words:
                gone.update(j for j in range(run[0], run[-1] + 1) if j in marked)
                runs += 1
            run = []
        return (set(range(len(lines))) if filled and gone.issuperset(filled) else gone), runs

    return units, lost


def chunk_table(docs: DataFrame, keys: list[str], text: str, units: Units, wanted: Broadcast | None = None) -> DataFrame:
    """``keys, chunk_no, h1, h2``: what may repeat in every text; with a filter ``wanted``, what passes it, and its bytes as ``chunk``."""
    ship_package(docs.sparkSession)
    with_text = wanted is not None
    source = docs.select(*keys, F.col(text).cast("binary").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            row, number, h1, h2, joined = [], [], [], [], []
            for i, x in enumerate(batch.column(batch.num_columns - 1)):
                for k, body in units(x.as_py()):
                    digest = xxhash.xxh3_128_digest(body)
                    row.append(i)
                    number.append(k)
                    h1.append(int.from_bytes(digest[:8], "big", signed=True))
                    h2.append(int.from_bytes(digest[8:], "big", signed=True))
                    if with_text:
                        joined.append(body)
            rows, hashes = np.array(row, np.int32), [np.array(h, np.int64) for h in (h1, h2)]
            kept = np.flatnonzero(wanted.value.holds(hashes)) if with_text else np.arange(len(rows))
            taken = pa.array(rows[kept])
            columns = [*(c.take(taken) for c in batch.columns[:-1]), pa.array(np.array(number, np.int32)[kept]), *(pa.array(h[kept]) for h in hashes)]
            names = [*keys, "chunk_no", "h1", "h2"]
            if with_text:
                columns.append(pa.array([joined[i] for i in kept], pa.binary()))
                names.append("chunk")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds = dict(docs.dtypes)
    fields = [*(f"{k} {kinds[k]}" for k in keys), "chunk_no int, h1 bigint, h2 bigint", *["chunk binary"] * with_text]
    return source.mapInArrow(run, ", ".join(fields))


def _repeated(docs: DataFrame, units: Units) -> DataFrame:
    """``doc_id, k1, k2, chunk_no, ahead``: the occurrences behind the first, from ``docs(doc_id, text)``.

    ``ahead`` is how far behind the first it stands if both are in one text, else null. Hashes are counted alone. A filter of fixed size
    holds those that repeat, and only chunks that pass it are moved, with their bytes; one that passes by mistake
    meets no other.
    """
    spark = docs.sparkSession
    keys = ["doc_id", "k1", "k2"]
    hashed = chunk_table(docs, [], "text", units)
    repeated = stage(hashed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated")
    wanted = spark.sparkContext.broadcast(make_filter(repeated.select(F.col("h1").alias("w1"), F.col("h2").alias("w2")), 2))
    named = docs.select("doc_id", *row_keys(F.col("text")), "text")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2", "chunk_no")
    found = stage(chunk_table(named, keys, "text", units, wanted), "chunks")
    first = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.min_by("chunk", place).alias("kept"), F.count(F.lit(1)).alias("n"))
    later = found.join(first.where("n > 1").drop("n"), ["h1", "h2"]).where((place != F.col("first")) & (F.col("chunk") == F.col("kept")))
    here = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("k1") == F.col("first.k1")) & (F.col("k2") == F.col("first.k2"))
    ahead = F.when(here, F.col("chunk_no") - F.col("first.chunk_no"))
    return later.select(*keys, "chunk_no", ahead.alias("ahead")).distinct()


def repeated_chunks(
    docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR, min_lines: int = MIN_LINES
) -> DataFrame:
    """``doc_id, k1, k2, chunk_no``: the occurrences to remove, from ``docs(doc_id, text)``.

    The first occurrence, by ``doc_id`` with nulls last, then the text's key and the place in it, stays.
    """
    return _repeated(docs, chunk_units((window, divisor, min_lines))[0]).drop("ahead")


def repeated_passages(docs: DataFrame, long_words: int = LONG_WORDS) -> DataFrame:
    """As ``repeated_chunks``, of the chunks of passages; a chunk that shares a line with the first is none."""
    found = _repeated(docs, passage_units(long_words)[0])
    return found.where("ahead is null or ahead > 2 or chunk_no % 2 = 1").drop("ahead")


def dedup_lines(
    docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars",
    window: int = WINDOW, divisor: int = DIVISOR, min_lines: int = MIN_LINES,
) -> DataFrame:
    """``docs`` with repeated multi-line chunks removed from ``text``, and two columns more.

    ``n_chunks_removed`` and ``n_lines_removed`` come last. All other columns are kept as they are, but for
    ``n_chars``, which follows the new text if that column exists and was not null. Lines that stay are joined by line
    ends as before. A null text stays null; an empty one stays empty; a text
    that loses all its lines becomes empty, and its row stays. Rows that agree in ``doc_id`` and text
    are one document: they are treated alike. Columns already named as one of the new ones are replaced.
    """
    options = (window, divisor, min_lines)
    return _without(docs, text, n_chars, lambda texts: repeated_chunks(texts, *options), chunk_units(options)[1])


def dedup_passages(
    docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars", long_words: int = LONG_WORDS, least_words: int = LEAST_WORDS
) -> DataFrame:
    """As ``dedup_lines``, but a passage that stands at an earlier place too goes from its first boundary line to its last.

    A passage has two boundary lines or more, or is one line of over ``long_words`` words; all places are those of the texts as
    given. Runs of lines with fewer than ``least_words`` words stay. Blank lines go if they stand inside a chunk, or if no
    other line is left. ``n_chunks_removed`` counts runs of removed lines.
    """
    return _without(docs, text, n_chars, lambda texts: repeated_passages(texts, long_words), passage_units(long_words, least_words)[1])


def _without(docs: DataFrame, text: str, n_chars: str | None, repeated: Callable[[DataFrame], DataFrame], lines_lost: Lost) -> DataFrame:
    added = ("n_chunks_removed", "n_lines_removed")
    columns = [c for c in docs.columns if c not in added]
    texts = docs.select("doc_id", whole_text(text).alias("text"))
    k1, k2 = row_keys(whole_text(text))
    lost = stage(
        repeated(texts).groupBy("doc_id", "k1", "k2").agg(F.collect_list("chunk_no").alias("__lost"))
        .select(F.col("doc_id").alias("__id"), F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), "__lost"),
        "lost",
    )
    named = docs.select(*[F.col(f"`{c}`") for c in columns], k1.alias("__r1"), k2.alias("__r2"))
    same = F.col("__r1") == F.col("__k1"), F.col("__r2") == F.col("__k2"), F.col("`doc_id`").eqNullSafe(F.col("__id"))
    # Texts that lose nothing pass by; only the others, and a few that the filter takes for them, are shuffled.
    some, rest = split_by_keys(named, "__r1", "__r2", lost.select("__k1", "__k2"))
    joined = some.join(lost, list(same), "left")
    source = joined.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{text}`").cast("binary").alias("__text"), "__lost")
    at = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            texts, n_chunks, n_lines = [], [], []
            for x, gone in zip(batch.column(len(columns)), batch.column(len(columns) + 1)):
                if not gone.is_valid:
                    texts.append(x.as_py())
                    n_chunks.append(0)
                    n_lines.append(0)
                    continue
                lines = x.as_py().split(b"\n")
                out, n = lines_lost(lines, set(gone.as_py()))
                texts.append(b"\n".join([line for i, line in enumerate(lines) if i not in out]))
                n_chunks.append(n)
                n_lines.append(len(out))
            made = list(batch.columns[: len(columns)])
            made[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*made, pa.array(n_chunks, pa.int64()), pa.array(n_lines, pa.int64())], names=[*columns, *added]
            )

    schema = docs.select(*[F.col(f"`{c}`") for c in columns]).schema
    for name in added:
        schema = schema.add(name, T.LongType())
    found = source.mapInArrow(run, schema).unionByName(
        rest.select(*[F.col(f"`{c}`") for c in columns], *[F.lit(0).cast("bigint").alias(c) for c in added]))
    if n_chars in columns:
        length = F.length(f"`{text}`").cast(schema[n_chars].dataType)
        found = found.withColumn(n_chars, F.when(F.col("n_chunks_removed") > 0, F.when(F.col(f"`{n_chars}`").isNotNull(), length)).otherwise(F.col(f"`{n_chars}`")))
    return found
