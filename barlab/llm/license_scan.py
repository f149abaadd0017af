"""Licence texts in documents: winnowed fingerprints pick candidates, banded alignment measures them.

Templates are cut into words; of the shingles of ``SHINGLE`` words in every window of ``WINNOW`` consecutive
ones, the one with the smallest hash is kept, with its place: an inverted index from shingle to templates. Documents are
asked with all their shingles, so every template that stands in a document whole is a
candidate there, however short. The places of the hits lie near a diagonal; around it, template and
document are aligned (Smith-Waterman in a band of ``BAND`` words to either side), again beside what was aligned, until no hit is left.
The pieces of one template are chained in the order of both, over any diagonals, where the words won weigh more than
the distance in the text; the chain gives the template words found, in order, and their span in the text.

The index goes to the executors with the task. It holds ``INDEX_SHINGLES`` shingles at most; more templates are
looked for in several passes over the documents.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.llm.common import ship_package, slices, whole_text

WORD = re.compile(r"[^\W_]+")
SHINGLE = 3
WINNOW = 4
BAND = 12
INDEX_SHINGLES = 200_000
MATCH, MISS, GAP = 2, -1, -1
#: Words in the text between two pieces that cost as much as one matched word.
FAR = 25
#: The share of a template's words from which on a licence counts as found.
COVERAGE = 0.9
#: What is reported: at least this share of the words, and this many (or all of a shorter template).
FLOOR = 0.1
FLOOR_WORDS = 6


def _words(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


def winnow(words: list[str], shingle: int = SHINGLE, window: int = WINNOW) -> list[int]:
    """Places of the kept shingles: the smallest hash in each window, the rightmost of equal ones."""
    n = len(words) - shingle + 1
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + shingle])) for i in range(max(n, 0))]
    kept = set()
    for i in range(max(1, n - window + 1) if n > 0 else 0):
        part = hashes[i : i + window]
        kept.add(i + max(k for k, h in enumerate(part) if h == min(part)))
    return sorted(kept)


@dataclass
class Index:
    """Templates as numbers of their words, and the kept shingles as sorted keys with template and place."""

    names: list[str]
    words: dict[str, int]
    templates: list[np.ndarray]
    keys: np.ndarray
    owner: np.ndarray
    place: np.ndarray

    def hits(self, ids: np.ndarray) -> list[tuple[int, int, int]]:
        """``template, place in it, place in the document`` of every indexed shingle of a document's words."""
        if len(ids) < SHINGLE:
            return []
        key, full = np.zeros(len(ids) - SHINGLE + 1, dtype=np.int64), np.ones(len(ids) - SHINGLE + 1, dtype=bool)
        for k in range(SHINGLE):
            part = ids[k : len(ids) - SHINGLE + 1 + k]
            key = key * (len(self.words) + 1) + part
            full &= part > 0
        at = np.flatnonzero(full)
        first, last = (np.searchsorted(self.keys, key[at], side) for side in ("left", "right"))
        return [(int(self.owner[j]), int(self.place[j]), int(p)) for p, a, b in zip(at, first, last) for j in range(a, b)]


def build_index(templates: Mapping[str, str]) -> Index:
    """Templates with fewer words than a shingle are left out: they say too little to be found by."""
    cut = {n: w for n, w in ((n, _words(t)) for n, t in sorted(templates.items())) if len(w) >= SHINGLE}
    words = {w: i for i, w in enumerate(sorted({w for ws in cut.values() for w in ws}), 1)}
    if (len(words) + 1) ** SHINGLE >= 1 << 63:
        raise ValueError("too many different words for one index")
    base, rows = len(words) + 1, []
    numbered = [np.array([words[w] for w in ws], dtype=np.int64) for ws in cut.values()]
    for t, ws in enumerate(cut.values()):
        for p in winnow(ws):
            key = 0
            for i in numbered[t][p : p + SHINGLE]:
                key = key * base + int(i)
            rows.append((key, t, p))
    rows.sort()
    keys, owner, place = (np.array(x, dtype=np.int64) for x in zip(*rows)) if rows else (np.zeros(0, dtype=np.int64),) * 3
    return Index(list(cut), words, numbered, keys, owner, place)


def align(template: np.ndarray, document: np.ndarray, diagonal: int, band: int = BAND) -> tuple[int, int, int]:
    """``matched, first, end``: the best local alignment near ``document place - template place = diagonal``.

    First and end are places of words in ``document``, the end exclusive.
    """
    pairs, first, end = aligned(template, document, diagonal, band)
    return len(pairs), first, end


def aligned(template: np.ndarray, document: np.ndarray, diagonal: int, band: int = BAND) -> tuple[list[tuple[int, int]], int, int]:
    """As ``align``, with the places in template and document of the words that match, in order."""
    width, m = 2 * band + 1, len(template)
    slots = np.arange(width)
    score = np.zeros((m + 1, width), dtype=np.int64)
    step = np.zeros((m + 1, width), dtype=np.int8)
    for i in range(1, m + 1):
        place = diagonal - band + slots + i - 1
        inside = (place >= 0) & (place < len(document))
        seen = np.where(inside, document[np.clip(place, 0, len(document) - 1)], -1)
        across = score[i - 1] + np.where(seen == template[i - 1], MATCH, MISS)
        across[~inside] = 0
        above = np.append(score[i - 1, 1:], 0) + GAP  # a template word is missing in the document
        best = np.maximum(np.maximum(across, above), 0)
        along = np.maximum.accumulate(best - GAP * slots) + GAP * slots  # a word stands between in the document
        score[i] = np.where(inside, along, np.maximum(above, 0))
        step[i] = np.where(score[i] == 0, 0, np.where((score[i] == across) & inside, 1, np.where(score[i] == above, 2, 3)))
    if not score.any():
        return [], 0, 0
    i, j = np.unravel_index(int(np.argmax(score)), score.shape)
    pairs, end = [], diagonal - band + int(j) + int(i)
    first = end
    while i > 0 and step[i, j]:
        if step[i, j] == 1:
            first = diagonal - band + int(j) + int(i) - 1
            if document[first] == template[i - 1]:
                pairs.append((int(i) - 1, first))
            i -= 1
        elif step[i, j] == 2:
            i, j = i - 1, j + 1
        else:
            j -= 1
    return pairs[::-1], first, end


def pieces(template: np.ndarray, document: np.ndarray, hits: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Alignments of parts of a template, as matching places, around its ``hits`` (place in it, in the document)."""
    found = []
    by_diagonal = sorted(hits, key=lambda h: h[1] - h[0])
    runs, start = [], 0
    for i in range(1, len(by_diagonal) + 1):
        if i == len(by_diagonal) or (by_diagonal[i][1] - by_diagonal[i][0]) - (by_diagonal[start][1] - by_diagonal[start][0]) > BAND // 2:
            runs.append((0, len(template), by_diagonal[start:i], document))
            start = i
    while runs:
        low, high, held, words = runs.pop()
        q, p = held[len(held) // 2]
        pairs = [(t + low, d) for t, d in aligned(template[low:high], words, p - q + low)[0]]
        if not pairs:
            continue
        found.append(pairs)
        (t0, d0), (t1, d1) = pairs[0], pairs[-1]
        left = [h for h in held if h[0] + SHINGLE <= t0 and h[1] + SHINGLE <= d0]
        right = [h for h in held if h[0] > t1 and h[1] > d1]
        other = [h for h in held if (h[1] + SHINGLE <= d0 or h[1] > d1) and h not in left and h not in right]
        if left:
            runs.append((low, t0, left, words))
        if right:
            runs.append((t1 + 1, high, right, words))
        if other:  # another copy close by
            words = words.copy()
            words[d0 : d1 + 1] = -1
            runs.append((low, high, other, words))
    return sorted(set(map(tuple, found)), key=lambda x: (x[0][1], x))


def in_order(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of pairs that grows in both places."""
    ends: list[int] = []
    at: list[int] = []
    before, ordered = [], sorted(set(pairs), key=lambda x: (x[0], -x[1]))
    for k, (_, d) in enumerate(ordered):
        n = bisect_left(ends, d)
        before.append(at[n - 1] if n else -1)
        ends[n:n + 1], at[n:n + 1] = [d], [k]
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(ordered[k])
        k = before[k]
    return out[::-1]


def _links(parts: list[list[tuple[int, int]]]) -> list[tuple[float, int]]:
    """For each piece, by place, the worth of the best chain that ends with it, and the piece before it there or -1."""
    best: list[tuple[float, int]] = []
    longest = max((x[-1][1] - x[0][1] for x in parts), default=0)
    for j, part in enumerate(parts):
        mine, first = (float(len(part)), -1), part[0]
        for i in range(j - 1, -1, -1):
            other = parts[i]
            if first[1] - other[0][1] > FAR * len(part) + longest + 1:
                break
            t, d = other[-1]
            if first[0] > other[0][0] and first[1] > other[0][1] and part[-1][0] > t and part[-1][1] > d:
                won = sum(1 for x, y in part if x > t and y > d) - max(first[1] - d - 1, 0) / FAR
                if won > 0 and best[i][0] + won > mine[0]:
                    mine = (best[i][0] + won, i)
        best.append(mine)
    return best


def chains(parts: list[list[tuple[int, int]]]) -> list[list[tuple[int, int]]]:
    """Pieces of one template joined in order, the best chain first; chains do not overlap in the document.

    ``parts`` are by place. Links are made anew only if a piece that another one is linked to was taken.
    """
    found, taken = [], []
    while parts:
        best, free = _links(parts), set(range(len(parts)))
        for last in sorted(free, key=lambda i: (-best[i][0], i)):
            used, k = [], last
            while k >= 0 and k in free:
                used.append(k)
                k = best[k][1]
            if k >= 0 or not used:
                continue  # gone, or linked to a piece that is
            free.difference_update(used)
            chain = in_order([x for i in used for x in parts[i]])
            a, b = chain[0][1], chain[-1][1]
            at = bisect_left(taken, (a, a))
            if (at and taken[at - 1][1] >= a) or (at < len(taken) and taken[at][0] <= b):
                continue  # over a better one
            taken.insert(at, (a, b))
            found.append(chain)
        parts = [parts[i] for i in sorted(free)]
    return found


def scan_text(text: str, index: Index, coverage: float = COVERAGE) -> list[tuple[str, int, int, int, int]]:
    """``licence, start, end, matched words, words of the template`` in one text, by place."""
    get = index.words.get
    lowered = text.lower()
    if len(lowered) == len(text):
        ids = np.fromiter((get(w, 0) for w in WORD.findall(lowered)), dtype=np.int64)
        if not index.hits(ids):
            return []
    places = [(m.start(), m.end(), get(m.group().lower(), 0)) for m in WORD.finditer(text)]
    ids = np.array([p[2] for p in places], dtype=np.int64)
    by_template: dict[int, list[tuple[int, int]]] = {}
    for t, q, p in index.hits(ids):
        by_template.setdefault(t, []).append((q, p))
    rows = []
    for t, hits in by_template.items():
        size = len(index.templates[t])
        for chain in chains(pieces(index.templates[t], ids, hits)):
            if len(chain) >= max(coverage * size, min(FLOOR_WORDS, size)):
                rows.append((places[chain[0][1]][0], places[chain[-1][1]][1], t, len(chain)))
    return [(index.names[t], a, b, matched, len(index.templates[t])) for a, b, t, matched in sorted(rows)]


def scan_licenses(docs: DataFrame, templates: Mapping[str, str], coverage: float = FLOOR, text: str = "text") -> DataFrame:
    """``doc_id, license, start, end, n_matched, n_template, coverage, found``: a row per licence, or part of one, in a text.

    ``start`` and ``end`` are code points, the end exclusive; ``coverage`` is the share of the template's words
    found in order, and ``found`` says whether it is ``COVERAGE`` at least. Less than ``coverage`` or ``FLOOR_WORDS`` words is
noise and not given. A template may be found at
    several places that do not overlap; different templates may overlap. A null or empty text has no rows. Rows of
    ``docs`` count by themselves, whether they repeat or lack an id; other columns are ignored.
    """
    ship_package(docs.sparkSession)
    source = docs.select("doc_id", whole_text(text).alias("text"))
    names, parts, held = sorted(templates), [{}], 0
    for name in names:
        size = len(WORD.findall(templates[name]))
        if held and held + size > INDEX_SHINGLES:
            parts.append({})
            held = 0
        parts[-1][name] = templates[name]
        held += size
    found = None
    for part in parts:
        some = _scan(source, build_index(part), coverage)
        found = some if found is None else found.unionByName(some)
    return found


def _scan(source: DataFrame, index: Index, coverage: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, found = [], []
            for i, x in enumerate(batch.column(1).to_pylist()):
                for one in scan_text(x, index, coverage):
                    row.append(i)
                    found.append(one)
            name, start, end, matched, size = zip(*found) if found else ((),) * 5
            numbers = [pa.array(c, pa.int64()) for c in (start, end, matched, size)]
            share = pa.array([a / b for a, b in zip(matched, size)], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int32())), pa.array(name, pa.string()), *numbers, share],
                names=["doc_id", "license", "start", "end", "n_matched", "n_template", "coverage"],
            )

    kind = dict(source.dtypes)["doc_id"]
    rows = source.mapInArrow(
        run, f"doc_id {kind}, license string, start bigint, end bigint, n_matched bigint, n_template bigint, coverage double"
    )
    return rows.withColumn("found", F.col("coverage") >= COVERAGE)
