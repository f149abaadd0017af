"""Prefix trie of conversations, built as burst tries.

Every conversation is a sequence of turn ids. A container holds the rests of all conversations that share a beginning,
under the trie node of that beginning, its head. Containers with more than ``size`` turns are burst by their next turn id, which
makes a node, and a container under it, of each id; where all conversations of a container go on alike, the nodes of that stretch
are made at once. The containers that remain are dealt to tasks, which sort the rests of a container and sweep over
them: each rest opens the nodes that the one before it does not have. A container of one conversation needs no sweep.
Sums over subtrees come from the sweeps and rise from the burst nodes' children, last burst first.

A node is named by its smallest member and its depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.llm.common import row_keys, ship_package, whole_text
from barlab.operators.panel import number_rows
from barlab.session import stage

#: Turns in a container that one task sweeps.
CONTAINER = 20_000
#: Nodes of a stretch over which one window runs, and ids among which one list of ends is gathered.
BLOCK = 32_768
IDS = 4_096
EMPTY = hashlib.sha256(b"").hexdigest()
HEAD = ["head", "at"]
NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
NODE_COLUMNS = [c.split()[0] for c in NODE.split(", ")]


# Conversations -------------------------------------------------------------------


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, n_turns, k1, k2, chars``: the turns in order, each known by 128 bits of its role and text."""
    role, text = whole_text("role"), whole_text("text")
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), *row_keys(whole),
        F.length(text).cast("bigint").alias("chars"),
    )
    ordered = number_rows(turns, ["conv_id"], ["turn", "role", "k1", "k2"], out="pos", total="n_turns", name="turns")
    return stage(ordered.drop("turn", "role"), "turns")


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations with the first turns of their hundred's: ``conv, len``, and their turns ``conv, pos, k1, k2, chars``."""
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    first = own.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    made = own.withColumns({"base": F.expr("conv_id - conv_id % 100"), "h": taken}).join(first, "base", "left")
    made = made.withColumn("shared", F.least("h", F.coalesce("n_base", F.lit(0))))
    made = stage(made.select(
        F.col("conv_id").alias("conv"), "base", "h", "shared", (F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")
    ), "rebuilt")
    heads = made.select("conv", "base", "shared").join(
        turns.where("pos < 6").withColumnRenamed("conv_id", "base"), "base").where("pos < shared")
    rests = made.select(F.col("conv").alias("conv_id"), "h", "shared").join(turns, "conv_id").where("pos >= h")
    rows = heads.select("conv", "pos", "k1", "k2", "chars").unionByName(
        rests.select(F.col("conv_id").alias("conv"), (F.col("pos") - F.col("h") + F.col("shared")).alias("pos"), "k1", "k2", "chars"))
    return made.select("conv", "len"), rows


# Containers ----------------------------------------------------------------------


def with_kind(members: DataFrame, size: int) -> DataFrame:
    """``members(conv, len, head, at)`` with what becomes of their container, and its number of conversations."""
    sizes = members.groupBy(*HEAD).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("len") - F.col("at")).alias("turns"))
    kind = F.when(F.col("n") == 1, "one").when(F.col("turns") == 0, "none").when(F.col("turns") <= size, "small").otherwise("large")
    return members.join(sizes.select(*HEAD, "n", kind.alias("kind")), HEAD)


def stretches(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """How far all conversations of a container go on alike: ``head, at, n, end``, and the turns of that stretch.

    ``rows(head, at, n, pos, k1, k2, chars)`` hold the turns of whole containers.
    """
    alike = (F.col("c") == F.col("n")) & (F.col("low1") == F.col("high1")) & (F.col("low2") == F.col("high2"))
    at = rows.groupBy(*HEAD, "n", "pos").agg(
        F.count(F.lit(1)).alias("c"), F.min("k1").alias("low1"), F.max("k1").alias("high1"), F.min("k2").alias("low2"),
        F.max("k2").alias("high2"), F.max("chars").alias("chars"),
    )
    at = stage(at.select(*HEAD, "n", "pos", "chars", alike.alias("alike")), "alike")
    ends = at.groupBy(*HEAD, "n").agg(
        F.coalesce(F.min(F.when(~F.col("alike"), F.col("pos"))), F.max("pos") + 1).alias("end")
    )
    ends = stage(ends, "ends")
    return ends, at.join(ends.select(*HEAD, "end"), HEAD).where("pos < end").select(*HEAD, "n", "end", "pos", "chars")


def sweep(head: int, at: int, rests: list[tuple[list, int, list]]) -> list[tuple]:
    """The nodes below one head, and a last row for the head itself, from ``(turn ids, conversation, characters)``.

    The head's own row has no ``n_convs`` and ``ends_sha256``, and sums over what is below it only.
    """
    rests.sort(key=lambda r: (r[0], r[1]))
    parent, depth, chars, ends = [-1], [at], [0], [[]]
    path, last = [0], []
    for ids, conv, sizes in rests:
        same = next((i for i, (a, b) in enumerate(zip(ids, last)) if a != b), min(len(ids), len(last)))
        del path[same + 1 :]
        for i in range(same, len(ids)):
            parent.append(path[-1])
            depth.append(at + i + 1)
            chars.append(sizes[i])
            ends.append([])
            path.append(len(parent) - 1)
        ends[path[-1]].append(conv)
        last = ids
    count = len(parent)
    least, members = [min(e, default=None) for e in ends], [len(e) for e in ends]
    children, leaves, saved = [0] * count, [0] * count, [0] * count
    for i in range(count - 1, 0, -1):  # children come after their parent
        p = parent[i]
        leaves[i] = leaves[i] or 1
        saved[i] += (members[i] - 1) * chars[i]
        children[p] += 1
        leaves[p] += leaves[i]
        saved[p] += saved[i]
        members[p] += members[i]
        least[p] = least[i] if least[p] is None else min(least[p], least[i])
    least[0] = head
    made = [
        (least[i], depth[i], least[parent[i]], members[i], children[i], leaves[i], saved[i],
         hashlib.sha256(",".join(map(str, sorted(ends[i]))).encode()).hexdigest() if ends[i] else EMPTY)
        for i in range(1, count)
    ]
    return [*made, (head, at, None, None, children[0], leaves[0] or 1, saved[0], None)]


def sweep_containers(rows: DataFrame) -> DataFrame:
    """Rows of :func:`sweep` for all containers of ``rows(head, at, conv, pos, k1, k2, chars)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def turns() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        made: list[tuple] = []
        for (head, at), held in groupby(turns(), key=lambda r: (r[0], r[1])):
            rests = []
            for conv, own in groupby(held, key=lambda r: r[2]):
                own = list(own)
                rests.append(([(r[4], r[5]) for r in own], conv, [r[6] for r in own]))
            made += sweep(head, at, rests)
            if len(made) >= 10_000:
                yield _nodes(made)
                made = []
        yield _nodes(made)

    dealt = rows.select(*HEAD, "conv", "pos", "k1", "k2", "chars").repartition(*HEAD).sortWithinPartitions(*HEAD, "conv", "pos")
    return dealt.mapInArrow(run, NODE)


def _nodes(made: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string() if "string" in c else pa.int64() for c in NODE.split(", ")]
    columns = zip(*made) if made else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=NODE_COLUMNS)


def digests_of_ends(ends: DataFrame) -> DataFrame:
    """``conv_id, depth, ends_sha256`` from ``ends(conv_id, depth, conv)``.

    The ids are gathered and sorted in lists of neighbouring ids, and a node's lists digested one after the other.
    """
    lists = ends.groupBy("conv_id", "depth", F.expr(f"conv div {IDS}").alias("part")).agg(
        F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        found: list[tuple] = []
        for (conv, depth), held in groupby(rows(), key=lambda r: (r[0], r[1])):
            digest = hashlib.sha256(next(held)[3].encode())
            for row in held:
                digest.update(b"," + row[3].encode())
            found.append((conv, depth, digest.hexdigest()))
        columns = zip(*found) if found else [[]] * 3
        kinds = [pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", "depth", "ends_sha256"])

    order = ["conv_id", "depth", "part"]
    dealt = lists.select(*order, "ids").repartition("conv_id", "depth").sortWithinPartitions(*order)
    return dealt.mapInArrow(run, "conv_id bigint, depth bigint, ends_sha256 string")


def saved_after(stretch: DataFrame) -> DataFrame:
    """``stretch`` with ``after``: what its later nodes save, for each ``pos``."""
    saving = (F.col("n") - 1) * F.col("chars")
    cut = stretch.withColumn("blk", F.expr(f"pos div {BLOCK}L"))
    later = Window.partitionBy(*HEAD).orderBy(F.desc("blk")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = cut.groupBy(*HEAD, "blk").agg(F.sum(saving).alias("saving"))
    blocks = blocks.select(*HEAD, "blk", F.coalesce(F.sum("saving").over(later), F.lit(0)).alias("beyond"))
    inside = Window.partitionBy(*HEAD, "blk").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(saving).over(inside), F.lit(0))
    return cut.withColumn("within", within).join(blocks, [*HEAD, "blk"]).withColumn("after", F.col("within") + F.col("beyond")).drop("blk")


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f)
    return whole


def prefix_trie(conversations: DataFrame, size: int = CONTAINER) -> DataFrame:
    """A row per node of the trie over the rebuilt conversations: the columns of ``NODE``.

    A null role or text is empty. Turns go by ``turn``, null first; turns with one number by role, then by a hash of their content. Rows
    without a ``conv_id`` are left out; repeated rows are repeated turns. A conversation of which no turn is left is a member of the root. Long
    texts count by their code points. An empty table has no nodes. Other columns are not looked at, whatever their names.
    """
    ship_package(conversations.sparkSession)
    convs, rows = rebuild(numbered_turns(conversations))
    convs = stage(convs, "conversations")
    root = convs.agg(F.min("conv").alias("head"), F.count(F.lit(1)).alias("n")).first()
    spark = conversations.sparkSession
    if not root["n"]:
        return spark.createDataFrame([], NODE)
    members = stage(with_kind(convs.select("conv", "len", F.lit(root["head"]).alias("head"), F.lit(0).cast("bigint").alias("at")), size), "members")
    heads = [spark.createDataFrame([(root["head"], 0, None, root["n"], 0)], "conv_id bigint, depth bigint, parent bigint, n bigint, chars bigint")]
    held, closed, ends, bursts = rows, [], [], []
    while True:
        keyed = members.select("conv", "len", *HEAD, "n", "kind")
        held = stage(held.select("conv", "pos", "k1", "k2", "chars").join(keyed, "conv").where("pos >= at"), "container")
        closed.append((held.where("kind <> 'large'"), members.where("kind <> 'large'")))
        ends.append(members.where("kind <> 'large' and len = at").select(F.col("head").alias("conv_id"), F.col("at").alias("depth"), "conv"))
        held, large = held.where("kind = 'large'"), members.where("kind = 'large'")
        if large.isEmpty():
            break
        tips, stretch = stretches(held)
        stretch = stage(stretch, "stretch")
        ends.append(large.join(tips.select(*HEAD, "end"), HEAD).where("len = end").select(
            F.col("head").alias("conv_id"), F.col("end").alias("depth"), "conv"))
        step = stage(held.join(tips.select(*HEAD, "end"), HEAD).where("pos = end").select(*HEAD, "end", "conv", "len", "k1", "k2", "chars"), "step")
        children = stage(step.groupBy(*HEAD, "end", "k1", "k2").agg(
            F.min("conv").alias("child"), F.count(F.lit(1)).alias("n"), F.max("chars").alias("chars")), "children")
        heads.append(children.select(
            F.col("child").alias("conv_id"), (F.col("end") + 1).alias("depth"), F.col("head").alias("parent"), "n", "chars"))
        bursts.append((tips, stretch, children))
        moved = step.join(children.select(*HEAD, "k1", "k2", "child"), [*HEAD, "k1", "k2"])
        members = stage(with_kind(moved.select("conv", "len", F.col("child").alias("head"), (F.col("end") + 1).alias("at")), size), "members")
    return _nodes_of(heads, closed, ends, bursts)


def _nodes_of(heads: list, closed: list, ends: list, bursts: list) -> DataFrame:
    """All nodes from what the bursts have left: heads, closed containers, ends at heads, and stretches."""
    rows, members = (_union([c[i] for c in closed]) for i in (0, 1))
    swept = stage(sweep_containers(rows.where("kind = 'small'")), "swept")
    last = F.col("pos") + 1 == F.col("len")
    alone = rows.where("kind = 'one'").select(
        F.col("conv").alias("conv_id"), (F.col("pos") + 1).alias("depth"), F.col("conv").alias("parent_conv_id"), F.lit(1).cast("bigint").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("bigint").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"),
        F.lit(0).cast("bigint").alias("saved_tokens"), F.when(last, F.sha2(F.col("conv").cast("string"), 256)).otherwise(EMPTY).alias("ends_sha256"),
    )
    # What is below each head. Containers that were not swept have one conversation, or none that goes on.
    below = [swept.where("n_convs is null").select("conv_id", "depth", "n_children", "n_leaves", F.col("saved_tokens").alias("saved"))]
    below.append(members.where("kind in ('one', 'none') and conv = head").select(
        F.col("head").alias("conv_id"), F.col("at").alias("depth"), F.when(F.col("len") > F.col("at"), 1).otherwise(0).cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"), F.lit(0).cast("bigint").alias("saved")))
    closed_below = stage(_union(below), "below")
    levels, inner = [closed_below], []
    for tips, stretch, children in reversed(bursts):
        met = children.select(*HEAD, F.col("child").alias("conv_id"), (F.col("end") + 1).alias("depth"), "n", "chars").join(
            _union([closed_below, *levels[1:][-1:]]), ["conv_id", "depth"])
        sums = met.groupBy(*HEAD).agg(
            F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
            F.sum(F.col("saved") + (F.col("n") - 1) * F.col("chars")).alias("saved"),
        )
        zero = {"n_children": 0, "n_leaves": 1, "saved": 0}
        tip = stage(tips.join(sums, HEAD, "left").fillna(zero), "tips")
        later = stage(saved_after(stretch), "later")
        whole = later.groupBy(*HEAD).agg(F.sum((F.col("n") - 1) * F.col("chars")).alias("stretch"))
        goes_on = F.col("end") > F.col("at")
        levels.append(stage(tip.join(whole, HEAD, "left").select(
            F.col("head").alias("conv_id"), F.col("at").alias("depth"), F.when(goes_on, 1).otherwise(F.col("n_children")).cast("bigint").alias("n_children"),
            "n_leaves", (F.col("saved") + F.coalesce("stretch", F.lit(0))).alias("saved"),
        ), "below"))
        tip_of = F.col("pos") + 1 == F.col("end")
        inner.append(later.select(*HEAD, "n", "pos", "chars", "after").join(tip.select(*HEAD, "end", "n_children", "n_leaves", "saved"), HEAD).select(
            F.col("head").alias("conv_id"), (F.col("pos") + 1).alias("depth"), F.col("head").alias("parent_conv_id"), F.col("n").alias("n_convs"),
            F.when(tip_of, F.col("n_children")).otherwise(1).cast("bigint").alias("n_children"), "n_leaves",
            (F.col("saved") + F.col("after") + (F.col("n") - 1) * F.col("chars")).alias("saved_tokens"),
        ))
    named = _union(heads).join(_union(levels), ["conv_id", "depth"]).select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves",
        (F.col("saved") + (F.col("n") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    digests = digests_of_ends(_union(ends))
    upper = _union([named, *inner]).join(digests, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY)))
    return _union([upper.select(*NODE_COLUMNS), swept.where("n_convs is not null"), alone])


_CRC = "list_reduce([CAST(4294967295 AS UBIGINT)] || flatten([[CAST(ord(x) AS UBIGINT)] || [CAST(999 AS UBIGINT) FOR i IN range(8)] FOR x IN string_split(CAST(c AS VARCHAR), '')]), lambda s, x: CASE WHEN x < 256 THEN xor(s, x) WHEN s & 1 = 1 THEN xor(s >> 1, CAST(3988292384 AS UBIGINT)) ELSE s >> 1 END)"
#: The same by SQL, over lists of whole turns. The checksum is made bit by bit: 999 stands for a shift.
ORACLE = f"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos,
    struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS x
  FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, c - c % 100 AS base, CAST(xor({_CRC}, CAST(4294967295 AS UBIGINT)) % 6 AS BIGINT) AS h FROM (SELECT DISTINCT c FROM t)),
s AS (
  SELECT h.c, coalesce(a.l, []) || coalesce(b.l, []) AS l
  FROM h
  LEFT JOIN (SELECT h.c, list(x ORDER BY pos) AS l FROM h JOIN t ON t.c = h.base AND t.pos < h.h GROUP BY h.c) a ON a.c = h.c
  LEFT JOIN (SELECT h.c, list(x ORDER BY pos) AS l FROM h JOIN t ON t.c = h.c AND t.pos >= h.h GROUP BY h.c) b ON b.c = h.c),
p AS (SELECT c, d AS depth, len(l) AS size, l[1:d] AS k FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM s)),
n AS (
  SELECT depth, k, min(c) AS conv_id, count(*) AS n_convs, coalesce(length(any_value(k[depth].t)), 0) * (count(*) - 1) AS saved,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (size = depth), '')) AS ends_sha256
  FROM p GROUP BY depth, k),
m AS (SELECT p.c, p.depth, n.conv_id FROM p JOIN n ON n.depth = p.depth AND n.k = p.k),
kids AS (
  SELECT m.conv_id, m.depth, count(*) AS n_children FROM n JOIN m ON m.c = n.conv_id AND m.depth = n.depth - 1 GROUP BY m.conv_id, m.depth),
own AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (conv_id, depth)),
sub AS (
  SELECT m.conv_id, m.depth, count(*) FILTER (x.n_children = 0) AS n_leaves, sum(x.saved) AS saved_tokens
  FROM own x JOIN m ON m.c = x.conv_id AND m.depth <= x.depth GROUP BY m.conv_id, m.depth)
SELECT own.conv_id, own.depth, up.conv_id AS parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM own JOIN sub USING (conv_id, depth) LEFT JOIN m up ON up.c = own.conv_id AND up.depth = own.depth - 1"""
