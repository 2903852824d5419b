"""Prefix trie of conversations by fixed-length block hashing.

A conversation's turns are cut into blocks of ``BLOCK`` turns. Every turn has a
128-bit hash of its place, role and text; a prefix's digest is their exclusive
or, so a block's digest is an aggregate and prefixes of blocks are a running
one. Conversations are first grouped by successive block digests. Where all
that share a prefix go on with one and the same block, every turn boundary in
it has the same members, and one conversation's turns stand for all. Only in
blocks where siblings diverge are the boundaries refined by turn digests.

A node's smallest member names it, and the nodes that one conversation names
are a run of depths on its path. So a sum over a subtree is the sum, over the
node's members, of what each one's own nodes hold, less what the node's own
conversation holds above it: two aggregates, however deep the trie is.

All groups are aggregates that combine before the shuffle; running values of a
conversation are taken over chunks of it and then over the chunks' totals, so a
conversation or a first turn with a third of all rows is no single task's work.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import written

BLOCK = 8
#: Turns, blocks or nodes of a conversation that one window sees.
CHUNK = 64
#: Ids that are joined to one text before hashing.
IDS = 50_000

_NODE = ["depth", "x1", "x2"]
_XOR = (F.bit_xor, lambda a, b: a.bitwiseXOR(b))
_SUM = (F.sum, lambda a, b: a + b)


def _running(df: DataFrame, key: str, place: str, chunk: Column, how: tuple, sums: dict[str, str],
             order: list[Column] | None = None) -> DataFrame:
    """``df`` with inclusive running values ``sums`` (name: column) along
    ``place`` of each ``key``, by chunks of ascending ``chunk`` numbers."""
    total, plus = how
    df = df.withColumn("_chunk", chunk)
    inner = (Window.partitionBy(key, "_chunk").orderBy(*(order or [F.col(place)]))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    carried = (df.groupBy(key, "_chunk").agg(*[total(c).alias(f"_t_{n}") for n, c in sums.items()])
               .select(key, "_chunk", *[F.coalesce(total(f"_t_{n}").over(before), zero).alias(f"_c_{n}")
                                        for n in sums]))
    local = df.select("*", *[total(c).over(inner).alias(f"_l_{n}") for n, c in sums.items()])
    return local.join(carried, [key, "_chunk"]).select(
        *[c for c in df.columns if c != "_chunk"],
        *[plus(F.col(f"_l_{n}"), F.col(f"_c_{n}")).cast("long").alias(n) for n in sums])


def placed(conversations: DataFrame) -> DataFrame:
    """(conv, pos, t1, t2, chars): each conversation's turns from 1 on, by turn
    (null first), then role, then text; a null role or text is empty; rows
    without conv_id belong to no conversation."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = (conversations.where("conv_id is not null")
            .select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                    text("role").alias("role"), text("text").alias("text"), F.lit(1).cast("long").alias("one")))
    chunk = F.floor(F.coalesce(F.col("turn"), F.lit(-2**63)) / F.lit(CHUNK)).cast("long")
    ranked = _running(rows, "conv", "turn", chunk, _SUM, {"pos": "one"},
                      [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")])
    return ranked.select("conv", "pos", F.xxhash64("role", "text").alias("t1"),
                         F.xxhash64(F.lit(1), "role", "text").alias("t2"),
                         F.char_length("text").cast("long").alias("chars"))


def rebuilt(turns: DataFrame, every: int = 100, shares: int = 6) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) where conversation c has the first h turns of
    c - c % every in place of its own first h; h = crc32(decimal c) % shares."""
    own = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    lender = own.select(F.col("conv").alias("lender"), F.col("n").alias("lent"))
    plan = (own.select("conv", (F.col("conv") - F.col("conv") % every).alias("lender"),
                       (F.crc32(F.col("conv").cast("string").cast("binary")) % shares).alias("h"))
            .join(lender, "lender", "left")
            .select("conv", "lender", "h", F.least("h", F.coalesce("lent", F.lit(0))).alias("lent")))
    heads = (turns.where(F.col("pos") < shares).withColumnRenamed("conv", "lender")
             .join(plan.select("conv", "lender", "h"), "lender").where("pos <= h"))
    tails = (turns.join(plan.select("conv", "h", "lent"), "conv").where("pos > h")
             .withColumn("pos", F.col("pos") - F.col("h") + F.col("lent")))
    columns = ["conv", "pos", "t1", "t2", "chars"]
    return heads.select(*columns).union(tails.select(*columns)), plan.select("conv")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ascending ids of each node as texts of up to ``IDS`` ids, in order."""
    def row(node, ids):
        return pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()),
                                           pa.array([node[2]], pa.int64()), pa.array([ids[0]], pa.int64()),
                                           pa.array([",".join(map(str, ids))], pa.string())],
                                          names=[*_NODE, "conv", "ids"])
    last, held = None, []
    for batch in batches:
        for *node, conv in zip(*[c.to_pylist() for c in batch.columns]):
            if held and (node != last or len(held) >= IDS):
                yield row(last, held)
                held = []
            last = node
            held.append(conv)
    if held:
        yield row(last, held)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's texts, joined by commas, read as they come."""
    def row(node, digest):
        return pa.RecordBatch.from_arrays([*[pa.array([v], pa.int64()) for v in node],
                                           pa.array([digest.hexdigest()], pa.string())],
                                          names=[*_NODE, "ends_sha256"])
    last, digest = None, None
    for batch in batches:
        for *node, _, ids in zip(*[c.to_pylist() for c in batch.columns]):
            if node != last:
                if digest is not None:
                    yield row(last, digest)
                last, digest = node, sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
    if digest is not None:
        yield row(last, digest)


def _ends(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes at which conversations end. Ids are
    joined in sorted ranges; a node's texts, not its rows, then meet."""
    sizes = ends.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("m"), F.min("conv").alias("first"))
    single = sizes.where("m = 1").select(*_NODE, F.sha2(F.col("first").cast("string"), 256).alias("ends_sha256"))
    several = ends.join(sizes.where("m > 1").select(*_NODE), _NODE).select(*_NODE, "conv")
    texts = (several.repartitionByRange(*_NODE, "conv").sortWithinPartitions(*_NODE, "conv")
             .mapInArrow(_joined, "depth long, x1 long, x2 long, conv long, ids string"))
    joined = (texts.repartition(*_NODE).sortWithinPartitions(*_NODE, "conv")
              .mapInArrow(_digested, "depth long, x1 long, x2 long, ends_sha256 string"))
    return single.union(joined)


def trie(turns: DataFrame, conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256) of every node, the root too, of the trie of
    ``turns`` (see :func:`placed`) and all ``conversations`` (conv), which may
    have no turns. Without conversations there is no node."""
    e1, e2 = F.xxhash64("pos", "t1", "t2"), F.xxhash64(F.lit(1), "pos", "t1", "t2")
    turns = written(turns.select("conv", "pos", "chars", e1.alias("e1"), e2.alias("e2"),
                                 F.floor((F.col("pos") - 1) / block).cast("long").alias("blk")), "turns")
    whole = written(conversations.join(
        turns.groupBy("conv").agg(F.count(F.lit(1)).alias("depth"), F.bit_xor("e1").alias("x1"),
                                  F.bit_xor("e2").alias("x2")), "conv", "left")
        .na.fill(0, _NODE).select("conv", *_NODE), "conversations")

    # groups of conversations by successive block digests
    digests = turns.groupBy("conv", "blk").agg(F.bit_xor("e1").alias("b1"), F.bit_xor("e2").alias("b2"))
    blocks = _running(digests, "conv", "blk", F.floor(F.col("blk") / CHUNK).cast("long"), _XOR,
                      {"c1": "b1", "c2": "b2"})
    blocks = written(blocks.select("conv", "blk", "c1", "c2", F.col("b1").bitwiseXOR(F.col("c1")).alias("p1"),
                                   F.col("b2").bitwiseXOR(F.col("c2")).alias("p2")), "blocks")
    groups = blocks.groupBy("blk", "c1", "c2").agg(
        F.count(F.lit(1)).alias("m"), F.min("conv").alias("first"), F.first("p1").alias("p1"), F.first("p2").alias("p2"))
    siblings = groups.groupBy("blk", "p1", "p2").agg(F.count(F.lit(1)).alias("kinds"))
    groups = written(groups.join(siblings, ["blk", "p1", "p2"]).withColumn("alone", F.col("kinds") == 1), "groups")

    # turn boundaries: of one conversation where a block is alone, of all others where siblings diverge
    inside = Window.partitionBy("conv", "blk").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = blocks.join(groups.select("blk", "c1", "c2", "m", "first", "alone"), ["blk", "c1", "c2"])
    wanted = marked.where("not alone or conv = first").select("conv", "blk", "p1", "p2", "c1", "c2", "m", "alone")
    bounds = written(turns.join(wanted, ["conv", "blk"]).select(
        "conv", F.col("pos").alias("depth"), "chars", "alone", "blk", "c1", "c2", "m", "e1", "e2",
        F.bit_xor("e1").over(inside).bitwiseXOR(F.col("p1")).alias("x1"),
        F.bit_xor("e2").over(inside).bitwiseXOR(F.col("p2")).alias("x2")), "boundaries")
    parent = [F.col(f"x{k}").bitwiseXOR(F.col(f"e{k}")).alias(f"q{k}") for k in (1, 2)]
    shared = bounds.where("alone").select(*_NODE, "conv", "m", "chars", *parent)
    refined = (bounds.where("not alone").select(*_NODE, "conv", "chars", *parent).groupBy(*_NODE).agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("m"), F.first("chars").alias("chars"),
        F.first("q1").alias("q1"), F.first("q2").alias("q2")))
    zero = F.lit(0).cast("long")
    root = (conversations.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("m")).where("m > 0")
            .select(*[zero.alias(c) for c in _NODE], "conv", "m", zero.alias("chars"), zero.alias("q1"), zero.alias("q2")))
    columns = [*_NODE, "conv", "m", "chars", "q1", "q2"]
    nodes = shared.select(*columns).union(refined.select(*columns)).union(root.select(*columns))
    kids = (nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("x1"),
                                             F.col("q2").alias("x2")).agg(F.count(F.lit(1)).alias("kids")))
    nodes = written(nodes.join(kids, _NODE, "left").na.fill(0, ["kids"])
                    .withColumn("w", (F.col("m") - 1) * F.col("chars")), "nodes")

    # what each conversation's own nodes hold, and its sum over the members of every node
    leaf = whole.join(nodes.where("kids = 0").select(*_NODE, F.col("conv")), [*_NODE, "conv"], "left_semi")
    held = (whole.select("conv")
            .join(nodes.groupBy("conv").agg(F.sum("w").alias("held")), "conv", "left")
            .join(leaf.select("conv", F.lit(1).cast("long").alias("leaf")), "conv", "left").na.fill(0))
    held = written(held.where("held > 0 or leaf > 0"), "held")
    sums = [F.sum("held").alias("held"), F.sum("leaf").alias("leaves")]
    of_group = (blocks.join(held, "conv").groupBy("blk", "c1", "c2").agg(*sums)
                .join(groups.where("alone").select("blk", "c1", "c2"), ["blk", "c1", "c2"]))
    of_shared = bounds.where("alone").select(*_NODE, "blk", "c1", "c2").join(of_group, ["blk", "c1", "c2"])
    of_refined = bounds.where("not alone").select("conv", *_NODE).join(held, "conv").groupBy(*_NODE).agg(*sums)
    of_root = held.agg(*sums).select(*[zero.alias(c) for c in _NODE], "held", "leaves")
    columns = [*_NODE, "held", "leaves"]
    totals = of_shared.select(*columns).union(of_refined.select(*columns)).union(of_root.select(*columns))

    above = _running(nodes.select(*_NODE, "conv", "m", "kids", "q1", "q2", "w"), "conv", "depth",
                     F.floor(F.col("depth") / CHUNK).cast("long"), _SUM, {"run": "w"})
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("q1"), F.col("x2").alias("q2"),
                           F.col("conv").alias("parent_conv_id"))
    return (above.join(totals, _NODE, "left").na.fill(0, ["held", "leaves"])
            .join(parents, ["depth", "q1", "q2"], "left").join(_ends(whole), _NODE, "left")
            .select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("m").alias("n_convs"),
                    F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"),
                    (F.col("held") - F.col("run") + F.col("w")).alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie (see :func:`trie`) of ``conversations`` (conv_id, turn, role,
    text) as they are. Repeated rows are turns of their own; other columns are
    ignored; an empty table has no node."""
    turns = written(placed(conversations), "placed")
    return trie(turns, turns.select("conv").distinct())


def rebuilt_trie(conversations: DataFrame, every: int = 100, shares: int = 6) -> DataFrame:
    """The trie of the conversations after :func:`rebuilt`."""
    return trie(*rebuilt(written(placed(conversations), "placed"), every, shares))
