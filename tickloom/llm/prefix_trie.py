"""Trie of conversation prefixes by ROLLUP over positional turn columns.

A conversation is cut into column blocks of WIDTH turns. A block row carries the identity of the
node that the blocks before it end in, and its turns as WIDTH columns; a ROLLUP over those columns,
grouped by the node before, aggregates the prefixes of all lengths together. A node's identity is
an order-free sum of one hash per (position, turn), so every block knows the node before it without
walking the blocks one after the other: long conversations add rows, not passes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import small_batches
from tickloom.operators.series import Series
from tickloom.session import staged

#: Turns of a block, and blocks whose running identities one window group sums up.
WIDTH, RUN = 8, 4096
#: Ids that are joined to one string.
IDS = 16_384
TURNS = [f"t{i}" for i in range(WIDTH)]


def ordered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, pos (from 0), turn (32 bytes that stand for role and text), bytes (of the text).

    Turns are ordered by ``turn_col``, null first, and by the SHA-256 of their role and text where
    that is equal; repeated rows are turns of their own. A null role or text is empty; a row
    without conversation id belongs to none. Positions come from range partitions, so that a
    conversation with a third of all rows is numbered by many tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = staged(turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("at"),
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("turn"),
        F.octet_length(text).cast("long").alias("bytes")), "turns")
    return Series(keys=("conv",), ts="at", ties=("turn",)).numbered(rows).select(
        "conv", F.col("_at").cast("long").alias("pos"), "turn", "bytes")


def share_heads(turns: DataFrame, group: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as their group's first one: (conv), and (conv, pos, turn, bytes).

    Conversation c takes the first h turns of conversation c - c % ``group`` (all if there are
    fewer, none if it is absent) in place of its own first h, with h = crc32 of its decimal id
    modulo ``most`` + 1. A head is at most ``most`` turns, so it travels as one array.
    """
    kept = staged(turns, "ordered")
    heads = (kept.where((F.col("pos") < most) & (F.col("conv") % group == 0))
             .groupBy(F.col("conv").alias("base"))
             .agg(F.sort_array(F.collect_list(F.struct("pos", "turn", "bytes"))).alias("head")))
    convs = kept.select("conv").distinct().select(
        "conv", (F.col("conv") - F.col("conv") % group).alias("base"),
        (F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)).alias("own_from"))
    convs = staged(convs.join(heads, "base", "left").select(
        "conv", "own_from", F.slice(F.coalesce("head", F.array().cast(
            "array<struct<pos:bigint,turn:binary,bytes:bigint>>")), 1, F.col("own_from").cast("int"))
        .alias("head")), "heads")
    first = convs.select("conv", F.explode("head").alias("x")).select("conv", "x.*")
    rest = (kept.join(convs.select("conv", "own_from", F.size("head").alias("n_head")), "conv")
            .where("pos >= own_from")
            .select("conv", F.expr("pos - own_from + n_head").alias("pos"), "turn", "bytes"))
    return convs.select("conv"), first.union(rest)


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Per distinct sequence of first turns (a node): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``convs`` (conv: distinct integers) lists the members of the textless root; ``turns`` (conv,
    pos without gaps from 0, turn, bytes) are theirs, in any order. The first ROLLUP finds each
    node's smallest member, its owner. Every node has one owner, and a conversation owns the nodes
    of its path from some depth on, so what a subtree sums up is a sum over members: leaves count
    at the members that own a leaf, and saved bytes follow from the bytes of the nodes that each
    member does not own. The second ROLLUP sums those; nothing is spread over ancestors.

    ends_sha256 hashes the ids of the conversations that end in the node, ascending. SHA-256 has no
    parts that could be combined: ids become strings of IDS each in parallel, and a node's strings
    run through one task as a stream, of which one Arrow batch is held at a time.

    Columns are those named, others are not looked at. Without conversations there is no node.
    """
    blocks = _blocks(convs, turns)
    first = _rollup(blocks, "min(conv) AS conv, max(n_turns) AS longest")
    text = F.coalesce(*[F.when(F.col("kept") == i + 1, F.col(f"b{i}")) for i in range(WIDTH)],
                      F.lit(0))
    owners = first.groupBy("conv").agg(
        F.sum(text).alias("owned"),
        F.sum((F.col("longest") == F.col("depth")).cast("long")).alias("leaves"))
    shares = (blocks.join(owners, "conv", "left")
              .withColumns({"shared": F.col("all_bytes") - F.coalesce("owned", F.lit(0)),
                            "leaves": F.coalesce("leaves", F.lit(0))}))
    nodes = _rollup(shares, "min(conv) AS conv, sum(leaves) AS n_leaves, sum(shared) AS shared, "
                            "min_by(shared, conv) AS owner_shared")
    before = sum((F.when(F.col("kept") > i + 1, F.col(f"b{i}")).otherwise(0)
                  for i in range(WIDTH - 1)), F.col("bytes_before"))
    nodes = staged(nodes.select(
        "depth", _node(F.col("kept")).alias("node"), _node(F.col("kept") - 1).alias("parent"),
        "conv", "n_convs", "n_leaves", (F.col("shared") - F.col("owner_shared")
                                        - (F.col("n_convs") - 1) * before).alias("saved")), "nodes")
    parents = nodes.select(F.col("node").alias("parent"), (F.col("depth") + 1).alias("depth"),
                           F.col("conv").alias("parent_conv_id"))
    children = nodes.where("depth > 0").groupBy(
        F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"))
    return (nodes.join(parents, ["parent", "depth"], "left").join(children, ["node", "depth"], "left")
            .join(_ends(blocks), ["node", "depth"], "left")
            .select(F.col("conv").alias("conv_id"), F.col("depth").cast("long"), "parent_conv_id",
                    "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
                    "n_leaves", F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
                    .alias("ends_sha256")))


def _lanes(pos: Column, turn: Column) -> list[Column]:
    return [F.xxhash64(F.lit(seed), pos, turn) for seed in (13, 31)]


def _blocks(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """A row per conversation and block of WIDTH turns; one for a conversation without turns."""
    slot = F.col("pos") % WIDTH
    rows = turns.unionByName(convs.select("conv"), allowMissingColumns=True)
    block = F.coalesce(F.expr(f"pos div {WIDTH}"), F.lit(0))
    made = rows.groupBy("conv", block.alias("block")).agg(
        *[F.max(F.when(slot == i, F.col("turn"))).alias(t) for i, t in enumerate(TURNS)],
        *[F.max(F.when(slot == i, F.col("bytes"))).alias(f"b{i}") for i in range(WIDTH)],
        F.count("pos").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        *[F.coalesce(F.bit_xor(F.when(F.col("pos").isNotNull(), lane)), F.lit(0)).alias(f"x{i}")
          for i, lane in enumerate(_lanes(F.col("pos"), F.col("turn")))])
    made = staged(made.withColumn("run", F.expr(f"block div {RUN}")), "blocks")
    # Running identities: within runs of blocks, and over the totals of runs.
    sums = {"n": F.sum, "bytes": F.sum, "x0": F.bit_xor, "x1": F.bit_xor}
    runs = made.groupBy("conv", "run").agg(*[f(c).alias(c) for c, f in sums.items()])
    earlier = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv")
    runs = runs.select("conv", "run", F.sum("n").over(whole).alias("n_turns"),
                       F.sum("bytes").over(whole).alias("all_bytes"),
                       *[F.coalesce(f(c).over(earlier), F.lit(0)).alias(f"{c}_run")
                         for c, f in sums.items() if c != "n"])
    inside = (Window.partitionBy("conv", "run").orderBy("block")
              .rowsBetween(Window.unboundedPreceding, -1))
    within = {c: F.coalesce(f(c).over(inside), F.lit(0)) for c, f in sums.items() if c != "n"}
    return staged(
        made.withColumns({f"{c}_in": x for c, x in within.items()}).join(runs, ["conv", "run"]).select(
            "conv", "block", "n_turns", "all_bytes", *TURNS, *[f"b{i}" for i in range(WIDTH)],
            (F.col("bytes_in") + F.col("bytes_run")).alias("bytes_before"),
            *[F.col(f"x{i}_in").bitwiseXOR(F.col(f"x{i}_run")).alias(f"p{i}") for i in (0, 1)],
            *[F.col(f"x{i}_in").bitwiseXOR(F.col(f"x{i}_run")).bitwiseXOR(F.col(f"x{i}"))
              .alias(f"e{i}") for i in (0, 1)]), "keyed_blocks")


def _rollup(blocks: DataFrame, aggregates: str) -> DataFrame:
    """All nodes: block, node before, turns, ``kept`` (turn columns of the node), ``depth``, its
    turns' bytes, n_convs and the aggregates. The bytes before the block and of a node's turns are
    the same for all members."""
    sizes = ", ".join(f"max(b{i}) AS b{i}" for i in range(WIDTH))
    out = blocks.sparkSession.sql(
        f"SELECT block, p0, p1, {', '.join(TURNS)}, {WIDTH} - bit_count(grouping_id()) AS kept, "
        f"count(*) AS n_convs, max(bytes_before) AS bytes_before, {sizes}, {aggregates} "
        f"FROM {{blocks}} GROUP BY block, p0, p1, ROLLUP({', '.join(TURNS)})", blocks=blocks)
    # A null column that is not rolled up stands behind a conversation's end; with all rolled up,
    # the node is that of the block before, or the root.
    real = F.coalesce(*[F.when(F.col("kept") == i + 1, F.col(t).isNotNull())
                        for i, t in enumerate(TURNS)], F.col("block") == 0)
    return out.where(real).withColumn("depth", F.col("block") * WIDTH + F.col("kept"))


def _node(kept: Column) -> Column:
    """Identity of the node that a block's first ``kept`` turns lead to."""
    lanes = [F.col("p0"), F.col("p1")]
    for i, t in enumerate(TURNS):
        found = _lanes(F.col("block") * WIDTH + i, F.col(t))
        lanes = [a.bitwiseXOR(F.when(kept > i, b).otherwise(0)) for a, b in zip(lanes, found)]
    return F.struct(lanes[0].alias("a"), lanes[1].alias("b"))


def _ends(blocks: DataFrame) -> DataFrame:
    """node, depth, ends_sha256 of the nodes in which conversations end."""
    last = staged(blocks.where(F.col("n_turns") <= (F.col("block") + 1) * WIDTH).select(
        F.col("e0").alias("a"), F.col("e1").alias("b"), F.col("n_turns").alias("depth"), "conv"), "ends")
    small_batches(blocks.sparkSession)
    strings = (Series(keys=("a", "b", "depth"), ts="conv", block_rows=IDS).dealt(last)
               .groupBy("a", "b", "depth", "_slice")
               .agg(F.min("conv").alias("low"), F.array_join(F.transform(
                   F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            out = []
            for a, b, depth, ids in zip(*(batch.column(c).to_pylist()
                                          for c in ("a", "b", "depth", "ids"))):
                if (a, b, depth) == current:
                    state.update(b"," + ids.encode())
                    continue
                if current:
                    out.append((*current, state.hexdigest()))
                current, state = (a, b, depth), hashlib.sha256(ids.encode())
            yield from _digests(out)
        if current:
            yield from _digests([(*current, state.hexdigest())])

    return (strings.repartition("a", "b", "depth").sortWithinPartitions("a", "b", "depth", "low")
            .select("a", "b", "depth", "ids")
            .mapInArrow(digest, "a long, b long, depth long, ends_sha256 string")
            .select(F.struct("a", "b").alias("node"), "depth", "ends_sha256"))


def _digests(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if rows:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                         ["a", "b", "depth", "ends_sha256"])
