"""Conversation prefix trie: every prefix of every conversation by SQL ROLLUP over blocks of turn columns."""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.joins import lookup
from tidemark.sources.storage import shared_dir

WORD = r"[^\x20\x09-\x0D]+"
#: Turns in the columns of one block; longer conversations go on in further blocks.
BLOCK = 8
#: Rows of a conversation that one window takes; longer runs are summed run by run.
RUN = 4096
#: Ids that are joined into one string on their way to the digest.
PACK = 10_000

_NODE = ["na", "nb"]
_EMPTY = hashlib.sha256(b"").hexdigest()


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv``, ``turn``, two halves of the digest of role and text (``a``, ``b``), ``words``, ``tie``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    half = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint")
    return conversations.select(
        F.col(conv).cast("bigint").alias("conv"),
        F.col(turn).cast("bigint").alias("turn"),
        half(1).alias("a"),
        half(16).alias("b"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
        F.monotonically_increasing_id().alias("tie"),
    ).where("conv IS NOT NULL")


def _in_order(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns sorted over all tasks, and for each conversation and range where its rows begin.

    A conversation may span many ranges, so one of any length is no hot task.
    """
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("a"), F.col("b"), F.col("tie")]
    rows = (
        turns.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "conv", "a", "b", "words",
            F.spark_partition_id().alias("range"),
            F.monotonically_increasing_id().alias("row"),
        )
        .checkpoint()
    )
    starts = rows.groupBy("conv", "range").agg(F.min("row").alias("first"), F.count("*").alias("rows"))
    mine = Window.partitionBy("conv")
    before = F.sum("rows").over(mine.orderBy("range")) - F.col("rows")
    starts = starts.withColumn("before", before).withColumn("size", F.sum("rows").over(mine))
    return rows, starts


def _rebuilt(rows: DataFrame, starts: DataFrame, shared: tuple[int, int] | None) -> tuple[DataFrame, DataFrame]:
    """``conv``, ``pos`` and turn of every rebuilt conversation; its ``length`` by ``conv``."""
    pos = F.col("row") - F.col("first") + F.col("before")
    heads = F.lit(0)
    convs = starts.groupBy("conv").agg(F.max("size").alias("size"))
    if shared:
        group, most = shared
        heads = F.crc32(F.col("conv").cast("string")) % most
        base = F.col("conv") - F.col("conv") % group
        openers = starts.where((F.col("conv") % group == 0) & (F.col("before") < most - 1))
        openers = rows.join(openers, ["conv", "range"]).where(pos < most - 1)
        # At most most - 1 turns each.
        turn = F.struct(pos.alias("pos"), "a", "b", "words")
        openers = openers.groupBy("conv").agg(F.array_sort(F.collect_list(turn)).alias("head"))
        openers = openers.select(F.col("conv").alias("base"), "head")
        convs = convs.withColumn("h", heads).withColumn("base", base).join(openers, "base", "left")
        head = F.when(F.col("h") > 0, F.slice("head", 1, F.greatest("h", F.lit(1)).cast("int")))
        convs = convs.withColumn("head", head).drop("base")
        convs = convs.withColumn("given", F.coalesce(F.size("head"), F.lit(0)).cast("bigint"))
        convs = convs.withColumn("given", F.greatest("given", F.lit(0)))
    else:
        convs = convs.withColumns({"h": F.lit(0), "given": F.lit(0)})
    length = F.col("given") + F.greatest(F.col("size") - F.col("h"), F.lit(0))
    convs = convs.withColumn("length", length).checkpoint()
    moved = starts.join(convs.select("conv", "h", "given"), "conv")
    own = rows.join(moved, ["conv", "range"]).where(pos >= F.col("h"))
    own = own.select("conv", (pos - F.col("h") + F.col("given")).alias("pos"), "a", "b", "words")
    if shared:
        given = convs.select("conv", F.explode("head").alias("t")).select("conv", "t.*")
        own = own.unionByName(given)
    return own, convs.select("conv", "length")


def _running(rows: DataFrame, key: str, at: str, add, names: list[str], run: int) -> DataFrame:
    """Adds, as ``before_<name>``, the aggregate of the rows of the key that come earlier by ``at``.

    ``add`` aggregates a column; it must give the same whatever the grouping, as
    sums do. Windows take ``run`` rows at most; runs of longer keys are
    aggregated first, then the runs before each are.
    """
    part = F.floor(F.col(at) / run)
    inner = Window.partitionBy(key, "part").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("part", part)
    parts = rows.groupBy(key, "part").agg(*(add(n).alias(n) for n in names))
    parts = parts.select(key, "part", *(F.coalesce(add(n).over(outer), F.lit(0)).alias(f"past_{n}") for n in names))
    for n in names:
        rows = rows.withColumn(f"before_{n}", F.coalesce(add(n).over(inner), F.lit(0)))
    return rows.join(parts.hint("merge"), [key, "part"])


def _hash(lane: int, pos: Column, turn: Column) -> Column:
    return F.xxhash64(F.lit(lane), pos, turn["a"], turn["b"])


def _blocks(turns: DataFrame, convs: DataFrame, block: int, run: int) -> DataFrame:
    """A row per conversation and block: its turns in columns, and ``ka``, ``kb`` of the node before it.

    A node is known by two 64-bit values: the exclusive or of a hash of each
    turn with its position. Conversations without turns have one empty block.
    """
    turn = F.struct("a", "b", "words")
    hashed = turns.select("conv", "pos", turn.alias("t"), *(
        _hash(lane, F.col("pos").cast("bigint"), F.struct("a", "b")).alias(n) for lane, n in ((1, "xa"), (2, "xb"))
    ))
    blocks = hashed.groupBy("conv", F.floor(F.col("pos") / block).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "t"))).alias("ts"),
        F.bit_xor("xa").alias("xa"),
        F.bit_xor("xb").alias("xb"),
    )
    columns = [F.get(F.col("ts"), F.lit(j))["t"].alias(f"t{j}") for j in range(block)]
    blocks = blocks.select("conv", "block", "xa", "xb", *columns).checkpoint()
    blocks = _running(blocks, "conv", "block", F.bit_xor, ["xa", "xb"], run)
    key = {f"k{x}": F.col(f"before_x{x}").bitwiseXOR(F.col(f"past_x{x}")) for x in "ab"}
    blocks = blocks.withColumns(key)
    bare = convs.where("length = 0").select("conv", *(F.lit(0).cast("bigint").alias(c) for c in ("block", "xa", "xb", "ka", "kb")))
    blocks = blocks.drop("part", "before_xa", "before_xb", "past_xa", "past_xb")
    return blocks.unionByName(bare, allowMissingColumns=True).checkpoint()


def _rolled(blocks: DataFrame, block: int, *aggregates: str) -> DataFrame:
    """The aggregates for every prefix: ``na``, ``nb``, ``depth``, ``last`` (its last turn)."""
    spark = blocks.sparkSession
    ts = [f"t{j}" for j in range(block)]
    rolled = spark.sql(
        f"SELECT block, ka, kb, grouping_id() AS g, {', '.join(ts)}, {', '.join(aggregates)}"
        f" FROM {{blocks}} GROUP BY block, ka, kb, ROLLUP({', '.join(ts)})",
        blocks=blocks,
    )
    inside = F.lit(block) - F.bit_count("g")
    rolled = rolled.withColumn("inside", inside)
    rolled = rolled.withColumn("last", F.get(F.array(*ts), F.col("inside") - 1))
    # Shorter conversations leave empty columns; a block's own top is the last node of the block before.
    rolled = rolled.where("last IS NOT NULL OR (inside = 0 AND block = 0)")
    first = F.col("block") * block
    for lane, key, node in ((1, "ka", "na"), (2, "kb", "nb")):
        found = (
            F.when(F.col(t).isNotNull(), _hash(lane, first + j, F.col(t))).otherwise(F.lit(0))
            for j, t in enumerate(ts)
        )
        rolled = rolled.withColumn(node, reduce(lambda x, y: x.bitwiseXOR(y), found, F.col(key)))
    return rolled.withColumn("depth", first + F.col("inside")).drop("block", "ka", "kb", "g", "inside", *ts)


def _ends(blocks: DataFrame, convs: DataFrame, block: int) -> DataFrame:
    """``na``, ``nb`` and ``sha``: the SHA-256 of the ids of the conversations that end there.

    Ids are sorted over all tasks and joined into strings there; the strings of
    a node are hashed one after another, so none is ever whole in memory.
    """
    last = F.greatest(F.ceil(F.col("length") / block) - 1, F.lit(0))
    ends = blocks.join(convs.select(F.col("conv").alias("c"), last.alias("last")).hint("merge"),
                       (F.col("conv") == F.col("c")) & (F.col("block") == F.col("last")))
    ends = ends.select(
        F.col("ka").bitwiseXOR(F.col("xa")).alias("na"), F.col("kb").bitwiseXOR(F.col("xb")).alias("nb"), "conv"
    )

    def pack(batches):
        held, ids = None, []
        for batch in batches:
            out = []
            for a, b, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and ((a, b) != held or len(ids) >= PACK):
                    out.append((*held, ids[0], ",".join(map(str, ids))))
                    ids = []
                held = a, b
                ids.append(conv)
            yield _packed(out)
        if ids:
            yield _packed([(*held, ids[0], ",".join(map(str, ids)))])

    def digest(batches):
        held, sha = None, None
        for batch in batches:
            out = []
            for a, b, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (a, b) != held:
                    if held:
                        out.append((*held, sha.hexdigest()))
                    held, sha = (a, b), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield _digests(out)
        if held:
            yield _digests([(*held, sha.hexdigest())])

    order = ["na", "nb", "conv"]
    packed = ends.repartitionByRange(*order).sortWithinPartitions(*order)
    packed = packed.mapInArrow(pack, "na bigint, nb bigint, first bigint, ids string")
    packed = packed.repartition(*_NODE).sortWithinPartitions(*_NODE, "first")
    return packed.mapInArrow(digest, "na bigint, nb bigint, sha string")


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    a, b, first, ids = zip(*rows) if rows else ((),) * 4
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((a, b, first, ids), kinds)], ["na", "nb", "first", "ids"])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    a, b, sha = zip(*rows) if rows else ((),) * 3
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((a, b, sha), kinds)], ["na", "nb", "sha"])


def prefix_tree(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    shared: tuple[int, int] | None = None,
    block: int = BLOCK,
    run: int = RUN,
) -> DataFrame:
    """A row per node of the trie of all conversations.

    A node is a distinct sequence of first ``depth`` turns (role and text); its
    members are the conversations that begin with it. Columns: ``conv_id`` (the
    smallest member), ``depth``, ``parent_conv_id`` (null for the root),
    ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes at or below it),
    ``saved_tokens`` (over all nodes at or below it, the words of the last turn
    times the members but one: what a cache of prefixes saves) and
    ``ends_sha256`` (of the ascending ids of the members that end there, comma-joined).

    ``shared=(group, most)`` first rebuilds every conversation: the first h
    turns of the conversation whose id is c - c % group, then its own after its
    first h, where h is the CRC-32 of its id modulo ``most``.

    Turns are put in order over all tasks and laid out in blocks of ``block``
    columns, one row per conversation and block, keyed by the node of the block
    before; one ROLLUP over the columns aggregates the prefixes of all blocks
    together. What lies below a node is summed by a second ROLLUP: every node is
    owned by its smallest member, the owned part of a member's path is its end,
    so all of what members own lies below, but for the owner's part above the node.
    So no step goes level by level, however deep the trie.

    Null roles and texts count as empty. Turns come by ``turn_col``, null first,
    then equal ones by a digest of role and text; repeated rows are turns of
    their own. Rows with a null id belong to no conversation. A conversation
    that is left without turns is a member of the root. No rows: no nodes, not
    even the root. Turns are equal if 120 bits of their SHA-256 are, nodes if
    128 bits of hashes of their turns are. Other columns are not read.
    """
    shared_dir(conversations.sparkSession)
    rows, starts = _in_order(_turns(conversations, conv_col, turn_col, role_col, text_col))
    turns, convs = _rebuilt(rows, starts, shared)
    blocks = _blocks(turns, convs, block, run)

    nodes = _rolled(blocks, block, "count(*) AS n_convs", "min(conv) AS conv")
    above = lambda lane, n: F.when(
        F.col("depth") > 0, F.col(n).bitwiseXOR(_hash(lane, F.col("depth") - 1, F.col("last")))
    )
    nodes = nodes.select(
        *_NODE, above(1, "na").alias("pa"), above(2, "nb").alias("pb"), "depth", "conv", "n_convs",
        ((F.col("n_convs") - 1) * F.coalesce(F.col("last.words"), F.lit(0))).alias("gain"),
    ).checkpoint()
    children = nodes.where("depth > 0").groupBy(F.col("pa").alias("na"), F.col("pb").alias("nb"))
    children = children.agg(F.count("*").alias("n_children"))
    ends = _ends(blocks, convs, block)
    nodes = nodes.join(children, _NODE, "left").join(ends, _NODE, "left")
    nodes = nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.withColumn("leaf", (F.col("n_children") == 0).cast("bigint")).checkpoint()

    owned = nodes.groupBy("conv").agg(F.sum("gain").alias("owned"), F.sum("leaf").alias("leaves"))
    blocks = lookup(blocks, owned, ["conv"])
    below = _rolled(blocks, block, "sum(owned) AS owned", "sum(leaves) AS n_leaves")
    nodes = _running(nodes, "conv", "depth", F.sum, ["gain"], run)
    nodes = nodes.join(below.select(*_NODE, "owned", "n_leaves"), _NODE).checkpoint()

    parents = nodes.select(F.col("na").alias("pa"), F.col("nb").alias("pb"), F.col("conv").alias("parent_conv_id"))
    nodes = lookup(nodes, parents, ["pa", "pb"])
    return nodes.select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
        (F.coalesce("owned", F.lit(0)) - F.col("before_gain") - F.col("past_gain")).alias("saved_tokens"),
        F.coalesce("sha", F.lit(_EMPTY)).alias("ends_sha256"),
    )
