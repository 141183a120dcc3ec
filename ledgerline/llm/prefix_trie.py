"""Trie of conversation prefixes, with totals of every subtree by parallel tree contraction.

A node is a distinct sequence of turns with which some conversation starts. The
totals of all subtrees come from contracting the tree to nothing in rounds of
joins: a round rakes all leaves into their parents, then compresses all chains of
nodes with one child, each by doubling its links. What was taken out is put back
from the last round to the first: a leaf has its total, a node of a chain that of
the chain's end and what hung between the two. A round at least halves the tree.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# Conversation ids in one piece of the text that is hashed for a node.
PIECE = 4096


def digest_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, s1, s2, words): 128 bits for role and text, and the words of the text.

    A null role or text counts as empty. Rows without a conversation are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    conv = F.col("conv_id").cast("long")
    return turns.where(conv.isNotNull()).select(
        conv.alias("conv_id"), "turn", F.xxhash64(F.lit(1), role, text).alias("s1"), F.xxhash64(F.lit(2), text, role).alias("s2"), words.alias("words")
    )


def numbered(rows: DataFrame, key: str, order: list[str], marks: tuple[str, str] | None = None) -> DataFrame:
    """Add ``place``, 0 for the first row of its key in this order, and ``p1`` and ``p2``, the XOR of the key's two marks up to each row.

    Rows are dealt out by ranges of key and order, so a key of any size spreads
    over tasks. Each task counts from the start of what it has of a key; keys that
    lie in several ranges, at most one per cut, get what the ranges before hold.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in (key, *order)]
    first, second = (F.col(m) for m in marks) if marks else (F.lit(0).cast("long"),) * 2
    dealt = (
        rows.withColumns({"p1": first, "p2": second}).repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())
    )
    names = dealt.columns
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema)

    def run(batches):
        last, count, xors = None, 0, {"p1": np.int64(0), "p2": np.int64(0)}
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = {n: batch.column(i) for i, n in enumerate(names)}
            ids = columns[key].to_numpy(zero_copy_only=False)
            fresh = np.concatenate(([ids[0] != last], ids[1:] != ids[:-1]))
            goes_on = not fresh[0]
            fresh[0] = True
            starts, owner = np.flatnonzero(fresh), np.cumsum(fresh) - 1
            place = np.arange(len(ids)) - starts[owner]
            place[owner == 0] += count if goes_on else 0
            for name in xors:
                total = np.bitwise_xor.accumulate(columns[name].to_numpy(zero_copy_only=False))
                base = np.concatenate(([np.int64(0)], total))[starts]
                base[0] = xors[name] if goes_on else 0
                total = total ^ base[owner]
                xors[name] = total[-1]
                columns[name] = pa.array(total, pa.int64())
            last, count = ids[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(place, pa.int64())], names=[*names, "place"])

    local = stored(dealt.mapInArrow(run, fields + ", place bigint"), "numbered")
    ends = local.groupBy(key, "part").agg(F.max("place").alias("top"), F.max_by("p1", "place").alias("x1"), F.max_by("p2", "place").alias("x2"))
    cut = ends.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(key)
    earlier = f"OVER (PARTITION BY {key} ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    before = ends.join(cut, key).selectExpr(
        key, "part", f"sum(top + 1) {earlier} AS b0", f"bit_xor(x1) {earlier} AS b1", f"bit_xor(x2) {earlier} AS b2"
    )
    # at most two of these for each cut between ranges
    whole = local.join(F.broadcast(before), [key, "part"], "left")
    own = lambda c, b: F.col(c).bitwiseXOR(F.coalesce(b, F.lit(0))).alias(c)
    kept = [c for c in names if c not in ("p1", "p2", "part")]
    return whole.select(*kept, (F.col("place") + F.coalesce("b0", F.lit(0))).alias("place"), own("p1", "b1"), own("p2", "b2"))


def _node(a: str | Column, b: str | Column) -> Column:
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return F.struct(a.alias("x"), b.alias("y"))


def _ends_sha(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256) of the nodes at which conversations end, from rows (x, y, conv_id).

    Ids are put in order by ranges and joined piece by piece, so a node at which
    many end has few rows when its pieces go, in order, through one hash.
    """
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ends.select("x", "y", "conv_id").repartitionByRange(parts, "x", "y", "conv_id").sortWithinPartitions("x", "y", "conv_id")

    def cut(batches):
        held, ids = None, []
        for batch in batches:
            out = []
            for x, y, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if ids and ((x, y) != held or len(ids) == PIECE):
                    out.append((*held, ids[0], ",".join(map(str, ids))))
                    ids = []
                held = (x, y)
                ids.append(c)
            yield _piece_batch(out)
        if ids:
            yield _piece_batch([(*held, ids[0], ",".join(map(str, ids)))])

    pieces = dealt.mapInArrow(cut, "x bigint, y bigint, low bigint, piece string")
    lined = pieces.repartition(parts, "x", "y").sortWithinPartitions("x", "y", "low")

    def hashed(batches):
        held, state = None, None
        for batch in batches:
            out = []
            for x, y, piece in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if (x, y) == held:
                    state.update(b"," + piece.encode())
                    continue
                if held:
                    out.append((*held, state.hexdigest()))
                held, state = (x, y), hashlib.sha256(piece.encode())
            yield _sha_batch(out)
        if held:
            yield _sha_batch([(*held, state.hexdigest())])

    made = lined.mapInArrow(hashed, "x bigint, y bigint, ends_sha256 string")
    return made.select(_node("x", "y").alias("id"), "ends_sha256")


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], [], []]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["x", "y", "low", "piece"])


def _sha_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()))], names=["x", "y", "ends_sha256"])


def _chain_ends(unary: DataFrame) -> DataFrame:
    """(id, end, leaves, saved) for nodes with one child: where the chain ends, and what hangs on it before the end.

    ``unary`` has (id, next, leaves, saved). Every pass takes each node twice as far
    along its chain; nodes that reached the end leave.
    """
    done, going = [], unary
    while True:
        far = going.select(F.col("id").alias("next"), F.col("next").alias("_next"), F.col("leaves").alias("_leaves"), F.col("saved").alias("_saved"))
        plus = lambda c: (F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c)
        going = stored(
            going.join(far, "next", "left").select(
                "id", F.coalesce("_next", "next").alias("next"), plus("leaves"), plus("saved"), F.col("_next").isNull().alias("at_end")
            ),
            "chain",
        )
        done.append(going)
        if not going.where("NOT at_end").limit(1).count():
            return going.select("id", F.col("next").alias("end"), "leaves", "saved")
        going = going.drop("at_end")


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """(id, leaves, saved): both summed over the subtree of each node, its own included.

    ``nodes`` has unique ``id``, its ``parent`` (null for a top) and the node's own
    ``leaves`` and ``saved``. No step groups by anything but a parent, and only
    sums and minima are grouped, so a parent of many children is no hot task.
    """
    zero = F.lit(0).cast("long")
    tree = stored(nodes.select("id", "parent", "leaves", "saved", zero.alias("more_leaves"), zero.alias("more_saved")), "tree")
    rounds: list[tuple[DataFrame, DataFrame | None]] = []
    while tree.limit(1).count():
        kids = tree.where(F.col("parent").isNotNull()).groupBy("parent").agg(F.count(F.lit(1)).alias("kids")).withColumnRenamed("parent", "id")
        counted = stored(tree.join(kids, "id", "left"), "counted")
        leaves = counted.where(F.col("kids").isNull())
        raked = (
            leaves.where(F.col("parent").isNotNull())
            .groupBy(F.col("parent").alias("id"))
            .agg(
                F.sum(F.col("leaves") + F.col("more_leaves")).alias("add_leaves"),
                F.sum(F.col("saved") + F.col("more_saved")).alias("add_saved"),
                F.count(F.lit(1)).alias("gone"),
            )
        )
        plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
        rest = stored(
            counted.where(F.col("kids").isNotNull())
            .join(raked, "id", "left")
            .select(
                "id", "parent", plus("leaves", "add_leaves"), plus("saved", "add_saved"), "more_leaves", "more_saved",
                (F.col("kids") - F.coalesce("gone", F.lit(0))).alias("kids"),
            ),
            "raked",
        )
        # the one child that is left of each node of a chain, and what its link carries
        link = rest.where(F.col("parent").isNotNull()).select("parent", "id", F.struct("more_leaves", "more_saved").alias("carried"))
        only = (
            link.groupBy("parent")
            .agg(
                F.count(F.lit(1)).alias("n"), F.min("id.x").alias("x"), F.min("id.y").alias("y"),
                F.min("carried.more_leaves").alias("l"), F.min("carried.more_saved").alias("s"),
            )
            .where(F.col("n") == 1)
            .select(F.col("parent").alias("id"), _node("x", "y").alias("next"), "l", "s")
        )
        unary = stored(
            rest.where(F.col("kids") == 1)
            .join(only, "id")
            .select("id", "parent", "next", (F.col("leaves") + F.col("l")).alias("leaves"), (F.col("saved") + F.col("s")).alias("saved"), "more_leaves", "more_saved"),
            "unary",
        )
        if not unary.limit(1).count():
            rounds.append((leaves, None))
            tree = rest.drop("kids")
            continue
        chains = _chain_ends(unary.select("id", "next", "leaves", "saved"))
        inner = unary.select(F.col("next").alias("id"), F.lit(True).alias("inner"))
        heads = (
            unary.select("id", "parent", "more_leaves", "more_saved")
            .join(inner, "id", "left_anti")
            .join(chains, "id")
            .select(
                F.col("end").alias("id"), F.lit(True).alias("moved"), F.col("parent").alias("new_parent"),
                (F.col("more_leaves") + F.col("leaves")).alias("new_leaves"), (F.col("more_saved") + F.col("saved")).alias("new_saved"),
            )
        )
        moved = rest.where(F.col("kids") != 1).join(heads, "id", "left")
        new = lambda a, b: F.when(F.col("moved"), F.col(b)).otherwise(F.col(a)).alias(a)
        tree = stored(
            moved.select("id", new("parent", "new_parent"), "leaves", "saved", new("more_leaves", "new_leaves"), new("more_saved", "new_saved")), "tree"
        )
        rounds.append((leaves, chains))
    totals = None
    for leaves, chains in reversed(rounds):
        if chains is not None:
            end = totals.select(F.col("id").alias("end"), F.col("leaves").alias("_leaves"), F.col("saved").alias("_saved"))
            grown = chains.join(end, "end").select(
                "id", (F.col("leaves") + F.col("_leaves")).alias("leaves"), (F.col("saved") + F.col("_saved")).alias("saved")
            )
            totals = stored(totals.unionByName(grown), "totals")
        own = leaves.select("id", "leaves", "saved")
        totals = own if totals is None else totals.unionByName(own)
    return totals if totals is not None else nodes.select("id", "leaves", "saved")


def prefix_trie(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row per node of the trie over the turns' prefixes, its textless root included.

    ``turns`` has (conv_id, turn, role, text); other columns are not read. ``conversations`` names the conv_ids in ``conv_id``, so that
    those without turns belong to the root; default: those of the turns. Turns are
    ordered by ``turn``, null first; of equal ones the digest decides. A null role
    or text is empty; rows without conv_id are left out; a repeated row is one more
    turn. No conversations at all: no rows.

    Columns: conv_id, the node's smallest member; depth; parent_conv_id (root:
    null); n_convs; n_children; n_leaves and saved_tokens, over the subtree;
    ends_sha256, of the ids of the conversations that end there.
    """
    rows = numbered(digest_turns(turns), "conv_id", ["turn", "s1", "s2"])
    owners = (turns if conversations is None else conversations).select(F.col("conv_id").cast("long").alias("conv_id"))
    return trie_of(rows.select("conv_id", (F.col("place") + 1).alias("depth"), "s1", "s2", "words"), owners)


def trie_of(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The trie of digested turns (conv_id, depth, s1, s2, words) that are numbered from 1 in each conversation."""
    # a turn's bits depend on its depth, so their XOR tells sequences apart and no two turns cancel
    own = turns.withColumns({"t1": F.xxhash64("s1", "depth"), "t2": F.xxhash64("depth", "s2")}).drop("s1", "s2")
    rows = stored(numbered(own, "conv_id", ["depth"], ("t1", "t2")).drop("place"), "prefixes")
    found = (
        rows.groupBy("depth", "p1", "p2")
        .agg(
            F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("words").alias("words"),
            F.min(F.col("p1").bitwiseXOR(F.col("t1"))).alias("q1"), F.min(F.col("p2").bitwiseXOR(F.col("t2"))).alias("q2"),
        )
        .select(_node("p1", "p2").alias("id"), _node("q1", "q2").alias("parent"), "depth", "conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    )
    everyone = stored(conversations.where(F.col("conv_id").isNotNull()).distinct(), "conversations")
    top = everyone.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where(F.col("n_convs") > 0)
    zero = F.lit(0).cast("long")
    root_id = _node(zero, zero)
    root = top.select(root_id.alias("id"), F.lit(None).cast(found.schema["parent"].dataType).alias("parent"), zero.alias("depth"), "conv_id", "n_convs", zero.alias("saved"))
    nodes = stored(found.unionByName(root), "nodes")

    # A node of one member heads a chain down to one leaf: the first rake takes the chain whole, its totals are 1 and 0.
    lone = (F.col("n_convs") == 1) & (F.col("depth") > 0)
    kids = (
        nodes.where("depth > 0").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"), F.count_if(lone).alias("lone_children"))
    )
    counted = stored(nodes.join(kids, "id", "left").fillna(0, ["n_children", "lone_children"]), "counted-nodes")
    shared = counted.where(~lone)
    totals = subtree_totals(
        shared.select("id", "parent", (F.col("lone_children") + (F.col("n_children") == 0).cast("long")).alias("leaves"), "saved")
    )

    length = rows.groupBy("conv_id").agg(F.max("depth").alias("depth"), F.max_by("p1", "depth").alias("x"), F.max_by("p2", "depth").alias("y"))
    none = everyone.join(length.select("conv_id"), "conv_id", "left_anti").select("conv_id", zero.alias("x"), zero.alias("y"))
    ends = _ends_sha(length.select("conv_id", "x", "y").unionByName(none))
    above = shared.select(F.col("id").alias("parent"), F.col("conv_id").alias("_above"))
    return (
        counted.join(totals.withColumnRenamed("saved", "saved_below"), "id", "left")
        .join(ends, "id", "left")
        .join(above, "parent", "left")
        .select(
            "conv_id", "depth",
            F.when(F.col("depth") > 0, F.coalesce("_above", "conv_id")).alias("parent_conv_id"),
            "n_convs", "n_children",
            F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
            F.coalesce("saved_below", F.lit(0)).cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
