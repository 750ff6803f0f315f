"""The prefix trie of conversations, built as a z-fast trie in batches.

A conversation is a path of turns. Its first d turns have a fingerprint, a hash chained over the turns;
equal fingerprints are equal beginnings. The trie is kept compacted: one row per edge, from the depth of
the node above it (``up``) to its own end (``ends``), with the fingerprints of the turns in between. The
handle of an edge is the fingerprint at the two-fattest depth in (up, ends].
"""

from __future__ import annotations

from hashlib import blake2b, sha256
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightloom.session import fits_broadcast, settle

WIDTH = 16  # bytes of a fingerprint
ROOT = b""  # the fingerprint of no turns
CHUNK = 1 << 13  # ids that are joined to one piece before they are hashed


def fingerprint(paths: str, depth: Column) -> Column:
    """The fingerprint at ``depth`` of chained fingerprints; empty at depth 0."""
    start = (WIDTH * (depth - 1) + 1).cast("int")
    return F.when(depth > 0, F.substring(F.col(paths), start, F.lit(WIDTH))).otherwise(F.lit(ROOT))


def stretch(paths: Column, after: Column, upto: Column) -> Column:
    """The fingerprints of the depths in (after, upto]."""
    return F.substring(paths, (WIDTH * after + 1).cast("int"), (WIDTH * (upto - after)).cast("int"))


def sums_of(sums: str, after: Column, upto: Column) -> Column:
    """The running sums of the depths in (after, upto]."""
    return F.slice(F.col(sums), (after + 1).cast("int"), (upto - after).cast("int"))


def sum_at(sums: str, depth: Column, before: Column) -> Column:
    """The running sum at a depth counted from ``before``, which is the sum at depth 0."""
    return F.when(depth > 0, F.get(F.col(sums), (depth - 1).cast("int"))).otherwise(before)


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that is divisible by the largest power of two; low < high."""
    bits = F.length(F.bin(low.bitwiseXOR(high))) - 1
    power = F.pow(F.lit(2.0), bits).cast("long")
    return high - F.pmod(high, power)


# -- Paths -------------------------------------------------------------------------------------


def turn_lists(conversations: DataFrame, group: Column | None = None) -> DataFrame:
    """(conv_id, turns): per conversation its turns in order, each a digest and its text's length in bytes.

    Null turns come first, equal turn numbers follow the order of their digests. Null role or text is empty;
    rows without a conv_id are left out; extra columns are ignored. Only digests are shuffled. Rows are dealt by ``group`` if it is given.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.substring(F.unhex(F.sha2(named, 256)), 1, WIDTH).alias("digest"),
            F.octet_length(text).cast("long").alias("bytes"),
        ).alias("turn"),
    )
    keys = ["conv_id"]
    if group is not None:
        keys = ["__group", "conv_id"]
        rows = rows.withColumn("__group", group).repartition("__group")
    return rows.groupBy(*keys).agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def chained(lists: DataFrame) -> DataFrame:
    """(conv_id, n, path, sums): the number of turns, their chained fingerprints, the running sums of their bytes."""
    schema = "conv_id long, n long, path binary, sums array<long>"
    out = pa.schema(
        [("conv_id", pa.int64()), ("n", pa.int64()), ("path", pa.binary()), ("sums", pa.list_(pa.int64()))]
    )

    def chain(digests: list[bytes]) -> bytes:
        last, found = b"", []
        for digest in digests:
            last = blake2b(last + digest, digest_size=WIDTH).digest()
            found.append(last)
        return b"".join(found)

    def link(batches):
        for batch in batches:
            digests = batch.column("digests").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    pa.array([len(d) for d in digests], pa.int64()),
                    pa.array([chain(d) for d in digests], pa.binary()),
                    pa.array([list(accumulate(b)) for b in batch.column("bytes").to_pylist()], pa.list_(pa.int64())),
                ],
                schema=out,
            )

    parts = lists.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.bytes").alias("bytes"))
    return parts.mapInArrow(link, schema)


# -- Building ----------------------------------------------------------------------------------

EDGE = (
    "node binary, above binary, up long, ends long, path binary, start long, sums array<long>, first binary, "
    "handle binary"
)


def with_keys(edges: DataFrame) -> DataFrame:
    """Adds the fingerprint of an edge's first turn and its handle."""
    fat = two_fattest(F.col("up"), F.col("ends")) - F.col("up")
    return edges.withColumns(
        {
            "first": fingerprint("path", F.lit(1)),
            "handle": fingerprint("path", fat),
        }
    ).select(*[c.split(" ")[0] for c in EDGE.split(", ")])


def located(pending: DataFrame, trie: DataFrame, deepest: int, small: bool) -> DataFrame:
    """``pending`` with ``reached``, the end of the deepest edge that a path runs through as a whole.

    Fat binary search: each step looks for the edge whose handle the path has at the two-fattest depth of
    what is left. Found and run through: go on below its end. Found and left on the way: the search ends above
    it. Not found: go on above the handle. Steps grow with the logarithm of the depth. A trie of few edges is
    ``small``: its handles (under 100 bytes each) are broadcast.
    """
    found = pending.withColumns({"reached": F.lit(0).cast("long"), "most": F.least(F.col("n"), F.lit(deepest))})
    handles = trie.select(
        F.col("handle").alias("probe"), F.col("node").alias("__node"), F.col("up").alias("__up"), F.col("ends").alias("__ends")
    )
    handles = F.broadcast(handles) if small else handles
    columns = found.columns
    for _ in range(deepest.bit_length()):
        open_ = F.col("reached") < F.col("most")
        fat = F.when(open_, two_fattest(F.col("reached"), F.col("most")))
        found = found.withColumn("__fat", fat)
        # a search that has ended asks for something that is no handle, each for another
        nothing = F.encode(F.concat(F.lit("-"), F.col("conv_id").cast("string")), "utf-8")
        probe = F.when(F.col("__fat").isNotNull(), fingerprint("path", F.col("__fat"))).otherwise(nothing)
        step = found.withColumn("probe", probe).join(handles, "probe", "left")
        through = (F.col("__ends") <= F.col("n")) & (fingerprint("path", F.col("__ends")) == F.col("__node"))
        hit = F.col("__node").isNotNull()
        step = step.withColumn("__through", hit & through)
        found = step.withColumns(
            {
                "reached": F.when(F.col("__through"), F.col("__ends")).when(hit, F.col("__up")).otherwise(F.col("reached")),
                "most": F.when(F.col("__through"), F.col("most"))
                .when(hit, F.col("__up"))
                .otherwise(F.coalesce(F.col("__fat") - 1, F.col("most"))),
            }
        ).select(*columns)
    return found.drop("most")


def exits(pending: DataFrame, trie: DataFrame, deepest: int, small: bool) -> DataFrame:
    """``pending`` with ``shared``, the turns a path shares with the trie, and ``exit``, the edge it ends or
    leaves on; null where it does so at a node."""
    edges = trie.select(F.col("first").alias("probe"), F.col("node").alias("exit"), F.col("path").alias("__path"))
    # a path that ends at a node asks for something that is no edge
    nothing = F.encode(F.concat(F.lit("-"), F.col("conv_id").cast("string")), "utf-8")
    further = F.col("reached") < F.col("n")
    probe = F.when(further, fingerprint("path", F.col("reached") + 1)).otherwise(nothing)
    found = located(pending, trie, deepest, small).withColumn("probe", probe).join(edges, "probe", "left")
    room = F.least(F.col("n") - F.col("reached"), F.expr(f"octet_length(__path) div {WIDTH}"))
    same = F.filter(
        F.sequence(F.lit(1).cast("long"), room),
        lambda d: fingerprint("__path", d) == fingerprint("path", F.col("reached") + d),
    )
    shared = F.when(F.col("exit").isNotNull(), F.size(same)).otherwise(0)
    return found.withColumn("shared", F.col("reached") + shared).drop("probe", "__path", "reached")


def inserted(trie: DataFrame, found: DataFrame, chosen: DataFrame) -> DataFrame:
    """The trie with nodes where paths leave or end on an edge, and with the new edges of ``chosen``.

    An edge has at most as many new nodes as turns, so its cuts are few however many paths leave on it.
    """
    places = found.filter("exit IS NOT NULL").select(F.col("exit").alias("node"), "shared").distinct()
    cuts = places.groupBy("node").agg(F.sort_array(F.collect_list("shared")).alias("__cuts"))
    whole = trie.join(cuts, "node", "left_anti")
    pieces = (
        trie.join(cuts, "node")
        .withColumn("__from", F.concat(F.array("up"), F.col("__cuts")))
        .withColumn("__to", F.concat(F.col("__cuts"), F.array("ends")))
        .withColumn("__piece", F.explode(F.arrays_zip("__from", "__to")))
        .withColumn("low", F.col("__piece.__from") - F.col("up"))
        .withColumn("high", F.col("__piece.__to") - F.col("up"))
    )
    pieces = pieces.select(
        fingerprint("path", F.col("high")).alias("node"),
        F.when(F.col("low") > 0, fingerprint("path", F.col("low"))).otherwise(F.col("above")).alias("above"),
        (F.col("up") + F.col("low")).alias("__up"),
        (F.col("up") + F.col("high")).alias("ends"),
        stretch(F.col("path"), F.col("low"), F.col("high")).alias("path"),
        sum_at("sums", F.col("low"), F.col("start")).alias("start"),
        sums_of("sums", F.col("low"), F.col("high")).alias("sums"),
    ).withColumnRenamed("__up", "up")
    new = chosen.select(
        fingerprint("path", F.col("n")).alias("node"),
        fingerprint("path", F.col("shared")).alias("above"),
        F.col("shared").alias("up"),
        F.col("n").alias("ends"),
        stretch(F.col("path"), F.col("shared"), F.col("n")).alias("path"),
        sum_at("sums", F.col("shared"), F.lit(0).cast("long")).alias("start"),
        sums_of("sums", F.col("shared"), F.col("n")).alias("sums"),
    )
    return whole.unionByName(with_keys(pieces)).unionByName(with_keys(new))


def build_trie(paths: DataFrame) -> DataFrame:
    """The compacted trie of distinct ``paths`` (conv_id, n, path, sums), one row per edge.

    Each batch: every path that is not in the trie yet locates its exit; of the paths that leave at the
    same node with the same next turn one is chosen at random (by a hash of its id) and its edge is
    inserted; the others wait for the next batch. What waits shrinks with each batch, in the expected number
    by a constant factor, so there are about as many batches as the logarithm of the largest such group.
    Each batch is written, so a lost executor costs one batch.
    """
    trie = settle(paths.sparkSession.createDataFrame([], EDGE), "trie")
    pending = paths.filter("n > 0")
    while True:
        deepest = trie.agg(F.coalesce(F.max("ends"), F.lit(0))).first()[0]
        found = settle(exits(pending, trie, deepest, fits_broadcast(trie)), "exits")
        leaving = found.filter("shared < n").withColumn("__next", fingerprint("path", F.col("shared") + 1))
        drawn = leaving.groupBy("__next").agg(
            F.min(F.struct(F.xxhash64("conv_id").alias("draw"), F.col("conv_id"))).alias("__drawn")
        )
        drawn = drawn.select(F.col("__drawn.conv_id").alias("conv_id"))
        chosen = leaving.join(drawn, "conv_id", "left_semi")
        trie = settle(inserted(trie, found, chosen), "trie")
        pending = settle(leaving.join(drawn, "conv_id", "left_anti").select(*paths.columns), "pending")
        if pending.isEmpty():
            return trie


# -- What the nodes hold -------------------------------------------------------------------------


def total() -> Column:
    """Bytes from the root to an edge's end."""
    return F.element_at("sums", -1)



def ancestors(trie: DataFrame) -> DataFrame:
    """(node, chain): the nodes above each node but the root, in order; each round doubles their number."""
    current = settle(trie.select("node", F.col("above").alias("top"), F.array("above").alias("chain")), "chains")
    while True:
        active = current.filter(F.col("top") != F.lit(ROOT))
        if active.isEmpty():
            return current.select("node", "chain")
        above = current.select(F.col("node").alias("top"), F.col("top").alias("__top"), F.col("chain").alias("__chain"))
        longer = active.join(above, "top").select(
            "node", F.col("__top").alias("top"), F.concat("chain", "__chain").alias("chain")
        )
        current = settle(current.filter(F.col("top") == F.lit(ROOT)).unionByName(longer), "chains")


def joined_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) from (node, conv_id): SHA-256 of the ids, ascending and joined by commas.

    Ids are sorted by (node, id) over all partitions and joined to pieces of a bounded size there; then the pieces of
    a node are hashed one after the other as they are read, so a node at which a third of all conversations
    end holds no task's memory.
    """
    piece = pa.schema([("node", pa.binary()), ("start", pa.int64()), ("ids", pa.binary())])
    digest = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])

    def join(batches):
        for batch in batches:
            rows: list[tuple] = []
            nodes, ids = batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()
            start = 0
            for i in range(1, len(nodes) + 1):
                if i == len(nodes) or nodes[i] != nodes[start] or i - start == CHUNK:
                    rows.append((nodes[start], ids[start], ",".join(map(str, ids[start:i])).encode()))
                    start = i
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), piece)] if rows else
                                             [pa.array([], f.type) for f in piece], schema=piece)

    def digested(batches):
        node, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for found, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if found != node:
                    if node is not None:
                        done.append((node, state.hexdigest()))
                    node, state = found, sha256(ids)
                else:
                    state.update(b"," + ids)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), digest)], schema=digest)
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], schema=digest)

    ordered = ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = ordered.mapInArrow(join, "node binary, start long, ids binary")
    sorted_ = pieces.repartition("node").sortWithinPartitions("node", "start")
    return sorted_.mapInArrow(digested, "node binary, ends_sha256 string")


def trie_nodes(paths: DataFrame) -> DataFrame:
    """All nodes of the prefix trie of ``paths`` (conv_id, n, path, sums; see ``chained``).

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    and ends_sha256 per node. Conversations with the same turns share their path. No conversations: no
    nodes, not even a root.
    """
    paths = settle(paths, "paths")
    ends = paths.select(fingerprint("path", F.col("n")).alias("node"), "conv_id")
    members = settle(
        ends.groupBy("node").agg(F.count("*").alias("members"), F.min("conv_id").alias("least")), "members"
    )
    leaders = members.select(F.col("least").alias("conv_id"))
    trie = build_trie(paths.join(leaders, "conv_id", "left_semi"))
    children = trie.groupBy(F.col("above").alias("node")).agg(F.count("*").alias("n_children"))

    own = (
        trie.select("node", total().alias("total"), (total() - F.col("start")).alias("label"))
        .join(members, "node", "left")
        .join(children, "node", "left")
        .withColumns(
            {
                "members": F.coalesce("members", F.lit(0).cast("long")),
                "leaves": F.when(F.col("n_children").isNull(), 1).otherwise(0),
            }
        )
    )
    # what a node adds to each node above it and to itself
    added = own.join(ancestors(trie), "node").select(
        F.explode(F.concat(F.array("node"), F.col("chain"))).alias("node"),
        "members", "least", "leaves", "label", (F.col("members") * F.col("total")).alias("weighted"),
    )
    at_root = members.filter(F.col("node") == F.lit(ROOT)).select(
        "node", "members", "least", F.lit(0).alias("leaves"), F.lit(0).cast("long").alias("label"),
        F.lit(0).cast("long").alias("weighted"),
    )
    sums = settle(
        added.unionByName(at_root).groupBy("node").agg(
            F.sum("members").alias("n_convs"),
            F.min("least").alias("conv_id"),
            F.sum("leaves").alias("n_leaves"),
            F.sum("label").alias("labels"),
            F.sum("weighted").alias("weighted"),
        ),
        "subtrees",
    )
    digests = settle(joined_digests(ends), "digests")
    root_id = sums.filter(F.col("node") == F.lit(ROOT)).select("conv_id").first()
    parents = sums.select(F.col("node").alias("above"), F.col("conv_id").alias("__parent"))
    below_root = trie.filter(F.col("above") == F.lit(ROOT)).withColumn("__parent", F.lit(root_id[0] if root_id else None).cast("long"))
    others = trie.filter(F.col("above") != F.lit(ROOT)).join(parents, "above")
    edges = (
        below_root.unionByName(others.select(*below_root.columns))
        .join(sums, "node")
        .join(children, "node", "left")
        .join(digests, "node", "left")
    )
    nothing = F.lit(sha256(b"").hexdigest())
    # what the nodes below an edge's end save; the edge itself saves from each of its depths on
    below = F.col("weighted") - F.col("n_convs") * total() - (F.col("labels") - (total() - F.col("start")))
    before = F.concat(F.array("start"), F.col("sums"))  # one more than there are depths
    spread = edges.withColumns({"__below": below, "__total": total(), "__size": F.size("sums")}).select(
        "*", F.posexplode(before).alias("__at", "__before")
    ).filter("__at < __size")
    last = F.col("__at") == F.col("__size") - 1
    inner = spread.select(
        "conv_id",
        (F.col("up") + F.col("__at") + 1).alias("depth"),
        F.when(F.col("__at") == 0, F.col("__parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(last, F.coalesce("n_children", F.lit(0).cast("long"))).otherwise(F.lit(1).cast("long")).alias("n_children"),
        "n_leaves",
        (F.col("__below") + (F.col("n_convs") - 1) * (F.col("__total") - F.col("__before"))).alias("saved_tokens"),
        F.when(last, F.coalesce("ends_sha256", nothing)).otherwise(nothing).alias("ends_sha256"),
    )
    root = (
        sums.filter(F.col("node") == F.lit(ROOT))
        .join(children, "node", "left")
        .join(digests, "node", "left")
        .select(
            "conv_id",
            F.lit(0).cast("long").alias("depth"),
            F.lit(None).cast("long").alias("parent_conv_id"),
            "n_convs",
            F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
            # a root without children is a leaf itself
            F.greatest("n_leaves", F.lit(1)).alias("n_leaves"),
            (F.col("weighted") - F.col("labels")).alias("saved_tokens"),
            F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
        )
    )
    return root.unionByName(inner)
