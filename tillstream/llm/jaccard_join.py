"""N-gram Jaccard join by grouped prefixes.

A document is the set of its word shingles. Sets are put in one order of shingles, rare ones first,
so that two sets which are similar enough share a shingle in their prefixes.

1. Equal sets become one node; only nodes go on.
2. Nodes with equal prefix and size become one group; the prefixes of the groups are indexed.
3. In each list of the index every group is paired with one pivot, the group in which the shingle
   comes first. Size and position filters drop pairs which cannot be similar enough, the rest is
   expanded to members and verified on whole sets. This links most of a large class of near copies
   by as many pairs as it has members.
4. Whatever is not in one component yet is still paired, member by member: in each list, nodes
   outside the pivot's component with all nodes of other groups and components, and in each group,
   members outside the leader's component with all of other components. Same filters, same check. So
   no link between different components is missed, and none within one needs to be looked at.

The order of shingles comes from a sketch of their frequencies with a fixed number of counters.
Any order gives right results; the sketch only keeps the lists short.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, binary, bit_filter, lists, mix, over_batches, passing, shingle_hashes, small_batches, stored
from .components import components

#: Counters of the frequency sketch, a power of two; 4 MB whatever the input.
COUNTERS_LOG2 = 20
_CHUNKS = 64


def shingles(text: bytes | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text with A-Z in lower case."""
    words = (text or b"").lower().split()
    return np.unique(shingle_hashes(hashes.of(words), width))


def node_of(tokens: np.ndarray) -> int:
    """A 64-bit name of a set."""
    if not len(tokens):
        return 0
    both = mix(np.array([tokens.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(tokens + np.uint64(1)))]))
    return int(mix(both[:1] + (both[1:] << np.uint64(1)) + np.uint64(len(tokens)))[0].view(np.int64))


def frequency_sketch(docs: DataFrame, text_col: str, width: int) -> np.ndarray:
    """How many documents have a shingle, summed over all shingles with the same leading bits."""
    shift = np.uint64(64 - COUNTERS_LOG2)
    size = 1 << COUNTERS_LOG2

    def count(batches):
        hashes, total = WordHashes(), np.zeros(size, np.int64)
        for batch in batches:
            for text in binary(batch, text_col):
                np.add.at(total, (shingles(text, width, hashes) >> shift).astype(np.int64), 1)
        if total.any():
            parts = np.minimum(total, 2**32 - 1).astype("<u4").reshape(_CHUNKS, -1)
            yield pa.record_batch([pa.array(range(_CHUNKS)), pa.array([p.tobytes() for p in parts])], names=["chunk", "counts"])

    def add(key, blobs):
        total = np.zeros(size // _CHUNKS, np.int64)
        for blob in blobs.column("counts"):
            total += np.frombuffer(blob.as_buffer(), "<u4")
        return pa.table({"chunk": pa.array([key[0].as_py()]), "counts": pa.array([np.minimum(total, 2**32 - 1).astype("<u4").tobytes()])})

    chunks = over_batches(docs, [text_col], count, "chunk long, counts binary").groupBy("chunk").applyInArrow(add, "chunk long, counts binary")
    sketch = np.zeros((_CHUNKS, size // _CHUNKS), np.uint32)
    with small_batches(docs.sparkSession):
        rows = chunks.collect()  # 64 rows of 64 KB
    for row in rows:
        sketch[row["chunk"]] = np.frombuffer(row["counts"], "<u4")
    return sketch.ravel()


def least_share(size, percent: int):
    """Shingles that a set of this size shares with a similar one at least."""
    return -(-size * percent // 100)


def heads(docs: DataFrame, sketch: np.ndarray, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """(id, n, node, prefix, prefix_key) per row; a prefix is in the order of the sketch."""
    shift = np.uint64(64 - COUNTERS_LOG2)
    sent = docs.sparkSession.sparkContext.broadcast(sketch)

    def describe(batches):
        hashes = WordHashes()
        for batch in batches:
            sizes, nodes, prefixes, keys = [], [], [], []
            for text in binary(batch, text_col):
                tokens = shingles(text, width, hashes)
                n = len(tokens)
                head = n - least_share(n, percent) + 1 if n else 0
                rare = sent.value[(tokens >> shift).astype(np.int64)]
                prefix = tokens[np.lexsort((tokens, rare))[:head]]
                sizes.append(n)
                nodes.append(node_of(tokens))
                prefixes.append(prefix.view(np.int64))
                keys.append(node_of(prefix) ^ n)
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), lists(prefixes, pa.int64()), pa.array(keys, pa.int64())],
                names=["id", "n", "node", "prefix", "prefix_key"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return over_batches(docs, [id_col, text_col], describe, f"id {kind}, n long, node long, prefix array<long>, prefix_key long")


def fitting(a: str, b: str, percent: int):
    """Size and position filters: can the sets of rows ``a`` and ``b`` that meet in a shingle be similar?

    The least shingle that two sets share precedes all others they share, so they share no more than
    what follows it in either. A pair that fails here in every list it meets in fails at that one.
    """
    na, nb, ia, ib = F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.pos"), F.col(f"{b}.pos")
    most = F.least(na - ia, nb - ib)
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & ((100 + percent) * most >= percent * (na + nb))


def verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """The pairs of nodes (a, b) whose whole sets are similar; sets are made again of whole texts."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(reps, "node")
    # Texts that are not needed are dropped where they are read; nothing but sets is shuffled.
    bits, log2 = bit_filter(needed.select(F.xxhash64("rep")))
    sent = docs.sparkSession.sparkContext.broadcast(bits)
    bodies = docs.where(F.col(id_col).isNotNull()).select(F.xxhash64(id_col).alias("key"), F.col(text_col).alias("body"))

    def sets(batches):
        hashes = WordHashes()
        for batch in batches:
            keys = batch.column(0).to_numpy().view(np.uint64)
            found = [shingles(text, width, hashes) for text in binary(batch.take(pa.array(passing(sent.value, log2, keys))), "body")]
            yield pa.record_batch(
                [pa.array([node_of(t) for t in found], pa.int64()), lists([t.view(np.int64) for t in found], pa.int64())], names=["node", "tokens"]
            )

    tokens = over_batches(bodies, ["key", "body"], sets, "node long, tokens array<long>").dropDuplicates(["node"])
    left = tokens.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    right = tokens.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    shared = F.size(F.array_intersect("ta", "tb"))
    return (
        pairs.join(left, "a").join(right, "b")
        .where((100 + percent) * shared >= percent * (F.size("ta") + F.size("tb")))
        .select("a", "b")
    )


def ordered_pairs(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def jaccard_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """(id, n_shingles, component_id) per row of ``docs``.

    Two rows are linked if 100 * shared shingles >= percent * all shingles of both; ``component_id`` is
    the least id that links reach. A text of fewer than ``width`` words is one shingle; null, empty
    and white-space texts have no shingle, are linked with nothing and keep their own id. Rows
    without an id take no part in links and have a null component. Repeated rows get a row each;
    rows that share an id are one document, so its texts' components are one.
    """
    spark = docs.sparkSession
    sketch = frequency_sketch(docs, text_col, width)
    with small_batches(spark):
        table = stored(heads(docs, sketch, id_col, text_col, width, percent), "heads")
    usable = table.where((F.col("n") > 0) & F.col("id").isNotNull())
    nodes = stored(usable.groupBy("node").agg(F.min("id").alias("rep"), F.min("prefix_key").alias("prefix_key")), "nodes")
    leaders = nodes.groupBy("prefix_key").agg(F.min("node").alias("leader"))
    members = stored(nodes.join(leaders, "prefix_key").select("node", "leader", "rep"), "members")
    lead = members.where("node = leader").select("node", F.col("rep").alias("id"))
    index = usable.select("id", "node", "n", "prefix").join(lead, ["id", "node"]).dropDuplicates(["id", "node"])
    index = index.select("node", "n", F.posexplode("prefix").alias("pos", "token")).withColumn("pos", F.col("pos").cast("long"))
    # The pivot of a list: where the shingle comes first, that is the set with the fewest rarer ones.
    rank = F.shiftleft("pos", 36) + F.col("node").bitwiseAND(F.lit((1 << 36) - 1))
    short = index.groupBy("token").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1")
    packed = index.select("token", "node", (F.shiftleft("n", 31) + F.col("pos")).alias("size_and_pos"))
    shared = packed.join(short.select("token", "first"), "token").select(
        "token", "node", F.shiftright("size_and_pos", 31).alias("n"), F.col("size_and_pos").bitwiseAND(F.lit((1 << 31) - 1)).alias("pos"), "first"
    )
    shared = stored(shared.withColumn("rank", rank), "index")
    pivots = shared.where("rank = first").select("token", "node", "n", "pos")

    # Groups with a pivot, expanded: the members of a group with the leader of its pivot and its own.
    stars = (
        shared.alias("x").join(pivots.alias("y"), "token")
        .where((F.col("x.node") != F.col("y.node")) & fitting("x", "y", percent))
        .select(F.col("x.node").alias("leader"), F.col("y.node").alias("pivot"))
        .distinct()
    )
    own = members.where("node <> leader").select(*ordered_pairs(F.col("node"), F.col("leader")))
    first_pairs = stored(members.select("node", "leader").join(stars, "leader").select(*ordered_pairs(F.col("node"), F.col("pivot"))).unionByName(own).distinct(), "pairs")
    reps = nodes.select("node", "rep")

    def check(pairs):
        with small_batches(spark):
            return stored(verified(pairs, docs, reps, id_col, text_col, width, percent), "verified")

    links = check(first_pairs)
    known = stored(components(links), "components")

    # What the stars left apart, member by member.
    parted = members.join(known, "node", "left").select("node", "leader", F.coalesce("component", "node").alias("component"))
    rows = stored(
        shared.select("token", "n", "pos", F.col("node").alias("leader"), (F.col("rank") == F.col("first")).alias("pivot")).join(parted, "leader"),
        "rows",
    )
    heart = rows.where("pivot and node = leader").groupBy("token").agg(F.min("component").alias("heart"))
    outer = rows.join(heart, "token").where("component <> heart").drop("heart")
    across = (
        outer.alias("x").join(rows.alias("y"), "token")
        .where((F.col("x.leader") != F.col("y.leader")) & (F.col("x.component") != F.col("y.component")) & fitting("x", "y", percent))
        .select(*ordered_pairs(F.col("x.node"), F.col("y.node")))
    )
    # Members of one group meet by their leader: lists in which no other group is are not in the index.
    centre = parted.where("node = leader").select("leader", F.col("component").alias("heart"))
    apart = parted.join(centre, "leader").where("component <> heart").drop("heart")
    within = (
        apart.alias("x").join(parted.alias("y"), "leader")
        .where(F.col("x.component") != F.col("y.component"))
        .select(*ordered_pairs(F.col("x.node"), F.col("y.node")))
    )
    more = check(stored(across.unionByName(within).distinct(), "pairs"))
    # Different texts under one id belong together.
    twice = usable.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("id", "a")
    same_id = usable.join(twice, "id").select("a", F.col("node").alias("b")).where("a <> b")
    final = components(known.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more).unionByName(same_id))
    final = stored(reps.join(final, "node", "left").select("node", "rep", F.coalesce("component", "node").alias("component")), "components")
    named = final.join(final.groupBy("component").agg(F.min("rep").alias("component_id")), "component").select("node", "component_id")
    joined = table.join(named, "node", "left")
    found = F.when(F.col("id").isNull(), None).when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    return joined.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), found.alias("component_id"))


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stand for their class: those with its least id, once, and rows without an id."""
    classes = jaccard_classes(docs, id_col, text_col, width, percent)
    kept = classes.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col)).distinct()
    chosen = docs.join(kept, id_col, "left_semi").dropDuplicates([id_col])
    return chosen.unionByName(docs.where(F.col(id_col).isNull())).select(*docs.columns)
