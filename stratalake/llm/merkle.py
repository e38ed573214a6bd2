"""Merkle manifest of a dataset, with proofs folded from retained hash states.

A node is the hash of its at most three children. A parent keeps a copy of its hash state
before each child slot, so that putting another child in a slot takes that state, the
replacement and the siblings to its right; what is left of the slot is not hashed again.

Trees are built and folded in blocks of 3**6 consecutive nodes: a task holds whole blocks
only, however large a source is.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import free_name, importable, sized, stored

FANOUT = 3
#: Levels that a task builds at once, from FANOUT**LEVELS nodes.
LEVELS = 6


# ---- hashing, plain -----------------------------------------------------------------------


class Parent:
    """A node over its children: its digest, and a copy of the state before each child slot."""

    __slots__ = ("children", "states", "digest")

    def __init__(self, children: list[bytes]) -> None:
        self.children = children
        self.states = []
        state = hashlib.sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()

    def folded(self, slot: int, replacement: bytes) -> bytes:
        """The digest with another child in a slot, from the state kept for that slot."""
        state = self.states[slot].copy()
        state.update(replacement)
        for sibling in self.children[slot + 1 :]:
            state.update(sibling)
        return state.hexdigest().encode()

    def siblings(self, slot: int) -> bytes:
        return b"".join(self.children[:slot] + self.children[slot + 1 :])


def build(nodes: list[bytes], n: int, levels: int) -> list[list[Parent]]:
    """The levels above the nodes of a block, the lowest first: up to the top of its tree of ``n`` nodes, ``levels`` at most."""
    built: list[list[Parent]] = []
    while n > 1 and len(built) < levels:
        n = -(-n // FANOUT)
        parents = [Parent(nodes[i : i + FANOUT]) for i in range(0, len(nodes), FANOUT)]
        built.append(parents)
        nodes = [p.digest for p in parents]
    return built


def steps(built: list[list[Parent]], place: int) -> list[tuple[Parent, int]]:
    """(parent, slot) on the way of a block's node to the top of the block."""
    way = []
    for parents in built:
        place, slot = divmod(place, FANOUT)
        way.append((parents[place], slot))
    return way


# ---- leaves and places --------------------------------------------------------------------


def _field(column: str) -> str:
    """``-`` for null, else byte count, colon, value."""
    text = f"cast({column} as string)"
    return f"coalesce(concat(octet_length({text}), ':', {text}), '-')"


def leaves(docs: DataFrame) -> DataFrame:
    """(source, doc_id, leaf, tampered): the leaf of each row as it is and as tampering leaves it.

    Tampering takes the line feeds out of the text where 2 divides the crc32 of the id; a null id has
    no crc32 and its row is not tampered with. Hex digests, made by built-in functions.
    """
    head = ", ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    tampered = "CASE WHEN crc32(cast(doc_id as string)) % 2 = 0 THEN replace(text, '\\n', '') ELSE text END"
    return docs.select("doc_id", "source", "lang", "n_chars", "text", F.expr(tampered).alias("_text")).selectExpr(
        "source",
        "doc_id",
        f"sha2(concat({head}, {_field('text')}), 256) AS leaf",
        f"sha2(concat({head}, {_field('_text')}), 256) AS tampered",
    )


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Rows with ``place`` in their group, by ``order``, from 0, and ``n``, the rows of the group.

    Sorted over all partitions, a group of any size over many of them, and stored with a number that ascends; what a
    partition holds of a group is a count, and only counts meet in a window.
    """
    rows = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    ordered = stored(rows.withColumn("_at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_at", 33)
    runs = ordered.groupBy(F.col(group).alias("_group"), part.alias("_part")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "_group",
        "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("_group")).alias("n"),
    )
    runs = sized(stored(runs, "runs"))
    here = ordered[group].eqNullSafe(runs["_group"]) & (F.shiftright(ordered["_at"], 33) == runs["_part"])
    return ordered.join(runs, here).withColumn("place", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift", "_group")


def blocks(nodes: DataFrame, levels: int, *columns: str) -> DataFrame:
    """A row per block (tree, n, block, members): its nodes by place, at most FANOUT**levels of them."""
    member = F.struct("place", "digest", *columns)
    return nodes.groupBy("tree", "n", F.expr(f"place div {FANOUT**levels}").alias("block")).agg(
        F.array_sort(F.collect_list(member)).alias("members")
    )


# ---- up: digests --------------------------------------------------------------------------


def _digests(packed: DataFrame, levels: int) -> DataFrame:
    """(tree, n, place, digest) of what each block comes to: the nodes of the next round."""
    spark = packed.sparkSession
    importable(spark)
    tree = dict(packed.dtypes)["tree"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n, members in zip(batch["n"].to_pylist(), batch["members"], strict=True):
                nodes = [m["digest"].encode() for m in members.as_py()]
                built = build(nodes, n, levels)
                out.append((built[-1][0].digest if built else nodes[0]).decode())
            left = pa.array([-(-n // FANOUT**levels) for n in batch["n"].to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["tree"], left, batch["block"], pa.array(out, pa.string())], names=["tree", "n", "place", "digest"]
            )

    slim = packed.select("tree", "n", "block", F.expr("transform(members, m -> struct(m.digest))").alias("members"))
    return slim.mapInArrow(run, f"tree {tree}, n bigint, place bigint, digest string")


def grown(nodes: DataFrame, levels: int, *columns: str) -> tuple[list[DataFrame], DataFrame]:
    """(blocks of each round, lowest first; (tree, digest) of the tops).

    ``nodes`` is (tree, n, place, digest). A round makes a node of each block; trees of one
    node are done. As many rounds as the largest tree needs, a block for a node each time.
    """
    rounds = []
    while True:
        packed = stored(blocks(nodes, levels, *(columns if not rounds else ())), "blocks")
        rounds.append(packed)
        nodes = stored(_digests(packed, levels), "nodes")
        if nodes.where("n > 1").isEmpty():
            return rounds, nodes.select("tree", "digest")


# ---- down: ways to the root ---------------------------------------------------------------

#: A way is a list of (siblings to the left, to the right), from the lowest level up.
_WAY = "array<struct<left:string,right:string>>"


def _ways(packed: DataFrame, levels: int) -> DataFrame:
    """(tree, place, way) of every node of the blocks; ``way`` of a block goes on from its top."""
    tree = dict(packed.dtypes)["tree"]
    names = ["tree", "place", "way"]
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                n, members, onward = (batch[c][row].as_py() for c in ("n", "members", "way"))
                built = build([m["digest"].encode() for m in members], n, levels)
                ways = []
                for i in range(len(members)):
                    own = [
                        {"left": b"".join(p.children[:s]).decode(), "right": b"".join(p.children[s + 1 :]).decode()}
                        for p, s in steps(built, i)
                    ]
                    ways.append(own + (onward or []))
                trees = pa.repeat(batch["tree"][row], len(members))
                places = pa.array([m["place"] for m in members], pa.int64())
                yield pa.RecordBatch.from_arrays([trees, places, pa.array(ways, kind)], names=names)

    return packed.mapInArrow(run, f"tree {tree}, place bigint, way {_WAY}")


def descended(rounds: list[DataFrame], ways: DataFrame, levels: int) -> DataFrame:
    """The lowest round's blocks, each with the ``way`` from its top to the root.

    ``ways`` (tree, way) leads on from the top of each tree.
    """
    ways = ways.withColumn("place", F.lit(0).cast("bigint"))
    for packed in reversed(rounds):
        if packed is not rounds[-1]:
            ways = stored(_ways(above, levels), "ways")  # noqa: F821 - set by the round before
        ways = ways.select(F.col("tree").alias("_tree"), F.col("place").alias("_place"), "way")
        same = packed["tree"].eqNullSafe(ways["_tree"]) & (packed["block"] == ways["_place"])
        above = packed.join(ways, same).drop("_tree", "_place")
    return above


def _folded(packed: DataFrame, levels: int) -> DataFrame:
    """(tree, doc_id, leaf, subroot, root, proof_sha256, folded_root) of every leaf of the blocks."""
    kinds = dict(packed.selectExpr("tree", "inline(members)").dtypes)
    names = ["tree", "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
    schema = f"tree {kinds['tree']}, doc_id {kinds['doc_id']}, " + ", ".join(f"{c} string" for c in names[2:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                n, members, onward = (batch[c][row].as_py() for c in ("n", "members", "way"))
                built = build([m["digest"].encode() for m in members], n, levels)
                # beyond the block all leaves share parents: the state before their slot is made once
                beyond, shared = [], b""
                for level in onward or []:
                    left, right = level["left"].encode(), level["right"].encode()
                    beyond.append((hashlib.sha256(left), right))
                    shared += left + right
                proofs, roots = [], []
                for i, member in enumerate(members):
                    node, proof = member["tampered"].encode(), hashlib.sha256()
                    for parent, slot in steps(built, i):
                        proof.update(parent.siblings(slot))
                        node = parent.folded(slot, node)
                    proof.update(shared)
                    for kept, right in beyond:
                        state = kept.copy()
                        state.update(node + right)
                        node = state.hexdigest().encode()
                    proofs.append(proof.hexdigest())
                    roots.append(node.decode())
                whole = [pa.repeat(batch[c][row], len(members)) for c in ("tree", "subroot", "root")]
                ids = pa.array([m["doc_id"] for m in members], batch["members"].type.value_type.field("doc_id").type)
                leaf = pa.array([m["digest"] for m in members])
                columns = [whole[0], ids, leaf, *whole[1:], pa.array(proofs), pa.array(roots)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return packed.mapInArrow(run, schema)


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified) of every document.

    ``docs`` has doc_id, source, lang, n_chars and text; further columns are left out. A null
    source is a source of its own and comes first; null ids come first in their source; rows that
    share an id go by their leaf, so repeated rows are leaves of their own with equal digests.
    An empty table has no root and gives no rows. A text of any length is hashed whole.
    ``levels`` bounds what a task holds and doesn't change the result.
    """
    importable(docs.sparkSession)
    rows = placed(stored(leaves(docs), "leaves"), "source", ["doc_id", "leaf"])
    rounds, tops = grown(rows.withColumnsRenamed({"source": "tree", "leaf": "digest"}), levels, "doc_id", "tampered")
    # the subroots are the nodes of one tree over all sources
    over = placed(tops.withColumn("all", F.lit(0)), "all", ["tree"])
    over = stored(over.select(F.col("all").alias("tree"), "n", "place", "digest", F.col("tree").alias("source")), "over")
    over_rounds, root = grown(over, levels)
    ways = _ways(descended(over_rounds, root.select("tree", F.array().cast(_WAY).alias("way")), levels), levels)
    ends = ways.join(over.select("place", "source", F.col("digest").alias("subroot")), "place").select(
        F.col("source").alias("tree"), "subroot", "way"
    )
    ends = stored(ends.withColumn("root", root.select("digest").scalar()), "ways")
    packed = descended(rounds, ends.select("tree", "way"), levels)
    tops = sized(ends.select(F.col("tree").alias("_tree"), "subroot", "root"))
    found = _folded(packed.join(tops, F.col("tree").eqNullSafe(F.col("_tree"))), levels)
    return found.withColumnRenamed("tree", "source").withColumn("verified", F.expr("folded_root = root"))
