"""SimHash near-duplicates: fingerprints, linked by multi-index hashing, in connected groups."""

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import exploded, map_texts, sized, stored

#: A bucket of a segment's table with more fingerprints is searched by whole balls instead.
BUCKET = 32
_BLOCK = 1 << 16


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a text's word shingles, A-Z lower-cased; as a signed number."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = max(1, len(words) - shingle + 1) if words else 0
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _BLOCK):
        part = words[at : at + _BLOCK + shingle - 1]
        grams = zip(*(part[k:] for k in range(shingle))) if len(words) >= shingle else [part]
        hashes = np.array([digest(b" ".join(g), seed) for g in grams], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; a text without words, null too, has fingerprint zero."""

    def made(columns, texts) -> dict:
        return {"doc_id": columns[0], "text_hash": columns[1], "fp": [fingerprint(t, shingle) for t in texts]}

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return map_texts(rows, made, "doc_id long, text_hash long, fp long", ("doc_id", "text_hash", "text"))


def _masks(first: int, bits: int, radius: int) -> list[int]:
    """All signed 64-bit masks with at most ``radius`` ones among ``bits`` bits from ``first``."""
    found = [sum(1 << (first + b) for b in c) for k in range(radius + 1) for c in combinations(range(bits), k)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def _longs(values: list[int]) -> F.Column:
    return F.expr("array(" + ",".join(f"{v}L" if v != -(1 << 63) else "(-9223372036854775807L - 1L)" for v in values) + ")")


def _ball(segment: int, mask: int, flips: list[int]) -> F.Column:
    """The keys of a segment near the fingerprint's own."""
    own = F.col("fp").bitwiseAND(F.lit(mask))
    return F.transform(_longs(flips), lambda x: F.struct(F.lit(segment).alias("seg"), own.bitwiseXOR(x).alias("part")))


def _segments(radius: int, parts: int) -> list[tuple[int, int, int]]:
    """(first bit, bits, radius to search): if two fingerprints differ in at most ``radius`` bits,
    they do so in some segment within the radius given for it."""
    width, each, more = 64 // parts, radius // parts, radius % parts
    return [
        (i * width, width if i < parts - 1 else 64 - i * width, each if i <= more else each - 1)
        for i in range(parts)
        if i <= more or each > 0
    ]


def near_pairs(fps: DataFrame, radius: int = 2, parts: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct fingerprints ``fp`` that differ in 1 to ``radius`` bits.

    Every fingerprint stands in a table of each segment and probes it with the ball around its
    own value; matches are verified on all 64 bits. A bucket that holds more than ``bucket``
    fingerprints isn't paired: fingerprints that would probe it emit the balls of half the
    radius around all 64 bits instead, where a key has at most as many members as a ball.
    Both ways are exact, and no key gathers more rows than a ball or a bucket has.
    """
    segments = _segments(radius, parts)
    masks = [_signed(((1 << b) - 1) << f) for f, b, _ in segments]
    fps = stored(fps.select("fp"), "fps")
    where = F.array(*(F.struct(F.lit(i).alias("seg"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(masks)))
    entries = fps.select("fp", F.explode(where).alias("k")).select("fp", "k.*")
    probe = [_ball(i, m, _masks(*seg)) for i, (seg, m) in enumerate(zip(segments, masks))]
    probes = fps.select("fp", F.explode(F.concat(*probe)).alias("k")).select("fp", "k.*")
    full = sized(stored(entries.groupBy("seg", "part").count().where(F.col("count") > bucket).select("seg", "part"), "full"))
    some = not full.isEmpty()
    if some:
        around = stored(probes.join(full, ["seg", "part"], "left_semi").select("fp").distinct(), "around")
        entries = entries.join(full, ["seg", "part"], "left_anti")
    verified = (F.col("t.fp") > F.col("p.fp")) & (F.bit_count(F.col("t.fp").bitwiseXOR(F.col("p.fp"))) <= radius)
    same = (F.col("t.seg") == F.col("p.seg")) & (F.col("t.part") == F.col("p.part"))
    # the side of fewer rows: one a segment against a ball of each
    entries = exploded(entries, fps.count() * len(masks))
    pairs = entries.alias("t").join(probes.alias("p"), same & verified).select(F.col("p.fp").alias("a"), F.col("t.fp").alias("b"))
    if some:
        pairs = pairs.unionByName(_whole_balls(around, radius))
    return pairs.distinct()


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _whole_balls(fps: DataFrame, radius: int) -> DataFrame:
    """Near pairs by keys that both have in a ball around them."""
    low, high = (_masks(0, 64, r) for r in (radius // 2, radius - radius // 2))

    def keys(masks: list[int]) -> DataFrame:
        return fps.select("fp", F.explode(F.transform(_longs(masks), lambda x: F.col("fp").bitwiseXOR(x))).alias("key"))

    near = (F.col("t.fp") > F.col("p.fp")) & (F.bit_count(F.col("t.fp").bitwiseXOR(F.col("p.fp"))) <= radius)
    few = exploded(keys(low), fps.count() * len(low))
    joined = few.alias("t").join(keys(high).alias("p"), (F.col("t.key") == F.col("p.key")) & near)
    return joined.select(F.col("p.fp").alias("a"), F.col("t.fp").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): the least node it is connected to.

    Each round hooks every node to its least neighbour, follows these links by doubling to
    their end, and contracts the edges: at most half of the nodes with edges are left. Every
    step is a stored table, so joins on a hub are plain ones that Spark can split.
    """
    edges = stored(edges.select("a", "b"), "edges")
    total = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        up = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "up")
        while True:
            up, moved = _followed(up, up)
            if not moved:
                break
        total = up if total is None else _followed(total, up)[0]
        ends = [_named(up, n) for n in ("x", "y")]
        edges = stored(
            edges.join(ends[0], F.col("a") == F.col("x_node"))
            .join(ends[1], F.col("b") == F.col("y_node"))
            .where(F.col("x_root") != F.col("y_root"))
            .select(F.least("x_root", "y_root").alias("a"), F.greatest("x_root", "y_root").alias("b"))
            .distinct(),
            "edges",
        )
    return total if total is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _named(up: DataFrame, name: str) -> DataFrame:
    return up.select(F.col("node").alias(f"{name}_node"), F.col("root").alias(f"{name}_root"))


def _followed(of: DataFrame, by: DataFrame) -> tuple[DataFrame, bool]:
    """Roots of ``of`` replaced by their own roots in ``by``, and whether any changed."""
    step = _named(by, "y")
    out = stored(
        of.join(step, F.col("root") == F.col("y_node"), "left").select(
            "node", F.coalesce("y_root", "root").alias("root"), (F.coalesce("y_root", "root") != F.col("root")).alias("moved")
        ),
        "up",
    )
    return out.select("node", "root"), not out.where("moved").isEmpty()


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, stays) of every row.

    Documents link when their fingerprints differ in at most ``radius`` bits, and
    component_id is the least doc_id reachable by links. Equal fingerprints are one node. A
    row with a null doc_id is in its component but never names it; a component of such rows
    alone has a null component_id. ``stays`` marks the row that names the component (without
    an id: the one of the least text_hash), and all rows equal to it.
    """
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    groups = stored(rows.groupBy("fp").agg(first), "groups")
    linked = components(near_pairs(groups, radius))
    named = stored(
        groups.join(linked, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root")),
        "rooted",
    )
    least = stored(named.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("least")), "least")
    of_fp = stored(named.join(least, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "least"), "components")
    stays = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))
    return rows.join(of_fp, F.col("fp") == F.col("f")).select(
        "doc_id", "text_hash", "fp", F.col("least.doc_id").alias("component_id"), stays.alias("stays")
    )


def without_near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of each component, with the columns of docs; of equal rows one stays."""
    rows = stored(near_duplicates(docs, shingle, radius), "near")
    gone = sized(stored(rows.where(~F.col("stays")).select("doc_id", "text_hash").distinct(), "gone"))
    again = sized(stored(rows.where("stays").groupBy("doc_id", "text_hash").count().where("count > 1").select("doc_id", "text_hash"), "again"))
    text_hash = F.xxhash64("d.text")

    def same(other: str):
        return F.col("d.doc_id").eqNullSafe(F.col(f"{other}.doc_id")) & (text_hash == F.col(f"{other}.text_hash"))

    kept = docs.alias("d").join(gone.alias("g"), same("g"), "left_anti")
    if again.isEmpty():
        return kept
    once = kept.alias("d").join(again.alias("a"), same("a"), "left_anti")
    return once.unionByName(kept.alias("d").join(again.alias("a"), same("a"), "left_semi").dropDuplicates(["doc_id", "text"]))
