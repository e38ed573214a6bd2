"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

DataFrame expressions only.
"""

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import sized, stored

#: Words of a shingle, and the least weighted similarity of a window and an item.
SHINGLE = 5
SIMILARITY = 0.8
#: Shingles of an item that are searched as one; a longer item is searched by equal parts of at most that many.
PART = 1024
#: Bits that the fingerprints of a window and an item may differ in. Repeats of a shingle are hashed
#: with their number, so counted similarity is that of sets; at 0.8 the distance is 9.7 on
#: average, with a deviation of 2.9, and 3 in 10,000 such pairs are further apart than this.
RADIUS = 20
BLOCKS = 8
_WIDTH = 64 // BLOCKS
#: The radius searched in each block: two fingerprints within RADIUS agree this well in one.
_RADII = [RADIUS // BLOCKS - (i > RADIUS % BLOCKS) for i in range(BLOCKS)]


def words(text: str = "text") -> str:
    """Lower-cased runs of letters and digits."""
    return f"filter(split(lower(coalesce({text}, '')), '[^\\\\p{{L}}\\\\p{{N}}]+'), w -> w != '')"


def hashes(of: str) -> str:
    """A hash of every shingle of an array of words."""
    gram = ", ".join(f"h[i + {k}]" for k in range(SHINGLE))
    return f"""transform(array(transform({of}, w -> xxhash64(w))), h -> if(size(h) < {SHINGLE}, array(),
        transform(sequence(0, greatest(size(h) - {SHINGLE}, 0)), i -> xxhash64({gram}))))[0]"""


def simhash(of: str) -> str:
    """64-bit SimHash of an array of hashes, each occurrence counting; of 65,535 at most, which a part never exceeds.

    Sixteen sums hold the counts of four bits each, in 16-bit lanes.
    """
    sums = ", ".join(f"aggregate({of}, 0L, (a, h) -> a + (shiftrightunsigned(h, {k}) & 281479271743489L))" for k in range(16))
    bits = f"""aggregate(sequence(0, 63), 0L, (a, b) ->
        a | if(2 * (shiftrightunsigned(s[b % 16], 16 * (b div 16)) & 65535L) > size({of}), shiftleft(1L, b), 0L))"""
    return f"transform(array(array({sums})), s -> {bits})[0]"


def _once(rows: DataFrame, **made: str) -> DataFrame:
    """Columns computed once a row: an explode of one element keeps them out of the lambdas that use them."""
    fields = ", ".join(f"'{name}', {value}" for name, value in made.items())
    held = rows.select("*", F.explode(F.expr(f"array(named_struct({fields}))")).alias("_made"))
    return held.select(*rows.columns, *(F.col(f"_made.{name}").alias(name) for name in made))


def numbered(of: str, made: str) -> str:
    """An array with the copies of each value told apart: ``made`` of the value s[p] and the number k of its copy.

    Sorted, then cut into runs of equal values.
    """
    first = "filter(sequence(0, size(s) - 1), i -> i = 0 OR s[i - 1] <> s[i])"
    copies = f"transform(sequence(0, coalesce(get(t, j + 1), size(s)) - p - 1), k -> {made})"
    return f"transform(array(array_sort({of})), s -> transform(array({first}), t -> flatten(transform(t, (p, j) -> {copies})))[0])[0]"


def fingerprint(of: str) -> str:
    """SimHash of the shingles of an array of words, copies of a shingle told apart."""
    return f"transform(array({numbered(hashes(of), 'xxhash64(s[p], k)')}), g -> {simhash('g')})[0]"


def _items(benchmark: DataFrame) -> DataFrame:
    """(item_no, item_id, item_words, n_shingles, item_fp) of items of SHINGLE words or more, a row per part."""
    rows = benchmark.select("item_id", F.expr(words()).alias("all_words")).where(F.size("all_words") >= SHINGLE)
    rows = _once(rows, n_all=f"size(all_words) - {SHINGLE - 1}")
    rows = _once(rows, n_parts=f"cast(ceil(n_all / {PART}) as int)")
    part = f"""transform(sequence(0, n_parts - 1), b -> slice(all_words, cast(b * cast(n_all as bigint) div n_parts as int) + 1,
        cast((b + 1) * cast(n_all as bigint) div n_parts - b * cast(n_all as bigint) div n_parts as int) + {SHINGLE - 1}))"""
    rows = rows.select("item_id", F.explode(F.expr(part)).alias("item_words"))
    rows = rows.withColumn("n_shingles", F.size("item_words") - (SHINGLE - 1))
    return rows.withColumn("item_fp", F.expr(fingerprint("item_words"))).withColumn("item_no", F.monotonically_increasing_id())


def _keys_of_item() -> Column:
    """(block, key) of the ball around each block of an item's fingerprint."""
    balls = []
    for i, r in enumerate(_RADII):
        masks = [sum(1 << b for b in c) for k in range(r + 1) for c in combinations(range(_WIDTH), k)]
        own = f"(shiftrightunsigned(item_fp, {_WIDTH * i}) & {2**_WIDTH - 1}L)"
        balls.append(f"transform(array({', '.join(f'{m}L' for m in masks)}), m -> struct({i} as block, {own} ^ m as key))")
    return F.expr(f"concat({', '.join(balls)})")


def _within(block: int) -> str:
    return f"bit_count(shiftrightunsigned(fp ^ item_fp, {_WIDTH * block}) & {2**_WIDTH - 1}L) <= {_RADII[block]}"


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, similarity, start_word, n_words): the best window of each document and item.

    A window has as many words as the item, or is the whole document if that is shorter. It
    matches if the counted shingles they share are at least SIMILARITY of the larger counts.
    Null texts and documents or items of fewer than SHINGLE words never match; rows of one
    doc_id are told apart by text_hash, equal rows give one match. An item of more than PART shingles is
    searched by its parts, and a passage like one of them is a match of the item. Items are told
    apart by row: texts that share an item_id are searched each on its own and the best is
    reported for the id; a null item_id is an id like any other.

    A window that similar holds at least SIMILARITY * (window + item) / (1 + SIMILARITY)
    places of the item's shingles, so only windows with that many are made. Their
    fingerprints meet the items' in multi-index blocks, and pairs within RADIUS are checked
    on the words.
    """
    items = stored(_items(benchmark), "items")
    grams = F.explode(F.array_distinct(F.expr(hashes("item_words")))).alias("h")
    of_shingle = sized(stored(items.select("item_no", "n_shingles", grams), "item-shingles"))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    places = rows.select("doc_id", "text_hash", F.posexplode(F.expr(hashes(words()))).alias("pos", "h"))
    met = places.join(of_shingle, "h").groupBy("doc_id", "text_hash", "item_no", "n_shingles").agg(
        F.sort_array(F.collect_set("pos")).alias("places")
    )
    near = stored(met.where(F.size("places") >= SIMILARITY * F.col("n_shingles") - 1e-9), "met")
    # the texts that may match: keys are broadcast, the lists of places aren't
    keys = sized(stored(near.select("doc_id", "text_hash").distinct(), "met-keys"))

    def same(a: str, b: str) -> Column:
        return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_hash") == F.col(f"{b}.text_hash"))

    texts = rows.alias("r").join(keys.alias("k"), same("r", "k"), "left_semi").distinct()
    full = texts.alias("r").join(near.alias("m"), same("r", "m")).select("r.*", "m.item_no", "m.n_shingles", "m.places")
    full = _once(full, w=words()).drop("text")
    full = _once(full, size=f"least(size(w) - {SHINGLE - 1}, n_shingles)", last=f"greatest(size(w) - {SHINGLE - 1} - n_shingles, 0)")
    full = _once(full, need=f"cast(ceil({SIMILARITY}D * (size + n_shingles) / {1 + SIMILARITY}D - 1e-9D) as int)")
    # starts up to place j and after the place before it, from which the window reaches the place that makes up the number
    low = "greatest(if(j = 0, 0, places[j - 1] + 1), places[j + need - 1] - size + 1)"
    starts = f"""if(size(places) < need, array(), flatten(transform(sequence(0, size(places) - need), j ->
        if({low} <= least(places[j], last), sequence({low}, least(places[j], last)), array()))))"""
    windows = (
        full.select("doc_id", "text_hash", "n_shingles", "size", "w", F.explode(F.expr(starts)).alias("start"))
        .select("doc_id", "text_hash", "n_shingles", "start", F.expr(f"slice(w, start + 1, size + {SHINGLE - 1})").alias("window"))
        .distinct()
    )
    windows = _once(windows, fp=fingerprint("window"))
    blocks = F.expr(
        f"transform(sequence(0, {BLOCKS - 1}), i -> struct(i as block, shiftrightunsigned(fp, {_WIDTH} * i) & {2**_WIDTH - 1}L as key))"
    )
    probes = windows.select("*", F.explode(blocks).alias("b"))
    balls = items.select("item_no", F.col("n_shingles").alias("m"), "item_fp", F.explode(_keys_of_item()).alias("t"))
    # A pair that several blocks give counts in the first of them only.
    first = " AND ".join(f"(b.block <= {i} OR NOT {_within(i)})" for i in range(BLOCKS))
    pairs = probes.join(
        sized(stored(balls, "item-blocks")),
        (F.col("n_shingles") == F.col("m")) & (F.col("b.block") == F.col("t.block")) & (F.col("b.key") == F.col("t.key"))
        & F.expr(f"bit_count(fp ^ item_fp) <= {RADIUS} AND {first}"),
    ).select("doc_id", "text_hash", "start", "window", "item_no")
    pairs = pairs.join(sized(items.select("item_no", "item_id", "item_words")), "item_no")
    shingles = f"transform(sequence(0, size({{0}}) - {SHINGLE}), i -> array_join(slice({{0}}, i + 1, {SHINGLE}), ' '))"
    a, c = (numbered(shingles.format(x), "concat(s[p], ' ', k)") for x in ("window", "item_words"))
    checked = _once(pairs, shared=f"size(array_intersect({a}, {c}))", both=f"size(window) + size(item_words) - {2 * (SHINGLE - 1)}")
    checked = checked.withColumn("similarity", F.expr("shared / (both - shared)"))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), F.size("window").alias("n_words"))).alias("best")
    return checked.where(F.col("similarity") >= SIMILARITY).groupBy("doc_id", "text_hash", "item_id").agg(best).select(
        "doc_id",
        "text_hash",
        "item_id",
        F.col("best.similarity").alias("similarity"),
        (-F.col("best.back")).alias("start_word"),
        F.col("best.n_words").alias("n_words"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that no benchmark item matches."""
    found = sized(stored(contaminated(docs, benchmark).select("doc_id", "text_hash").distinct(), "contaminated"))
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.xxhash64("d.text") == F.col("f.text_hash"))
    return docs.alias("d").join(found.alias("f"), same, "left_anti")
