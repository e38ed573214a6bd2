"""Substring dedup: bytes covered by a long string that also starts earlier.

Windows of LENGTH bytes are compared only where they may be equal. Of the grams in a window
the one of least hash is its anchor, so equal windows have anchors with one gram at one
offset. An anchor's context is what its windows cover. A context that occurs before is
covered whole; only contexts that share a gram but differ are sorted as suffixes. Hashes
bring together what may be equal; that it is, the bytes tell.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import sized, stored
from stratalake.llm.suffix import Suffixes, mixed, prefix_hashes, substring_hashes

LENGTH = 100
GRAM = 32
#: Bytes of a text anchored at once.
BLOCK = 1 << 20
#: A gram with more anchors is judged context by context, and one with more contexts is dealt out by window.
MANY = 4096
#: Bits of the digests of contexts, each time with another seed: if different contexts of a frequent gram agree, the next one's turn comes.
DIGESTS = (64, 64, 64)
#: Windows, and contexts, that a task remembers, to keep repeats of them from the shuffle.
SEEN = 1 << 17
#: Windows that a task sorts at once.
SORTED = 1 << 19
_PLACE = np.uint64((1 << 24) - 1)


def anchors(data: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(gram hash, place, first window, last window) of all anchors, block by block.

    Windows from the first to the last are those with this anchor. A window's anchor depends
    on its bytes alone: the leftmost gram of least hash.
    """
    per_window = length - gram + 1
    for at in range(0, max(0, len(data) - length + 1), BLOCK):
        part = data[at : at + BLOCK + length - 1]
        prefix = prefix_hashes(part)
        grams = mixed(substring_hashes(prefix, np.arange(len(part) - gram + 1), gram))
        least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        span = 1
        while span * 2 <= per_window:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < per_window:
            least = np.minimum(least[: len(least) - (per_window - span)], least[per_window - span :])
        place = (least & _PLACE).astype(np.int64)  # of the anchor of each window
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        last = np.append(first[1:], len(place)) - 1
        yield grams[place[first]], place[first] + at, first + at, last + at


def _merged(doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Overlapping or touching intervals of a document as one."""
    order = np.lexsort((low, doc))
    doc, low, high = doc[order], low[order], high[order]
    if not len(doc):
        return doc, low, high
    starts_doc = np.append(True, doc[1:] != doc[:-1])
    # Running maxima within a document: shift each document above the ones before.
    step = int(high.max()) + 1
    rank = np.cumsum(starts_doc) - 1
    reach = np.maximum.accumulate(high + rank * step) - rank * step
    new = starts_doc | np.append(True, low[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return doc[first], low[first], reach[np.append(first[1:], len(doc)) - 1]


def _cells(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a column of texts or byte strings; the bytes aren't copied."""
    cells = column.cast(pa.large_binary())
    _, offsets, data = cells.buffers()
    offsets = np.frombuffer(offsets, np.int64)[cells.offset : cells.offset + len(cells) + 1]
    return offsets - offsets[0], np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]


def _again(data: np.ndarray, start: np.ndarray, size: np.ndarray, key: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Which byte strings are equal to an earlier one of their key. Digests find them, the bytes decide.

    Of different strings with one digest only those equal to the first are told.
    """
    order = np.lexsort((digest, key))
    same = np.append(False, (key[order[1:]] == key[order[:-1]]) & (digest[order[1:]] == digest[order[:-1]]))[: len(order)]
    first = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    out = np.zeros(len(order), bool)
    view = memoryview(data)
    pairs = order[same], first[same]
    equal = [
        view[a : a + n].tobytes() == view[b : b + m].tobytes()
        for a, n, b, m in zip(*(x[i].tolist() for i in pairs for x in (start, size)))
    ]
    out[pairs[0]] = equal
    return out


_FOUND = "gram long, context long, ord long, tie long, place long, first long, last long, covered boolean"


def _found(texts: DataFrame, length: int, gram: int, seed: int, bits: int) -> DataFrame:
    """A row for each anchor, but of equal contexts in a batch only the first; the others are covered intervals."""
    names = [c.split()[0] for c in _FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            if not batch.num_rows:
                continue
            ords, ties = (np.asarray(batch.column(i)) for i in (0, 1))
            offsets, data = _cells(batch.column(2))
            parts = []
            for i in np.lexsort((ties, ords)):  # in document order, so that what is first stays first
                text = data[offsets[i] : offsets[i + 1]]
                view = memoryview(text)
                for grams, place, first, last in anchors(text, length, gram):
                    spans = zip(first.tolist(), last.tolist(), place.tolist())
                    context = [digest(view[a : b + length], seed << 32 | p - a) for a, b, p in spans]
                    parts.append((grams, np.array(context, np.uint64) >> np.uint64(64 - bits), np.full(len(grams), i), place, first, last))
            if not parts:
                continue
            grams, context, row, place, first, last = (np.concatenate(x) for x in zip(*parts))
            repeated = _again(data, offsets[row] + first, last - first + length, grams, context)
            one = ~repeated
            at, low, high = _merged(row[repeated], first[repeated], last[repeated] + length)
            # Covered intervals ride along under a gram of their own document.
            columns = [
                np.append(grams[one].view(np.int64), ords[at] ^ ties[at]),
                np.append(context[one].view(np.int64), np.arange(len(at))),
                np.append(ords[row[one]], ords[at]),
                np.append(ties[row[one]], ties[at]),
                np.append(place[one], low),
                np.append(first[one], low),
                np.append(last[one], high - length),
                np.append(np.zeros(one.sum(), bool), np.ones(len(at), bool)),
            ]
            table = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
            for k in range(0, table.num_rows, 1 << 16):
                yield table.slice(k, 1 << 16)

    return texts.select("ord", "tie", "text").mapInArrow(run, _FOUND)


_CONTEXTS = "key long, check boolean, ord long, tie long, place long, first long, bytes binary"


def _contexts(texts: DataFrame, open_: DataFrame, length: int) -> DataFrame:
    """The bytes of the contexts to compare: (key, check, ord, tie, place, first, bytes), key dealing them to tasks.

    The key is the gram; to be checked (kind 3) it is one of gram and context; for a gram of many
    contexts (kind 2) a hash of each window, which is then a context of its own. A window, or a
    context to be checked, that the task has sent from an earlier place is not sent
    again: its interval rides along without bytes, from ``place`` to ``first``.
    """
    names = [c.split()[0] for c in _CONTEXTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple[int, int, int]] = {}  # the earliest place sent
        checked: dict[bytes, tuple[int, int, int]] = {}
        for batch in batches:
            for i in np.lexsort([np.asarray(batch.column(k)) for k in (1, 0)]).tolist():  # the first of a batch is sent first
                rows, data = batch.column(2)[i].as_py(), batch.column(3)[i].as_py().encode("utf-8", "surrogatepass")
                out, low, high = [], [], []
                o, t = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()

                def sent_before(known: dict, cell: bytes, at: int) -> bool:
                    sent = known.get(cell)
                    if sent is not None and sent < (o, t, at):
                        low.append(at)
                        high.append(at + len(cell))
                        return True
                    if len(known) >= SEEN:
                        known.clear()
                    known[cell] = (o, t, at)
                    return False

                for r in rows:
                    cell = data[r["first"] : r["last"] + length]
                    if r["kind"] == 1:
                        out.append((r["key"], False, r["place"], r["first"], cell))
                    elif r["kind"] == 3:
                        if not sent_before(checked, cell, r["first"]):
                            out.append((r["key"], True, r["place"], r["first"], cell))
                    else:
                        for s in range(r["first"], r["last"] + 1):
                            window = data[s : s + length]
                            if not sent_before(seen, window, s):
                                key = xxhash.xxh3_64_intdigest(window, (r["key"] ^ (r["place"] - s)) & (1 << 64) - 1)
                                out.append((key - (1 << 64) if key >> 63 else key, False, r["place"], s, window))
                _, a, b = _merged(np.zeros(len(low), np.int64), np.array(low, np.int64), np.array(high, np.int64))
                out += [(o ^ t, False, *span, b"") for span in zip(a.tolist(), b.tolist())]
                for k in range(0, len(out), 1 << 14):
                    keys, checks, places, firsts, datas = zip(*out[k : k + (1 << 14)])
                    n = len(keys)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), pa.array(checks, pa.bool_()), pa.array([o] * n, pa.int64()), pa.array([t] * n, pa.int64()),
                         pa.array(places, pa.int64()), pa.array(firsts, pa.int64()), pa.array(datas, pa.binary())],
                        names=names,
                    )

    lists = open_.groupBy(F.col("ord").alias("o"), F.col("tie").alias("t")).agg(
        F.collect_list(F.struct("key", "place", "first", "last", "kind")).alias("rows")
    )
    joined = texts.join(lists, (F.col("ord") == F.col("o")) & (F.col("tie") == F.col("t"))).select("ord", "tie", "rows", "text")
    return joined.mapInArrow(run, _CONTEXTS)


_MARK = ["ord", "tie", "low", "high", "clash"]


def _marks(ords: np.ndarray, ties: np.ndarray, low: np.ndarray, high: np.ndarray, clash: bool = False) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(pa.array(x) for x in (ords, ties, low, high)), pa.array(np.full(len(low), clash))], names=_MARK)


def _repeats(t: pa.Table, length: int) -> tuple[list[pa.RecordBatch], np.ndarray]:
    """Intervals of windows that occur earlier under their key, and the rows that have a window for the first time.

    A context equal to an earlier one is covered whole; the windows of the others are sorted where a key has several.
    """
    key, ords, ties, place, first = (np.asarray(t[c]) for c in ("key", "ord", "tie", "place", "first"))
    check = t["check"].to_numpy()
    cells = t["bytes"].combine_chunks()
    offsets, data = _cells(cells.chunk(0) if isinstance(cells, pa.ChunkedArray) else cells)
    starts, size = offsets[:-1], np.diff(offsets)
    number = np.cumsum(np.append(False, (key[1:] != key[:-1]) | (check[1:] != check[:-1])))
    view = memoryview(data)
    digest = np.array([xxhash.xxh3_64_intdigest(view[a : a + n]) for a, n in zip(starts.tolist(), size.tolist())], np.uint64)
    again = _again(data, starts, size, number, digest)
    left = ~again
    several = np.bincount(number[left], minlength=number[-1] + 1) > 1
    pick = np.flatnonzero(left & several[number])

    n = size[pick] - length + 1  # windows of each context
    row = np.repeat(pick, n)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    offset = place[row] - first[row] - inside  # of the anchor in the window
    # Rows come by key, document and place: a stable sort by key and offset keeps that order.
    group = number[row] * length + offset
    order = np.argsort(group, kind="stable")
    fresh = np.flatnonzero(left & ~several[number])
    where, low, high = np.flatnonzero(again), first[again], first[again] + size[again]
    if len(row):
        ranked, equal = Suffixes(data, length).sort((starts[row] + inside)[order], group[order])
        hit = order[ranked[equal]]
        at = first[row[hit]] + inside[hit]
        where, low, high = np.append(where, row[hit]), np.append(low, at), np.append(high, at + length)
        fresh = np.append(fresh, row[order[ranked[~equal]]])
    doc, low, high = _merged(where, low, high)
    marks = [_marks(ords[doc], ties[doc], low, high)]
    clash = pick[check[pick]]  # contexts that were to be equal
    if len(clash):
        marks.append(_marks(ords[clash], ties[clash], first[clash], first[clash], True))
    return marks, np.unique(fresh)


def _swept(batches: Iterator[pa.RecordBatch], length: int, at_once: int) -> Iterator[pa.RecordBatch]:
    """Marks of sorted contexts, of as many whole keys at a time as fit.

    Of a key that alone outgrows ``at_once`` only the contexts with a window for the first time are held.
    """
    held: list[pa.RecordBatch] = []
    size, limit = 0, at_once

    def windows(t: pa.Table | pa.RecordBatch) -> int:
        cells = t["bytes"] if isinstance(t, pa.Table) else t.column(t.schema.get_field_index("bytes"))
        return (pc.sum(pc.binary_length(cells)).as_py() or 0) - t.num_rows * (length - 1)

    for batch in batches:
        full = pc.greater(pc.binary_length(batch.column(batch.schema.get_field_index("bytes"))), 0)
        if not pc.all(full).as_py():
            done = pa.Table.from_batches([batch.filter(pc.invert(full))])  # intervals that are covered already
            yield _marks(*(np.asarray(done[c]) for c in ("ord", "tie", "place", "first")))
            batch = batch.filter(full)
        if not batch.num_rows:
            continue
        held.append(batch)
        size += windows(batch)
        if size >= limit:
            t = pa.Table.from_batches(held).combine_chunks()
            keys = np.asarray(t["key"])
            cut = int(np.argmax(keys == keys[-1]))  # rows of the last key may go on
            if cut:
                yield from _repeats(t.slice(0, cut), length)[0]
                rest = t.slice(cut)
            else:
                marks, fresh = _repeats(t, length)
                yield from marks
                rest = t.take(pa.array(fresh))
            held, size = rest.to_batches(), windows(rest)
            limit = max(at_once, 2 * size)
    if size:
        yield from _repeats(pa.Table.from_batches(held).combine_chunks(), length)[0]


def _sorted(contexts: DataFrame, length: int, at_once: int) -> DataFrame:
    """(ord, tie, low, high, clash): intervals of windows that occur earlier under their key, and those that ride along.

    Tasks get whole keys in order, and sort the windows of as many keys at a time as fit. ``clash``
    marks contexts that were to be equal and aren't.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _swept(batches, length, at_once)

    dealt = contexts.repartition("key").sortWithinPartitions("key", "check", "ord", "tie", "place", "first")
    return dealt.mapInArrow(run, "ord long, tie long, low long, high long, clash boolean")


def _judged(found: DataFrame, many: int) -> DataFrame:
    """(key, ord, tie, place, first, last, kind) of anchors that count.

    Kind 0 is covered whole. The others have their bytes compared: 1 under their gram, 2 window by window (a gram of
    over ``many`` contexts), 3 under their gram and context. A gram of over ``many`` anchors doesn't bring
    its rows into one task: the firsts of its contexts are aggregates that combine in each task; under the gram
    go these only, and every anchor is checked against the first of its context (3).
    """
    kept = ["key", "ord", "tie", "place", "first", "last", "kind"]
    anchors_ = found.where("NOT covered").withColumn("key", F.col("gram"))
    covered = found.where("covered").select(F.col("gram").alias("key"), *kept[1:-1], F.lit(0).alias("kind"))
    hot = sized(stored(anchors_.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > many).select("gram"), "hot"))
    some = not hot.isEmpty()
    cold = (
        (anchors_.join(hot, "gram", "left_anti") if some else anchors_)
        .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("gram")))
        .where("n > 1")
        .withColumn("kind", F.lit(1))
        .select(kept)
    )
    out = covered.unionByName(cold)
    if not some:
        return out
    rows = anchors_.join(hot, "gram", "left_semi")
    at = F.struct("ord", "tie", "place", "first", "last")
    firsts = stored(rows.groupBy("gram", "context").agg(F.min(at).alias("least"), F.count(F.lit(1)).alias("n")), "hot-contexts")
    counts = sized(stored(firsts.groupBy("gram").agg(F.count(F.lit(1)).alias("contexts")), "hot-counts"))
    several = firsts.join(counts, "gram").where("contexts > 1")
    kind = F.when(F.col("contexts") > many, F.lit(2)).otherwise(F.lit(1)).alias("kind")
    opened = several.select(F.col("gram").alias("key"), "least.*", kind)
    repeated = sized(firsts.where("n > 1").select("gram", "context"))
    check = rows.join(repeated, ["gram", "context"], "left_semi").withColumn("key", F.xxhash64("gram", "context"))
    return out.unionByName(opened).unionByName(check.withColumn("kind", F.lit(3)).select(kept))


def _outcome(texts: DataFrame, marks: DataFrame) -> DataFrame:
    """(o, t, n_removed, n_spans, kept_sha256) of every document with marked bytes."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                spans = np.array([(s["low"], s["high"]) for s in batch.column(2)[i].as_py()], np.int64)
                _, low, high = _merged(np.zeros(len(spans), np.int64), spans[:, 0], spans[:, 1])
                view = memoryview(batch.column(3)[i].as_py().encode("utf-8", "surrogatepass"))
                kept, at = hashlib.sha256(), 0
                for a, b in zip(low.tolist(), high.tolist()):
                    kept.update(view[at:a])
                    at = b
                kept.update(view[at:])
                rows.append((batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), int((high - low).sum()), len(low), kept.hexdigest()))
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(("o", "t", "n_removed", "n_spans", "kept"), r)) for r in rows])

    lists = marks.groupBy(F.col("ord").alias("o"), F.col("tie").alias("t")).agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    joined = texts.join(lists, (F.col("ord") == F.col("o")) & (F.col("tie") == F.col("t"))).select("o", "t", "spans", "text")
    return joined.mapInArrow(run, "o long, t long, n_removed long, n_spans long, kept string")


def repeated_substrings(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, many: int = MANY, at_once: int = SORTED, digests: tuple[int, ...] = DIGESTS
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row, for strings of ``length`` bytes.

    A null text is empty. Documents go by doc_id (null last), of one doc_id by a hash of the
    text, equal rows in any order: one of them is first. A whole text that occurs before is
    removed without further work if it is long enough, and stays if not.
    """
    none = F.lit((1 << 63) - 1)
    rows = docs.select("doc_id", F.coalesce("doc_id", none).alias("ord"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "ord", F.xxhash64("text").alias("tie"), "text")
    base = stored(rows.select("doc_id", "ord", "tie", F.sha2("text", 256).alias("sha"), F.octet_length("text").cast("long").alias("n_bytes")), "texts")
    firsts = base.groupBy(F.col("sha").alias("s")).agg(F.min("ord").alias("first_ord"), F.count(F.lit(1)).alias("n"))
    firsts = sized(stored(firsts.where("n > 1").select("s", "first_ord"), "firsts"))
    distinct = base.groupBy("doc_id", "ord", "tie", "sha", "n_bytes").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    known = stored(
        distinct.join(firsts, F.col("sha") == F.col("s"), "left").select(
            *distinct.columns, F.coalesce(F.col("ord") == F.col("first_ord"), F.lit(True)).alias("is_first")
        ),
        "known",
    )
    gone = sized(stored(known.where(~F.col("is_first")).select("ord", "tie").distinct(), "gone"))
    texts = rows.where(F.octet_length("text") >= length).select("ord", "tie", "text").join(gone, ["ord", "tie"], "left_anti")
    again = sized(stored(known.where("copies > 1 and is_first").select("ord", "tie").distinct(), "again"))
    if not again.isEmpty():
        once = texts.join(again, ["ord", "tie"], "left_anti")
        texts = once.unionByName(texts.join(again, ["ord", "tie"], "left_semi").dropDuplicates(["ord", "tie"]))

    for seed, bits in enumerate(digests):
        judged = stored(_judged(stored(_found(texts, length, gram, seed, bits), "found"), many), "judged")
        whole = judged.where("kind = 0").select("ord", "tie", F.col("first").alias("low"), (F.col("last") + length).alias("high"), F.lit(False).alias("clash"))
        touched = sized(stored(judged.select("ord", "tie").distinct(), "touched"))
        some = texts.join(touched, ["ord", "tie"], "left_semi")
        marks = stored(whole.unionByName(_sorted(_contexts(some, judged.where("kind > 0"), length), length, at_once)), "marks")
        if marks.where("clash").isEmpty():
            break
    else:
        raise ValueError("different contexts of a gram agree in every digest")
    marked = sized(stored(marks.select("ord", "tie").distinct(), "marked"))
    out = stored(_outcome(texts.join(marked, ["ord", "tie"], "left_semi"), marks), "outcome")

    each = known.select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    joined = each.join(out, (F.col("ord") == F.col("o")) & (F.col("tie") == F.col("t")), "left")
    stays = F.col("is_first") & (F.col("copy") == 1)
    long = F.col("n_bytes") >= length
    zero = F.lit(0).cast("long")
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(stays, F.coalesce("n_removed", zero)).when(long, F.col("n_bytes")).otherwise(zero).alias("n_removed"),
        F.when(stays, F.coalesce("n_spans", zero)).when(long, F.lit(1).cast("long")).otherwise(zero).alias("n_spans"),
        F.when(stays, F.coalesce("kept", "sha")).when(long, F.sha2(F.lit(""), 256)).otherwise(F.col("sha")).alias("kept_sha256"),
    )
