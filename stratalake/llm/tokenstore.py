"""Token ids in files of directly addressable codes: any token without decoding a block."""

import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import stored
from stratalake.sources.shared import batches_up_to

#: Id that ends every document.
END = 2
#: Tokens after which a file ends; a document is never split over files.
FILE_TOKENS = 1 << 20
#: Bytes of texts that a worker gets at once.
BATCH_BYTES = 4 << 20
#: Bits of an id that one level holds.
CHUNK = 8
_MAGIC = b"DACS"
_RANK = 64  # bytes of the bitmap that one entry of the rank directory spans
#: Pre-tokens that a worker holds at most, some 35 MB; once full, misses after which the cache starts anew.
_CACHE = 150_000
_RENEW = 8 * _CACHE
_MARKED = 1 << 20  # slots that tell whether a pre-token was met before; half of them used, they start anew
_BLOCK = 1 << 16
_SPACE = re.compile("[\\t-\\r\\x20]")
#: Texts of characters whose normal form, lower case and class need no look-up beyond these.
_PLAIN = re.compile("[\t-\r\x20-\x7eÀ-ÖØ-öø-ſ]*")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^\t-\r\x20a-zß-öø-ſ0-9]+")
_MARKS = re.compile("[^\t-\r\x20a-zß-öø-ſ0-9]+")
#: Normal form and pre-tokens that the short path stands for: the settings of a vocabulary that may take it.
_SHORT = {
    "normalizer": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    "pre_tokenizer": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def _takes_short_path(settings: dict) -> bool:
    """Whether a tokenizer's settings are those the short path stands for; its added tokens all hold ``<|``."""
    normal, pre = settings["normalizer"] or {}, settings["pre_tokenizer"] or {}
    same = normal.get("normalizers") == _SHORT["normalizer"] and pre.get("pretokenizers") == _SHORT["pre_tokenizer"]
    return same and settings["model"]["type"] == "BPE" and all("<|" in t["content"] for t in settings["added_tokens"])


def _pieces(low: str) -> list[str]:
    """The pre-tokens of a plain, lower-cased text."""
    if "'" in low:
        return _PIECES.findall(low)
    low = _MARKS.sub(r" \g<0> ", low)  # without apostrophes, runs of marks, digits and letters are all there is
    for digit in "0123456789":
        if digit in low:
            low = low.replace(digit, f" {digit} ")
    return low.split()


class Pieces(dict):
    """Ids of a pre-token, as bytes, merged by the library's model; held from the second time it is met.

    What is met once takes no memory. A full cache stays as it is, as frequent pre-tokens came
    first, until misses show that texts may have changed: then it starts anew.
    """

    def __init__(self, model) -> None:
        self.model = model
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in printable]
        # The byte-level alphabet: printable bytes stand for themselves, the others follow from 256.
        self.alphabet = dict(zip([*printable, *other], [chr(b) for b in printable] + [chr(256 + i) for i in range(len(other))]))
        self._unmark()
        self.missed = 0

    def _unmark(self) -> None:
        self.met, self.marks = bytearray(_MARKED), 0

    def __missing__(self, piece: str) -> bytes:
        mapped = piece if piece.isascii() else "".join([self.alphabet[b] for b in piece.encode()])
        out = _packed([t.id for t in self.model.tokenize(mapped)])
        if len(self) >= _CACHE:
            self.missed += 1
            if self.missed >= _RENEW:
                self.clear()
                self._unmark()
                self.missed = 0
            return out
        at = hash(piece) % _MARKED
        if self.met[at]:
            self[piece] = out
        else:
            self.met[at] = 1
            self.marks += 1
            if self.marks > _MARKED // 2:
                self._unmark()
        return out


class Encoder:
    """A tokenizer with word ends: ids of texts as little-endian 32-bit numbers.

    A plain text is cut into pre-tokens here, as the vocabulary's own pattern does, and the
    library's model merges each distinct one once. Any other text is cut at ASCII white
    space, which is exact as no pre-token holds any, and goes through the whole tokenizer.
    With a vocabulary of other settings every text goes through it uncut.
    """

    def __init__(self, file: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.short = _takes_short_path(json.loads(self.tokenizer.to_str()))
        self.pieces = Pieces(self.tokenizer.model)

    def ids(self, text: str) -> bytes:
        if not self.short:
            return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        out, at = [], 0
        while at < len(text):
            part = _line_end(text, at)
            at += len(part)
            if _PLAIN.fullmatch(part) and "<|" not in part:
                out += map(self.pieces.__getitem__, _pieces(part.lower()))
            else:
                out.append(_packed(self.tokenizer.encode(part, add_special_tokens=False).ids))
        return b"".join(out)


def _line_end(text: str, at: int) -> str:
    """The next piece of a text: up to white space after _BLOCK characters."""
    if len(text) - at <= _BLOCK:
        return text[at:]
    space = _SPACE.search(text, at + _BLOCK)
    return text[at : space.end()] if space else text[at:]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def encoder(file: str) -> Encoder:
    return Encoder(file)


def packed_file(doc_ids: list[int | None], documents: list[bytes]) -> bytes:
    """A file: header, document index, then per level its chunks, continuation bitmap and rank directory.

    ``documents``: ids of each as little-endian 32-bit numbers.
    """
    ids = np.frombuffer(b"".join(documents), "<u4")
    ends = np.cumsum([len(d) // 4 for d in documents], dtype="<u8")
    known = np.array([d is not None for d in doc_ids], np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], "<i8")
    levels, rest = [], ids
    while True:
        more = rest >> CHUNK
        goes_on = more > 0
        bits = np.packbits(goes_on, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % _RANK))
        counts = np.bitwise_count(bits.reshape(-1, _RANK)).sum(1, dtype="<u8") if len(bits) else np.zeros(0, "<u8")
        ranks = np.concatenate([np.zeros(1, "<u8"), np.cumsum(counts, dtype="<u8")])
        levels.append(((rest & (1 << CHUNK) - 1).astype(np.uint8), bits, ranks))
        if not goes_on.any():
            break
        rest = more[goes_on]
    head = struct.pack("<4sIQ", _MAGIC, len(levels), len(doc_ids))
    sizes = b"".join(struct.pack("<Q", len(chunks)) for chunks, _, _ in levels)
    body = b"".join(x.tobytes() for level in levels for x in level)
    return head + sizes + numbers.tobytes() + known.tobytes() + ends.tobytes() + body


class TokenFile:
    """Random access to a file's tokens; nothing is decoded but what is asked for."""

    def __init__(self, data: bytes) -> None:
        magic, n_levels, n = struct.unpack_from("<4sIQ", data)
        if magic != _MAGIC:
            raise ValueError("not a token file")
        at = struct.calcsize("<4sIQ")

        def read(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        sizes = read("<u8", n_levels).tolist()
        self.doc_ids, self.known, self.ends = read("<i8", n), read("u1", n), read("<u8", n)
        self.levels = []
        for size in sizes:
            n_bits = -(-size // 8)
            n_bits += -n_bits % _RANK
            self.levels.append((read("u1", size), read("u1", n_bits), read("<u8", n_bits // _RANK + 1)))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def _rank(self, level: int, at: int) -> int:
        """How many of the first ``at`` chunks of a level go on in the next one."""
        _, bits, ranks = self.levels[level]
        block = at // (8 * _RANK)
        part = bits[block * _RANK : -(-at // 8)]
        over = int(part[-1] >> (at % 8)).bit_count() if len(part) and at % 8 else 0
        return int(ranks[block]) + int(np.bitwise_count(part).sum(dtype=np.int64)) - over

    def token(self, at: int) -> int:
        out = 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            out |= int(chunks[at]) << (CHUNK * level)
            if not bits[at // 8] >> (at % 8) & 1:
                break
            at = self._rank(level, at)
        return out

    def tokens(self, start: int, end: int) -> np.ndarray:
        """The ids from start to before end."""
        chunks, bits, _ = self.levels[0]
        out = chunks[start:end].astype("<u4")
        place = np.arange(end - start)
        for level in range(1, len(self.levels)):
            _, bits, _ = self.levels[level - 1]
            own = np.unpackbits(bits[start // 8 : -(-end // 8)], bitorder="little")[start % 8 :][: end - start].astype(bool)
            place = place[own]
            start, end = self._rank(level - 1, start), self._rank(level - 1, end)
            out[place] |= self.levels[level][0][start:end].astype("<u4") << np.uint32(CHUNK * level)
        return out

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        """(doc_id, start, end) of every document in the file."""
        start = 0
        for doc_id, known, end in zip(self.doc_ids.tolist(), self.known.tolist(), self.ends.tolist()):
            yield doc_id if known else None, start, end
            start = end


def stored_order() -> list[Column]:
    """The order of rows read from Parquet as they were written: by part of the write, file and row."""
    name = F.col("_metadata.file_name")
    return [F.regexp_extract(name, "^part-([0-9]+)", 1).cast("int"), name, F.col("_metadata.row_index")]


def write_tokens(docs: DataFrame, vocabulary: str, name: str = "tokens", order: list[Column] | None = None) -> DataFrame:
    """Files of all documents' ids, each ended by END, in ascending doc_id order or that of ``order``.

    One row per file: part, file_no, n_docs, n_tokens, start (tokens before it) and data, the
    file's bytes. The rows are a stored table, so that files are committed by Spark wherever
    the shared folder is. A null or empty text is END alone; without ``order`` null ids come
    first, rows of one id in the order of their text's hash. Only texts are shuffled, once, by
    ranges of the order; starts are sums over parts, then over the files of a part.
    """
    conf = docs.sparkSession.conf
    parts = int(conf.get("spark.sql.shuffle.partitions"))

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, ids, held, count = encoder(vocabulary), [], [], 0
        end = struct.pack("<I", END)

        def made() -> pa.RecordBatch:
            row = {"n_docs": [len(ids)], "n_tokens": [count], "data": [packed_file(ids, held)]}
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("data", pa.binary())]))

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                held.append(words.ids(text.as_py() or "") + end)
                count += len(held[-1]) // 4
                if count >= FILE_TOKENS:
                    yield made()
                    ids, held, count = [], [], 0
        if ids:
            yield made()

    rows = docs.select("doc_id", "text", *(c.alias(f"order_{i}") for i, c in enumerate(order or [])))
    keys = [F.col(c) for c in rows.columns[2:]] if order else [F.col("doc_id"), F.xxhash64("text")]
    rows = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select("doc_id", "text")
    made = rows.mapInArrow(files, "n_docs long, n_tokens long, data binary")
    # An id is its task's number and its place in the task, so it keeps the order of files.
    numbered = made.withColumn("file_no", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id())
    with batches_up_to(docs.sparkSession, BATCH_BYTES):
        kept = stored(numbered.select("part", "file_no", "n_docs", "n_tokens", "data"), name)
    sums = kept.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumnRenamed("part", "p")
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    offsets = sums.select("p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    index = kept.select("part", "file_no", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("inside"))
    starts = index.join(offsets, F.col("part") == F.col("p")).select(
        F.col("file_no").alias("f"), (F.col("offset") + F.col("inside")).alias("start")
    )
    return stored(starts, f"{name}-index").join(kept, F.col("f") == F.col("file_no")).select(
        "part", "file_no", "n_docs", "n_tokens", "start", "data"
    )


def read_tokens(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files' bytes."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for offset, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                file = TokenFile(data.as_py())
                rows = [(d, offset + a, b - a, zlib.crc32(file.tokens(a, b).tobytes())) for d, a, b in file.documents()]
                names = ("doc_id", "start", "n_tokens", "ids_crc32")
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    return files.select("start", "data").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
