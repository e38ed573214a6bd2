import json
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from llm_rows import documents
from tokenizers import Tokenizer

from stratalake.llm import tokenstore
from stratalake.llm.queries import op3_token_store
from stratalake.llm.tokenstore import Encoder, TokenFile, packed_file, read_tokens, write_tokens
from stratalake.sources.shared import batches_up_to

FILE = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "Ⅷ ½x É́ ﬁ <|endoftext|>a <|EndOfText|> I'll'LL 'S x²y ªb  a\xa0b İİ ΑΣ J̌ don't__x 日本 a\x1cb \x85", "a\x00b ퟿",
       "‘’“'ve'd.,'t!'s", "it's 12,34 'tis ß ÿ ɏ ×÷", "a'b''s1's", "x_y-z... 3.14", "é ́x", "ÀÉß straße"]


def test_encoder_against_tokenizer():
    enc, plain, rng = Encoder(FILE), Tokenizer.from_file(FILE), random.Random(2)
    parts = ["the", "Über", "'s", "'", "12", " ", "\n", ".", ",,", "é", "日", "ll", "'ll", "́", "_", "<|", "\xa0", "fooBar"]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(1500)]
    texts.append(" ".join(rng.choice(["alpha", "Beta", "it's", "é1"]) for _ in range(60_000)))
    for text in texts:
        assert np.frombuffer(enc.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text[:80])


def test_every_letter_of_the_short_path():
    enc, plain = Encoder(FILE), Tokenizer.from_file(FILE)
    assert enc.short
    letters = [chr(c) for c in [*range(0x20, 0x7F), *range(0xA0, 0x250)]]
    for c in letters:
        for text in (c, f"{c}X", f"ab{c}cd", f"{c}{c.upper()}", f"a {c} b1", f"It's{c}'s"):
            assert np.frombuffer(enc.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_other_vocabularies_take_the_whole_tokenizer(tmp_path):
    settings = json.loads(Tokenizer.from_file(FILE).to_str())
    settings["normalizer"]["normalizers"].pop()  # no lower case
    other = tmp_path / "other.json"
    other.write_text(json.dumps(settings))
    enc, plain = Encoder(str(other)), Tokenizer.from_file(str(other))
    assert not enc.short
    for text in ("The Cat's  hat", "ÀB 12"):
        assert np.frombuffer(enc.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_pretokens_met_once_take_no_memory():
    enc, words = Encoder(FILE), ["once" + "".join(chr(97 + int(d)) for d in str(i)) for i in range(30_000)]
    enc.ids(" ".join(words))
    assert len(enc.pieces) < 3000  # by chance, as marks are shared
    enc.ids("again and again and again")
    assert {"again", "and"} <= enc.pieces.keys()


def test_cache_is_bounded_and_exact(monkeypatch):
    for name, value in {"_CACHE": 20, "_RENEW": 100, "_MARKED": 64}.items():
        monkeypatch.setattr(tokenstore, name, value)
    enc, plain, rng, renewed, before = Encoder(FILE), Tokenizer.from_file(FILE), random.Random(7), 0, 0
    words = ["w" + "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 5))) for _ in range(300)]
    for _ in range(400):
        text = " ".join(rng.choice(words) for _ in range(20))
        assert np.frombuffer(enc.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
        assert len(enc.pieces) <= 20
        renewed, before = renewed + (len(enc.pieces) < before), len(enc.pieces)
    assert renewed


def test_batches_end_by_bytes(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    with batches_up_to(spark, 1 << 16):
        rows = documents(spark, [(i, "x" * 10_000) for i in range(100)]).coalesce(1).select("text")
        got = [r.n for r in rows.mapInArrow(sizes, "n long").collect()]
    assert sum(got) == 100 and max(got) <= 8 and spark.conf.get(name) == before


def test_tokens_are_written_from_small_batches(spark, monkeypatch):
    seen, plain = [], tokenstore.stored
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    monkeypatch.setattr(tokenstore, "stored", lambda rows, to: seen.append((to, spark.conf.get(name))) or plain(rows, to))
    write_tokens(documents(spark, [(1, "a b")]), FILE)
    assert ("tokens", str(tokenstore.BATCH_BYTES)) in seen


def test_file_round_trip_and_access():
    rng = np.random.default_rng(1)
    for top in (200, 70_000, 1 << 31):
        docs = [rng.integers(0, top, n).astype("<u4") for n in (0, 1, 700, 5000, 3, 0, 4097)]
        file = TokenFile(packed_file([None, 5, -2, 1 << 40, 7, 7, 9], [d.tobytes() for d in docs]))
        whole = np.concatenate(docs)
        assert len(file) == len(whole) and [d for d, *_ in file.documents()] == [None, 5, -2, 1 << 40, 7, 7, 9]
        for at in rng.integers(0, len(whole), 400).tolist() + [0, len(whole) - 1]:
            assert file.token(at) == whole[at]
        for _ in range(100):
            a, b = sorted(rng.integers(0, len(whole) + 1, 2).tolist())
            assert (file.tokens(a, b) == whole[a:b]).all()


def expected(rows):
    plain = Tokenizer.from_file(FILE)
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query(spark, folder, clash, monkeypatch):
    rng = random.Random(3)
    rows = [(i * 7, " ".join(rng.choice(["alpha", "Beta!", "it's", "é1"]) for _ in range(rng.randrange(80)))) for i in range(300)]
    rows += [(5000 + i, t) for i, t in enumerate(ODD)] + [(9000, None)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    docs = clash(documents(spark, shuffled)).repartition(3)
    got = op3_token_store(spark, folder(documents=docs)).collect()
    assert sorted(tuple(r) for r in got) == expected(rows)
    monkeypatch.setattr(tokenstore, "FILE_TOKENS", 50)
    files = write_tokens(docs, FILE)
    assert sorted(tuple(r) for r in read_tokens(files).collect()) == expected(rows)


def test_repeated_and_null_ids(spark):
    rows = [(None, "b c"), (None, "b c"), (1, "x"), (1, "x"), (1, "y z"), (2, "")]
    got = sorted((tuple(r) for r in read_tokens(write_tokens(documents(spark, rows), FILE)).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 1, 1, 1, 2]
    ends = [a[1] + a[2] for a in got]
    assert [r[1] for r in got] == [0, *ends[:-1]]
    assert read_tokens(write_tokens(documents(spark, []), FILE)).count() == 0
