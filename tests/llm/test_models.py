"""Held-out accuracy of the two classifiers, and their odd rows."""

import random
import zlib

import numpy as np
import pytest
from llm_rows import documents
from pyspark.sql import functions as F

from stratalake.llm import langid, letters, toxicity
from stratalake.llm.letters import ngrams
from stratalake.llm.queries import op2_language, op10_toxicity

SF = "/root/testdata/sf0.01"


def whole(text):
    """The letters of a text and their places, without blocks."""
    low, at = [], []
    for i, c in enumerate(text):
        if c.isalpha():
            if i == 0:
                low, at = [0], [-1]
            low.append(ord(c.lower()) if len(c.lower()) == 1 else ord(c))
            at.append(i)
        elif low and low[-1]:
            low.append(0)
            at.append(i)
    if low and low[-1]:
        low.append(0)
        at.append(len(text))
    return low, at


def test_letters():
    (block,) = letters.letters("Ab, ñ1É")
    assert [chr(c) if c else "_" for c in block.low] == list("_ab_ñ_é_") and block.at.tolist() == [-1, 0, 1, 2, 4, 5, 6, 7]
    assert len(ngrams(block.low, 3, 64)) == 6 and len(ngrams(block.low, 20, 64)) == 0


def odd_texts(rng):
    texts = ["", "a", ".", "ab", ".a", "a.", "Ab, ñ1É", "x" * 40, ". " * 30, "İß é\n" * 9]
    return texts + ["".join(rng.choice("abÉ .!\n1") for _ in range(rng.randrange(80))) for _ in range(200)]


@pytest.mark.parametrize("size", [1, 2, 7, 16])
def test_blocks_leave_no_seam(monkeypatch, size):
    """Letters, n-grams, sentences and scores are those of the unsplit text."""
    monkeypatch.setattr(letters, "BLOCK", size)
    rng = random.Random(size)
    for text in odd_texts(rng):
        low, at = whole(text)
        parts = list(letters.letters(text))
        assert [int(c) for b in parts for c in b.low] == low and [int(i) for b in parts for i in b.at] == at
        found = sorted(int(g) for p in langid.grams(text) for g in p)
        want = [g for n in langid.ORDERS for g in ngrams(np.array(low, np.uint32), n, langid.BUCKETS).tolist()]
        assert found == sorted(want)
        ends = [i + 1 for i, c in enumerate(text) if c in ".!?\n"]
        ends += [len(text)] if text and (not ends or ends[-1] < len(text)) else []
        pairs = []
        for n in toxicity.ORDERS:
            grams = ngrams(np.array(low, np.uint32), n, toxicity.BUCKETS).tolist()
            pairs += [(min(sum(e <= at[i + 1] for e in ends), len(ends) - 1), g) for i, g in enumerate(grams)]
        got = list(toxicity.sentence_grams(text))
        assert [int(e) for part in got for e in part[0]] == ends
        assert sorted((int(s), int(g)) for _, s, b in got for s, g in zip(s, b, strict=True)) == sorted(pairs)


def test_a_long_text_is_one_text():
    text = "the river and stone garden window " * 6000  # 200,000 characters, one sentence
    got = list(toxicity.sentence_grams(text))
    assert sum(len(e) for e, _, _ in got) == 1
    low, _ = whole(text)
    assert sum(len(b) for _, _, b in got) == sum(len(low) - n + 1 for n in toxicity.ORDERS)


def test_scores_against_plain_sums():
    """Batches of texts score as each text does, n-gram by n-gram; documents as the noisy-or of their sentences."""
    rng, random_ = random.Random(2), np.random.default_rng(2)
    langs = langid.Model(["a", "b", "c"], random_.normal(size=(langid.BUCKETS, 3)).astype(np.float32), np.log([0.5, 0.3, 0.2]))
    texts = odd_texts(rng) + ["lorem ipsum dolor " * 30_000]
    for text, (lang, p) in zip(texts, langid.predict(iter(texts), langs), strict=True):
        low, _ = whole(text)
        grams = [g for n in langid.ORDERS for g in ngrams(np.array(low, np.uint32), n, langid.BUCKETS).tolist()]
        if not grams:
            assert (lang, p) == ("und", 0.0)
            continue
        sums = langs.columns[grams].astype(float).sum(0) + langs.prior
        e = np.exp((sums - sums.max()) / max(1.0, len(grams) / 50))
        assert lang == langs.langs[int(sums.argmax())] and p == pytest.approx(e.max() / e.sum(), rel=1e-6)
    weights = np.where(random_.random(toxicity.BUCKETS) < 0.3, random_.normal(size=toxicity.BUCKETS), 0).astype(np.float32)
    model = toxicity.Model(weights, -2.0)
    for text in texts[:120]:
        z = {}
        for _, sentence, found in toxicity.sentence_grams(text):
            for s, g in zip(sentence.tolist(), found.tolist(), strict=True):
                if weights[g]:
                    z[s] = z.get(s, -2.0) + float(weights[g])
        want = 1 - np.prod([1 - 1 / (1 + np.exp(-x)) for x in z.values()])
        assert toxicity.score(toxicity.sentence_scores(text, model)) == pytest.approx(want, abs=1e-6)


def test_language_accuracy(spark):
    got = op2_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    n, right, held = got.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.sum(F.col("held_out").cast("int"))).first()
    assert n == 1000 and right >= 990 and held > 200
    wrong = [r for r in got.collect() if r.held_out != (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)]
    assert not wrong and all(0 <= r.score <= 1 for r in got.collect())


def test_language_never_learns_from_held_out(spark):
    rows = [(i, "the cat and the dog" if i % 2 else "der hund und die katze", "en" if i % 2 else "de", None) for i in range(200)]
    spoiled = [(i, "zzz" if zlib.crc32(str(i).encode()) % 4 == 2 else t, la, s) for i, t, la, s in rows]
    a, b = (langid.fit(documents(spark, r)) for r in (rows, spoiled))
    assert a.langs == b.langs == ["de", "en"] and (a.columns == b.columns).all()


def test_language_odd_rows(spark, folder, clash):
    rows = [(i, "the cat and the dog", "en", None) for i in range(20)] + [(100, None, "en", None), (101, "12 .", None, None), (None, "the dog", None, None), (101, "", None, None)]
    rows.append((102, "the dog and the cat " * 60_000, None, None))
    got = op2_language(spark, folder(documents=clash(documents(spark, rows)))).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.lang_pred) for r in got if r.doc_id is None or r.doc_id > 99} == {(100, "und"), (101, "und"), (None, "en"), (102, "en")}
    assert op2_language(spark, folder(documents=documents(spark, []))).count() == 0


def test_toxicity_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = op10_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    hit = sum(r.predicted and r.toxic for r in got)
    assert len(got) > 900
    # Some documents with label 1 here have lost their toxic words to other damage.
    assert hit >= 0.82 * sum(r.toxic for r in got) and hit >= 0.9 * sum(r.predicted for r in got)


def test_toxicity_odd_rows(spark, folder, clash):
    rng = random.Random(1)
    words = ["lamp", "river", "stone", "garden", "window"]
    text = lambda bad: " ".join(rng.choice(words) for _ in range(30)) + (". You awfulness here! " if bad else ". ") + " ".join(rng.choice(words) for _ in range(30))
    rows = [(i, text(i % 5 == 0)) for i in range(400)]
    odd = [(1000, None), (1001, ""), (None, text(True)), (1002, text(False) * 3000 + text(True)), (1002, text(False)), (1003, "...")]
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(400)] + [(5, 1, 0), (None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    docs = clash(documents(spark, rows + odd))
    got = op10_toxicity(spark, folder(documents=docs, labels=labels)).collect()
    assert len(got) == 406
    assert all(r.predicted == int(r.doc_id % 5 == 0) for r in got if r.doc_id is not None and r.doc_id < 1000)
    by = {(r.doc_id, r.predicted): r for r in got if r.doc_id is None or r.doc_id >= 1000}
    assert {k for k in by} == {(1000, 0), (1001, 0), (None, 1), (1002, 1), (1002, 0), (1003, 0)} and by[(1000, 0)].score == 0
    start, end = map(int, by[(None, 1)].sentences.split(":"))
    assert "awfulness" in odd[2][1][start:end] and end - start < 30
    model = toxicity.fit(docs, labels)
    assert toxicity.without_toxic(docs, model).columns == docs.columns
    assert toxicity.without_toxic(docs, model).count() == sum(1 - r.predicted for r in got)


@pytest.mark.parametrize("kept", [0, 1, 2])
def test_toxicity_empty(spark, folder, kept):
    labels = spark.createDataFrame([(1, 1, 1), (3, 1, 1)][:kept], "doc_id long, quality int, toxic int")
    docs = documents(spark, [(1, "a b c"), (3, None)] if kept else [])
    got = op10_toxicity(spark, folder(documents=docs, labels=labels)).collect()
    assert [r.score for r in got] == [0.0] * len(docs.collect())
