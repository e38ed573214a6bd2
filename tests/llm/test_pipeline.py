import random
from collections import Counter

import numpy as np
import public_tokenizers
from llm_rows import documents
from test_decontam import brute
from test_simhash import plain_fingerprint, roots
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from stratalake.llm import toxicity
from stratalake.llm.common import stored


def corpus(rng):
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    text = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, text(rng.randrange(20, 90)) + (". Awful nasty words. " if i % 9 == 0 else ".")) for i in range(240)]
    items = [(i, text(30)) for i in range(4)]
    rows += [(300 + i, text(20) + " " + items[i % 4][1] + " " + text(10)) for i in range(12)]
    rows += [(400 + i, rows[i + 1][1]) for i in range(30)] + [(None, rows[4][1]), (None, text(30)), (2, rows[2][1]), (500, None), (501, ""), (502, " ")]
    rows = [(d, t, None, ["hot", "hot", "b", None][k % 4]) for k, (d, t) in enumerate(rows)]
    labels = [(i, 1, int(i % 9 == 0)) for i in range(200)]
    return rows, items, labels


def test_stages_against_plain(spark, folder, clash):
    rows, items, labels = corpus(random.Random(6))
    path = folder(
        documents=clash(documents(spark, rows)),
        benchmark=spark.createDataFrame(items, "item_id long, text string"),
        labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, outs = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, path), name)
        outs.append(docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    pairs = [[(r.doc_id, r.text) for r in out] for out in outs[:4]]
    rough = Counter((d, t) for d, t, *_ in rows)
    assert Counter(pairs[0]) == Counter({k: n for k, n in rough.items() if "Awful" not in (k[1] or "")})
    fps = [plain_fingerprint(t or "") for _, t in pairs[0]]
    linked = roots(range(len(fps)), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    groups = {}
    for i, r in linked.items():
        groups.setdefault(r, []).append(pairs[0][i])
    assert len(pairs[1]) == len(groups) < len(pairs[0])
    for g in groups.values():
        ids = [d for d, _ in g if d is not None]
        assert Counter(pairs[1]) & Counter([min((x for x in g if x[0] == min(ids)), key=str)] if ids else g[:1])
    dirty = {d for d, _ in brute(pairs[1], items)}
    assert len(dirty) == 12 and Counter(pairs[2]) == Counter(p for p in pairs[1] if p[0] not in dirty)
    assert set(pairs[3]) <= set(pairs[2]) and 0.5 < len(pairs[3]) / len(pairs[2]) < 1.7
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = Counter((d, len(plain.encode(t or "", add_special_tokens=False).ids) + 1) for d, t in pairs[3])
    assert Counter((r.doc_id, r.n_tokens) for r in outs[4]) == lengths
    starts = np.array(sorted((r.start, r.n_tokens) for r in outs[4]))
    assert (starts[:, 0] == np.concatenate([[0], np.cumsum(starts[:, 1])[:-1]])).all()


def test_run_and_entry(spark):
    assert entry.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert 50 < out.count() < 400 and out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_empty_tables(spark, folder):
    path = folder(
        documents=documents(spark, []),
        benchmark=spark.createDataFrame([], "item_id long, text string"),
        labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"),
    )
    assert corpus_pipeline.run(spark, path).count() == 0
    assert toxicity.THRESHOLD == 0.3


def test_tokens_keep_the_order_of_the_mixture(spark, folder):
    rows = [(i, f"text {i}", None, "rare" if i % 50 == 0 else "rest") for i in range(400)]
    path = folder(documents=documents(spark, rows))
    mixture = stored(corpus_pipeline.mix(spark, spark.read.parquet(f"{path}/documents.parquet"), path).repartition(3), "mixture")
    files = sorted(mixture.inputFiles())
    assert len(files) > 1
    want = [r.doc_id for f in files for r in spark.read.parquet(f).collect()]
    got = sorted(corpus_pipeline.token_ids(spark, mixture, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == want != sorted(want)
