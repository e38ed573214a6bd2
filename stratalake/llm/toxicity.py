"""Toxicity by multiple-instance learning: labels of documents train scores of sentences."""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import held_out, map_texts, sample_of
from stratalake.llm.letters import text_ngrams

#: Lengths of the n-grams; a separator counts, so word starts and ends are told apart.
ORDERS = (5, 7)
BUCKETS = 1 << 18
#: Labelled documents the model is fitted on at most, those of the smallest hash of doc_id.
SAMPLE = 12_000
#: N-grams with a weight, those that tell toxic documents best.
FEATURES = 4096
#: A document, and a sentence, counts as toxic from this score on.
THRESHOLD = 0.3
#: Least lower bound of the log odds ratio of an n-gram that gets a weight.
SURE = 0.5
_ENDS = np.array([ord(c) for c in ".!?\n"], np.uint32)
_STEPS = 600


class Model(NamedTuple):
    weights: np.ndarray  # float32 by bucket, 0 for one that isn't used
    bias: float


def sentence_grams(text: str):
    """(ends of sentences, sentence and bucket of every n-gram) of a text, a part of it at a time.

    A sentence ends after ``.``, ``!``, ``?`` or a line feed, and with the text; sentences are numbered through.
    """
    done = 0
    held = np.zeros(0, np.int64)  # sentences of the letters that the next part goes on from
    for block, found, at in text_ngrams(text, ORDERS, BUCKETS):
        ends = block.offset + np.flatnonzero(np.isin(block.codes, _ENDS)) + 1
        last = block.offset + len(block.codes) == len(text)
        if last and (not len(ends) or ends[-1] < len(text)):
            ends = np.append(ends, len(text))
        new = at[len(at) - len(block.at) :]
        # a separator after the end of the text is of its last sentence
        own = done + np.searchsorted(ends, new, "right").clip(max=len(ends) - 1 if last else None)
        of = np.concatenate([held, own])
        # An n-gram is of the sentence of its second character: the first may be a separator.
        sentence = [of[len(of) - len(p) - n + 2 : len(of) - n + 2] for p, n in zip(found, ORDERS, strict=True)]
        yield ends, np.concatenate(sentence), np.concatenate(found)
        done += len(ends)
        keep = min(max(ORDERS) - 1, len(of))
        held = of[len(of) - keep :]


def sentence_scores(text: str, model: Model) -> list[tuple[int, int, float]]:
    """(start, end, score) of the sentences that have a weighted n-gram; the others count as not toxic."""
    borders, own, weights = [np.zeros(1, np.int64)], [], []
    for ends, sentence, found in sentence_grams(text):
        borders.append(ends)
        used = model.weights[found] != 0
        if used.any():
            own.append(sentence[used])
            weights.append(model.weights[found[used]])
    if not own:
        return []
    ends = np.concatenate(borders)
    known, place = np.unique(np.concatenate(own), return_inverse=True)
    z = model.bias + np.bincount(place, np.concatenate(weights), len(known))
    return [(int(ends[i]), int(ends[i + 1]), float(p)) for i, p in zip(known, _sigmoid(z), strict=True)]


def score(found: list[tuple[int, int, float]]) -> float:
    """Noisy-or: the probability that one sentence at least is toxic."""
    return float(1 - np.prod([1 - p for _, _, p in found])) if found else 0.0


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the text and ``toxic`` of labelled documents that aren't held out.

    Spark counts in how many documents of each label an n-gram occurs; the FEATURES most
    telling ones are then read again, by sentence, and weighted by gradient steps on the
    likelihood of the noisy-or. Both sets are bounded by parameters. A document with several
    labels counts as toxic if one says so. Without both labels every score is 0.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = sample_of(known, sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text")

    def seen(columns, texts) -> dict:
        n = np.zeros((2, BUCKETS), np.int64)
        for y, text in zip(columns[0].to_pylist(), texts):
            for b in {int(b) for _, _, found in sentence_grams(text) for b in np.unique(found)}:
                n[y, b] += 1
        y, b = np.nonzero(n)
        return {"toxic": y, "bucket": b, "n": n[y, b]}

    counts = map_texts(rows, seen, "toxic int, bucket int, n long", ("toxic", "text")).groupBy("toxic", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toArrow()  # at most two rows a bucket
    df = np.zeros((2, BUCKETS))
    df[found["toxic"].to_numpy(), found["bucket"].to_numpy()] = found["n"].to_numpy()
    total = {r.toxic: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    if set(total) != {0, 1}:
        return Model(np.zeros(BUCKETS, np.float32), -40.0)
    # The lower end of a confidence interval of each n-gram's log odds ratio ranks them.
    odds = np.log((df[1] + 0.5) / (total[1] + 1)) - np.log((df[0] + 0.5) / (total[0] + 1))
    sure = odds - 2 * np.sqrt(1 / (df[1] + 0.5) + 1 / (df[0] + 0.5))
    best = np.argsort(-sure, kind="stable")[:FEATURES]
    best = best[sure[best] > SURE]
    slot = np.full(BUCKETS, -1, np.int64)
    slot[best] = np.arange(len(best))

    def read(columns, texts) -> dict:
        out = {"toxic": [], "sentence": [], "slot": []}
        for y, text in zip(columns[0].to_pylist(), texts):
            own, slots = [], []
            for _, sentence, found in sentence_grams(text):
                used = slot[found] >= 0
                own += sentence[used].tolist()
                slots += slot[found[used]].tolist()
            out["toxic"].append(y)
            out["sentence"].append(own)
            out["slot"].append(slots)
        return out

    bags = map_texts(rows, read, "toxic int, sentence array<int>, slot array<int>", ("toxic", "text")).toArrow()
    learned, bias = _learn(bags, odds[best])
    weights = np.zeros(BUCKETS, np.float32)
    weights[best] = learned
    return Model(weights, bias)


def _learn(bags, start: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias by adaptive gradient steps; ``bags``: label and sentences of each document.

    As in a score, a sentence without a weighted n-gram counts as not toxic.
    """
    y = bags["toxic"].to_numpy().astype(float)
    docs, sentences, slots, n = [], [], [], 0
    for i, (own, used) in enumerate(zip(bags["sentence"].to_pylist(), bags["slot"].to_pylist())):
        if own:
            distinct, place = np.unique(own, return_inverse=True)
            sentences.append(place + n)
            docs.append(np.full(len(distinct), i))
            slots.append(used)
            n += len(distinct)
    if not n:
        return np.zeros(len(start)), -40.0
    doc, sent, slot = np.concatenate(docs), np.concatenate(sentences), np.concatenate(slots)
    w, b = np.clip(start, 0, 4) * 0.25, -4.0
    grown, grown_b = np.full(len(w), 1e-6), 1e-6
    for _ in range(_STEPS):
        z = b + np.bincount(sent, w[slot], n)
        p = _sigmoid(z)
        log_q = np.bincount(doc, np.log1p(-p.clip(max=1 - 1e-12)), len(y))
        q = np.exp(log_q).clip(1e-9, 1 - 1e-9)
        pull = np.where(y == 1, -q / (1 - q), 1.0)  # of the loss, for each unit of p in a document
        each = pull[doc] * p
        gw = np.bincount(slot, each[sent], len(w)) / len(y) + 1e-5 * w
        gb = each.sum() / len(y)
        grown += gw * gw
        grown_b += gb * gb
        w -= 0.3 * gw / np.sqrt(grown)
        b -= 0.3 * gb / np.sqrt(grown_b)
    return w, float(b)


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, sentences) of every row.

    ``sentences``: (start, end, score) in code points of those from THRESHOLD on. A null or
    empty text scores 0. Sentences without a weighted n-gram count as not toxic.
    """
    cast = docs.sparkSession.sparkContext.broadcast(model)

    def scored(columns, texts) -> dict:
        found = [sentence_scores(t, cast.value) for t in texts]
        names = ("start", "end", "score")
        return {
            "doc_id": columns[0],
            "held_out": columns[1],
            "score": [score(f) for f in found],
            "sentences": [[dict(zip(names, s)) for s in f if s[2] >= THRESHOLD] for f in found],
        }

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    schema = "doc_id long, held_out boolean, score double, sentences array<struct<start:long,end:long,score:double>>"
    return map_texts(rows, scored, schema, ("doc_id", "held_out", "text"))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, all columns, whose score is below THRESHOLD. Nothing is shuffled."""
    cast = docs.sparkSession.sparkContext.broadcast(model)

    # one text at a time: as pandas a batch would be held twice
    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        return pa.array([score(sentence_scores(t.as_py() or "", cast.value)) for t in texts], pa.float64())

    return docs.where(scores(F.col("text")) < THRESHOLD)
