"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import held_out, map_texts, sample_of
from stratalake.llm.letters import text_ngrams

ORDERS = (2, 3)
BUCKETS = 1 << 16
#: Documents the model is fitted on at most, those of the smallest hash of doc_id.
SAMPLE = 20_000
#: Languages the matrix of BUCKETS float32 columns may hold; more is an error.
MAX_LANGS = 256
#: Entries of the weights that one product gathers, about.
PRODUCT = 1 << 20
UNKNOWN = "und"


class Model(NamedTuple):
    langs: list[str]
    columns: np.ndarray  # float32 [bucket, language]: log probability of a bucket
    prior: np.ndarray


def grams(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams of the lower-cased letters, a part of the text at a time.

    What isn't a letter is one separator: digits, punctuation and line ends tell nothing here.
    """
    for _, found, _ in text_ngrams(text, ORDERS, BUCKETS):
        yield from (part for part in found if len(part))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Counts of buckets by language over a bounded sample, summed by Spark, as log probabilities.

    Learns from ``text`` and non-null ``lang`` of documents that aren't held out.
    """
    rows = sample_of(docs.where(F.col("lang").isNotNull() & ~held_out()).select("doc_id", "text", "lang"), sample)
    per_lang = rows.groupBy("lang").count().orderBy("lang").limit(MAX_LANGS + 1).collect()
    if len(per_lang) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    langs = [r.lang for r in per_lang]

    def counted(columns, texts) -> dict:
        by_lang: dict[str, np.ndarray] = {}
        for lang, text in zip(columns[0].to_pylist(), texts):
            sums = by_lang.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for part in grams(text):
                sums += np.bincount(part, minlength=BUCKETS)
        found = [(lang, np.flatnonzero(s), s) for lang, s in by_lang.items()]
        return {
            "lang": [lang for lang, at, _ in found for _ in at],
            "bucket": np.concatenate([at for _, at, _ in found]).astype(np.int32) if found else [],
            "n": np.concatenate([s[at] for _, at, s in found]) if found else [],
        }

    sums = map_texts(rows, counted, "lang string, bucket int, n long", ("lang", "text"))
    table = sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()  # at most languages x buckets rows
    counts = np.zeros((len(langs), BUCKETS), np.float64)
    place = {lang: i for i, lang in enumerate(langs)}
    at = np.array([place[x] for x in table["lang"].to_pylist()], np.int64)
    counts[at, table["bucket"].to_numpy()] = table["n"].to_numpy()
    smooth = counts + 0.5
    columns = np.ascontiguousarray(np.log(smooth / smooth.sum(1, keepdims=True)).astype(np.float32).T)
    prior = np.log(np.array([r["count"] for r in per_lang], float) / max(1, sum(r["count"] for r in per_lang)))
    return Model(langs, columns, prior)


def predict(texts: Iterable[str], model: Model) -> list[tuple[str, float]]:
    """The likeliest language of each text and its probability, spread over n-grams (a mean, not a product).

    Texts are scored together as a sparse matrix: a row's n-grams are the entries from its pointer on, and
    the rows of the weights that they name are summed up to the next pointer. A long text takes several products.
    """
    n_langs = len(model.langs)
    totals: list[np.ndarray] = []
    counts: list[int] = []
    entries: list[np.ndarray] = []
    rows: list[int] = []
    held = 0

    def score() -> None:
        nonlocal held
        if entries:
            pointers = np.cumsum([0] + [len(e) for e in entries[:-1]])
            sums = np.add.reduceat(model.columns[np.concatenate(entries)], pointers, axis=0, dtype=np.float64)
            for row, total in zip(rows, sums, strict=True):
                totals[row] += total
        entries.clear()
        rows.clear()
        held = 0

    for row, text in enumerate(texts):
        totals.append(np.zeros(n_langs))
        counts.append(0)
        for part in grams(text):
            counts[row] += len(part)
            entries.append(part)
            rows.append(row)
            held += len(part) * max(n_langs, 1)
            if held >= PRODUCT:
                score()
    score()
    return [_best(total, n, model) for total, n in zip(totals, counts, strict=True)]


def _best(total: np.ndarray, n: int, model: Model) -> tuple[str, float]:
    if not n or not model.langs:
        return UNKNOWN, 0.0
    scores = total + model.prior
    best = int(np.argmax(scores))
    p = np.exp(np.clip((scores - scores[best]) / max(1.0, n / 50.0), -700, 0))
    return model.langs[best], float(1.0 / p.sum())


def languages(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row.

    ``und`` with score 0 if the text is null or has no letter, or if no language was learned.
    """
    cast = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(columns, texts) -> dict:
        known = cast.value
        found = predict(texts, known)
        return {"doc_id": columns[0], "held_out": columns[1], "lang_pred": [x for x, _ in found], "score": [s for _, s in found]}

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return map_texts(rows, predicted, "doc_id long, held_out boolean, lang_pred string, score double", ("doc_id", "held_out", "text"))
