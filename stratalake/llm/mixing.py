"""Mixing sources to target weights: each document is repeated by a hash-seeded Poisson count."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import free_name, sized, stored

#: A Poisson count of a greater mean is the sum of counts of at most this mean.
MAX_MEAN = 32.0
SEED = "mix-1"
#: Copies that one row is exploded into; a document with more goes to several tasks, that many copies each.
PIECE = 4096


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, rest: float = 1.0, epochs: float = 1.0) -> DataFrame:
    """(source, n_rows, rate): the mean number of repetitions that gives each source its share.

    ``weights`` by source, ``rest`` for any other one and for null; shares are weights over
    their sum. The expected number of rows out is ``epochs`` times the rows in.
    """
    if any(w < 0 for w in [*(weights or {}).values(), rest, epochs]):
        raise ValueError("weights are 0 or more")
    weight = F.lit(float(rest))
    for name, w in (weights or {}).items():
        weight = F.when(F.col("source") == name, F.lit(float(w))).otherwise(weight)
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("weight", weight)
    sums = counts.agg(F.sum("n_rows").alias("n"), F.sum("weight").alias("w"))
    rate = F.when(F.col("w") > 0, F.lit(float(epochs)) * F.col("n") * F.col("weight") / F.col("w") / F.col("n_rows"))
    total = sums.select(F.struct("n", "w")).scalar()
    return counts.withColumns({"n": total["n"], "w": total["w"]}).select(
        "source", "n_rows", F.coalesce(rate, F.lit(0.0)).alias("rate")
    )


def _uniform(key: str, part: str) -> str:
    """52 bits of a hash as a number from 0 to below 1."""
    return f"cast(conv(substring(md5(concat_ws(':', {key}, {part})), 1, 13), 16, 10) as bigint) / 4503599627370496.0D"


def with_cdf(rates: DataFrame) -> DataFrame:
    """Rates with ``parts``, the number of counts to add, ``cdf`` of one of them, and ``most``, the greatest sum."""
    mean = f"(rate / greatest(1, cast(ceil(rate / {MAX_MEAN}D) as int)))"
    last = f"cast(ceil({mean} + 12 * sqrt({mean}) + 30) as int)"
    cdf = f"""aggregate(sequence(1, {last}),
        named_struct('p', exp(-{mean}), 'c', array(exp(-{mean}))),
        (a, k) -> named_struct('p', a.p * {mean} / k, 'c', concat(a.c, array(element_at(a.c, -1) + a.p * {mean} / k))),
        a -> a.c)"""
    made = rates.withColumns({"parts": F.expr(f"greatest(1, cast(ceil(rate / {MAX_MEAN}D) as int))"), "cdf": F.expr(cdf)})
    return made.withColumn("most", F.expr("cast(parts as bigint) * size(cdf)"))


def poisson_mix(docs: DataFrame, rates: DataFrame, seed: str = SEED, piece: int = PIECE) -> DataFrame:
    """Every row of docs with its copies; further columns source_rate, n_copies, copy_no, place in ``mix``.

    ``mix`` is one struct column under a name that docs doesn't have (its last column). A row
    whose count is 0 is gone. The count depends on the seed and doc_id alone (a null doc_id
    draws by its text), so repeated rows draw alike. ``place`` orders the output at random.
    A row of more than ``piece`` copies is exploded into pieces first, which are dealt out over all
    tasks; rates tell whether there can be one.
    Native: hash, inversion and explode are expressions; the rates are broadcast only if few.
    """
    key = f"'{seed}', coalesce(cast(doc_id as string), text, '')"
    rated = stored(with_cdf(rates.withColumnRenamed("source", "mix_source")), "rates")
    mix = free_name(docs, "mix")
    # one hash a count, then its place among the sums
    drawn = f"transform(sequence(1, parts), j -> {_uniform(key, 'j')})"
    count = F.expr(f"aggregate({drawn}, 0L, (n, u) -> n + size(filter(cdf, c -> c <= u)))")
    place = f"cast(conv(substring(md5(concat_ws(':', {key}, 'place', copy)), 1, 15), 16, 10) as bigint)"
    d = docs.alias("d")
    joined = d.join(sized(rated).alias("r"), F.col("d.source").eqNullSafe(F.col("r.mix_source")))
    shown = [F.col(f"`{c}`") for c in docs.columns]
    n, rate, first = (free_name(docs, f"mix_{name}") for name in ("n", "rate", "first"))
    # The key names columns of docs, so the draw is made before anything else is in scope.
    drawn = joined.select(*(F.col(f"d.`{c}`") for c in docs.columns), count.alias(n), F.col("r.rate").alias(rate))

    def copies(rows: DataFrame, start: str, end: str) -> DataFrame:
        made = (
            f"transform(sequence({start}, {end}), copy -> named_struct('rate', `{rate}`, 'n_copies', `{n}`, "
            f"'copy_no', copy, 'place', {place}))"
        )
        return rows.select(*shown, F.explode(F.expr(made)).alias(mix))

    some = copies(drawn.where(f"`{n}` BETWEEN 1 AND {piece}"), "1L", f"`{n}`")
    if not (rated.agg(F.max("most")).first()[0] or 0) > piece:
        return some
    many = drawn.where(f"`{n}` > {piece}").withColumn(first, F.explode(F.expr(f"sequence(1L, `{n}`, {piece}L)")))
    # by number: adaptive execution would put these few bytes into one task again
    dealt = many.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col("doc_id"), F.col(first))
    return some.unionByName(copies(dealt, f"`{first}`", f"least(`{first}` + {piece - 1}, `{n}`)"))


def mixed(docs: DataFrame, rates: DataFrame, seed: str = SEED, numbered: bool = False) -> DataFrame:
    """The copies in random order over all partitions, with the columns of docs.

    ``numbered`` keeps the struct column of ``poisson_mix`` as the last one.
    """
    out = poisson_mix(docs, rates, seed)
    mix = out.columns[-1]
    rows = out.orderBy(F.col(f"`{mix}`.place"))
    return rows if numbered else rows.drop(mix)
