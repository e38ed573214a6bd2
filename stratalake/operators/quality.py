"""Data checks. Each returns violations as (rule, table_name, key, detail); none means good.

Counting comes before joining, so a key shared by a third of all rows is one row in a join.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _violations(rows: DataFrame, rule: str, table: str, key: Column, detail: Column) -> DataFrame:
    return rows.select(
        F.lit(rule).alias("rule"),
        F.lit(table).alias("table_name"),
        key.cast("string").alias("key"),
        detail.cast("string").alias("detail"),
    )


def _key(columns: list[str]) -> Column:
    return F.concat_ws(",", *[F.col(c).cast("string") for c in columns])


def unique(rows: DataFrame, table: str, key: list[str]) -> DataFrame:
    """Keys with more than one row; detail = how many."""
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return _violations(counted, "unique", table, _key(key), F.col("n"))


def relationships(
    child: DataFrame, table: str, foreign: list[str], parent: DataFrame, primary: list[str]
) -> DataFrame:
    """Foreign keys without a parent row; null keys refer to nothing. detail = child rows."""
    held = child.select(*foreign).dropna()
    counted = held.groupBy(*foreign).agg(F.count(F.lit(1)).alias("n"))
    parents = parent.select(*[F.col(p).alias(f) for p, f in zip(primary, foreign, strict=True)])
    orphans = counted.join(parents, foreign, "left_anti")
    return _violations(orphans, "relationships", table, _key(foreign), F.col("n"))


def accepted_values(rows: DataFrame, table: str, column: str, values: list) -> DataFrame:
    """Values outside the accepted set; key = value, detail = rows. Null is a violation."""
    counted = rows.groupBy(F.col(column)).agg(F.count(F.lit(1)).alias("n"))
    bad = counted.where(F.col(column).isNull() | ~F.col(column).isin(values))
    return _violations(bad, "accepted_values", table, F.coalesce(F.col(column).cast("string"), F.lit("null")), F.col("n"))


def matrix_complete(matrix: DataFrame, types: DataFrame) -> DataFrame:
    """Types whose row of the matrix does not hold each defending type exactly once."""
    n_types = types.agg(F.count(F.lit(1))).scalar()
    rows = matrix.groupBy("attacking_type_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("defending_type_id").alias("d")
    )
    per_type = types.select(F.col("type_id").alias("attacking_type_id")).join(
        rows, "attacking_type_id", "left"
    )
    n, d = F.coalesce("n", F.lit(0)), F.coalesce("d", F.lit(0))
    bad = per_type.withColumn("want", n_types).where((n != F.col("want")) | (d != F.col("want")))
    return _violations(bad, "matrix", "bridge_type_effectiveness", F.col("attacking_type_id"), n)


def bridge_cardinality(staged: DataFrame, column: str, bridge: DataFrame, table: str) -> DataFrame:
    """One row if the elements of a staged array and the bridge rows differ in number."""
    want = staged.agg(F.coalesce(F.sum(F.size(column)), F.lit(0)).cast("bigint")).scalar()
    have = bridge.agg(F.count(F.lit(1)).alias("have")).withColumn("want", want)
    bad = have.where(F.col("have") != F.col("want"))
    return _violations(bad, "bridge", table, F.lit(column), F.concat_ws("/", "have", "want"))


#: Ranges of hashes that two tables are compared by.
RANGES = 4096


def _hashed(rows: DataFrame) -> tuple[Column, Column]:
    """Two hashes of a row. Nulls count by place, what is nested by its JSON."""
    flat = [
        F.to_json(F.struct(f"`{c}`"), {"ignoreNullFields": "false"}) if "<" in kind else F.col(f"`{c}`")
        for c, kind in rows.dtypes
    ]
    nulls = [F.col(f"`{c}`").isNull() for c in rows.columns]
    return F.xxhash64(*flat, *nulls), F.xxhash64(F.lit(1), *flat, *nulls)


def _in_ranges(rows: DataFrame) -> DataFrame:
    """(row, range, a, b): each row as one column, with its range and its hashes."""
    a, b = _hashed(rows)
    hashed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), a.alias("a"), b.alias("b"))
    return hashed.withColumn("range", F.pmod("a", F.lit(RANGES)).cast("int"))


def differing_ranges(left: DataFrame, right: DataFrame) -> DataFrame:
    """(range): ranges of hashes in which two tables don't hold the same rows, at most RANGES.

    The digest of a range is the number of its rows and the sums of both hashes in halves, so
    the order of rows doesn't matter, and a task sends one row for each range. Rows that differ with an equal
    digest have a chance of about 1 in 2^128.
    """
    low, high = F.lit((1 << 32) - 1), 32
    halves = [h for c in ("a", "b") for h in (F.col(c).bitwiseAND(low), F.shiftrightunsigned(c, high))]

    def signed(rows: DataFrame, sign: int) -> DataFrame:
        return _in_ranges(rows).select("range", F.lit(sign).alias("n"), *[(h * sign).alias(f"h{i}") for i, h in enumerate(halves)])

    sums = [F.sum(c).alias(c) for c in ("n", "h0", "h1", "h2", "h3")]
    both = signed(left, 1).unionByName(signed(right, -1)).groupBy("range").agg(*sums)
    return both.where("n != 0 OR h0 != 0 OR h1 != 0 OR h2 != 0 OR h3 != 0").select("range")


def _differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows that one side has more often, with ``n`` > 0 where it is the left one.

    One aggregate over both sides: equal rows meet in each task before the shuffle.
    """
    columns = [F.col(f"`{c}`") for c in left.columns]
    sides = [rows.select(*columns, F.lit(sign).alias("_n")) for rows, sign in ((left, 1), (right, -1))]
    both = sides[0].unionByName(sides[1])
    return both.groupBy(*columns).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0).withColumnRenamed("_n", "n")


def same_rows(left: DataFrame, right: DataFrame, table: str) -> DataFrame:
    """Rows that one side has more often than the other.

    Digests of ranges are compared first; only rows of the ranges that differ are read again and shuffled.
    """
    ranges = F.broadcast(differing_ranges(left, right))  # at most RANGES numbers
    left, right = (_in_ranges(rows).join(ranges, "range", "left_semi").select("row.*") for rows in (left, right))
    side = F.when(F.col("n") > 0, "left only").otherwise(F.lit("right only"))
    return _violations(_differences(left, right), "idempotent", table, F.col(left.columns[0]), side)


def conservation(raw: DataFrame, staged: dict[str, DataFrame]) -> DataFrame:
    """Entities whose staged rows differ in number from their raw records."""
    parts = [t.select(F.lit(name).alias("entity_type")) for name, t in staged.items()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    have = rows.groupBy("entity_type").agg(F.count(F.lit(1)).alias("have"))
    want = raw.groupBy("entity_type").agg(F.count(F.lit(1)).alias("want"))
    n_have, n_want = F.coalesce("have", F.lit(0)), F.coalesce("want", F.lit(0))
    bad = have.join(want, "entity_type", "full_outer").where(n_have != n_want)
    return _violations(bad, "conservation", "staging", F.col("entity_type"), F.concat_ws("/", n_have, n_want))


def reciprocity(types: DataFrame, size: str) -> DataFrame:
    """Relations that only one of the two types lists (``to`` here, ``from`` there)."""
    to = types.select(
        F.col("name").alias("a"), F.explode(F.array_distinct(f"{size}_damage_to")).alias("b")
    )
    back = types.select(
        F.explode(F.array_distinct(f"{size}_damage_from")).alias("a"), F.col("name").alias("b")
    )
    side = F.when(F.col("n") > 0, "to only").otherwise(F.lit("from only"))
    pair = F.concat_ws(">", "a", "b")
    return _violations(_differences(to, back), "reciprocity", size, pair, side)


# Keys, references and accepted values of the star.
STAR_KEYS = {
    "dim_type": ["type_id"],
    "dim_species": ["species_id"],
    "dim_move": ["move_id"],
    "fact_root": ["root_id"],
    "bridge_root_type": ["root_id", "type_id"],
    "bridge_root_move": ["root_id", "move_id"],
    "bridge_type_effectiveness": ["attacking_type_id", "defending_type_id"],
}
STAR_REFERENCES = [
    ("dim_species", "evolves_from_species_id", "dim_species"),
    ("dim_move", "type_id", "dim_type"),
    ("fact_root", "species_id", "dim_species"),
    ("bridge_root_type", "root_id", "fact_root"),
    ("bridge_root_type", "type_id", "dim_type"),
    ("bridge_root_move", "root_id", "fact_root"),
    ("bridge_root_move", "move_id", "dim_move"),
    ("bridge_type_effectiveness", "attacking_type_id", "dim_type"),
    ("bridge_type_effectiveness", "defending_type_id", "dim_type"),
]
STAR_VALUES = [
    ("dim_move", "damage_class", ["physical", "special", "status"]),
    ("bridge_root_type", "slot", [1, 2]),
    ("bridge_type_effectiveness", "multiplier", [0.0, 0.5, 1.0, 2.0]),
]
_MATRIX = "matrix:bridge_type_effectiveness"
STAR_CHECKS = [
    *(f"unique:{n}" for n in STAR_KEYS),
    *(f"relationships:{child}:{column}" for child, column, _ in STAR_REFERENCES),
    *(f"accepted_values:{table}:{column}" for table, column, _ in STAR_VALUES),
    _MATRIX,
]


def _star_entries(star: dict[str, DataFrame]) -> DataFrame:
    """(space, key, tag) of every key, reference and checked value; each table is read once.

    A space is a table's keys or a column's values; tag 0 is a row of the table itself, tag n
    the n-th reference to it.
    """
    spaces = list(STAR_KEYS)
    entries: dict[str, list[str]] = {n: [] for n in spaces}

    def add(table: str, space: int, key: str, tag: int) -> None:
        entries[table].append(f"named_struct('space', {space}, 'key', {key}, 'tag', {tag})")

    def text(column: str) -> str:
        return f"cast({column} as string)"

    for i, (table, key) in enumerate(STAR_KEYS.items()):
        add(table, i, f"concat_ws(',', {', '.join(f"coalesce({text(c)}, 'null')" for c in key)})", 0)
    for table, column, parent in STAR_REFERENCES:
        add(table, spaces.index(parent), text(column), _tag(table, column, parent))
    for i, (table, column, values) in enumerate(STAR_VALUES, len(spaces)):
        # + 0.0 turns -0.0 into 0.0
        add(table, i, f"coalesce({text(f'{column} + 0D' if isinstance(values[0], float) else column)}, 'null')", 0)
    parts = [star[f"analytics.{n}"].selectExpr(f"inline(array({', '.join(e)}))") for n, e in entries.items()]
    return reduce(DataFrame.unionByName, parts).where("key IS NOT NULL")


def _tag(table: str, column: str, parent: str) -> int:
    return [(t, c) for t, c, p in STAR_REFERENCES if p == parent].index((table, column)) + 1


def star_violations(star: dict[str, DataFrame]) -> DataFrame:
    """(check, rule, table_name, key, detail) of all checks of the star, named ``rule:table[:column]``.

    One grouped shuffle of keys counts, per key, its rows and the references to it; every rule
    looks at these counts. What is found is grouped once more, since a type's row of the
    matrix fails on its number or on a pair told twice.
    """
    n_tags = 1 + max(_tag(*r) for r in STAR_REFERENCES)
    counts = [F.count_if(F.col("tag") == i).alias(f"n{i}") for i in range(n_tags)]
    n_types = star["analytics.dim_type"].agg(F.count(F.lit(1))).scalar()
    counted = _star_entries(star).groupBy("space", "key").agg(*counts).withColumn("want", n_types)

    def found(rule: str, table: str, column: str, bad: str, detail: str, key: str = "key", known: str = "true") -> str:
        name = ":".join(filter(None, [rule, table, column]))
        return (
            f"named_struct('check', '{name}', 'rule', '{rule}', 'table_name', '{table}', 'key', {key}, "
            f"'detail', {detail}, 'bad', {bad}, 'known', {known})"
        )

    pairs, by_space = "bridge_type_effectiveness", []
    for i, table in enumerate(STAR_KEYS):
        rules = [found("unique", table, "", "n0 > 1", "n0")]
        for child, column, parent in STAR_REFERENCES:
            if parent == table:
                n = f"n{_tag(child, column, parent)}"
                rules.append(found("relationships", child, column, f"n0 = 0 AND {n} > 0", n))
        if table == "dim_type":
            n = f"n{_tag(pairs, 'attacking_type_id', table)}"
            rules.append(found("matrix", pairs, "", f"n0 > 0 AND {n} <> want", n, known="n0 > 0"))
        if table == pairs:
            rules.append(found("matrix", pairs, "", "n0 > 1", "0L", "substring_index(key, ',', 1)", "false"))
        by_space.append((i, rules))
    for i, (table, column, values) in enumerate(STAR_VALUES, len(STAR_KEYS)):
        allowed = ", ".join(f"'{v}'" for v in values)
        by_space.append((i, [found("accepted_values", table, column, f"key NOT IN ({allowed})", "n0")]))
    keep = "x -> x.bad OR (x.rule = 'matrix' AND x.known)"
    rules = " ".join(f"WHEN {i} THEN filter(array({', '.join(r)}), {keep})" for i, r in by_space)
    hits = counted.selectExpr(f"inline(CASE space {rules} END)")
    return (
        hits.groupBy("check", "rule", "table_name", "key")
        .agg(F.max("detail").cast("string").alias("detail"), F.bool_or("bad").alias("bad"), F.bool_or("known").alias("known"))
        .where("bad AND known")
        .drop("bad", "known")
    )


def star_summary(violations: DataFrame) -> DataFrame:
    """(check, violations) of every check of the star, those without a violation included."""
    names = violations.sparkSession.sql(f"SELECT explode(array({', '.join(repr(c) for c in STAR_CHECKS)})) AS check")
    counted = violations.groupBy("check").agg(F.count(F.lit(1)).alias("n"))
    return names.join(counted, "check", "left").select("check", F.coalesce("n", F.lit(0)).alias("violations"))


def summary(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, violations) of every check, those without a violation included."""
    parts = [
        rows.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("check"), "violations"
        )
        for name, rows in checks.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
