"""The registered queries: each operator on its whole table, with the digest its contract names."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import convrepair, decontam, exactdup, langid, merkle, mixing, pagetext
from stratalake.llm import secrets, simhash, substrings, tokencount, tokenstore, toxicity
from stratalake.llm.common import stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the fixed kinds, and all spans."""
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in secrets.BASE]
    joined = "array_join(transform({}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
    base = f"filter(spans, x -> x.kind in ({', '.join(repr(k) for k in kinds)}))"
    return found.select(
        "doc_id",
        *(F.expr(f"cast(size(filter(spans, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in kinds),
        F.sha2(F.expr(joined.format(base)), 256).alias("base_sha256"),
        F.expr(joined.format("spans")).alias("spans"),
    )


@query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    return langid.languages(docs, langid.fit(docs))


@query
def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the files."""
    files = tokenstore.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return tokenstore.read_tokens(files)


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: three-word shingles, at most two bits."""
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document, and the row of it that stays."""
    return exactdup.exact_duplicates(table(spark, sf_dir, "documents"))


SQL["op5_exact_dedup"] = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
),
ranked AS (
  SELECT doc_id, norm,
    first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size, row_number() OVER w = 1 AS kept
  FROM texts WINDOW w AS (PARTITION BY norm ORDER BY n_chars DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, kept, sha256(norm) AS text_sha256 FROM ranked
"""


#: The edits of a text: a word is repeated at a quarter, a line is put in at the middle, the end goes.
_EDITS = """array(
  struct(length(text) div 4 as start, length(text) div 4 as end, split_part(text, ' ', 2) as text),
  struct(length(text) div 2 as start, length(text) div 2 + 7 as end, concat('\\n  ', left(text, 20)) as text),
  struct(length(text) - 9 as start, length(text) + 99 as end, '.' as text))"""


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document, and after three edits counted from its stored tree."""
    file = public_tokenizers.path("byte_bpe_50k.tiktoken")
    trees = stored(tokencount.count_trees(table(spark, sf_dir, "documents"), file), "count-trees")
    return tokencount.edited_counts(trees.withColumn("edits", F.expr(_EDITS)), file)


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, with the best window of each."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document in strings of 100 bytes that start earlier too, and what is left."""
    return substrings.repeated_substrings(table(spark, sf_dir, "documents"), length=100)


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document for equal shares of all sources, in their random order, read back from the mixture.

    The mixture is a stored table of whole rows, sorted by place.
    """
    docs = table(spark, sf_dir, "documents")
    mixture = stored(mixing.mixed(docs, mixing.source_rates(docs), numbered=True), "mixture")
    return mixture.select("doc_id", "source", f"`{mixture.columns[-1]}`.*").orderBy("place")


SQL["op9_mixing"] = """
WITH counts AS (SELECT source, count(*) AS n_rows FROM documents GROUP BY source),
rates AS (
  SELECT source, (SELECT sum(n_rows) FROM counts) * 1.0::DOUBLE / (SELECT count(*) FROM counts) / n_rows AS rate FROM counts
),
means AS (
  SELECT source, rate, greatest(1, ceil(rate / 32)::INT) AS parts, rate / greatest(1, ceil(rate / 32)::INT) AS mean FROM rates
),
terms AS (
  SELECT source, k, exp(-mean + k * ln(mean) - lgamma(k + 1)) AS p
  FROM (SELECT *, unnest(range(0, ceil(mean + 12 * sqrt(mean) + 30)::BIGINT + 1)) AS k FROM means)
),
cdf AS (
  SELECT source, list(c ORDER BY k) AS c
  FROM (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms) GROUP BY source
),
drawn AS (
  SELECT doc_id, d.source, text, rate, (
    SELECT sum(len(list_filter(c, lambda x: x <=
      ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, text, '') || ':' || j), 1, 13))::BIGINT / 4503599627370496.0)))
    FROM (SELECT unnest(range(1, parts + 1)) AS j)
  )::BIGINT AS n_copies
  FROM documents d JOIN means m ON d.source IS NOT DISTINCT FROM m.source JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source
)
SELECT doc_id, source, rate, n_copies, copy_no,
  ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, text, '') || ':place:' || copy_no), 1, 15))::BIGINT AS place
FROM (SELECT *, unnest(range(1, n_copies + 1)) AS copy_no FROM drawn)
"""


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, and where its toxic sentences are."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.toxicity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        "held_out",
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.expr("array_join(transform(sentences, x -> concat_ws(':', x.start, x.end)), ',')").alias("sentences"),
    )


@query
def op11_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return pagetext.page_texts(table(spark, sf_dir, "pages"))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every conversation after damage, its cheapest repair, and the digest of what that gives."""
    return convrepair.repaired(convrepair.damaged(table(spark, sf_dir, "conversations")))


#: The crc32 of a short text of ASCII characters, from the table of its polynomial.
_CRC32 = """
crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crcs
)"""


def _crc32(text: str) -> str:
    steps = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    return (
        f"if({text} IS NULL, NULL, xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), "
        "lambda c, b: xor(crcs[(xor(c, b) & 255) + 1], c >> 8)), 4294967295))"
    )


SQL["op12_conversation_repair"] = rf"""
WITH RECURSIVE {_CRC32},
keyed AS (
  SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
),
kinds AS (SELECT *, {_crc32("k")} % 20 AS kind FROM keyed, crc_table),
copies AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
    unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0
),
ordered AS (
  SELECT *, row_number() OVER w AS i, lag(role) OVER w AS before, rtrim(text, E' \t\n\x0b\x0c\r') AS trimmed
  FROM copies WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
),
faults AS (
  SELECT *, CASE WHEN trimmed = '' THEN 'blank' WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate'
    WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM ordered
),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faults GROUP BY conv_id
),
-- state: what the letters so far are: none (0), s (1), up to a user's (2), up to an assistant's (3)
letters(state, letter, next) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
put(state, n, next, lines) AS (
  VALUES (0, 0, 0, ''), (1, 0, 1, ''), (2, 0, 2, ''), (3, 0, 3, ''),
    (0, 1, 2, E'
user:'), (1, 1, 2, E'
user:'), (3, 1, 2, E'
user:'), (2, 1, 3, E'
assistant:'),
    (0, 2, 3, E'
user:
assistant:'), (1, 2, 3, E'
user:
assistant:')
),
acts AS (
  SELECT p.state, n, l.letter, l.next, lines FROM put p JOIN letters l ON l.state = p.next
),
parses AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, {{'cost': 0, 'audit': '', 'lines': ''}} AS best
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, state, min(best) FROM (
    SELECT f.conv_id, f.i, a.next AS state, {{
      'cost': best.cost + 2 * a.n + (fault = 'truncated')::INT, 'audit': best.audit || repeat('I', a.n) || 'K',
      'lines': best.lines || a.lines || E'
' || role || ':' || text}} AS best
    FROM parses p JOIN faults f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = p.i + 1
    JOIN acts a ON a.state = p.state AND a.letter = left(role, 1)
    WHERE fault NOT IN ('blank', 'duplicate')
    UNION ALL
    SELECT f.conv_id, f.i, a.next, {{
      'cost': best.cost + 2 * a.n + 2 + (fault = 'truncated')::INT, 'audit': best.audit || repeat('I', a.n) || 'R',
      'lines': best.lines || a.lines || E'
' || CASE a.letter WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text}}
    FROM parses p JOIN faults f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = p.i + 1
    JOIN acts a ON a.state = p.state AND a.letter <> 's'
    WHERE fault NOT IN ('blank', 'duplicate')
    UNION ALL
    SELECT f.conv_id, f.i, a.next, {{
      'cost': best.cost + 2 * a.n + 3, 'audit': best.audit || repeat('I', a.n) || 'D', 'lines': best.lines || a.lines}}
    FROM parses p JOIN faults f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = p.i + 1
    JOIN put a ON a.state = p.state
  ) GROUP BY conv_id, i, state
),
ended AS (
  SELECT p.conv_id, min({{'cost': best.cost + 2 * a.n, 'audit': best.audit || repeat('I', a.n), 'lines': best.lines || a.lines}}) AS best
  FROM parses p LEFT JOIN counts c ON p.conv_id IS NOT DISTINCT FROM c.conv_id
  JOIN put a ON a.state = p.state AND a.next IN (0, 3)
  WHERE p.i = coalesce(c.n, 0) GROUP BY p.conv_id
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, best.cost::BIGINT AS cost, best.audit AS audit,
  sha256(substr(best.lines, 2)) AS repaired_sha256
FROM ended e LEFT JOIN counts c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and what a tampered text makes of the root."""
    return merkle.manifest(table(spark, sf_dir, "documents")).drop("source")


def _merkle_field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


_MERKLE_HEAD = " || ".join(_merkle_field(c) for c in ("doc_id", "source", "lang", "n_chars"))


def _merkle_tree(name: str, group: str, nodes: str) -> str:
    """All levels of the trees over ``nodes`` (group, place, digest, n), and the runs of children in them."""
    return f"""
{name} AS (
  SELECT {group}, 0 AS level, place, digest, n FROM {nodes}
  UNION ALL
  SELECT {group}, level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (n + 2) // 3
  FROM {name} WHERE n > 1 GROUP BY {group}, level, place // 3, n
),
{name}_runs AS (
  SELECT {group}, level, place // 3 AS parent, list(digest ORDER BY place) AS kids
  FROM {name} WHERE n > 1 GROUP BY {group}, level, place // 3
)"""


def _merkle_fold(name: str, group: str, tree: str, start: str) -> str:
    """(id, level, place, node, proof) of each replacement, level by level up the tree."""
    kids = "list_concat(kids[:place % 3], {}, kids[place % 3 + 2:])"
    return f"""
{name} AS (
  SELECT id, {group}, 0 AS level, place, node, proof FROM {start}
  UNION ALL
  SELECT id, f.{group}, f.level + 1, place // 3, sha256(array_to_string({kids.format("[node]")}, '')),
    proof || array_to_string({kids.format("[]::VARCHAR[]")}, '')
  FROM {name} f JOIN {tree}_runs r ON f.{group} IS NOT DISTINCT FROM r.{group} AND f.level = r.level AND place // 3 = parent
)"""


SQL["op13_merkle_manifest"] = rf"""
WITH RECURSIVE {_CRC32},
leaves AS (
  SELECT doc_id, source, row_number() OVER () AS id, sha256({_MERKLE_HEAD} || {_merkle_field("text")}) AS leaf,
    sha256({_MERKLE_HEAD} || {_merkle_field("CASE WHEN " + _crc32("doc_id::VARCHAR") + " % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")})
      AS tampered
  FROM documents, crc_table
),
nodes AS (
  SELECT *, leaf AS digest, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY source) AS n
  FROM leaves
),
{_merkle_tree("tree", "source", "nodes")},
subroots AS (
  SELECT source, digest, level, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n, 0 AS every
  FROM tree WHERE n = 1
),
{_merkle_tree("over", "every", "subroots")},
starts AS (SELECT id, source, place, tampered AS node, '' AS proof FROM nodes),
{_merkle_fold("fold", "source", "tree", "starts")},
onward AS (
  SELECT id, s.every, s.place, node, proof
  FROM fold f JOIN subroots s ON f.source IS NOT DISTINCT FROM s.source AND f.level = s.level
),
{_merkle_fold("refold", "every", "over", "onward")}
SELECT doc_id, leaf, s.digest AS subroot, o.digest AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = o.digest AS verified
FROM refold r JOIN over o ON o.n = 1 AND r.level = o.level JOIN leaves l ON r.id = l.id
JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
"""
