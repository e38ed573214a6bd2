"""Entity projections: nested payload -> typed staging row, with a strict gate.

Payload leaves are parsed as VARIANT. A plain ``from_json`` into ``string`` takes the
number 5 as "5" and cannot tell a missing key from a null; a VARIANT leaf keeps both
apart, in the same single parse that skips every key the projection does not read.

Casting a VARIANT leaf costs more than parsing it, so a load parses payloads into plain types first, and only those
that this doesn't show to be sound (see :func:`checked_plain_first`) again with VARIANT leaves, which decide.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stratalake.functions.nested import (
    collapse_spaces,
    distinct_sorted,
    first_match,
    last_match,
    nested_names,
    slot_order,
)
from stratalake.functions.refs import try_ref_id
from stratalake.plans.tables import TABLES

MISSING, NULL, WRONG_TYPE, MALFORMED = "missing", "null", "wrong type", "malformed"
_CORRUPT = "_malformed"


@dataclass(frozen=True)
class FieldRule:
    """One staging column: its value, and what is wrong with its source (null if nothing).

    ``plain`` is the value in the plain parse ``t``. It is that of the column, and nothing is wrong, if ``sure`` is true
    and ``texts``, or all of their elements, were texts in the payload.
    """

    name: str
    value: str
    problem: str
    plain: str
    sure: str
    texts: tuple[str, ...] = ()


@dataclass(frozen=True)
class EntitySpec:
    """One entity: payload keys that are read, the columns made of them, the table.

    ``payload`` has {int}, {bool} and {text} for leaves that must be there and of that type.
    ``cells`` is a struct of what several columns search the parsed payload for: made once a
    payload, its fields are the leaves that those columns read.
    """

    entity: str
    table: str
    payload: str
    fields: tuple[FieldRule, ...]
    cells: str = ""

    @property
    def schema(self) -> T.StructType:
        return TABLES[self.table].schema

    @property
    def leaves(self) -> str:
        """What is read, as VARIANT leaves."""
        return self.payload.format(int="variant", bool="variant", text="variant")

    @property
    def plain(self) -> str:
        """What is read, as plain types."""
        return self.payload.format(int="bigint", bool="boolean", text="string")


# --- reading VARIANT leaves; ``d`` is the parsed payload, ``c`` its cells, ``t`` the plain parse ---

_KIND = {"bigint": "BIGINT", "string": "STRING", "boolean": "BOOLEAN"}


def _read(leaf: str, dtype: str = "string") -> str:
    return f"TRY_CAST({leaf} AS {dtype})"


def _is(leaf: str, dtype: str = "string") -> str:
    return f"coalesce(schema_of_variant({leaf}) = '{_KIND[dtype]}', false)"


def _leaf_problem(leaf: str, dtype: str = "string", nullable: bool = False) -> str:
    null = "NULL" if nullable else f"'{NULL}'"
    return (
        f"CASE WHEN {leaf} IS NULL THEN '{MISSING}' WHEN is_variant_null({leaf}) THEN {null} "
        f"WHEN NOT {_is(leaf, dtype)} THEN '{WRONG_TYPE}' END"
    )


def _each_problem(items: str, ok: str) -> str:
    return (
        f"CASE WHEN {items} IS NULL THEN '{MISSING}' "
        f"WHEN NOT forall({items}, e -> {ok}) THEN '{WRONG_TYPE}' END"
    )


def _all_there(items: str, other: str) -> str:
    """Whether an array is there and all of its elements are: compiled code, unlike a lambda. Not sure if it has ``other``."""
    return f"array_contains({items}, {other}) = false"


# --- kinds of column ------------------------------------------------------------------


def scalar(name: str, dtype: str, path: str | None = None, nullable: bool = False) -> FieldRule:
    """A typed value copied as it is; null stays null."""
    leaf, plain = (f"{doc}.{path or name}" for doc in "dt")
    value, problem = _read(leaf, dtype), _leaf_problem(leaf, dtype, nullable)
    if nullable:  # a VARIANT in the plain parse too, as a plain null may be a missing key
        return FieldRule(name, value, problem, _read(plain, dtype), f"{_leaf_problem(plain, dtype, nullable)} IS NULL")
    return FieldRule(name, value, problem, plain, f"{plain} IS NOT NULL", (plain,) if dtype == "string" else ())


def reference(name: str, path: str) -> FieldRule:
    """Number at the end of a required url."""
    leaf = f"d.{path}"
    value = try_ref_id(_read(leaf))
    no_number = f"CASE WHEN {value} IS NULL THEN '{WRONG_TYPE}' END"
    url = f"t.{path}"
    plain = try_ref_id(url)
    return FieldRule(name, value, f"coalesce({_leaf_problem(leaf)}, {no_number})", plain, f"{plain} IS NOT NULL", (url,))


def _optional(path: str, leaf: str, doc: str) -> tuple[str, str]:
    """Text below a parent that may be null or empty, and what is wrong with the pair."""
    parent = f"{doc}.{path}"
    child = f"try_variant_get({parent}, '$.{leaf}', 'variant')"
    absent = f"(is_variant_null({parent}) OR schema_of_variant({parent}) = 'OBJECT<>')"
    problem = (
        f"CASE WHEN {parent} IS NULL THEN '{MISSING}' WHEN {absent} THEN NULL "
        f"WHEN NOT startswith(schema_of_variant({parent}), 'OBJECT') THEN '{WRONG_TYPE}' "
        f"ELSE {_leaf_problem(child)} END"
    )
    return f"CASE WHEN NOT {absent} THEN {_read(child)} END", problem


def optional_text(name: str, path: str, leaf: str) -> FieldRule:
    """Text below an optional parent; no parent gives null."""
    plain, problem = _optional(path, leaf, "t")
    return FieldRule(name, *_optional(path, leaf, "d"), plain, f"{problem} IS NULL")


def optional_reference(name: str, path: str) -> FieldRule:
    """Number at the end of the url of an optional parent; no parent gives null."""

    def made(doc: str) -> tuple[str, str]:
        url, problem = _optional(path, "url", doc)
        value = try_ref_id(url)
        no_number = f"CASE WHEN ({url}) IS NOT NULL AND {value} IS NULL THEN '{WRONG_TYPE}' END"
        return value, f"coalesce({problem}, {no_number})"

    plain, problem = made("t")
    return FieldRule(name, *made("d"), plain, f"{problem} IS NULL")


def names(name: str, path: str, leaf: str = "e.name", distinct: bool = False) -> FieldRule:
    """Names of an array of references: in source order, or distinct and sorted."""
    pick = distinct_sorted if distinct else nested_names
    plain = f"t.{path}{leaf[1:]}"
    made = f"sort_array(array_distinct({plain}))" if distinct else plain
    value, problem = pick(f"d.{path}", _read(leaf)), _each_problem(f"d.{path}", _is(leaf))
    return FieldRule(name, value, problem, made, _all_there(plain, "''"), (plain,))


def slots(name: str, path: str, leaf: str) -> FieldRule:
    """Names of an array of references, ordered by slot."""
    value = slot_order(f"d.{path}", _read("e.slot", "bigint"), _read(leaf))
    ok = f"{_is('e.slot', 'bigint')} AND {_is(leaf)}"
    plain, texts = slot_order(f"t.{path}", "e.slot", leaf), f"t.{path}{leaf[1:]}"
    sure = f"{_all_there(f't.{path}.slot', '-1L')} AND {_all_there(texts, "''")}"
    return FieldRule(name, value, _each_problem(f"d.{path}", ok), plain, sure, (texts,))


def stat(column: str, name: str) -> FieldRule:
    """A stat as a column, from its cell."""
    leaf = f"c.{column}"
    last = f"CAST(size(t.stats) - array_position(reverse(t.stats.stat.name), '{name}') AS INT)"
    plain = f"get(t.stats.base_stat, {last})"
    return FieldRule(column, _read(leaf, "bigint"), _leaf_problem(leaf, "bigint"), plain, f"{plain} IS NOT NULL")


def stat_cells(stats: dict[str, str]) -> str:
    """The named entries of the stats array, by column; of equal names the last one counts.

    Names are read once an entry, and entries are searched by them. They only have to equal a
    text, which no other kind of value does, so they are parsed as text.
    """
    named = "transform(d.stats, e -> struct(e.stat.name AS name, e.base_stat AS base_stat))"
    found = ", ".join(f"'{column}', {last_match('s', f"e.name = '{name}'")}.base_stat" for column, name in stats.items())
    return f"get(transform(array({named}), s -> named_struct({found})), 0)"


def first_text_in(name: str, path: str, language: str) -> FieldRule:
    """Text of the first entry in a language, white space collapsed; none gives null."""
    items, spoken = f"d.{path}", f"{_read('e.language.name')} = '{language}'"
    text = f"{first_match(items, spoken)}.flavor_text"
    # entries before the first match must name a language; after it nothing is read
    stop = first_match(items, f"NOT {_is('e.language.name')} OR {spoken}")
    bad = f"s IS NOT NULL AND NOT ({_is('s.language.name')} AND {_is('s.flavor_text')})"
    # the one-element transform names the entry, so it is searched for once
    named = f"get(transform(array({stop}), s -> CASE WHEN {bad} THEN '{WRONG_TYPE}' END), 0)"
    problem = f"CASE WHEN {items} IS NULL THEN '{MISSING}' ELSE {named} END"
    place = f"CAST(array_position(t.{path}.language.name, '{language}') AS INT)"
    plain = f"get(t.{path}.flavor_text, {place} - 1)"
    spoken_in = f"t.{path}.language.name"
    sure = f"{_all_there(spoken_in, "''")} AND ({place} = 0 OR {plain} IS NOT NULL)"
    return FieldRule(name, collapse_spaces(_read(text)), problem, collapse_spaces(plain), sure, (spoken_in, plain))


# --- the four entities ----------------------------------------------------------------

_REF_URL = "struct<url:{text}>"
_REF_NAME = "struct<name:{text}>"
# The relations of a type.
_DAMAGE_LISTS = [
    "double_damage_to", "double_damage_from", "half_damage_to", "half_damage_from", "no_damage_to", "no_damage_from",
]

# Column and name of each stat.
_STATS = {
    "hp": "hp",
    "attack": "attack",
    "defense": "defense",
    "special_attack": "special-attack",
    "special_defense": "special-defense",
    "speed": "speed",
}

ROOT = EntitySpec(
    "root",
    "staging.root",
    "id {int}, name {text}, height {int}, weight {int}, base_experience variant, "
    "`order` {int}, is_default {bool}, "
    f"species {_REF_URL}, "
    f"types array<struct<slot:{{int}},type:{_REF_NAME}>>, "
    f"abilities array<struct<slot:{{int}},ability:{_REF_NAME}>>, "
    f"moves array<struct<move:{_REF_NAME}>>, "
    "sprites struct<front_default:variant,back_default:variant>, "
    "stats array<struct<base_stat:{int},stat:struct<name:string>>>",
    (
        scalar("id", "bigint"),
        scalar("name", "string"),
        scalar("height", "bigint"),
        scalar("weight", "bigint"),
        scalar("base_experience", "bigint", nullable=True),
        scalar("order", "bigint"),
        scalar("is_default", "boolean"),
        reference("species_id", "species.url"),
        slots("types", "types", "e.type.name"),
        slots("abilities", "abilities", "e.ability.name"),
        names("moves", "moves", "e.move.name", distinct=True),
        scalar("sprite_front_default", "string", "sprites.front_default", nullable=True),
        scalar("sprite_back_default", "string", "sprites.back_default", nullable=True),
        *(stat(column, name) for column, name in _STATS.items()),
    ),
    cells=stat_cells(_STATS),
)

SPECIES = EntitySpec(
    "species",
    "staging.species",
    "id {int}, name {text}, `order` {int}, "
    f"generation {_REF_URL}, evolution_chain {_REF_URL}, evolves_from_species variant, "
    "is_legendary {bool}, is_mythical {bool}, is_baby {bool}, capture_rate {int}, "
    "base_happiness variant, gender_rate {int}, hatch_counter variant, "
    "has_gender_differences {bool}, forms_switchable {bool}, "
    f"growth_rate {_REF_NAME}, color {_REF_NAME}, shape variant, habitat variant, "
    f"egg_groups array<{_REF_NAME}>, "
    f"flavor_text_entries array<struct<flavor_text:{{text}},language:{_REF_NAME}>>",
    (
        scalar("id", "bigint"),
        scalar("name", "string"),
        scalar("order", "bigint"),
        reference("generation_id", "generation.url"),
        reference("evolution_chain_id", "evolution_chain.url"),
        optional_reference("evolves_from_id", "evolves_from_species"),
        scalar("is_legendary", "boolean"),
        scalar("is_mythical", "boolean"),
        scalar("is_baby", "boolean"),
        scalar("capture_rate", "bigint"),
        scalar("base_happiness", "bigint", nullable=True),
        scalar("gender_rate", "bigint"),
        scalar("hatch_counter", "bigint", nullable=True),
        scalar("has_gender_differences", "boolean"),
        scalar("forms_switchable", "boolean"),
        scalar("growth_rate", "string", "growth_rate.name"),
        scalar("color", "string", "color.name"),
        optional_text("shape", "shape", "name"),
        optional_text("habitat", "habitat", "name"),
        names("egg_groups", "egg_groups"),
        first_text_in("flavor_text", "flavor_text_entries", "en"),
    ),
)

TYPE = EntitySpec(
    "type",
    "staging.type",
    f"id {{int}}, name {{text}}, generation {_REF_URL}, move_damage_class variant, "
    "damage_relations struct<" + ",".join(f"{c}:array<{_REF_NAME}>" for c in _DAMAGE_LISTS) + ">",
    (
        scalar("id", "bigint"),
        scalar("name", "string"),
        reference("generation_id", "generation.url"),
        optional_text("move_damage_class", "move_damage_class", "name"),
        *(names(c, f"damage_relations.{c}") for c in _DAMAGE_LISTS),
    ),
)

MOVE = EntitySpec(
    "move",
    "staging.move",
    "id {int}, name {text}, power variant, accuracy variant, pp variant, priority {int}, "
    f"effect_chance variant, type {_REF_URL}, damage_class {_REF_NAME}, target {_REF_NAME}, "
    f"generation {_REF_URL}",
    (
        scalar("id", "bigint"),
        scalar("name", "string"),
        scalar("power", "bigint", nullable=True),
        scalar("accuracy", "bigint", nullable=True),
        scalar("pp", "bigint", nullable=True),
        scalar("priority", "bigint"),
        scalar("effect_chance", "bigint", nullable=True),
        reference("type_id", "type.url"),
        scalar("damage_class", "string", "damage_class.name"),
        scalar("target", "string", "target.name"),
        reference("generation_id", "generation.url"),
    ),
)

# in load order; an entity that is not listed here fails with a KeyError
ENTITIES: dict[str, EntitySpec] = {s.entity: s for s in (ROOT, SPECIES, TYPE, MOVE)}


# --- projection and gate --------------------------------------------------------------


def _document(schema: str) -> str:
    """The parsed payload; one that can't be parsed is told by its last column."""
    return f"from_json(payload, '{schema}, {_CORRUPT} string', map('columnNameOfCorruptRecord', '{_CORRUPT}'))"


def _problems(spec: EntitySpec) -> str:
    broken = f"CASE WHEN d IS NULL OR d.{_CORRUPT} IS NOT NULL THEN 'payload: {MALFORMED}' END"
    found = [f"concat('{f.name}: ', {f.problem})" for f in spec.fields]
    # most payloads have no problem, which compiled code finds without making a list
    sound = f"coalesce({', '.join([broken, *[f.problem for f in spec.fields]])}) IS NULL"
    problems = f"array_compact(array({', '.join([broken, *found])}))"
    return f"CASE WHEN {sound} THEN CAST(array() AS array<string>) ELSE {problems} END"


def checked(payloads: DataFrame, spec: EntitySpec, *kept: str) -> DataFrame:
    """(key, payload) -> key, payload, further columns ``kept``, the staging columns, and the list of ``problems``."""
    # explode of one element: without it the filter on the problems is pushed below this
    # select, and with it a copy of the parse for every field the filter looks at
    parsed = payloads.selectExpr("key", "payload", *kept, f"explode(array({_document(spec.leaves)})) AS d")
    if spec.cells:
        parsed = parsed.selectExpr("*", f"explode(array({spec.cells})) AS c")
    return parsed.selectExpr(
        "key",
        "payload",
        *kept,
        *[f"{f.value} AS `{f.name}`" for f in spec.fields],
        f"{_problems(spec)} AS problems",
    )


#: Longest payload that the plain parse may show to be sound: far below what a VARIANT holds.
PLAIN_BYTES = 1 << 20


def _sound(spec: EntitySpec) -> str:
    """Whether the plain parse shows that a payload has no problem; if not, it may still have none.

    A plain parse reads any value as text, so a text that could be another value counts as unsure.
    """
    texts = [text for f in spec.fields for text in f.texts]
    other = r"""\\n([-+.0-9\\[{\"]|(true|false|NaN|INF|Infinity)\\n)"""
    # a lambda, the only one of some entities, has the conditions compiled in many methods; a single one is too long for the JIT
    sure = [f"forall(array(t.{_CORRUPT}), x -> x IS NULL)", f"octet_length(payload) <= {PLAIN_BYTES}", *[f"({f.sure})" for f in spec.fields]]
    if texts:
        sure.append(f"NOT rlike(concat_ws('\\n', '', {', '.join(texts)}, ''), '{other}')")
    return f"coalesce({' AND '.join(sure)}, false)"


def checked_plain_first(payloads: DataFrame, spec: EntitySpec, *kept: str) -> DataFrame:
    """As :func:`checked`, for many payloads most of which are sound.

    A payload whose plain parse has every required leaf, each of its type, is sound. Any other, also one
    that the plain parse can't judge, is parsed again with VARIANT leaves, which tell what is wrong, if anything.
    """
    parsed = payloads.selectExpr("key", "payload", *kept, f"explode(array({_document(spec.plain)})) AS t")
    plain = [f"{f.plain} AS `t_{f.name}`" for f in spec.fields]
    judged = parsed.selectExpr("key", "payload", *kept, *plain, f"{_sound(spec)} AS sound")
    again = f"array(CASE WHEN NOT sound THEN {_document(spec.leaves)} END)"
    cells = f", CASE WHEN NOT sound THEN {spec.cells} END AS c" if spec.cells else ""
    judged = judged.selectExpr("*", f"explode(transform({again}, d -> struct(d AS d{cells}))) AS v").selectExpr("*", "v.*")
    return judged.selectExpr(
        "key",
        "payload",
        *kept,
        *[f"CASE WHEN sound THEN `t_{f.name}` ELSE {f.value} END AS `{f.name}`" for f in spec.fields],
        f"CASE WHEN sound THEN CAST(array() AS array<string>) ELSE {_problems(spec)} END AS problems",
    )


def accepted(rows: DataFrame) -> DataFrame:
    """Rows without a problem."""
    return rows.where("size(problems) = 0").drop("problems", "payload")


def rejected(rows: DataFrame) -> DataFrame:
    """Rows with a problem: key, payload, problems."""
    return rows.where("size(problems) > 0").select("key", "payload", "problems")


def all_accepted(rows: DataFrame) -> DataFrame:
    """All rows; the first one with a problem fails the job, and with it the whole write."""
    message = "concat('invalid payload ', key, ': ', array_join(problems, '; '))"
    ok = f"CASE WHEN size(problems) > 0 THEN CAST(raise_error({message}) AS BOOLEAN) ELSE true END"
    return rows.where(ok).drop("problems", "payload")


def project(payloads: DataFrame, spec: EntitySpec) -> DataFrame:
    """(key, payload) -> validated staging rows."""
    return all_accepted(checked(payloads, spec)).drop("key")
