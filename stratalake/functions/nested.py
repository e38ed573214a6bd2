"""Arrays of structs, and text clean-up."""

# Unicode white space plus the four ASCII separators that Python's str.split() also drops.
_WHITE_SPACE = r"(?U)[\s\x1c-\x1f]+"


def slot_order(items: str, slot: str, value: str) -> str:
    """Values ordered by slot; equal slots keep their source order."""
    tagged = f"transform({items}, (e, i) -> struct({slot} AS slot, i AS i, {value} AS value))"
    return f"transform(sort_array({tagged}), s -> s.value)"


def nested_names(items: str, value: str) -> str:
    """Values in source order; an empty array stays empty."""
    return f"transform({items}, e -> {value})"


def distinct_sorted(items: str, value: str) -> str:
    """Distinct values, sorted."""
    return f"array_sort(array_distinct(transform({items}, e -> {value})))"


def first_match(items: str, condition: str) -> str:
    """First element that meets a condition, in array order, else null."""
    return f"get(filter({items}, e -> {condition}), 0)"


def last_match(items: str, condition: str) -> str:
    """Last element that meets a condition, in array order, else null."""
    return f"try_element_at(filter({items}, e -> {condition}), -1)"


def collapse_spaces(text: str) -> str:
    """Runs of white space become one space; none is left at the ends."""
    return f"trim(regexp_replace({text}, r'{_WHITE_SPACE}', ' '))"
