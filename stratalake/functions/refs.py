"""Resource references: urls, keys and ids."""

# Fixed value: a resource url ends in /<entity>/<number> with an optional slash.
# (?U) gives \w and \d their Unicode meaning, (?d) makes only \n a line end.
KEY_PATTERN = r"(?dU)/([\w-]+/\d+)/?$"


def parse_key(url: str) -> str:
    """``.../species/6/`` -> ``species:6``; null where the url is no resource url."""
    return f"nullif(replace(regexp_extract({url}, r'{KEY_PATTERN}', 1), '/', ':'), '')"


def url_to_key(url: str) -> str:
    """As :func:`parse_key`, but an unparseable url fails the job."""
    message = f"concat('unparseable resource url: ', coalesce({url}, 'null'))"
    return f"coalesce({parse_key(url)}, raise_error({message}))"


def ref_id(url: str) -> str:
    """Trailing path segment as a number; anything else fails the job (ANSI cast)."""
    return f"CAST(regexp_extract({url}, '/([^/]+)/*$', 1) AS BIGINT)"


def try_ref_id(url: str) -> str:
    """Trailing path segment as a number, else null."""
    return f"TRY_CAST(regexp_extract({url}, '/([^/]+)/*$', 1) AS BIGINT)"


def key_entity(key: str = "key") -> str:
    """Entity part of ``entity:id``, up to the first colon."""
    return f"substring_index({key}, ':', 1)"


def key_id(key: str = "key") -> str:
    """Everything after the first colon of ``entity:id``."""
    return f"get(split({key}, ':', 2), 1)"


def key_path(key: str = "key") -> str:
    """``entity:id`` -> ``/entity/id``."""
    return f"concat('/', {key_entity(key)}, '/', {key_id(key)})"
