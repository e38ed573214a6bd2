"""Secret scan: all rules as one minimal automaton, one pass over the bytes of a text."""

from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import DataFrame

from stratalake.llm.automata import Table, compiled
from stratalake.llm.common import map_texts


class Rule(NamedTuple):
    """A kind, its pattern, and the least length of the match or of the run after ``after``."""

    kind: str
    pattern: str
    least: int
    after: str = ""  # pattern of what stands before the run that ``least`` counts


_KEY = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?"""
_WORD = "[A-Za-z0-9]"

#: Fixed kinds, in the order that breaks ties. A run of hex digits is matched whole, so counting its
#: length in the automaton equals dropping short matches; the others are matched first and then dropped.
BASE = (
    Rule("assign", _KEY + "[A-Za-z0-9+/_.=-]+", 12, _KEY),
    Rule("access", "AKIA[A-Z0-9]+", 18),
    Rule("hex", "[0-9a-f]{16,}", 16),
)
#: Kinds that add spans.
MORE = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 27),
    Rule("github", f"gh[pousr]_{_WORD}+", 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 20),
)


class Scanner:
    """The combined table of all rules, and each rule's own for the ends of a match."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        self.any: Table = compiled([r.pattern for r in rules], anywhere=True)
        self.ahead = [compiled([r.pattern]) for r in rules]
        self.back = [compiled([r.pattern], backwards=True) for r in rules]
        self.before = [compiled([r.after]) if r.after else None for r in rules]

    def events(self, data: bytes) -> list[tuple[int, int]]:
        """(end, bit set of rules) of every byte that ends a match: the one pass."""
        state, rows, accepts, found = 1, self.any.rows, self.any.accepts, []
        for at, byte in enumerate(data, 1):
            state = rows[state][byte]
            if accepts[state]:
                found.append((at, accepts[state]))
        return found

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, leftmost and not overlapping within a rule, by start and rule."""
        over, found = [0] * len(self.rules), []
        for at, bits in self.events(data):
            for r, rule in enumerate(self.rules):
                if not bits >> r & 1 or at <= over[r]:
                    continue
                length = self.back[r].longest(data, at, over[r])
                if not length:
                    continue  # it would overlap the match before
                start = at - length
                end = start + self.ahead[r].longest(data, start, len(data))
                over[r] = end
                run = start + (self.before[r].longest(data, start, end) if rule.after else 0)
                if end - run >= rule.least:
                    found.append((start, r, end))
        return sorted(found)


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def scan(text: str, machine: Scanner | None = None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of one text in code points."""
    machine = machine or scanner(BASE + MORE)
    rules = machine.rules
    data = text.encode("utf-8", "surrogatepass")
    spans = machine.spans(data)
    if len(data) == len(text):
        return [(rules[r].kind, s, e) for s, r, e in spans]
    place, at, chars = {}, 0, 0
    for b in sorted({b for s, _, e in spans for b in (s, e)}):
        chars += len(data[at:b].decode("utf-8", "surrogatepass"))
        place[b], at = chars, b
    return [(rules[r].kind, place[s], place[e]) for s, r, e in spans]


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """One row per document: doc_id and spans, an array of (kind, start, end) in code points.

    A null or empty text has no spans; a null or repeated doc_id is a row like any other.
    One task holds one Arrow batch; nothing is shuffled.
    """

    machine = scanner(rules)  # built once here; tasks get its tables

    def found(columns, texts) -> dict:
        names = ("kind", "start", "end")
        return {"doc_id": columns[0], "spans": [[dict(zip(names, s)) for s in scan(t, machine)] for t in texts]}

    return map_texts(docs, found, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")
