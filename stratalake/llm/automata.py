"""Regular expressions as minimal transition tables over bytes.

A pattern of literals, classes, groups, alternatives and repeats becomes a nondeterministic
automaton; subset construction makes it deterministic and partition refinement minimal.
"""

import re._constants as sre
import re._parser as parser
from collections import defaultdict

import numpy as np


class _Nfa:
    """States with byte transitions and empty moves; ``accepts`` gives a state's rule."""

    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.steps: list[list[tuple[frozenset[int], int]]] = []
        self.accepts: dict[int, int] = {}

    def state(self) -> int:
        self.empty.append([])
        self.steps.append([])
        return len(self.empty) - 1

    def add(self, tree, start: int, fold: bool) -> int:
        """Append a parsed pattern after ``start``; gives the state where it ends."""
        for op, arg in tree:
            if op in (sre.LITERAL, sre.NOT_LITERAL, sre.IN):
                end = self.state()
                self.steps[start].append((_bytes_of(op, arg, fold), end))
            elif op is sre.SUBPATTERN:
                _, flags, off, inner = arg
                end = self.add(inner, start, (fold or bool(flags & sre.SRE_FLAG_IGNORECASE)) and not off & sre.SRE_FLAG_IGNORECASE)
            elif op is sre.BRANCH:
                end = self.state()
                for option in arg[1]:
                    self.empty[self.add(option, start, fold)].append(end)
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
                low, high, inner = arg
                end = start
                for _ in range(low):
                    end = self.add(inner, end, fold)
                if high is sre.MAXREPEAT:
                    loop = self.state()
                    self.empty[end].append(loop)
                    self.empty[self.add(inner, loop, fold)].append(loop)
                    end = loop
                else:
                    done = self.state()
                    for _ in range(high - low):
                        self.empty[end].append(done)
                        end = self.add(inner, end, fold)
                    self.empty[end].append(done)
                    end = done
            else:
                raise ValueError(f"not supported in a rule: {op}")
            start = end
        return start

    def closure(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


def _bytes_of(op, arg, fold: bool) -> frozenset[int]:
    """The bytes that one element of a pattern matches; patterns are ASCII."""
    found: set[int] = set()
    negate = op is sre.NOT_LITERAL
    items = [(sre.LITERAL, arg)] if op in (sre.LITERAL, sre.NOT_LITERAL) else arg
    for kind, value in items:
        if kind is sre.NEGATE:
            negate = True
        elif kind is sre.LITERAL:
            found.add(value)
        elif kind is sre.RANGE:
            found.update(range(value[0], value[1] + 1))
        else:
            raise ValueError(f"not supported in a class: {kind}")
    if any(b > 127 for b in found):
        raise ValueError("rules are ASCII")
    if fold:
        found |= {ord(chr(b).swapcase()) for b in found if chr(b).isalpha()}
    return frozenset(set(range(256)) - found if negate else found)


class Table:
    """A deterministic automaton: ``step[state, byte]``, ``accepts[state]`` a bit set of rules.

    State 0 is dead, state 1 the start.
    """

    def __init__(self, step: np.ndarray, accepts: list[int]) -> None:
        self.step, self.accepts = step, accepts

    def longest(self, data: bytes, at: int, stop: int) -> int:
        """Length of the longest match that starts at ``at`` and ends by ``stop``; 0: none.

        With ``stop`` below ``at`` it reads backwards, from the byte before ``at``.
        """
        back = stop < at
        state, found, step, accepts = 1, 0, self.rows, self.accepts
        # by index: a slice would copy what the walk never reaches
        for n, place in enumerate(range(at - 1, stop - 1, -1) if back else range(at, stop), 1):
            state = step[state][data[place]]
            if not state:
                break
            if accepts[state]:
                found = n
        return found

    @property
    def rows(self) -> list[list[int]]:
        if not hasattr(self, "_rows"):
            self._rows = self.step.tolist()
        return self._rows


def compiled(patterns: list[str], anywhere: bool = False, backwards: bool = False) -> Table:
    """One minimal table for all patterns.

    ``anywhere``: a match may start at any byte. ``backwards``: the patterns reversed.
    """
    nfa = _Nfa()
    start = nfa.state()
    for rule, pattern in enumerate(patterns):
        tree = parser.parse(pattern)
        fold = bool(tree.state.flags & sre.SRE_FLAG_IGNORECASE)
        end = nfa.add(_reversed(tree) if backwards else tree, start if len(patterns) == 1 else _fork(nfa, start), fold)
        nfa.accepts[end] = rule
    if anywhere:
        nfa.steps[start].append((frozenset(range(256)), start))
    return _minimal(*_subsets(nfa, start))


def _fork(nfa: _Nfa, start: int) -> int:
    branch = nfa.state()
    nfa.empty[start].append(branch)
    return branch


def _reversed(tree) -> list:
    out = []
    for op, arg in reversed(list(tree)):
        if op is sre.SUBPATTERN:
            arg = (*arg[:3], _reversed(arg[3]))
        elif op is sre.BRANCH:
            arg = (arg[0], [_reversed(x) for x in arg[1]])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            arg = (arg[0], arg[1], _reversed(arg[2]))
        out.append((op, arg))
    return out


def _subsets(nfa: _Nfa, start: int) -> tuple[np.ndarray, list[int]]:
    """Subset construction over classes of bytes that no transition tells apart."""
    sets = {s for moves in nfa.steps for s, _ in moves}
    classes: dict[tuple, list[int]] = defaultdict(list)
    ordered = sorted(sets, key=sorted)
    for b in range(256):
        classes[tuple(b in s for s in ordered)].append(b)
    members = list(classes.values())
    first = nfa.closure({start})
    number, todo = {frozenset(): 0, first: 1}, [first]
    rows: dict[int, list[int]] = {0: [0] * len(members)}
    while todo:
        here = todo.pop()
        moves = [m for s in here for m in nfa.steps[s]]
        row = []
        for group in members:
            target = nfa.closure({t for s, t in moves if group[0] in s})
            if target not in number:
                number[target] = len(number)
                todo.append(target)
            row.append(number[target])
        rows[number[here]] = row
    step = np.zeros((len(number), 256), np.int32)
    for k, group in enumerate(members):
        step[:, group] = np.array([rows[i][k] for i in range(len(number))], np.int32)[:, None]
    accepts = [0] * len(number)
    for subset, i in number.items():
        for s in subset & nfa.accepts.keys():
            accepts[i] |= 1 << nfa.accepts[s]
    return step, accepts


def _minimal(step: np.ndarray, accepts: list[int]) -> Table:
    """Partition refinement: states stay together while their successors do."""
    block = np.unique(np.array(accepts, np.int64), return_inverse=True)[1]
    count = 0
    while block.max() + 1 != count:
        count = block.max() + 1
        block = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)[1].ravel()
    # Dead is 0 and start 1; a start that is dead keeps its own row.
    order = {int(block[0]): 0}
    order.setdefault(int(block[1]), 1)
    for b in block:
        order.setdefault(int(b), max(order.values()) + 1)
    place = np.array([order[b] for b in range(count)])
    out, marks = np.zeros((count, 256), np.int32), [0] * count
    for i, b in enumerate(block):
        out[place[b]], marks[place[b]] = place[block[step[i]]], accepts[i]
    return Table(out, marks)
