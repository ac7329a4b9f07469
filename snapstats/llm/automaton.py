"""Byte automata for rule patterns: subset construction, minimisation, transition arrays.

The patterns use literals, escapes, classes, groups, `|`, `?`, `*`, `+` and counts `{m}`, `{m,}`, `{m,n}`.
"""

from __future__ import annotations

import numpy as np

DEAD = 0


class _Nfa:
    """States with byte-set edges and empty edges; built piece by piece from a pattern."""

    def __init__(self, ignore_case: bool):
        self.sets: list[tuple[frozenset[int], int] | None] = []
        self.empty: list[list[int]] = []
        self.ignore_case = ignore_case

    def state(self) -> int:
        self.sets.append(None)
        self.empty.append([])
        return len(self.sets) - 1

    def parse(self, pattern: str) -> tuple[int, int]:
        self.p, self.i = pattern, 0
        part = self._either()
        if self.i != len(pattern):
            raise ValueError(f"bad pattern {pattern!r} at {self.i}")
        return part

    def _peek(self) -> str:
        return self.p[self.i] if self.i < len(self.p) else ""

    def _take(self) -> str:
        self.i += 1
        return self.p[self.i - 1]

    def _either(self) -> tuple[int, int]:
        options = [self._sequence()]
        while self._peek() == "|":
            self._take()
            options.append(self._sequence())
        if len(options) == 1:
            return options[0]
        first, last = self.state(), self.state()
        for a, b in options:
            self.empty[first].append(a)
            self.empty[b].append(last)
        return first, last

    def _sequence(self) -> tuple[int, int]:
        first = last = self.state()
        while self._peek() not in ("", "|", ")"):
            a, b = self._repeat()
            self.empty[last].append(a)
            last = b
        return first, last

    def _repeat(self) -> tuple[int, int]:
        begin = self.i
        part = self._atom()
        end = self.i
        low, high = 1, 1
        if self._peek() in ("?", "*", "+"):
            low, high = {"?": (0, 1), "*": (0, None), "+": (1, None)}[self._take()]
        elif self._peek() == "{":
            self._take()
            text = ""
            while self._peek() != "}":
                text += self._take()
            self._take()
            a, _, b = text.partition(",")
            low, high = int(a), (int(a) if "," not in text else int(b) if b else None)
        if (low, high) == (1, 1):
            return part
        after = self.i

        def again() -> tuple[int, int]:
            self.i = begin
            made = self._atom()
            assert self.i == end
            return made
        first = last = self.state()
        for k in range(max(low, 1) if high is None else high):
            a, b = part if k == 0 else again()
            self.empty[last].append(a)
            if k >= low:
                skip = self.state()
                self.empty[b].append(skip)
                self.empty[last].append(skip)
                b = skip
            last = b
            if high is None and k == max(low, 1) - 1:
                done = self.state()
                self.empty[b].extend([a, done])
                if low == 0:
                    self.empty[first].append(done)
                last = done
        self.i = after
        return first, last

    def _escaped(self) -> int:
        c = self._take()
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2:self.i], 16)
        return ord({"n": "\n", "t": "\t", "r": "\r"}.get(c, c))

    def _atom(self) -> tuple[int, int]:
        c = self._take()
        if c == "(":
            part = self._either()
            self._take()
            return part
        if c == "[":
            members: set[int] = set()
            while self._peek() != "]":
                x = self._take()
                low = self._escaped() if x == "\\" else ord(x)
                if self._peek() == "-" and self.p[self.i + 1] != "]":
                    self._take()
                    x = self._take()
                    members.update(range(low, (self._escaped() if x == "\\" else ord(x)) + 1))
                else:
                    members.add(low)
            self._take()
        else:
            members = {self._escaped() if c == "\\" else ord(c)}
        if self.ignore_case:
            members |= {m ^ 32 for m in members if chr(m).isascii() and chr(m).isalpha()}
        a, b = self.state(), self.state()
        self.sets[a] = (frozenset(members), b)
        return a, b

    def closure(self, states) -> frozenset[int]:
        seen, open_ = set(states), list(states)
        while open_:
            for n in self.empty[open_.pop()]:
                if n not in seen:
                    seen.add(n)
                    open_.append(n)
        return frozenset(seen)


class Automaton:
    """Minimal automaton of one or more patterns.

    `step` is the flat transition array, indexed by state * n_classes + byte_class[byte]; state DEAD
    is left by nothing. With `search` a match may start anywhere and the accepting state is kept for good,
    so that the state after a whole text tells whether any pattern occurs in it.
    """

    def __init__(self, patterns: list[tuple[str, bool]], search: bool = False):
        nfas = []
        for pattern, ignore_case in patterns:
            nfa = _Nfa(ignore_case)
            nfas.append((nfa, *nfa.parse(pattern)))
        sets = sorted({s[0] for nfa, _, _ in nfas for s in nfa.sets if s}, key=sorted)
        classes: dict[tuple[bool, ...], int] = {}
        self.byte_class = np.array([classes.setdefault(tuple(b in s for s in sets), len(classes)) for b in range(256)], np.int32)
        samples = [int(np.flatnonzero(self.byte_class == c)[0]) for c in range(len(classes))]
        start = tuple(nfa.closure([a]) for nfa, a, _ in nfas)
        ids = {start: 0}
        table, accept, open_ = [], [], [start]
        while open_:
            now = open_.pop(0)
            done = any(last in states for states, (_, _, last) in zip(now, nfas))
            accept.append(done)
            row = []
            for byte in samples:
                if search and done:
                    row.append(ids[now])
                    continue
                to = tuple(
                    nfa.closure({nfa.sets[s][1] for s in states if nfa.sets[s] and byte in nfa.sets[s][0]} | ({a} if search else set()))
                    for states, (nfa, a, _) in zip(now, nfas))
                if search and any(last in states for states, (_, _, last) in zip(to, nfas)):
                    to = tuple(frozenset([last]) for _, _, last in nfas)
                if to not in ids:
                    ids[to] = len(ids)
                    open_.append(to)
                row.append(ids[to])
            table.append(row)
        self._minimise(np.array(table), np.array(accept))

    def _minimise(self, table: np.ndarray, accept: np.ndarray) -> None:
        """Moore's partition refinement; the dead block, if there is one, gets number DEAD."""
        block, count = accept.astype(np.int64), 0
        while True:
            _, block = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)
            block = block.ravel()
            if block.max() + 1 == count:
                break
            count = int(block.max()) + 1
        one = np.zeros(count, np.int64)
        one[block] = np.arange(len(block))
        small, self_accept = block[table[one]], accept[one]
        dead = [b for b in range(count) if not self_accept[b] and (small[b] == b).all()]
        order = dead + [b for b in range(count) if b not in dead]
        if not dead:
            order = [-1, *order]
        rank = np.zeros(count, np.int64)
        for new, old in enumerate(order):
            if old >= 0:
                rank[old] = new
        self.n_classes = table.shape[1]
        step = np.zeros((len(order), self.n_classes), np.int32)
        self.accept = np.zeros(len(order), bool)
        for new, old in enumerate(order):
            if old >= 0:
                step[new] = rank[small[old]]
                self.accept[new] = self_accept[old]
        self.start = int(rank[block[0]])
        self.step = step.ravel()
        live = [s for s in range(1, len(order)) if not self.accept[s]]
        # Bytes after which nothing before them matters: a text may be cut behind them.
        self.resets = np.isin(self.byte_class, [c for c in range(self.n_classes) if live and all(step[s, c] == self.start for s in live)])
        self.rows = [[int(x) for x in row[self.byte_class]] for row in step]
        self.first = np.array([self.rows[self.start][b] != DEAD for b in range(256)])

    def run(self, text: bytes, state: int) -> int:
        """State behind `text`, or the accepting state as soon as it is met."""
        rows, accept = self.rows, self.accept.tolist()
        for byte in text:
            state = rows[state][byte]
            if accept[state]:
                break
        return state

    def longest(self, text: bytes, at: int) -> int:
        """End of the longest match that starts at `at`, or -1."""
        state, end, rows, accept = self.start, -1, self.rows, self.accept
        for i in range(at, len(text)):
            state = rows[state][text[i]]
            if state == DEAD:
                break
            if accept[state]:
                end = i + 1
        return end
