"""From rule patterns to one minimal deterministic automaton as arrays.

A pattern is parsed to a nondeterministic automaton, several of these are combined by subset
construction, and equal states are merged. Bytes that no pattern tells apart share a
column of the transition array.
"""

import numpy as np

Edges = list[list[tuple[frozenset, int]]]  # per state: (bytes, next state); None bytes: free step

ANY_CASE = {ord(a): frozenset((ord(a), ord(a) ^ 32)) for a in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"}


class Pattern:
    """Parses literals, ``\\xHH`` and escapes, ``[...]``, ``( | )``, ``?``, ``*``, ``+``, ``{n}``, ``{n,}``.

    ``(?i: )`` matches ASCII letters in either case.
    """

    def __init__(self, text: str):
        self.text, self.at, self.fold = text, 0, False
        self.free: list[list[int]] = []
        self.edges: Edges = []
        self.start, self.end = self._choice()
        if self.at != len(text):
            raise ValueError(f"cannot read {text!r} at {self.at}")

    def _state(self) -> int:
        self.free.append([])
        self.edges.append([])
        return len(self.free) - 1

    def _peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def _choice(self) -> tuple[int, int]:
        start, end = self._state(), self._state()
        while True:
            a, b = self._sequence()
            self.free[start].append(a)
            self.free[b].append(end)
            if self._peek() != "|":
                return start, end
            self.at += 1

    def _sequence(self) -> tuple[int, int]:
        start = end = self._state()
        while self._peek() not in ("", "|", ")"):
            begin = self.at
            a, b = self._atom()
            low, high = self._times()
            after, fold = self.at, self.fold
            copies = [(a, b)]
            for _ in range(1, max(low, 1)):  # the atom is read again for each further copy
                self.at = begin
                copies.append(self._atom())
                self.at = after
            self.fold = fold
            for a, b in copies:
                self.free[end].append(a)
                last, end = end, b
            if high is None:
                loop = self._state()
                self.free[b].append(loop)
                self.free[loop].append(a)
                end = loop
            if low == 0:
                out = self._state()
                self.free[last].append(out)
                self.free[end].append(out)
                end = out
        return start, end

    def _times(self) -> tuple[int, int | None]:
        c = self._peek()
        if c and c in "?*+":
            self.at += 1
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
        if c == "{":
            close = self.text.index("}", self.at)
            low, comma, high = self.text[self.at + 1 : close].partition(",")
            if high:
                raise ValueError("{n,m} is not supported")
            self.at = close + 1
            return int(low), None if comma else int(low)
        return 1, 1

    def _atom(self) -> tuple[int, int]:
        if self.text.startswith("(?i:", self.at):
            outer, self.fold, self.at = self.fold, True, self.at + 4
        elif self._peek() == "(":
            outer, self.at = self.fold, self.at + 1
        else:
            a, b = self._state(), self._state()
            self.edges[a].append((self._bytes(), b))
            return a, b
        inner = self._choice()
        if self._peek() != ")":
            raise ValueError(f"no end of group in {self.text!r}")
        self.at += 1
        self.fold = outer
        return inner

    def _byte(self) -> int:
        c = self._peek()
        self.at += 1
        if c != "\\":
            return ord(c)
        c = self._peek()
        self.at += 1
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return ord(c)

    def _bytes(self) -> frozenset:
        if self._peek() != "[":
            code = self._byte()
            return ANY_CASE.get(code, frozenset((code,))) if self.fold else frozenset((code,))
        self.at += 1
        found: set[int] = set()
        while self._peek() != "]":
            low = self._byte()
            high = low
            if self._peek() == "-" and self.text[self.at + 1 : self.at + 2] != "]":
                self.at += 1
                high = self._byte()
            found.update(range(low, high + 1))
        self.at += 1
        if self.fold:
            found = set().union(*(ANY_CASE.get(b, {b}) for b in found))
        return frozenset(found)


class Automaton:
    """``next[state, column[byte]]`` is the next state, ``accepts[state]`` whether a pattern ends there.

    State 0 is the start. An anchored automaton has a dead state -1. With ``search`` a match may begin
    anywhere and the accepting state is never left: it tells whether there is a match. With ``backwards``
    a text is read from its end; bit k of ``accepts`` says that a match of pattern k begins at the
    byte read last.
    """

    def __init__(self, patterns: list[str], search: bool = False, backwards: bool = False):
        free: list[list[int]] = []
        edges: Edges = []
        starts, ends = [], {}
        for k, text in enumerate(patterns):
            p, base = Pattern(text), len(free)
            free += [[s + base for s in f] for f in p.free]
            edges += [[(b, s + base) for b, s in e] for e in p.edges]
            first, last = (p.end, p.start) if backwards else (p.start, p.end)
            starts.append(first + base)
            ends[last + base] = k
        if backwards:
            ahead_free, ahead = free, edges
            free, edges = [[] for _ in ahead], [[] for _ in ahead]
            for state, (steps, reads) in enumerate(zip(ahead_free, ahead)):
                for to in steps:
                    free[to].append(state)
                for b, to in reads:
                    edges[to].append((b, state))

        #: Bytes that occur in some pattern.
        self.used = np.zeros(256, bool)
        sets = {b for e in edges for b, _ in e}
        for b in sets:
            self.used[list(b)] = True
        signature = np.array([[byte in b for b in sorted(sets, key=sorted)] for byte in range(256)], dtype=bool)
        _, first, column = np.unique(signature, axis=0, return_index=True, return_inverse=True)
        self.column = column.reshape(-1).astype(np.uint8)

        def closed(states: set[int]) -> frozenset:
            todo, found = list(states), set(states)
            while todo:
                for s in free[todo.pop()]:
                    if s not in found:
                        found.add(s)
                        todo.append(s)
            return frozenset(s for s in found if edges[s] or s in ends)

        begin = closed(set(starts))
        number, todo, rows, accepts = {begin: 0}, [begin], [], []
        while todo:
            states = todo.pop(0)
            accepted = states & ends.keys()
            accepts.append(sum(1 << ends[s] for s in accepted) if backwards else bool(accepted))
            row = []
            for byte in first.tolist():
                to = {s for state in states for b, s in edges[state] if byte in b}
                after = closed(to | set(starts)) if search or backwards else closed(to)
                if search and accepted:
                    after = states
                elif search and after & ends.keys():
                    after = frozenset(ends)  # one accepting state
                if not after:
                    row.append(-1)
                    continue
                if after not in number:
                    number[after] = len(number)
                    todo.append(after)
                row.append(number[after])
            rows.append(row)
        self._minimise(np.array(rows, np.int32), np.array(accepts))

    def _minimise(self, table: np.ndarray, accepts: np.ndarray) -> None:
        """Merge states that no continuation tells apart, by refining a partition."""
        part = np.unique(accepts, return_inverse=True)[1].reshape(-1)
        while True:
            # The dead state -1 is a part of its own.
            after = np.where(table < 0, -1, part[table])
            keys = np.column_stack([part, after])
            _, first, new = np.unique(keys, axis=0, return_index=True, return_inverse=True)
            new = new.reshape(-1)
            if new.max() == part.max():
                break
            part = new
        order = np.argsort(first, kind="stable")  # the start state stays 0
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        part = rank[new]
        rows = first[order]
        self.next = np.where(table[rows] < 0, -1, part[table[rows]]).astype(np.int32)
        self.accepts = accepts[rows]
