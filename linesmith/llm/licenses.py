"""License scans: templates with optional and replaceable regions, run as automata over the words of a text.

A template is parsed into a tree of words, regions that may be missing, gaps
of a bounded number of words, and choices. The trees of all templates become one
automaton over words; base phrases are templates without regions. Its states
are found as texts need them, ``STATES`` at a time, so a text costs one
lookup per word however many templates there are, and memory stays bounded. A
place is accepted if every word outside the regions agrees; the automaton of the
reversed template then gives its longest start.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` with A-Z in lower case,
in templates too. Null and empty texts have no words and no places. Texts are
scanned whole, one after another, whatever their length; nothing is shuffled.
Overlapping places all count; templates that accept at one end are one place
each. Repeated rows and null ids are rows like any other, an empty table gives
an empty one. Columns of the input named like the new ones are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import sliced
from .shipping import ship
from .wordings import BASE, TEMPLATES

ship(__name__)

#: States kept of an automaton before it starts anew, and words remembered by a task.
STATES = 1 << 12
ADDED = ("license_words", "license_places")
# Every byte that is no word's becomes a space; a-z, 0-9 and all of a longer character stay.
_KEEP = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_KEEP).split()


# ---- templates: ("word", w), ("opt", items), ("any", a, b), ("one", [items, ...]) ----

def parse(markup: str) -> list[tuple]:
    """The tree of a template; a region left open or closed twice is an error."""
    items, at = _items(markup, 0, ())
    if at != len(markup):
        raise ValueError(f"unexpected {markup[at:at + 8]!r}")
    if not items or "any" in (items[0][0], items[-1][0]):
        raise ValueError("a template neither is empty nor starts or ends with a gap")
    if not mandatory(items):
        raise ValueError("a template needs a word that must be there")
    return items


def _items(markup: str, at: int, ends: tuple[str, ...]) -> tuple[list[tuple], int]:
    found: list[tuple] = []
    while at < len(markup):
        if markup.startswith(ends, at) and ends:
            return found, at
        if markup.startswith("<<opt>>", at):
            inner, at = _items(markup, at + 7, ("<</opt>>",))
            at = _past(markup, at, "<</opt>>")
            found.append(("opt", inner))
        elif gap := re.compile(r"<<any (\d+)-(\d+)>>").match(markup, at):
            if int(gap[1]) > int(gap[2]):
                raise ValueError(f"no such gap: {gap[0]}")
            found.append(("any", int(gap[1]), int(gap[2])))
            at = gap.end()
        elif markup.startswith("<<one ", at):
            choices, at = [], at + 6
            while True:
                inner, at = _items(markup, at, ("|", ">>"))
                choices.append(inner)
                if not markup.startswith("|", at):
                    break
                at += 1
            at = _past(markup, at, ">>")
            found.append(("one", choices))
        elif markup.startswith("<<", at):
            raise ValueError(f"unknown region {markup[at:at + 12]!r}")
        else:
            stop = min([len(markup), *(p for p in (markup.find(m, at) for m in ("<<", *ends)) if p >= 0)])
            found += [("word", w) for w in words_of(markup[at:stop].encode())]
            at = stop
    return found, at


def _past(markup: str, at: int, mark: str) -> int:
    if not markup.startswith(mark, at):
        raise ValueError(f"missing {mark}")
    return at + len(mark)


def mandatory(items: list[tuple]) -> int:
    """The words any accepted text has, outside of gaps."""
    return sum(1 if kind == "word" else min(map(mandatory, more[0])) if kind == "one" else 0 for kind, *more in items)


def turned(items: list[tuple]) -> list[tuple]:
    """The tree that accepts the words in reverse."""
    def one(item: tuple) -> tuple:
        kind, *more = item
        return (kind, turned(more[0])) if kind == "opt" else (kind, [turned(c) for c in more[0]]) if kind == "one" else item
    return [one(i) for i in reversed(items)]


# ---- automata ----

ANY = -1


class Automaton:
    """All trees at once; ``floating`` starts anew at every word, else at the first only."""

    def __init__(self, trees: list[list[tuple]], codes: dict[bytes, int], floating: bool):
        self.steps: list[list[tuple[int, int]]] = []  # of a node: (code or ANY, next node)
        self.free: list[list[int]] = []
        self.ends: dict[int, int] = {}
        starts = []
        for number, tree in enumerate(trees):
            start = self._node()
            starts.append(start)
            self.ends[self._add(tree, start, codes)] = number
        self.first = self._closed(starts)
        self.floating = floating
        self._forget()

    def _node(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def _add(self, items: list[tuple], at: int, codes: dict[bytes, int]) -> int:
        for kind, *more in items:
            if kind == "word":
                to = self._node()
                self.steps[at].append((codes.setdefault(more[0], len(codes) + 1), to))
            elif kind == "any":
                low, high = more
                to = self._node()
                for k in range(high + 1):
                    if k >= low:
                        self.free[at].append(to)
                    if k < high:
                        self.steps[at].append((ANY, nxt := self._node()))
                        at = nxt
            else:
                to = self._node()
                for choice in more[0] if kind == "one" else [more[0], []]:
                    inner = self._node()
                    self.free[at].append(inner)
                    self.free[self._add(choice, inner, codes)].append(to)
            at = to
        return at

    def _closed(self, nodes) -> frozenset[int]:
        seen, todo = set(nodes), list(nodes)
        while todo:
            for n in self.free[todo.pop()]:
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        return frozenset(seen)

    def _forget(self) -> None:
        self.known: dict[frozenset[int], int] = {}
        self.sets: list[frozenset[int]] = []
        self.moves: list[dict[int, int]] = []
        self.accepts: list[tuple[int, ...]] = []
        self._state(self.first)

    def _state(self, nodes: frozenset[int]) -> int:
        if nodes not in self.known:
            self.known[nodes] = len(self.sets)
            self.sets.append(nodes)
            self.moves.append({})
            self.accepts.append(tuple(sorted(self.ends[n] for n in nodes if n in self.ends)))
        return self.known[nodes]

    def step(self, state: int, code: int) -> int:
        """The next state, looked up or found; after ``STATES`` states the tables start anew."""
        to = self.moves[state].get(code)
        if to is None:
            nodes = self.sets[state]
            after = self._closed({n for node in nodes for want, n in self.steps[node] if want == code or want == ANY})
            if self.floating:
                after |= self.first
            if len(self.sets) >= STATES:
                self._forget()
                return self._state(after)
            to = self.moves[state][code] = self._state(after)
        return to


@dataclass(frozen=True)
class Wording:
    label: str
    base: bool
    tree: list[tuple]
    words: int


def wordings(base: dict[str, str] = BASE, templates: dict[str, str] = TEMPLATES) -> list[Wording]:
    """Base phrases first, then templates."""
    plain = [Wording(label, True, [("word", w) for w in words_of(phrase.encode())], len(phrase.split())) for phrase, label in base.items()]
    trees = [(label, parse(markup)) for label, markup in templates.items()]
    return plain + [Wording(label, False, tree, mandatory(tree)) for label, tree in trees]


class Scanner:
    def __init__(self, known: list[Wording]):
        self.known = known
        self.codes: dict[bytes, int] = {}
        self.forward = Automaton([w.tree for w in known], self.codes, floating=True)
        self.back = [Automaton([turned(w.tree)], self.codes, floating=False) for w in known]

    def places(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """(wording, first word, word behind the last) of every place, in order of ends."""
        get, run = self.codes.get, self.forward
        coded = [get(w, 0) for w in words]
        found, state = [], 0
        for at, code in enumerate(coded):
            to = run.moves[state].get(code)
            state = run.step(state, code) if to is None else to
            if run.accepts[state]:
                found += [(number, self._start(number, coded, at), at + 1) for number in run.accepts[state]]
        return found

    def _start(self, number: int, coded: list[int], at: int) -> int:
        run, state, best = self.back[number], 0, at
        while at >= 0:
            state = run.step(state, coded[at])
            if not run.sets[state]:
                break
            if run.accepts[state]:
                best = at
            at -= 1
        return best


PLACE = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("words", pa.int64()), ("first", pa.int64()), ("stop", pa.int64())])


def license_places(docs: DataFrame, known: list[Wording] | None = None, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns), ``license_words`` and ``license_places``.

    A place has its label, whether it is a base phrase, the mandatory words of
    its wording, its first word and the word behind its last.
    """
    known = wordings() if known is None else known
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ADDED]
    rows_of = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("__license_text"))

    def start():
        scanner = Scanner(known)

        def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            sizes, places = [], []
            for value in batch.column(len(kept)):
                words = words_of(value.as_py())
                sizes.append(len(words))
                places.append([{"label": known[n].label, "base": known[n].base, "words": known[n].words, "first": a, "stop": b}
                               for n, a, b in scanner.places(words)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(sizes, pa.int64()), pa.array(places, pa.list_(PLACE))],
                                             names=[*kept, *ADDED])
        return rows
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows_of.schema.fields[:-1])
    return rows_of.mapInArrow(sliced("__license_text", start), f"{kinds}license_words long, license_places array<struct<"
                              "label: string, base: boolean, words: long, first: long, stop: long>>")


def as_pattern(items: list[tuple]) -> str:
    """The template as a regular expression over words that each follow a space, for SQL and tests."""
    def one(kind: str, *more) -> str:
        if kind == "word":
            return " " + more[0].decode()
        if kind == "any":
            return f"(?: [^ ]+){{{more[0]},{more[1]}}}"
        inner = [as_pattern(c) for c in (more[0] if kind == "one" else [more[0]])]
        return f"(?:{'|'.join(inner)})" + ("?" if kind == "opt" else "")
    return "".join(one(*i) for i in items)
