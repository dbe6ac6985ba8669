"""A compiler for chat templates.

Statements: ``{% for x in e %}``, ``{% if e %} {% elif e %} {% else %}``,
``{% set x = e %}``, ``{% generation %}``, each but ``set`` ended by ``end…``;
``{{ e }}`` prints, ``{# … #}`` is a comment; a ``-`` inside a tag's mark takes the
white space next to it. Expressions: texts, whole numbers, ``true false none``,
names, ``a.b``, ``a['b']``, ``a[0]``, ``a[1:]``, ``not and or``, ``== != < > <= >= in``,
``not in``, ``is (not) defined/none/string``, ``+ - %``, ``~`` (joins texts) and filters
``e | name``. Inside ``for`` there are ``loop.index``, ``index0``, ``first``, ``last``
and ``length``.

A name or key that does not exist is undefined: it is false, ``is defined`` tells,
and anything else done with it is an error, as printing nothing would hide it.
What the language lacks, calls and methods among them, is an error when the
template is compiled.

The sandbox is what the language lacks: no calls, no imports, no attributes but
the keys of the values given, no writes outside ``set``. A template is parsed to
tuples (the syntax tree), parts without names are folded to constants, and the
rest becomes nested Python closures. A render gives the text and, as code point
ranges, what was printed inside ``generation``.

Control strings in texts are broken by the ``escape`` filter: a backslash goes
behind their first character, and a backslash is doubled. :func:`unescape`
gives the text back.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from typing import Any

from .shipping import ship

ship(__name__)

TAGS = re.compile(r"\{(?:%(?P<s1>-?)\s*(?P<statement>.*?)\s*(?P<s2>-?)%|\{(?P<p1>-?)\s*(?P<print>.*?)\s*(?P<p2>-?)\}|#(?P<c1>-?).*?(?P<c2>-?)#)\}", re.S)
TOKENS = re.compile(r"""\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<mark>==|!=|<=|>=|[<>+%:.\[\]|~()-]))""", re.S)
CONSTANTS = {"true": True, "false": False, "none": None}
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}

Node = tuple
Env = dict[str, Any]


def escaper(controls: Iterable[str]) -> Callable[[str], str]:
    """The ``escape`` filter for these control strings; none may overlap itself or another one."""
    found = sorted(set(controls))
    for a in found:
        if "\\" in a or len(a) < 2 or any(a != b and a in b for b in found) or any(a[:k] == b[-k:] for b in found for k in range(1, min(len(a), len(b)) + (a != b))):
            raise ValueError(f"not usable as a control string: {a!r}")
    pattern = re.compile("|".join([r"\\", *[re.escape(c) for c in found]]))
    return lambda text: pattern.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


# --- syntax tree


class _Expression:
    """Recursive descent over one tag's tokens."""

    def __init__(self, source: str):
        self.items: list[tuple[str, str]] = []
        at = 0
        source = source.rstrip()
        while at < len(source):
            m = TOKENS.match(source, at)
            if not m:
                raise SyntaxError(f"cannot read {source[at:]!r}")
            self.items.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def take(self, *wanted: str) -> str | None:
        if self.at < len(self.items) and self.items[self.at][0] != "text" and self.items[self.at][1] in wanted:
            self.at += 1
            return self.items[self.at - 1][1]
        return None

    def name(self) -> str:
        kind, value = self.items[self.at] if self.at < len(self.items) else ("", "")
        if kind != "name":
            raise SyntaxError("a name is missing")
        self.at += 1
        return value

    def end(self, node: Node) -> Node:
        if self.at < len(self.items):
            raise SyntaxError(f"not expected: {self.items[self.at][1]!r}")
        return node

    def either(self) -> Node:
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> Node:
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> Node:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> Node:
        node = self.joined()
        while sign := self.take("==", "!=", "<=", ">=", "<", ">", "in", "not", "is"):
            if sign == "is":
                other = self.take("not")
                test = self.name()
                if test not in TESTS:
                    raise SyntaxError(f"no such test: {test}")
                node = ("not", ("is", test, node)) if other else ("is", test, node)
            elif sign == "not":
                if not self.take("in"):
                    raise SyntaxError("in is missing")
                node = ("not", ("in", node, self.joined()))
            else:
                node = (sign, node, self.joined())
        return node

    def joined(self) -> Node:
        node = self.added()
        while self.take("~"):
            node = ("~", node, self.added())
        return node

    def added(self) -> Node:
        node = self.rest_of()
        while sign := self.take("+", "-"):
            node = (sign, node, self.rest_of())
        return node

    def rest_of(self) -> Node:
        node = self.filtered()
        while self.take("%"):
            node = ("%", node, self.filtered())
        return node

    def filtered(self) -> Node:
        node = self.atom()
        while mark := self.take(".", "[", "|"):
            if mark == "|":
                node = ("filter", self.name(), node)
            elif mark == ".":
                node = ("item", node, ("constant", self.name()))
            else:
                node = self.picked(node)
        return node

    def picked(self, node: Node) -> Node:
        """Behind ``[``: a key, a place or a range."""
        nothing: Node = ("constant", None)
        low = nothing if self.take(":") else self.either()
        ranged = low is nothing or bool(self.take(":"))
        if not ranged:
            node = ("item", node, low)
        elif self.take("]"):
            return ("slice", node, low, nothing)
        else:
            node = ("slice", node, low, self.either())
        if not self.take("]"):
            raise SyntaxError("] is missing")
        return node

    def atom(self) -> Node:
        if self.take("("):
            node = self.either()
            if not self.take(")"):
                raise SyntaxError(") is missing")
            return node
        if self.at >= len(self.items):
            raise SyntaxError("an expression is missing")
        kind, value = self.items[self.at]
        self.at += 1
        if kind == "text":
            return ("constant", re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "number":
            return ("constant", int(value))
        if value == "-" and self.at < len(self.items) and self.items[self.at][0] == "number":
            self.at += 1
            return ("constant", -int(self.items[self.at - 1][1]))
        if kind == "name":
            return ("constant", CONSTANTS[value]) if value in CONSTANTS else ("name", value)
        raise SyntaxError(f"not expected: {value!r}")


def parse(source: str) -> Node:
    """The syntax tree: ``("block", node, …)``."""
    parts: list[tuple[str, str]] = []
    at = 0
    trim = False
    for m in TAGS.finditer(source):
        text = source[at:m.start()]
        text = text.lstrip() if trim else text
        parts.append(("text", text.rstrip() if m["s1"] or m["p1"] or m["c1"] else text))
        kind = next((k for k in ("statement", "print") if m[k] is not None), "comment")
        parts.append((kind, m[kind] if kind != "comment" else ""))
        trim, at = bool(m["s2"] or m["p2"] or m["c2"]), m.end()
    parts.append(("text", source[at:].lstrip() if trim else source[at:]))
    parts.reverse()

    def block(*ends: str) -> tuple[Node, str, str]:
        nodes: list[Node] = []
        while parts:
            kind, content = parts.pop()
            if kind == "text" and content:
                nodes.append(("print", ("constant", content)))
            elif kind == "print":
                nodes.append(("print", (e := _Expression(content)).end(e.either())))
            elif kind == "statement":
                word, rest = [*re.split(r"\s+", content, maxsplit=1), ""][:2]
                if word in ends:
                    return ("block", *nodes), word, rest
                nodes.append(statement(word, rest))
        if ends:
            raise SyntaxError(f"missing: {' or '.join(ends)}")
        return ("block", *nodes), "", ""

    def condition(rest: str) -> Node:
        test = (e := _Expression(rest)).end(e.either())
        body, word, more = block("elif", "else", "endif")
        other: Node = ("block",)
        if word == "elif":
            other = condition(more)
        elif word == "else":
            other = block("endif")[0]
        return ("if", test, body, other)

    def statement(word: str, rest: str) -> Node:
        if word == "if":
            return condition(rest)
        if word == "generation":
            return ("generation", block("endgeneration")[0])
        e = _Expression(re.sub(r"^(\w+)\s*=(?!=)", r"\1 ~ ", rest, count=1) if word == "set" else rest)
        if word == "set":
            name = e.name()
            if not e.take("~"):
                raise SyntaxError("= is missing")
            return ("set", name, e.end(e.either()))
        if word == "for":
            name = e.name()
            if not e.take("in"):
                raise SyntaxError("in is missing")
            values = e.end(e.joined())
            return ("for", name, values, block("endfor")[0])
        raise SyntaxError(f"no such statement: {word}")

    return block()[0]


# --- meaning

class Undefined:
    """What a name or key stands for that does not exist."""

    def __init__(self, name: Any):
        self.name = name

    def __bool__(self) -> bool:
        return False


class RenderError(ValueError):
    """A template asks for something its values do not have."""


def _there(value: Any) -> Any:
    if isinstance(value, Undefined):
        raise RenderError(f"undefined: {value.name}")
    return value


def _item(holder: Any, key: Any) -> Any:
    holder = _there(holder)
    if isinstance(holder, dict):
        return holder[key] if key in holder else Undefined(key)
    if isinstance(holder, (list, tuple, str)) and isinstance(key, int) and not isinstance(key, bool):
        return holder[key] if -len(holder) <= key < len(holder) else Undefined(key)
    return Undefined(key)


def _both(f: Callable[[Any, Any], Any]) -> Callable[[Any, Any], Any]:
    def checked(a: Any, b: Any) -> Any:
        try:
            return f(_there(a), _there(b))
        except TypeError as error:
            raise RenderError(str(error)) from error
    return checked


def _equal(a: Any, b: Any) -> bool:
    return not isinstance(a, Undefined) and not isinstance(b, Undefined) and a == b


TESTS: dict[str, Callable[[Any], bool]] = {
    "defined": lambda v: not isinstance(v, Undefined), "none": lambda v: v is None, "string": lambda v: isinstance(v, str)}
BINARY: dict[str, Callable[[Any, Any], Any]] = {
    "==": _equal, "!=": lambda a, b: not _equal(a, b), "in": _both(lambda a, b: a in b),
    "<": _both(lambda a, b: a < b), ">": _both(lambda a, b: a > b), "<=": _both(lambda a, b: a <= b), ">=": _both(lambda a, b: a >= b),
    "+": _both(lambda a, b: a + b), "-": _both(lambda a, b: a - b), "%": _both(lambda a, b: a % b if isinstance(a, int) else _no_format()),
    "~": lambda a, b: _text(a) + _text(b), "item": _item}


def _no_format() -> Any:
    raise TypeError("% is for whole numbers")


def _text(value: Any) -> str:
    value = _there(value)
    return "" if value is None else value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


def fold(node: Node, filters: dict[str, Callable]) -> Node:
    """The tree with every part that needs no name replaced by its value."""
    kind = node[0]
    if kind in ("constant", "name"):
        return node
    if kind == "filter" and node[1] not in filters:
        raise SyntaxError(f"no such filter: {node[1]}")
    parts = tuple(fold(x, filters) if isinstance(x, tuple) else x for x in node[1:])
    values = [x[1] for x in parts if isinstance(x, tuple) and x[0] == "constant"]
    if kind in BINARY and len(values) == 2 and kind != "item":
        try:
            return ("constant", BINARY[kind](*values))
        except (RenderError, ZeroDivisionError) as error:
            raise SyntaxError(str(error)) from error
    if kind == "is" and values:
        return ("constant", TESTS[parts[0]](values[0]))
    if kind == "not" and values:
        return ("constant", not values[0])
    if kind == "filter" and values:
        return ("constant", filters[parts[0]](values[0]))
    if kind in ("and", "or") and parts[0][0] == "constant":
        return parts[1] if bool(parts[0][1]) == (kind == "and") else parts[0]
    if kind == "if" and parts[0][0] == "constant":
        return parts[1] if parts[0][1] else parts[2]
    if kind == "print" and values:
        return ("print", ("constant", _text(values[0])))
    if kind == "block":
        flat: list[Node] = []
        for x in (y for part in parts for y in (part[1:] if part[0] == "block" else (part,))):
            if flat and x[0] == flat[-1][0] == "print" and x[1][0] == flat[-1][1][0] == "constant":
                flat[-1] = ("print", ("constant", flat[-1][1][1] + x[1][1]))
            else:
                flat.append(x)
        return ("block", *flat)
    return (kind, *parts)


class Output:
    """Printed pieces, their length so far, and the ranges under the loss mask."""

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def add(self, text: str) -> None:
        self.pieces.append(text)
        self.length += len(text)


def _value(node: Node, filters: dict[str, Callable]) -> Callable[[Env], Any]:
    kind = node[0]
    if kind == "constant":
        return lambda env, v=node[1]: v
    if kind == "name":
        return lambda env, n=node[1]: env[n] if n in env else Undefined(n)
    if kind == "filter":
        return lambda env, f=filters[node[1]], x=_value(node[2], filters): f(x(env))
    if kind == "not":
        return lambda env, x=_value(node[1], filters): not x(env)
    if kind == "is":
        return lambda env, f=TESTS[node[1]], x=_value(node[2], filters): f(x(env))
    if kind == "slice":
        return lambda env, x=[_value(p, filters) for p in node[1:]]: _there(x[0](env))[_there(x[1](env)):_there(x[2](env))]
    a, b = (_value(x, filters) for x in node[1:])
    if kind == "and":
        return lambda env: a(env) and b(env)
    if kind == "or":
        return lambda env: a(env) or b(env)
    return lambda env, f=BINARY[kind]: f(a(env), b(env))


def _step(node: Node, filters: dict[str, Callable]) -> Callable[[Env, Output], None]:
    kind = node[0]
    if kind == "print":
        if node[1][0] == "constant":
            return lambda env, out, t=node[1][1]: out.add(t)
        return lambda env, out, x=_value(node[1], filters): out.add(_text(x(env)))
    if kind == "set":
        def assign(env: Env, out: Output, name=node[1], x=_value(node[2], filters)) -> None:
            env[name] = x(env)
        return assign
    if kind == "if":
        test, yes, no = _value(node[1], filters), _step(node[2], filters), _step(node[3], filters)
        return lambda env, out: yes(env, out) if test(env) else no(env, out)
    if kind == "generation":
        def marked(env: Env, out: Output, body=_step(node[1], filters)) -> None:
            start = out.length
            body(env, out)
            out.spans.append((start, out.length))
        return marked
    if kind == "for":
        def loop(env: Env, out: Output, name=node[1], values=_value(node[2], filters), body=_step(node[3], filters)) -> None:
            items = list(_there(values(env)) or ())
            for k, item in enumerate(items):
                place = {"index": k + 1, "index0": k, "first": k == 0, "last": k == len(items) - 1, "length": len(items)}
                body(env | {name: item, "loop": place}, out)
        return loop
    steps = [_step(x, filters) for x in node[1:]]

    def block(env: Env, out: Output) -> None:
        for step in steps:
            step(env, out)
    return block


def compiled(source: str, controls: Iterable[str] = ()) -> Callable[[Env], tuple[str, list[tuple[int, int]]]]:
    """A function from a context to the rendered text and its generation ranges."""
    filters: dict[str, Callable] = {
        "escape": (lambda f: lambda v: f(_text(v)))(escaper(controls)), "trim": lambda v: _text(v).strip(),
        "upper": lambda v: _text(v).upper(), "lower": lambda v: _text(v).lower(), "length": lambda v: len(_there(v) or ())}
    run = _step(fold(parse(source), filters), filters)

    def render(context: Env) -> tuple[str, list[tuple[int, int]]]:
        out = Output()
        run(dict(context), out)
        return "".join(out.pieces), out.spans
    return render
