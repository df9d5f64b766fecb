"""A small template language for conversations, compiled to Python closures.

Statements: text, `{{ expression }}`, `{% for x in e %}`, `{% if e %}`, `{% elif e %}`,
`{% else %}`, `{% set x = e %}`, `{% generation %}` with their ends. Expressions: strings,
whole numbers, true, false, none, names, `a.key`, `a['key']`, `==`, `!=`, `in`, `and`, `or`,
`not`, `~` and `+` (text), parentheses and the filters in FILTERS. A template can look up
keys of what it is given and nothing else: it has no calls and no Python attributes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import partial
from typing import Any

#: Signs that control strings are made of, and what stands for them inside a text.
ESCAPES = {"&": "&amp;", "<": "&lt;", "[": "&#91;", "]": "&#93;"}
_SIGN = str.maketrans(ESCAPES)
_ESCAPED = re.compile("|".join(map(re.escape, ESCAPES.values())))
_MEANING = {v: k for k, v in ESCAPES.items()}


def escape(text: str) -> str:
    return text.translate(_SIGN)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _MEANING[m[0]], text) if "&" in text else text


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape,
    "trim": str.strip,
    "upper": str.upper,
    "lower": str.lower,
}


class TemplateError(ValueError):
    """The template does not parse, or looks up what it is not given."""


# --- the tree ------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Key:
    of: Any
    key: Any


@dataclass(frozen=True)
class Call:
    """An operator or filter applied to its operands."""

    op: str
    args: tuple


@dataclass(frozen=True)
class Print:
    value: Any


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class If:
    test: Any
    body: tuple
    otherwise: tuple


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


# --- parsing -------------------------------------------------------------------------

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%-?(.*?)-?%\}", re.DOTALL)
_TOKEN = re.compile(
    r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)"""
    r"""|(?P<op>==|!=|[\[\].()|~+]))"""
)
_CONSTANTS = {"true": True, "false": False, "none": None}
_WORDS = {"and", "or", "not", "in"}
_LETTERS = {"n": "\n", "t": "\t"}


class _Expression:
    """Recursive descent, loosest first: or, and, not, comparison, joining, filter, lookup."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        while source[at:].strip():
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()

    def whole(self):
        out = self.either()
        if self.tokens:
            raise TemplateError(f"unexpected {self.tokens[0][1]!r}")
        return out

    def take(self, *wanted: str) -> str | None:
        if self.tokens and self.tokens[0][0] != "str" and self.tokens[0][1] in wanted:
            return self.tokens.pop(0)[1]
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} is missing")

    def name(self) -> str:
        if not self.tokens or self.tokens[0][0] != "name" or self.tokens[0][1] in _WORDS:
            raise TemplateError("a name is missing")
        return self.tokens.pop(0)[1]

    def chain(self, below: Callable, *ops: str):
        out = below()
        while op := self.take(*ops):
            out = Call(op, (out, below()))
        return out

    def either(self):
        return self.chain(self.both, "or")

    def both(self):
        return self.chain(self.inverse, "and")

    def inverse(self):
        return Call("not", (self.inverse(),)) if self.take("not") else self.compared()

    def compared(self):
        return self.chain(self.joined, "==", "!=", "in")

    def joined(self):
        return self.chain(self.filtered, "~", "+")

    def filtered(self):
        out = self.looked_up()
        while self.take("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            out = Call(name, (out,))
        return out

    def looked_up(self):
        out = self.single()
        while found := self.take(".", "["):
            if found == ".":
                out = Key(out, Const(self.name()))
            else:
                out = Key(out, self.either())
                self.need("]")
        return out

    def single(self):
        if self.take("("):
            out = self.either()
            self.need(")")
            return out
        if not self.tokens:
            raise TemplateError("an expression is missing")
        kind, text = self.tokens.pop(0)
        if kind == "str":
            return Const(re.sub(r"\\(.)", lambda m: _LETTERS.get(m[1], m[1]), text[1:-1]))
        if kind == "int":
            return Const(int(text))
        if kind == "name" and text not in _WORDS:
            return Const(_CONSTANTS[text]) if text in _CONSTANTS else Name(text)
        raise TemplateError(f"unexpected {text!r}")


def _expression(source: str):
    return _Expression(source).whole()


def parse(source: str) -> tuple:
    """The statements of a template."""
    parts, at = [], 0
    for tag in _TAG.finditer(source):
        if tag.start() > at:
            parts.append(("text", source[at : tag.start()]))
        parts.append(("print", tag[1]) if tag[1] is not None else ("tag", tag[2].strip()))
        at = tag.end()
    if at < len(source):
        parts.append(("text", source[at:]))
    parts.reverse()
    body, end = _body(parts)
    if end:
        raise TemplateError(f"unexpected {end!r}")
    return body


def _body(parts: list) -> tuple[tuple, str]:
    """Statements up to a tag that ends or divides a block, and that tag."""
    out = []
    while parts:
        kind, text = parts.pop()
        word, _, rest = text.partition(" ")
        if kind == "text":
            out.append(Print(Const(text)))
        elif kind == "print":
            out.append(Print(_expression(text)))
        elif word == "for":
            name, _, over = rest.strip().partition(" in ")
            if not name.isidentifier():
                raise TemplateError(f"cannot read {text!r}")
            out.append(For(name, _expression(over), _until(parts, "endfor")))
        elif word == "if":
            out.append(_if(parts, rest))
        elif word == "set":
            name, sign, value = rest.partition("=")
            if not sign or not name.strip().isidentifier():
                raise TemplateError(f"cannot read {text!r}")
            out.append(Set(name.strip(), _expression(value)))
        elif word == "generation":
            out.append(Generation(_until(parts, "endgeneration")))
        else:
            return tuple(out), text
    return tuple(out), ""


def _until(parts: list, wanted: str) -> tuple:
    body, end = _body(parts)
    if end != wanted:
        raise TemplateError(f"{wanted!r} is missing")
    return body


def _if(parts: list, test: str) -> If:
    body, end = _body(parts)
    if end.startswith("elif "):
        return If(_expression(test), body, (_if(parts, end[5:]),))
    if end == "else":
        return If(_expression(test), body, _until(parts, "endif"))
    if end != "endif":
        raise TemplateError("'endif' is missing")
    return If(_expression(test), body, ())


# --- folding -------------------------------------------------------------------------


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _apply(op: str, args: list) -> Any:
    if op in FILTERS:
        return FILTERS[op](_text(args[0]))
    if op == "not":
        return not args[0]
    a, b = args
    if op == "==":
        return a == b
    if op == "!=":
        return a != b
    if op == "in":
        return a in (b or ())
    return _text(a) + _text(b)


def fold(node: Any) -> Any:
    """An expression with its constant parts worked out."""
    if isinstance(node, Key):
        return Key(fold(node.of), fold(node.key))
    if not isinstance(node, Call):
        return node
    args = [fold(x) for x in node.args]
    if node.op in ("and", "or"):
        if isinstance(args[0], Const):
            return args[bool(args[0].value) == (node.op == "and")]
    elif all(isinstance(x, Const) for x in args):
        return Const(_apply(node.op, [x.value for x in args]))
    return Call(node.op, tuple(args))


def fold_body(body: Iterable) -> tuple:
    """Statements without dead branches and with neighbouring constant texts joined."""
    out: list = []
    for node in body:
        if isinstance(node, Print):
            new = [Print(fold(node.value))]
        elif isinstance(node, If):
            test = fold(node.test)
            if isinstance(test, Const):
                new = list(fold_body(node.body if test.value else node.otherwise))
            else:
                new = [If(test, fold_body(node.body), fold_body(node.otherwise))]
        elif isinstance(node, For):
            new = [For(node.name, fold(node.over), fold_body(node.body))]
        elif isinstance(node, Generation):
            new = [Generation(fold_body(node.body))]
        else:
            new = [Set(node.name, fold(node.value))]
        for x in new:
            if _constant(x) and out and _constant(out[-1]):
                out[-1] = Print(Const(_text(out[-1].value.value) + _text(x.value.value)))
            else:
                out.append(x)
    return tuple(out)


def _constant(node: Any) -> bool:
    return isinstance(node, Print) and isinstance(node.value, Const)


# --- closures ------------------------------------------------------------------------

#: Gets each text as it is made, and whether it lies in a generation block.
Emit = Callable[[str, bool], None]


def _value(node: Any) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        return lambda env, v=node.value: v
    if isinstance(node, Name):

        def name(env, n=node.name):
            if n not in env:
                raise TemplateError(f"{n!r} is not given")
            return env[n]

        return name
    if isinstance(node, Key):

        def key(env, of=_value(node.of), by=_value(node.key)):
            found = of(env)
            if not isinstance(found, Mapping):
                raise TemplateError("only keys of mappings can be looked up")
            return found.get(by(env))

        return key
    args = [_value(x) for x in node.args]
    if node.op == "and":
        return lambda env: args[0](env) and args[1](env)
    if node.op == "or":
        return lambda env: args[0](env) or args[1](env)
    return lambda env, op=node.op: _apply(op, [f(env) for f in args])


def _run(body: tuple) -> Callable[[dict, Emit, bool], None]:
    steps = [_step(node) for node in body]

    def run(env, emit, inside):
        for step in steps:
            step(env, emit, inside)

    return run


def _step(node: Any) -> Callable[[dict, Emit, bool], None]:
    if isinstance(node, Print):
        value = _value(node.value)
        return lambda env, emit, inside: emit(_text(value(env)), inside)
    if isinstance(node, Set):
        value = _value(node.value)
        return lambda env, emit, inside: env.update({node.name: value(env)})
    if isinstance(node, Generation):
        body = _run(node.body)
        return lambda env, emit, inside: body(env, emit, True)
    if isinstance(node, If):
        test, yes, no = _value(node.test), _run(node.body), _run(node.otherwise)
        return lambda env, emit, inside: (yes if test(env) else no)(env, emit, inside)
    over, body = _value(node.over), _run(node.body)

    def loop(env, emit, inside):
        for item in over(env) or ():
            body({**env, node.name: item}, emit, inside)

    return loop


def compile_template(source: str) -> Callable[..., None]:
    """`render(emit, **given)`: calls `emit` with every text of the rendering, in order.

    A loop takes its items one by one, so a conversation given as an iterator is rendered
    without being held.
    """
    run = _run(fold_body(parse(source)))

    def render(emit: Emit, **given: Any) -> None:
        run(dict(given), emit, False)

    return partial(render)
