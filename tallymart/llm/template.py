"""A small sandboxed template language, compiled to Python closures.

Syntax: ``{{ expression }}``, ``{% if %} {% elif %} {% else %} {% endif %}``,
``{% for name in expression %} {% endfor %}``, ``{% generation %} {% endgeneration %}``
and ``{# comment #}``.  Expressions have text and whole-number constants, names,
``a.b`` and ``a['b']``, ``== != < <= > >= in + not and or``, ``x if c else y`` and the
filters ``escape lower upper trim length``.

A template sees only the mappings, texts and numbers it is given: a dot reads a
key of a mapping and never an attribute of an object, nothing can be called, and
loops run over given sequences only.  What marks a generation is returned beside
the text, so a loss mask needs no search in the output.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any


class TemplateError(ValueError):
    """The template cannot be read, or asks for something that is not there."""


# ------------------------------------------------------------------ syntax tree


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
class Filter:
    of: Any
    name: str


@dataclass(frozen=True)
class Unary:
    of: Any


@dataclass(frozen=True)
class Binary:
    sign: str
    left: Any
    right: Any


@dataclass(frozen=True)
class Choice:
    test: Any
    yes: Any
    no: Any


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Output:
    of: Any


@dataclass(frozen=True)
class If:
    test: Any
    yes: tuple
    no: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


# ------------------------------------------------------------------ parser

TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.DOTALL)
TOKEN = re.compile(
    r"\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)"
    r"|(?P<sign>==|!=|<=|>=|[-+<>.|()\[\]]))"
)
ESCAPES = {"n": "\n", "t": "\t"}
COMPARE = ("==", "!=", "<", "<=", ">", ">=", "in")
WORDS = {"and", "or", "not", "in", "if", "else", "true", "false", "none"}


class _Expression:
    """Recursive descent over one expression's tokens, the loosest operator first."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            found = TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((found.lastgroup, found.group(found.lastgroup)))
            at = found.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) else None

    def take(self, *wanted: str) -> str | None:
        kind = self.tokens[self.at][0] if self.at < len(self.tokens) else None
        if kind in ("sign", "name") and self.peek() in wanted:
            self.at += 1
            return wanted[wanted.index(self.tokens[self.at - 1][1])]
        return None

    def need(self, sign: str) -> None:
        if not self.take(sign):
            raise TemplateError(f"{sign!r} is missing before {self.peek()!r}")

    def whole(self):
        out = self.choice()
        if self.peek() is not None:
            raise TemplateError(f"{self.peek()!r} is not expected")
        return out

    def choice(self):
        yes = self.chain("or")
        if not self.take("if"):
            return yes
        test = self.chain("or")
        self.need("else")
        return Choice(test, yes, self.choice())

    def chain(self, sign: str):
        below = (lambda: self.chain("and")) if sign == "or" else self.negation
        left = below()
        while self.take(sign):
            left = Binary(sign, left, below())
        return left

    def negation(self):
        return Unary(self.negation()) if self.take("not") else self.comparison()

    def comparison(self):
        left = self.sum()
        sign = self.take(*COMPARE)
        return Binary(sign, left, self.sum()) if sign else left

    def sum(self):
        left = self.filtered()
        while self.take("+"):
            left = Binary("+", left, self.filtered())
        return left

    def filtered(self):
        out = self.value()
        while True:
            if self.take("."):
                out = Key(out, Const(self.word()))
            elif self.take("["):
                out = Key(out, self.choice())
                self.need("]")
            elif self.take("|"):
                name = self.word()
                if name not in FILTERS and name != "escape":
                    raise TemplateError(f"no filter {name!r}")
                out = Filter(out, name)
            else:
                return out

    def word(self) -> str:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        if kind != "name":
            raise TemplateError(f"a name is missing before {value!r}")
        self.at += 1
        return value

    def value(self):
        if self.take("("):
            out = self.choice()
            self.need(")")
            return out
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        self.at += 1
        if kind == "text":
            return Const(re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.DOTALL))
        if kind == "number":
            return Const(int(value))
        if kind == "name" and value in ("true", "false", "none"):
            return Const({"true": True, "false": False, "none": None}[value])
        if kind == "name" and value not in WORDS:
            return Name(value)
        raise TemplateError(f"a value is missing before {value!r}")


def parse(source: str) -> tuple:
    """The template's syntax tree."""
    parts: list[tuple[str, str]] = []
    at = 0
    for tag in TAG.finditer(source):
        if tag.start() > at:
            parts.append(("text", source[at : tag.start()]))
        if tag[1] is not None:
            parts.append(("output", tag[1].strip()))
        elif tag[2] is not None:
            parts.append(("tag", tag[2].strip()))
        at = tag.end()
    if at < len(source):
        parts.append(("text", source[at:]))
    parts.reverse()
    body, end = _body(parts, ())
    return body


def _body(parts: list, ends: tuple[str, ...]) -> tuple[tuple, str]:
    out = []
    while parts:
        kind, text = parts.pop()
        if kind == "text":
            out.append(Text(text))
        elif kind == "output":
            out.append(Output(_Expression(text).whole()))
        else:
            word, _, rest = text.partition(" ")
            if word in ends:
                return tuple(out), text
            out.append(_block(word, rest, parts))
    if ends:
        raise TemplateError(f"{ends[-1]!r} is missing")
    return tuple(out), ""


def _block(word: str, rest: str, parts: list):
    if word == "if":
        yes, end = _body(parts, ("elif", "else", "endif"))
        if end.startswith("elif"):
            no = (_block("if", end[4:], parts),)
        else:
            no = _body(parts, ("endif",))[0] if end == "else" else ()
        return If(_Expression(rest).whole(), yes, no)
    if word == "for":
        name, found, over = rest.strip().partition(" in ")
        if not found or not name.strip().isidentifier() or name.strip() in WORDS:
            raise TemplateError(f"cannot read the loop {rest!r}")
        return For(name.strip(), _Expression(over).whole(), _body(parts, ("endfor",))[0])
    if word == "generation":
        return Generation(_body(parts, ("endgeneration",))[0])
    raise TemplateError(f"no tag {word!r}")


# ------------------------------------------------------------------ folding

FILTERS: dict[str, Callable] = {"lower": str.lower, "upper": str.upper, "trim": str.strip, "length": len}
SIGNS = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt,
    ">=": operator.ge, "in": lambda a, b: a in b, "+": operator.add,
}


def fold(node, escape: Callable[[str], str]):
    """The node with all that is constant worked out and neighbouring texts joined."""
    if isinstance(node, tuple):
        out: list = []
        for child in node:
            folded = fold(child, escape)
            for x in folded if isinstance(folded, tuple) else (folded,):
                if isinstance(x, Text) and out and isinstance(out[-1], Text):
                    out[-1] = Text(out[-1].text + x.text)
                elif x != Text(""):
                    out.append(x)
        return tuple(out)
    if isinstance(node, Output):
        of = fold(node.of, escape)
        return Text(_shown(of.value)) if isinstance(of, Const) else Output(of)
    if isinstance(node, If):
        test = fold(node.test, escape)
        if isinstance(test, Const):
            return fold(node.yes if test.value else node.no, escape)
        return If(test, fold(node.yes, escape), fold(node.no, escape))
    if isinstance(node, For):
        return For(node.name, fold(node.over, escape), fold(node.body, escape))
    if isinstance(node, Generation):
        return Generation(fold(node.body, escape))
    if isinstance(node, Filter):
        of = fold(node.of, escape)
        if isinstance(of, Const):
            return Const(_filter(node.name, escape)(of.value))
        return Filter(of, node.name)
    if isinstance(node, Unary):
        of = fold(node.of, escape)
        return Const(not of.value) if isinstance(of, Const) else Unary(of)
    if isinstance(node, Choice):
        test = fold(node.test, escape)
        if isinstance(test, Const):
            return fold(node.yes if test.value else node.no, escape)
        return Choice(test, fold(node.yes, escape), fold(node.no, escape))
    if isinstance(node, Binary):
        left, right = fold(node.left, escape), fold(node.right, escape)
        if node.sign in ("and", "or") and isinstance(left, Const):
            return right if bool(left.value) == (node.sign == "and") else left
        if isinstance(left, Const) and isinstance(right, Const):
            return Const(_apply(node.sign, left.value, right.value))
        return Binary(node.sign, left, right)
    if isinstance(node, Key):
        return Key(fold(node.of, escape), fold(node.key, escape))
    return node


def _shown(value) -> str:
    if value is None:
        return ""
    if isinstance(value, (str, int)):
        return str(value)
    raise TemplateError("only texts and numbers can be written")


def _filter(name: str, escape: Callable[[str], str]) -> Callable:
    call = escape if name == "escape" else FILTERS[name]
    return lambda value: call("" if value is None else value if name == "length" else _shown(value))


def _apply(sign: str, left, right):
    try:
        return SIGNS[sign](left, right)
    except TypeError as error:
        raise TemplateError(f"{sign!r} does not fit its values") from error


# ------------------------------------------------------------------ closures

Pieces = Iterator[tuple[str, bool]]


def _value(node, escape) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        return lambda scope: node.value
    if isinstance(node, Name):

        def name(scope):
            if node.name not in scope:
                raise TemplateError(f"no name {node.name!r}")
            return scope[node.name]

        return name
    if isinstance(node, Key):
        of, key = _value(node.of, escape), _value(node.key, escape)

        def get(scope):
            value = of(scope)
            if not isinstance(value, Mapping):
                raise TemplateError("only mappings have keys")
            return value.get(key(scope))

        return get
    if isinstance(node, Filter):
        of, call = _value(node.of, escape), _filter(node.name, escape)
        return lambda scope: call(of(scope))
    if isinstance(node, Unary):
        of = _value(node.of, escape)
        return lambda scope: not of(scope)
    if isinstance(node, Choice):
        test, yes, no = (_value(x, escape) for x in (node.test, node.yes, node.no))
        return lambda scope: yes(scope) if test(scope) else no(scope)
    left, right, sign = _value(node.left, escape), _value(node.right, escape), node.sign
    if sign == "and":
        return lambda scope: left(scope) and right(scope)
    if sign == "or":
        return lambda scope: left(scope) or right(scope)
    return lambda scope: _apply(sign, left(scope), right(scope))


def _block_closure(body: tuple, escape, marked: bool) -> Callable[[dict], Pieces]:
    steps = [_step(node, escape, marked) for node in body]

    def run(scope: dict) -> Pieces:
        for step in steps:
            yield from step(scope)

    return run


def _step(node, escape, marked: bool) -> Callable[[dict], Pieces]:
    if isinstance(node, Text):
        piece = ((node.text, marked),)
        return lambda scope: piece
    if isinstance(node, Output):
        of = _value(node.of, escape)
        return lambda scope: ((_shown(of(scope)), marked),)
    if isinstance(node, If):
        test = _value(node.test, escape)
        yes, no = _block_closure(node.yes, escape, marked), _block_closure(node.no, escape, marked)
        return lambda scope: yes(scope) if test(scope) else no(scope)
    if isinstance(node, Generation):
        return _block_closure(node.body, escape, True)
    over, body = _value(node.over, escape), _block_closure(node.body, escape, marked)

    def loop(scope: dict) -> Pieces:
        for i, item in enumerate(over(scope)):
            inner = {**scope, node.name: item, "loop": {"index": i + 1, "index0": i, "first": i == 0}}
            yield from body(inner)

    return loop


class Controls:
    """Control strings of a format, and texts in which none of them occurs."""

    def __init__(self, strings: tuple[str, ...]):
        if any(len(s) < 2 or "\\" in s for s in strings):
            raise TemplateError("a control string has two characters or more and no backslash")
        self.strings = strings
        longest_first = "|".join(map(re.escape, sorted(strings, key=len, reverse=True)))
        self.starts = re.compile(rf"\\|(?=(?:{longest_first}))." if strings else r"\\", re.DOTALL)
        #: What a reader steps over: an escaped character, a control string, or neither.
        self.reader = re.compile(rf"(?P<escaped>\\.)|(?P<control>{longest_first})", re.DOTALL)

    def escape(self, text: str) -> str:
        """A backslash is doubled, and one is put after the first character of each control string."""
        return self.starts.sub(lambda m: m[0] + "\\", text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def compile_template(source: str, controls: Controls) -> Callable[..., Pieces]:
    """A function of the template's names that yields (text, is it generated) in order.

    Sequences are read as the output is asked for, so a long conversation is
    never held as a whole.
    """
    run = _block_closure(fold(parse(source), controls.escape), controls.escape, False)
    return lambda **names: run(names)
