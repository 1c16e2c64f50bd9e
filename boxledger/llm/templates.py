"""A small sandboxed template language for conversations: syntax tree, constant folding, generator closures.

Statements: ``{{ expression }}``, ``{% if %} {% elif %} {% else %} {% endif %}``, ``{% for name in expression %} {% endfor %}``,
``{% set name = expression %}``, ``{% generation %} {% endgeneration %}``, ``{# comment #}``; a ``-`` inside a tag strips the white
space beside it.  Expressions: strings, whole numbers, ``true false none``, names, ``a.b`` and ``a['b']`` on mappings,
``== != < <= > >= in``, ``not and or``, ``+``, ``~``, ``x if c else y``, and the filters below.

The sandbox has no calls, no attributes of Python objects (access looks keys up in mappings only), no assignment outside the
template's own scope, and no loop without a finite input.  Loops pull their input one value at a time and a rendered
template is a generator, so a conversation of any length is rendered in bounded memory.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field


class TemplateError(ValueError):
    """The template is not valid, or asks for something outside the sandbox."""


class Mark:
    """A generation marker in the rendered stream."""

    def __init__(self, name: str):
        self.name = name


BEGIN, END = Mark("begin"), Mark("end")


def escape_text(value: str) -> str:
    """Break every ``<|`` with a backslash, and double backslashes; ``unescape`` is the inverse."""
    return value.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_line(value: str) -> str:
    """``escape_text`` that also keeps the value on one line."""
    return escape_text(value).replace("\n", "\\n")


def unescape(value: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], value, flags=re.S)


FILTERS: dict[str, Callable] = {
    "trim": lambda v: str(v).strip(), "upper": lambda v: str(v).upper(), "lower": lambda v: str(v).lower(),
    "length": len, "string": str, "escape_text": lambda v: escape_text(str(v)), "escape_line": lambda v: escape_line(str(v)),
}


@dataclass
class Const:
    value: object


@dataclass
class Name:
    name: str


@dataclass
class Get:
    of: object
    key: object


@dataclass
class Op:
    """An operation on evaluated operands; ``fold`` says whether equal operands always give equal results."""

    name: str
    args: list
    apply: Callable = field(repr=False)


@dataclass
class Choice:
    """``and``, ``or`` and conditional expressions: operands are evaluated only when needed."""

    kind: str
    args: list


@dataclass
class Text:
    value: str


@dataclass
class Print:
    value: object


@dataclass
class If:
    cases: list
    otherwise: list


@dataclass
class For:
    name: str
    over: object
    body: list


@dataclass
class Set:
    name: str
    value: object


@dataclass
class Generation:
    body: list


_TAG = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\})", re.S)
_TOKEN = re.compile(r"\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|"
                    r"(?P<sign>==|!=|<=|>=|[<>+~|.()\[\]=]))", re.S)
_COMPARE = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
            ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b, "not in": lambda a, b: a not in b}
_WORDS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
_RESERVED = {"if", "else", "elif", "for", "in", "not", "and", "or"}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
MAX_DEPTH = 50


def _plus(a, b):
    if isinstance(a, str) != isinstance(b, str):
        raise TemplateError("+ needs two texts or two numbers")
    return a + b


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"unexpected {source[at:at + 10]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        self.at = self.depth = 0

    def peek(self) -> str | None:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        return value if kind in ("sign", "name") else None

    def take(self, value: str) -> bool:
        if self.peek() == value:
            self.at += 1
            return True
        return False

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"expected {value!r}")

    def word(self) -> str:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        if kind != "name" or value in _RESERVED or value.startswith("_"):
            raise TemplateError(f"not a name: {value!r}")
        self.at += 1
        return value

    def whole(self):
        out = self.choice()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return out

    def choice(self):
        self.depth += 1
        if self.depth > MAX_DEPTH:
            raise TemplateError("expression is nested too deeply")
        value = self.either()
        if self.take("if"):
            test = self.either()
            value = Choice("if", [test, value, self.choice() if self.take("else") else Const("")])
        self.depth -= 1
        return value

    def either(self):
        left = self.both()
        while self.take("or"):
            left = Choice("or", [left, self.both()])
        return left

    def both(self):
        left = self.inverse()
        while self.take("and"):
            left = Choice("and", [left, self.inverse()])
        return left

    def inverse(self):
        turns = 0
        while self.take("not"):
            turns += 1
        value = self.compare()
        for _ in range(min(turns, 2 + turns % 2)):
            value = Op("not", [value], lambda a: not a)
        return value

    def compare(self):
        left = self.sum()
        sign = self.peek()
        if sign == "not" and self.at + 1 < len(self.tokens) and self.tokens[self.at + 1][1] == "in":
            self.at += 2
            return Op("not in", [left, self.sum()], _COMPARE["not in"])
        if sign in _COMPARE:
            self.at += 1
            return Op(sign, [left, self.sum()], _COMPARE[sign])
        return left

    def sum(self):
        left = self.filtered()
        while (sign := self.peek()) in ("+", "~"):
            self.at += 1
            left = Op(sign, [left, self.filtered()], _plus if sign == "+" else lambda a, b: f"{shown(a)}{shown(b)}")
        return left

    def filtered(self):
        value = self.access()
        while self.take("|"):
            name = self.word()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            value = Op(name, [value], FILTERS[name])
        return value

    def access(self):
        value = self.atom()
        while True:
            if self.take("."):
                value = Get(value, Const(self.word()))
            elif self.take("["):
                value = Get(value, self.choice())
                self.need("]")
            else:
                return value

    def atom(self):
        if self.take("("):
            value = self.choice()
            self.need(")")
            return value
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        if kind == "text":
            self.at += 1
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "number":
            self.at += 1
            return Const(int(value))
        if value in _WORDS:
            self.at += 1
            return Const(_WORDS[value])
        return Name(self.word())


def shown(value) -> str:
    return "" if value is None else str(value)


def parse(source: str) -> list:
    """The syntax tree of a template."""
    parts = _TAG.split(source)
    for k in range(1, len(parts), 2):
        if parts[k][2:3] == "-":
            parts[k - 1] = parts[k - 1].rstrip()
        if parts[k][-3:-2] == "-":
            parts[k + 1] = parts[k + 1].lstrip()
    open_blocks: list[tuple] = [(None, [], None)]
    for k, part in enumerate(parts):
        body = open_blocks[-1][1]
        if k % 2 == 0:
            if "{%" in part or "{{" in part:
                raise TemplateError("a tag is not closed")
            if part:
                body.append(Text(part))
            continue
        if part.startswith("{#"):
            continue
        inner = part[2:-2].strip("-").strip()
        if part.startswith("{{"):
            body.append(Print(_Expression(inner).whole()))
            continue
        word, _, rest = inner.partition(" ")
        kind, _, node = open_blocks[-1]
        if len(open_blocks) > MAX_DEPTH:
            raise TemplateError("blocks are nested too deeply")
        if word == "if":
            block: list = []
            node = If([(_Expression(rest).whole(), block)], [])
            body.append(node)
            open_blocks.append(("if", block, node))
        elif word == "elif" and kind == "if":
            block = []
            node.cases.append((_Expression(rest).whole(), block))
            open_blocks[-1] = ("if", block, node)
        elif word == "else" and kind == "if":
            open_blocks[-1] = ("else", node.otherwise, node)
        elif word == "for":
            found = re.fullmatch(r"([A-Za-z]\w*)\s+in\s+(.+)", rest, re.S)
            if not found or found[1] in _RESERVED:
                raise TemplateError(f"not a loop: {rest!r}")
            node = For(found[1], _Expression(found[2]).whole(), [])
            body.append(node)
            open_blocks.append(("for", node.body, node))
        elif word == "set":
            name, equals, value = rest.partition("=")
            if not equals or not re.fullmatch(r"[A-Za-z]\w*", name.strip()):
                raise TemplateError(f"not an assignment: {rest!r}")
            body.append(Set(name.strip(), _Expression(value).whole()))
        elif word == "generation":
            if any(b[0] == "generation" for b in open_blocks):
                raise TemplateError("generation blocks cannot be nested")
            node = Generation([])
            body.append(node)
            open_blocks.append(("generation", node.body, node))
        elif (word, kind) in (("endif", "if"), ("endif", "else"), ("endfor", "for"), ("endgeneration", "generation")):
            open_blocks.pop()
        else:
            raise TemplateError(f"unexpected {word!r}")
    if len(open_blocks) > 1:
        raise TemplateError(f"{open_blocks[-1][0]} is not closed")
    return open_blocks[0][1]


def fold(node):
    """The same tree with constant expressions evaluated, dead branches removed and neighbouring texts joined."""
    if isinstance(node, list):
        out: list = []
        for item in map(fold, node):
            for x in item if isinstance(item, list) else [item]:
                if isinstance(x, Text) and out and isinstance(out[-1], Text):
                    out[-1] = Text(out[-1].value + x.value)
                elif not (isinstance(x, Text) and not x.value):
                    out.append(x)
        return out
    if isinstance(node, Op):
        args = [fold(a) for a in node.args]
        if all(isinstance(a, Const) for a in args):
            try:
                return Const(node.apply(*[a.value for a in args]))
            except TypeError as wrong:
                raise TemplateError(str(wrong)) from None
        return Op(node.name, args, node.apply)
    if isinstance(node, Choice):
        args = [fold(a) for a in node.args]
        if isinstance(args[0], Const):
            first = bool(args[0].value)
            return {"and": args[1] if first else args[0], "or": args[0] if first else args[1], "if": args[1] if first else args[-1]}[node.kind]
        return Choice(node.kind, args)
    if isinstance(node, Get):
        return Get(fold(node.of), fold(node.key))
    if isinstance(node, Print):
        value = fold(node.value)
        return Text(shown(value.value)) if isinstance(value, Const) else Print(value)
    if isinstance(node, If):
        cases = []
        for test, body in node.cases:
            test = fold(test)
            if isinstance(test, Const) and test.value:
                return If(cases, fold(body)) if cases else fold(body)
            if not isinstance(test, Const):
                cases.append((test, fold(body)))
        return If(cases, fold(node.otherwise)) if cases else fold(node.otherwise)
    if isinstance(node, For):
        return For(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Set):
        return Set(node.name, fold(node.value))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    return node


def _value(node) -> Callable[[dict], object]:
    """A closure that evaluates an expression in a scope."""
    if isinstance(node, Const):
        constant = node.value
        return lambda scope: constant
    if isinstance(node, Name):
        name = node.name

        def look(scope):
            if name not in scope:
                raise TemplateError(f"no value {name!r}")
            return scope[name]

        return look
    if isinstance(node, Get):
        of, key = _value(node.of), _value(node.key)

        def get(scope):
            value = of(scope)
            if not isinstance(value, Mapping):
                raise TemplateError("only mappings have keys")
            return value.get(key(scope))

        return get
    args = [_value(a) for a in node.args]
    if isinstance(node, Choice):
        if node.kind == "and":
            return lambda scope: args[0](scope) and args[1](scope)
        if node.kind == "or":
            return lambda scope: args[0](scope) or args[1](scope)
        return lambda scope: args[1](scope) if args[0](scope) else args[2](scope)
    apply = node.apply
    if len(args) == 1:
        only = args[0]
        return lambda scope: apply(only(scope))
    left, right = args
    return lambda scope: apply(left(scope), right(scope))


def _block(nodes: list) -> Callable[[dict], Iterator]:
    """A closure that renders a block as a generator of texts and markers."""
    steps = [_step(n) for n in nodes]

    def render(scope):
        for step in steps:
            yield from step(scope)

    return render


def _step(node) -> Callable[[dict], Iterator]:
    if isinstance(node, Text):
        fixed = (node.value,)
        return lambda scope: fixed
    if isinstance(node, Print):
        value = _value(node.value)
        return lambda scope: (shown(value(scope)),)
    if isinstance(node, Set):
        value, name = _value(node.value), node.name

        def assign(scope):
            scope[name] = value(scope)
            return ()

        return assign
    if isinstance(node, Generation):
        body = _block(node.body)

        def generation(scope):
            yield BEGIN
            yield from body(scope)
            yield END

        return generation
    if isinstance(node, If):
        cases = [(_value(test), _block(body)) for test, body in node.cases]
        otherwise = _block(node.otherwise)

        def branch(scope):
            for test, body in cases:
                if test(scope):
                    return body(scope)
            return otherwise(scope)

        return branch
    over, body, name = _value(node.over), _block(node.body), node.name

    def loop(scope):
        values = over(scope)
        if isinstance(values, (str, Mapping)) or not hasattr(values, "__iter__"):
            raise TemplateError("for needs a list")
        inner = dict(scope)
        for index, value in enumerate(values):
            inner[name] = value
            inner["loop"] = {"index": index + 1, "index0": index, "first": index == 0}
            yield from body(inner)

    return loop


def compile_template(source: str) -> Callable[[Mapping], Iterator]:
    """A function from a context to a generator of texts and of ``BEGIN`` and ``END`` markers."""
    render = _block(fold(parse(source)))
    return lambda context: render(dict(context))
