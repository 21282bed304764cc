"""A small sandboxed template language, compiled to Python closures.

    {{ expression }}   {% for x in expression %}..{% endfor %}   {% if e %}..{% elif e %}..{% else %}..{% endif %}
    {% set name = e %}   {% generation %}..{% endgeneration %}   {# comment #}   a - inside a tag's end trims white space there

Expressions: names, string, integer, true, false and none literals, x.key and x[e] (items of mappings and
sequences only), filters ``x | name`` or ``x | name(e, ...)`` from a fixed table, ``+ - * %``, ``~`` (join as text),
comparisons, ``in``, ``not``, ``and``, ``or`` and parentheses. Nothing else can be said: there are no
attribute look-ups, no calls but those of filters, no imports, and names come from the given variables.

parse() makes a syntax tree of tuples, fold() replaces constant parts by their values, joins texts and drops
branches that are never taken, and generate() turns the tree into closures. Rendering yields (text, generated)
pieces, generated being whether a generation block is around them; a loop pulls its items one at a time, so a
conversation of any length renders in bounded memory.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import Any

Tree = tuple
TAG = re.compile(r"\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\}", re.S)
TOKEN = re.compile(r"""\s*(?:(?P<int>\d+)|(?P<str>'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-+*%~<>|.,()\[\]=]))""", re.S)
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
WORDS = {"and", "or", "not", "in", "true", "false", "none"}


class TemplateError(ValueError):
    pass


#: Control strings begin with one of these; behind each of them in a text the mark goes.
MARK = "\\"


def escape(text: str) -> str:
    """text without control strings: they begin with < or [, which are never left unmarked."""
    return re.sub(r"[<\[\\]", lambda m: m[0] + MARK, text)


def escape_line(text: str) -> str:
    """escape(text) in one line: [n, which escape never makes, stands for a newline."""
    return escape(text).replace("\n", "[n")


def unescape(text: str) -> str:
    return re.sub(r"([<\[\\])\\|\[n", lambda m: m[1] or "\n", text)


FILTERS: dict[str, Callable] = {
    "escape": lambda x: escape(_text(x)), "escape_line": lambda x: escape_line(_text(x)), "trim": lambda x: _text(x).strip(), "upper": lambda x: _text(x).upper(), "lower": lambda x: _text(x).lower(),
    "length": len, "default": lambda x, y: y if x is None else x, "string": lambda x: _text(x), "join": lambda x, s="": s.join(map(_text, x)),
}
BINARY = {"+": operator.add, "-": operator.sub, "*": operator.mul, "%": operator.mod, "==": operator.eq, "!=": operator.ne, "<": operator.lt, ">": operator.gt, "<=": operator.le, ">=": operator.ge}
#: Products of constants and of values may not grow beyond this many characters.
MAX_TEXT = 1 << 20


def _text(x: Any) -> str:
    return "" if x is None else "true" if x is True else "false" if x is False else str(x)


def _binary(op: str, a: Any, b: Any) -> Any:
    if op == "~":
        return _text(a) + _text(b)
    if op == "in":
        return a in b
    if op == "%" and isinstance(a, str):
        raise TemplateError("% is for numbers")
    if op == "*" and (not isinstance(a, int) or not isinstance(b, int)):
        size, by = (len(a), b) if isinstance(a, (str, list, tuple)) else (len(b), a)
        if size * by > MAX_TEXT:
            raise TemplateError("too long a product")
    return BINARY[op](a, b)


def _item(x: Any, key: Any) -> Any:
    if isinstance(x, Mapping):
        return x.get(key)
    if isinstance(x, (list, tuple, str)) and isinstance(key, int):
        return x[key] if -len(x) <= key < len(x) else None
    raise TemplateError(f"no item {key!r}")


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, *texts: str) -> str | None:
        kind, text = self.peek()
        if kind != "str" and text in texts:
            self.at += 1
            return text
        return None

    def need(self, text: str) -> None:
        if not self.take(text):
            raise TemplateError(f"{text!r} expected before {self.peek()[1]!r}")

    def name(self) -> str:
        kind, text = self.peek()
        if kind != "name" or text in WORDS:
            raise TemplateError(f"a name expected before {text!r}")
        self.at += 1
        return text

    def end(self) -> None:
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")

    def whole(self) -> Tree:
        tree = self.either()
        self.end()
        return tree

    def either(self) -> Tree:
        tree = self.both()
        while self.take("or"):
            tree = ("or", tree, self.both())
        return tree

    def both(self) -> Tree:
        tree = self.negated()
        while self.take("and"):
            tree = ("and", tree, self.negated())
        return tree

    def negated(self) -> Tree:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> Tree:
        tree = self.summed()
        while op := self.take("==", "!=", "<=", ">=", "<", ">", "in"):
            tree = ("binary", op, tree, self.summed())
        return tree

    def summed(self) -> Tree:
        tree = self.times()
        while op := self.take("+", "-", "~"):
            tree = ("binary", op, tree, self.times())
        return tree

    def times(self) -> Tree:
        tree = self.filtered()
        while op := self.take("*", "%"):
            tree = ("binary", op, tree, self.filtered())
        return tree

    def filtered(self) -> Tree:
        tree = self.item()
        while self.take("|"):
            name, args = self.name(), []
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            if self.take("("):
                while not self.take(")"):
                    args.append(self.either())
                    if not self.take(","):
                        self.need(")")
                        break
            tree = ("filter", name, tree, *args)
        return tree

    def item(self) -> Tree:
        tree = self.atom()
        while True:
            if self.take("."):
                tree = ("item", tree, ("value", self.name()))
            elif self.take("["):
                tree = ("item", tree, self.either())
                self.need("]")
            else:
                return tree

    def atom(self) -> Tree:
        kind, text = self.peek()
        self.at += 1
        if kind == "int":
            return ("value", int(text))
        if kind == "str":
            return ("value", re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "name" and text in ("true", "false", "none"):
            return ("value", {"true": True, "false": False, "none": None}[text])
        if kind == "op" and text == "(":
            tree = self.either()
            self.need(")")
            return tree
        if kind == "op" and text == "-":
            return ("binary", "-", ("value", 0), self.item())
        self.at -= 1
        return ("name", self.name())


def parse(source: str) -> Tree:
    """The syntax tree: ("block", statement, ...)."""
    pieces, at, trim = [], 0, False
    for m in TAG.finditer(source):
        text, tag = source[at : m.start()], m[0]
        text = text.lstrip() if trim else text
        pieces.append(("text", text.rstrip() if tag[2] == "-" else text))
        trim, at = tag[-3] == "-" and tag[1] != "#", m.end()
        if tag[1] != "#":
            pieces.append(("out" if tag[1] == "{" else "tag", tag[2:-2].removeprefix("-").removesuffix("-").strip()))
    pieces.append(("text", source[at:].lstrip() if trim else source[at:]))
    pos = 0

    def block(*ends: str) -> tuple[Tree, str]:
        nonlocal pos
        made = []
        while pos < len(pieces):
            kind, text = pieces[pos]
            pos += 1
            if kind == "text":
                made.append(("text", text))
            elif kind == "out":
                made.append(("out", _Expression(text).whole()))
            elif (word := (text.split() or [""])[0]) in ends:
                return ("block", *made), text
            elif word == "for":
                e = _Expression(text[3:])
                name = e.name()
                e.need("in")
                items = e.whole()
                body, _ = block("endfor")
                made.append(("for", name, items, body))
            elif word == "if":
                made.append(branch(text[2:]))
            elif word == "set":
                e = _Expression(text[3:])
                name = e.name()
                e.need("=")
                made.append(("set", name, e.whole()))
            elif word == "generation":
                made.append(("generation", block("endgeneration")[0]))
            else:
                raise TemplateError(f"unexpected tag {text!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return ("block", *made), ""

    def branch(test: str) -> Tree:
        condition = _Expression(test).whole()
        then, end = block("elif", "else", "endif")
        if end.split()[0] == "elif":
            return ("if", condition, then, ("block", branch(end[4:])))
        return ("if", condition, then, block("endif")[0] if end == "else" else ("block",))

    return block()[0]


def fold(tree: Tree) -> Tree:
    """The tree with constant expressions as values, neighbouring texts joined and dead branches dropped."""
    kind = tree[0]
    if kind in ("value", "name", "text"):
        return tree
    if kind == "block":
        made: list[Tree] = []
        for t in map(fold, tree[1:]):
            for part in t[1:] if t[0] == "block" else [t]:
                if part[0] == "out" and part[1][0] == "value":
                    part = ("text", _text(part[1][1]))
                if part[0] == "text" and made and made[-1][0] == "text":
                    made[-1] = ("text", made[-1][1] + part[1])
                elif part != ("text", ""):
                    made.append(part)
        return ("block", *made)
    tree = tuple(fold(x) if isinstance(x, tuple) else x for x in tree)
    parts = [x for x in tree[1:] if isinstance(x, tuple)]
    if kind == "if" and tree[1][0] == "value":
        return tree[2] if tree[1][1] else tree[3]
    if kind in ("binary", "filter", "item", "not", "and", "or") and all(x[0] == "value" for x in parts):
        return ("value", _evaluate(tree)({}))
    if kind in ("and", "or") and tree[1][0] == "value":
        return tree[2] if bool(tree[1][1]) == (kind == "and") else tree[1]
    return tree


def _evaluate(tree: Tree) -> Callable[[dict], Any]:
    """A closure from variables to the value of an expression."""
    kind = tree[0]
    if kind == "value":
        return lambda v, x=tree[1]: x
    if kind == "name":
        return lambda v, n=tree[1]: v.get(n)
    parts = [_evaluate(x) for x in tree[1:] if isinstance(x, tuple)]
    if kind == "item":
        a, b = parts
        return lambda v: _item(a(v), b(v))
    if kind == "filter":
        f, (a, *rest) = FILTERS[tree[1]], parts
        return (lambda v: f(a(v), *[r(v) for r in rest])) if rest else lambda v: f(a(v))
    if kind == "binary":
        (a, b), op = parts, tree[1]
        return lambda v: _binary(op, a(v), b(v))
    if kind == "not":
        return lambda v: not parts[0](v)
    a, b = parts
    return (lambda v: a(v) and b(v)) if kind == "and" else lambda v: a(v) or b(v)


Pieces = Iterator[tuple[str, bool]]


def _loop(items: Iterable) -> Iterator[tuple[Any, dict]]:
    """Items with loop.index, index0, first and last; one item is read ahead."""
    source, n = iter(items or ()), 0
    ahead = next(source, source)
    while ahead is not source:
        item, ahead = ahead, next(source, source)
        yield item, {"index": n + 1, "index0": n, "first": n == 0, "last": ahead is source}
        n += 1


def generate(tree: Tree) -> Callable[[dict, bool], Pieces]:
    """A closure that yields the pieces of a statement."""
    kind = tree[0]
    if kind == "text":
        return lambda v, g, t=tree[1]: iter(((t, g),))
    if kind == "out":
        value = _evaluate(tree[1])
        return lambda v, g: iter(((_text(value(v)), g),))
    if kind == "generation":
        inner = generate(tree[1])
        return lambda v, g: inner(v, True)
    if kind == "set":
        value = _evaluate(tree[2])

        def put(v, g, name=tree[1]):
            v[name] = value(v)
            return iter(())

        return put
    if kind == "if":
        test, then, other = _evaluate(tree[1]), generate(tree[2]), generate(tree[3])
        return lambda v, g: then(v, g) if test(v) else other(v, g)
    if kind == "for":
        items, body = _evaluate(tree[2]), generate(tree[3])

        def each(v, g, name=tree[1]):
            for item, loop in _loop(items(v)):
                yield from body(v | {name: item, "loop": loop}, g)

        return each
    parts = [generate(x) for x in tree[1:]]

    def block(v, g):
        for p in parts:
            yield from p(v, g)

    return block


def compile_template(source: str) -> Callable[..., Pieces]:
    """A function of the template's variables (keywords) that yields (text, generated) pieces."""
    run = generate(fold(parse(source)))
    return lambda **variables: run(dict(variables), False)
