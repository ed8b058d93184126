"""A small sandboxed template language for conversations, compiled to Python closures.

Templates are text with ``{{ expression }}`` and the blocks ``{% for m in messages %} .. {% endfor %}``, ``{% if e %} ..
{% elif e %} .. {% else %} .. {% endif %}`` and ``{% generation %} .. {% endgeneration %}``. Expressions know string and number
literals, names, ``m.role``, ``m.text``, ``loop.index0``, ``loop.first``, ``loop.last``, ``== !=``, ``and or not``, ``~`` (joining
texts), brackets and the filters ``escape``, ``trim``, ``upper`` and ``lower``. Nothing else can be reached: no attributes of
Python objects, calls or imports.

A template is parsed to a tree, constant parts of the tree are folded, and each node becomes a closure. Rendering yields
pieces (text, whether it lies inside a generation block) one by one, so a conversation is never held as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import regex

#: Strings with a meaning in the default template. Only their first character is a bracket, so none can begin in a text.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[END]"]
TEMPLATE = (
    "<s>{% for m in messages %}"
    "{% if m.role == 'user' %}[INST]{{ m.text | escape }}[/INST]"
    "{% elif m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% else %}[ROLE]{{ m.role | escape }}[/ROLE]{{ m.text | escape }}[END]{% endif %}"
    "{% endfor %}"
)
_CONTROL = regex.compile("|".join(map(regex.escape, sorted(CONTROLS, key=len, reverse=True))))
_ESCAPED = regex.compile(r"\\(.)", regex.DOTALL)
_PARTS = regex.compile(r"(\{\{.*?\}\}|\{%.*?%\})", regex.DOTALL)
_LEXEMES = regex.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[().|~]))")

Scope = dict[str, object]
Value = Callable[[Scope], object]
Render = Callable[[Scope], Iterator[tuple[str, bool]]]


class TemplateError(ValueError):
    """The template isn't well formed or asks for something outside the language."""


def escape(text: str) -> str:
    """Text without any control string: a backslash behind their first character; backslashes are doubled."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    """Undo ``escape``."""
    return _ESCAPED.sub(r"\1", text)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}
FIELDS = {"role", "text", "index0", "first", "last"}


@dataclass(frozen=True)
class Node:
    """Kind, and parts: texts, names or nodes."""

    kind: str
    parts: tuple = ()


def _text(value: object) -> str:
    return "" if value is None or value is False else str(value)


class _Expression:
    """Recursive descent over one expression's lexemes."""

    def __init__(self, source: str) -> None:
        self.tokens: list[tuple[str, str]] = []
        at = 0
        source = source.strip()
        while at < len(source):
            match = _LEXEMES.match(source, at)
            if not match:
                raise TemplateError("Cannot read expression {!r} at {}".format(source, at))
            kind = ("text", "number", "name", "sign")[match.lastindex - 1]
            self.tokens.append((kind, match[match.lastindex]))
            at = match.end()
        self.at = 0

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, *wanted: str) -> bool:
        if self.peek()[0] in ("sign", "name") and self.peek()[1] in wanted:
            self.at += 1
            return True
        return False

    def whole(self) -> Node:
        node = self.either()
        if self.peek()[0] != "end":
            raise TemplateError("Unexpected {!r}".format(self.peek()[1]))
        return node

    def either(self) -> Node:
        node = self.both()
        while self.take("or"):
            node = Node("or", (node, self.both()))
        return node

    def both(self) -> Node:
        node = self.negated()
        while self.take("and"):
            node = Node("and", (node, self.negated()))
        return node

    def negated(self) -> Node:
        return Node("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> Node:
        node = self.joined()
        sign = self.peek()[1]
        return Node(sign, (node, self.joined())) if self.take("==", "!=") else node

    def joined(self) -> Node:
        node = self.filtered()
        while self.take("~"):
            node = Node("~", (node, self.filtered()))
        return node

    def filtered(self) -> Node:
        node = self.atom()
        while self.take("|"):
            kind, name = self.peek()
            if kind != "name" or name not in FILTERS:
                raise TemplateError("Unknown filter {!r}".format(name))
            self.at += 1
            node = Node("filter", (name, node))
        return node

    def atom(self) -> Node:
        kind, value = self.peek()
        self.at += 1
        if kind == "text":
            return Node("constant", (_ESCAPED.sub(r"\1", value[1:-1]),))
        if kind == "number":
            return Node("constant", (int(value),))
        if (kind, value) == ("sign", "("):
            node = self.either()
            if not self.take(")"):
                raise TemplateError("Missing )")
            return node
        if kind == "name":
            if self.take("."):
                field = self.peek()[1]
                self.at += 1
                if field not in FIELDS:
                    raise TemplateError("Unknown field {!r}".format(field))
                return Node("field", (value, field))
            return Node("name", (value,))
        raise TemplateError("Unexpected {!r}".format(value or "end"))


def parse(template: str) -> Node:
    """The template's tree."""
    parts = [p for p in _PARTS.split(template) if p]
    node, at = _block(parts, 0, ())
    if at != len(parts):
        raise TemplateError("Unexpected {!r}".format(parts[at]))
    return node


def _words(part: str) -> list[str]:
    return part[2:-2].split(None, 1) if part.startswith("{%") else [""]


def _block(parts: list[str], at: int, ends: tuple[str, ...]) -> tuple[Node, int]:
    nodes: list[Node] = []
    while at < len(parts):
        part = parts[at]
        word = (_words(part) or [""])[0]
        if word and word in ends:
            return Node("block", tuple(nodes)), at
        at += 1
        if part.startswith("{{"):
            nodes.append(Node("show", (_Expression(part[2:-2]).whole(),)))
        elif not part.startswith("{%"):
            nodes.append(Node("show", (Node("constant", (part,)),)))
        elif word == "for":
            loop = regex.fullmatch(r"for\s+([A-Za-z_]\w*)\s+in\s+([A-Za-z_]\w*)", part[2:-2].strip())
            if not loop:
                raise TemplateError("Cannot read {!r}".format(part))
            body, at = _close(parts, at, "endfor")
            nodes.append(Node("for", (loop[1], loop[2], body)))
        elif word == "generation":
            body, at = _close(parts, at, "endgeneration")
            nodes.append(Node("generation", (body,)))
        elif word == "if":
            node, at = _branches(parts, at, part)
            nodes.append(node)
        else:
            raise TemplateError("Unexpected {!r}".format(part))
    if ends:
        raise TemplateError("Missing {}".format(" or ".join(ends)))
    return Node("block", tuple(nodes)), at


def _close(parts: list[str], at: int, end: str) -> tuple[Node, int]:
    body, at = _block(parts, at, (end,))
    return body, at + 1


def _branches(parts: list[str], at: int, opening: str) -> tuple[Node, int]:
    words = _words(opening)
    test = _Expression(words[1] if len(words) > 1 else "").whole()
    body, at = _block(parts, at, ("elif", "else", "endif"))
    word = _words(parts[at])[0]
    if word == "elif":
        rest, at = _branches(parts, at + 1, parts[at])
        return Node("if", (test, body, rest)), at
    other = Node("block")
    if word == "else":
        other, at = _block(parts, at + 1, ("endif",))
    return Node("if", (test, body, other)), at + 1


def fold(node: Node) -> Node:
    """The tree with constant expressions evaluated, neighbouring texts joined and decided branches taken."""
    parts = tuple(fold(p) if isinstance(p, Node) else p for p in node.parts)
    node = Node(node.kind, parts)
    inner = [p for p in parts if isinstance(p, Node)]
    if node.kind in ("or", "and", "not", "==", "!=", "~", "filter") and all(p.kind == "constant" for p in inner):
        return Node("constant", (_value(node)({}),))
    if node.kind == "if" and parts[0].kind == "constant":
        return parts[1] if parts[0].parts[0] else parts[2]
    if node.kind == "block":
        flat: list[Node] = []
        for part in parts:
            for one in part.parts if part.kind == "block" else (part,):
                if flat and one.kind == flat[-1].kind == "show" and one.parts[0].kind == flat[-1].parts[0].kind == "constant":
                    joined = _text(flat.pop().parts[0].parts[0]) + _text(one.parts[0].parts[0])
                    one = Node("show", (Node("constant", (joined,)),))
                flat.append(one)
        return Node("block", tuple(flat))
    return node


def _value(node: Node) -> Value:
    kind, parts = node.kind, node.parts
    if kind == "constant":
        value = parts[0]
        return lambda scope: value
    if kind == "name":
        name = parts[0]
        return lambda scope: scope.get(name)
    if kind == "field":
        name, field = parts
        return lambda scope: (scope.get(name) or {}).get(field)
    if kind == "filter":
        change, inner = FILTERS[parts[0]], _value(parts[1])
        return lambda scope: change(_text(inner(scope)))
    first = _value(parts[0])
    if kind == "not":
        return lambda scope: not first(scope)
    second = _value(parts[1])
    if kind == "or":
        return lambda scope: first(scope) or second(scope)
    if kind == "and":
        return lambda scope: first(scope) and second(scope)
    if kind == "==":
        return lambda scope: first(scope) == second(scope)
    if kind == "!=":
        return lambda scope: first(scope) != second(scope)
    return lambda scope: _text(first(scope)) + _text(second(scope))


def _render(node: Node) -> Render:
    kind, parts = node.kind, node.parts
    if kind == "show":
        value = _value(parts[0])

        def show(scope: Scope) -> Iterator[tuple[str, bool]]:
            text = _text(value(scope))
            if text:
                yield text, False

        return show
    if kind == "block":
        inner = [_render(p) for p in parts]

        def block(scope: Scope) -> Iterator[tuple[str, bool]]:
            for one in inner:
                yield from one(scope)

        return block
    if kind == "generation":
        body = _render(parts[0])
        return lambda scope: ((text, True) for text, _ in body(scope))
    if kind == "if":
        test, yes, no = _value(parts[0]), _render(parts[1]), _render(parts[2])
        return lambda scope: yes(scope) if test(scope) else no(scope)
    name, over, body = parts[0], parts[1], _render(parts[2])

    def loop(scope: Scope) -> Iterator[tuple[str, bool]]:
        held = None
        index = 0
        for item in [*()] if scope.get(over) is None else scope[over]:
            if held is not None:
                yield from body({**scope, name: held, "loop": {"index0": index, "first": index == 0, "last": False}})
                index += 1
            held = item
        if held is not None:
            yield from body({**scope, name: held, "loop": {"index0": index, "first": index == 0, "last": True}})

    return loop


def compile_template(template: str) -> Callable[[Iterable[dict]], Iterator[tuple[str, bool]]]:
    """A function from messages (``role``, ``text``) to pieces (text, inside a generation block)."""
    render = _render(fold(parse(template)))
    return lambda messages: render({"messages": messages})


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a conversation, or of whole turns of it, in the default template's format."""
    turns: list[tuple[str, str]] = []
    at, role = 0, ""
    for mark in _CONTROL.finditer(formatted):
        text, at = formatted[at : mark.start()], mark.end()
        if mark[0] == "[/INST]":
            turns.append(("user", unescape(text)))
        elif mark[0] == "</s>":
            turns.append(("assistant", unescape(text)))
        elif mark[0] == "[/ROLE]":
            role = unescape(text)
        elif mark[0] == "[END]":
            turns.append((role, unescape(text)))
        elif text:
            raise ValueError("Text outside a turn")
    if at != len(formatted):
        raise ValueError("Text after the last turn")
    return turns
