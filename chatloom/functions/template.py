"""Chat templates as data: the part of Jinja that stored templates use, as a column expression.

A template comes as text with a tokenizer's configuration. ``compile_template`` turns it into a
function of a conversation column, so rendering stays inside the query: a loop over the
messages is a ``transform`` whose pieces are joined, a condition is a ``CASE``, and what depends on
flags that are known beforehand is decided before the query is planned.

Supported: text; ``{{ … }}`` with strings, names, message fields (``message['role']``, ``message.role``),
``+`` and ``~``, the filters ``trim``, ``upper``, ``lower``, ``length``, ``default(…)`` and ``tojson`` of a string;
``{% for message in messages %}`` with ``loop.first``, ``loop.last``, ``loop.index``, ``loop.index0``; ``{% if %}``, ``{% elif %}``,
``{% else %}`` with ``==``, ``!=``, ``in``, ``not``, ``and``, ``or``, ``is defined``, ``is none``, parentheses, ``messages[0]`` and
``messages[-1]``; ``{% set name = … %}`` outside of loops; comments; ``-`` at either end of a tag, which strips the
white space there. Anything else raises ``TemplateError`` when the template is compiled.

As in Jinja, a field that a message lacks is an empty text where it is written, and neither
defined nor true in a condition. A newline right after a block tag is dropped and
white space before a block at a line's beginning too if ``trim`` is set, as chat templates are
read; so is one newline at the end of the template.
"""

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.functions.text import strip


class TemplateError(ValueError):
    """A template, or a part of one, that is not supported."""


_TAG = re.compile(r"(\{\{-?|\{%-?|\{#)(.*?)(-?\}\}|-?%\}|#\})", re.S)
_TOKEN = re.compile(
    r"""\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|[+~|.\[\](),-]))"""
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
FIELDS = ("role", "content", "reasoning_content", "tools", "tool_calls")


def _pieces(source: str, trim: bool):
    """("text" | "print" | "block", content) in order."""
    at, out = 0, []
    strip_next = False
    after_block = False
    for m in [*_TAG.finditer(source), None]:
        text = source[at : m.start() if m else len(source)]
        if after_block and trim and text.startswith("\n"):
            text = text[1:]
        if strip_next:
            text = text.lstrip()
        if m and m[1].endswith("-"):
            text = text.rstrip()
        elif m and trim and m[1] != "{{":
            line = text.rsplit("\n", 1)
            if not line[-1].strip(" \t") and (len(line) > 1 or at == 0):
                text = text[: len(text) - len(line[-1])]
        if "{{" in text or "{%" in text or "{#" in text:
            raise TemplateError(f"a tag is not closed: {text.strip()[:40]!r}")
        if m is None and text.endswith("\n"):
            text = text[:-1]
        if text:
            out.append(("text", text))
        if m is None:
            break
        if {"{{": "}}", "{%": "%}", "{#": "#}"}[m[1][:2]] != m[3][-2:]:
            raise TemplateError(f"{m[0]!r} is closed by another sign than it was opened with")
        if m[1] != "{#":
            out.append(("print" if m[1][:2] == "{{" else "block", m[2].strip()))
        at, strip_next, after_block = m.end(), m[3].startswith("-"), m[1][:2] != "{{"
    return out


def _tokens(code: str) -> list[tuple[str, str]]:
    out, at = [], 0
    code = code.rstrip()
    while at < len(code):
        m = _TOKEN.match(code, at)
        if m is None:
            raise TemplateError(f"not supported: {code[at:].strip()[:40]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return out


class _Value:
    """What an expression stands for: a Python value known beforehand, or a column. ``there`` is a column
    (or a truth value) that tells whether it is defined."""

    def __init__(self, value, there=True):
        self.value, self.there = value, there

    @property
    def known(self) -> bool:
        return not isinstance(self.value, Column) and not isinstance(self.there, Column)

    def text(self) -> Column:
        if isinstance(self.value, Column):
            return F.coalesce(self.value.cast("string"), F.lit(""))
        if self.value is None or self.there is False:
            return F.lit("")
        return F.lit(str(self.value))

    def truth(self):
        """Jinja's truth of it, as a truth value or a column without nulls."""
        if not isinstance(self.value, Column):
            return bool(self.value) and self.there is not False
        return F.coalesce(self.value.cast("string") != "", F.lit(False))


class _Flag(_Value):
    """A condition: ``value`` is a truth value or a column of them."""

    def text(self) -> Column:
        if isinstance(self.value, Column):
            return F.when(self.value, F.lit("True")).otherwise(F.lit("False"))
        return F.lit(str(self.value))

    def truth(self):
        return self.value


class _Message(_Value):
    def field(self, name: str) -> _Value:
        if name not in FIELDS:
            return _Value(None, False)
        value = self.value[name]
        return _Value(value, value.isNotNull())


class _Messages(_Value):
    pass


class _Loop:
    def __init__(self, index: Column, size: Column):
        self.fields = {
            "first": _Flag(index == 0),
            "last": _Flag(index == size - 1),
            "index": _Value(index + 1),
            "index0": _Value(index),
            "length": _Value(size),
        }


def _both(a, b, how: str):
    """``and`` or ``or`` of truth values and columns."""
    if not isinstance(a, Column):
        return b if a == (how == "and") else a
    if not isinstance(b, Column):
        return a if b == (how == "and") else b
    return a & b if how == "and" else a | b


def _not(a):
    return ~a if isinstance(a, Column) else not a


class _Expression:
    """A parser of one expression, by precedence."""

    def __init__(self, code: str, names: dict):
        self.code, self.names, self.tokens, self.at = code, names, _tokens(code), 0

    def whole(self):
        found = self.either()
        if self.at != len(self.tokens):
            self.fail()
        return found

    def fail(self):
        raise TemplateError(f"not supported: {self.code!r}")

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][1] in values and self.tokens[self.at][0] != "text"

    def take(self, *values: str) -> str | None:
        if self.peek(*values):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, *values: str) -> str:
        return self.take(*values) or self.fail()

    def either(self):
        left = self.all()
        while self.take("or"):
            left = _Flag(_both(left.truth(), self.all().truth(), "or"))
        return left

    def all(self):
        left = self.negated()
        while self.take("and"):
            left = _Flag(_both(left.truth(), self.negated().truth(), "and"))
        return left

    def negated(self):
        if self.take("not"):
            return _Flag(_not(self.negated().truth()))
        return self.compared()

    def compared(self):
        left = self.joined()
        if sign := self.take("==", "!="):
            same = self.same(left, self.joined())
            return _Flag(same if sign == "==" else _not(same))
        if self.take("is"):
            wrong = bool(self.take("not"))
            kind = self.need("defined", "none", "string")
            there = left.there
            if kind == "string":
                there = there if isinstance(left.value, (Column, str)) else False
            return _Flag(_not(there) if wrong != (kind == "none") else there)
        wrong = self.peek("not") and self.tokens[self.at + 1 : self.at + 2] == [("name", "in")]
        if wrong:
            self.at += 1
        if self.take("in"):
            right = self.joined()
            if left.known and right.known:
                held = str(left.value) in str(right.value)
            else:
                held = F.contains(right.text(), left.text()) & (F.lit(right.there) if isinstance(right.there, bool) else right.there)
            return _Flag(_not(held) if wrong else held)
        return left

    def same(self, left, right):
        if left.known and right.known:
            return left.value == right.value and left.there == right.there
        if isinstance(left, (_Messages, _Message)) or isinstance(right, (_Messages, _Message)):
            self.fail()
        there = [F.lit(x.there) if isinstance(x.there, bool) else x.there for x in (left, right)]
        if left.value is None or right.value is None:
            return F.lit(False)
        return F.coalesce(left.text() == right.text(), F.lit(False)) & there[0] & there[1]

    def joined(self):
        left = self.filtered()
        while self.take("+", "~"):
            right = self.filtered()
            left = _Value(str(left.value) + str(right.value)) if left.known and right.known else _Value(F.concat(left.text(), right.text()))
        return left

    def filtered(self):
        left = self.place()
        while self.take("|"):
            left = self.apply(self.word(), left)
        return left

    def word(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            self.fail()
        self.at += 1
        return self.tokens[self.at - 1][1]

    def apply(self, name: str, value):
        if name == "length" and isinstance(value, _Messages):
            return _Value(F.size(value.value))
        if isinstance(value, (_Messages, _Message)):
            self.fail()
        if name == "default":
            self.need("(")
            other = self.either()
            self.need(")")
            if not isinstance(value.there, Column):
                return value if value.there else other
            return _Value(F.when(value.there, value.text()).otherwise(other.text()))
        forms: dict[str, Callable[[Column], Column]] = {
            "trim": strip,
            "upper": F.upper,
            "lower": F.lower,
            "length": F.length,
            # the JSON text of a one-element array, without its brackets
            "tojson": lambda x: F.regexp_extract(F.to_json(F.array(x)), r"(?s)^\[(.*)\]$", 1),
        }
        return _Value(forms[name](value.text())) if name in forms else self.fail()

    def place(self):
        """A name or a literal, and what is taken out of it."""
        found = self.atom()
        while True:
            if self.take("."):
                key = self.word()
                if self.peek("("):  # the one method that templates use
                    self.need("(")
                    self.need(")")
                    if key not in ("strip", "upper", "lower") or isinstance(found, (_Messages, _Message)):
                        self.fail()
                    found = self.apply("trim" if key == "strip" else key, found)
                    continue
            elif self.take("["):
                minus = bool(self.take("-"))
                if self.at >= len(self.tokens):
                    self.fail()
                kind, key = self.tokens[self.at]
                self.at += 1
                self.need("]")
                if kind == "number" and isinstance(found, _Messages):
                    at = -int(key) if minus else int(key) + 1
                    found = _Message(F.try_element_at(found.value, F.lit(at)))
                    continue
                if kind != "text" or minus:
                    self.fail()
                key = key[1:-1]
            else:
                return found
            if isinstance(found, _Message):
                found = found.field(key)
            elif isinstance(found, _Loop) and key in found.fields:
                found = found.fields[key]
            else:
                self.fail()

    def atom(self):
        if self.at >= len(self.tokens):
            self.fail()
        if self.take("("):
            found = self.either()
            self.need(")")
            return found
        kind, token = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            return _Value(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), token[1:-1], flags=re.S))
        if kind == "number":
            return _Value(int(token))
        if kind != "name":
            self.fail()
        if token in ("true", "True", "false", "False"):
            return _Flag(token.lower() == "true")
        if token in ("none", "None"):
            return _Value(None, False)
        return self.names.get(token, _Value(None, False))


def _parse(pieces: list[tuple[str, str]], at: int, ends: tuple[str, ...]):
    """A list of nodes up to one of ``ends``, and the place of that."""
    nodes = []
    while at < len(pieces):
        kind, code = pieces[at]
        word = code.split(None, 1)[0] if kind == "block" and code else ""
        if word in ends:
            return nodes, at
        at += 1
        if kind != "block":
            nodes.append((kind, code))
        elif word == "for":
            m = re.fullmatch(r"for\s+(\w+)\s+in\s+(\w+)", code)
            if not m:
                raise TemplateError(f"not supported: {code!r}")
            body, at = _parse(pieces, at, ("endfor",))
            nodes.append(("for", m[1], m[2], body))
            at += 1
        elif word == "if":
            cases, rest = [], []
            condition = code[2:]
            while True:
                body, at = _parse(pieces, at, ("elif", "else", "endif"))
                if condition is None:
                    rest = body
                else:
                    cases.append((condition, body))
                word = pieces[at][1].split(None, 1)[0]
                if word == "endif":
                    break
                if condition is None:
                    raise TemplateError("a case after else")
                condition = pieces[at][1][4:] if word == "elif" else None
                at += 1
            nodes.append(("if", cases, rest))
            at += 1
        elif word == "set" and (m := re.fullmatch(r"set\s+(\w+)\s*=\s*(.+)", code, re.S)):
            nodes.append(("set", m[1], m[2]))
        else:
            raise TemplateError(f"not supported: {code!r}")
    if ends:
        raise TemplateError(f"no {ends[-1]}")
    return nodes, at


def _render(nodes, names: dict, inside: bool = False) -> Column:
    parts: list[Column] = []
    for node in nodes:
        if node[0] == "text":
            parts.append(F.lit(node[1]))
        elif node[0] == "print":
            found = _Expression(node[1], names).whole()
            if isinstance(found, (_Messages, _Message, _Loop)):
                raise TemplateError(f"not a text: {node[1]!r}")
            parts.append(found.text())
        elif node[0] == "set":
            if inside:  # in Jinja it would end with the loop's turn, or change nothing outside of a case
                raise TemplateError(f"set inside a loop or a case: {node[1]}")
            names[node[1]] = _Expression(node[2], names).whole()
        elif node[0] == "for":
            _, name, over, body = node
            messages = names.get(over)
            if not isinstance(messages, _Messages):
                raise TemplateError(f"a loop over {over!r}")
            size = F.size(messages.value)

            def turn(m, i):
                return _render(body, names | {name: _Message(m), "loop": _Loop(i, size)}, True)

            parts.append(F.array_join(F.transform(messages.value, turn), ""))
        else:
            parts.append(_cases(node[1], node[2], names))
    if not parts:
        return F.lit("")
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _cases(cases, rest, names) -> Column:
    out = None
    for condition, body in cases:
        truth = _Expression(condition, names).whole().truth()
        if truth is False:
            continue
        found = _render(body, names, True)
        if truth is True:
            return found if out is None else out.otherwise(found)
        out = F.when(truth, found) if out is None else out.when(truth, found)
    other = _render(rest, names, True)
    return other if out is None else out.otherwise(other)


def compile_template(source: str, trim: bool = True, **values) -> Callable[..., Column]:
    """A function of a conversation column that renders it by the template.

    ``values`` are what the template may name besides ``messages``: texts such as ``bos_token``, and flags. The function
    takes ``generation_prompt`` and more values, as ``render_chat`` does, and so fits wherever a ``render`` function is asked for.
    A null conversation gives null, as an empty one has no messages.
    """
    nodes, _ = _parse(_pieces(source, trim), 0, ())

    def render(conv: Column, generation_prompt: bool = False, **more) -> Column:
        given = {"add_generation_prompt": bool(generation_prompt)} | values | more
        names = {k: _Flag(v) if isinstance(v, bool) else _Value(v, v is not None) for k, v in given.items()}
        names["messages"] = _Messages(conv)
        return F.when(conv.isNotNull(), _render(nodes, names))

    render(F.col("messages"))  # unsupported parts raise now
    return render
