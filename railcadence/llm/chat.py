"""Chat formatting with a small sandboxed template language.

A template is parsed into a syntax tree, constants are folded, and Python closures are made
of it once per task. They render a conversation turn by turn, so memory holds one turn and
not a conversation; the parts of a ``generation`` block are marked for the loss.

    {{ expression }}   {% for x in messages %} ... {% endfor %}   {% set x = expression %}
    {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}    {# comment #}
    {% generation %} ... {% endgeneration %}

Expressions: strings, whole numbers, true/false/none, names, ``a.b`` and ``a['b']`` on
records, ``+ ~ == != < <= > >= in not and or``, ``x if y else z``, filters ``| name``. There
are no calls and no Python attributes, and only names that the renderer sets can be read.

Defined results: NULL role or text is empty, a NULL turn comes first, turns with one number
are ordered by role and text, repeated turns stay, rows with a NULL conversation are one
conversation, extra columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from hashlib import sha256
from itertools import groupby
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

CHATML = (
    "{% for message in messages %}{{ '<|im_start|>' ~ message.role | field ~ '\\n' }}"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | guard }}{% endgeneration %}"
    "{% else %}{{ message.text | guard }}{% endif %}{{ '<|im_end|>' ~ '\\n' }}{% endfor %}"
)

# ---------------------------------------------------------------- escapes
_CONTROL, _GUARDED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def guard(text: str) -> str:
    """No ``<|`` is left: ``<``, n backslashes, ``|`` gets one backslash more."""
    return _CONTROL.sub(r"<\\\1|", text)


def unguard(text: str) -> str:
    return _GUARDED.sub(r"<\1|", text)


def field(text: str) -> str:
    """Guarded and without line ends, for the header of a turn."""
    return guard(text.replace("\\", "\\\\").replace("\n", "\\n"))


def unfield(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unguard(text), flags=re.S)


FILTERS: dict[str, Callable[[Any], Any]] = {
    "guard": lambda v: guard(_text(v)), "field": lambda v: field(_text(v)), "trim": lambda v: _text(v).strip(),
    "lower": lambda v: _text(v).lower(), "upper": lambda v: _text(v).upper(), "length": lambda v: len(_text(v)),
    "string": lambda v: _text(v),
}


def _text(value: Any) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (str, int)):
        return str(value)
    raise TemplateError(f"a {type(value).__name__} can't be text")


class TemplateError(ValueError):
    pass


# ---------------------------------------------------------------- syntax tree
@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: Any
    key: Any


@dataclass(frozen=True)
class Op:
    name: str
    args: tuple


@dataclass(frozen=True)
class Out:
    expr: Any


@dataclass(frozen=True)
class If:
    cases: tuple  # of (condition, body); the last condition may be Const(True)


@dataclass(frozen=True)
class For:
    var: str
    source: Any
    body: tuple


@dataclass(frozen=True)
class Assign:
    var: str
    expr: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


OPERATIONS: dict[str, Callable] = {
    "~": lambda a, b: _text(a) + _text(b), "+": lambda a, b: _plus(a, b),
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
    "in": lambda a, b: _text(a) in _text(b), "not": lambda a: not a,
}


def _plus(a: Any, b: Any) -> Any:
    if isinstance(a, str) and isinstance(b, str) or isinstance(a, int) and isinstance(b, int):
        return a + b
    raise TemplateError("+ takes two texts or two numbers")


# ---------------------------------------------------------------- parser
_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(
    r"\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<name>[A-Za-z][A-Za-z0-9_]*)"
    r"|(?P<mark>==|!=|<=|>=|[<>+~|.()\[\]=]))", re.S,
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_RESERVED = {"and", "or", "not", "in", "if", "else", "true", "false", "none"}


class _Expression:
    """Recursive descent over the tokens of one tag, loosest operator first."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.strip()
        while at < len(source):
            if not (m := _TOKEN.match(source, at)):
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        return value if kind in ("mark", "name") else None

    def take(self, *values: str) -> str | None:
        if self.peek() in values:
            self.at += 1
            return values[values.index(self.tokens[self.at - 1][1])]
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} is missing")

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name" or self.tokens[self.at][1] in _RESERVED:
            raise TemplateError("a name is missing")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def end(self, tree: Any) -> Any:
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at][1]!r} isn't expected")
        return tree

    def choice(self) -> Any:
        value = self.either()
        if self.take("if"):
            condition = self.either()
            self.need("else")
            return Op("if", (condition, value, self.choice()))
        return value

    def either(self) -> Any:
        left = self.both()
        while self.take("or"):
            left = Op("or", (left, self.both()))
        return left

    def both(self) -> Any:
        left = self.negated()
        while self.take("and"):
            left = Op("and", (left, self.negated()))
        return left

    def negated(self) -> Any:
        return Op("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> Any:
        left = self.joined()
        while op := self.take("==", "!=", "<=", ">=", "<", ">", "in"):
            left = Op(op, (left, self.joined()))
        return left

    def joined(self) -> Any:
        left = self.filtered()
        while op := self.take("+", "~"):
            left = Op(op, (left, self.filtered()))
        return left

    def filtered(self) -> Any:
        value = self.value()
        while self.take("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            value = Op(f"|{name}", (value,))
        return value

    def value(self) -> Any:
        if self.at >= len(self.tokens):
            raise TemplateError("an expression is missing")
        kind, word = self.tokens[self.at]
        if self.take("("):
            tree = self.choice()
            self.need(")")
        elif kind == "text":
            self.at += 1
            tree = Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), word[1:-1], flags=re.S))
        elif kind == "number":
            self.at += 1
            tree = Const(int(word))
        elif word in ("true", "false", "none"):
            self.at += 1
            tree = Const({"true": True, "false": False, "none": None}[word])
        else:
            tree = Name(self.name())
        while mark := self.take(".", "["):
            if mark == ".":
                tree = Item(tree, Const(self.name()))
            else:
                tree = Item(tree, self.choice())
                self.need("]")
        return tree


def parse(source: str) -> tuple:
    """The syntax tree of a template: a tuple of statements."""
    parts, at = [], 0
    for m in _TAG.finditer(source):
        if m.start() > at:
            parts.append(("text", source[at : m.start()]))
        if m[1] is not None:
            parts.append(("out", m[1]))
        elif m[2] is not None:
            parts.append(("tag", m[2].strip()))
        at = m.end()
    if at < len(source):
        parts.append(("text", source[at:]))
    body, rest = _body(parts, 0, ())
    if rest != len(parts):
        raise TemplateError(f"{parts[rest][1]!r} closes nothing")
    return body


def _body(parts: list, at: int, until: tuple[str, ...]) -> tuple[tuple, int]:
    out = []
    while at < len(parts):
        kind, value = parts[at]
        word, _, rest = value.partition(" ") if kind == "tag" else ("", "", "")
        if kind == "tag" and word in ("elif", "else", "endif", "endfor", "endgeneration"):
            if word not in until:
                break
            return tuple(out), at
        at += 1
        if kind == "text":
            out.append(Out(Const(value)))
        elif kind == "out":
            e = _Expression(value)
            out.append(Out(e.end(e.choice())))
        elif word == "for":
            e = _Expression(rest)
            var = e.name()
            e.need("in")
            source = e.end(e.choice())
            body, at = _closed(parts, at, "endfor")
            out.append(For(var, source, body))
        elif word == "set":
            e = _Expression(rest)
            var = e.name()
            e.need("=")
            out.append(Assign(var, e.end(e.choice())))
        elif word == "generation":
            body, at = _closed(parts, at, "endgeneration")
            out.append(Generation(body))
        elif word == "if":
            e = _Expression(rest)
            condition, cases = e.end(e.choice()), []
            while True:
                body, at = _body(parts, at, ("elif", "else", "endif"))
                if at >= len(parts):
                    raise TemplateError("endif is missing")
                cases.append((condition, body))
                word, _, rest = parts[at][1].partition(" ")
                at += 1
                if word == "endif":
                    break
                e = _Expression(rest) if word == "elif" else None
                condition = e.end(e.choice()) if e else Const(True)
            out.append(If(tuple(cases)))
        else:
            raise TemplateError(f"unknown tag {value!r}")
    if until:
        raise TemplateError(f"{until[-1]} is missing")
    return tuple(out), at


def _closed(parts: list, at: int, end: str) -> tuple[tuple, int]:
    body, at = _body(parts, at, (end,))
    return body, at + 1


# ---------------------------------------------------------------- constant folding
def fold(node: Any) -> Any:
    """The same tree with constant parts computed, dead branches gone and texts joined."""
    if isinstance(node, tuple):
        out: list = []
        for child in (fold(c) for c in node):
            for c in child if isinstance(child, tuple) else (child,):
                if isinstance(c, Out) and isinstance(c.expr, Const):
                    c = Out(Const(_text(c.expr.value)))
                    if not c.expr.value:
                        continue
                    if out and isinstance(out[-1], Out) and isinstance(out[-1].expr, Const):
                        out[-1] = Out(Const(out[-1].expr.value + c.expr.value))
                        continue
                out.append(c)
        return tuple(out)
    if isinstance(node, Item):
        return Item(fold(node.of), fold(node.key))
    if isinstance(node, Op):
        args = tuple(fold(a) for a in node.args)
        if node.name in ("and", "or", "if") and isinstance(args[0], Const):
            if node.name == "if":
                return args[1] if args[0].value else args[2]
            return args[1] if bool(args[0].value) == (node.name == "and") else args[0]
        if node.name not in ("and", "or", "if") and all(isinstance(a, Const) for a in args):
            return Const(_apply(node.name)(*[a.value for a in args]))
        return Op(node.name, args)
    if isinstance(node, Out):
        return Out(fold(node.expr))
    if isinstance(node, Assign):
        return Assign(node.var, fold(node.expr))
    if isinstance(node, For):
        return For(node.var, fold(node.source), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, If):
        cases = []
        for condition, body in node.cases:
            condition = fold(condition)
            if isinstance(condition, Const) and not condition.value:
                continue
            cases.append((condition, fold(body)))
            if isinstance(condition, Const):
                break
        if cases and isinstance(cases[0][0], Const):
            return cases[0][1]
        return If(tuple(cases)) if cases else ()
    return node


def _apply(name: str) -> Callable:
    return FILTERS[name[1:]] if name[0] == "|" else OPERATIONS[name]


# ---------------------------------------------------------------- closures
Scope = dict[str, Any]


def _value(node: Any) -> Callable[[Scope], Any]:
    if isinstance(node, Const):
        return lambda scope, v=node.value: v
    if isinstance(node, Name):
        def read(scope: Scope, name: str = node.name) -> Any:
            if name not in scope:
                raise TemplateError(f"{name!r} isn't set")
            return scope[name]
        return read
    if isinstance(node, Item):
        of, key = _value(node.of), _value(node.key)

        def look(scope: Scope) -> Any:
            record = of(scope)
            if not isinstance(record, Mapping):
                raise TemplateError("only records have fields")
            return record.get(key(scope))
        return look
    args = [_value(a) for a in node.args]
    if node.name == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if node.name == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    if node.name == "if":
        return lambda scope: args[1](scope) if args[0](scope) else args[2](scope)
    f = _apply(node.name)
    if len(args) == 1:
        return lambda scope, a=args[0]: f(a(scope))
    return lambda scope, a=args[0], b=args[1]: f(a(scope), b(scope))


Chunks = Iterator[tuple[str, bool]]


def _statements(body: tuple) -> Callable[[Scope, bool], Chunks]:
    steps = [_statement(s) for s in body]

    def run(scope: Scope, marked: bool) -> Chunks:
        for step in steps:
            yield from step(scope, marked)
    return run


def _statement(node: Any) -> Callable[[Scope, bool], Chunks]:
    if isinstance(node, Out):
        value = _value(node.expr)

        def out(scope: Scope, marked: bool) -> Chunks:
            yield _text(value(scope)), marked
        return out
    if isinstance(node, Assign):
        value = _value(node.expr)

        def assign(scope: Scope, marked: bool) -> Chunks:
            scope[node.var] = value(scope)
            yield from ()
        return assign
    if isinstance(node, Generation):
        inner = _statements(node.body)
        return lambda scope, marked: inner(scope, True)
    if isinstance(node, If):
        cases = [(_value(c), _statements(b)) for c, b in node.cases]

        def choose(scope: Scope, marked: bool) -> Chunks:
            for condition, then in cases:
                if condition(scope):
                    yield from then(scope, marked)
                    return
        return choose
    source, inner = _value(node.source), _statements(node.body)

    def loop(scope: Scope, marked: bool) -> Chunks:
        rows = source(scope)
        if isinstance(rows, (str, Mapping)) or not isinstance(rows, Iterable):
            raise TemplateError("only lists can be looped over")
        rows, index, outer = iter(rows), 0, scope.get("loop")
        row, more = next(rows, None), True
        while row is not None:  # one row ahead, so that the last one is known
            ahead = next(rows, None)
            scope[node.var] = row
            scope["loop"] = {"index": index + 1, "index0": index, "first": not index, "last": ahead is None}
            yield from inner(scope, marked)
            row, index = ahead, index + 1
        scope["loop"] = outer
    return loop


def compile_template(source: str) -> Callable[[Iterable[Mapping], Mapping], Chunks]:
    """A function of messages and further names that yields (text, under the loss mask)."""
    run = _statements(fold(parse(source)))
    return lambda messages, names: run({"messages": messages, **names}, False)


# ---------------------------------------------------------------- Spark
_PART = pa.schema([
    ("conv_id", pa.string()), ("part", pa.int64()), ("formatted", pa.string()),
    ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])
PART_CHARS = 1 << 16
BATCH_CHARS = 1 << 23


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            yield from batch.slice(at, 512).to_pylist()


def _batched(rows: Iterable[tuple], schema: pa.Schema, size: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += size(row) + 50
        if n >= BATCH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _parts(chunks: Chunks) -> Iterator[tuple[str, list[dict]]]:
    """Stretches of the output of about PART_CHARS; a chunk is never split."""
    held, loss, n = [], [], 0
    for text, marked in chunks:
        if marked:
            loss.append({"start": n, "end": n + len(text)})
        held.append(text)
        n += len(text)
        if n >= PART_CHARS:
            yield "".join(held), loss
            held, loss, n = [], [], 0
    if held:
        yield "".join(held), loss


def format_conversations(
    df: DataFrame, template: str = CHATML, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text", names: Mapping[str, Any] | None = None,
) -> DataFrame:
    """``conv_id`` (as text), ``part``, ``formatted``, ``loss``: the rendered conversations.

    A long conversation has several parts, in order within one Spark partition; ``loss``
    holds the stretches under the mask as character offsets of the part.
    """
    compile_template(template)  # a wrong template fails here and not in a task
    given = dict(names or {})
    rows = df.select(
        F.col(conv_col).cast("string").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)

        def out() -> Iterator[tuple]:
            for conv, turns in groupby(_rows(batches), key=lambda r: r["conv_id"]):
                for k, (text, loss) in enumerate(_parts(render(turns, given))):
                    yield conv, k, text, loss
        yield from _batched(out(), _PART, lambda r: len(r[2]))

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(
        run, "conv_id string, part long, formatted string, loss array<struct<start:long,end:long>>"
    )


_READ = pa.schema([
    ("conv_id", pa.string()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])


def _turns(parts: Iterable[str]) -> Iterator[tuple[str, str]]:
    """Role and text of each turn of a conversation in the CHATML layout."""
    start, end, buffer = "<|im_start|>", "<|im_end|>\n", ""
    for part in parts:
        buffer += part
        at = 0
        while (stop := buffer.find(end, at)) >= 0:
            head, _, text = buffer[at:stop].partition("\n")
            if not head.startswith(start):
                raise ValueError("a turn doesn't begin with its mark")
            yield unfield(head.removeprefix(start)), unguard(text)
            at = stop + len(end)
        buffer = buffer[at:]
    if buffer:
        raise ValueError("a turn isn't closed")


def read_conversations(formatted: DataFrame) -> DataFrame:
    """Read CHATML output back: digests of the turns and of the text under the loss mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for conv, parts in groupby(_rows(batches), key=lambda r: r["conv_id"]):
                turns, loss, n, chars, loss_chars = sha256(), sha256(), 0, 0, 0

                def texts(parts: Iterable[dict] = parts, loss: Any = loss) -> Iterator[str]:
                    nonlocal chars, loss_chars
                    for p in parts:
                        chars += len(p["formatted"])
                        for span in p["loss"]:
                            plain = unguard(p["formatted"][span["start"] : span["end"]])
                            loss_chars += len(plain)
                            loss.update(plain.encode("utf-8"))
                        yield p["formatted"]

                for role, text in _turns(texts()):
                    turns.update(f"{role}\n{text}\n".encode())
                    n += 1
                yield conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars
        yield from _batched(out(), _READ, lambda r: 200)

    return formatted.mapInArrow(
        run, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
