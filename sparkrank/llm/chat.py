"""Chat formatting with a template compiler.

A small, sandboxed template language is parsed into a syntax tree, constants are
folded, and the tree becomes Python closures that write a conversation turn by turn.
The language has text, ``{{ expression }}``, ``{% for x in messages %}``, ``{% if %}``
with ``elif`` and ``else``, ``{% set name = expression %}`` and
``{% generation %}...{% endgeneration %}``, which marks what a model is trained on.
Expressions are strings, numbers, ``true``/``false``/``none``, names, fields of a turn
(``m.role``, ``m.content``, ``m.index``, ``m.first``, ``m.last``), ``not and or``,
``== != < <= > >= in``, ``~`` (joins texts), ``+ - % *`` on numbers, and the filters
below. Nothing else can be reached from a template: no calls, no attributes. A name that was not
set shows nothing. A template outside the language raises ``TemplateError`` when it is compiled: unread
or unclosed marks, fields of anything but a turn of an open loop, a turn or ``messages`` as a value, sums
and orders of values whose kinds do not fit, remainders by zero. What depends on values that
are set while rendering raises it there, as do numbers beyond 64 bits.

Conversations are read in turn order from sorted partitions, one turn at a
time, and written in parts of bounded length, so a conversation may be longer than a task's
memory.

Defined cases: null text, role and turn count as empty text, empty role and a place before
all turns; equal turns are ordered by role, then text; repeated rows are turns of their own; rows with a
null ``conv_id`` form one conversation; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


PART_CHARS = 1 << 20

#: Fixed marks of the built-in template. Every mark starts with ``<`` or ``[``.
TEMPLATE = (
    "{% for m in messages %}"
    "{% if m.role == 'user' %}<s>[INST] {{ m.content | escape }} [/INST]"
    "{% elif m.role == 'assistant' %}[OUT]{% generation %}{{ m.content | escape }}{% endgeneration %}</s>"
    "{% else %}[ROLE]{{ m.role | escape }}[/ROLE]{{ m.content | escape }}[END]"
    "{% endif %}{% endfor %}"
)
TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\]|\[OUT\](.*?)</s>|\[ROLE\](.*?)\[/ROLE\](.*?)\[END\]", re.DOTALL)


def escape(text: str) -> str:
    """A backslash after each ``<`` and ``[``, so that no mark can stand in the text."""
    return text.replace("<", "<\\").replace("[", "[\\")


def unescape(text: str) -> str:
    return text.replace("<\\", "<").replace("[\\", "[")


class TemplateError(ValueError):
    """A template that the language does not allow."""


def _shown(value: object) -> str:
    return "" if value is None else str(value)


def _ordered(act: Callable) -> Callable:
    def run(a, b):
        try:
            return act(a, b)
        except TypeError:
            raise TemplateError(f"no order of {a!r} and {b!r}") from None

    return run


def _arithmetic(act: Callable) -> Callable:
    def run(a, b):
        for value in (a, b):
            if not isinstance(value, int):
                raise TemplateError(f"not a number: {value!r}")
        try:
            result = act(a, b)
        except ZeroDivisionError:
            raise TemplateError("remainder by zero") from None
        if not -LARGEST <= result <= LARGEST:
            raise TemplateError("a number is too large")
        return result

    return run


LARGEST = (1 << 63) - 1
FILTERS: dict[str, Callable[[object], object]] = {
    "escape": lambda v: escape(_shown(v)),
    "trim": lambda v: _shown(v).strip(),
    "lower": lambda v: _shown(v).lower(),
    "upper": lambda v: _shown(v).upper(),
    "length": lambda v: len(_shown(v)),
}
BINARY: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": _ordered(lambda a, b: a < b),
    "<=": _ordered(lambda a, b: a <= b),
    ">": _ordered(lambda a, b: a > b),
    ">=": _ordered(lambda a, b: a >= b),
    "in": lambda a, b: _shown(a) in _shown(b),
    "~": lambda a, b: f"{_shown(a)}{_shown(b)}",
    "+": _arithmetic(lambda a, b: a + b),
    "-": _arithmetic(lambda a, b: a - b),
    "*": _arithmetic(lambda a, b: a * b),
    "%": _arithmetic(lambda a, b: a % b),
}
LEVELS = (("==", "!=", "<", "<=", ">", ">=", "in"), ("~",), ("+", "-"), ("*", "%"))
FIELDS = {"role": "text", "content": "text", "index": "number", "first": "number", "last": "number"}
TOKEN = re.compile(r"\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[<>~+\-*%|.()]))")
PIECES = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.DOTALL)
NAME = re.compile(r"[A-Za-z_]\w*")
CONSTANTS = {"true": True, "false": False, "none": None}
RESERVED = {*CONSTANTS, "and", "or", "not", "in", "messages"}


# --- syntax tree: tuples of a kind and its parts -------------------------------------------


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at, source = 0, source.strip()
        while at < len(source):
            found = TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        self.at = 0

    def next_is(self, *values: str) -> str | None:
        if self.at < len(self.tokens):
            kind, value = self.tokens[self.at]
            if kind in ("op", "name") and value in values:
                self.at += 1
                return value
        return None

    def whole(self) -> tuple:
        node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.next_is("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.inverted()
        while self.next_is("and"):
            node = ("and", node, self.inverted())
        return node

    def inverted(self) -> tuple:
        return ("not", self.inverted()) if self.next_is("not") else self.level(0)

    def level(self, k: int) -> tuple:
        if k == len(LEVELS):
            return self.filtered()
        node = self.level(k + 1)
        while op := self.next_is(*LEVELS[k]):
            node = ("binary", op, node, self.level(k + 1))
        return node

    def filtered(self) -> tuple:
        node = self.single()
        while self.next_is("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            node = ("filter", name, node)
        return node

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError("a name is missing")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def single(self) -> tuple:
        if self.next_is("("):
            node = self.either()
            if not self.next_is(")"):
                raise TemplateError("a ) is missing")
            return node
        if self.at >= len(self.tokens):
            raise TemplateError("an expression is missing")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            marks = {"n": "\n", "t": "\t"}
            return ("value", re.sub(r"\\(.)", lambda m: marks.get(m[1], m[1]), value[1:-1]))
        if kind == "number":
            if len(value) > 18:
                raise TemplateError("a number is too large")
            return ("value", int(value))
        if kind != "name":
            raise TemplateError(f"unexpected {value!r}")
        if value in CONSTANTS:
            return ("value", CONSTANTS[value])
        if self.next_is("."):
            field = self.name()
            if field not in FIELDS:
                raise TemplateError(f"no field {field!r}")
            return ("field", value, field)
        return ("name", value)


def parse(source: str) -> list[tuple]:
    """The syntax tree of a template: a list of nodes."""
    pieces = [p for p in PIECES.split(source) if p]

    def block(at: int, ends: tuple[str, ...]) -> tuple[list[tuple], int, str]:
        nodes: list[tuple] = []
        while at < len(pieces):
            piece = pieces[at]
            at += 1
            if piece.startswith("{{"):
                nodes.append(("out", _Expression(piece[2:-2]).whole()))
            elif not piece.startswith("{%"):
                if "{{" in piece or "{%" in piece:
                    raise TemplateError(f"not closed: {piece[:40]!r}")
                nodes.append(("text", piece))
            else:
                head, _, rest = piece[2:-2].strip().partition(" ")
                if head in ends:
                    if rest.strip() and head != "elif":
                        raise TemplateError(f"unexpected {rest.strip()!r}")
                    return nodes, at, f"{head} {rest}".strip()
                if head == "for":
                    found = re.fullmatch(r"(\w+)\s+in\s+messages", rest.strip())
                    if not found:
                        raise TemplateError("loops go over messages only")
                    body, at, _ = block(at, ("endfor",))
                    nodes.append(("for", found[1], body))
                elif head == "if":
                    node, at = choice(at, rest)
                    nodes.append(node)
                elif head == "set":
                    name, _, value = rest.partition("=")
                    nodes.append(("set", name.strip(), _Expression(value).whole()))
                elif head == "generation" and not rest.strip():
                    body, at, _ = block(at, ("endgeneration",))
                    nodes.append(("generation", body))
                else:
                    raise TemplateError(f"no statement {head!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return nodes, at, ""

    def choice(at: int, test: str) -> tuple[tuple, int]:
        body, at, end = block(at, ("elif", "else", "endif"))
        other: list[tuple] = []
        if end.startswith("elif"):
            node, at = choice(at, end[4:])
            other = [node]
        elif end == "else":
            other, at, _ = block(at, ("endif",))
        return ("if", _Expression(test).whole(), body, other), at

    return block(0, ())[0]


def _kind(node: tuple, turns: frozenset[str]) -> str | None:
    """Whether an expression is a text, a number or none; null where that depends on values set while rendering."""
    kind = node[0]
    if kind == "value":
        return {int: "number", bool: "number", str: "text"}.get(type(node[1]), "none")
    if kind == "name":
        if node[1] in turns or node[1] in RESERVED:
            raise TemplateError(f"{node[1]} is no value")
        return None
    if kind == "field":
        if node[1] not in turns:
            raise TemplateError(f"{node[1]} is no turn of an open loop")
        return FIELDS[node[2]]
    if kind == "not":
        _kind(node[1], turns)
        return "number"
    if kind == "filter":
        _kind(node[2], turns)
        return "number" if node[1] == "length" else "text"
    left, right = _kind(node[-2], turns), _kind(node[-1], turns)
    if kind in ("and", "or"):
        return left if left == right else None
    op = node[1]
    if op in LEVELS[2] or op in LEVELS[3]:
        if not {left, right} <= {"number", None}:
            raise TemplateError(f"{op} takes numbers")
        return "number"
    if op in ("<", "<=", ">", ">=") and (left and right and left != right or "none" in (left, right)):
        raise TemplateError(f"no order of {left} and {right}")
    return "text" if op == "~" else "number"


def _check(nodes: list[tuple], turns: frozenset[str] = frozenset()) -> None:
    """Raise what is wrong with names and kinds of values."""
    for node in nodes:
        kind = node[0]
        if kind in ("for", "set"):
            if not NAME.fullmatch(node[1]) or node[1] in RESERVED or node[1] in turns:
                raise TemplateError(f"{node[1]!r} cannot be set here")
        if kind == "out":
            _kind(node[1], turns)
        elif kind == "set":
            _kind(node[2], turns)
        elif kind == "if":
            _kind(node[1], turns)
            _check(node[2], turns)
            _check(node[3], turns)
        elif kind == "for":
            _check(node[2], turns | {node[1]})
        elif kind == "generation":
            _check(node[1], turns)


def fold(node: tuple) -> tuple:
    """An expression whose constant parts are computed."""
    kind = node[0]
    if kind == "not":
        inner = fold(node[1])
        return ("value", not inner[1]) if inner[0] == "value" else ("not", inner)
    if kind in ("and", "or"):
        left, right = fold(node[1]), fold(node[2])
        if left[0] == "value":
            return right if bool(left[1]) == (kind == "and") else left
        return (kind, left, right)
    if kind == "binary":
        left, right = fold(node[2]), fold(node[3])
        if left[0] == right[0] == "value":
            return ("value", BINARY[node[1]](left[1], right[1]))
        return ("binary", node[1], left, right)
    if kind == "filter":
        inner = fold(node[2])
        return ("value", FILTERS[node[1]](inner[1])) if inner[0] == "value" else ("filter", node[1], inner)
    return node


def fold_block(nodes: list[tuple]) -> list[tuple]:
    """Statements with folded expressions, decided branches and joined texts."""
    out: list[tuple] = []
    for node in nodes:
        kind = node[0]
        if kind == "out":
            inner = fold(node[1])
            new = [("text", _shown(inner[1]))] if inner[0] == "value" else [("out", inner)]
        elif kind == "if":
            test, body, other = fold(node[1]), fold_block(node[2]), fold_block(node[3])
            new = (body if test[1] else other) if test[0] == "value" else [("if", test, body, other)]
        elif kind == "for":
            new = [("for", node[1], fold_block(node[2]))]
        elif kind == "generation":
            new = [("generation", fold_block(node[1]))]
        elif kind == "set":
            new = [("set", node[1], fold(node[2]))]
        else:
            new = [node]
        for n in new:
            if n[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + n[1])
            elif n != ("text", ""):
                out.append(n)
    return out


# --- closures ------------------------------------------------------------------------------


def _value(node: tuple) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "value":
        constant = node[1]
        return lambda env: constant
    if kind == "name":
        name = node[1]
        return lambda env: env.get(name)
    if kind == "field":
        name, field = node[1], node[2]
        return lambda env: env[name][field]
    if kind == "not":
        inner = _value(node[1])
        return lambda env: not inner(env)
    if kind == "filter":
        change, inner = FILTERS[node[1]], _value(node[2])
        return lambda env: change(inner(env))
    left, right = _value(node[-2]), _value(node[-1])
    if kind == "and":
        return lambda env: left(env) and right(env)
    if kind == "or":
        return lambda env: left(env) or right(env)
    act = BINARY[node[1]]
    return lambda env: act(left(env), right(env))


Writer = Callable[[dict, bool], Iterator[tuple[str, bool]]]


def _block(nodes: list[tuple]) -> Writer:
    """A closure that yields pieces of text, each with whether it is generated."""
    steps = [_statement(n) for n in nodes]

    def run(env, marked):
        for step in steps:
            yield from step(env, marked)

    return steps[0] if len(steps) == 1 else run


def _statement(node: tuple) -> Writer:
    kind = node[0]
    if kind == "text":
        text = node[1]

        def run(env, marked):
            yield text, marked
    elif kind == "out":
        value = _value(node[1])

        def run(env, marked):
            yield _shown(value(env)), marked
    elif kind == "set":
        name, value = node[1], _value(node[2])

        def run(env, marked):
            env[name] = value(env)
            return iter(())

        return run
    elif kind == "generation":
        body = _block(node[1])

        def run(env, marked):
            return body(env, True)
    elif kind == "if":
        test, body, other = _value(node[1]), _block(node[2]), _block(node[3])

        def run(env, marked):
            return body(env, marked) if test(env) else other(env, marked)
    else:
        name, body = node[1], _block(node[2])

        def run(env, marked):
            for turn in env["messages"]:
                env[name] = turn
                yield from body(env, marked)
                yield "", False  # the end of a turn, where a part may end

    return run


def _loops(nodes: list[tuple]) -> int:
    return sum((n[0] == "for") + sum(_loops(x) for x in n if isinstance(x, list)) for n in nodes)


class Template:
    """A compiled template. ``render`` takes turns (role, content) from an iterator."""

    def __init__(self, source: str):
        try:
            tree = parse(source)
            _check(tree)
            self.tree = fold_block(tree)
            self.loops = _loops(self.tree)
            self.write = _block(self.tree)
        except RecursionError:
            raise TemplateError("nested too deeply") from None

    def render(self, turns: Iterable[tuple[str, str]]) -> Iterator[tuple[str, bool]]:
        """Pieces of the formatted text and whether they are generated.

        With one loop over the messages, turns are read as they are needed and
        none is kept.
        """

        def messages():
            held = None
            for index, (role, content) in enumerate(turns):
                if held:
                    yield held
                held = {"role": role, "content": content, "index": index, "first": index == 0, "last": False}
            if held:
                held["last"] = True
                yield held

        return self.write({"messages": messages() if self.loops < 2 else list(messages())}, False)


# --- Spark ---------------------------------------------------------------------------------

FORMATTED = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()), ("spans", pa.list_(pa.list_(pa.int64())))])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, str, str]]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _runs(rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Neighbouring rows of one first value, read only once and in order."""
    row = next(rows, None)
    while row is not None:
        key = row[0]

        def run(first):
            nonlocal row
            row = first
            while row is not None and row[0] == key:
                yield row
                row = next(rows, None)

        own = run(row)
        yield key, own
        for _ in own:  # what was not read
            pass


def _format(source: str, part_chars: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(source)
        done: list[tuple] = []
        size = 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), FORMATTED, strict=True)], schema=FORMATTED)

        for conv_id, turns in _runs(_rows(batches)):
            number, chars, pieces, spans = 0, 0, [], []
            for text, marked in chain(template.render((r[1], r[2]) for r in turns), [(None, False)]):
                if text:
                    if marked:
                        spans.append([chars, chars + len(text)])
                    pieces.append(text)
                    chars += len(text)
                elif text is None and (pieces or not number) or chars >= part_chars:
                    done.append((conv_id, number, "".join(pieces), spans))
                    size += chars
                    number, chars, pieces, spans = number + 1, 0, [], []
                    if size >= part_chars:
                        yield batch()
                        done, size = [], 0
        if done:
            yield batch()

    return run


def format_conversations(turns: DataFrame, template: str = TEMPLATE, part_chars: int = PART_CHARS) -> DataFrame:
    """``conv_id, part, formatted, spans`` for conversations given as rows ``conv_id, turn, role, text``.

    The formatted conversation is its parts, joined in order; most have one.
    A part ends with a turn, once it has ``part_chars`` characters. ``spans`` are
    start and end, in code points of the part, of generated text.
    """
    Template(template)  # errors of the template show here
    empty = F.lit("")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
        F.col("turn").alias("turn"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    ddl = "conv_id long, part long, formatted string, spans array<array<long>>"
    return ordered.select("conv_id", "role", "text").mapInArrow(_format(template, part_chars), ddl)


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """Role and text of each turn in a text that the built-in template wrote."""
    at = 0
    while at < len(formatted):
        found = TURN.match(formatted, at)
        if not found:
            raise ValueError(f"not a turn: {formatted[at : at + 40]!r}")
        user, assistant, role, other = found.groups()
        if user is not None:
            yield "user", unescape(user)
        elif assistant is not None:
            yield "assistant", unescape(assistant)
        else:
            yield unescape(role), unescape(other)
        at = found.end()


DIGESTS = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: list[tuple] = []
    for conv_id, parts in _runs(_rows(batches)):
        n = loss_chars = chars = 0
        turns, loss = hashlib.sha256(), hashlib.sha256()
        for _, _, formatted, spans in parts:
            chars += len(formatted)
            for role, text in read_turns(formatted):
                n += 1
                turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            for start, end in spans:
                text = unescape(formatted[start:end])
                loss_chars += len(text)
                loss.update(text.encode("utf-8", "surrogatepass"))
        done.append((conv_id, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
        if len(done) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), DIGESTS, strict=True)], schema=DIGESTS)
            done = []
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), DIGESTS, strict=True)], schema=DIGESTS)


def digests(formatted: DataFrame) -> DataFrame:
    """What is read back from formatted conversations, one row for each.

    Takes the result of ``format_conversations`` with the built-in template as it
    comes: the parts of a conversation follow each other in one partition.
    """
    ddl = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.mapInArrow(_digest, ddl)
