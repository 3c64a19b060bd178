"""Chat formatting by a small template language, compiled to Python closures.

A template is text with ``{{ expression }}`` and ``{% statement %}``. Statements are
``for NAME in messages`` ... ``endfor``, ``if`` / ``elif`` / ``else`` / ``endif`` and
``generation`` ... ``endgeneration``, which marks what a model is to learn. Expressions are
string and integer literals, ``NAME.field``, ``NAME.first``, ``NAME.index``, ``+``, ``==``,
``!=``, ``and``, ``or``, ``not``, parentheses and the filters ``trim``, ``upper``, ``lower``
and ``escape``. There are no calls, no attributes of Python objects and no other loops, so a
template can reach nothing but the rows it is given.

The text is parsed to a syntax tree, constant parts are folded (literal sums and
comparisons, branches with a known condition, neighbouring texts), and each node becomes a
closure that yields (text, learned) pieces. The loop runs over an iterator, so a
conversation of any length is rendered turn by turn.

``escape`` puts ``\\`` before each control character of the template's control strings
(and before itself): the marks themselves can then stand nowhere but where the template
puts them, and ``unescape`` gives the text back.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortloom.llm.common import arrow_types

Piece = tuple[str, bool]

# Turn marks of this template; texts are escaped so that none of them can occur inside.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")
TEMPLATE = (
    "{% for m in messages %}{% if m.role == 'assistant' %}"
    "[ROLE]{{ m.role | escape }}[/ROLE]{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% else %}<s>[ROLE]{{ m.role | escape }}[/ROLE][INST]{{ m.text | escape }}[/INST]{% endif %}"
    "{% endfor %}"
)
SPECIAL = re.compile(r"([\\<\[])")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)

TOKEN = re.compile(
    r"\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|[+.|()]))"
)
FILTERS: dict[str, Callable[[str], str]] = {
    "trim": str.strip, "upper": str.upper, "lower": str.lower, "escape": lambda s: escape(s),
}


class TemplateError(ValueError):
    """The template is not of the language."""


def escape(text: str) -> str:
    return SPECIAL.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


# The syntax tree: expressions


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Field:
    name: str
    field: str


@dataclass(frozen=True)
class Op:
    sign: str
    parts: tuple


@dataclass(frozen=True)
class Filter:
    name: str
    of: object


# and statements


@dataclass(frozen=True)
class Out:
    value: object


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body)


@dataclass(frozen=True)
class For:
    name: str
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


class Expression:
    """Recursive descent over one expression."""

    def __init__(self, text: str, names: frozenset[str]) -> None:
        self.tokens: list[tuple[str, str]] = []
        at, text = 0, text.strip()
        while at < len(text):
            m = TOKEN.match(text, at)
            if not m:
                raise TemplateError(f"cannot read {text[at:]!r}")
            self.tokens.append((m.lastgroup or "", m[m.lastgroup or 0]))
            at = m.end()
        self.names, self.at = names, 0

    def peek(self) -> str:
        return self.tokens[self.at][1] if self.at < len(self.tokens) else ""

    def take(self, *values: str) -> str:
        value = self.peek()
        if not value or values and value not in values:
            raise TemplateError(f"expected {' or '.join(values) or 'more'}, found {value!r}")
        self.at += 1
        return value

    def whole(self) -> object:
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.peek()!r}")
        return tree

    def chain(self, below: Callable[[], object], *signs: str) -> object:
        tree = below()
        while self.peek() in signs:
            tree = Op(self.take(), (tree, below()))
        return tree

    def either(self) -> object:
        return self.chain(self.both, "or")

    def both(self) -> object:
        return self.chain(self.negated, "and")

    def negated(self) -> object:
        if self.peek() == "not":
            self.take()
            return Op("not", (self.negated(),))
        return self.chain(self.total, "==", "!=")

    def total(self) -> object:
        return self.chain(self.filtered, "+")

    def filtered(self) -> object:
        tree = self.atom()
        while self.peek() == "|":
            self.take()
            tree = Filter(self.take(*FILTERS), tree)
        return tree

    def atom(self) -> object:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
        self.take()
        if kind == "text":
            return Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), value[1:-1]))
        if kind == "number":
            return Const(int(value))
        if value == "(":
            tree = self.either()
            self.take(")")
            return tree
        if kind == "name" and value in self.names:
            self.take(".")
            return Field(value, self.take("role", "text", "first", "index"))
        raise TemplateError(f"unexpected {value!r}")


def parse(template: str) -> tuple:
    """Template text to statements."""
    parts = re.split(r"(\{\{.*?\}\}|\{%.*?%\})", template, flags=re.DOTALL)
    at = 0

    def block(ends: tuple[str, ...], names: frozenset[str]) -> tuple[tuple, str]:
        nonlocal at
        body: list[object] = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{") and part.endswith("}}"):
                body.append(Out(Expression(part[2:-2], names).whole()))
            elif part.startswith("{%") and part.endswith("%}"):
                said = part[2:-2].strip()
                word = said.split(" ", 1)[0]
                if word in ends:
                    return tuple(body), said
                body.append(statement(said, word, names))
            elif part:
                body.append(Out(Const(part)))
        if ends:
            raise TemplateError(f"no {ends[-1]}")
        return tuple(body), ""

    def statement(said: str, word: str, names: frozenset[str]) -> object:
        if word == "for":
            m = re.fullmatch(r"for\s+([A-Za-z_]\w*)\s+in\s+messages", said)
            if not m or names:
                raise TemplateError(f"a loop must be 'for NAME in messages' and stand alone: {said!r}")
            return For(m[1], block(("endfor",), names | {m[1]})[0])
        if word == "generation":
            return Generation(block(("endgeneration",), names)[0])
        if word != "if":
            raise TemplateError(f"unknown statement {said!r}")
        branches = []
        while word in ("if", "elif"):
            condition = Expression(said[len(word):], names).whole()
            body, said = block(("elif", "else", "endif"), names)
            branches.append((condition, body))
            word = said.split(" ", 1)[0]
        if word == "else":
            branches.append((Const(True), block(("endif",), names)[0]))
        return If(tuple(branches))

    return block((), frozenset())[0]


def fold(node: object) -> object:
    """The same tree with constant expressions, branches and neighbouring texts put together."""
    if isinstance(node, Op):
        parts = tuple(fold(p) for p in node.parts)
        folded = Op(node.sign, parts)
        return Const(value(folded)({})) if all(isinstance(p, Const) for p in parts) else folded
    if isinstance(node, Filter):
        inner = Filter(node.name, fold(node.of))
        return Const(value(inner)({})) if isinstance(inner.of, Const) else inner
    if isinstance(node, Out):
        return Out(fold(node.value))
    if isinstance(node, For):
        return For(node.name, fold_all(node.body))
    if isinstance(node, Generation):
        return Generation(fold_all(node.body))
    return node


def fold_all(body: tuple) -> tuple:
    out: list[object] = []
    for node in body:
        for x in fold_branches(node) if isinstance(node, If) else (fold(node),):
            last = out[-1] if out else None
            if all(isinstance(o, Out) and isinstance(o.value, Const) for o in (x, last)):
                out[-1] = Out(Const(str(last.value.value) + str(x.value.value)))
            else:
                out.append(x)
    return tuple(out)


def fold_branches(node: If) -> tuple:
    """The branches whose condition is not known; of a first one known to hold, its body."""
    branches = []
    for condition, inner in ((fold(c), b) for c, b in node.branches):
        if isinstance(condition, Const) and not condition.value:
            continue
        branches.append((condition, fold_all(inner)))
        if isinstance(condition, Const):
            break
    if branches and isinstance(branches[0][0], Const):
        return branches[0][1]
    return (If(tuple(branches)),) if branches else ()


def value(node: object) -> Callable[[dict], object]:
    """An expression as a closure over the names in scope."""
    if isinstance(node, Const):
        return lambda scope, v=node.value: v
    if isinstance(node, Field):
        return lambda scope, n=node.name, f=node.field: scope[n][f]
    if isinstance(node, Filter):
        return lambda scope, f=FILTERS[node.name], of=value(node.of): f(str(of(scope)))
    left, *right = map(value, node.parts)
    if node.sign == "not":
        return lambda scope: not left(scope)
    other = right[0]
    return {
        "+": lambda scope: plus(left(scope), other(scope)),
        "==": lambda scope: left(scope) == other(scope),
        "!=": lambda scope: left(scope) != other(scope),
        "and": lambda scope: left(scope) and other(scope),
        "or": lambda scope: left(scope) or other(scope),
    }[node.sign]


def plus(a: object, b: object) -> object:
    return a + b if isinstance(a, int) and isinstance(b, int) else f"{a}{b}"


Render = Callable[[dict, Iterable[dict], bool], Iterator[Piece]]


def run(node: object) -> Render:
    """A statement as a closure that yields (text, learned)."""
    if isinstance(node, Out):
        said = value(node.value)

        def out(scope, messages, learned):
            yield str(said(scope)), learned

        return out
    if isinstance(node, Generation):
        body = run_all(node.body)
        return lambda scope, messages, learned: body(scope, messages, True)
    if isinstance(node, If):
        branches = [(value(c), run_all(b)) for c, b in node.branches]

        def choose(scope, messages, learned):
            for condition, body in branches:
                if condition(scope):
                    yield from body(scope, messages, learned)
                    return

        return choose
    body = run_all(node.body)

    def loop(scope, messages, learned):
        for index, message in enumerate(messages):
            inner = {**message, "first": index == 0, "index": index}
            yield from body({**scope, node.name: inner}, (), learned)

    return loop


def run_all(body: tuple) -> Render:
    steps = [run(node) for node in body]

    def sequence(scope, messages, learned):
        for step in steps:
            yield from step(scope, messages, learned)

    return sequence


def compile_template(template: str) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """A function from messages ({role, text}) to pieces."""
    body = run_all(fold_all(parse(template)))
    return lambda messages: body({}, messages, False)


# Spark


PIECES = "conv_id long, piece long, text string, learned boolean"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _emit(rows: Iterator[tuple], kinds: dict[str, pa.DataType], most: int = 4096) -> Iterator[pa.RecordBatch]:
    while lot := list(itertools.islice(rows, most)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lot), kinds.values())], names=list(kinds))


def format_conversations(
    conversations: DataFrame,
    template: str = TEMPLATE,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """Render every conversation; its text is the pieces in order, the loss mask is ``learned``.

    Rows are sorted by (conversation, turn, role, text) inside hash partitions and rendered
    as they pass, so no conversation is held as a whole. Null texts and roles are empty;
    equal turns follow by role and text; rows without an id are one conversation.
    """
    kinds = arrow_types(conversations.sparkSession, PIECES)

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = compile_template(template)

        def pieces() -> Iterator[tuple]:
            for conv, rows in itertools.groupby(_rows(batches), key=lambda r: r[0]):
                messages = ({"role": r[1], "text": r[2]} for r in rows)
                for nth, (text, learned) in enumerate(compiled(messages)):
                    yield conv, nth, text, learned

        return _emit(pieces(), kinds)

    rows = conversations.select(
        F.col(id_column).cast("long").alias("conv_id"),
        F.col(turn_column).alias("turn"),
        F.coalesce(F.col(role_column), F.lit("")).alias("role"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(render, PIECES)


TURN = re.compile(r"(?:<s>)?\[ROLE\]((?:[^\\\[<]|\\.)*)\[/ROLE\](?:\[INST\]((?:[^\\\[<]|\\.)*)\[/INST\]|((?:[^\\\[<]|\\.)*)</s>)", re.DOTALL)
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class Digest:
    """What is read back from the formatted text of one conversation, piece by piece."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.rest, self.learned = "", ""

    def add(self, text: str, learned: bool) -> None:
        self.chars += len(text)
        if learned:
            # a mask's piece may end inside an escape; the backslash waits for the next one
            plain = self.learned + text
            odd = (len(plain) - len(plain.rstrip("\\"))) % 2
            self.learned = plain[len(plain) - odd:]
            plain = unescape(plain[: len(plain) - odd])
            self.loss_chars += len(plain)
            self.loss.update(plain.encode("utf-8", "surrogatepass"))
        self.rest += text
        if text.endswith(("</s>", "[/INST]")) or "</s>" in text or "[/INST]" in text:
            self.read()

    def read(self) -> None:
        at = 0
        while m := TURN.match(self.rest, at):
            said = m[2] if m[2] is not None else m[3]
            self.turns.update(f"{unescape(m[1])}\n{unescape(said)}\n".encode("utf-8", "surrogatepass"))
            self.n_turns += 1
            at = m.end()
        self.rest = self.rest[at:]

    def row(self, conv: int | None) -> tuple:
        if self.rest:
            raise ValueError(f"conversation {conv}: text after the last turn: {self.rest[:80]!r}")
        return conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and learned text of each conversation, parsed from its formatted text.

    ``formatted`` is in the order it was written in: conversations one after the other.
    """
    kinds = arrow_types(formatted.sparkSession, DIGESTS)

    def parse_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests() -> Iterator[tuple]:
            for conv, rows in itertools.groupby(_rows(batches), key=lambda r: r[0]):
                digest = Digest()
                for _, text, learned in rows:
                    digest.add(text, learned)
                yield digest.row(conv)

        return _emit(digests(), kinds)

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return ordered.select("conv_id", "text", "learned").mapInArrow(parse_all, DIGESTS)


def extra_conversation(spark: SparkSession, said: str, conv_id: int) -> DataFrame:
    """A user and an assistant row with one text."""
    return spark.range(2).select(
        F.lit(conv_id).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
