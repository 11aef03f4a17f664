"""Chat formatting: a sandboxed template language is parsed to a tree, folded, and compiled to Python closures."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import table

# Inside texts these characters are written as two, so that no control string can occur there.
ESCAPES = {"\\": "\\\\", "<": "\\l", ">": "\\g", "[": "\\b"}
_BACK = {v[1]: k for k, v in ESCAPES.items()}
_TABLE = str.maketrans(ESCAPES)

TEMPLATE = """\
{% for message in messages %}<|{{ message.role | escape }}|>
{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}\
{% else %}{{ message.text | escape }}{% endif %}<|end|>
{% endfor %}"""


def escape(text: str) -> str:
    return text.translate(_TABLE)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _BACK[m[1]], text)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": lambda s: s.strip(" \t\r\n"), "upper": str.upper, "lower": str.lower}


class TemplateError(ValueError):
    pass


# Syntax tree. Expressions: Const, Name, Field, Filter, Unary, Binary. Statements: Emit, For, If, Generation.
@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: object
    key: object


@dataclass(frozen=True)
class Filter:
    of: object
    name: str


@dataclass(frozen=True)
class Unary:
    of: object


@dataclass(frozen=True)
class Binary:
    op: str
    left: object
    right: object


@dataclass(frozen=True)
class Emit:
    value: object


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body)


@dataclass(frozen=True)
class Generation:
    body: tuple


_PARTS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[+|.\[\]()]))")
_TEXT_ESCAPES = {"n": "\n", "t": "\t"}


def _tokens(code: str) -> list[tuple[str, object]]:
    found, at, code = [], 0, code.strip()
    while at < len(code):
        m = _TOKEN.match(code, at)
        if not m:
            raise TemplateError(f"cannot read {code[at:]!r}")
        at = m.end()
        text, number, name, sign = m.groups()
        if text is not None:
            found.append(("const", re.sub(r"\\(.)", lambda e: _TEXT_ESCAPES.get(e[1], e[1]), text[1:-1], flags=re.S)))
        elif number is not None:
            found.append(("const", int(number)))
        else:
            found.append(("name", name) if name else ("sign", sign))
    return found


class _Expression:
    """Recursive descent: or, and, not, comparison, +, filter, field. No calls and no attributes of Python objects."""

    def __init__(self, code: str):
        self.tokens = _tokens(code)
        self.at = 0

    def peek(self, kind: str, *values: object) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] == kind and (not values or self.tokens[self.at][1] in values)

    def take(self, kind: str, *values: object) -> object:
        if not self.peek(kind, *values):
            raise TemplateError(f"expected {' or '.join(map(str, values)) or kind} in {self.tokens}")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self) -> object:
        tree = self.chain(("or",), lambda: self.chain(("and",), self.negation, "name"), "name")
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def chain(self, signs: tuple, below: Callable[[], object], kind: str = "sign") -> object:
        tree = below()
        while self.peek(kind, *signs):
            op = self.take(kind)
            tree = Binary(str(op), tree, below())
        return tree

    def negation(self) -> object:
        if self.peek("name", "not"):
            self.take("name")
            return Unary(self.negation())
        return self.chain(("==", "!="), lambda: self.chain(("+",), self.filtered))

    def filtered(self) -> object:
        tree = self.field()
        while self.peek("sign", "|"):
            self.take("sign")
            name = str(self.take("name"))
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = Filter(tree, name)
        return tree

    def field(self) -> object:
        if self.peek("const"):
            tree: object = Const(self.take("const"))
        elif self.peek("sign", "("):
            self.take("sign")
            tree = self.chain(("or",), lambda: self.chain(("and",), self.negation, "name"), "name")
            self.take("sign", ")")
        else:
            name = self.take("name")
            tree = Const(name == "true") if name in ("true", "false") else Name(str(name))
        while self.peek("sign", ".", "["):
            if self.take("sign") == ".":
                tree = Field(tree, Const(self.take("name")))
            else:
                tree = Field(tree, self.chain(("+",), self.filtered))
                self.take("sign", "]")
        return tree


def parse(template: str) -> tuple:
    """The statements of a template."""
    pieces, at = [], 0
    for m in _PARTS.finditer(template):
        if m.start() > at:
            pieces.append(("text", template[at : m.start()]))
        if m[1] is not None:
            pieces.append(("value", m[1]))
        elif m[2] is not None:
            pieces.append(("tag", m[2].strip()))
        at = m.end()
    if at < len(template):
        pieces.append(("text", template[at:]))
    body, rest, _ = _block(pieces, 0, ())
    if rest < len(pieces):
        raise TemplateError(f"unexpected {pieces[rest][1]!r}")
    return body


def _block(pieces: list, at: int, ends: tuple) -> tuple[tuple, int, str]:
    """Statements up to a tag whose first word is in ``ends``; the place after it, and the tag."""
    body: list = []
    while at < len(pieces):
        kind, code = pieces[at]
        at += 1
        if kind == "text":
            body.append(Emit(Const(code)))
            continue
        if kind == "value":
            body.append(Emit(_Expression(code).whole()))
            continue
        word, _, rest = code.partition(" ")
        if word in ends:
            return tuple(body), at, code
        if word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
            if not m:
                raise TemplateError(f"cannot read {code!r}")
            inner, at, _ = _block(pieces, at, ("endfor",))
            body.append(For(m[1], _Expression(m[2]).whole(), inner))
        elif word == "if":
            branches, condition = [], _Expression(rest).whole()
            while True:
                inner, at, tag = _block(pieces, at, ("elif", "else", "endif"))
                branches.append((condition, inner))
                word, _, rest = tag.partition(" ")
                if word == "endif":
                    break
                condition = Const(True) if word == "else" else _Expression(rest).whole()
            body.append(If(tuple(branches)))
        elif word == "generation":
            inner, at, _ = _block(pieces, at, ("endgeneration",))
            body.append(Generation(inner))
        else:
            raise TemplateError(f"unknown tag {code!r}")
    if ends:
        raise TemplateError(f"missing {' or '.join(ends)}")
    return tuple(body), at, ""


def _evaluate(op: str, left: object, right: object) -> object:
    if op == "==":
        return left == right
    if op == "!=":
        return left != right
    if isinstance(left, str) and isinstance(right, str) or isinstance(left, int) and isinstance(right, int):
        return left + right
    raise TemplateError("+ takes two texts or two numbers")


def fold(node: object) -> object:
    """The same tree with constant expressions computed, dead branches cut and neighbouring texts joined."""
    if isinstance(node, tuple):
        done: list = []
        for part in map(fold, node):
            for one in part if isinstance(part, tuple) else (part,):
                if isinstance(one, Emit) and isinstance(one.value, Const):
                    if done and isinstance(done[-1], Emit) and isinstance(done[-1].value, Const):
                        one = Emit(Const(str(done.pop().value.value) + str(one.value.value)))
                    if one.value.value == "":
                        continue
                done.append(one)
        return tuple(done)
    if isinstance(node, Emit):
        return Emit(fold(node.value))
    if isinstance(node, Field):
        return Field(fold(node.of), fold(node.key))
    if isinstance(node, Filter):
        of = fold(node.of)
        return Const(FILTERS[node.name](str(of.value))) if isinstance(of, Const) else Filter(of, node.name)
    if isinstance(node, Unary):
        of = fold(node.of)
        return Const(not of.value) if isinstance(of, Const) else Unary(of)
    if isinstance(node, Binary):
        left, right = fold(node.left), fold(node.right)
        if node.op in ("and", "or") and isinstance(left, Const):
            return right if bool(left.value) == (node.op == "and") else left
        if isinstance(left, Const) and isinstance(right, Const):
            return Const(_evaluate(node.op, left.value, right.value))
        return Binary(node.op, left, right)
    if isinstance(node, For):
        return For(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, If):
        live = []
        for condition, body in node.branches:
            condition = fold(condition)
            if isinstance(condition, Const) and not condition.value:
                continue
            live.append((condition, fold(body)))
            if isinstance(condition, Const):
                break
        if live and isinstance(live[0][0], Const):
            return live[0][1]
        return If(tuple(live)) if live else ()
    return node


# A rendered part is (text, whether a model is trained on it); END ends a round of the outermost loop.
Part = tuple[str, bool]
END: Part = ("", False)


def _value(node: object) -> Callable[[dict], object]:
    if isinstance(node, Const):
        constant = node.value
        return lambda scope: constant
    if isinstance(node, Name):
        name = node.name

        def look(scope: dict) -> object:
            if name not in scope:
                raise TemplateError(f"no value named {name!r}")
            return scope[name]

        return look
    if isinstance(node, Field):
        of, key = _value(node.of), _value(node.key)

        def get(scope: dict) -> object:
            holder = of(scope)
            if not isinstance(holder, dict):
                raise TemplateError("only records have fields")
            return holder.get(key(scope), "")

        return get
    if isinstance(node, Filter):
        of, apply = _value(node.of), FILTERS[node.name]
        return lambda scope: apply(str(of(scope)))
    if isinstance(node, Unary):
        of = _value(node.of)
        return lambda scope: not of(scope)
    left, right, op = _value(node.left), _value(node.right), node.op
    if op == "and":
        return lambda scope: left(scope) and right(scope)
    if op == "or":
        return lambda scope: left(scope) or right(scope)
    return lambda scope: _evaluate(op, left(scope), right(scope))


def _run(body: tuple, trained: bool, outer: bool) -> Callable[[dict], Iterator[Part]]:
    steps = [_step(node, trained, outer) for node in body]

    def run(scope: dict) -> Iterator[Part]:
        for step in steps:
            yield from step(scope)

    return run


def _step(node: object, trained: bool, outer: bool) -> Callable[[dict], Iterable[Part]]:
    if isinstance(node, Emit):
        if isinstance(node.value, Const):
            fixed = ((str(node.value.value), trained),)
            return lambda scope: fixed
        value = _value(node.value)
        return lambda scope: ((str(value(scope)), trained),)
    if isinstance(node, Generation):
        return _run(node.body, True, outer)
    if isinstance(node, If):
        branches = [(_value(c), _run(b, trained, outer)) for c, b in node.branches]

        def choose(scope: dict) -> Iterator[Part]:
            for condition, inner in branches:
                if condition(scope):
                    yield from inner(scope)
                    return

        return choose
    over, inner, name = _value(node.over), _run(node.body, trained, False), node.name

    def loop(scope: dict) -> Iterator[Part]:
        items = over(scope)
        if isinstance(items, (str, dict)) or not isinstance(items, Iterable):
            raise TemplateError("only lists can be looped over")
        rest = iter(items)
        following = next(rest, None)
        index = 0
        while following is not None:
            item, following = following, next(rest, None)
            yield from inner(scope | {name: item, "loop": {"index": index + 1, "index0": index, "first": index == 0, "last": following is None}})
            index += 1
            if outer:
                yield END

    return loop


def compile_template(template: str = TEMPLATE) -> Callable[[Iterable[dict]], Iterator[Part]]:
    """A renderer: records of a conversation, which may come from a stream, to rendered parts in order."""
    run = _run(fold(parse(template)), False, True)
    return lambda messages: run({"messages": messages})


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield conv, role or "", text or ""


def format_conversations(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, piece, formatted, loss_spans): each conversation rendered, a row per round of the template's outer loop.

    The pieces of a conversation in order are its formatted text; ``loss_spans`` are (start, end) in code points of the
    piece. Turns go by turn, then role and text; null turns come last. A conversation is streamed, so its length does not
    matter for memory. Null roles and texts are empty, rows that repeat a turn are turns of their own, rows with a null
    conv_id form one conversation, an empty table gives an empty result, and other columns are ignored. The pieces stay
    sorted by conversation within partitions.
    """
    fields = rows.select("conv_id", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"), F.col("turn").alias("turn"))
    ready = fields.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_last(), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    )
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("piece", pa.int64()),
            ("formatted", pa.string()),
            ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render, held, size = compile_template(template), [], 0
        for conv, turns in groupby(_turns(batches), key=lambda t: t[0]):
            number, texts, spans, length = 0, [], [], 0
            parts = render({"role": role, "text": text} for _, role, text in turns)
            for part in parts:
                if part is END:
                    held.append((conv, number, "".join(texts), spans))
                    size += length
                    number, texts, spans, length = number + 1, [], [], 0
                    if size > 4_000_000 or len(held) >= 5_000:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, h, strict=True)) for h in held], schema=schema)
                        held, size = [], 0
                    continue
                text, trained = part
                if trained:
                    if spans and spans[-1]["end"] == length:
                        spans[-1]["end"] += len(text)
                    else:
                        spans.append({"start": length, "end": length + len(text)})
                texts.append(text)
                length += len(text)
            if length:
                held.append((conv, number, "".join(texts), spans))
                size += length
        if held:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, h, strict=True)) for h in held], schema=schema)

    return ready.select("conv_id", "role", "text").mapInArrow(
        work, "conv_id long, piece long, formatted string, loss_spans array<struct<start: long, end: long>>"
    )


_TURN = re.compile(r"<\|([^<>]*)\|>\n([^<>]*)<\|end\|>\n")


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests of what is read from the default template's pieces, which lie in order within partitions as they are made:
    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        def digests() -> Iterator[tuple]:
            for conv, own in groupby(rows(), key=lambda r: r[0]):
                turns, loss, n, lost, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                for _, formatted, spans in own:
                    at = 0
                    for m in _TURN.finditer(formatted):
                        if m.start() != at:
                            raise ValueError(f"unreadable text at {at} in conversation {conv}")
                        at = m.end()
                        turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                        n += 1
                    if at != len(formatted):
                        raise ValueError(f"unreadable text at {at} in conversation {conv}")
                    for span in spans:
                        text = unescape(formatted[span["start"] : span["end"]])
                        loss.update(text.encode())
                        lost += len(text)
                    chars += len(formatted)
                yield conv, n, turns.hexdigest(), lost, loss.hexdigest(), chars

        found: list[tuple] = []
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=names)

        for row in digests():
            found.append(row)
            if len(found) >= 10_000:
                yield batch_of(found)
                found = []
        if found:
            yield batch_of(found)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return pieces.select("conv_id", "formatted", "loss_spans").mapInArrow(work, schema)


CHECK_TEXT = "</s>[INST] ok [/INST]"


def op9_chat_format(spark, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CHECK_TEXT).alias("text")
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_conversations(rows.unionByName(extra)))


OP9_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(regexp_replace(role, '[\\<>\[]', '..', 'g')) + length(regexp_replace(text, '[\\<>\[]', '..', 'g')) + 13) AS BIGINT)
           AS formatted_chars
FROM turns GROUP BY conv_id
"""
