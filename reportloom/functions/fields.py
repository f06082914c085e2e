"""Fields of front matter: a fold over its lines that keeps a stack of open keys."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: ``name:`` at the start of a line, the name plain or quoted, and what follows.
_KEY = re.compile(r"""(?:'(?P<one>(?:[^']|'')*)'|"(?P<two>(?:[^"\\]|\\.)*)"|(?P<plain>[^\s#'"\[\]{},&*!|>%@`?-](?:[^\s:#]|:(?=\S)|\s(?![#]))*?|-\S(?:[^\s:#]|:(?=\S)|\s(?![#]))*?))\s*:(?:[ \t]+|$)""")
_CLOSED = {'"': re.compile(r'"((?:[^"\\]|\\.)*)"', re.S), "'": re.compile(r"'((?:[^']|'')*)'(?!')", re.S)}
_ESCAPE = re.compile(r"\\(x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|\n[ \t]*|.)|[ \t]*\n[ \t]*(?:\n[ \t]*)*", re.S)
_BREAK = re.compile(r"[ \t]*\n[ \t]*(?:\n[ \t]*)*")
_BLOCK = re.compile(r"([|>])([+-]?)\d?([+-]?)\s*(?:#.*)?$")
_FLOW = re.compile(r"""\s*(?:'((?:[^']|'')*)'|"((?:[^"\\]|\\.)*)"|([^,\[\]{}'"]*))\s*(?:,|$)""", re.S)
# Plain scalars that stand for null, and what single-letter escapes stand for.
_NULLS = {"", "~", "null", "Null", "NULL"}
_LETTERS = {"0": "\0", "a": "\a", "b": "\b", "t": "\t", "n": "\n", "v": "\v", "f": "\f", "r": "\r", "e": "\x1b", "N": "\x85", "_": "\xa0", "L": "\u2028", "P": "\u2029"}

KIND = "struct<fields: map<string, string>, lists: map<string, array<string>>, problem: string>"
_ARROW = pa.struct([("fields", pa.map_(pa.string(), pa.string())), ("lists", pa.map_(pa.string(), pa.list_(pa.string()))), ("problem", pa.string())])


class Fields:
    """What a block of lines states: scalars and lists by path (``relationships.related``), and the first problem."""

    def __init__(self, block: str) -> None:
        self.lines = block.split("\n")
        self.at = 0
        self.scalars: dict[str, str | None] = {}
        self.lists: dict[str, list[str | None]] = {}
        self.problem: str | None = None
        #: keys whose value is below them, outermost first, by indent
        self.open: list[tuple[int, str]] = []
        while self.at < len(self.lines):
            line = self.lines[self.at]
            body = line.strip()
            self.at += 1
            if body and not body.startswith("#"):
                self.entry(len(line) - len(line.lstrip(" ")), body)

    def entry(self, indent: int, body: str) -> None:
        if body == "-" or body.startswith("- "):
            while self.open and self.open[-1][0] > indent:
                self.open.pop()
            if not self.open:
                return self.fault("an item without a list")
            path = self.open[-1][1]
            self.scalars.pop(path, None)
            self.lists.setdefault(path, []).append(self.scalar(body[1:].strip(), indent))
            return None
        key = _KEY.match(body)
        while self.open and self.open[-1][0] >= indent:
            self.open.pop()
        if not key or (indent and not self.open):
            return self.fault("a line that is no field")
        name = key["plain"] if key["plain"] is not None else _single(key["one"]) if key["one"] is not None else _double(key["two"])
        path = f"{self.open[-1][1]}.{name}" if self.open else name
        self.scalars.pop(self.open[-1][1] if self.open else "", None)
        self.forget(path)
        value = body[key.end() :].strip()
        if not value or value.startswith("#"):
            self.scalars[path] = None
            self.open.append((indent, path))
        elif value[0] == "[":
            self.lists[path] = self.flow(value, "[", "]", indent)
        elif value[0] == "{":
            for pair in self.flow(value, "{", "}", indent):
                name, _, own = (pair or "").partition(":")
                self.scalars[f"{path}.{name.strip()}"] = _plain(own.strip())
        else:
            self.scalars[path] = self.scalar(value, indent)
        return None

    def forget(self, path: str) -> None:
        """A key that comes again counts anew."""
        for kept in (self.scalars, self.lists):
            for old in [k for k in kept if k == path or k.startswith(f"{path}.")]:
                del kept[old]

    def fault(self, what: str) -> None:
        self.problem = self.problem or f"{what} in line {self.at}"

    def scalar(self, value: str, indent: int) -> str | None:
        if value[:1] in ("'", '"'):
            kind, first = _CLOSED[value[0]], self.at
            while not (whole := kind.match(value)) and self.at < len(self.lines):
                value += "\n" + self.lines[self.at]
                self.at += 1
            if not whole or not re.fullmatch(r"\s*(#.*)?", value[whole.end() :]):
                self.at = first
                self.fault("a quote that does not end")
                return value.split("\n")[0]
            return _double(whole[1]) if value[0] == '"' else _single(whole[1])
        if m := _BLOCK.match(value):
            return self.block(m[1] == ">", m[2] or m[3], indent)
        parts = [re.sub(r"(^|\s+)#.*", "", value)]
        while value == parts[0] and (below := self.continued(indent)) is not None:
            parts += [""] * (below - self.at) + [self.lines[below].strip()]
            self.at = below + 1
        return _plain(_BREAK.sub(_folded, "\n".join(parts)))

    def continued(self, indent: int) -> int | None:
        """The line that goes on with a plain value: the next one that is not blank, if it is indented and no field."""
        below = next((k for k in range(self.at, len(self.lines)) if self.lines[k].strip()), None)
        if below is None:
            return None
        line = self.lines[below]
        body = line.strip()
        return below if len(line) - len(line.lstrip(" ")) > indent and body[0] != "#" and not _KEY.match(body) else None

    def block(self, folds: bool, chomp: str, indent: int) -> str:
        own: list[str] = []
        while self.at < len(self.lines) and (not self.lines[self.at].strip() or len(self.lines[self.at]) - len(self.lines[self.at].lstrip(" ")) > indent):
            own.append(self.lines[self.at])
            self.at += 1
        margin = min((len(x) - len(x.lstrip(" ")) for x in own if x.strip()), default=0)
        own = [x[margin:] for x in own]
        body = "\n".join(own)
        kept = body.rstrip("\n")
        tail = "\n" * (len(body) - len(kept) + 1) if chomp == "+" else "" if chomp == "-" or not kept else "\n"
        if folds:  # a line that is indented further keeps its breaks
            kept = re.sub(r"(?<=\S)(\n+)(?=[^\s])", lambda m: " " if len(m[1]) == 1 else m[1][1:], kept)
        return kept + tail

    def flow(self, value: str, left: str, right: str, indent: int) -> list[str | None]:
        first = self.at
        bare = lambda: re.sub(r"""'(?:[^']|'')*'|"(?:[^"\\]|\\.)*"|\s#.*""", "", value)
        while bare().count(left) > bare().count(right) and self.at < len(self.lines):
            value += "\n" + self.lines[self.at].strip()
            self.at += 1
        body = re.sub(r"\s#[^\n]*", "", value).strip()
        inner = body[1:-1].strip()
        if not body.endswith(right) or (left in bare()[1:] and bare().count(left) > 1):
            self.at = first
            self.fault("a list that does not end or holds others")
            return []
        out: list[str | None] = []
        at = 0
        while at < len(inner) and (m := _FLOW.match(inner, at)):
            out.append(_single(m[1]) if m[1] is not None else _double(m[2]) if m[2] is not None else _plain(_BREAK.sub(_folded, m[3].strip())))
            if m.end() == at:
                break
            at = m.end()
        if at < len(inner):
            self.fault("a list that is not plain")
        return out


def _folded(m: re.Match) -> str:
    """Line ends inside a value: one is a blank, each further one a line end."""
    n = m[0].count("\n")
    return " " if n == 1 else "\n" * (n - 1)


def _plain(value: str) -> str | None:
    return None if value in _NULLS else value


def _single(body: str) -> str:
    return _BREAK.sub(_folded, body).replace("''", "'")


def _double(body: str) -> str:
    def meant(m: re.Match) -> str:
        if m[1] is None:
            return _folded(m)
        if m[1][0] == "\n":
            return ""
        return chr(int(m[1][1:], 16)) if len(m[1]) > 1 else _LETTERS.get(m[1], m[1])

    return _ESCAPE.sub(meant, body)


def stated(block: Column) -> Column:
    """``(fields, lists, problem)`` of blocks of front matter; null for null.

    ``fields`` are scalars, null where a value is null; nested names are joined by dots; ``lists``
    hold the items of flow and block lists.  Of a name that comes twice the last counts.
    ``problem`` names the first line that does not read, and the others are read all the same.

    A block is read where the column stands: as a function that Spark may repeat, it would be read again
    for each filter on what it states, below exchanges too.  A column that is used often is to be named first.
    """

    @F.arrow_udf(KIND)
    def run(blocks: pa.Array) -> pa.Array:
        out = []
        for b in blocks.to_pylist():
            f = None if b is None else Fields(b)
            out.append(f and {"fields": list(f.scalars.items()), "lists": list(f.lists.items()), "problem": f.problem})
        return pa.array(out, _ARROW)

    return run.asNondeterministic()(block)


def written(value: Column) -> Column:
    """A value as a scalar that reads back as the same string: plain where that is safe, else quoted."""
    plain = value.rlike(r"^[A-Za-z/][A-Za-z0-9_./()&+;, -]*$") & ~value.rlike(r"(?i)^(null|true|false|yes|no|on|off|y|n)$| $")
    odd = value.rlike(r"[\x00-\x1f\x7f\x85\u2028\u2029\ufeff]")
    escaped = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for code in (*range(32), 0x7F, 0x85, 0x2028, 0x2029, 0xFEFF):
        escaped = F.replace(escaped, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
    quoted = F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'"))
    return F.when(value.isNull(), "null").when(plain, value).when(odd, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(quoted)
