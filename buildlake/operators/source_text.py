"""Comments, prototypes and decorated definitions of functions in source text.

One lexer tells code from comments, string and character literals; what a line
is and says is decided on its code alone, so a ``//`` in a string or a call in a
comment misleads nobody. The rest are selections of lexed lines. Texts are
short, so they come as Arrow batches; Spark distributes the functions.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import dropwhile, takewhile
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# an unfinished block comment reaches to the end, an unfinished literal to the end of its line
_TOKEN = re.compile(r'(/\*.*?(?:\*/|\Z)|//[^\n]*)|("(?:\\.|[^"\\\n])*"?|\'(?:\\.|[^\'\\\n])*\'?)', re.DOTALL)


class Line(NamedTuple):
    """A source line: its text, the same with comments and literals blanked, and the number of the last comment on it."""

    text: str
    code: str
    comment: int | None

    @property
    def blank(self) -> bool:
        return not self.text.strip()

    @property
    def only_comment(self) -> bool:
        return self.comment is not None and not self.code.strip()

    @property
    def directive(self) -> bool:
        return self.code.lstrip().startswith("#")

    def calls(self, name: str) -> bool:
        return re.search(rf"{re.escape(name)}\s*\(", self.code) is not None

    def ends(self, marks: str) -> bool:
        return self.code.rstrip()[-1:] in tuple(marks)


def lexed(lines: Sequence[str]) -> list[Line]:
    """The lines of a source; line comments on neighbouring lines of their own are one comment."""
    text = "\n".join(lines)
    owners: list[int | None] = [None] * len(lines)
    last = (-2, -1)  # line and number of the latest line comment on a line of its own
    for number, token in enumerate(_TOKEN.finditer(text)):
        if token[1] is None:
            continue
        first = text.count("\n", 0, token.start())
        alone = token[1].startswith("//") and not lines[first][: token.start() - text.rfind("\n", 0, token.start()) - 1].strip()
        owner = last[1] if alone and last[0] == first - 1 else number
        last = (first, owner) if alone else last
        for k in range(first, first + token[1].count("\n") + 1):
            owners[k] = owner
    blanked = _TOKEN.sub(lambda m: re.sub(r"[^\n]", " ", m[0]), text).split("\n")
    return [Line(*row) for row in zip(lines, blanked, owners, strict=True)] if lines else []


def comment_lines(lines: Sequence[str], name: str, body: bool) -> list[str]:
    """Lines with comments above the line that calls the name, or from it on; an include starts the list anew."""
    source = lexed(lines)
    below = lambda line: not line.calls(name)
    part = list(dropwhile(below, source) if body else takewhile(below, source))
    included = max((i for i, line in enumerate(part) if line.directive and "include" in line.code), default=-1)
    return [line.text for line in part[included + 1 :] if line.comment is not None and line.text]


def prototype_lines(lines: Sequence[str], name: str) -> list[str]:
    """From behind the nearest line above that is or ends something (comment, directive, statement, block) to the first ``)``."""
    source = [line for line in lexed(lines) if line.text]
    at = next((i for i, line in enumerate(source) if line.calls(name)), None)
    if at is None:
        return []
    closed = lambda line: line.comment is not None or line.directive or ";" in line.code or "}" in line.code
    above = list(takewhile(lambda line: not closed(line), reversed(source[:at])))
    rest = list(takewhile(lambda line: ")" not in line.code, source[at:]))
    end = at + len(rest) + 1 if at + len(rest) < len(source) else at + 1
    return [line.text for line in [*reversed(above), *source[at:end]]]


def definition_start(lines: Sequence[str], name: str) -> int | None:
    """Index of the first line that belongs to a definition: its comment, decorators or prototype.

    Lines right above the last call of the name are decorators until a blank
    one; the nearest comment of its own, blank lines between, is taken whole; a
    directive or the end of a statement or block ends the search. A qualified
    name that isn't called is looked for without its namespaces.
    """
    source = lexed(lines)
    calls = [i for i, line in enumerate(source) if line.calls(name)]
    if not calls:
        bare = name.rpartition("::")[2]
        return definition_start(lines, bare) if bare != name else None
    above = source[: calls[-1]]
    near = list(takewhile(lambda line: line.only_comment or line.blank or not (line.directive or line.ends(";{}")), reversed(above)))
    # decorators, then what a blank line parts from them
    decorators = list(takewhile(lambda line: not line.blank and not line.only_comment, near))
    comment = next((line.comment for line in near if line.only_comment), None)
    if comment is not None:
        return next(i for i, line in enumerate(source) if line.comment == comment)
    return calls[-1] - len(decorators)


DESCRIBED = ["definition", "top_comments", "body_comments", "prototype"]


@F.pandas_udf(T.StructType([T.StructField(n, T.StringType()) for n in DESCRIBED]))
def described(texts: pd.Series, names: pd.Series) -> pd.DataFrame:
    """All four in one pass over a text; the others are taken from the definition."""

    def one(text: str | None, name: str | None) -> tuple:
        if text is None or name is None:
            return (None,) * 4
        lines = text.splitlines()
        at = definition_start(lines, name)
        lines = [] if at is None else lines[at:]
        return "\n".join(lines), *("\n".join(found) for found in (comment_lines(lines, name, False), comment_lines(lines, name, True), prototype_lines(lines, name)))

    return pd.DataFrame([one(t, n) for t, n in zip(texts, names, strict=True)], columns=DESCRIBED, dtype=object)


def described_functions(functions: DataFrame, body: str = "body", name: str = "name") -> DataFrame:
    """``functions`` with definition, top_comments, body_comments and prototype; null texts give nulls."""
    return functions.withColumn("__d", described(F.col(body), F.col(name))).select(*functions.columns, "__d.*")
