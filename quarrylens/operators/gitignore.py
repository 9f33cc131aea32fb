"""Ignore patterns, compiled to regular expressions that Java and RE2 read alike."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def compiled(pattern: str) -> tuple[str, bool] | None:
    """``(regular expression, keeps)`` of one line; None for a blank line or a comment.

    The expression matches whole relative paths. A pattern with a slash before its end is bound to the top;
    one that ends in a slash matches what lies in such a folder."""
    line = pattern.rstrip("\n")
    if line.startswith("#") or not line.strip():
        return None
    keeps = line.startswith("!")
    line = line[1:] if keeps else line
    line = line[1:] if line.startswith("\\") and line[1:2] in "!#" else line
    line = line.rstrip(" ")
    folder = line.endswith("/")
    line = line.rstrip("/")
    bound = "/" in line
    line = line.lstrip("/")
    if not line:
        return None
    out, at = [], 0
    while at < len(line):
        c = line[at]
        if line.startswith("**/", at) and (at == 0 or line[at - 1] == "/"):
            out.append("(?:.*/)?")
            at += 3
        elif line.startswith("**", at) and at + 2 == len(line) and at and line[at - 1] == "/":
            out.append(".*")
            at += 2
        elif c == "*":
            out.append("[^/]*")
            at += 1
        elif c == "?":
            out.append("[^/]")
            at += 1
        elif c == "[" and (end := line.find("]", at + 2)) > 0:
            inside = line[at + 1 : end]
            inside = "^" + inside[1:] if inside[0] in "!^" else inside
            out.append("[" + inside.replace("\\", "\\\\") + "]")
            at = end + 1
        elif c == "\\" and at + 1 < len(line):
            out.append(_literal(line[at + 1]))
            at += 2
        else:
            out.append(_literal(c))
            at += 1
    return f"^{'' if bound else '(?:.*/)?'}{''.join(out)}{'/.*' if folder else '(?:/.*)?'}$", keeps


def _literal(c: str) -> str:
    return "\\" + c if c in r".^$+(){}|[]\*?" else c


def expressions(patterns: list[str]) -> list[tuple[str, bool]]:
    return [x for x in map(compiled, patterns) if x is not None]


def ignored(path: Column, patterns: list[str]) -> Column:
    """Whether the last pattern that matches ignores the path; one column expression, no join."""
    return reduce(lambda out, x: F.when(path.rlike(x[0]), F.lit(not x[1])).otherwise(out), expressions(patterns), F.lit(False))


def ignored_sql(path: str, patterns: list[str]) -> str:
    """The same for an SQL engine with ``regexp_matches``."""
    cases = " ".join(f"WHEN regexp_matches({path}, '{x.replace(chr(39), chr(39) * 2)}') THEN {'false' if keeps else 'true'}" for x, keeps in reversed(expressions(patterns)))
    return f"(CASE {cases} ELSE false END)"
