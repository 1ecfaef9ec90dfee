"""Template text: ``r`` upper letter, ``a`` lower letter, ``d`` digit, ``\\`` escapes, the rest is literal."""

from __future__ import annotations

import re
import string
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from finloom.functions.values import sql_literal

LETTERS = {"r": string.ascii_uppercase, "a": string.ascii_lowercase}
LONGEST_LETTER_RUN = 13
LONGEST_DIGIT_RUN = 18


def template_runs(template: str) -> list[tuple[str, str]]:
    """Split into runs: (mark, marks) for marks, ("", text) for literal text."""
    marked, escaped = [], False
    for ch in template:
        if escaped:
            marked.append(("", ch))
            escaped = False
        elif ch == "\\":
            escaped = True
        elif ch in "rad":
            marked.append((ch, ch))
        else:
            marked.append(("", ch))
    if escaped:
        raise ValueError(f"template ends inside an escape: {template!r}")
    runs = []
    for mark, chars in groupby(marked, key=lambda pair: pair[0]):
        body = "".join(ch for _, ch in chars)
        limit = {"": len(body), "d": LONGEST_DIGIT_RUN}.get(mark, LONGEST_LETTER_RUN)
        runs += [(mark, body[i:i + limit]) for i in range(0, len(body), max(1, limit))]
    return runs


def _letters(draw: str, count: int, alphabet: str) -> str:
    """``count`` base-26 digits of the draw as letters, two per table lookup."""
    pairs = "split('" + ",".join(a + b for a in alphabet for b in alphabet) + "', ',')"
    value, pieces = f"({draw} % {26**count}L)", []
    if count % 2:
        singles = "split('" + ",".join(alphabet) + "', ',')"
        pieces.append(f"get({singles}, cast({value} div {26 ** (count - 1)}L as int))")
    for place in reversed(range(count // 2)):
        pieces.append(f"get({pairs}, cast({value} div {676**place}L % 676 as int))")
    return ", ".join(pieces)


def _digits(draw: str, count: int) -> str:
    """``count`` digits with leading zeros."""
    return f"substr(cast({draw} % {10**count}L + {10**count}L as string), 2)"


def text(draw_for_run, template: str) -> Column:
    """Fill a template. ``draw_for_run(k)`` gives the stream of the k-th marked run."""
    pieces, marked = [], 0
    for mark, body in template_runs(template):
        if mark == "":
            pieces.append(sql_literal(body))
            continue
        draw = draw_for_run(marked)
        marked += 1
        pieces.append(_digits(draw, len(body)) if mark == "d" else _letters(draw, len(body), LETTERS[mark]))
    return F.expr(f"concat({', '.join(pieces)})")


def template_regex(template: str) -> str:
    """Anchored pattern that every filled template matches."""
    classes = {"r": "[A-Z]", "a": "[a-z]", "d": "[0-9]"}
    parts = []
    for mark, body in template_runs(template):
        parts.append(f"{classes[mark]}{{{len(body)}}}" if mark else re.escape(body))
    return "^" + "".join(parts) + "$"
