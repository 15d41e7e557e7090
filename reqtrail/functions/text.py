"""Text column expressions (all JVM built-ins)."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Approval status code -> label used for worklist event types.
WORKLIST_STATUS = {"I": "Initiated", "A": "Approved", "D": "Denied"}
# Fixed value: a worklist whose name (first line) contains this word is handled inside procurement.
INTERNAL_WORD = "procurement"


# Fixed value: the characters with Unicode's White_Space property.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """remove leading/trailing white space (tab, newline, ...), not only blanks. A pattern would be tried at every character."""
    return F.trim(_c(c), F.lit(WHITE_SPACE))


def matches_from_start(c: str | Column, word: str = INTERNAL_WORD) -> Column:
    """case-insensitive ``word`` somewhere on the first line; NULL counts as no match."""
    pattern = "(?iu)^[^\\n]*" + word
    return F.coalesce(_c(c).rlike(pattern), F.lit(False))


def decode(c: str | Column, mapping: Mapping[str, str] = WORKLIST_STATUS) -> Column:
    """map a code to its label; unknown codes pass through unchanged."""
    col = _c(c)
    expr = None
    for code, label in mapping.items():
        expr = (F.when(col == code, F.lit(label)) if expr is None
                else expr.when(col == code, F.lit(label)))
    return expr.otherwise(col) if expr is not None else col


def template(text: str, *cols: str | Column) -> Column:
    """fill the ``{}`` slots of a message template with columns (NULL prints as "")."""
    pieces = text.split("{}")
    if len(pieces) != len(cols) + 1:
        raise ValueError(f"{text!r} has {len(pieces) - 1} slots, got {len(cols)} columns")
    parts: list[str | Column] = [pieces[0]]
    for c, piece in zip(cols, pieces[1:]):
        parts += [F.col(c) if isinstance(c, str) else c, piece]
    return fmt(*parts)


def fmt(*parts: str | Column) -> Column:
    """concatenate literals and columns; a NULL column prints as the empty string."""
    cols = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.concat(*cols)
