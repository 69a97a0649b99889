"""Text column helpers.

Lines of one document live in one array column, so cleaning, de-duplication
and word counting run inside the scan stage with higher-order functions:
no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# A line is dropped when its lower-case form contains any of these phrases.
IGNORE_PHRASES = (
    "scrubs episode",
    "transcripts",
    "browse more",
    'back to "',
    "following is a transcript",
    "editorial note",
)
# One-character lines that are dropped.
PUNCT_LINES = ('"', ".", "!", ",")
# Words per scene.
MAX_WORDS = 150
# Tokens kept per scene for the encoder input.
MAX_TOKENS = 512
# ---------------------------------------------------------------------------

# Whitespace as Python's str.split()/str.strip() know it (str.isspace()).
PY_WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200b))
               + "\u2028\u2029\u202f\u205f\u3000")
WS = r"[\t\n\x0b\f\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
# The ASCII form is what an RE2-based engine (DuckDB) has for \s; it is used
# where results are checked against such an engine.
ASCII_WS_CHARS = "\t\n\x0c\r "
WS_ASCII = r"[\t\n\f\r ]+"
# Line breaks as Python's str.splitlines() knows them.
LINE_BREAKS = r"\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]"
LINE_BREAKS_ASCII = r"\r\n|\n|\r"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utrim(c: str | Column, unicode: bool = True) -> Column:
    """Strip whitespace at both ends (``str.strip()``; Unicode by default).
    A character-set trim, no regex."""
    return F.btrim(_c(c), F.lit(PY_WS_CHARS if unicode else ASCII_WS_CHARS))


def split_lines(text: str | Column, unicode: bool = True) -> Column:
    """C3 first half: text -> array of raw lines."""
    return F.split(_c(text), LINE_BREAKS if unicode else LINE_BREAKS_ASCII)


def word_count(line: str | Column, ws: str = WS) -> Column:
    """Whitespace-token count of a line (0 for blank)."""
    t = utrim(line, ws == WS)
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, ws)))


def clean_lines(lines: str | Column, phrases: Sequence[str] = IGNORE_PHRASES,
                punct: Sequence[str] = PUNCT_LINES, unicode: bool = True) -> Column:
    """Trim each line, drop empty lines, lines holding an ignored
    phrase (case-insensitive) and one-character punctuation lines."""
    trimmed = F.transform(_c(lines), lambda x: utrim(x, unicode))
    phrase_arr = F.array(*[F.lit(p) for p in phrases]) if phrases else None
    punct_arr = F.array(*[F.lit(p) for p in punct]) if punct else None

    def keep(x: Column) -> Column:
        ok = x != ""
        if phrase_arr is not None:
            low = F.lower(x)
            ok = ok & ~F.exists(phrase_arr, lambda p: F.contains(low, p))
        if punct_arr is not None:
            ok = ok & ~((F.length(x) < 2) & F.array_contains(punct_arr, x))
        return ok

    return F.filter(trimmed, keep)


def dedupe_consecutive(lines: str | Column) -> Column:
    """Drop a line equal to the one kept just before it. Applied to the
    already cleaned array, so 'previous' is the last kept line."""
    arr = _c(lines)
    return F.filter(arr, lambda x, i: (i == 0) | (x != F.element_at(arr, i)))


def with_text_lines(df: DataFrame, text: str | Column, out_col: str = "lines",
                    phrases: Sequence[str] = IGNORE_PHRASES, punct: Sequence[str] = PUNCT_LINES,
                    unicode: bool = True, split: bool = True) -> DataFrame:
    """Add ``out_col`` = cleaned, consecutively de-duplicated lines.

    The cleaned array is first materialised as its own column: the
    de-duplication lambda reads its neighbour, and an inlined expression
    there would be re-evaluated for every element."""
    raw = split_lines(text, unicode) if split else _c(text)
    tmp = "__clean_" + out_col
    d = df.withColumn(tmp, clean_lines(raw, phrases, punct, unicode))
    return d.withColumn(out_col, dedupe_consecutive(tmp)).drop(tmp)


def safe_name(c: str | Column) -> Column:
    """C14: spaces -> ``_``, parentheses removed (file-name form)."""
    return F.regexp_replace(F.replace(_c(c), F.lit(" "), F.lit("_")), r"[()]", "")


def tokens(text: str | Column, unicode: bool = True) -> Column:
    t = utrim(text, unicode)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(
        F.split(t, WS if unicode else WS_ASCII))


def truncate_tokens(text: str | Column, max_tokens: int = MAX_TOKENS,
                    unicode: bool = True) -> tuple[Column, Column, Column]:
    """(first ``max_tokens`` whitespace tokens joined by a space,
    kept token count, total token count)."""
    toks = tokens(text, unicode)
    kept = F.slice(toks, 1, max_tokens)
    return F.array_join(kept, " "), F.size(kept), F.size(toks)


def explode_positions(df: DataFrame, array_col: str, keep, pos_col: str = "pos",
                      value_col: str = "value") -> DataFrame:
    """``posexplode`` of a computed array column without the size filter Spark
    infers for a plain generator: that filter would be pushed below the
    projection with the array expression inlined, computing it twice (and
    quadratically inside a lambda that reads neighbours). Empty arrays give no
    rows, as with ``posexplode``."""
    keep = [keep] if isinstance(keep, str) else list(keep)
    out = df.select(*keep, F.posexplode_outer(array_col).alias(pos_col, value_col))
    return out.filter(F.col(pos_col).isNotNull())
