"""Small building blocks shared by all column functions.

Every function takes and returns ``Column`` objects, so Catalyst sees plain
built-in expressions.  Sessions must run with ``spark.sql.session.timeZone=UTC``.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ASCII word boundary: Java's own ``\b`` also treats accented letters as word
# characters, which the rule tables do not expect.
_BOUNDARY = r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"


def c(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def nz(value: str | Column) -> Column:
    """NULL text becomes the empty string."""
    return F.coalesce(c(value), F.lit(""))


def rx(pattern: str, flags: str = "i") -> str:
    """Inline flags plus ASCII word boundaries for a rule pattern."""
    prefix = f"(?{flags})" if flags else ""
    return prefix + pattern.replace(r"\b", _BOUNDARY)


def plain_letters(text: str | Column) -> Column:
    """Text for number and date patterns: no-break spaces as blanks, accented letters as dots.

    Lengths stay, and Java's fast native ``\\b`` then equals the ASCII word boundary.
    """
    blanks = F.translate(nz(text), "\u00a0\u0001", "  ")
    return F.regexp_replace(blanks, r"[\p{L}\p{N}\p{M}&&[^\p{ASCII}]]", "·")


def plain_groups(text: Column, pattern: str, group: int = 1) -> Column:
    """``all_groups`` on a text that went through ``plain_letters``; "." spans lines."""
    return F.regexp_extract_all(text, F.lit(f"(?is){pattern}"), F.lit(group))


def by_first_letter(pattern: str) -> str:
    """An alternation with its alternatives gathered by their first letters, for tests that only ask whether it matches.

    Java tries one alternative after the other at every place; gathered, most of them fall with one
    comparison.  The same texts match, but another alternative may be met first.
    """
    return "|".join(_gathered(_alternatives(pattern)))


def _marks(pattern: str) -> Iterator[tuple[int, str, int]]:
    """Place, mark and depth behind it of every bracket and bar that is no plain character."""
    depth, in_class, i = 0, False, 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            i += 1
        elif in_class:
            in_class = ch != "]"
        elif ch == "[":
            in_class = True
        elif ch in "()|":
            depth += {"(": 1, ")": -1}.get(ch, 0)
            yield i, ch, depth
        i += 1


def _alternatives(pattern: str) -> list[str]:
    bars = [-1, *(i for i, ch, depth in _marks(pattern) if ch == "|" and depth == 0), len(pattern)]
    return [pattern[a + 1 : b] for a, b in zip(bars, bars[1:])]


def _closing(pattern: str) -> int:
    """Place of the bracket that closes a pattern's first one."""
    return next((i for i, ch, depth in _marks(pattern) if ch == ")" and depth == 0), -1)


def _gathered(alternatives: list[str]) -> list[str]:
    groups: dict[str, list[str]] = {}
    others = []
    for one in alternatives:
        plain = one[:1].isascii() and (one[:1].isalnum() or one[:1] in "/ ") and one[1:2] not in ("?", "*", "+", "{")
        (groups.setdefault(one[0], []) if one and plain else others).append(one[1:] if one and plain else one)
    out = [first + rests[0] if len(rests) == 1 else f"{first}(?:{'|'.join(_gathered(rests))})" for first, rests in groups.items()]
    return out + others


def rx_words(pattern: str) -> str:
    """A word-list pattern for lower-case text.

    Its outer boundaries stand next to word characters, where one look-around suffices.
    """
    inner = pattern.removeprefix(r"\b").removesuffix(r"\b")
    if inner.startswith("(") and not inner.startswith("(?") and _closing(inner) == len(inner) - 1:
        inner = f"(?:{by_first_letter(inner[1:-1])})"
    return r"(?<!\w)" + rx(inner, "") + r"(?!\w)"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, which may use it many times.

    Catalyst has no let expression; a one-element ``transform`` is one.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def matches(text: str | Column, pattern: str, flags: str = "i") -> Column:
    return nz(text).rlike(rx(pattern, flags))


def first_group(text: str | Column, pattern: str, group: int = 1, flags: str = "i") -> Column:
    """Captured group of the first match, NULL when nothing matched."""
    return F.nullif(F.regexp_extract(nz(text), rx(pattern, flags), group), F.lit(""))


def all_groups(text: str | Column, pattern: str, group: int = 1, flags: str = "i") -> Column:
    return F.regexp_extract_all(nz(text), F.lit(rx(pattern, flags)), F.lit(group))


def sub(text: str | Column, pattern: str, replacement: str, flags: str = "i") -> Column:
    return F.regexp_replace(c(text), rx(pattern, flags), replacement)


_SPACE = r"[\s\u00A0\uFEFF]"


def trim_ws(text: str | Column) -> Column:
    """Trim every kind of white space, line breaks and no-break spaces included."""
    return F.regexp_replace(c(text), f"^{_SPACE}+|{_SPACE}+$", "")


def squash_ws(text: str | Column) -> Column:
    return F.regexp_replace(c(text), f"{_SPACE}+", " ")


def blank_to_null(text: str | Column) -> Column:
    return F.nullif(c(text), F.lit(""))


def present(*items: Column) -> Column:
    """Array of the items that are not NULL, in the given order.

    ``array_except`` is code-generated, unlike a lambda filter; the items of one
    call are always distinct messages, so its de-duplication changes nothing.
    """
    nothing = F.array(F.lit(None).cast("string"))
    return F.array_except(F.array(*items), nothing)


def when_text(condition: Column, message: str | Column) -> Column:
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(condition, text)


def round2(value: str | Column) -> Column:
    """Half-up rounding of a double to two places through ``floor``."""
    return F.floor(c(value) * 100 + 0.5) / 100


def digits_of(text: str | Column) -> Column:
    """Number made of the digits and dots of a text, NULL when there are none."""
    return number_of(F.regexp_replace(nz(text), r"[^\d.]", ""))


def number_of(text: str | Column) -> Column:
    """Number spelled by a text, else NULL.

    The shape is checked first: a failing ``try_cast`` builds an exception per row.
    """
    t = c(text).cast("string")
    shaped = t.rlike(r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d{1,3})?\s*$")
    return F.when(shaped, t.cast("double"))


def whole_of(text: str | Column) -> Column:
    """Whole number spelled by a text of at most 18 digits, else NULL."""
    t = c(text).cast("string")
    return F.when(t.rlike(r"^[+-]?\d{1,18}$"), t.cast("bigint"))


def number_text(value: str | Column) -> Column:
    """Shortest decimal spelling of a number: ``2`` rather than ``2.0``."""
    v = c(value).cast("double")
    whole = (F.abs(v) < 1e15) & (v == F.floor(v))
    return F.when(whole, v.cast("bigint").cast("string")).otherwise(v.cast("string"))


def thousands(value: str | Column) -> Column:
    """1234567 -> 1,234,567."""
    return F.format_number(c(value), 0)


def instant(text: str | Column) -> Column:
    """Timestamp of an ISO text, NULL when it cannot be read."""
    value = c(text).cast("string")
    shaped = value.rlike(r"^\s*[+-]?\d{4,6}-\d{1,2}")
    return F.when(shaped, value.try_cast("timestamp"))


def at(now) -> Column:
    """Literal timestamp for the run clock (ISO text, datetime or Column)."""
    if isinstance(now, Column):
        return now
    return F.lit(str(now)).cast("timestamp")


def days(n: float) -> Column:
    return F.expr(f"make_dt_interval(0, 0, 0, {float(n) * 86400:.6f})")


def with_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are evaluated once per row, whatever filters read them later.

    A filter on a projected column is pushed below the projection, which repeats an
    expensive expression; a one-row ``inline`` keeps it where it is.
    """
    kept = [F.col(f"`{n}`") for n in df.columns if n not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[e.alias(n) for n, e in columns.items()]))))
