"""Text forms of values."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, SparkSession, types as T
from pyspark.sql import functions as F


def number_text(value: Column) -> Column:
    """Shortest decimal text of a double: no ``.0``, exponents only below 1e-4 and from 1e21 on."""
    raw = value.cast("string")
    whole = (value == F.floor(value)) & (F.abs(value) < 1e18)
    decimal = F.regexp_replace(value.cast("decimal(38,18)").cast("string"), r"\.?0+$", "")
    mantissa = F.regexp_replace(F.regexp_extract(raw, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    # Below 1e-3 the text has an exponent, here -4; a decimal would lose its last digits.
    shifted = F.concat(F.when(value < 0, "-0.000").otherwise("0.000"), F.regexp_replace(mantissa, "[-.]", ""))
    plain = F.when(F.abs(value) < 1e-3, shifted).when(F.abs(value) < 1e7, raw).otherwise(decimal)
    exponent = F.regexp_extract(raw, r"E(-?\d+)$", 1)
    power = F.when(exponent != "", exponent).cast("int")
    sign = F.when(power < 0, "-").otherwise("+")
    scientific = F.concat(mantissa, F.lit("e"), sign, F.lpad(F.abs(power).cast("string"), 2, "0"))
    return (
        F.when(F.isnan(value), "NaN")
        .when(value == float("inf"), "+Inf")
        .when(value == float("-inf"), "-Inf")
        .when(whole, value.cast("bigint").cast("string"))
        .when(F.abs(value) < 1e-4, scientific)
        .when(F.abs(value) < 1e18, plain)
        .when(F.abs(value) < 1e21, value.cast("decimal(38,0)").cast("string"))
        .otherwise(scientific)
    )


def group_text(column: Column, data_type: T.DataType) -> Column:
    """Text that is equal exactly when the values are equal; NULL stays NULL.

    Text of 64 characters and more is told apart by its SHA-256 digest, so that counting long
    documents does not shuffle them. Digests have 64 characters and never meet shorter text.
    """
    if isinstance(data_type, T.BinaryType):
        return _short(F.hex(column))
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return _short(F.to_json(column))
    return _short(column) if isinstance(data_type, T.StringType) else column.cast("string")


def _short(text: Column) -> Column:
    return F.when(F.length(text) >= 64, F.sha2(text, 256)).otherwise(text)


def json_value(text: Column) -> Column:
    """The variant a JSON text holds, NULL where it is no JSON; repeated names are allowed.

    The built-in parser passes text after the value. So the text is read as the first of two
    elements, whose second is the text's own hash: it has to be found there.
    """
    mark = F.xxhash64(text)
    both = F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), mark.cast("string"), F.lit("]")))
    parts = F.try_variant_get(both, "$", "array<variant>")
    whole = (F.size(parts) == 2) & (F.try_variant_get(F.get(parts, F.lit(1)), "$", "bigint") == mark)
    return F.when(whole, F.get(parts, F.lit(0)))


# Bracket classes of the common dialect and their Java names.
BRACKET_CLASSES = {
    "alnum": r"\p{Alnum}", "alpha": r"\p{Alpha}", "ascii": r"\p{ASCII}", "blank": r"\p{Blank}", "cntrl": r"\p{Cntrl}",
    "digit": r"\p{Digit}", "graph": r"\p{Graph}", "lower": r"\p{Lower}", "print": r"\p{Print}", "punct": r"\p{Punct}",
    "space": r"\s", "upper": r"\p{Upper}", "word": r"\w", "xdigit": r"\p{XDigit}",
}

_PIECES = re.compile(
    r"""(?P<escape>\\.)|(?P<bracket>\[:\^?[a-z]+:\])|(?P<open>\[\^?\]?)|(?P<close>\])|(?P<name>\(\?P<)"""
    r"""|(?P<flags>\(\?[a-zA-Z]*(?:-[a-zA-Z]+)?[:)])|(?P<other>.)""",
    re.DOTALL,
)


def engine_pattern(pattern: str) -> str:
    """The pattern of the common linear-time dialect, as Spark's engine has to be given it.

    ``$`` means the very end unless the m flag is set, lines end at ``\\n`` alone, bracket classes and
    named groups are known, and inside a class ``[`` and ``&`` are plain. Look-around,
    back-references, possessive repeats and the flag U are refused, and so is what does not compile.
    """
    _refuse_unportable(pattern)
    by_line = re.search(r"\(\?[a-zA-Z]*m", pattern) is not None
    out, inside = ["(?d)"], False
    for m in _PIECES.finditer(pattern):
        kind, piece = m.lastgroup, m.group()
        if kind == "bracket" and inside:
            name = piece.strip("[:]").lstrip("^")
            if name not in BRACKET_CLASSES:
                raise ValueError(f"pattern {pattern!r}: unknown class {piece}")
            known = BRACKET_CLASSES[name]
            out.append(known[0] + known[1].swapcase() + known[2:] if "^" in piece else known)
        elif inside:
            inside = kind != "close"
            plain = kind in ("escape", "close")
            out.append(piece if plain else re.sub(r"([\[\]&])", r"\\\1", piece))
        elif kind in ("open", "bracket"):
            if kind == "bracket":
                raise ValueError(f"pattern {pattern!r}: {piece} belongs into a class")
            inside = True
            out.append(piece.replace("]", r"\]"))
        elif kind == "flags" and "U" in piece:
            raise ValueError(f"pattern {pattern!r} uses the flag U")
        else:
            out.append("(?<" if kind == "name" else r"\z" if piece == "$" and not by_line else piece)
    found = "".join(out)
    try:
        SparkSession.active()._jvm.java.util.regex.Pattern.compile(found)
    except (Py4JJavaError, IllegalArgumentException) as problem:
        raise ValueError(f"pattern {pattern!r} does not compile") from problem
    return found


def _refuse_unportable(pattern: str) -> None:
    if re.search(r"\\[1-9]|\(\?<?[=!]|\\k<|\(\?P=|\(\?>|[*+?}]\+", pattern):
        raise ValueError(f"pattern {pattern!r} uses look-around, back-references or possessive repeats")


def portable_pattern(pattern: str) -> str:
    """The pattern, if it stays within what every linear-time engine accepts."""
    re.compile(pattern)
    _refuse_unportable(pattern)
    return pattern


#: Members of the bracket classes as ranges of ASCII code points.
_CLASS_RANGES = {
    "alnum": "09AZaz", "alpha": "AZaz", "ascii": "\x00\x7f", "blank": "\t\t  ", "cntrl": "\x00\x1f\x7f\x7f", "digit": "09",
    "graph": "!~", "lower": "az", "print": " ~", "punct": "!/:@[`{~", "space": "\t\r  ", "upper": "AZ", "word": "09AZ__az",
    "xdigit": "09AFaf", "perl space": "\t\n\f\r  ",
}


def _members(name: str, negated: bool) -> str:
    """The inside of a Python class that holds the members of a bracket class, or all other characters."""
    ends = [ord(c) for c in _CLASS_RANGES[name]]
    ranges = list(zip(ends[::2], ends[1::2]))
    if negated:
        borders = [-1, *[x for low, high in ranges for x in (low, high)], 0x110000]
        ranges = [(a + 1, b - 1) for a, b in zip(borders[::2], borders[1::2]) if a + 1 <= b - 1]
    return "".join(f"\\U{low:08x}-\\U{high:08x}" for low, high in ranges)


def python_pattern(pattern: str) -> re.Pattern:
    """The pattern of the common linear-time dialect, compiled for Python with the same meaning.

    As with :func:`engine_pattern`, ``$`` and ``\\z`` are the very end unless the m flag is set, bracket
    classes are known, ``\\s`` has no vertical tab, and what the dialect lacks is refused with a ValueError, as is
    what Python cannot express (classes by Unicode property, flags in mid-pattern).
    """
    _refuse_unportable(pattern)
    by_line = re.search(r"\(\?[a-zA-Z]*m", pattern) is not None
    out, inside = [], False
    for m in _PIECES.finditer(pattern):
        kind, piece = m.lastgroup, m.group()
        if kind == "bracket":
            name = piece.strip("[:]").lstrip("^")
            if not inside or name not in BRACKET_CLASSES:
                raise ValueError(f"pattern {pattern!r}: {piece} is no class, or stands outside of one")
            out.append(_members(name, "^" in piece))
        elif piece in (r"\s", r"\S"):
            space = _members("perl space", piece == r"\S")
            out.append(space if inside else f"[{space}]")
        elif inside:
            inside = kind != "close"
            out.append(piece if kind in ("escape", "close") else re.sub(r"([\[&~|])", r"\\\1", piece))
        elif kind == "open":
            inside = True
            out.append(piece.replace("]", r"\]"))
        elif piece == r"\Z" or (kind == "flags" and re.search("[^ims:)(?-]", piece)):
            raise ValueError(f"pattern {pattern!r}: {piece} is not of the dialect")
        else:
            out.append(r"\Z" if piece == r"\z" or (piece == "$" and not by_line) else piece)
    try:
        return re.compile("".join(out), re.ASCII)
    except re.error as problem:
        raise ValueError(f"pattern {pattern!r} does not compile") from problem


def sorted_entries(column: Column) -> Column:
    """Entries of a map in key order; groups and sorts where a map cannot."""
    return F.sort_array(F.map_entries(column))


def sorted_json(column: Column) -> Column:
    """JSON object of a map with its keys in order."""
    return F.to_json(F.map_from_entries(sorted_entries(column)))
