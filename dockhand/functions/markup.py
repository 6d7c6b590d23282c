"""Text and metadata out of HTML."""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from dockhand.functions.text import BLANKS, strip

# The inside of a tag: a ``>`` in a quoted value does not end it, and a quote that is never closed is no quote.
# Repetitions are possessive, so a page costs one scan and a tag of many attributes no stack for each character.
_INSIDE = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+(?:>|\z)"""

# One scan drops script and style blocks with their content, comments, and
# all other tags; the block alternatives come first so that a tag quoted
# inside a script is not taken for the end of it. What is not closed reaches to the end.
_MARKUP = (
    rf"(?is)<script\b{_INSIDE}.*?(?:</script\b[^>]*+(?:>|\z)|\z)"
    rf"|<style\b{_INSIDE}.*?(?:</style\b[^>]*+(?:>|\z)|\z)"
    rf"|<!--.*?(?:-->|\z)|<[!?][^>]*+(?:>|\z)|</?[a-z]{_INSIDE}"
)

_REFERENCE = r"^(?:#0*([0-9]{1,7})|#[xX]0*([0-9a-fA-F]{1,6})|([a-zA-Z][a-zA-Z0-9]*));"
_UNKNOWN = "\N{REPLACEMENT CHARACTER}"


def named_references() -> dict[str, str]:
    """Characters by name; a no-break space is a blank."""
    return {name: html5[f"{name};"] for name in name2codepoint} | {"apos": "'", "nbsp": " "}


def mended_codes() -> dict[int, str]:
    """Numbers that stand for another character: those of the Windows code page, and the no-break space."""
    high = {code: bytes([code]).decode("cp1252", errors="ignore") for code in range(0x80, 0xA0)}
    return {code: char for code, char in high.items() if char} | {0xA0: " "}


def _literal_map(values: dict) -> Column:
    return F.create_map(*(F.lit(item) for pair in values.items() for item in pair))


def _character(code: Column) -> Column:
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(valid, F.coalesce(_literal_map(mended_codes())[code], plain)).otherwise(F.lit(_UNKNOWN))


def _decoded(piece: Column) -> Column:
    """What followed an ampersand, with the reference it begins with turned into its character."""
    decimal, hexadecimal, name = (F.regexp_extract(piece, _REFERENCE, group) for group in (1, 2, 3))
    char = (
        F.when(decimal != "", _character(decimal.cast("int")))
        .when(hexadecimal != "", _character(F.conv(hexadecimal, 16, 10).cast("int")))
        .when(name != "", _literal_map(named_references())[name])
    )
    rest = F.substring(piece, F.locate(";", piece) + 1, F.length(piece))
    return F.when(char.isNotNull(), F.concat(char, rest)).otherwise(F.concat(F.lit("&"), piece))


def unescape(text: Column) -> Column:
    """Turn character references back into characters, each once; unknown names stay as they are."""
    pieces = F.split(text, "&", -1)
    decoded = F.transform(F.slice(pieces, 2, F.size(pieces)), _decoded)
    return F.when(F.contains(text, F.lit("&")), F.concat(pieces[0], F.array_join(decoded, ""))).otherwise(text)


def html_text(html: Column) -> Column:
    """Visible text with white space collapsed."""
    bare = unescape(F.regexp_replace(html, _MARKUP, " "))
    return strip(F.regexp_replace(bare, BLANKS, " "))


def html_metadata(html: Column) -> Column:
    """Map with ``title`` and ``lang``; a missing one is an empty text."""
    return F.create_map(
        F.lit("title"),
        strip(unescape(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))),
        F.lit("lang"),
        F.regexp_extract(html, r'(?is)<html[^>]*\slang="([^"]*)"', 1),
    )
