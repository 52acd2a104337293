"""Links of a page, in document order, as native columns.

Every pattern uses possessive or lazy single-character loops only: they run in
linear time and without recursion, whatever the page looks like.
"""

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements whose content a browser does not turn into elements of the page.
_INERT = "script|style|textarea|title|noscript|template|iframe|noframes|xmp"

# All markup, so that nothing inside a comment, a script or an attribute is taken for a tag;
# each piece up to the end of the page when it is not closed. The second group is an anchor.
_UNQUOTED = r"""[^\s>"'][^\s>]*+"""
_QUOTED = rf"""(?:"[^"]*+"|'[^']*+'|{_UNQUOTED})"""
_VALUE = rf"""(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|{_UNQUOTED})"""
_ATTRIBUTES = rf"(?:[^>=]++|=\s*+{_VALUE}?+)*+(?:>|\z)"
_MARKUP = (
    rf"(?is)<(?:!--.*?(?:-->|\z)|({_INERT})(?=[\s/>]).*?(?:</\1(?=[\s/>])|\z)|[!?/][^>]*+"
    rf"|(a(?=[\s/]){_ATTRIBUTES})|[a-z]{_ATTRIBUTES})"
)
_OTHER = rf"[\s/]*+(?!href\s*+=)[^\s/>=]++(?:\s*+=\s*+{_QUOTED})?+"
_HREF = rf"(?i)^a(?:{_OTHER})*+[\s/]*+href\s*+=\s*+({_QUOTED})"

# Names that need no semicolon, the longest first; in an attribute only before neither a letter,
# a digit nor an equals sign.
_LEGACY = sorted((name for name in html5 if not name.endswith(";")), key=lambda n: (-len(n), n))
_REFERENCE = (
    r"&(?:#[0-9]++;?+|#[xX][0-9a-fA-F]++;?+|[A-Za-z][A-Za-z0-9]*+;"
    rf"|(?:{'|'.join(_LEGACY)})(?![A-Za-z0-9=]))|[^&]++|&"
)

_NAMED = {f"&{name}": text for name, text in sorted(html5.items())}
# The ones that links mostly have are not looked up among all.
_COMMON = {"&amp;": "&", "&quot;": '"', "&lt;": "<", "&gt;": ">", "&apos;": "'", "&nbsp;": "\xa0"}

# What the numbers 128 to 159 stand for in a reference; the others are controls.
_WINDOWS = {
    0x80: 0x20AC, 0x82: 0x201A, 0x83: 0x0192, 0x84: 0x201E, 0x85: 0x2026, 0x86: 0x2020,
    0x87: 0x2021, 0x88: 0x02C6, 0x89: 0x2030, 0x8A: 0x0160, 0x8B: 0x2039, 0x8C: 0x0152,
    0x8E: 0x017D, 0x91: 0x2018, 0x92: 0x2019, 0x93: 0x201C, 0x94: 0x201D, 0x95: 0x2022,
    0x96: 0x2013, 0x97: 0x2014, 0x98: 0x02DC, 0x99: 0x2122, 0x9A: 0x0161, 0x9B: 0x203A,
    0x9C: 0x0153, 0x9E: 0x017E, 0x9F: 0x0178,
}
_KEPT_CONTROLS = [0x81, 0x8D, 0x8F, 0x90, 0x9D, 0x09, 0x0A, 0x0C, 0x0D]


def _code_point(digits: Column, base: int) -> Column:
    """The character of a number written with ``digits``, however many there are."""
    short = F.regexp_replace(digits, "^0+", "")
    # Seven digits hold any code point in either base; with more it is beyond all of them.
    number = F.when(F.length(short) > 7, F.lit(0x110000)).otherwise(
        F.coalesce(F.conv(F.concat(F.lit("0"), short), base, 10).cast("bigint"), F.lit(0))
    )
    replaced = F.try_element_at(F.create_map(*[F.lit(n) for p in _WINDOWS.items() for n in p]), number.cast("int"))
    point = F.coalesce(replaced.cast("bigint"), number)
    control = point.between(0x01, 0x1F) | point.between(0x7F, 0x9F) | point.between(0xFDD0, 0xFDEF)
    control |= (point % 0x10000).isin(0xFFFE, 0xFFFF)
    return (
        F.when((point == 0) | point.between(0xD800, 0xDFFF) | (point > 0x10FFFF), F.lit("�"))
        .when(control & ~point.isin(_KEPT_CONTROLS), F.lit(""))
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))
    )


def unescape(text: Column) -> Column:
    """Character references of an attribute resolved, as a browser does.

    Numeric ones of any length, all HTML 5 names, and those older names that need no semicolon,
    unless a letter, a digit or an equals sign follows. Names are looked up in the map of those
    with their first letter.
    """
    by_letter = {}
    for name, character in _NAMED.items():
        by_letter.setdefault(name[1], {})[name] = character
    named = F.from_json(F.lit(json.dumps(by_letter)), "map<string,map<string,string>>")

    def resolve(token: Column) -> Column:
        known = F.when(F.lit(False), token)
        for written, character in _COMMON.items():
            known = known.when(token == written, F.lit(character))
        return (
            known.when(
                token.rlike("^&#[0-9]"), _code_point(F.regexp_extract(token, "[0-9]+", 0), 10)
            )
            .when(
                token.rlike("^&#[xX][0-9a-fA-F]"),
                _code_point(F.regexp_extract(token, "^&#[xX]([0-9a-fA-F]+)", 1), 16),
            )
            .when(
                token.startswith("&") & (F.length(token) > 1),
                F.coalesce(
                    F.try_element_at(F.try_element_at(named, F.substring(token, 2, 1)), token), token
                ),
            )
            .otherwise(token)
        )

    resolved = F.array_join(
        F.transform(F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0)), resolve), ""
    )
    return F.when(text.contains("&"), resolved).otherwise(text)


def anchor_tags(html: Column) -> Column:
    """The start tags of all ``a`` elements as an array, without their opening bracket."""
    pieces = F.regexp_extract_all(html, F.lit(_MARKUP), F.lit(2))
    return F.filter(pieces, lambda piece: piece.endswith(">"))


def href_of(tag: Column) -> Column:
    """The link of one ``a`` start tag as written, empty when it has none."""
    written = F.regexp_extract(tag, _HREF, 1)
    quoted = written.startswith('"') | written.startswith("'")
    return unescape(
        F.when(quoted, F.substring(written, F.lit(2), F.length(written) - 2)).otherwise(written)
    )
