"""One element of a page, cut out natively by a stack of open tags over the page's markup."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitewatch.functions.anchors import unescape

# Elements of HTML that have no content, and those whose content is no elements.
VOID = "area base br col embed hr img input link meta source track wbr".split()
_INERT = "script style template noscript title textarea iframe noframes xmp".split()

# A comment, an element without elements inside, a tag, or anything else in brackets; each up to
# the end of the page when it is not closed. Groups: inert element, end mark, tag, attributes.
VALUE = r"""(?:"[^"]*+(?:"|$)|'[^']*+(?:'|$)|[^\s>"'][^\s>]*+)"""
MARKUP = (
    rf"<(?:!--.*?(?:-->|$)|({'|'.join(_INERT)})(?=[\s/>]).*?(?:</\1(?=[\s/>])[^>]*+|$)>?"
    rf"|(/?)([a-z][^\s/>]*+)((?:[^>=]++|=\s*+{VALUE}?+)*+)>?|[!?/][^>]*+>?)"
)
HIDING_STYLE = r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)"

_NAME = r"(?is)\A</?([a-z][^\s/>]*+)"

# A control that no reference stands for.
_BETWEEN = "\x01"


def _leaf(wanted: str) -> str:
    """A pattern for an element of text alone, which opens and closes nothing else.

    Its tag is plain, so that it ends at the first bracket, and can't be the wanted one.
    """
    plain = r"""[^<>&"']*+(?:(?:"[^"<>&]*+"|'[^'<>&]*+')[^<>&"']*+)*+"""
    return rf"<([a-z][^\s/>]*+)(?=[\s>])(?![^<>]*{wanted}){plain}>[^<]*+</\1>"


def _piece(wanted: str) -> str:
    """A pattern for a text and a leaf or other markup behind it; a page is such pieces."""
    markup = MARKUP.replace(r"\1", r"\2")
    return rf"(?is)[^<]*+(?:{_leaf(wanted)}|{markup}|<|$)".replace("$", r"\z")


def _attribute(name: str, value: str = "") -> str:
    """A pattern for a start tag with this attribute; of several the first counts."""
    ends = r"(?:[\s/>=]|$)"
    other = rf"(?:[\s/>=]*+(?!{name}{ends})[^\s/>=]++(?:\s*+=\s*+{VALUE})?+)*+"
    return rf"{_NAME}{other}[\s/>=]*+{name}{value or f'(?={ends})'}".replace("$", r"\z")


def _value(markup: Column, name: str) -> Column:
    """An attribute of a start tag as it is written; empty if it has none."""
    found = F.regexp_extract(markup, _attribute(name, rf"\s*+=\s*+({VALUE})"), 2)
    quoted = found.startswith('"') | found.startswith("'")
    return F.when(quoted, F.substring(found, F.lit(2), F.length(found) - 2)).otherwise(found)


def _tags(pieces: Column, wanted: str) -> Column:
    """What the stack has to know of the pieces: their tags that open or close an element."""
    markup = F.transform(pieces, lambda p: F.substring(p, F.instr(p, "<"), F.lit(1 << 30)))
    name = rf"(?is)\A(?!{_leaf(wanted)}\z)</?([a-z][^\s/>]*+)"
    named = F.transform(
        markup,
        lambda m, place: F.struct(
            (place + 1).alias("at"),
            F.lower(F.regexp_extract(m, name, 2)).alias("name"),
            m.startswith("</").alias("ends"),
            m.alias("markup"),
        ),
    )
    kept = F.filter(
        named, lambda t: (t["name"] != "") & (t["ends"] | ~t["name"].isin(*VOID, *_INERT))
    )

    def of(tag: Column) -> Column:
        m, opens = tag["markup"], ~tag["ends"]
        # It shows the id, or an ``&`` that may spell part of it.
        shows = opens & (m.contains(wanted) | m.contains("&"))
        styled = opens & F.lower(m).contains("style")
        both = F.concat(
            F.when(shows, _value(m, "id")).otherwise(""),
            F.lit(_BETWEEN),
            F.when(styled, _value(m, "style")).otherwise(""),
        )
        return F.struct(
            tag["at"].alias("at"),
            tag["name"].alias("name"),
            tag["ends"].alias("ends"),
            (opens & F.lower(m).contains("hidden") & m.rlike(_attribute("hidden"))).alias("hidden"),
            # References resolved, in both at once: the rules for them are long.
            F.split(F.when(shows | styled, unescape(both)), _BETWEEN).alias("values"),
        )

    return F.transform(
        F.transform(kept, of),
        lambda tag: F.struct(
            tag["at"].alias("at"),
            tag["name"].alias("name"),
            tag["ends"].alias("ends"),
            (tag["hidden"] | F.coalesce(F.get(tag["values"], F.lit(1)).rlike(f"(?i){HIDING_STYLE}"), F.lit(False)))
            .alias("hides"),
            F.coalesce(F.get(tag["values"], F.lit(0)) == wanted, F.lit(False)).alias("is_wanted"),
        ),
    )


def _next(state: Column, tag: Column) -> Column:
    """The open tags after a tag, and where the wanted element begins and ends.

    An end tag closes the nearest open tag of its name with all those inside, or nothing.
    """
    stack, size = state["stack"], F.size(state["stack"])
    left = size - F.array_position(F.reverse(stack), tag["name"]).cast("int")
    closes = tag["ends"] & (left < size)
    found = state["begins"] > 0
    is_wanted = ~found & tag["is_wanted"]
    # How many tags are open where the outermost hidden one, or the wanted one, is.
    hidden = F.when(tag["hides"] & (state["hidden"] == 0), size + 1).otherwise(state["hidden"])
    hidden = F.when(closes & (left < state["hidden"]), 0).otherwise(hidden)
    return F.when(state["ends"] > 0, state).otherwise(
        F.struct(
            F.when(closes, F.slice(stack, F.lit(1), left))
            .when(tag["ends"], stack)
            .otherwise(F.concat(stack, F.array(tag["name"])))
            .alias("stack"),
            F.when(found | is_wanted, state["hidden"]).otherwise(hidden).alias("hidden"),
            F.when(is_wanted, tag["at"]).otherwise(state["begins"]).alias("begins"),
            F.when(is_wanted, size + 1).otherwise(state["depth"]).alias("depth"),
            F.when(found & closes & (left < state["depth"]), tag["at"]).otherwise(0).alias("ends"),
        )
    )


def element_with_id(html: Column, wanted: str) -> Column:
    """``(html, hidden)``: the first element with an id, and whether one around it is hidden.

    It is as written, up to the tag that closes it. NULL for a page without one; pages that can't
    hold it are not taken apart. What it is inside of, and what comes behind it, is left out.
    """
    may_hold = html.contains(wanted) | html.rlike(r"""(?i)\bid\s*+=\s*+["']?[^"'\s>&]*+&""")
    pieces = F.regexp_extract_all(F.when(may_hold, html), F.lit(_piece(wanted)), F.lit(0))
    start = F.expr(
        "named_struct('stack', cast(array() as array<string>), 'hidden', 0, 'begins', 0, 'depth', 0, 'ends', 0)"
    )

    def part(state: Column, pieces: Column) -> Column:
        last = F.when(state["ends"] > 0, state["ends"]).otherwise(F.size(pieces))
        own = F.slice(pieces, state["begins"], last - state["begins"] + 1)
        # Without the text before its tag.
        own = F.regexp_replace(F.array_join(own, ""), r"\A[^<]*+", "")
        found = F.struct(own.alias("html"), (state["hidden"] > 0).alias("hidden"))
        return F.when(state["begins"] > 0, found)

    def of(pieces: Column) -> Column:
        return F.aggregate(_tags(pieces, wanted), start, _next, lambda state: part(state, pieces))

    # Once for each page, whatever number of times the pieces are used.
    return F.get(F.transform(F.array(pieces), of), F.lit(0))
