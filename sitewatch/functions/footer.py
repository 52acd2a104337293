"""Footer fields of a page.

The footer's element is cut out of the page natively (``elements.py``). Only it goes to Python,
the one place that runs there: an Arrow-batched UDF that reads the visible texts of the element by
the rules of a browser. Everything after the raw text is native again.
"""

import re
import sys
from collections import Counter
from html import unescape

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sitewatch.functions.elements import HIDING_STYLE, MARKUP, VALUE, VOID, element_with_id
from sitewatch.schemas import NOT_FOUND

# Ids of the footer element and of the fields inside it.
CONTAINER_ID = "idCorpoRodape"
FIELD_IDS = {
    "data-atualizacao-pagina": "date_time",
    "usuario-atualizacao-pagina": "updated_by",
    "responsavel-pagina": "responsible",
}

# Element classes of HTML.
_CELL = {"td", "th"}
_BLOCK = set(
    "address article aside blockquote dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section summary table tr ul".split()
)

_FLAGS = re.IGNORECASE | re.ASCII
_TAGS = re.compile(MARKUP.replace("$", r"\Z"), _FLAGS | re.DOTALL)
_ATTRIBUTE = re.compile(rf"([^\s/>=]++)(?:\s*+=\s*+({VALUE}))?".replace("$", r"\Z"), _FLAGS)
_HIDES = re.compile(HIDING_STYLE, _FLAGS)
_BLANKS = re.compile(r"[ \t\r\n\f]+")
_RAW = ["full_text", "date_time", "updated_by", "responsible"]

# Executors get this module with the task, the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _attributes(text):
    """Attributes by lower-case name; of a repeated one the first counts."""
    found = {}
    for name, value in _ATTRIBUTE.findall(text):
        if value.startswith(("'", '"')):
            value = value[1:-1]
        found.setdefault(name.lower(), unescape(value))
    return found


class _Lines:
    """The visible text of one element as it grows."""

    def __init__(self):
        self.lines = [""]

    def add(self, text):
        self.lines[-1] += text

    def end_line(self, even_if_empty=False):
        if even_if_empty or self.lines[-1].strip(" "):
            self.lines.append("")

    def text(self):
        trimmed = "\n".join(_BLANKS.sub(" ", line).strip(" ") for line in self.lines)
        return trimmed.strip("\n").replace("\xa0", " ")


def _walk(html, hidden=False):
    """Collect the visible lines of the footer and its fields, by field.

    ``html`` may be the footer's element alone; ``hidden`` says whether an element around is.
    """
    fields = {}
    elements = [("", hidden, None)]  # (tag, hidden, field) of every open element
    open_tags = Counter()
    reading = []  # the fields whose elements are open

    def read_text(begin, end):
        if reading and end > begin and not elements[-1][1]:
            text = _BLANKS.sub(" ", unescape(html[begin:end]))
            for field in reading:
                fields[field].add(text)

    position = 0
    for markup in _TAGS.finditer(html):
        read_text(position, markup.start())
        position = markup.end()
        if not markup[3]:
            continue
        tag = markup[3].lower()
        for field in reading:
            if tag == "br" or tag in _BLOCK:
                fields[field].end_line(even_if_empty=tag == "br")
            elif tag in _CELL:
                fields[field].add(" ")

        if markup[2]:
            while open_tags[tag]:
                closed, _, field = elements.pop()
                open_tags[closed] -= 1
                if field:
                    reading.remove(field)
                if field == "full_text":
                    return fields
                if closed == tag:
                    break
        elif tag not in VOID:
            attributes = _attributes(markup[4])
            hides = "hidden" in attributes or _HIDES.search(attributes.get("style", ""))
            field = FIELD_IDS.get(attributes.get("id"))
            if "full_text" not in fields:
                field = "full_text" if attributes.get("id") == CONTAINER_ID else None
            elif field in fields:
                field = None
            if field:
                fields[field] = _Lines()
                reading.append(field)
            elements.append((tag, elements[-1][1] or bool(hides), field))
            open_tags[tag] += 1
    read_text(position, len(html))
    return fields


def read_footer(html, hidden=False):
    """Raw visible texts of one footer, None for what it does not have."""
    fields = _walk(html, hidden)
    return tuple(fields[name].text() if name in fields else None for name in _RAW)


@F.pandas_udf(StructType([StructField(field, StringType()) for field in _RAW]))
def _raw_footer(html: pd.Series, hidden: pd.Series) -> pd.DataFrame:
    nothing = (None,) * len(_RAW)
    rows = [read_footer(*own) if own[0] else nothing for own in zip(html, hidden)]
    return pd.DataFrame(rows, columns=_RAW)


def with_raw_footer(pages: DataFrame) -> DataFrame:
    """``pages`` with the struct ``raw`` of the raw footer texts in place of ``html``."""
    cut = pages.withColumn("raw", element_with_id(F.col("html"), CONTAINER_ID)).drop("html")
    return cut.withColumn("raw", _raw_footer(F.col("raw.html"), F.col("raw.hidden")))


def found_or_default(text: Column) -> Column:
    """The text unchanged, or the marker when it is missing, empty or only whitespace."""
    blank = F.coalesce(text, F.lit("")).rlike(r"(?U)^[\s\x1c-\x1f]*$")
    return F.when(blank, F.lit(NOT_FOUND)).otherwise(text)


def date_token(date_time: Column) -> Column:
    """The part before the first blank; the marker stays whole."""
    return F.when(date_time == NOT_FOUND, date_time).otherwise(
        F.get(F.split(date_time, " ", 2), F.lit(0))
    )


def observed_fields(raw: Column) -> list[Column]:
    """The four history fields of a raw footer.

    When none of the three fields was found, the footer's text is not kept either.
    """
    date_time = found_or_default(raw["date_time"])
    updated_by = found_or_default(raw["updated_by"])
    responsible = found_or_default(raw["responsible"])
    any_found = (
        (date_time != NOT_FOUND) | (updated_by != NOT_FOUND) | (responsible != NOT_FOUND)
    )
    full_text = F.when(any_found, found_or_default(raw["full_text"])).otherwise(F.lit(NOT_FOUND))
    return [
        date_token(date_time).alias("modified_date"),
        updated_by.alias("updated_by"),
        responsible.alias("responsible"),
        full_text.alias("full_modified_text"),
    ]
