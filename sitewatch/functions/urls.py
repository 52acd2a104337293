"""URL rules as native columns."""

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitewatch.session import as_timestamp

# Fixed values of the site's URL convention and of the page ids made from it.
MARKER = "#!/"
HOMEPAGE_ID = "homepage"
UNKNOWN_ID_PREFIX = "unknown_"

_PLAIN = r"^[\x21-\x7e&&[^\"<>`]]*$"
_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)"


def canonical_url(url: Column) -> Column:
    """The URL without any trailing slash; case, query and fragment stay."""
    return F.rtrim(url, F.lit("/"))


def base_url(url: Column) -> Column:
    """``scheme://host:port`` of an absolute URL, NULL when there is none."""
    origin = F.concat(
        F.lower(F.regexp_extract(url, _ORIGIN, 1)), F.lit("://"), F.regexp_extract(url, _ORIGIN, 2)
    )
    return F.when(url.rlike(_ORIGIN), origin)


def site_prefix(start_url: Column) -> Column:
    """What a link has to start with, as written, to belong to the site."""
    return F.concat(base_url(start_url), F.lit("/" + MARKER))


def marker_path(url: Column) -> Column:
    """Text between the first and the second marker, NULL when there is no marker."""
    return F.get(F.split(url, MARKER, 3), F.lit(1))


def is_sub_page(url: Column) -> Column:
    """True when there is any text after the marker, so not for the site root."""
    return F.coalesce(marker_path(url), F.lit("")) != ""


def page_id(path: Column, run_ts: datetime | Column) -> Column:
    """Page id of a URL path: outer slashes dropped, inner ones made ``_``.

    Not injective (``a/b`` and ``a_b`` meet), see ``registry.one_page_per_id``.
    """
    clean = F.replace(F.btrim(path, F.lit("/")), F.lit("/"), F.lit("_"))
    epoch = F.unix_timestamp(as_timestamp(run_ts).cast("timestamp")).cast("string")
    return F.when(clean == "", F.lit(HOMEPAGE_ID)).otherwise(
        F.coalesce(clean, F.concat(F.lit(UNKNOWN_ID_PREFIX), epoch))
    )


def browser_url(href: Column) -> Column:
    """An in-site link as a browser reports it.

    Outer control characters and blanks go, line breaks and tabs go, and in the
    fragment everything outside printable ASCII, and blanks, quotes,
    angle brackets and backticks, is percent-encoded. Whatever is already encoded stays.
    """
    stripped = F.regexp_replace(href, r"^[\x00-\x20]+|[\x00-\x20]+$|[\t\n\r]", "")
    encoded = F.array_join(
        F.transform(
            F.split(stripped, ""),
            lambda c: F.when(c.rlike(_PLAIN), c).otherwise(
                F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
            ),
        ),
        "",
    )
    return F.when(href.rlike(_PLAIN), href).otherwise(encoded)
