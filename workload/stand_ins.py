"""The tables of a monitored site, derived by Spark from the supplied tables.

Every stand-in uses all rows and whole texts. What the supplied pages lack (in-site links,
footer ids, flags) is derived from their own URLs and texts, never from a row's number.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewatch.functions.urls import canonical_url

SITE = "https://site.example"
START_URL = f"{SITE}/#!/"
RUN_TS = "2030-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_ts():
    return F.expr(f"timestamp_ntz'{RUN_TS}'")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry keyed by page number; the flag comes from the URL and has all three values."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("id"),
        "url",
        F.expr("CASE WHEN url LIKE 'https:%' THEN true WHEN url LIKE '%?%' THEN NULL ELSE false END")
        .alias("is_active"),
        F.expr("timestamp_ntz'2024-01-31 00:00:00'").alias("last_crawled_at"),
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is an observation of the page with the user's number."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("page_id"),
        F.col("ts").alias("scrape_timestamp"),
        F.date_format("ts", "dd/MM/yyyy").alias("modified_date"),
        F.expr("CASE WHEN event_type = 'error' THEN 'Not Found' ELSE event_type END")
        .alias("updated_by"),
        F.col("props").alias("responsible"),
        F.col("props").alias("full_modified_text"),
    )


def in_site_url(url):
    """The page's own path, moved to the site behind the marker."""
    return F.concat(F.lit(f"{SITE}/#!/"), F.regexp_extract(url, "^[a-z]+://[^/]+/(.*)$", 1))


def fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched pages of one site.

    A page is known under its second link's name, so a URL has many fetches; page 0 is the
    site's root. Links become absolute in-site links. The footer gets the ids the monitor
    looks for; pages reached by plain http have no date and German ones hide the footer.
    """
    pages = table(spark, sf_dir, "pages")
    name = F.get(F.regexp_extract_all("html", F.lit('<a href="(/[^"]*)"'), F.lit(1)), F.lit(1))
    fetched_at = F.expr(
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(page_id as int), 0)"
    )
    date = F.when(
        F.col("url").startswith("https:"),
        F.concat(
            F.lit(' <i><span id="data-atualizacao-pagina"> '),
            F.date_format(fetched_at, "dd/MM/yyyy HH:mm"),
            F.lit("&nbsp;</span></i>"),
        ),
    ).otherwise(F.lit(""))
    footer = F.concat(
        F.lit('<footer id="idCorpoRodape"'),
        F.when(F.col("url").contains("/de/"), F.lit(" hidden")).otherwise(F.lit("")),
        F.lit('>&copy; <span id="responsavel-pagina">$1</span> &middot; '),
        F.lit('<span id="usuario-atualizacao-pagina">$2</span>'),
        date,
        F.lit("</footer>"),
    )
    with_links = F.replace("html", F.lit('<a href="/'), F.lit(f'<a href="{SITE}/#!/'))
    return pages.select(
        "page_id",
        F.when(F.col("page_id") == 0, F.lit(START_URL))
        .otherwise(F.concat(F.lit(f"{SITE}/#!"), name))
        .alias("url"),
        F.regexp_replace(
            with_links, F.lit("<footer>&copy; ([^ <]+) &middot; ([^<]*)</footer>"), footer
        ).alias("html"),
        fetched_at.alias("fetched_at"),
    )


def page_graph(links: DataFrame) -> DataFrame:
    """Links between pages and the names they link to, in both directions."""
    forward = links.select(canonical_url(F.col("url")).alias("src_url"), F.col("href").alias("dst_url"))
    back = forward.select(F.col("dst_url").alias("src_url"), F.col("src_url").alias("dst_url"))
    return forward.unionByName(back)


# Links of one page of an index; a name with more has several such pages.
_INDEX_LINKS = 100


def _anchors(urls):
    return F.array_join(F.transform(urls, lambda u: F.concat(F.lit('<a href="'), u, F.lit('">x</a>'))), " ")


def portal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched pages of a site on which nearly every page is reached, and ids collide.

    A page has its path first and its host behind a second marker, which ids leave out, so pages
    of one path on several hosts share an id. A page links to the index of each name it has a link
    to, an index to its parts, and a part to the pages with that name. The root links to the first
    name's index.
    """
    host = F.regexp_extract("url", "^[a-z]+://([^/]+)/", 1)
    own = F.concat(F.regexp_extract("url", "^[a-z]+://[^/]+/(.*)$", 1), F.lit("/#!/"), host)
    names = F.regexp_extract_all("html", F.lit('<a href="/([^"]*)"'), F.lit(1))
    each = table(spark, sf_dir, "pages").select(
        F.concat(F.lit(START_URL), own).alias("url"), F.explode(names).alias("name")
    ).distinct()
    index = F.concat(F.lit(f"{START_URL}t/"), "name")
    of_page = each.groupBy("url").agg(F.array_sort(F.collect_set(index)).alias("targets"))
    parts = each.groupBy("name").agg(F.ceil(F.count("*") / _INDEX_LINKS).alias("parts"))
    number = F.conv(F.substring(F.md5("url"), 1, 8), 16, 10).cast("bigint")
    part = F.concat(index, F.lit("/"), F.pmod(number, F.col("parts")).cast("string"))
    dealt = each.join(parts, "name").select("name", "url", part.alias("part"))
    # A part has about as many links as it is made for.
    of_part = dealt.groupBy("part").agg(F.array_sort(F.collect_list("url")).alias("targets"))
    of_index = dealt.select("name", "part").distinct().groupBy("name").agg(
        F.array_sort(F.collect_list("part")).alias("targets")
    )
    of_root = each.agg(F.array(F.concat(F.lit(f"{START_URL}t/"), F.min("name"))).alias("targets"))
    fetched = (
        of_page.unionByName(of_part.withColumnRenamed("part", "url"))
        .unionByName(of_index.select(index.alias("url"), "targets"))
        .unionByName(of_root.select(F.lit(START_URL).alias("url"), "targets"))
    )
    return fetched.select(
        "url", _anchors(F.col("targets")).alias("html"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("fetched_at"),
    )
