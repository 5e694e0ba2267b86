"""Catalogue of parcel files from crawled download pages."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropmosaic.functions.geometry import bind
from cropmosaic.functions.text import first_of, strip_trailing_newline
from cropmosaic.schemas import FIRST_YEAR, LAST_YEAR, REGIONS


def _inside_lists(tags: str) -> str:
    """The <a> tags of an array of tags that stand inside a list, as SQL text.

    The running sum of list starts and ends, lifted by its lowest point so far, is the depth that
    never falls below zero. Tags are folded in blocks of about the square root of their number:
    first the sum and lowest point of each block, then those before each block, then the tags of
    each block; so no growing array is copied once per tag.
    """
    blocks = (
        f"transform(sequence(0, (size({tags}) - 1) div lb), lk -> slice({tags}, lk * lb + 1, lb))"
    )
    step = "CASE lower(left(lg, 3)) WHEN '<ul' THEN 1 WHEN '</u' THEN -1 ELSE 0 END"
    grown = bind("ls", f"lt.s + {step}", "struct(ls AS s, least(lt.low, ls) AS low)")
    sums = f"transform(lbs, lk -> aggregate(lk, struct(0 AS s, 0 AS low), (lt, lg) -> {grown}))"
    place = "struct<s:int,low:int>"
    before = (
        f"aggregate({sums}, struct(0 AS s, 0 AS low, CAST(array() AS array<{place}>) AS seen), (lt, lv) -> "
        "struct(lt.s + lv.s AS s, least(lt.low, lt.s + lv.low) AS low, "
        "concat(lt.seen, array(struct(lt.s AS s, lt.low AS low))) AS seen), lt -> lt.seen)"
    )
    kept = bind(
        "ln",
        grown,
        "struct(ln.s AS s, ln.low AS low, CASE WHEN ln.s > ln.low AND lower(left(lg, 2)) = '<a' "
        "THEN concat(lt.kept, array(lg)) ELSE lt.kept END AS kept)",
    )
    found = (
        f"zip_with(lbs, {before}, (lk, lp) -> aggregate(lk, struct(lp.s AS s, lp.low AS low, "
        f"CAST(array() AS array<string>) AS kept), (lt, lg) -> {kept}, lt -> lt.kept))"
    )
    size = f"CAST(ceil(sqrt(size({tags}))) AS INT)"
    return f"CASE WHEN size({tags}) > 0 THEN flatten({bind('lb', size, bind('lbs', blocks, found))}) END"


def extract_links(pages: DataFrame, block_pattern: str | None = None) -> DataFrame:
    """page_id, url of every <a href> inside a list, optionally within one block of the page.

    `block_pattern` is a regular expression whose first group is the block. List depth is
    counted tag by tag, so nested lists are read whole and links outside lists are not read; an
    end of a list that never began counts for nothing. Values may stand in quotes or bare. Pages
    are read row by row, and nothing is shuffled.
    """
    html = F.col("html") if block_pattern is None else F.regexp_extract("html", block_pattern, 1)
    tags = F.regexp_extract_all(html, F.lit(r"(?is)(<ul\b|</ul\s*>|<a\b[^>]*>)"), F.lit(1))
    href = r"""(?is)^<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    url = F.concat(*[F.regexp_extract("tag", href, i) for i in (1, 2, 3)])
    return (
        pages.select("page_id", tags.alias("tags"))
        .select("page_id", F.explode(F.expr(_inside_lists("tags"))).alias("tag"))
        .filter(F.col("tag").rlike(href))
        .select("page_id", F.replace(url, F.lit("&amp;"), F.lit("&")).alias("url"))
    )


def region_year_grid(regions: DataFrame, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    """Every region in every year for which a file may exist: region_name, region_code, year."""
    return regions.select(
        "region_name", "region_code", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year")
    )


def link_catalog(
    links: DataFrame, grid: DataFrame, first: int = FIRST_YEAR, last: int = LAST_YEAR
) -> DataFrame:
    """region_name, region_code, year, url for the links naming a region, by year and region.

    Region and year are the first of the grid's codes and of the years found in the url; a link
    without a known year stays, unnamed, at the end. The url ends the sort key, so that a region and
    year with very many links is still spread over the sorted ranges.
    """
    listed = {r["region_code"] for r in grid.select("region_code").distinct().collect()}  # a dimension: one row per region
    usual = [code for _, code in REGIONS if code in listed]
    codes = usual + sorted(c for c in listed if c is not None and c not in usual)
    years = [str(y) for y in range(first, last + 1)]
    tagged = links.select(
        "url",
        first_of(F.col("url"), codes).alias("region_code"),
        first_of(F.col("url"), years).cast("int").alias("year"),
    ).filter(F.col("region_code").isNotNull())
    return (
        tagged.join(grid, ["region_code", "year"], "left")
        .select("region_name", "region_code", "year", strip_trailing_newline(F.col("url")).alias("url"))
        .orderBy(F.asc_nulls_last("year"), F.asc_nulls_last("region_name"), "url")
    )


def missing_files(grid: DataFrame, catalog: DataFrame) -> DataFrame:
    """Region and year pairs without a file."""
    return grid.join(catalog.select("region_code", "year").distinct(), ["region_code", "year"], "left_anti")
