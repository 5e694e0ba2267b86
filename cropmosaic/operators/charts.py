"""Chart-ready tables; drawing them is left to the reader's plotting library."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropmosaic.operators.analysis import diversity, national_crop_share, top_crop
from cropmosaic.operators.communes import attach_geometry
from cropmosaic.schemas import MAP_COLUMNS

# Column headings of the national report.
REPORT_HEADINGS = {
    "cult_label": "Label de culture",
    "surf_cult_m2": "Surface totale dédiée (m2)",
    "surf_cult_perc": "Pourcentage de la surface totale (%)",
    "parcel_cult_n": "Nombre total de parcelles",
    "parcel_cult_perc": "Pourcentage du nombre total de parcelles (%)",
}


def national_report(compiled: DataFrame, year: int, denominator: str = "rows") -> DataFrame:
    """National shares under the headings of the report."""
    shares = national_crop_share(compiled, year, denominator)
    return shares.select(*[F.col(c).alias(h) for c, h in REPORT_HEADINGS.items()])


def pie_table(compiled: DataFrame, year: int, denominator: str = "rows") -> DataFrame:
    """One row per slice: measure ('area' or 'parcels'), label, percentage."""
    return national_crop_share(compiled, year, denominator).select(
        "cult_label",
        F.expr("stack(2, 'area', surf_cult_perc, 'parcels', parcel_cult_perc) AS (measure, percentage)"),
    )


def map_table(compiled: DataFrame, units: DataFrame) -> DataFrame:
    """The compiled table with outlines, in the layout of the map file."""
    return attach_geometry(compiled, units).select(*MAP_COLUMNS, "rings")


def choropleth_table(
    compiled: DataFrame, units: DataFrame, year: int, value: str = "top_crop", keys: tuple[str, ...] = ("geo_unit",)
) -> DataFrame:
    """Outlines coloured by the leading crop or by the Shannon index of one year.

    The figures are reduced to the rows to draw before they meet the heavy outlines.
    keys=("name",) ranks crops among all communes of the same name.
    """
    rows = compiled.filter(F.col("year") == year)
    if value == "top_crop":
        colours = top_crop(rows, list(keys)).select("geo_unit", "name", "cult_label")
    elif value == "shannon":
        colours = diversity(rows, ["geo_unit"], "surf_cult_perc").select("geo_unit", "shannon_diversity")
    else:
        raise ValueError(f"unknown value {value!r}")
    return attach_geometry(colours, units)


def evolution_table(compiled: DataFrame, name: str) -> DataFrame:
    """Leading crop of one commune year by year, with its area share."""
    rows = compiled.filter(F.col("name") == name)
    return top_crop(rows, ["name", "year"]).select("name", "year", "cult_label", "surf_cult_perc")


def diversity_by_year(compiled: DataFrame, units: DataFrame) -> DataFrame:
    """Point cloud: Shannon and Simpson index per commune and year, for communes with an outline."""
    points = diversity(compiled, ["year", "geo_unit"], "surf_cult_perc")
    return points.join(units.select("geo_unit"), "geo_unit", "left_semi")
