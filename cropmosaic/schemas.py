"""Schemas of the tables the operators accept, and the fixed dimension tables."""

from pyspark.sql import DataFrame, SparkSession

from cropmosaic.functions.geometry import RINGS_TYPE

# Attribute names of each kind of delivered polygon file, as DDL. The origin columns are filled by the reader.
_ORIGIN = f"rings {RINGS_TYPE}, srid int, source_path string, record bigint"
FILE_SCHEMAS = {
    "pg": "ID_PARCEL string, CODE_CULTU string, CODE_GROUP string, CULTURE_D1 string, "
    "CULTURE_D2 string, SURF_PARC double, " + _ORIGIN,
    "ia": "NUM_ILOT string, ID_ILOT string, CODE_CULTU string, " + _ORIGIN,
    "commune": "insee string, nom string, surf_ha double, " + _ORIGIN,
    "department": "code_insee string, insee_dep string, " + _ORIGIN,
}

# Columns of the published code tables.
CROP_GROUPS_CSV = (
    "CODE_CULTURE string, LIBELLE_CULTURE string, CODE_GROUPE_CULTURE int, LIBELLE_GROUPE_CULTURE string"
)
CATCH_CROPS_CSV = "CODE_CULTURE_DEROBEE string, LIBELLE_CULTURE_DEROBEE string"

# Columns of the prepared table, in order.
PREPARED_COLUMNS = [
    "geo_unit",
    "CODE_GROUP",
    "cult_label",
    "data_type",
    "region",
    "name",
    "year",
    "surf_tot_geo_unit_m2",
    "surf_agri_geo_unit_m2",
    "surf_cult_m2",
    "surf_cult_perc",
    "parcel_cult_n",
    "parcel_cult_perc",
]

# Columns of the map table, in order.
MAP_COLUMNS = [
    "geo_unit",
    "name",
    "region",
    "year",
    "data_type",
    "surf_tot_geo_unit_m2",
    "surf_agri_geo_unit_m2",
    "N_Parcels",
    "CODE_GROUP",
    "cult_label",
    "surf_cult_m2",
    "surf_cult_perc",
    "parcel_cult_n",
    "parcel_cult_perc",
]

# The 13 regions of metropolitan France with the codes used in file names.
REGIONS = [
    ("Auvergne-Rhône-Alpes", "R84"),
    ("Bourgogne-Franche-Comté", "R27"),
    ("Bretagne", "R53"),
    ("Centre-Val de Loire", "R24"),
    ("Corse", "R94"),
    ("Grand Est", "R44"),
    ("Hauts-de-France", "R32"),
    ("Île-de-France", "R11"),
    ("Normandie", "R28"),
    ("Nouvelle-Aquitaine", "R75"),
    ("Occitanie", "R76"),
    ("Pays de la Loire", "R52"),
    ("Provence-Alpes-Côte d’Azur", "R93"),
]

# Years for which parcel files may exist.
FIRST_YEAR, LAST_YEAR = 2007, 2022

# Departments of two regions, for regional subsets.
DEPARTMENTS_ILE_DE_FRANCE = ["75", "77", "78", "91", "92", "93", "94", "95"]
DEPARTMENTS_CORSE = ["2A", "2B"]

# Group codes missing from the published table, with their labels.
EXTRA_LABELS = [
    ("10", "Semences"),
    ("12", "Gel industriel"),
    ("13", "Autre gel"),
    ("27", "Arboriculture"),
]


def _literal_table(spark: SparkSession, rows: list[tuple[str, str]], columns: str) -> DataFrame:
    """Fixed rows as inline VALUES, whose size Spark knows: joins with them are broadcast unasked."""
    quoted = ", ".join("(" + ", ".join("'" + v.replace("'", "\\'") + "'" for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {quoted} AS t({columns})")


def region_dim(spark: SparkSession) -> DataFrame:
    """The 13 regions: region_name, region_code."""
    return _literal_table(spark, REGIONS, "region_name, region_code")


def extra_labels(spark: SparkSession) -> DataFrame:
    return _literal_table(spark, EXTRA_LABELS, "CODE_GROUP, cult_label")
