"""Departments and regions from postal and commune codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_REGION = "regioninconnue"
# Departments of each region.
REGIONS = {
    "Auvergne-Rhône-Alpes": ("01", "03", "07", "15", "26", "38", "42", "43", "63", "69", "73", "74"),
    "Bourgogne-Franche-Comté": ("21", "25", "39", "58", "70", "71", "89", "90"),
    "Bretagne": ("22", "29", "35", "56"),
    "Centre-Val de Loire": ("18", "28", "36", "37", "41", "45"),
    "Corse": ("2A", "2B"),
    "Grand Est": ("08", "10", "51", "52", "54", "55", "57", "67", "68", "88"),
    "Hauts-de-France": ("02", "59", "60", "62", "80"),
    "Île-de-France": ("75", "77", "78", "91", "92", "93", "94", "95"),
    "Normandie": ("14", "27", "50", "61", "76"),
    "Nouvelle-Aquitaine": ("16", "17", "19", "23", "24", "33", "40", "47", "64", "79", "86", "87"),
    "Occitanie": ("09", "11", "12", "30", "31", "32", "34", "46", "48", "65", "66", "81", "82"),
    "Pays de la Loire": ("44", "49", "53", "72", "85"),
    "Provence-Alpes-Côte d'Azur": ("04", "05", "06", "13", "83", "84"),
    "Guadeloupe": ("971",),
    "Martinique": ("972",),
    "Guyane": ("973",),
    "La Réunion": ("974",),
    "Mayotte": ("976",),
}


def region_key(name: Column) -> Column:
    """Lower case without hyphens, apostrophes and spaces; a blank is the unknown region."""
    key = F.regexp_replace(F.lower(F.trim(name)), "[-' ]", "")
    return F.coalesce(F.nullif(key, F.lit("")), F.lit(UNKNOWN_REGION))


def region_map() -> Column:
    return F.create_map(*[F.lit(x) for name, codes in REGIONS.items() for c in codes for x in (c, name)])


def department(postal: Column) -> Column:
    """Three characters overseas, else two; nothing for a missing code."""
    p = F.coalesce(F.trim(postal), F.lit(""))
    return F.when((F.length(p) >= 3) & (p.startswith("97") | p.startswith("98")), F.left(p, F.lit(3))).otherwise(F.left(p, F.lit(2)))


def region_of_postal(postal: Column) -> Column:
    """Region key of a postal code, by its department's prefix."""
    return region_key(F.try_element_at(region_map(), department(postal)))


def region_of_commune(commune: Column) -> Column:
    code = F.when(commune.startswith("97"), F.left(commune, F.lit(3))).otherwise(F.left(commune, F.lit(2)))
    return F.try_element_at(region_map(), code)


def match_type(pc_a: Column, loc_a: Column, pc_b: Column, loc_b: Column) -> Column:
    """struct(type, similarity) of two places."""
    e = lambda c: F.coalesce(c, F.lit(""))
    dep = department(pc_a)
    t = (
        F.when((e(pc_a) == "") | (e(pc_b) == ""), "UNKNOWN")
        .when(pc_a == pc_b, "EXACT_POSTAL_CODE")
        .when((e(loc_a) != "") & (e(loc_a) == e(loc_b)), "SAME_LOCALITY")
        .when((dep != "") & (dep == department(pc_b)), "SAME_DEPARTMENT")
        .otherwise("DIFFERENT")
    )
    sim = F.when(t == "EXACT_POSTAL_CODE", 1.0).when(t == "SAME_LOCALITY", 0.9).when(t == "SAME_DEPARTMENT", 0.5).otherwise(0.0)
    return F.struct(t.alias("type"), sim.alias("similarity"))
