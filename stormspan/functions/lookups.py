"""Fixed lookup values of the domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .calendar import _col

# Waterway name of each archive segment.
WATERWAY_OF_SEGMENT = {
    1: "NSC Upper (NSWRP)",
    2: "NSC Lower (NSWRP)",
    3: "NBCR Lower (NSC Confluence)",
    4: "NBCR Upper (NSC Confluence)",
    5: "Chicago R",
    6: "SB Chicago R",
    7: "SF SB Chicago R",
    8: "CSSC Upper (SWRP)",
    9: "CSSC Lower (SWRP)",
    10: "CSSC Lower (SWRP)",
    11: "CSSC Lower (SWRP)",
    12: "Weller Cr",
    13: "DesPlaines Upper",
    14: "DesPlaines Middle",
    15: "DesPlaines Lower",
    16: "Salt Cr",
    17: "Cal R",
    18: "Grand Cal R",
    19: "Little Cal R (North)",
    20: "Little Cal R (South)",
    21: "Cal Sag Ch",
    22: "Cal Union drainage Ditch",
    23: "Addison Cr",
    30: "",
    31: "",
    32: "",
}

# Spellings of the city accepted in each assistance table.
OWNER_CITY_SPELLINGS = (
    "CHIAGO", "CHICAGI", "CHGO", "CHICAGO", "CHICAGOI", "CHICGAGO", "CGICAGO",
    "CHICAAGO", "CHICAGIO", "CHICAGOP", "CHICGO", "GHICAGO", "CHICAGGO", "CHICATO",
    "CHICAGO IL", "CHICGAO", "CHCIAGO", "CHICAG", "CHICAO", "CHCAGO", "CHICAHO",
    "CHHICAGO", "CHICASGO", "CHICACO", "CHIC AGO", "CHUCAGO", "CHIHAGO",
)
RENTER_CITY_SPELLINGS = (
    "CHCAGO", "CHICAGO", "CHICOAG", "CHGO", "CHICAO", "CHICGO", "CHCIAGO",
    "CHICAGO APT B", "CHICAAGO", "CHICAGO ", "CHICAGOIL", "CHICAGO IL",
)
REGISTRATION_CITY_SPELLINGS = (
    "CHGO", "CHICAGO", "CHIHAGO", "CHUCAGO", "CHICGO", "CGICAGO", "CHICAG", "CHHICAGO",
    "CHCAGO", "CHIAGO", "CHCIAGO", "CHICAGGO", "CHICAGI", "CHG", "CHICAAGO", "CHICAGIO",
    "CHICACO", "CHIC AGO", "CHICAGO IL", "CHICATO", "CHICAGO ", "CHICAGOP", "CHICGAO",
    "CHICAHO", "CHICAGOI", "CHICAO", "CHICASGO", "CHICOAG", "CHICAGOIL", "CHICGAGO",
    "CHICAGO APT B",
)

# Areas left out of the parcel correlation as outliers.
PARCEL_OUTLIER_AREAS = ("LOOP", "NEAR NORTH SIDE", "LINCOLN PARK")


def waterway_name(segment: Column | str) -> Column:
    """Waterway of a segment number.

    An unknown segment stops the job, as a wrong waterway would silently move
    overflow volume between rivers; a null segment stays null.
    """
    segment = _col(segment).cast("int")
    pairs = [F.lit(x) for item in WATERWAY_OF_SEGMENT.items() for x in item]
    name = F.try_element_at(F.create_map(*pairs), segment)
    unknown = F.raise_error(F.concat(F.lit("unknown waterway segment "), segment.cast("string")))
    return F.when(segment.isNull(), F.lit(None)).otherwise(F.coalesce(name, unknown.cast("string")))
