"""Flood calls per area, disaster assistance and housing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import area_key, canonical_city, number, percent, zip_key
from ..operators.reshape import row_mean, row_sum, wide_to_long

YEARS = tuple(range(2005, 2016))


def calls_per_area(wide: DataFrame, date: str, name: str = "area", value: str = "calls") -> DataFrame:
    """A matrix with one column per area -> total calls per area."""
    areas = [c for c in wide.columns if c != date]
    return wide_to_long(wide.drop(date), [], areas, name, value).groupBy(name).agg(F.sum(value).alias(value))


def basement_to_street(basement: DataFrame, street: DataFrame, date: str) -> DataFrame:
    """Both kinds of calls per area and their ratio."""
    both = calls_per_area(basement, date, value="basement_calls").join(
        calls_per_area(street, date, value="street_calls"), "area"
    )
    return both.withColumn("ratio", F.try_divide("basement_calls", "street_calls"))


def claims_with_disasters(
    claims: DataFrame, disasters: DataFrame, spellings: Sequence[str], city: str = "city"
) -> DataFrame:
    """Claims of the city under one name, every disaster kept."""
    return canonical_city(claims, city, spellings).join(disasters, "disasterNumber", "right")


def assistance_per_zip(owners: DataFrame, renters: DataFrame) -> DataFrame:
    """Approved claims and amounts per zip over both kinds of households."""
    columns = ["zipCode", "approvedForFemaAssistance", "totalApprovedIhpAmount"]
    both = owners.select(*columns).unionByName(renters.select(*columns))
    return both.withColumn("zipCode", zip_key("zipCode")).groupBy("zipCode").agg(
        F.sum("approvedForFemaAssistance").alias("approvedForFemaAssistance"),
        F.sum("totalApprovedIhpAmount").alias("totalApprovedIhpAmount"),
    ).dropna()


def combine_housing(
    accumulation: DataFrame,
    filings: DataFrame,
    per_parcel: DataFrame,
    low_value: DataFrame,
    vacancy: DataFrame,
    *,
    filing_years: Sequence[int] = YEARS,
) -> DataFrame:
    """Five housing tables with text columns -> one row per area present in all.

    Thousands commas are read, so a year with '1,090' in one area counts like
    the others; pass ``filing_years`` without it to leave that year out.
    """
    area = "Community_Area"

    def residential(years):
        return [f"All_Res_{y}" for y in years]

    filed = _parsed(filings, residential(filing_years), number, fill=0.0)
    parcels = [c for c in per_parcel.columns if c != area]
    shares = _parsed(low_value, residential(YEARS), percent, fill=0.0)
    quarters = [c for c in vacancy.columns if c != area]
    return (
        accumulation.select(area, percent("Percentage_Foreclosed_Parcels").alias("Percentage_Foreclosed_Parcels"))
        .join(filed.select(area, row_sum(residential(filing_years)).alias("Foreclosure_Filings_05_15")), area)
        .join(
            _parsed(per_parcel, parcels, number).select(
                area, row_mean(parcels).alias("Foreclosures_per_Parcel_Mean_05_15")
            ),
            area,
        )
        .join(shares.select(area, row_mean(residential(YEARS)).alias("Share_Low_Value_Mean_05_15")), area)
        .join(
            _parsed(vacancy, quarters, percent).select(area, row_mean(quarters).alias("Vacant_Percent_Mean_10_15")),
            area,
        )
        .withColumnRenamed(area, "Community Area")
    )


def _parsed(table: DataFrame, columns: Sequence[str], read, fill: float | None = None) -> DataFrame:
    parsed = table.withColumns({c: read(F.col(c).cast("string")) for c in columns})
    return parsed if fill is None else parsed.fillna(fill, list(columns))


def estimated_parcels(calls: DataFrame, housing: DataFrame, parcels: DataFrame) -> DataFrame:
    """Calls next to parcel counts estimated as percentage times parcels.

    As published, percentages are not divided by 100.
    """
    keyed = housing.withColumn("Community Area", area_key("Community Area"))
    joined = calls.withColumnRenamed("area", "Community Area").join(keyed, "Community Area").join(
        parcels.withColumnRenamed("CommunityArea", "Community Area").select(
            "Community Area", "MeanBldgAge", "ParcelCount", "MeanBldgValue"
        ),
        "Community Area",
    )
    return joined.withColumns({
        "Est_Foreclosed_Parcels": F.col("Percentage_Foreclosed_Parcels") * F.col("ParcelCount"),
        "Est_Low_Value_Parcels": F.col("Share_Low_Value_Mean_05_15") * F.col("ParcelCount"),
        "Est_Vacant_Parcels": F.col("Vacant_Percent_Mean_10_15") * F.col("ParcelCount"),
    })
