"""US state to census region: 51 rows, always."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values. Names match exactly, after title case, so the lower-case "of" keeps
# a title-cased "District Of Columbia" unmatched.
STATES_BY_REGION = {
    "Northeast": [
        "Connecticut", "Maine", "Massachusetts", "New Hampshire", "New Jersey", "New York",
        "Pennsylvania", "Rhode Island", "Vermont",
    ],
    "Midwest": [
        "Illinois", "Indiana", "Iowa", "Kansas", "Michigan", "Minnesota", "Missouri",
        "Nebraska", "North Dakota", "Ohio", "South Dakota", "Wisconsin",
    ],
    "South": [
        "Alabama", "Arkansas", "Delaware", "District of Columbia", "Florida", "Georgia",
        "Kentucky", "Louisiana", "Maryland", "Mississippi", "North Carolina", "Oklahoma",
        "South Carolina", "Tennessee", "Texas", "Virginia", "West Virginia",
    ],
    "West": [
        "Alaska", "Arizona", "California", "Colorado", "Hawaii", "Idaho", "Montana",
        "Nevada", "New Mexico", "Oregon", "Utah", "Washington", "Wyoming",
    ],
}


def region_values() -> str:
    """The lookup as a VALUES list, which Spark sizes exactly when it plans a join."""
    return ", ".join(
        f"('{state}', '{region}')"
        for region, states in STATES_BY_REGION.items()
        for state in states
    )


def dim_region(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {region_values()} AS t(state_name, region)")
