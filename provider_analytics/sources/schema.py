"""Names and types of the five inputs and of the derived tables."""

from __future__ import annotations

from pyspark.sql import types as T

from .names import normalise

TAXONOMY_SLOTS = 15

# The registry file's column headers that are kept, in file order.
PROVIDER_HEADERS = [
    "NPI",
    "Entity Type Code",
    "Employer Identification Number (EIN)",
    "Provider Organization Name (Legal Business Name)",
    "Provider Last Name (Legal Name)",
    "Provider First Name",
    "Provider Middle Name",
    "Provider Name Prefix Text",
    "Provider Name Suffix Text",
    "Provider Credential Text",
    "Provider Other Organization Name",
    "Provider Other Organization Name Type Code",
    "Provider Other Last Name",
    "Provider Other First Name",
    "Provider Other Middle Name",
    "Provider Other Name Prefix Text",
    "Provider Other Name Suffix Text",
    "Provider Other Credential Text",
    "Provider Other Last Name Type Code",
    "Provider First Line Business Practice Location Address",
    "Provider Second Line Business Practice Location Address",
    "Provider Business Practice Location Address City Name",
    "Provider Business Practice Location Address State Name",
    "Provider Business Practice Location Address Postal Code",
    "Provider Business Practice Location Address Country Code (If outside U.S.)",
    "Provider Business Practice Location Address Telephone Number",
    "Provider Business Practice Location Address Fax Number",
    "Healthcare Provider Taxonomy Code_1",
    "Provider License Number_1",
    "Provider License Number State Code_1",
    "Healthcare Provider Primary Taxonomy Switch_1",
    "Healthcare Provider Taxonomy Code_2",
    "Healthcare Provider Primary Taxonomy Switch_2",
    "Healthcare Provider Taxonomy Code_3",
    "Healthcare Provider Primary Taxonomy Switch_3",
    "Healthcare Provider Taxonomy Code_4",
    "Healthcare Provider Primary Taxonomy Switch_4",
    "Healthcare Provider Taxonomy Code_5",
    "Healthcare Provider Primary Taxonomy Switch_5",
    "Healthcare Provider Taxonomy Code_6",
    "Healthcare Provider Primary Taxonomy Switch_6",
    "Healthcare Provider Taxonomy Code_7",
    "Healthcare Provider Primary Taxonomy Switch_7",
    "Healthcare Provider Taxonomy Code_8",
    "Healthcare Provider Primary Taxonomy Switch_8",
    "Healthcare Provider Taxonomy Code_9",
    "Healthcare Provider Primary Taxonomy Switch_9",
    "Healthcare Provider Taxonomy Code_10",
    "Healthcare Provider Primary Taxonomy Switch_10",
    "Healthcare Provider Taxonomy Code_11",
    "Healthcare Provider Primary Taxonomy Switch_11",
    "Healthcare Provider Taxonomy Code_12",
    "Healthcare Provider Primary Taxonomy Switch_12",
    "Healthcare Provider Taxonomy Code_13",
    "Healthcare Provider Primary Taxonomy Switch_13",
    "Healthcare Provider Taxonomy Code_14",
    "Healthcare Provider Primary Taxonomy Switch_14",
    "Healthcare Provider Taxonomy Code_15",
    "Healthcare Provider Primary Taxonomy Switch_15",
]

# The census variable that carries the population, and the columns
# of the county population answer.
POPULATION_VARIABLE = "B01001_001E"
POPULATION_HEADERS = ["NAME", POPULATION_VARIABLE, "state", "county"]

PROVIDER_COLUMNS = normalise(PROVIDER_HEADERS)

SUBSET_SCHEMA = T.StructType(
    [
        T.StructField("npi", T.LongType()),
        T.StructField("entity_type_code", T.IntegerType()),
        T.StructField("entity_name", T.StringType()),
        T.StructField("practice_address", T.StringType()),
        T.StructField("zip_code", T.StringType()),
        T.StructField("primary_taxonomy_code", T.StringType()),
    ]
)

VIEW_SCHEMA = T.StructType(
    [
        T.StructField("npi", T.LongType()),
        T.StructField("entity_type_code", T.IntegerType()),
        T.StructField("entity_name", T.StringType()),
        T.StructField("practice_address", T.StringType()),
        T.StructField("county_name", T.StringType()),
        T.StructField("classification", T.StringType()),
        T.StructField("grouping", T.StringType()),
        T.StructField("specialization", T.StringType()),
    ]
)
