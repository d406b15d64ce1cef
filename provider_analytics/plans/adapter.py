"""Registry-shaped inputs derived from the driver's order, customer and part tables.

The rules are written down in FIXTURES.md; the oracle SQL states them again on its own.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleanse
from ..sources.schema import (
    POPULATION_VARIABLE,
    PROVIDER_COLUMNS,
    PROVIDER_HEADERS,
    TAXONOMY_SLOTS,
)


# Values that several provider columns share, computed once per order. They are
# worked out after the joins, so that a shuffle carries the order's own columns only.
_SHARED = {
    "k": "o_orderkey",
    "z": "string(100 + o_custkey % 60)",
    "odd": "o_orderkey & 1 = 1",
    "nameless": "o_orderkey % 23 = 0",
    "postal_kind": "coalesce(int(o_orderkey & 7), 7)",
    "third": "o_orderkey % 3",
    "fifth": "o_orderkey % 5",
    "even_code_fixed": "o_orderkey % 29 = 0",
    "even_code": "''",
    "odd_code_fixed": "o_orderkey % 13 = 0 OR even_code_fixed",
    "odd_code": "if(o_orderkey % 13 = 0, NULL, '')",
}

# Switches repeat with this period of the order key (16 * 11 * 3), codes with that.
_SWITCH_PERIOD = 528
_CODE_PERIOD = 250
_SLOTS = range(1, TAXONOMY_SLOTS + 1)

_ORDER_COLUMNS = {
    "npi": "string(1000000000 + k)",
    "entity_type_code": "if(k % 17 = 0, '', string(1 + k % 2))",
    cleanse.ORGANISATION: """
        CASE WHEN nameless THEN '' WHEN odd THEN concat('ORG ', o_orderpriority)
             WHEN fifth = 4 THEN NULL ELSE '' END""",
    "provider_name_prefix_text": "if(NOT nameless AND fifth = 0, 'DR.', '')",
    "provider_first_name": "if(nameless, '', concat('F', o_custkey))",
    "provider_middle_name": "if(NOT nameless AND fifth = 1, 'Q.', '')",
    "provider_name_suffix_text": "if(NOT nameless AND fifth = 2, 'JR', NULL)",
    "provider_credential_text": "if(NOT nameless AND third = 0, 'MD', '')",
    cleanse.OTHER_ORGANISATION: "if(third = 0, '', 'ALT')",
    "provider_other_name_prefix_text": "'PROF.'",
    "provider_other_first_name": "if(fifth = 0, '', concat('O', o_custkey))",
    "provider_other_middle_name": "if(fifth = 1, 'X.', NULL)",
    "provider_other_last_name": "if(fifth = 3, '', 'OTHER')",
    "provider_other_name_suffix_text": "if(fifth = 2, 'SR', '')",
    cleanse.PRACTICE_ADDRESS[0]: "concat(k, ' MAIN ST')",
    cleanse.PRACTICE_ADDRESS[1]: "if(postal_kind & 3 = 0, 'STE 1', '')",
    # z has three digits: padded to 5, kept at 3 or cut to 0, then a tail by kind.
    cleanse.POSTAL_CODE: """
        concat(lpad(z, get(array(5, 3, 5, 5, 0, 0, 3, 0), postal_kind), '0'),
               get(array('', '', '1234', '-1234', '', NULL, '12345', 'K1A 0B1'),
                   postal_kind))""",
}

_CUSTOMER_COLUMNS = {
    "provider_last_name_legal_name": "if(nameless, '', c_name)",
    cleanse.PRACTICE_ADDRESS[2]: "n_name",
    cleanse.PRACTICE_ADDRESS[3]: "r_name",
}


def _slot_columns() -> dict[str, str]:
    columns = {}
    for slot in _SLOTS:
        fixed = "odd_code" if slot % 2 == 1 else "even_code"
        columns[cleanse.taxonomy_switch(slot)] = f"switch_{slot}"
        columns[cleanse.taxonomy_code(slot)] = f"if({fixed}_fixed, {fixed}, code_{slot})"
    return columns


def _switch(slot: int) -> str:
    chosen = f"id % 16 = {slot - 1}"
    if slot % 4 == 1:
        chosen += " OR id % 11 = 0"
    return f"CASE WHEN {chosen} THEN 'Y' WHEN id % 3 = 0 THEN 'N' WHEN id % 3 = 1 THEN '' END"


def _with_shared(rows: DataFrame) -> DataFrame:
    """Add the shared values and those of the taxonomy slots.

    Slot values are looked up by remainder. Written out per row they make one
    generated method that is too long for the JVM to compile.
    """
    spark = rows.sparkSession
    switches = spark.range(_SWITCH_PERIOD).selectExpr(
        "id AS switch_key", *[f"{_switch(slot)} AS switch_{slot}" for slot in _SLOTS]
    )
    codes = spark.range(_CODE_PERIOD).selectExpr(
        "id AS code_key",
        *[f"string((id + {7 * slot}) % {_CODE_PERIOD}) AS code_{slot}" for slot in _SLOTS],
    )
    return (
        rows.selectExpr("*", *[f"{value} AS {name}" for name, value in _SHARED.items()])
        .join(F.broadcast(switches), F.expr(f"k % {_SWITCH_PERIOD} = switch_key"), "left")
        .join(F.broadcast(codes), F.expr(f"k % {_CODE_PERIOD} = code_key"), "left")
    )


def _select(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    return rows.selectExpr(*[f"{value} AS {name}" for name, value in columns.items()])


class Inputs:
    """The five inputs over the tables in ``sf_dir``; each table is opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def providers(self) -> DataFrame:
        """All 59 provider columns, normalised names, one row per order."""
        places = (
            self.table("nation")
            .join(self.table("region"), F.expr("n_regionkey = r_regionkey"))
            .select("n_nationkey", "n_name", "r_name")
        )
        rows = self.table("orders").join(
            self.table("customer"), F.expr("o_custkey = c_custkey")
        ).join(places, F.expr("c_nationkey = n_nationkey"))
        values = _ORDER_COLUMNS | _CUSTOMER_COLUMNS | _slot_columns()
        return _select(
            _with_shared(rows),
            {name: values.get(name, "string(NULL)") for name in PROVIDER_COLUMNS},
        )

    @cached_property
    def raw_providers(self) -> DataFrame:
        """The registry file: original headers, and two columns that no job keeps."""
        return self.providers.toDF(*PROVIDER_HEADERS).selectExpr(
            "'unused' AS `Replacement NPI`", "*", "'unused' AS `Is Sole Proprietor`"
        )

    @cached_property
    def _counties(self) -> DataFrame:
        """One row per customer with the county it stands for; counties repeat."""
        return (
            self.table("customer")
            .join(self.table("nation"), F.expr("c_nationkey = n_nationkey"))
            .selectExpr("c_custkey", "n_nationkey", "n_name", "int(c_custkey % 1000) AS number")
            .selectExpr(
                "*",
                "n_nationkey * 1000 + number AS code",
                "concat(n_name, ' COUNTY ', number) AS county_name",
            )
        )

    @cached_property
    def crosswalk(self) -> DataFrame:
        """ZIP to county, one row per customer, copies included."""
        return self._counties.selectExpr(
            "int(100 + c_custkey % 60) AS zip", "code AS county"
        )

    @cached_property
    def fips(self) -> DataFrame:
        """County code and name, copies included; some counties are not listed."""
        return self._counties.where("code % 43 <> 7").selectExpr(
            "code AS fipscounty", "county_name AS countyname_fips"
        )

    @cached_property
    def county_pop(self) -> DataFrame:
        """Population matrix, all text, copies included; some counties are missing."""
        population = """
            CASE WHEN code % 97 = 8 THEN NULL WHEN code % 10 = 1 THEN '70000'
                 ELSE string(bigint(code) * 7919 % 120011) END"""
        return self._counties.where("code % 41 <> 5").selectExpr(
            "county_name AS NAME",
            f"{population} AS {POPULATION_VARIABLE}",
            "lpad(string(n_nationkey), 2, '0') AS state",
            "lpad(string(number), 3, '0') AS county",
        )

    @cached_property
    def raw_nucc(self) -> DataFrame:
        """Taxonomy file: original headers, NULL details, a second row for some codes."""
        return (
            self.table("part")
            .selectExpr(
                "*", "explode(if(p_partkey % 7 = 0, array('', ' ALT'), array(''))) AS suffix"
            )
            .selectExpr(
                "string(p_partkey) AS Code",
                "p_brand AS Grouping",
                "concat(p_type, suffix) AS Classification",
                "if(p_partkey % 5 = 0, NULL, p_name) AS Specialization",
                "if(p_partkey % 6 = 0, NULL, p_size) AS `Display-Size (No.)`",
            )
        )

    @cached_property
    def nucc(self) -> DataFrame:
        """Taxonomy list as the CSV reader returns it: NULL text is ``''``."""
        return self.raw_nucc.na.fill("").toDF(
            "code", "grouping", "classification", "specialization", "display_size_no"
        )
