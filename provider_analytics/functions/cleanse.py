"""Cleansing rules for one provider row, as column expressions.

Everything here is a built-in Spark function, so a chain of rules runs as one
narrow projection: no shuffle, no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.schema import TAXONOMY_SLOTS

ORGANISATION = "provider_organization_name_legal_business_name"
PERSON = [
    "provider_name_prefix_text",
    "provider_first_name",
    "provider_middle_name",
    "provider_last_name_legal_name",
    "provider_name_suffix_text",
    "provider_credential_text",
]
OTHER_ORGANISATION = "provider_other_organization_name"
OTHER_PERSON = [
    "provider_other_name_prefix_text",
    "provider_other_first_name",
    "provider_other_middle_name",
    "provider_other_last_name",
    "provider_other_name_suffix_text",
]
PRACTICE_ADDRESS = [
    "provider_first_line_business_practice_location_address",
    "provider_second_line_business_practice_location_address",
    "provider_business_practice_location_address_city_name",
    "provider_business_practice_location_address_state_name",
]
POSTAL_CODE = "provider_business_practice_location_address_postal_code"


def taxonomy_code(slot: int) -> str:
    return f"healthcare_provider_taxonomy_code_{slot}"


def taxonomy_switch(slot: int) -> str:
    return f"healthcare_provider_primary_taxonomy_switch_{slot}"


def blank_to_null(value: Column | str) -> Column:
    """NULL for the empty string. White space alone is a value."""
    return F.nullif(F.col(value) if isinstance(value, str) else value, F.lit(""))


def words(names: list[str]) -> Column:
    """The non-blank values joined by one space; ``''`` when there is none."""
    return F.concat_ws(" ", *[blank_to_null(name) for name in names])


def typed_cast(value: Column | str, type_name: str, strict: bool = True) -> Column:
    """Blank becomes NULL, anything else must parse.

    ``strict`` relies on ANSI mode (Spark 4's default): a malformed value stops
    the job. Otherwise it becomes NULL, see ``operators.quality.malformed_rows``.
    """
    text = blank_to_null(value)
    return text.cast(type_name) if strict else text.try_cast(type_name)


def entity_name(name_fallback: str = "person") -> Column:
    """Organisation name, else the person's name.

    ``"person"`` stops there, so a row with neither gets ``''`` and the "other"
    names are never used. ``"full"`` goes on to the other organisation and the
    other person, and ends in NULL.
    """
    if name_fallback == "person":
        return F.coalesce(blank_to_null(ORGANISATION), words(PERSON))
    if name_fallback == "full":
        return F.coalesce(
            blank_to_null(ORGANISATION),
            blank_to_null(words(PERSON)),
            blank_to_null(OTHER_ORGANISATION),
            blank_to_null(words(OTHER_PERSON)),
        )
    raise ValueError(f"name_fallback must be 'person' or 'full', not {name_fallback!r}")


def practice_address() -> Column:
    """Two address lines, city and state joined by one space."""
    return words(PRACTICE_ADDRESS)


def five_characters(value: Column) -> Column:
    """Left-pad with zeros to five characters, or keep the first five."""
    return F.lpad(value, 5, "0")


def zip_code(value: Column | str = POSTAL_CODE) -> Column:
    """Five-character ZIP of a postal code of one to nine characters, else NULL."""
    text = F.col(value) if isinstance(value, str) else value
    return F.when(F.length(text).between(1, 9), five_characters(text))


def primary_taxonomy() -> Column:
    """Code of the lowest slot that is switched on and has a code.

    A blank code counts as a code, a NULL one does not.
    """
    return F.coalesce(
        *[
            F.when(F.col(taxonomy_switch(slot)) == "Y", F.col(taxonomy_code(slot)))
            for slot in range(1, TAXONOMY_SLOTS + 1)
        ]
    )
