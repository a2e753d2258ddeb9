"""Scalar column expressions."""

from clinark.functions.exprs import (  # noqa: F401
    age_group,
    age_rank,
    birth_year,
    condition_type,
    first,
    iso_date_text,
    month_of,
    patient_bucket,
    patient_key,
    patient_key_from_ref,
    strip_prefix,
    type_suffix_filter,
)
