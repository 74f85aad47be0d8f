"""Sources: landed-file readers and raw-zone landing writers."""
from strata.sources.landing import land_delimited, land_documents, land_json_arrays, land_lines
from strata.sources.readers import (
    NESTED_DOCUMENT,
    classify_payloads,
    explode_series,
    in_list,
    lookback,
    period_list,
    read_delimited,
    read_documents,
    read_json_array,
    split_documents,
    split_payloads,
    stamp_lineage,
    variant_fields,
    variant_payloads,
)

__all__ = [
    "NESTED_DOCUMENT", "classify_payloads", "explode_series", "in_list", "land_delimited", "land_documents",
    "land_json_arrays", "land_lines", "lookback", "period_list", "read_delimited",
    "read_documents", "read_json_array", "split_documents", "split_payloads", "stamp_lineage",
    "variant_fields", "variant_payloads",
]
