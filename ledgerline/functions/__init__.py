from ledgerline.functions.hashes import row_hash
from ledgerline.functions.labels import banded, two_way_label, value_within
from ledgerline.functions.money import (
    as_money,
    exact_total,
    from_units,
    raised_by,
    share_of,
    units,
    units_deviation,
    units_mean,
    units_total,
)
from ledgerline.functions.times import ISO_DATE, month_text, parsed_date, year_number, year_text

__all__ = [
    "ISO_DATE",
    "as_money",
    "banded",
    "exact_total",
    "from_units",
    "month_text",
    "parsed_date",
    "raised_by",
    "row_hash",
    "share_of",
    "two_way_label",
    "units",
    "units_deviation",
    "units_mean",
    "units_total",
    "value_within",
    "year_number",
    "year_text",
]
