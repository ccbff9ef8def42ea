from contrail.functions.bands import band
from contrail.functions.calendar import (
    calendar_columns, enrich_features, parse_lenient, parse_strict, route_column, season_of_month,
)
from contrail.functions.flags import add_derived_features, flag_columns
from contrail.functions.hashing import hex60, row_digest, seeded_md5, uniform_int

__all__ = [
    "add_derived_features", "band", "calendar_columns", "enrich_features", "flag_columns", "hex60",
    "parse_lenient", "parse_strict", "route_column", "row_digest", "season_of_month", "seeded_md5",
    "uniform_int",
]
