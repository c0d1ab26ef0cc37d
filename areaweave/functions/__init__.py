from areaweave.functions.casts import (
    concat_skip_nulls, name_before, round_half_even, strip_prefix, to_numeric, varchar,
)
from areaweave.functions.release import release_version

__all__ = [
    "concat_skip_nulls", "name_before", "release_version", "round_half_even",
    "strip_prefix", "to_numeric", "varchar",
]
