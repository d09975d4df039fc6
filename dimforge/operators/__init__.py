"""DataFrame operators of a conformed load."""

from dimforge.operators.aggregate import group_sum
from dimforge.operators.joins import (
    Lookup,
    Sizes,
    bounded_fits,
    chain_lookups,
    check_lookups,
    checked_bytes,
    fits_broadcast,
    lookup_join,
    match_flags,
    merge_lookups,
    narrowed,
    note_sizes,
    proven_small,
    semi_join,
    sizes_of,
)
from dimforge.operators.origin import attach_origin, origin_registry
from dimforge.operators.stage import (
    all_equal,
    contains,
    in_list,
    origin_cutover,
    stage,
    starts_with,
)
from dimforge.operators.union import align, conform_origins, conform_union, union_all

__all__ = [
    "Lookup", "Sizes", "align", "all_equal", "bounded_fits", "chain_lookups", "check_lookups", "checked_bytes", "attach_origin", "conform_origins", "conform_union", "contains",
    "fits_broadcast", "group_sum", "in_list", "lookup_join", "match_flags", "merge_lookups", "narrowed", "note_sizes", "origin_cutover",
    "origin_registry", "proven_small", "semi_join", "sizes_of", "stage", "starts_with", "union_all",
]
