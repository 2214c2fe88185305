from panelwright.operators.aggregates import (
    conditional_sums,
    fan_out_sums,
    leader,
    side_totals,
    sum_by_dimension,
    union_distinct,
)
from panelwright.operators.joins import (
    Match,
    Matched,
    hot_keys,
    lookup,
    match_and_report,
    name_ids,
    outer_merge,
    outer_merge_skewed,
    semi,
    unmatched_names,
)
from panelwright.operators.keys import dense_keys
from panelwright.operators.merge import insert_ignore, last_known, merge_rows
from panelwright.operators.quality import (
    audit,
    foreign_key_orphans,
    key_duplicates,
    null_violations,
    precision_violations,
)
from panelwright.operators.ranking import first_per_key, sort_desc, top_k, top_per_group
from panelwright.operators.reshape import pivot_first, unpivot_columns

__all__ = [
    "Match",
    "Matched",
    "audit",
    "conditional_sums",
    "dense_keys",
    "fan_out_sums",
    "first_per_key",
    "foreign_key_orphans",
    "hot_keys",
    "insert_ignore",
    "key_duplicates",
    "last_known",
    "leader",
    "lookup",
    "match_and_report",
    "merge_rows",
    "name_ids",
    "null_violations",
    "outer_merge",
    "outer_merge_skewed",
    "pivot_first",
    "precision_violations",
    "semi",
    "side_totals",
    "sort_desc",
    "sum_by_dimension",
    "top_k",
    "top_per_group",
    "union_distinct",
    "unmatched_names",
    "unpivot_columns",
]
