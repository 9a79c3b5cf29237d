from touchstone.operators.compare import multiset_difference
from touchstone.operators.intervals import (
    adjacent,
    conflict_counts,
    conflict_pairs,
    overlapping,
    period_conflicts,
)
from touchstone.operators.keys import (
    duplicates,
    lookup,
    null_safe,
    referenced,
    unreferenced,
    unresolved,
)
from touchstone.operators.lineage import (
    chain_summary,
    chains,
    closed_predecessors,
    cycle_members,
    looping_roots,
    without_successor,
)
from touchstone.operators.scan import OrderedScan
from touchstone.operators.upsert import UpsertError, UpsertResult, merged, upsert, upserted

__all__ = [
    "OrderedScan",
    "UpsertError",
    "UpsertResult",
    "adjacent",
    "chain_summary",
    "chains",
    "closed_predecessors",
    "conflict_counts",
    "conflict_pairs",
    "cycle_members",
    "duplicates",
    "lookup",
    "looping_roots",
    "merged",
    "multiset_difference",
    "null_safe",
    "overlapping",
    "period_conflicts",
    "referenced",
    "unreferenced",
    "unresolved",
    "upsert",
    "upserted",
    "without_successor",
]
