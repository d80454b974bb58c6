"""Plan helpers: staging of shared inputs and joins that split hot groups."""

from affinis.plans.skew import GROUP_LIMIT, pair_join, split_join
from affinis.plans.staging import spread, stage

__all__ = ["GROUP_LIMIT", "pair_join", "split_join", "spread", "stage"]
