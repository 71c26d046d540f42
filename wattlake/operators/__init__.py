from wattlake.operators.asof import asof_join
from wattlake.operators.joins import dimension_join, orphans
from wattlake.operators.keyed import dedupe_and_difference, difference_by_key, latest_per_key, split_rows
from wattlake.operators.ranking import dense_rank_within, top_n_cutoff
from wattlake.operators.rolling import rolling_mean_by_days
from wattlake.operators.scoring import score_against_group

__all__ = [
    "asof_join", "dedupe_and_difference", "dense_rank_within", "difference_by_key",
    "dimension_join", "latest_per_key", "orphans", "rolling_mean_by_days",
    "score_against_group", "split_rows", "top_n_cutoff",
]
