from wattlake.functions.scalars import (
    cents,
    epoch_hours,
    path_segment,
    round_to,
    run_id_of,
    safe_divide,
    to_hour,
)

__all__ = [
    "cents", "epoch_hours", "path_segment", "round_to", "run_id_of", "safe_divide", "to_hour",
]
