from nearrate.functions.expressions import (
    scale, normalized_deviation, combine, absolute_error, counts_sim, positive_sim, round_sim, SIM_DIGITS,
)

__all__ = ["scale", "normalized_deviation", "combine", "absolute_error", "counts_sim", "positive_sim", "round_sim", "SIM_DIGITS"]
