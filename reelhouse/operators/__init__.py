from .rank import global_rank
from .overlap import active_by_month, active_by_month_explode
from .sessions import with_gap, sessionize
from .topk import top_k_per_key

__all__ = ["global_rank", "active_by_month", "active_by_month_explode", "with_gap", "sessionize",
           "top_k_per_key"]
