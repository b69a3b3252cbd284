from .columns import (concat_null_as_empty, nullif_zero, safe_ratio,
                      typed_null, week_start_date)

__all__ = ["concat_null_as_empty", "nullif_zero", "safe_ratio", "typed_null",
           "week_start_date"]
