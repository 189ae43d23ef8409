from cardwatch.functions.columns import (changed, differs, full_name, minus_days,
                                        nulls_last, within)

__all__ = ["changed", "differs", "full_name", "minus_days", "nulls_last", "within"]
