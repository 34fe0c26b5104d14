"""Column-expression helpers: bands, flags, exact sums, lookups."""

from bankmart.functions.bands import band, age_band, income_tier, credit_band
from bankmart.functions.exact import exact_sum, exact_avg
from bankmart.functions.flags import churn_flag, high_value_flag
from bankmart.functions.lookup import pick, case_map

__all__ = ["band", "age_band", "income_tier", "credit_band", "exact_sum",
           "exact_avg", "churn_flag", "high_value_flag", "pick",
           "case_map"]
