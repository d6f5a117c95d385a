"""The analysis stages, each a DataFrame -> DataFrame function."""

from .classify import classify
from .correction import correction_factors, corrected_spend, corrected_spend_raw
from .cseg import cseg_allocation_join, cseg_allocation_window, household_cseg
from .matrix import flow_sums, gain_loss_matrix
from .spend import continuous_sample, household_weights, spend_by_household_brand

__all__ = [
    "classify",
    "continuous_sample",
    "corrected_spend",
    "corrected_spend_raw",
    "correction_factors",
    "cseg_allocation_join",
    "cseg_allocation_window",
    "flow_sums",
    "gain_loss_matrix",
    "household_cseg",
    "household_weights",
    "spend_by_household_brand",
]
