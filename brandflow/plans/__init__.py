"""Whole-analysis plans: the seven variants of the gain/loss query."""

from .sql import declare_periods, register_gain_loss
from .variants import VARIANTS, Variant, allocated_spend, gain_loss

__all__ = ["VARIANTS", "Variant", "allocated_spend", "declare_periods", "gain_loss", "register_gain_loss"]
