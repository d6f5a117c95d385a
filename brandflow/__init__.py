"""brandflow: brand gain/loss (switching) analysis on household panels, on Spark.

Stages are DataFrame -> DataFrame functions (``brandflow.operators``), the
seven formulations of the whole query are option sets of
``brandflow.plans.gain_loss``, inputs and stores live in ``brandflow.sources``.
"""

from .functions import Periods
from .plans import VARIANTS, gain_loss

__all__ = ["VARIANTS", "Periods", "gain_loss"]
