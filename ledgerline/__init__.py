"""Daily merchant settlement and reconciliation as Spark DataFrame jobs."""

from ledgerline.plans.params import Params
from ledgerline.plans.settlement import settlement_report
from ledgerline.sources.inputs import Inputs

__all__ = ["Inputs", "Params", "settlement_report"]
