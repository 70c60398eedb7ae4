"""Order-fulfilment analytics on Spark: raw tables to marts, reports and checks."""

from parcelyard.plans.models import Models

__all__ = ["Models"]
