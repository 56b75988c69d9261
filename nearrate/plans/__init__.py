"""Named query plans: the Spark side and an independent SQL oracle for each."""

from nearrate.plans.catalog import QUERIES, ORACLES, flagship

__all__ = ["QUERIES", "ORACLES", "flagship"]
