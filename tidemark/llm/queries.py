"""Registers the queries of all operators."""

from tidemark.llm import op1_query, op2_query, op3_query, op4_query, op5_query, op6_query, op10_query, op7_query, op8_query, op9_query, op11_query, op12_query, op13_query  # noqa: F401  (they register queries)
from tidemark.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
