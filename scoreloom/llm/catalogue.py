"""What the subpackage registers: its queries, and the DuckDB twins of those that SQL can express."""

from __future__ import annotations

from scoreloom.llm.oracle import ORACLE as LLM_ORACLE
from scoreloom.llm.queries import QUERIES as LLM_QUERIES

__all__ = ["LLM_ORACLE", "LLM_QUERIES"]
