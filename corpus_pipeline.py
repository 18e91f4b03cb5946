"""The corpus pipeline, under the name it is called by; it is part of ``shelfwise.llm``."""

from shelfwise.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
