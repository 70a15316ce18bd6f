"""From raw documents to a training mix: the stages of ``portalmeter.llm.stages``, for running them from here."""

from portalmeter.llm.stages import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
