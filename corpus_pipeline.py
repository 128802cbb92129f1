"""A training-data pipeline over the documents table, one operator of gridloom.llm for each stage.

STAGES has (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a DataFrame
that is written and read again as the next one's docs. All but the last return the columns of docs.
"""

from gridloom.llm.stages import STAGES, run

#: Language models, near copies and BPE cannot be put in SQL.
ORACLE_SQL = None

__all__ = ["ORACLE_SQL", "STAGES", "run"]
