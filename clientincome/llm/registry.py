"""What the entry module adds to its queries if this subpackage is there."""

from __future__ import annotations

import corpus_pipeline
from clientincome.llm.queries import QUERIES, SQL


def queries() -> dict:
    return {**QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {**SQL, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})}
