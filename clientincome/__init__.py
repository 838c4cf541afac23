"""Client income engine on Spark.

Estimates the monthly income of bank clients from payroll income, deposit
accounts, money transfers, remittances and currency exchange histories.
Every operator takes and returns Spark DataFrames; nothing runs at import.
"""

from clientincome.semantics import CORRECTED, REFERENCE, RunParams, Semantics

__all__ = ["CORRECTED", "REFERENCE", "RunParams", "Semantics"]
