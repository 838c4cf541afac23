"""Run parameters and the semantics switch.

``REFERENCE`` reproduces the established results of the original pipeline,
quirks included (see README, "Semantics").  ``CORRECTED`` applies the fixes.
Both presets share the deterministic choices that the original left to chance
(seeded hash sampling and splitting, one feature order, a fitted saved model).
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Semantics:
    # Q1: transfer/currency recency measured against the reference month itself
    # (always 1) instead of the history month.
    service_recency_from_month: bool = False
    # Q2: currency activity flag is a literal 0 instead of the population flag.
    fx_flag_from_population: bool = False
    # Q3: the |sum| < 100 floor also zeroes deposit *counts*.
    floor_deposit_counts: bool = True
    # Q4: whole-row dedupe of account-months after the account key is gone.
    dedupe_account_months: bool = True
    # Q5: received/sent express-money counts are not null-filled.
    fill_dex_counts: bool = False
    # Q6: columns the original drops (tot_mto_env_rem_corr, last-month deposits).
    keep_dropped_columns: bool = False
    # Q7: trimmed total scaled by the history length instead of fixed 2..5/4*6.
    trimmed_scaled_by_history: bool = False
    # Q8: training population restricted to natural persons (inner join).
    training_natural_persons_only: bool = False
    # Q10: one deposit-population row per client even when the rank ties.
    distinct_deposit_population: bool = False
    # Q12/Q29: dimensions (contact, census, income, journey) deduplicated by key.
    dedupe_dimensions: bool = False
    # Q14: default postal codes 0 and 99999 both excluded from the factor.
    exclude_default_postal: bool = False
    # Q15: unmatched rules give NULL labels instead of the string 'nan'.
    null_unmatched_label: bool = False
    # Q16: num_flujos used as a count instead of "is not null".
    num_flujos_as_count: bool = False
    # Q17: 'RFM(CAPTACION)' matched literally instead of as a regex.
    literal_rfm_label: bool = False
    # Q31/Q32: NULL channels and activity flags count as 0.
    fill_null_measures: bool = False
    # Q34: population clients without account rows keep a feature row.
    deposits_keep_population: bool = False

    def but(self, **changes) -> "Semantics":
        return replace(self, **changes)


REFERENCE = Semantics()

CORRECTED = Semantics(
    service_recency_from_month=True,
    fx_flag_from_population=True,
    floor_deposit_counts=False,
    dedupe_account_months=False,
    fill_dex_counts=True,
    keep_dropped_columns=True,
    trimmed_scaled_by_history=True,
    training_natural_persons_only=True,
    distinct_deposit_population=True,
    dedupe_dimensions=True,
    exclude_default_postal=True,
    null_unmatched_label=True,
    num_flujos_as_count=True,
    literal_rfm_label=True,
    fill_null_measures=True,
    deposits_keep_population=True,
)


@dataclass(frozen=True)
class RunParams:
    """Reference month ``mes`` (int yyyyMM) and history length in months."""

    mes: int = 200012
    historia: int = 6
    seed: int = 123

    def __post_init__(self):
        mes = int(self.mes)
        if not (100001 <= mes <= 999912) or not (1 <= mes % 100 <= 12):
            raise ValueError(f"mes must be an int yyyyMM, got {self.mes!r}")
        if int(self.historia) < 1:
            raise ValueError("historia must be >= 1")
        object.__setattr__(self, "mes", mes)
        object.__setattr__(self, "historia", int(self.historia))

    @property
    def start(self) -> int:
        """First month of the inclusive history window [start, mes]."""
        y, m = divmod(self.mes, 100)
        idx = y * 12 + (m - 1) - (self.historia - 1)
        return (idx // 12) * 100 + idx % 12 + 1
