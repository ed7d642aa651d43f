"""Job parameters. Defaults are fixed values of the metric and cascade definitions."""

from __future__ import annotations

from dataclasses import dataclass

EXPENSE_DEFAULT = "EXP-039"
INCOME_DEFAULT = "INC-007"
DEFAULT_CODES = (EXPENSE_DEFAULT, INCOME_DEFAULT)
REFUND = "EXP-032"
OWN_TRANSFER = "INTERNAL_TRANSFER"
EXTERNAL_TRANSFER = "EXP-013"


@dataclass(frozen=True)
class MetricParams:
    period_days: int = 180
    stable_percent: int = 10
    recent_months: int = 2
    days_per_month: int = 30
    min_dates: int = 3
    # (name, least mean gap, greatest mean gap) in days
    frequencies: tuple = (("weekly", 3, 9), ("fortnightly", 10, 17), ("monthly", 25, 35))
    salary: tuple = ("INC-009",)
    income: tuple = (
        "INC-001", "INC-002", "INC-003", "INC-004", "INC-005", "INC-006", "INC-007",
        "INC-008", "INC-009", "INC-010", "INC-011", "INC-012", "INC-013", "INC-014",
        "INC-015", "INC-016", "INC-018", "INC-019", "INC-020", "INC-021",
    )
    youth: tuple = ("INC-012",)
    rental: tuple = ("INC-013",)
    benefits: tuple = ("INC-001", "INC-011", "INC-014", "INC-016", "INC-018",
                       "INC-019", "INC-020", "INC-021")
    high_risk: tuple = ("EXP-001", "EXP-003", "EXP-014", "EXP-006", "EXP-029")
    atm: tuple = ("EXP-001",)
    small_loans: tuple = ("EXP-033",)
    dishonours: tuple = ("EXP-009",)
    mortgage: tuple = ("EXP-056",)

    @property
    def recent_days(self) -> int:
        return self.recent_months * self.days_per_month

    @property
    def other_income(self) -> tuple:
        """SET4: income codes without salary."""
        return tuple(c for c in self.income if c not in self.salary)


@dataclass(frozen=True)
class CascadeParams:
    high: float = 0.90
    medium: float = 0.80
    rule_threshold: float = 0.90
    model_threshold: float = 0.80
    hybrid_rule_threshold: float = 0.95
    hybrid_model_threshold: float = 0.95
    vague: tuple = ("Third Party Payment Providers", "Uncategorised", "Department Stores",
                    "Financial Services", "Overdrawn")
    # substrings that make a provider category useless as an override
    generic: tuple = ("Uncategorised", "Uncategorized", "Other", "Unknown",
                      "All Other Credits", "All Other Debits")


@dataclass(frozen=True)
class LearningParams:
    min_confidence: float = 0.90
    prune_below: float = 0.85
    max_examples: int = 5
    similar: int = 5
    price_in: float = 0.25
    price_out: float = 1.25
    chars_per_token: int = 4


@dataclass(frozen=True)
class MatchParams:
    cents: int = 1
    days: int = 2
    # least share of common words, as a fraction of integers
    overlap_num: int = 2
    overlap_den: int = 5
    samples: int = 3
