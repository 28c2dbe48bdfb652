"""Settings of the bank-contact table: its schema, token lists, limits and rates.

Every operator takes the settings it needs as an argument, so another table is
another ``PrepConfig``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

# --- Fixed values ----------------------------------------------------------
# Schema, tokens, level orders, limits and rates that results must agree on.

NUMERIC = ("age", "balance", "day", "duration", "campaign", "pdays", "previous")
CATEGORICAL = ("job", "marital", "education", "contact", "poutcome", "month")
BINARY = ("default", "housing", "loan", "deposit")

NULL_TOKENS = ("", " ", "NA", "N/A")
YES_TOKENS = ("yes", "y", "1", "true")
NO_TOKENS = ("no", "n", "0", "false")
MISSING_CATEGORY = "nan"

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
EDUCATION_LEVELS = ("primary", "secondary", "tertiary")

FLAGS = (
    "flag_balance_negativo",
    "flag_outlier_balance",
    "flag_outlier_campaign",
    "pdays_flag_nuevo_cliente",
    "flag_outlier_pdays",
    "flag_outlier_previous",
)

GREEN, YELLOW, RED = "verde", "amarillo", "rojo"

PHASES = ("ingesta", "limpieza", "transformacion", "validacion", "carga")
RAW_PHASES = (
    "ingesta",
    "limpieza",
    "transformacion",
    "validacion_estructural",
    "validacion_semantica",
    "carga",
)

REPORT_VERSION = "5.0.0"


def _frozen(**items):
    return field(default_factory=lambda: MappingProxyType(dict(items)))


@dataclass(frozen=True)
class PrepConfig:
    """What the columns of a table are and how to clean and encode them."""

    key: tuple[str, ...] = ("contact_id",)
    numeric: tuple[str, ...] = NUMERIC
    categorical: tuple[str, ...] = CATEGORICAL
    binary: tuple[str, ...] = BINARY
    target: str = "deposit"
    leakage: tuple[str, ...] = ("duration",)

    null_tokens: tuple[str, ...] = NULL_TOKENS
    yes_tokens: tuple[str, ...] = YES_TOKENS
    no_tokens: tuple[str, ...] = NO_TOKENS
    missing_category: str = MISSING_CATEGORY

    flags: tuple[str, ...] = FLAGS
    negative_flags: Mapping[str, str] = _frozen(balance="flag_balance_negativo")
    sentinel_flags: Mapping[str, tuple[str, float]] = _frozen(pdays=("pdays_flag_nuevo_cliente", -1.0))
    outlier_flags: Mapping[str, str] = _frozen(
        balance="flag_outlier_balance",
        campaign="flag_outlier_campaign",
        pdays="flag_outlier_pdays",
        previous="flag_outlier_previous",
    )
    outlier_excluded: Mapping[str, tuple[float, ...]] = _frozen(pdays=(-1.0,))
    fence_width: float = 1.5

    robust: tuple[str, ...] = ("balance",)
    standard: tuple[str, ...] = ("age", "pdays", "previous", "campaign")
    one_hot: tuple[str, ...] = ("job", "marital", "contact", "poutcome")
    #: categories of very many levels: their vectors are sparse, their levels stay in a table
    one_hot_sparse: tuple[str, ...] = ()
    ordinal: Mapping[str, tuple[str, ...]] = _frozen(education=EDUCATION_LEVELS)
    cyclic_numbers: Mapping[str, int] = _frozen(day=31)
    cyclic_names: Mapping[str, tuple[str, ...]] = _frozen(month=MONTHS)

    #: both are 1 for a contact with a double debt
    debt_columns: tuple[str, ...] = ("housing", "loan")

    published_names: Mapping[str, str] = _frozen(default="default_flag", deposit="y")

    @property
    def expected(self) -> tuple[str, ...]:
        return self.numeric + self.categorical + self.binary

    @property
    def binary_features(self) -> tuple[str, ...]:
        return tuple(c for c in self.binary if c != self.target)

    @property
    def cyclic(self) -> tuple[str, ...]:
        return tuple(self.cyclic_numbers) + tuple(self.cyclic_names)


@dataclass(frozen=True)
class Thresholds:
    """Limits of the traffic lights."""

    min_success_pct: float = 95.0
    max_total_secs: float = 120.0
    max_phase_secs: Mapping[str, float] = _frozen(
        ingesta=10.0, limpieza=15.0, transformacion=30.0, validacion=20.0, carga=5.0
    )
    green_phase_share: float = 0.6
    green_total_share: float = 0.5
    max_null_pct_clean: float = 1.0
    max_null_pct_features: float = 0.0
    green_outlier_pct: float = 5.0
    max_outlier_pct: float = 15.0
    min_minority_pct: float = 20.0
    yellow_minority_pct: float = 10.0
    min_valid_columns_pct: float = 90.0
    yellow_valid_columns_pct: float = 80.0
    max_cost_usd: float = 0.10
    green_cost_share: float = 0.5
    min_cyclic_identity: float = 0.9999
    green_score: float = 85.0
    yellow_score: float = 60.0

    # points taken off the quality score: (red, yellow)
    null_penalty: tuple[int, int] = (30, 10)
    outlier_penalty: tuple[int, int] = (10, 5)
    balance_penalty: tuple[int, int] = (10, 5)
    columns_penalty: tuple[int, int] = (15, 7)
    types_penalty: int = 25
    alignment_penalty: int = 25

    light_points: Mapping[str, int] = _frozen(verde=100, amarillo=60, rojo=0)
    weights: Mapping[str, float] = _frozen(availability=0.30, performance=0.20, quality=0.40, cost=0.10)

    @property
    def score_without_data(self) -> int:
        """Quality score of tables that do not exist: red for nulls, classes and columns."""
        lost = self.null_penalty[0] + self.balance_penalty[0] + self.columns_penalty[0]
        return max(0, 100 - lost)


@dataclass(frozen=True)
class CostModel:
    """Rates in USD used to attribute the cost of a run."""

    compute_usd_per_hour: float = 0.0950
    storage_usd_per_gb_month: float = 0.020
    io_usd_per_gb: float = 0.010
    overhead_factor: float = 1.15
    rows_per_cent_at_full_score: float = 10_000.0


# --- End of fixed values ---------------------------------------------------
