"""Fixed values of the reference behaviour: contract, feature lists, limits and search spaces."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

RAW_SCHEMA = T.StructType(
    [
        T.StructField("PassengerId", T.IntegerType()),
        T.StructField("Pclass", T.IntegerType()),
        T.StructField("Name", T.StringType()),
        T.StructField("Sex", T.StringType()),
        T.StructField("Age", T.DoubleType()),
        T.StructField("SibSp", T.IntegerType()),
        T.StructField("Parch", T.IntegerType()),
        T.StructField("Ticket", T.StringType()),
        T.StructField("Fare", T.DoubleType()),
        T.StructField("Cabin", T.StringType()),
        T.StructField("Embarked", T.StringType()),
    ]
)
LABELLED_SCHEMA = T.StructType([RAW_SCHEMA[0], T.StructField("Survived", T.IntegerType()), *RAW_SCHEMA.fields[1:]])


@dataclass(frozen=True)
class FieldRule:
    """What one input field must look like. `default` fills an absent column, `null_default` a NULL."""

    name: str
    required: bool = False
    low: float | None = None
    high: float | None = None
    min_length: int | None = None
    max_length: int | None = None
    allowed: tuple = ()
    case: str | None = None
    default: object = None
    null_default: object = None


# The input contract.
PASSENGER_RULES = (
    FieldRule("PassengerId", default=1),
    FieldRule("Pclass", required=True, low=1, high=3, allowed=(1, 2, 3)),
    FieldRule("Name", required=True, min_length=2, max_length=200),
    FieldRule("Sex", required=True, allowed=("male", "female"), case="lower"),
    FieldRule("Age", low=0.0, high=120.0),
    FieldRule("SibSp", required=True, low=0, high=20, default=0),
    FieldRule("Parch", required=True, low=0, high=20, default=0),
    FieldRule("Ticket", default="PC 17599"),
    FieldRule("Fare", low=0.0, high=1000.0),
    FieldRule("Cabin", max_length=50),
    FieldRule("Embarked", allowed=("S", "C", "Q"), case="upper", default="S", null_default="S"),
)

# Title groups, bins and names.
TITLE_GROUPS = {
    "Mr": "Mr",
    "Miss": "Miss",
    "Mrs": "Mrs",
    "Master": "Master",
    "Mlle": "Miss",
    "Ms": "Miss",
    "Mme": "Mrs",
    "Dr": "Rare_Prof",
    "Prof": "Rare_Prof",
    "Rev": "Rare_Clergy",
    "Col": "Rare_Military",
    "Major": "Rare_Military",
    "Capt": "Rare_Military",
}
TITLE_DEFAULT = "Rare"
AGE_EDGES = (0, 12, 18, 35, 60, 100)
AGE_LABELS = ("Child", "Teen", "Adult", "Middle", "Senior")
FAMILY_EDGES = (0, 1, 4, 20)
FAMILY_LABELS = ("Solo", "Small", "Large")
FARE_LABELS = ("Q1", "Q2", "Q3", "Q4")
PORT_NAMES = {"C": "Cherbourg", "Q": "Queenstown", "S": "Southampton"}
NEIGHBOUR_INPUTS = ("Age", "Pclass", "SibSp", "Parch", "FamilySize", "Fare")
ENCODED_INPUTS = ("TicketPrefix", "CabinDeck", "Title", "Embarked")
ONE_HOT_INPUTS = ("Sex", "Embarked", "Title", "CabinDeck", "Pclass", "AgeBin", "FareBin", "FamilyBin")
NUMERIC_OUTPUTS = (
    "Age",
    "Fare",
    "FamilySize",
    "IsAlone",
    "HasCabin",
    "FarePerPerson",
    "TicketFrequency",
    "Pclass_Sex_Interaction",
    "TicketPrefix_TE",
    "CabinDeck_TE",
    "Title_TE",
    "Embarked_TE",
)


@dataclass(frozen=True)
class DriftLimits:
    """Sample sizes, bins and verdict limits of the drift report."""

    alpha: float = 0.05
    psi_bins: int = 10
    psi_min_bins: int = 3
    psi_rows_per_bin: int = 25
    psi_min_rows: int = 10
    psi_epsilon: float = 1e-4
    psi_cap: float = 10.0
    min_rows: int = 5
    psi_visible: float = 0.05
    psi_high: float = 0.25
    p_marginal: float = 0.10
    tvd_visible: float = 0.10
    tvd_high: float = 0.20
    chi2_min_rows: int = 10
    share: float = 0.33
    prediction_psi_moderate: float = 0.10
    prediction_psi_critical: float = 0.25
    prediction_min_baseline: int = 10
    prediction_min_current: int = 5


# Serving, promotion and gate limits.
RISK_HIGH = 0.70
RISK_MODERATE = 0.40
BUFFER_ROWS = 2000
PROMOTION_AUC = 0.880
DEFAULT_PRIOR = 0.3838
ENCODER_M = 10.0
ENCODER_FOLDS = 5
GATE_LIMITS = (
    ("roc_auc", ">=", 0.880),
    ("accuracy", ">=", 0.830),
    ("f1_macro", ">=", 0.820),
    ("p95_latency_ms", "<=", 250.0),
    ("mean_latency_ms", "<=", 200.0),
)
VOTING_WEIGHTS = (1.5, 1.4, 1.3, 1.1, 1.1)


@dataclass(frozen=True)
class Space:
    """One hyper-parameter: a range (log or with a step) or a choice."""

    name: str
    low: float = 0.0
    high: float = 0.0
    step: int | None = None
    log: bool = False
    integer: bool = False
    choices: tuple = field(default=())


# Search spaces per model family.
SEARCH_SPACES = {
    "GBM": (
        Space("n_estimators", 100, 500, step=50, integer=True),
        Space("max_depth", 2, 6, integer=True),
        Space("learning_rate", 0.01, 0.15, log=True),
        Space("subsample", 0.6, 1.0),
        Space("min_samples_leaf", 1, 30, integer=True),
        Space("max_features", choices=("sqrt", "log2", "all")),
    ),
    "LGBM": (
        Space("num_leaves", 15, 127, integer=True),
        Space("n_estimators", 100, 600, step=50, integer=True),
        Space("learning_rate", 0.01, 0.15, log=True),
        Space("min_child_samples", 5, 50, integer=True),
        Space("subsample", 0.6, 1.0),
        Space("colsample_bytree", 0.6, 1.0),
    ),
    "XGB": (
        Space("n_estimators", 100, 400, step=50, integer=True),
        Space("max_depth", 3, 8, integer=True),
        Space("learning_rate", 0.01, 0.20, log=True),
        Space("subsample", 0.6, 1.0),
        Space("colsample_bytree", 0.6, 1.0),
        Space("min_child_weight", 1, 8, integer=True),
        Space("gamma", 0.0, 1.0),
    ),
}
