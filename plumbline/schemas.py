"""Column contracts of the tables the operators read and write."""

from __future__ import annotations

from pyspark.sql import types as T


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


LONG, INT, DOUBLE, TEXT, FLAG = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.BooleanType()

# Column names and types of the published tables.
GOLDEN = struct(
    complaint_id=LONG,
    product=TEXT,
    narrative=TEXT,
    proposed_label=INT,
    evidence_quote=TEXT,
    confidence=TEXT,
    evidence_verbatim=FLAG,
    labeler_model=TEXT,
    churn_signal=INT,
    ambiguous=FLAG,
    human_overrode=FLAG,
)
GOLDEN_REQUIRED = ("complaint_id", "product", "narrative", "churn_signal")
TEMPLATE = struct(complaint_id=LONG, product=TEXT, narrative=TEXT, churn_signal=TEXT)
FOLDS = struct(complaint_id=LONG, fold=INT)
TFIDF_PREDICTIONS = struct(complaint_id=LONG, fold=INT, predicted_label=INT)
MODEL_PREDICTIONS = struct(
    complaint_id=LONG,
    product=TEXT,
    fold=INT,
    true_label=INT,
    predicted_label=INT,
    parse_failed=FLAG,
    rationale=TEXT,
    eval_duration_ms=DOUBLE,
)
PROPOSALS = struct(id=LONG, label=INT, evidence=TEXT, confidence=TEXT)
MODEL_CALLS = struct(
    model=TEXT,
    response=TEXT,
    prompt_eval_count=LONG,
    eval_count=LONG,
    load_duration_ns=LONG,
    prompt_eval_duration_ns=LONG,
    eval_duration_ns=LONG,
    total_duration_ns=LONG,
    wall_seconds=DOUBLE,
)
ACCOUNTS = struct(
    customerID=TEXT,
    gender=TEXT,
    SeniorCitizen=TEXT,
    Partner=TEXT,
    Dependents=TEXT,
    tenure=INT,
    PhoneService=TEXT,
    MultipleLines=TEXT,
    InternetService=TEXT,
    OnlineSecurity=TEXT,
    OnlineBackup=TEXT,
    DeviceProtection=TEXT,
    TechSupport=TEXT,
    StreamingTV=TEXT,
    StreamingMovies=TEXT,
    Contract=TEXT,
    PaperlessBilling=TEXT,
    PaymentMethod=TEXT,
    MonthlyCharges=DOUBLE,
    TotalCharges=TEXT,
    Churn=TEXT,
)

# The required keys of an extraction object and its urgency levels.
EXTRACTION_KEYS = ("product", "issue_summary", "urgency", "mentions_legal_action")
URGENCY_LEVELS = ("low", "medium", "high")

# The closed product vocabulary.
PRODUCTS = (
    "Checking or savings account",
    "Credit card",
    "Credit reporting or other personal consumer reports",
    "Debt collection",
    "Debt or credit management",
    "Money transfer, virtual currency, or money service",
    "Mortgage",
    "Payday loan, title loan, personal loan, or advance loan",
    "Prepaid card",
    "Student loan",
    "Vehicle loan or lease",
)
