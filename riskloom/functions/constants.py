"""Labels, band limits and defaults that results must carry unchanged."""

from __future__ import annotations

# Column roles of the client table.
ID = "SK_ID_CURR"
TARGET = "TARGET"
SPLIT = "split"
SCORE = "proba_champion"
RAW_SCORE = "proba_champion_raw"
BASELINE_SCORE = "proba_baseline"

# Cleaning and feature-table settings.
EMPLOYED_SENTINEL = 365243
UNKNOWN_GENDER = "XNA"
INCOME_CAP_QUANTILE = 0.999
DAYS_PER_YEAR = 365.25
DAYS_PER_MONTH = 30
OTHER_CATEGORY = "OUTROS"
MAX_CATEGORIES = 15
KEY_COLUMNS = ("SK_ID_CURR", "SK_ID_BUREAU", "SK_ID_PREV")
NUMERIC_AGGREGATES = ("mean", "sum", "max", "min", "count")

# Ratio name -> (numerator, denominator).
RATIOS = {
    "CREDIT_INCOME_RATIO": ("AMT_CREDIT", "AMT_INCOME_TOTAL"),
    "ANNUITY_INCOME_RATIO": ("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
    "CREDIT_TERM": ("AMT_ANNUITY", "AMT_CREDIT"),
    "EMPLOYED_AGE_RATIO": ("DAYS_EMPLOYED", "DAYS_BIRTH"),
    "REGISTRATION_AGE_RATIO": ("DAYS_REGISTRATION", "DAYS_BIRTH"),
    "ID_PUBLISH_AGE_RATIO": ("DAYS_ID_PUBLISH", "DAYS_BIRTH"),
    "PHONE_CHANGE_AGE_RATIO": ("DAYS_LAST_PHONE_CHANGE", "DAYS_BIRTH"),
    "INCOME_PER_PERSON": ("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
    "CREDIT_GOODS_RATIO": ("AMT_CREDIT", "AMT_GOODS_PRICE"),
}
YEARS_FROM_DAYS = {"AGE_YEARS": "DAYS_BIRTH", "YEARS_EMPLOYED": "DAYS_EMPLOYED"}
EXTERNAL_SCORES = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")
PRESENCE_FLAGS = {
    "HAS_BUREAU": "BUREAU_COUNT",
    "HAS_PREV": "PREV_COUNT",
    "HAS_POS": "POS_COUNT",
    "HAS_CC": "CC_COUNT",
    "HAS_INST": "INST_COUNT",
}
INTERNAL_FLAGS = ("HAS_PREV", "HAS_POS", "HAS_CC", "HAS_INST")

# Fixed values: (exclusive upper limit, label) in ascending order, then the open top label.
UNKNOWN = "desconhecido"
AGE_BANDS = (((25, "<25"), (35, "25-35"), (45, "35-45"), (55, "45-55"), (65, "55-65")), "65+")
INCOME_BANDS = (((100000, "ate 100k"), (150000, "100k-150k"), (225000, "150k-225k")), "225k+")
CREDIT_BANDS = (((250000, "ate 250k"), (500000, "250k-500k"), (1000000, "500k-1M")), "1M+")
SCORE_BANDS = (
    ((0.05, "A (<5%)"), (0.10, "B (5-10%)"), (0.20, "C (10-20%)"), (0.35, "D (20-35%)")),
    "E (35%+)",
)
NO_SCORE = "sem score"
THIN_FILE = "thin-file (sem bureau)"
WITH_HISTORY = "com historico de bureau"
MAX_CHILDREN = 5

# Decision labels and grey-band settings.
APPROVE, REVIEW, DENY = "APROVAR", "REVISAR", "NEGAR"
DEFAULT_BAND = 0.05
LOW_CONFIDENCE_FACTOR = 2.0

# Dimension key -> readable label.
DIMENSION_LABELS = {
    "gender": "Gênero",
    "contract_type": "Tipo de contrato",
    "education": "Escolaridade",
    "family_status": "Estado civil",
    "income_type": "Tipo de renda",
    "housing_type": "Moradia",
    "occupation": "Ocupação",
    "organization": "Organização",
    "split": "Fatia (treino/validação/teste)",
    "target": "Inadimplente (real)",
    "children": "Nº de filhos",
    "age_band": "Faixa etária",
    "income_band": "Faixa de renda",
    "credit_band": "Faixa de crédito",
    "score_band": "Faixa de score",
    "thin_file": "Thin-file",
}
PLAIN_DIMENSIONS = {
    "gender": "CODE_GENDER",
    "contract_type": "NAME_CONTRACT_TYPE",
    "education": "NAME_EDUCATION_TYPE",
    "family_status": "NAME_FAMILY_STATUS",
    "income_type": "NAME_INCOME_TYPE",
    "housing_type": "NAME_HOUSING_TYPE",
    "occupation": "OCCUPATION_TYPE",
    "organization": "ORGANIZATION_TYPE",
    "split": "split",
}

# Client sheet blocks and column selection.
SHEET_BLOCKS = {
    "identificacao": (
        "CODE_GENDER", "AGE_YEARS", "NAME_FAMILY_STATUS", "CNT_CHILDREN", "CNT_FAM_MEMBERS",
        "NAME_EDUCATION_TYPE", "OCCUPATION_TYPE", "ORGANIZATION_TYPE", "NAME_HOUSING_TYPE",
        "YEARS_EMPLOYED",
    ),
    "financeiro": (
        "AMT_INCOME_TOTAL", "NAME_INCOME_TYPE", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE",
        "NAME_CONTRACT_TYPE", "CREDIT_INCOME_RATIO", "ANNUITY_INCOME_RATIO", "CREDIT_TERM",
        "FLAG_OWN_CAR", "FLAG_OWN_REALTY",
    ),
    "historico": ("BUREAU_COUNT", "PREV_COUNT", "POS_COUNT", "CC_COUNT", "INST_COUNT"),
    "scores_externos": EXTERNAL_SCORES,
}
MAX_SELECTED_COLUMNS = 60

# Column prefix -> origin table, longest prefix first.
SOURCE_PREFIXES = (
    ("BUREAU_BB_", "BUREAU_BALANCE"),
    ("BUREAU_", "BUREAU"),
    ("PREV_", "PREV"),
    ("POS_", "POS"),
    ("CC_", "CC"),
    ("INST_", "INST"),
)
DEFAULT_SOURCE = "application"

# Threshold grid, costs and minimum group sizes.
GRID_POINTS, GRID_LOW, GRID_HIGH = 99, 0.01, 0.99
COST_FN, COST_FP = 1.0, 0.1
MIN_GROUP = 30

# Drift limits and verdicts.
PSI_EPS = 1e-6
PSI_STABLE, PSI_WATCH, PSI_SHIFT = "estável", "atenção", "mudança relevante"
PSI_LIMITS = (0.10, 0.25)
NOTE_NO_DATA = "sem dados suficientes"
NOTE_CONSTANT = "variável quase constante na referência"
NOTE_ONE_CLASS = "sem ambas as classes"

# Gates.
LEAK_PATTERNS = ("PROBA", "PREDIC", "SCORE_MODEL", "Y_TRUE", "Y_PRED")
MIN_TABLE_COLUMNS = 400
MIN_TABLE_ROWS = 1000
MAX_AUC_DROP = 0.01
STATUS_BASELINE = "linha_de_base"
STATUS_BETTER = "melhorou"
STATUS_TOLERATED = "piorou dentro do limiar"
STATUS_REGRESSION = "regressao"
ACCEPTED, REJECTED = "aceita", "rejeitada"

# Explanation labels.
RISK_UP, RISK_DOWN = "aumenta risco", "reduz risco"

# Score histogram edges of the monitoring view.
SCORE_EDGES = (0.01, 0.025, 0.05, 0.09, 0.15, 0.25, 0.4, 0.6, 0.8, 1.0)
