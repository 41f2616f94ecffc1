"""Configuration: thresholds, name lists and patterns.

Everything in the "FIXED VALUES" blocks must equal the values the original
pipeline used, otherwise results differ.  They are stated plainly, in their
natural order, and are parameters of the operators (callers may pass others).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: column-name mapping used by normalize_columns.
# Keys are the lower-cased, stripped names with '_' already replaced by ' '
# (so keys written with '_' can never match - kept as given, for parity).
# ---------------------------------------------------------------------------
COLUMN_MAPPING = {
    "ra": "ra",
    "nome": "nome",
    "instituicao_ensino_aluno": "instituicao",
    "instituição de ensino": "instituicao",
    "inde": "inde",
    "ian": "ian",
    "ida": "ida",
    "ieg": "ieg",
    "iaa": "iaa",
    "ips": "ips",
    "ipp": "ipp",
    "ipv": "ipv",
    "ipm": "ipm",
    "fase": "fase",
    "fase_ideal": "fase_ideal",
    "fase ideal": "fase_ideal",
    "defasagem": "defasagem",
    "idade_aluno": "idade",
    "anos_pm": "anos_pm",
    "anos pm": "anos_pm",
    "bolsista": "bolsista",
    "ponto_virada": "ponto_virada",
    "ponto de virada": "ponto_virada",
    "pedra": "pedra",
    "destaque_inde": "destaque_inde",
    "destaque inde": "destaque_inde",
    "destaque_ida": "destaque_ida",
    "destaque ida": "destaque_ida",
    "destaque_ieg": "destaque_ieg",
    "destaque ieg": "destaque_ieg",
    "rec_ava": "rec_ava",
    "rec ava": "rec_ava",
    "rec_inde": "rec_inde",
    "rec inde": "rec_inde",
    "indicador_nutricional": "indicador_nutricional",
    "indicador nutricional": "indicador_nutricional",
    "genero": "genero",
    "gênero": "genero",
    "sexo": "genero",
    "ano_ingresso": "ano_ingresso",
    "ano ingresso": "ano_ingresso",
    # Our addition: the 2022 spelling of the lag column.
    "defas": "defasagem",
}

# FIXED VALUES: feature allow-list (P8) and leakage lists (Q5 / Q6 / Q7).
ALLOWED_FEATURE_COLUMNS = [
    "ra", "nome", "instituicao", "idade", "genero",
    "fase", "anos_pm", "ano_ingresso", "bolsista",
    "inde", "ian", "ida", "ieg", "iaa", "ips", "ipp", "ipv", "ipm",
    "indicador_nutricional",
]
LEAKAGE_COLUMNS = [
    "defasagem", "ponto_virada", "pedra", "destaque_inde", "destaque_ida",
    "destaque_ieg", "rec_ava", "rec_inde",
]
BLOCKED_EXACT = ["ra", "nome", "nome_anonimizado", "target"]
BLOCKED_PREFIXES = ["defasagem", "em_risco", "ponto_virada", "pedra", "fase_ideal",
                    "destaque_", "rec_", "avaliador"]

# FIXED VALUES: inclusive indicator ranges (Q2).
INDICATOR_RANGES = {
    "inde": (0, 10),
    "ian": (0, 10),
    "ida": (0, 10),
    "ieg": (0, 10),
    "iaa": (0, 10),
    "ips": (0, 10),
    "ipp": (0, 10),
    "ipv": (0, 10),
    "ipm": (0, 10),
    "indicador_nutricional": (0, 100),
    "defasagem": (-10, 10),
    "fase": (0, 10),
    "fase_ideal": (0, 10),
}
MAX_MISSING_RATIO = 0.3

# FIXED VALUES: category rules for standardize_category (P6), in order.
# Each rule: (output, any-of substrings, all-of substrings).
CATEGORY_RULES = [
    ("Publica", ["publica"], []),
    ("Privada_Apadrinhamento", ["apadrinhamento"], []),
    ("Privada_Bolsa", ["bolsa", "parceira"], []),
    ("Privada", ["privada"], []),
    ("Concluiu_EM", ["concluiu"], []),
    ("Concluiu_EM", [], ["3", "em"]),
]
CATEGORY_NULL = "Desconhecido"
CATEGORY_OTHER = "Outro"

# FIXED VALUES: personal-data patterns (S1/S2), in application order.
PII_PATTERNS = [
    ("cpf", r"\b\d{3}\.?\d{3}\.?\d{3}-?\d{2}\b"),
    ("email", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"),
    ("phone", r"\b(?:\+55)?\s*\(?\d{2}\)?\s*\d{4,5}-?\d{4}\b"),
    ("cep", r"\b\d{5}-?\d{3}\b"),
    ("rg", r"\b\d{2}\.?\d{3}\.?\d{3}-?\d{1}\b"),
]
REDACTED = "[REDACTED]"

# FIXED VALUES: field names treated as personal data (S3/S7): the union of
# the lists found in the original code.
PII_FIELDS = [
    "nome", "name", "cpf", "email", "telefone", "phone",
    "endereco", "address", "cep", "rg", "documento", "document",
    "senha", "password", "token", "api_key", "secret",
    "ra", "id", "estudante_id", "student_id",
]
SAFE_FIELDS = [
    "turnover", "headcount", "idade", "idade_empresa", "setor",
    "nota_exame", "horas_treinamento", "participou_projeto",
    "numero_avaliacoes", "promocoes_ultimos_3_anos",
    "nivel_senioridade", "nivel_escolaridade", "area_atuacao",
    "percentual_meta_batida", "pedido_demissao",
]

# FIXED VALUES: drift thresholds.
PSI_WARN = 0.1
PSI_ALERT = 0.25
MISSING_DELTA_WARN = 0.05
MISSING_DELTA_ALERT = 0.10
YELLOW_SHARE_ALERT = 0.2
PSI_EPS = 1e-6
PROFILE_QUANTILES = [0.05, 0.25, 0.5, 0.75, 0.95]
SCORE_QUANTILES = [0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95]
SCORE_BINS = 20

# FIXED VALUES: performance-drift alerts (E13) and champion gate.
PERF_MIN_SAMPLES = 50
PERF_RECALL_MIN = 0.70
PERF_PRECISION_MIN = 0.30
PERF_AUC_MIN = 0.75
GATE_MAX_RECALL_DROP = 0.02
GATE_MAX_PRECISION_DROP = 0.05
GATE_MAX_BRIER_RISE = 0.02

# FIXED VALUES: risk bands and value bins (P13, P14), SLO (W3), rate limit.
BAND_LOW = 0.3
BAND_HIGH = 0.7
VALUE_BIN_LOW = 4
VALUE_BIN_HIGH = 7
SLO_P95_MS = 300.0
SLO_ERROR_RATE = 0.01
RATE_LIMIT_PER_MIN = 60
