"""Small dictionaries and parameters that queries and SQL share."""

ENGLISH = {"that": "rằng", "with": "cùng với", "for": "cho", "of": "của nó", "les": "và", "é": "và"}
SLANG = {"un": "một", "cho": "cho phép", "nó": "ấy", "é": "ế", "in": "ở trong", "zu": "tới"}
WRONG = ["eux", "ing", "ấy"]
STOP = ["the", "and", "la", "der", "với", "trong", "và", "a_lô"]

POLARITY = {
    "the": 1, "est": 1, "une": 1, "with": 1, "sch": 2, "los": 1,
    "and": -1, "la": -1, "un": -2, "und": -1, "en": -1, "of": -1,
}

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

RETRIEVAL_THRESHOLD = 0.1
STRICT_THRESHOLD = 0.35
