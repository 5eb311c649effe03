"""Fixed values.

Everything in this module is a FIXED VALUE: the results of the operators
depend on these exact words, labels, patterns and numbers, so they are
stated here plainly, in their natural order, in one place.
"""

# ---------------------------------------------------------------- fixed values
# Token pattern shared by every operator (and valid in Java regex and RE2):
# a word is a maximal run of letters, numbers and underscore.
WORD_CLASS = r"\p{L}\p{N}_"
WORD_RE = r"[\p{L}\p{N}_]+"

# The seven extracted project fields, each with the alternative key names
# searched in a model response, in search order.
PROJECT_FIELDS = [
    ("location", ["Location of project", "Location"]),
    ("what_built", ["What is being built"]),
    ("funder", ["Who is funding the project"]),
    ("amount_text", ["Amount of money being spent"]),
    ("category_text", ["Category of project that is being constructed"]),
    ("expected_completion", ["Expected completion date"]),
    ("additional", ["Additional"]),
]

# Export names of the seven fields (first alternative of each).
FIELD_EXPORT_NAMES = {name: alts[0] for name, alts in PROJECT_FIELDS}

# The six fields that count towards the completeness score.
SCORE_FIELDS = ["location", "what_built", "funder", "amount_text",
                "category_text", "expected_completion"]

# Phrases that count as "not given" in the completeness score
# (compared after trim + lower case).
FILLER_WORDS = [
    "not specified", "na", "nothing", "none", "n/a", "unknown", "nan",
    "not available", "not applicable", "unspecified", "no info provided",
    "not mentioned", "not provided", "Unspecified (information not provided)",
    "not given", "Not specified in the text", "Not mentioned in the text",
    "Information not provided", "Information not available in the text",
    "The article does not specify", "unclear",
]

# Ordered category rules: the first pattern found (case-insensitive,
# anywhere in the text) gives the label.
CATEGORY_RULES = [
    (r"residential.*", "Residential Construction"),
    (r"commercial.*", "Commercial Construction"),
    (r"industr.*", "Industrial Construction"),
    (r"(infrastruct.*|heavy civil).*", "Infrastructure and Heavy Civil Construction"),
    (r"(institutional|assembly).*", "Institutional and Assembly Construction"),
    (r"environmental.*", "Environmental Construction"),
    (r"(agricultural.*|crop.*)", "Agricultural Construction"),
    (r"recreational.*", "Recreational Construction"),
    (r"specialized.*", "Specialized Construction"),
    (r"(renovation|remodeling)", "Renovation and Remodeling"),
    (r"(utilit.*|energ.*|solar|gas|electric.*|water)", "Utility Construction"),
    (r"landscap.*", "Landscape Construction"),
    (r"multi-sectoral|multi.*", "Multi-Sectoral"),
]

# Topic labels that let a document through the gate (exact element match).
GATE_LABELS = ["Project", "Construction", "Reconstruction", "Build"]

# Ambiguous place names, kept only when the context word is near them.
SPECIAL_TERMS = ["Key", "Market"]
CONTEXT_WORD = "Iraq"
PROXIMITY_CHARS = 15

# Longest text sent in one model request, in words.
MAX_REQUEST_WORDS = 12000

# Currency conversion to USD.
USD_RATES = {"IQD": 0.00077, "GBP": 1.25, "EUR": 1.07, "USD": 1.0}
# Rate named only in the money prompt.
PROMPT_ONLY_RATES = {"JD": 1.41}

# Currency mentions recognised in free text, mapped to codes.
CURRENCY_WORDS = [
    ("USD", "USD"), ("U.S. dollars", "USD"), ("Iraqi dinars", "IQD"),
    ("ID", "IQD"), ("GBP", "GBP"), ("EUR", "EUR"), ("€", "EUR"),
    ("dinars", "IQD"),
]

# Number words read as amounts.
NUMBER_WORDS = ["one", "two", "three", "four", "five", "six", "seven",
                "eight", "nine", "ten"]

# Scale words and letters.
UNIT_SCALE = [
    ("thousand", 1e3), ("k", 1e3), ("million", 1e6), ("m", 1e6),
    ("billion", 1e9), ("b", 1e9), ("trillion", 1e12), ("t", 1e12),
]

# Categories offered to the model (the label rules above add Multi-Sectoral).
PROMPT_CATEGORIES = [
    "Residential Construction", "Commercial Construction",
    "Industrial Construction", "Infrastructure and Heavy Civil Construction",
    "Institutional and Assembly Construction", "Environmental Construction",
    "Agricultural Construction", "Recreational Construction",
    "Specialized Construction", "Renovation and Remodeling",
    "Utility Construction", "Landscape Construction",
]

# English stop words dropped from location evidence terms
# (the public NLTK English list).
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd "
    "your yours yourself yourselves he him his himself she she's her hers "
    "herself it it's its itself they them their theirs themselves what which "
    "who whom this that that'll these those am is are was were be been being "
    "have has had having do does did doing a an the and but if or because as "
    "until while of at by for with about against between into through during "
    "before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few "
    "more most other some such no nor not only own same so than too very s t "
    "can will just don don't should should've now d ll m o re ve y ain aren "
    "aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't "
    "haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't "
    "shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn "
    "wouldn't"
).split()

# Export column order of the master table (29) and its identity key (13).
MASTER_EXPORT_COLUMNS = [
    "title", "date", "content", "url", "performed", "summaries",
    "Location of project", "What is being built", "Who is funding the project",
    "Amount of money being spent",
    "Category of project that is being constructed",
    "Expected completion date", "Additional", "Matched Lat", "Matched Lon",
    "Town EN", "Town AR", "Admin 3 EN", "Admin 3 AR", "Admin 2 EN",
    "Admin 2 AR", "Matched ID", "Matched Term", "Matched Location Type",
    "Sort Score", "year", "Matched Category 0", "Matched Category 1", "USD",
]
DEDUPE_KEY_EXPORT = MASTER_EXPORT_COLUMNS[:13]

# Internal (snake_case) names of the same 29 columns, in the same order.
MASTER_COLUMNS = [
    "title", "published", "content", "url", "performed", "summaries",
    "location", "what_built", "funder", "amount_text", "category_text",
    "expected_completion", "additional", "lat", "lon",
    "town_en", "town_ar", "admin3_en", "admin3_ar", "admin2_en", "admin2_ar",
    "loc_id", "matched_term", "loc_type", "sort_score", "year",
    "category_0", "category_1", "usd",
]
DEDUPE_KEY = MASTER_COLUMNS[:13]

# Gazetteer name columns, in the order they are read.
GAZETTEER_NAME_COLUMNS = ["town_en", "town_ar", "admin3_en", "admin3_ar",
                          "admin2_en", "admin2_ar"]

# Fixed news-API queries run for every time window, before the per-term ones
# (8 English, 24 Arabic).
NEWS_FIXED_QUERIES = [
    "Iraq Reconstruction", "Reconstruction efforts in Iraq", "Reconstruction happening in Iraq",
    "Iraq Rebuilding", "Reconstruction plans in Iraq", "Plans for rebuilding in Iraq",
    "Renovations in Iraq", "Iraq reconstruction taking place",
    "مشروع", "مشاريع", "المشروع", "المشاريع", "بمشروع", "بمشاريع", "بالمشروع", "بالمشاريع",
    "لمشروع", "لمشاريع", "للمشروع", "للمشاريع", "اعمار", "الاعمار", "باعمار", "بالاعمار",
    "لاعمار", "للاعمار", "بناء", "البناء", "ببناء", "بالبناء", "لبناء", "للبناء",
]

# Per-term query templates (each listed term gives four queries).
QUERY_TEMPLATES = ["{ctx} NEAR {term}", "{term} NEAR {ctx}", "{ctx} AND {term}", "{term} AND {ctx}"]

# News-API request limits: newest first, at most this many records per request,
# and windows of this many days.
NEWS_MAX_RECORDS = 250
NEWS_WINDOW_DAYS = 2
