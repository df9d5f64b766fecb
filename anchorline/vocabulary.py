"""Fixed values the published results depend on, stated in one place.

Everything here is data: codes, key prefixes, phrase lists and text patterns. The
operators take these as defaults, and every caller may pass its own.
"""

from __future__ import annotations

from datetime import date

# --- fixed values: scope and windows -----------------------------------------
AGENCY_ID = 862
AGENCY_NAMES = ("national aeronautics and space administration", "nasa")
WINDOW_START = date(2025, 1, 20)
HISTORY_START = date(2007, 10, 1)
FIRST_FISCAL_YEAR = 2010
LOOKBACK_DAYS = 120
REFRESH_DAYS = 14
MIN_PULLBACK_DAYS = 90

# --- fixed values: identity and codes ----------------------------------------
FALLBACK_KEY_PREFIX = "PIID:"
IDV_TYPE_PREFIX = "IDV_"
IDV_ID_PREFIX = "CONT_IDV_"
TERMINATION_CODES = ("F", "N")
STANDALONE_CODES = ("F",)
CODED_AWARD_TYPES = ("contract", "idv")
COMPOSITE_ID_PATTERN = r"^(?:ASST_NON|ASST_AGG|CONT_AWD|CONT_IDV)_(.+?)_\d+(?:_|$)"

# --- fixed values: sources and human rulings ---------------------------------
RECENCY_SOURCE = "api"
DEPTH_SOURCE = "mirror"
EXCLUDING_STATUSES = ("excluded_by_design", "vacated", "continued")
DESCOPED_STATUS = "descoped"
OVERRIDE_ID_COLUMN = "Award ID"
OVERRIDE_STATUS_COLUMN = "Tracking Status"

# --- fixed values: text patterns (case-insensitive, Unicode-aware) -----------
TERMINATION_PATTERN = (
    r"terminat(?:e|ed|ion)[\s-]*for[\s-]*con[vn]\w*|\bt4c\b|stop[\s-]?work|"
    r"termination\s+settlement|notice\s+of\s+termination|"
    r"terminat(?:ion|ed)\s+notice|legal\s+contract\s+cancellation"
)
CAUSE_PATTERN = r"terminat\w*\s+for\s+(?:cause|default)"
DESCOPE_PATTERN = r"\bde[\s-]?scop\w*|partial\s+termination|reduce\s+scope"
VACATUR_PATTERN = r"\bvacat\w*"
SET_ASIDE_PATTERN = r"\bset\s+aside\b"
REVERSAL_PATTERN = (
    r"rescind\w*|rescission|reinstat\w*|resum\w+\s+of\s+work|"
    r"cancell?\w*\s+of\s+(?:\w+\s+){0,2}(?:stop[\s-]?work|terminat\w*|suspension)"
)
SUBJECT_PATTERN = r"stop[\s-]?work|terminat\w*|suspension"

# --- fixed values: substrings without which a pattern cannot match ------------
# Each is free of the letters i, s and k: those have Unicode case variants that the
# patterns accept and lower-casing leaves alone.
TERMINATION_STEMS = ("term", "t4c", "top", "legal")
CAUSE_STEMS = ("term",)
DESCOPE_STEMS = ("cop", "term")
VACATUR_STEMS = ("vacat",)
SUBJECT_STEMS = ("term", "top", "pen")
# The same more closely, where a pattern is about to run: a piece, or several that all must
# be there.
TERMINATION_PIECES = (
    ("term", "con"), ("term", "ettlement"), ("term", "not"), "t4c", ("top", "wor"), "legal",
)
CAUSE_PIECES = (("term", "cau"), ("term", "default"))
DESCOPE_PIECES = ("cop", ("term", "part"))
SUBJECT_PIECES = ("term", ("top", "wor"), "pen")
REVERSAL_PIECES = ("re", "cancel")
SET_ASIDE_PIECES = (("et", "de"),)

# --- fixed values: phrases of the keyword sweep -------------------------------
SWEEP_PHRASES = (
    "terminate for convenience",
    "terminate-for-convenience",
    "termination for convenience",
    "stop work",
    "terminate for convience",
    "termination for connivence",
    "termination for convicne",
    "terminate forconvenience",
    "t4c",
    "termination settlement",
    "notice of termination",
    "termination notice",
    "legal contract cancellation",
)

# --- fixed values: award category of a type code or type description ---------
# Public award type codes and their published names. Categories that carry no
# action code and no termination prose (loans, insurance, ...) are left out, so
# they read as "unknown".
AWARD_CATEGORIES = {
    "contract": (
        "contract", "a", "b", "c", "d",
        "bpa call", "purchase order", "delivery order", "definitive contract",
    ),
    "idv": (
        "idv", "idv_a", "idv_b", "idv_b_a", "idv_b_b", "idv_b_c", "idv_c", "idv_d", "idv_e",
        "gwac government wide acquisition contract", "idc indefinite delivery contract",
        "fss federal supply schedule", "boa basic ordering agreement",
        "bpa blanket purchase agreement",
    ),
    "grant": (
        "grant", "02", "03", "04", "05",
        "block grant", "formula grant", "project grant", "cooperative agreement",
    ),
}

# --- fixed values: the whitespace that "trim" and "collapse" act on -----------
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
