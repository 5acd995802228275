"""Parameters of the buying rules.

Every rule parameter lives here with the behaviour-defining default; operators take
them as keyword arguments so a caller can override any of them per run.
"""

# --- fixed values: reorder / transfer rules --------------------------------------------
TARGET_WEEKS = 4          # reorder below this many weeks of supply, top back up to it
DONOR_KEEP_WEEKS = 4      # a donor store keeps this many weeks before giving stock away
MIN_TRANSFER = 4          # smallest move worth suggesting, in units
WEEKLY_BUDGET = None      # cap on the net buy in dollars; None = no cap
PRIORITY = "stockout"     # stockout | margin | deals | balanced
REVIEW_BUY_USD = 4000     # one buy at or above this is flagged for review
WEEKS_PER_MONTH = 4.345   # buy-month stock-up converts months to weeks with this
MAX_STOCKUP_WEEKS = 52.0  # cap of the buy-month stock-up horizon
DEFAULT_AD_TARGET = 4.5   # ad target shown when the ad list has none

# --- fixed values: daily brief ----------------------------------------------------------
BRIEF_TARGET_WEEKS = 3    # per-store weeks-of-supply target in the brief
ABOVE_FLAG = 10           # price at least this % above the benchmark -> flag
BELOW_FLAG = 15           # price at least this % below the benchmark -> flag
CATEGORY_FACTOR_CLAMP = (0.8, 1.5)
ITEM_FACTOR_CLAMP = (0.7, 1.8)
BLEND_30 = 0.6            # blended weekly velocity = 0.6 * 30-day + 0.4 * 90-day
BLEND_90 = 0.4

# --- fixed values: history analysis -----------------------------------------------------
MIN_DAYS_IN_MONTH = 25    # a calendar month counts when it has this many days of data
PEAK_THRESHOLD = 1.15     # a month index at or above this is a seasonal peak
MIN_ITEM_UNITS = 200      # item-level seasonality needs this many units
MIN_ITEM_MONTHS = 6       # ... and this many distinct calendar months
EVENT_WINDOW_DAYS = 21    # event lift baseline: median of +-21 days, event day excluded
MONTH_ABBR = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
              "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# --- fixed values: deal evaluation ------------------------------------------------------
DEAL_COVER_WEEKS = 8      # a deal buy covers this many weeks
DEAL_MAX_SAVING = 0.80    # savings above 80 % are treated as data errors
DEAL_MIN_SAVING = 0.01    # savings must exceed one cent per unit
DEAL_MARGINAL_PCT = 3.0   # below 3 % the deal is marginal
DEAL_CAUTION_WEEKS = 16   # stock above this many weeks -> caution

# --- fixed values: ad order ---------------------------------------------------------------
# weeks-of-supply target per department (lower-cased) and ad kind; unknown -> DEFAULT
AD_TARGETS = {
    "thc": {"weekly": 4.5, "sunday": 8.0},
    "spirits": {"weekly": 4.5, "sunday": 8.0},
    "wine": {"weekly": 4.5, "sunday": 4.5},
    "beer": {"weekly": 4.5, "sunday": 4.5},
}
AD_TARGETS_DEFAULT = {"weekly": 4.5, "sunday": 4.5}
AD_MATCH_MIN_SCORE = 0.6  # fuzzy name match keeps scores at or above this
BRAND_REVIEW_COUNT = 40   # a whole-brand ad line with more items than this is flagged for review
# whole-token varietal initialisms expanded before fuzzy matching
ABBREVIATIONS = {
    "sb": "sauvignon blanc",
    "cs": "cabernet sauvignon",
    "pn": "pinot noir",
    "pg": "pinot grigio",
    "pgr": "pinot gris",
    "gsm": "grenache syrah mourvedre",
    "cdp": "chateauneuf du pape",
}
# whole-brand wording in an ad line
BRAND_SIGNAL = r"(?i)\ball\b|\(all|all types|all varietals|all flavors|all varieties"

# --- fixed values: sheet compare ----------------------------------------------------------
LOW_WOS = 2               # fewer weeks than this = low stock
OVERSTOCK_WOS = 12        # more weeks than this = overstock

# --- fixed values: top sellers ------------------------------------------------------------
TOP_SELLER_QUANTILE = 0.70
LOW_MARGIN_PCT = 45

# --- fixed values: explore / facets -------------------------------------------------------
FACET_MIN_VALUES = 2
FACET_MAX_VALUES = 50
NUMERIC_SORT_SHARE = 0.6  # sort a column numerically when 60 % of values parse

# --- fixed values: keyword retrieval -------------------------------------------------------
STOP_WORDS = [
    "what", "does", "need", "needs", "this", "week", "that", "have", "much", "how", "the",
    "for", "and", "buy", "store", "item", "items", "should", "which", "with", "sell",
    "sells", "selling", "price", "cost", "costs", "margin", "margins", "stock", "many",
    "are", "our", "you", "can", "get", "right", "now", "most", "top", "best", "worst",
    "low", "high", "out", "from", "into", "per", "about", "tell", "give", "list", "show",
    "club", "customer", "one", "case", "cases", "unit", "units", "each", "make", "retail",
]
FOCUS_LOW_WOS = 2
FOCUS_TOP_N = 15

# --- fixed values: open purchase orders ---------------------------------------------------
OPEN_PO_DAYS = 21
VENDOR_PO_DAYS = 4

# Fixed values. Department groups: label -> exact lower-cased department values. The default is the
# retail chain's own grouping; the driver fixture maps its part types onto it.
DEPARTMENTS = {
    "THC": ["thc"],
    "Beer": ["beer"],
    "Wine": ["wine"],
    "Spirits": ["spirits"],
    "Other": ["miscellaneous", "tobacco"],
}
FIXTURE_DEPARTMENTS = {
    "THC": ["small"],
    "Beer": ["large"],
    "Wine": ["medium"],
    "Spirits": ["standard"],
    "Other": ["promo", "economy"],
}

# Locations that are not stores (never donors, never stockouts).
NON_RETAIL_LOCATIONS = ["NATION_24"]

# Move priority classes and their sort rank.
MOVE_PRIORITY = {"STOCKOUT": 0, "Low <2wk": 1, "Top-up": 2}

# Brand names whose first word alone is ambiguous (brand = first two words).
TWO_WORD_BRANDS = ["uncle", "minny", "hop", "sweet", "earl", "bent", "green", "old"]

# Named competitors in the price comparison, in report order.
COMPETITORS = ["comp_a", "comp_b"]
