"""Constants that must equal the reference's for equal results.

Kept together here, in the order the work uses them; every module imports
them from this file.
"""

# ICU unit names carry their type in the first parenthesised part.
UNIT_TYPE_PATTERN = r"\((.*?)\)"

# Age bands: right-closed bins (0,18], (18,40], (40,65], (65,999].
AGE_EDGES = (0, 18, 40, 65, 999)
AGE_LABELS = ("child", "adult", "senior", "elderly")

# Fuzzy name matching accepts a best match scoring at least 80 (token-set ratio).
MATCH_THRESHOLD = 80.0

# A missing medicine cost is the mean cost of the 3 nearest rows by package size.
IMPUTE_NEIGHBOURS = 3

# Medicine costs are capped at 400; values at the cap are redrawn uniformly in [100, 400).
COST_CAP = 400.0
REDRAW_LOW = 100.0
REDRAW_HIGH = 400.0

# Package sizes are read from medicine names that mention tablets.
TABLET_WORD = "tab"

# Default lab price per category when the matched price is missing or zero.
DEFAULT_LAB_PRICES = (("blood gas", 8.0), ("chemistry", 75.0), ("hematology", 100.0))

# Code used when a prescription carries no usable code.
DEFAULT_CODE = "00000"

# The interactive company queries return 20 groups and 5 claims per group.
GROUP_LIMIT = 20
TOP_CLAIMS = 5
