"""Constants whose values must match the reference's behaviour.

They are stated here once, in plain text; modules import them.
"""

# Fixed values ---------------------------------------------------------------

# Characters Python's str.strip() removes (29 code points): U+0009-U+000D,
# U+001C-U+0020, U+0085, U+00A0, U+1680, U+2000-U+200A, U+2028, U+2029,
# U+202F, U+205F, U+3000 -- as a Java regex character class.
PY_SPACE_CLASS = (
    "[\\u0009-\\u000D\\u001C-\\u0020\\u0085\\u00A0\\u1680\\u2000-\\u200A"
    "\\u2028\\u2029\\u202F\\u205F\\u3000]"
)

# Python's Unicode "\W": anything but letters, digits and underscore.
NON_WORD_RE = "[^\\p{L}\\p{N}_]+"

# File-name-safe language: runs outside this class become "_", then these
# characters are stripped at both ends; an empty result uses the fallback.
UNSAFE_NAME_RE = "[^A-Za-z0-9._-]+"
NAME_EDGE_CHARS = "._-"
UNKNOWN_LANGUAGE = "unknown"

# Record ID fallbacks after the configured ID field.
ID_FALLBACK_FIELDS = ("id", "c_id")

# Classifier labels.
AD = "ad"
NON_AD = "non-ad"

# Keyword replies carry their list under this key.
REPLY_KEYWORDS_KEY = "english_keywords"

# Folder conventions of the keyword run.
KEYWORDS_FILE_PREFIX = "keywords_"
SPLIT_SUMMARY_NAME = "languages_summary.json"

# Defaults of the labelling run and the archive lookup report.
DEFAULT_SEED = 42
DEFAULT_TARGET_PER_LANGUAGE = 1000
POOL_FACTOR = 2  # sample pool per language = POOL_FACTOR x target
SHARDS_PER_BATCH = 120
