"""They decide results and must stay as they are."""

# --- Fixed values -----------------------------------------------------------------

MONTH_NAMES = [
    "Januar", "Februar", "März", "Mrz", "April", "Mai", "Juni", "Juli", "August",
    "September", "Oktober", "November", "Dezember",
    "Jan", "Feb", "Mär", "Apr", "Jun", "Jul", "Aug", "Sep", "Okt", "Nov", "Dez",
]
BIRTH_LABELS = ["Geburtsdatum", "geburtsdatum", "geboren", "geb\\."]
BIRTH_REACH = 40
DATE_PLACEHOLDER = "[DATE_REDACTED]"
NAME_PLACEHOLDER = "[NAME_REDACTED]"
PERSON_LABELS = ["PER", "PERSON", "NAME"]
SENTENCE_ENDS = ".!?…;"
HEX_BLANKS = [" ", "\n", "\t"]
RTF_MARK = "\\rtf"
RTF_MARK_WITHIN = 50
ANONYMISE_CHUNK_CHARS = 400
LOCAL_CHUNK_CHARS = 400
HOSTED_CHUNK_CHARS = 5000
EMBED_BATCH = 64
TRANSLATE_BATCH = 32
TAG_BATCH = 64
CLUSTERS = 10
REPRESENTATIVES = 10
TOPIC_TERMS = 10
VOCABULARY_SIZE = 5000
RANDOM_STATE = 42
DISCOVERY_HIT_CAP = 50
DISCOVERY_HIT_SHARE = 100
PREVIEW_ROWS = 10
PREVIEW_ENCODED_CHARS = 100
PREVIEW_PLAIN_CHARS = 200

# White space and word characters as Python's ``str`` and ``re`` define them.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE_CLASS = (
    r"[\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
NON_SPACE_CLASS = SPACE_CLASS.replace("[", "[^", 1)
WORD_CLASS = r"[\p{L}\p{N}_]"

# Latin-1 has control characters where Windows code page 1252 has these, 0x80 to 0x9F;
# the five unassigned positions keep their control character.
CP1252_UPPER = (
    "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f"
    "\x90‘’“”•–—˜™š›œ\x9džŸ"
)

# RTF control words that stand for characters.
RTF_CHARACTERS = {
    "par": "\n",
    "sect": "\n\n",
    "page": "\n\n",
    "line": "\n",
    "tab": "\t",
    "emdash": "—",
    "endash": "–",
    "emspace": "\u2003",
    "enspace": "\u2002",
    "qmspace": "\u2005",
    "bullet": "•",
    "lquote": "‘",
    "rquote": "’",
    "ldblquote": "“",
    "rdblquote": "”",
    "row": "\n",
    "cell": "|",
    "nestcell": "|",
}
# ----------------------------------------------------------------------------------
