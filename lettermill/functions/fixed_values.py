"""Results depend on these exact words, limits and prompts."""

# --- Fixed values: sign-off phrases that end a message body -----------------
SIGN_OFFS = [
    "Met vriendelijke groet",
    "Kind regards",
    "Best regards",
    "Regards",
    "Mvg",
    "Groet",
    "Groeten",
    "Cheers",
    "Thanks",
    "Bedankt",
    "Hartelijke groet",
    "Vriendelijke groet",
]

# --- Fixed values: line rules of the cleaner --------------------------------
DELIMITER_LINES = ["--", "___", "---"]
DELIMITER_PREFIX = "-- "
PHONE_LABELS = ["Tel", "Telefoon", "Phone", "Mobile", "Mob"]
ARTIFACT_BELOW_CHARS = 5
LONG_LINE_CHARS = 500

# --- Fixed values: message filter and language sample ------------------------
MIN_WORDS = 10
LANGUAGE_SAMPLE_CHARS = 500
KEPT_LANGUAGES = ["nl", "en"]
UNKNOWN_LANGUAGE = "unknown"

# --- Fixed values: chat example ----------------------------------------------
SYSTEM_PROMPT = "You are an AI assistant that writes emails in a personal, authentic style."
SUBJECT_PROMPT = "Write an email with subject: "
RECIPIENT_PROMPT = "\nTo: "

# --- Fixed values: style report -----------------------------------------------
STOP_WORDS = [
    "the", "and", "for", "are", "but", "not", "you", "all", "can", "had",
    "her", "was", "one", "our", "out", "day", "get", "has", "him", "his",
    "how", "man", "new", "now", "old", "see", "two", "way", "who", "boy",
    "did", "its", "let", "put", "say", "she", "too", "use", "het", "een",
    "van", "dat", "die", "voor", "met", "niet",
]
DUTCH_INDICATORS = ["graag", "bedankt", "groet", "mvg", "heb", "kunnen", "zou", "jij", "ik"]
ENGLISH_INDICATORS = ["thanks", "please", "regards", "best", "could", "would", "hello"]
CONTRACTIONS = ["don't", "won't", "can't", "wouldn't", "couldn't", "i'm", "i'll", "it's", "that's"]
FORMAL_PHRASES = ["sincerely", "regards", "respectfully", "pleased to", "thank you for your"]
CASUAL_WORDS = ["hey", "yeah", "cool", "awesome", "gonna", "wanna"]
PHRASE_CHARS = 100
PHRASE_DISPLAY_CHARS = 80
SAMPLE_DISPLAY_CHARS = 400
TOP_PHRASES = 10
TOP_WORDS = 20
SAMPLE_POOL = 100
SAMPLE_SIZE = 3

# --- Fixed values: training arithmetic ------------------------------------------
MAX_LENGTH = 2048
BATCH_SIZE = 2
ACCUMULATION = 8
EPOCHS = 3
SECONDS_PER_STEP = 14
TRAIN_RATIO = 0.9
SPLIT_SEED = 42

# --- Fixed values: comparison prompts ---------------------------------------------
COMPARISON_PROMPTS = [
    "Write a brief email reply thanking someone for their message and saying you'll get back to them soon.",
    "Write a short email asking a colleague if they have time for a quick call this week.",
    "Write a reply to someone asking when you can deliver a project, saying it will be ready next week.",
    "Write a quick email apologizing for a late response.",
    "Write an email confirming you received someone's documents and will review them.",
]

# --- Fixed values: white space as the reference semantics define it ------------------
# Unicode White_Space plus the four ASCII separators; no regex flag needed, and
# the same set works in Java and RE2 patterns.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
