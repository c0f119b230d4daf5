"""Fixed values of the news data model.

Everything here must stay as it is for results to be right: word lists,
thresholds, theme vocabulary, source configuration and retention settings.
"""

# Configured sources (name, country, rss_url).
SOURCES = [
    ("BBC News", "International", "https://feeds.bbci.co.uk/news/world/rss.xml"),
    ("Reuters World", "International",
     "https://www.reutersagency.com/feed/?best-topics=world&post_type=best"),
    ("Hespress", "Maroc", "https://fr.hespress.com/feed"),
    ("France24", "France", "https://www.france24.com/fr/rss"),
]
UNKNOWN = "Unknown"
ALL_SOURCES = "Toutes"

# Theme vocabulary, in order of priority.
THEMES = {
    "politique": ["election", "government", "president", "parliament", "minister", "politique"],
    "economie": ["market", "economy", "inflation", "business", "finance", "economie"],
    "sport": ["football", "match", "team", "league", "sport"],
    "technologie": ["ai", "technology", "digital", "software", "internet", "tech"],
}
OTHER_THEME = "autre"

# Keyword stopwords (lake), and the words the warehouse adds.
STOPWORDS = [
    "the", "and", "for", "with", "this", "that", "from", "have", "will", "into", "about", "dans",
    "avec", "pour", "sur", "plus", "sont", "une", "des", "les", "est", "que", "qui", "par", "pas",
]
WAREHOUSE_STOPWORDS = STOPWORDS + ["au", "du", "de", "la", "le", "et", "en"]
KEYWORD_PATTERN = "[a-z]{4,}"
LAKE_TOP_KEYWORDS = 25
WAREHOUSE_TOP_KEYWORDS = 100

# Indicator substrings of the language vote.
FRENCH_INDICATORS = ["le", "la", "de", "un", "une", "et", "est"]
ENGLISH_INDICATORS = ["the", "a", "is", "and", "to", "of"]

# Titles that are page furniture.
TITLE_BLACKLIST = [
    "register", "sign in", "signin", "home", "news", "sport", "live", "watch", "listen",
]
MIN_TITLE_CHARS = 8
MIN_PARAGRAPH_CHARS = 30
MAX_PARAGRAPHS = 30
ARTICLE_ID_CHARS = 24

# Quarantine rules.
GENERIC_TITLE_WORDS = [
    "register", "sign in", "signin", "sign up", "login", "home page", "read more",
]
REUTERS_SECTIONS = [
    "/world/", "/business/", "/markets/", "/technology/", "/legal/", "/sports/",
    "/breakingviews/", "/video/", "/pictures/", "/live/",
]
REASON_TEXT_CHARS = 200
SUSPICIOUS_TITLE_CHARS = 15

# Retention, windows and limits.
QUARANTINE_RETENTION_DAYS = 7
RECENT_PER_SOURCE = 10
LIMIT_PER_SOURCE_LAKE = 25
LIMIT_PER_SOURCE_WAREHOUSE = 20
UNBOUNDED_WINDOW_DAYS = 30
MIN_CONTENT_CHARS = 200
INGEST_INTERVAL_SECONDS = 300

# Messages that one run of the consumer takes.
MAX_MESSAGES = 200
