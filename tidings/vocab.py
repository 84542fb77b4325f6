"""Fixed values the engine must agree on with its inputs and consumers.

Everything here is data, not logic: identifiers, word lists, patterns and
feed addresses.  All tables are small and of fixed size, so they may be
broadcast freely.
"""

# --- fixed values: article ingestion ---------------------------------------
DOC_ID_PREFIX = "newsapi_ai_"
UNKNOWN_SOURCE = "Unknown"
SOURCE_TYPE = "news_article"
DESCRIPTION_CHARS = 500
UNCONFIGURED_URI_PREFIX = "YOUR_"
DEFAULT_MAX_ARTICLES = 100

# --- fixed values: graph vocabulary ----------------------------------------
NODE_TYPES = (
    "Company", "Person", "Technology", "Product", "Organization", "Location",
    "Event", "Contract", "Agency", "Program", "System",
)
RELATION_TYPES = (
    "PARTNERS_WITH", "COMPETES_WITH", "EMPLOYS", "DEVELOPS", "USES",
    "FUNDED_BY", "ACQUIRED", "LOCATED_IN", "PARTICIPATES_IN", "AWARDS",
    "SUPPLIES", "INTEGRATES_WITH",
)
NODE_PROPERTIES = ("description", "type", "industry", "sector")
RELATION_PROPERTIES = ("since", "value", "description", "status")

# --- fixed values: sub-graph per team --------------------------------------
TEAM_RELATIONS = {
    "technology": ("DEVELOPS", "USES", "INTEGRATES_WITH", "SUPPLIES"),
    "market": ("PARTNERS_WITH", "COMPETES_WITH", "ACQUIRED", "FUNDED_BY",
               "AWARDS", "LOCATED_IN"),
    "full": RELATION_TYPES,
}

# --- fixed values: pronouns replaced by coreference ------------------------
PRONOUNS = ("he", "she", "it", "they", "them", "his", "her", "its", "their")

# --- fixed values: rule-based relation patterns -----------------------------
# Two patterns per type; only patterns with two or more groups emit a relation
# (group 1 is the source, group 2 the target).
RELATION_PATTERNS = (
    ("AWARDED_CONTRACT", r"(\w+(?:\s+\w+)*)\s+(?:awarded|receives?|wins?)\s+(?:a\s+)?(?:\$[\d,]+\s+)?contract"),
    ("AWARDED_CONTRACT", r"(\w+(?:\s+\w+)*)\s+(?:has been|was)\s+awarded\s+(?:a\s+)?(?:\$[\d,]+\s+)?contract"),
    ("FUNDING_RELATIONSHIP", r"(DARPA|SBIR|DoD|Navy|Air Force|Army)\s+(?:funds|funding|awarded)\s+(?:\$[\d,]+\s+(?:to\s+)?)?(\w+(?:\s+\w+)*)"),
    ("FUNDING_RELATIONSHIP", r"(\$[\d,]+\s+(?:million|billion))\s+(?:from\s+)?(DARPA|SBIR|DoD|Navy|Air Force|Army)\s+(?:to\s+)?(\w+(?:\s+\w+)*)"),
    ("PARTNERSHIP", r"(\w+(?:\s+\w+)*)\s+(?:partners?\s+with|collaborates?\s+with|teams?\s+up\s+with)\s+(\w+(?:\s+\w+)*)"),
    ("PARTNERSHIP", r"(\w+(?:\s+\w+)*)\s+(?:and|&)\s+(\w+(?:\s+\w+)*)\s+(?:partner|collaborate|team\s+up)"),
    ("ACQUISITION", r"(\w+(?:\s+\w+)*)\s+(?:acquires?|purchases?|buys?)\s+(\w+(?:\s+\w+)*)"),
    ("ACQUISITION", r"(\w+(?:\s+\w+)*)\s+(?:acquired|purchased|bought)\s+(?:by\s+)?(\w+(?:\s+\w+)*)"),
    ("TECHNOLOGY_DEVELOPMENT", r"(\w+(?:\s+\w+)*)\s+(?:develops?|developing|creates?|creating|builds?|building)\s+([\w\s]+(?:system|technology|platform|solution))"),
    ("TECHNOLOGY_DEVELOPMENT", r"(\w+(?:\s+\w+)*)\s+(?:specializes?\s+in|focuses?\s+on)\s+([\w\s]+(?:system|technology|platform|solution))"),
)
RULE_CONFIDENCE = 0.8
ENTITY_CONFIDENCE_MIN = 0.7    # strict: kept when greater
RELATION_CONFIDENCE_MIN = 0.5  # strict: kept when greater

# --- fixed values: content routing ------------------------------------------
ROUTE_TERMS = ("DARPA", "SBIR", "defense contractor", "military",
               "naval systems", "space systems")

# --- fixed values: source name standardisation ------------------------------
SOURCE_LADDER = (
    ("%reuters%", "Reuters"),
    ("%associated press%", "Associated Press"),
    ("%wall street journal%", "Wall Street Journal"),
    ("%defense%news%", "Defense News"),
)
WIRE_SOURCES = ("Reuters", "Associated Press", "Wall Street Journal")

# --- fixed values: relevance score -------------------------------------------
RELEVANCE_WEIGHTS = (
    ("companies", 0.2), ("agencies", 0.3), ("technologies", 0.1),
    ("funding_mentions", 0.4), ("contract_mentions", 0.3),
)
WIRE_MULTIPLIER = 1.2
RELEVANCE_CAP = 10.0
PRIORITY_BANDS = ((5.0, "High Priority"), (2.0, "Medium Priority"), (0.5, "Low Priority"))
PRIORITY_DEFAULT = "Background"
TECHNOLOGY_FLAGS = (
    ("has_ai_tech", ("%ai%", "%artificial intelligence%", "%machine learning%")),
    ("has_cyber_tech", ("%cyber%", "%security%")),
    ("has_space_tech", ("%space%", "%satellite%", "%orbital%")),
    ("has_autonomous_tech", ("%autonomous%", "%unmanned%", "%drone%")),
)

# --- fixed values: keyword lists ----------------------------------------------
SECTOR_KEYWORDS = {
    "defense": (
        "DARPA contract", "SBIR award", "defense contractor", "naval systems",
        "space systems", "unmanned platforms", "Lockheed Martin", "Boeing",
        "Raytheon", "General Dynamics", "autonomous systems",
        "cybersecurity defense",
    ),
    "healthcare": (
        "surgical robotics", "medical devices FDA", "diagnostic systems",
        "wearable health technology", "medical AI", "robotic surgery",
    ),
    "manufacturing": (
        "Industry 4.0", "smart manufacturing", "predictive maintenance",
        "digital twin", "factory automation", "IoT manufacturing",
    ),
    "tier_1": (
        "DARPA contract award", "SBIR Phase II", "defense contractor",
        "naval systems", "unmanned platforms", "autonomous systems",
        "surgical robotics", "medical devices", "predictive maintenance",
        "Lockheed Martin", "Boeing defense", "Raytheon contract",
    ),
    "tier_2": (
        "space systems", "satellite", "cybersecurity", "IoT platform",
        "digital twin", "Industry 4.0", "robot collaboration",
        "energy storage", "renewable energy", "smart grid",
    ),
}

# --- fixed values: source registry (domain, name, feed) -----------------------
SOURCE_REGISTRY = (
    ("defense", "Defense News", "https://www.defensenews.com/arc/outboundfeeds/rss/"),
    ("defense", "Breaking Defense", "https://breakingdefense.com/feed/"),
    ("defense", "C4ISRNET", "https://www.c4isrnet.com/arc/outboundfeeds/rss/"),
    ("defense", "Defense One", "https://www.defenseone.com/rss/"),
    ("defense", "Federal News Network", "https://federalnewsnetwork.com/feed/"),
    ("defense", "Military.com", "https://www.military.com/rss"),
    ("defense", "National Defense Magazine", "https://www.nationaldefensemagazine.org/RSS"),
    ("defense", "Jane's Defence Weekly", "https://www.janes.com/feeds/defence-weekly"),
    ("space", "SpaceNews", "https://spacenews.com/feed/"),
    ("space", "Space Force Magazine", "https://www.spaceforce.com/rss"),
    ("space", "Aviation Week", "https://aviationweek.com/rss.xml"),
    ("space", "SpaceFlightNow", "https://spaceflightnow.com/feed/"),
    ("space", "NASA News", "https://www.nasa.gov/rss/dyn/breaking_news.rss"),
    ("tech", "IEEE Spectrum", "https://spectrum.ieee.org/rss"),
    ("tech", "TechCrunch", "https://techcrunch.com/feed/"),
    ("tech", "VentureBeat", "https://venturebeat.com/feed/"),
    ("tech", "Ars Technica", "https://feeds.arstechnica.com/arstechnica/index"),
    ("tech", "Wired", "https://www.wired.com/feed/rss"),
    ("tech", "MIT Technology Review", "https://www.technologyreview.com/feed/"),
    ("medtech", "MedTech Dive", "https://www.medtechdive.com/feeds/news/"),
    ("medtech", "Medical Device Network", "https://www.medicaldevice-network.com/feed/"),
    ("medtech", "FDA News", "https://www.fda.gov/about-fda/contact-fda/stay-informed/rss-feeds"),
    ("medtech", "Modern Healthcare", "https://www.modernhealthcare.com/rss"),
    ("medtech", "Healthcare IT News", "https://www.healthcareitnews.com/rss.xml"),
    ("government", "DARPA News", "https://www.darpa.mil/news/rss"),
    ("government", "SBIR.gov", "https://www.sbir.gov/rss"),
    ("government", "SAM.gov Opportunities", "https://sam.gov/api/prod/opps/v3/opportunities/rss"),
    ("government", "DoD News", "https://www.defense.gov/DesktopModules/ArticleCS/RSS.ashx?ContentType=1&Site=945"),
    ("government", "Air Force Research Lab", "https://www.afrl.af.mil/News/RSS/"),
    ("government", "Office of Naval Research", "https://www.onr.navy.mil/RSS"),
    ("government", "Army Research Lab", "https://www.arl.army.mil/RSS/"),
    ("government", "NASA Contracts", "https://www.nasa.gov/rss/dyn/contracts.rss"),
    ("government", "NASA Technology", "https://www.nasa.gov/rss/dyn/technology.rss"),
    ("government", "DOE ARPA-E", "https://arpa-e.energy.gov/rss.xml"),
    ("government", "NSF Awards", "https://www.nsf.gov/news/rss/rss_awards.xml"),
    ("finance", "SEC Filings (Defense Contractors)", "https://www.sec.gov/cgi-bin/browse-edgar"),
    ("finance", "Yahoo Finance (Defense Stocks)", "https://feeds.finance.yahoo.com/rss/2.0/headline"),
    ("finance", "MarketWatch", "https://feeds.marketwatch.com/marketwatch/topstories/"),
    ("finance", "Seeking Alpha", "https://seekingalpha.com/feed.xml"),
    ("trade", "Manufacturing.net", "https://www.manufacturing.net/rss"),
    ("trade", "Control Engineering", "https://www.controleng.com/rss/"),
    ("trade", "Plant Engineering", "https://www.plantengineering.com/rss/"),
    ("trade", "Robotics Business Review", "https://www.roboticsbusinessreview.com/feed/"),
    ("trade", "IoT World Today", "https://www.iotworldtoday.com/feed/"),
)

# --- fixed values: keyword-query source ---------------------------------------
NEWS_QUERIES = SECTOR_KEYWORDS["defense"]

# --- fixed values: pipeline version stamps --------------------------------------
NLP_PIPELINE_VERSION = "1.0"
MODEL_VERSIONS = {
    "ner": "roberta-base-finetuned-v2.1",
    "coref": "spanbert-large-coreference",
    "relations": "dygie-plus-v1.3",
}

# --- fixed values: quality floor --------------------------------------------------
QUALITY_FLOOR = 0.75

# --- our constants: published ranking formulas -------------------------------------
BM25_K1 = 1.2
BM25_B = 0.75
RRF_K = 60
FUSION_WEIGHTS = {"vector": 0.5, "bm25": 0.3, "centrality": 0.2}
