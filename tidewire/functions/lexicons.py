"""Word lists, places and lookup tables.

Results only agree with the original system when these lists agree, so they are
spelled out in full and in their natural order. Every operator takes its list
as a parameter; these are the defaults.
"""

# Sentiment words.
POSITIVE_WORDS = [
    "growth", "profit", "surplus", "gain", "rally", "boom", "recovery",
    "breakthrough", "innovation", "expansion", "prosperity", "opportunity",
    "stable", "strong", "positive", "optimistic", "upgrade", "bullish",
    "victory", "success", "achievement", "progress", "improvement",
]
NEGATIVE_WORDS = [
    "crisis", "crash", "loss", "deficit", "decline", "recession", "inflation",
    "default", "bankruptcy", "sanctions", "conflict", "war", "violence",
    "casualty", "death", "destruction", "threat", "risk", "downgrade",
    "bearish", "collapse", "instability", "turmoil", "downturn", "slump",
    "emergency", "disaster", "attack", "hostility", "tension",
]

# Countries and organisation patterns: the short lists of the enricher ...
LINKER_COUNTRIES = [
    "USA", "China", "Russia", "Ukraine", "Iran", "Israel", "India",
    "Germany", "France", "UK", "Japan", "Saudi Arabia", "Turkey",
    "North Korea", "Syria", "Afghanistan", "Venezuela", "Brazil",
]
LINKER_ACRONYMS = ["UN", "NATO", "EU", "OPEC", "IMF", "World Bank", "Fed", "ECB"]
LINKER_SUFFIXES = ["Inc", "Corp", "LLC", "Group", "Bank", "Fund", "Agency"]

# ... and the long lists of the entity extractor.
NER_COUNTRIES = [
    "USA", "United States", "China", "Russia", "Ukraine", "Iran", "Israel",
    "India", "Germany", "France", "UK", "Japan", "Saudi Arabia", "Turkey",
    "North Korea", "Syria", "Afghanistan", "Venezuela", "Brazil", "Pakistan",
    "Somalia", "Ethiopia", "Myanmar", "Sudan", "Yemen", "Iraq",
]
NER_ACRONYMS = [
    "UN", "NATO", "EU", "OPEC", "IMF", "World Bank", "Fed", "ECB",
    "WHO", "WTO", "ICC", "CIA", "FBI", "NASA",
]
NER_SUFFIXES = [
    "Inc", "Corp", "LLC", "Ltd", "Group", "Bank", "Fund", "Agency",
    "Organization", "Committee",
]

# Sentences holding one of these words score ten points more in a summary.
SUMMARY_KEYWORDS = ["market", "economy", "conflict", "trade", "risk", "growth", "crisis"]

# Conflict scan.
CONFLICT_QUERY_WORDS = ["conflict", "war", "military", "violence", "protest"]
CONFLICT_KEYWORDS = [
    "conflict", "war", "military", "violence", "protest", "sanctions",
    "ceasefire", "hostility", "insurgency", "rebellion", "invasion",
    "bombing", "strike", "offensive", "casualty", "refugee",
]
ESCALATION_TRIGGERS = {
    "high": ["invasion", "nuclear", "chemical weapon", "genocide", "massacre"],
    "medium": ["sanctions", "military exercise", "troop", "deployment", "ultimatum"],
    "low": ["diplomatic", "negotiation", "talk", "meeting", "summit"],
}
CONFLICT_ZONES = [
    "Ukraine", "Gaza", "Syria", "Yemen", "Sudan", "Myanmar",
    "Taiwan Strait", "Korean Peninsula",
]
SEVERITY_POINTS = {"high": 10, "medium": 5, "low": 1}

# Economic indicators and sectors.
ECONOMIC_INDICATORS = {
    "gdp": ["GDP", "gross domestic product", "economic growth"],
    "inflation": ["CPI", "inflation", "consumer price", "price index"],
    "unemployment": ["unemployment", "jobless", "labor market", "employment"],
    "interest_rates": ["interest rate", "fed rate", "central bank", "monetary policy"],
    "trade": ["trade deficit", "trade surplus", "tariff", "export", "import"],
    "fiscal": ["deficit", "debt", "budget", "fiscal policy", "stimulus"],
    "manufacturing": ["PMI", "manufacturing", "industrial production"],
    "consumer": ["consumer confidence", "retail sales", "consumer spending"],
}
SECTORS = {
    "energy": ["oil", "gas", "energy", "petroleum", "renewable"],
    "technology": ["tech", "AI", "semiconductor", "software", "cyber"],
    "finance": ["bank", "finance", "insurance", "fintech", "lending"],
    "healthcare": ["health", "pharma", "biotech", "medical"],
    "defense": ["defense", "military", "aerospace", "arms"],
    "agriculture": ["agriculture", "farming", "crop", "food"],
}

# Commodities by category.
COMMODITIES = {
    "energy": ["crude oil", "natural gas", "gasoline", "heating oil", "diesel"],
    "metals": ["gold", "silver", "copper", "platinum", "palladium", "aluminum", "steel", "lithium"],
    "agriculture": ["wheat", "corn", "soybeans", "coffee", "sugar", "cotton", "rice", "palm oil"],
    "softs": ["cocoa", "orange juice", "lumber", "rubber"],
}

# News categories.
NEWS_CATEGORIES = {
    "geopolitics": ["diplomat", "treaty", "alliance", "ambassador", "sovereign"],
    "economy": ["economy", "gdp", "inflation", "central bank", "fiscal"],
    "markets": ["stock", "bond", "market", "index", "volatility"],
    "technology": ["tech", "ai", "cyber", "semiconductor", "software"],
    "energy": ["oil", "gas", "energy", "renewable", "nuclear"],
    "defense": ["military", "defense", "weapon", "army", "navy"],
    "trade": ["trade", "tariff", "export", "import", "supply chain"],
    "health": ["health", "pandemic", "vaccine", "disease", "hospital"],
    "environment": ["climate", "environment", "emission", "flood", "drought"],
    "conflict": ["conflict", "war", "violence", "protest", "sanctions"],
}

# Credibility of news sources.
SOURCE_WEIGHTS = {
    "reuters": 0.95,
    "bloomberg": 0.95,
    "associated_press": 0.90,
    "bbc": 0.85,
    "cnn": 0.75,
    "al_jazeera": 0.70,
    "xinhua": 0.50,
    "rt": 0.30,
    "unknown": 0.50,
}
DEFAULT_SOURCE_WEIGHT = 0.50

# Watched places.
WATCHLIST = {
    "chokepoint": [
        "Strait of Hormuz", "Strait of Malacca", "Suez Canal", "Panama Canal",
        "Bab-el-Mandeb", "Turkish Straits", "South China Sea", "Baltic Sea",
    ],
    "airspace": [
        "Ukraine", "Russia", "Belarus", "Iran", "Iraq", "Syria",
        "Afghanistan", "North Korea", "Myanmar", "Israel", "Gaza",
        "Taiwan Strait", "South China Sea",
    ],
    "site": ["Bushehr", "Yongbyon", "Tartus", "Shanghai", "Crimea"],
}

# Historical events: name, type, impact, sentiment.
HISTORICAL_EVENTS = [
    ("2008 Financial Crisis", "economic", "severe", -0.9),
    ("COVID-19 Pandemic", "health", "severe", -0.8),
    ("Russia-Ukraine War 2022", "conflict", "high", -0.7),
    ("Brexit Vote 2016", "political", "high", -0.5),
    ("US-China Trade War", "trade", "moderate", -0.4),
    ("Arab Spring 2011", "political", "moderate", -0.3),
    ("Tech Bubble 2000", "market", "severe", -0.6),
    ("Oil Price Crash 2014", "energy", "moderate", -0.5),
    ("European Debt Crisis 2011", "economic", "high", -0.6),
    ("Gulf War 1991", "conflict", "moderate", -0.4),
]

# Asset classes attached to a similarity match.
ASSET_CLASSES = ["equities", "bonds", "commodities"]
AFFECTED_ASSETS = ["equities", "bonds"]
