"""Lists, lookup tables and constants that results depend on.

Every function that uses one of them takes it as an argument, so other data
can bring its own lists.
"""

# Text aliases applied after normalisation.
TEXT_ALIASES = {
    "usa": "united states",
    "uk": "united kingdom",
    "yunnan": "yunnan province",
    "yunnan prov": "yunnan province",
}

# Accepted attack types.
ATTACK_TYPES = [
    "assassination",
    "armed assault",
    "bombing/explosion",
    "hijacking",
    "hostage taking (kidnapping)",
    "hostage taking (barricade incident)",
    "facility/infrastructure attack",
    "unarmed assault",
    "unknown",
]

# Property value assumed for a described extent of damage.
EXTENT_VALUES = {
    "minor (likely < $1 million)": 10_000.0,
    "major (likely >= $1 million but < $1 billion)": 10_000_000.0,
    "catastrophic (likely >= $1 billion)": 1_500_000_000.0,
}
UNKNOWN_EXTENT_VALUE = 10_000.0
UNKNOWN_EXTENT_CAP = 9086

# Upper bounds of the value categories.
VALUE_CATEGORIES = [(0.0, "None"), (1e3, "Low"), (1e6, "Medium"), (1e9, "High")]
VALUE_CATEGORY_ABOVE = "Catastrophic"
VALUE_BIN_EDGES = [0.0, 1e3, 1e6, 1e9]

# Centroids (latitude, longitude).
COUNTRY_CENTROIDS = {
    "united states": (39.8283, -98.5795),
    "united kingdom": (51.5074, -0.1278),
    "india": (20.5937, 78.9629),
    "china": (35.8617, 104.1954),
    "iraq": (33.3152, 44.3661),
    "afghanistan": (33.9391, 67.7100),
    "pakistan": (30.3753, 69.3451),
}
REGION_CENTROIDS = {
    "east asia": (35.8617, 104.1954),
    "south asia": (20.5937, 78.9629),
    "middle east & north africa": (24.7743, 46.7386),
    "north america": (39.8283, -98.5795),
    "western europe": (50.8503, 4.3517),
}
CITY_CENTROIDS = {
    "kunming": (25.0389, 102.7183),
    "baghdad": (33.3152, 44.3661),
    "kabul": (34.5553, 69.2075),
    "madison": (43.0731, -89.4012),
    "oakland": (37.791927, -122.225906),
}

# Largest plausible distance from a country's centroid, in km.
COUNTRY_SIZES_KM = {
    "united states": 4500,
    "china": 5000,
    "india": 3200,
    "united kingdom": 1000,
    "iraq": 1400,
    "afghanistan": 1300,
    "pakistan": 1800,
    "unknown": 1000,
}
DEFAULT_COUNTRY_SIZE_KM = 1000

# The region a country belongs to.
COUNTRY_REGION = {
    "united states": "north america",
    "united kingdom": "western europe",
    "india": "south asia",
    "china": "east asia",
    "iraq": "middle east & north africa",
    "afghanistan": "south asia",
    "pakistan": "south asia",
    "unknown": "unknown",
}

# Group name aliases, in the order they are searched for in text.
GROUP_ALIASES = {
    "the taliban": "taliban",
    "al-qaeda in iraq": "al-qaeda",
    "al-qaida": "al-qaeda",
    "islamic state of iraq and the levant (isil)": "islamic state",
    "islamic state of iraq and syria (isis)": "islamic state",
    "boko haram": "boko haram",
    "bh": "boko haram",
    "al-shabaab": "al-shabaab",
    "al-shabab": "al-shabaab",
    "unknown group": "unknown",
    "unidentified": "unknown",
}
# Names searched for right after the first alias.
GROUP_NAMES_IN_TEXT = {
    "taliban": "taliban",
    "al-qaeda": "al-qaeda",
    "islamic state": "islamic state",
    "isis": "islamic state",
    "isil": "islamic state",
}

# Weapons an attack type allows, first one is the default.
ATTACK_WEAPONS = {
    "assassination": ["firearms", "melee", "unknown"],
    "armed assault": ["firearms", "melee", "unknown"],
    "bombing/explosion": ["explosives", "unknown"],
    "hijacking": ["firearms", "vehicle", "unknown"],
    "hostage taking (kidnapping)": ["firearms", "melee", "unknown"],
    "hostage taking (barricade incident)": ["firearms", "explosives", "unknown"],
    "facility/infrastructure attack": ["explosives", "incendiary", "unknown"],
    "unarmed assault": ["melee", "unknown"],
    "unknown": ["unknown"],
}
# Subtypes a weapon type allows.
WEAPON_SUBTYPES = {
    "explosives": ["grenade", "landmine", "bomb", "unknown"],
    "firearms": ["rifle", "pistol", "machine gun", "unknown"],
    "melee": ["knife", "blunt object", "unknown"],
    "incendiary": ["molotov", "arson", "unknown"],
    "vehicle": ["car", "truck", "unknown"],
    "unknown": ["unknown"],
}

# Summary wording, replaced in this order.
SUMMARY_ABBREVIATIONS = {
    "govt": "government",
    "mil": "military",
    "org": "organization",
    "intl": "international",
    "terr": "terrorist",
    "atk": "attack",
}
SUMMARY_TERMS = {
    "attackers": "attackers",
    "terrorists": "attackers",
    "militants": "attackers",
    "bombed": "bombing",
    "exploded": "explosion",
}
SUMMARY_DROPPED_PHRASE = "no group claimed responsibility"
SUMMARY_LENGTH = 500

# Words that point at damage, at a claim.
DAMAGE_PATTERN = "damage|cost|value|economic|destroy"
CLAIM_PATTERN = "claimed|responsibility"

# Motive classes, first matching pattern wins.
MOTIVE_PATTERNS = [
    ("religious", r"\b(religion|islam|jihad|faith|holy)\b"),
    ("anti-government", r"\b(anti[- ]?government|state|gov|dictator|regime)\b"),
    ("political", r"\b(politic|power|election|democracy|reform)\b"),
    ("ethnic", r"\b(ethnic|tribal|race|minority|ethno)\b"),
    ("separatist", r"\b(separat|independen|autonom|territor)\b"),
    ("retaliation", r"\b(retaliat|revenge|retribution|vengeance)\b"),
    ("economic", r"\b(economic|financial|money|poverty)\b"),
    ("criminal", r"\b(crime|gang|drug|mafia|cartel)\b"),
    ("ideological", r"\b(ideolog|doctrine|extremism)\b"),
    ("military", r"\b(military|army|soldier|warfare|invasion)\b"),
    ("unknown", r"\b(unknown|not known|no motive|unclear|unspecified)\b"),
]

# Prompt wording around a summary.
PROMPT_BEFORE = (
    "Given the following description of a terrorist attack, identify the most likely motive"
    ' behind the attack in one or two words.\n\nDescription: "'
)
PROMPT_AFTER = '"\nMotive:'

# Bounds.
FIRST_YEAR, LAST_YEAR = 1970, 2017
SUBCOUNT_CAP = 1000.0
HIGH_IMPACT_VALUE, HIGH_IMPACT_KILLED = 1e6, 100
CLIP_RANGES = {
    "success": (0, 1),
    "extended": (0, 1),
    "property": (-1, 1),
    "specificity": (1, 5),
    "vicinity": (0, 1),
    "uncertainty": (0, 1),
}
