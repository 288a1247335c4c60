"""Fixed values that must equal the reference's for identical results.

FIXED VALUES — category codes and names, canonical class order, cleaning word
lists, keyword families, unit patterns, numeric bins and unit conversions.
They are stated here plainly, in their natural order; every operator reads
them from this module (as small broadcast tables or literal arrays).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: product categories (code -> full name, short name, group)
# ---------------------------------------------------------------------------
CATEGORY_NAMES = {
    10: "Livres techniques, éducatifs, artistiques ou spirituels",
    2705: "Romans, récits et littérature",
    2280: "Journaux, magazines et revues",
    2403: "Séries & encyclopédies",
    40: "Rétro Gaming",
    50: "Accessoires & Périphériques de Jeux Vidéo",
    60: "Consoles",
    2462: "Jeux Vidéo Modernes",
    2905: "Jeux PC en Téléchargement",
    1140: "Figurine",
    1160: "Jeu de carte à collectionner",
    1180: "Jeux de rôle & figurines",
    1280: "Jouets, Figurines et Poupées",
    1281: "Jeux éducatifs & Créatifs",
    1300: "Modélisme & Drones",
    1301: "Bébé, Jeux & Loisirs",
    1302: "Sport, Loisirs & Plein Air",
    1320: "Bébé & Puériculture",
    1560: "Équipement de la maison & décoration",
    1920: "Textiles d'intérieur",
    2060: "Décoration & Éclairage",
    2582: "Jardinage, déco & extérieur",
    2583: "Piscine & équipement de piscine",
    2585: "Jardin, Bricolage & Outillage",
    1940: "Alimentation & Épicerie",
    2220: "Animaux & Accessoires",
    2522: "Fournitures de bureau & papeterie",
}

CATEGORY_SHORT_NAMES = {
    10: "Livres techniques",
    2705: "Romans & littérature",
    2280: "Journaux & magazines",
    2403: "Séries & encyclopédies",
    40: "Rétro Gaming",
    50: "Accessoires JV",
    60: "Consoles",
    2462: "Jeux Vidéo",
    2905: "Jeux PC",
    1140: "Figurine",
    1160: "Cartes à collectionner",
    1180: "Jeux de rôle",
    1280: "Jouets & Figurines",
    1281: "Jeux éducatifs",
    1300: "Modélisme & Drones",
    1301: "Bébé & Jeux",
    1302: "Sport & Loisirs",
    1320: "Bébé & Puériculture",
    1560: "Équipement maison",
    1920: "Textiles",
    2060: "Déco & Éclairage",
    2582: "Jardinage & déco",
    2583: "Piscine",
    2585: "Jardin & Bricolage",
    1940: "Alimentation",
    2220: "Animaux",
    2522: "Fournitures bureau",
}

CATEGORY_GROUPS = {
    "Livres & Médias": [10, 2705, 2280, 2403],
    "Jeux Vidéo": [40, 50, 60, 2462, 2905],
    "Jouets & Loisirs": [1140, 1160, 1180, 1280, 1281, 1300],
    "Bébé & Enfant": [1301, 1320],
    "Maison & Jardin": [1560, 1920, 2060, 2582, 2583, 2585],
    "Sport & Vie": [1302, 1940, 2220, 2522],
}

# FIXED VALUES: canonical class order and its fingerprint
CANONICAL_CLASSES = [10, 40, 50, 60, 1140, 1160, 1180, 1280, 1281, 1300, 1301, 1302, 1320,
                     1560, 1920, 1940, 2060, 2220, 2280, 2403, 2462, 2522, 2582, 2583, 2585,
                     2705, 2905]
CANONICAL_CLASSES_FP = "cdfa70b13f7390e6"

# ---------------------------------------------------------------------------
# FIXED VALUES: cleaning lists
# ---------------------------------------------------------------------------
BOILERPLATE_PHRASES = ["li li strong", "li li", "br br", "et de"]

# ASCII punctuation (string.punctuation) plus typographic characters
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
EXTRA_PUNCTUATION = ["…", "'", '"', "«", "»", "•", "·", "–", "—", "‹", "›"]

# Public NLTK stop-word lists (English, then French), written out as data.
STOPWORDS_EN = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've",
    "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself",
    "she", "she's", "her", "hers", "herself", "it", "it's", "its", "itself", "they", "them",
    "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "that'll",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has",
    "had", "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or",
    "because", "as", "until", "while", "of", "at", "by", "for", "with", "about", "against",
    "between", "into", "through", "during", "before", "after", "above", "below", "to", "from",
    "up", "down", "in", "out", "on", "off", "over", "under", "again", "further", "then", "once",
    "here", "there", "when", "where", "why", "how", "all", "any", "both", "each", "few", "more",
    "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than",
    "too", "very", "s", "t", "can", "will", "just", "don", "don't", "should", "should've", "now",
    "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't", "didn",
    "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't", "haven", "haven't", "isn",
    "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't", "needn", "needn't", "shan", "shan't",
    "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn",
    "wouldn't",
]
STOPWORDS_FR = [
    "au", "aux", "avec", "ce", "ces", "dans", "de", "des", "du", "elle", "en", "et", "eux", "il",
    "ils", "je", "la", "le", "les", "leur", "lui", "ma", "mais", "me", "même", "mes", "moi", "mon",
    "ne", "nos", "notre", "nous", "on", "ou", "par", "pas", "pour", "qu", "que", "qui", "sa", "se",
    "ses", "son", "sur", "ta", "te", "tes", "toi", "ton", "tu", "un", "une", "vos", "votre", "vous",
    "c", "d", "j", "l", "à", "m", "n", "s", "t", "y", "été", "étée", "étées", "étés", "étant",
    "étante", "étants", "étantes", "suis", "es", "est", "sommes", "êtes", "sont", "serai", "seras",
    "sera", "serons", "serez", "seront", "serais", "serait", "serions", "seriez", "seraient",
    "étais", "était", "étions", "étiez", "étaient", "fus", "fut", "fûmes", "fûtes", "furent",
    "sois", "soit", "soyons", "soyez", "soient", "fusse", "fusses", "fût", "fussions", "fussiez",
    "fussent", "ayant", "ayante", "ayantes", "ayants", "eu", "eue", "eues", "eus", "ai", "as",
    "avons", "avez", "ont", "aurai", "auras", "aura", "aurons", "aurez", "auront", "aurais",
    "aurait", "aurions", "auriez", "auraient", "avais", "avait", "avions", "aviez", "avaient",
    "eut", "eûmes", "eûtes", "eurent", "aie", "aies", "ait", "ayons", "ayez", "aient", "eusse",
    "eusses", "eût", "eussions", "eussiez", "eussent",
]
STOPWORDS_FR_EN = sorted(set(STOPWORDS_EN) | set(STOPWORDS_FR))

# ---------------------------------------------------------------------------
# FIXED VALUES: keyword families (substring alternations, case-sensitive)
# ---------------------------------------------------------------------------
KEYWORD_DICT = {
    "Animaux": ["chien", "chat", "animal", "compagnie", "collier"],
    "Bureau & Papeterie": ["verso", "cahier", "encre", "papier", "recto", "a5"],
    "Épicerie": ["epices", "arôme", "chocolat", "sucre", "sachet", "capsule"],
    "Puériculture": ["langer", "bavoir", "assiette", "siege", "tétine", "poussette"],
    "Vêtement Bébé & Loisirs": ["bébé", "chaussettes", "paire", "longueur", "filles", "garçons"],
    "Figurines": ["figurine", "gundam", "statuette", "officiel", "marvel", "funko"],
    "Jeux de cartes": ["mtg", "oh", "rare", "vf", "carte", "magic"],
    "Jeux de rôle & Figurines": ["halloween", "figurine", "warhammer", "prince", "masque"],
    "Bricolage & Outillage": ["arrosage", "tondeuse", "aspirateur", "appareils", "outil", "coupe", "bâche"],
    "Décoration & Équipement Jardin": ["bois", "jardin", "résistant", "tente", "parasol", "aluminium"],
    "Piscine & Accessoires": ["piscine", "filtration", "pompe", "dimensions", "eau", "ronde"],
    "Accessoires & Périphériques": ["nintendo", "manette", "protection", "ps4", "silicone", "câble"],
    "Consoles": ["console", "oui", "jeu", "écran", "portable", "marque", "jeux"],
    "Jeux PC en Téléchargement": ["windows", "jeu", "directx", "plus", "téléchargement", "disque", "édition"],
    "Jeux Vidéo Modernes": ["duty", "jeux", "manettes", "ps3", "xbox", "kinect"],
    "Rétro Gaming": ["japonais", "import", "langue", "titres", "sous", "français"],
    "Jeux éducatifs": ["joue", "cartes", "enfants", "éducatif", "bois", "jouer"],
    "Jouets & Figurines": ["doudou", "enfants", "cadeau", "peluche", "jouet", "puzzle"],
    "Loisirs & Plein air": ["camping", "pêche", "stress", "stream", "bracelet", "trampoline"],
    "Modélisme & Drones": ["drone", "générique", "dji", "avion", "batterie", "cámera", "one"],
    "Littérature": ["monde", "ouvrage", "siècle", "roman", "livre", "histoire", "tome"],
    "Livres spécialisés": ["guide", "édition", "histoire", "art", "collection"],
    "Presse & Magazines": ["journal", "france", "illustre", "magazine", "presse", "revue"],
    "Séries & Encyclopédies": ["lot", "livres", "tomes", "volumes", "tome", "revues"],
    "Décoration & Lumières": ["led", "noël", "lumière", "lampe", "décoration", "couleur"],
    "Textiles d'intérieur": ["oreiller", "taie", "coussin", "couverture", "canapé", "cotton"],
    "Équipement Maison": ["matelas", "assise", "bois", "table", "hauteur", "mousse"],
}

# FIXED VALUES: unit patterns (case-insensitive, any match -> has_any_unit)
UNIT_PATTERNS = {
    "cm": r"\b\d+\s*(cm|centimetre?s?|centimètre?s?)\b",
    "mm": r"\b\d+\s*(mm|millimetre?s?|millimètre?s?)\b",
    "m": r"\b\d+\s*(m|metre?s?|mètre?s?)\b",
    "kg": r"\b\d+\s*(kg|kilo|kilogramme?s?)\b",
    "g": r"\b\d+\s*(g|gramme?s?)\b",
    "ml": r"\b\d+\s*(ml|millilitres?|millilitre?)\b",
    "l": r"\b\d+\s*(l|litres?|litre?)\b",
    "cl": r"\b\d+\s*cl\b",
    "x_dim": r"\b\d+\s*(x|×)\s*\d+(\s*(cm|mm|m))?\b",
    "age_ans": r"\b\d+\s*ans\b",
    "age_mois": r"\b\d+\s*mois\b",
    "age_range_ans": r"\b\d+\s*[-–/]\s*\d+\s*ans\b",
    "age_range_mois": r"\b\d+\s*[-–/]\s*\d+\s*mois\b",
    "age_min_ans": r"\b(?:à\s*partir\s*de\s*)?\d+\s*ans\s*(?:et\s*plus|\+|plus)?\b",
    "pointure": r"\bpointures?\s*:?(\s*(eu|eur|fr))?\s*\d{2}(?:[.,]\d)?(\s*[-/]\s*\d{2}(?:[.,]\d)?)?\b",
    "inch": r'\b\d+\s*(\"|pouces?|po)\b',
    "time_heures": r"\b\d+\s*(?:h|heures?)\b",
    "time_jours": r"\b\d+\s*jours?\b",
    "go": r"\b\d+\s*(go|giga-?octets?)\b",
    "gb": r"\b\d+\s*(gb|gigabytes?)\b",
    "mo": r"\b\d+\s*(mo|méga-?octets?|mega-?octets?)\b",
    "mb": r"\b\d+\s*(mb|megabytes?)\b",
    "ko": r"\b\d+\s*(ko|kilo-?octets?)\b",
    "kb": r"\b\d+\s*(kb|kilobytes?)\b",
    "ram": r"\b\d+\s*(go|gb|mo|mb)\s*ram\b",
    "vram": r"\b\d+\s*(go|gb|mo|mb)\s*vram\b",
    "ghz": r"\b\d+(?:\.\d+)?\s*ghz\b",
    "mhz": r"\b\d+(?:\.\d+)?\s*mhz\b",
    "bits": r"\b(32|64)\s*[- ]?(?:bit|bits)\b",
    "kbps": r"\b\d+\s*kbps\b",
    "mbps": r"\b\d+\s*mbps\b",
    "fps": r"\b\d+\s*fps\b",
}

# ---------------------------------------------------------------------------
# FIXED VALUES: numeric-token bins (half-open [t_i, t_i+1)), unit spelling,
# conversion to base unit, measure groups
# ---------------------------------------------------------------------------
INF = float("inf")
LABEL_BINS = {
    "volume": ([0, 5e3, 1.5e6, INF], ["petit volume", "volume moyen", "grand volume"]),
    "surface": ([0, 1600, 2e4, INF], ["petite surface", "surface moyenne", "grande surface"]),
    "length": ([0, 10, 40, 350, INF],
               ["petite longueur", "longueur moyenne", "grande longueur", "très grande longueur"]),
    "weight": ([0, 1.5, 20, INF], ["poids leger", "poids moyen", "poids lourd"]),
    "price": ([0, 20, 100, INF], ["prix bas", "prix moyen", "prix eleve"]),
    "age": ([0, 3, 15, INF], ["age bébé", "age enfant", "age adulte"]),
    "memory": ([0, 8, 64, INF], ["petite mémoire", "mémoire moyenne", "grande mémoire"]),
    "date": ([1800, 1960, 2007, 2021, INF],
             ["date ancienne", "date contemporaine", "date récente", "date future"]),
    "numero": ([0, 20, INF], ["petit numero", "grand numero"]),
    "card": ([0, 5, INF], ["peu de cartes", "beaucoup de cartes"]),
    "piece": ([0, 3, INF], ["peu de pièces", "beaucoup de pièces"]),
    "integer": ([0, 1, 2, 5, 20, 100, INF],
                ["zéro", "un", "petit nombre", "nombre moyen", "grand nombre", "très grand nombre"]),
    "float": ([0, 1, 10, 100, INF],
              ["petite quantité", "quantité moyenne", "grande quantité", "très grande quantité"]),
}

UNIT_NORMALIZATION = [
    (r"m[èeé]tres?", "m"), (r"centim[eèé]tres?", "cm"), (r"millim[eèé]tres?", "mm"),
    (r"grammes?", "g"), (r"kilos?|kilogrammes?", "kg"), (r"tonnes?", "tonne"),
    (r"litres?", "l"), (r"centilitres?", "cl"), (r"millilitres?", "ml"),
    (r"ans?", "ans"),
]

CONVERSION = {
    "mm": 0.1, "cm": 1, "dm": 10, "m": 100,
    "mm2": 0.01, "cm2": 1, "dm2": 100, "m2": 10 ** 4,
    "mm3": 10 ** -3, "cm3": 1, "dm3": 1000, "m3": 10 ** 6,
    "ml": 1, "cl": 10, "dl": 100, "l": 1000,
    "g": 1e-3, "kg": 1, "tonne": 1e3,
    "mois": 1 / 12, "ans": 1,
    "mo": 10 ** -3, "go": 1, "to": 10 ** 3,
}

REG_DIST = r"(mm|millim[eèé]tres?|cm|centim[eèé]tres?|m|m[eèé]tres?)"
REG_VOL = r"([mcd]?m3|[mcd]?l|millilitres?|centilitres?|litres?)"
REG_WEIGHT = r"(g|grammes?|kg|kilogrammes?|kilo|tonnes?)"

# (measure, pattern, unit group position or None, interval flag) in pass order
NUMERIC_PATTERNS = [
    ("volume", rf"\b(\d+[.,]?\d*)\s*[xX*]\s*(\d+[.,]?\d*)\s*[xX*]\s*(\d+[.,]?\d*)\s*{REG_DIST}\b", -1, False),
    ("volume", rf"\b(\d+[.,]?\d*)\s*{REG_VOL}\b", -1, False),
    ("surface", rf"\b(\d+[.,]?\d*)\s*[xX*]\s*(\d+[.,]?\d*)\s*{REG_DIST}\b", -1, False),
    ("surface", r"\b(\d+[.,]?\d*)\s*([mcd]?m2)\b", -1, False),
    ("length", rf"\b(?:(\d+[.,]?\d*)\s*-\s*)?(\d+[.,]?\d*)\s*{REG_DIST}\b", -1, True),
    ("weight", rf"\b(\d+[.,]?\d*)\s*{REG_WEIGHT}\b", -1, False),
    ("price", r"\b(\d+[.,]?\d*)\s*(€|eur|euros?)\b", -1, False),
    ("age", r"\b(?:(\d+)\s*-\s*)?(\d+)\s*(mois|ans?)\b", -1, True),
    ("memory", r"\b(\d+)\s*([gmt][ob])\b", -1, False),
    ("date", r"\b(?:\d{2}/\d{2}/|\d{2}/)?((?:18|19|20)\d{2})\b", None, False),
    ("numero", r"\b(num[eé]ro|num|n°|n.?|no.?)\s*(\d+)\b", 0, False),
    ("power", r"\b(\d+[.,]?\d*)\s*(cv|w|watts?)\b", -1, False),
    ("energy", r"\b(\d+[.,]?\d*)\s*(kw|kilowatts?)\b", -1, False),
    ("capacity", r"\b(\d+[.,]?\d*)\s*(m?ah)\b", -1, False),
    ("temperature", r"\b(\d+[.,]?\d*)\s*(°[ck]?|degr[eé]s?)\b", -1, False),
    ("tension", r"\b(\d+[.,]?\d*)\s*(v|volts?)\b", -1, False),
    ("card", r"\b(\d+)\s*(cartes?)\b", -1, False),
    ("piece", r"\b(\d+)\s*(pi[eè]ces?|pcs)\b", -1, False),
    ("integer", r"\b(\d+)\b", None, False),
    ("float", r"\b(\d+[.,]?\d*)\b", None, False),
]

NUMERIC_GROUPS = {
    "light": ["volume", "surface", "length", "weight", "memory", "age", "card", "piece",
              "power", "energy", "capacity", "temperature", "tension"],
    "full": ["volume", "surface", "length", "weight", "memory", "age", "card", "piece",
             "power", "energy", "capacity", "temperature", "tension",
             "date", "numero", "integer", "float", "price"],
    "phys": ["length", "surface", "volume", "weight"],
}

# FIXED VALUES: model display order and text-model keywords
MODEL_ORDER = ["lenet", "resnet50", "vit", "swin", "camembert", "xlmr", "mdeberta", "flaubert"]
TEXT_MODEL_KEYWORDS = ["camembert", "flaubert", "xlmr", "mdeberta", "bert"]

# ---------------------------------------------------------------------------
# FIXED VALUES: archive and notebook cleaner variants (CLN19, CLN20)
# ---------------------------------------------------------------------------
ARCHIVE_CUSTOM_STOPWORDS = ["m?"]

NOTEBOOK_PUNCT_EXTRA = ["…", "’", "“", "”", "«", "»"]

NOTEBOOK_BOILERPLATE = [
    "de haute qualite", "haute qualite", "il vous plait", "vous plait", "vous plait permettre", "peut etre",
    "peut etre legerement", "peut etre utilise", "etre legerement different", "raison de la", "en raison",
    "en raison de", "raison de", "la couleur reelle", "couleur reelle de", "couleur reelle", "la couleur et",
    "la couleur de", "la mesure", "la mesure manuelle", "de la mesure", "la difference", "de la difference",
    "la lumiere", "de la lumiere", "ne pas", "ne pas utiliser", "ne pas refleter", "ne pas reflecter",
    "ne sont pas", "pas refleter la", "pas reflecter la", "plait permettre une", "la marque", "de la marque",
    "la main", "tout neuf", "100 tout neuf", "neuf et", "neuf et de", "tout neuf et", "forfait comprend",
    "le forfait comprend", "le forfait", "contenu de emballage", "contenu du coffret", "le paquet contient",
    "de element peut", "element peut etre", "permettre une legere", "duree de vie", "different des images",
    "en fonction de",
]

# The notebook's list glues "facile" "vraiment" into one word by a missing
# comma; both words are listed separately here (repaired).
NOTEBOOK_STOPWORDS = [
    "qualite", "neuf", "nouveau", "s'il", "d'un", "d'une", "ect", "m?", "plus", "peut", "etre", "être", "comme",
    "cette", "tout", "tous", "tres", "très", "si", "aussi", "encore", "peu", "egalement", "également", "avant",
    "entre", "grace", "grâce", "pour", "dans", "ce", "ces", "dont", "depuis", "ainsi", "son", "leurs", "avec",
    "100%", "facile", "vraiment", "simplement", "entierement", "completement", "deja", "juste", "description:",
    "caractéristiques:", "caractéristiques", "contenu", "type", "etc", "utiliser", "utilisé", "utilise",
    "utilisés", "utilises", "fait", "faire", "permet", "permettre", "peuvent", "parfait", "ideal", "idéal",
    "grand", "grande", "different", "différent", "differents", "différents", "durable",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: cleaning rules as (pattern, replacement), in order of
# application; \1, \2, \3 are groups and \0 the match.  Case-insensitive but
# for "years", Unicode classes.  Both engines' rules are made from this table.
# ---------------------------------------------------------------------------
HTML_TAG = r"<[^>]+>"
MERGE_RULES = {
    "dims": [(r"\b(\d+)\s*x\s*(\d+)\s*x\s*(\d+)\b", r"\1x\2x\3"), (r"\b(\d+)\s*x\s*(\d+)\b", r"\1x\2"),
             (r"\b([lh])\s*x\s*([lh])\s*x\s*([lh])\b", r"\1x\2x\3")],
    # `%\b` needs a word character after the sign
    "units": [(r"\b(\d+)\s*(kg|g|mg|ml|l)\b", r"\1\2"), (r"\b(\d+)\s*(mm|cm|m)\b", r"\1\2"),
              (r"\b(\d+)\s*(go|gb|mo|mb)\b", r"\1\2"), (r"\b(\d+)\s*%\b", r"\1pct"),
              (r"\b(\d+)\s*(mah|ah)\b", r"\1\2")],
    "durations": [(r"\b(\d+)\s*(h|heures?)\b", r"\1h"), (r"\b(\d+)\s*(j|jours?)\b", r"\1j"),
                  (r"\b(\d+)\s*mois\b", r"\1mois"), (r"\b(\d+)\s*ans?\b", r"\1ans"),
                  (r"\b24\s*h\s*/\s*24\b", "24h24"), (r"\b7\s*j\s*/\s*7\b", "7j7")],
    "ages": [(r"\b(\d+)\s*-\s*(\d+)\s*ans\b", r"\1_\2ans"), (r"\b(\d+)\s*-\s*(\d+)ans\b", r"\1_\2ans"),
             (r"\b(\d+)\s*ans?\s*et\s*plus\b", r"\1plus_ans")],
    "years": [(r"\b(18|19|20)\d{2}\b", r" year\0 ")],
}
LONE_DOT = r"(?<!\d)\.(?!\d)"
LONE_MARKS = ["-", ":", "·", "/", r"\+"]
SLASHES = "////"

# FIXED VALUES: colour classes and their HSV ranges (hue, saturation, value),
# half-open; a reversed hue range wraps.  A later class wins.
COLOR_RANGES = [
    ("noir", (0, 181), (0, 256), (0, 70)), ("gris", (0, 181), (0, 40), (70, 200)), ("blanc", (0, 181), (0, 40), (200, 256)),
    ("rouge", (170, 10), (40, 256), (70, 256)), ("orange", (10, 30), (40, 256), (70, 256)), ("jaune", (30, 50), (40, 256), (70, 256)),
    ("vert", (50, 70), (40, 256), (70, 256)), ("turquoise", (70, 90), (40, 256), (70, 256)), ("cyan", (90, 110), (40, 256), (70, 256)),
    ("bleu", (110, 130), (40, 256), (70, 256)), ("violet", (130, 150), (40, 256), (70, 256)), ("rose", (150, 170), (40, 256), (70, 256)),
]
