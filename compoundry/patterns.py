"""Results depend on them, so they are stated here as they are.

Whitespace is written out as a class (``WS``) because the rules follow Unicode
whitespace, while the ``\\s`` of Java regular expressions is ASCII only.
"""

# Whitespace and line breaks.
WS = r"[\s\x1C-\x1F\x85\p{Z}]"
LINE_BREAK_CHARS = r"\n\x0B\x0C\r\x1C-\x1E\x85\u2028\u2029"
LINE_BREAK = r"\r\n|[" + LINE_BREAK_CHARS + "]"
# whitespace that does not end a line
INLINE_WS = r"[ \t\x1F\p{Zs}]"

# Registry numbers.
CAS_SHAPE = r"^[0-9]{2,7}-[0-9]{2}-[0-9]\z"
CAS_TOKEN = r"[0-9]{2,7}-[0-9]{2}-[0-9]"
CAS_TOKEN_BOUNDED = r"(?<![0-9])[0-9]{2,7}-[0-9]{2}-[0-9](?![0-9])"

# Words and marks that say nothing about the substance.
NOISE = (
    r"(?i)\b[0-9]{1,3}" + WS + r"*%(?:" + WS + r"*(?:w/v|v/v))?\b"
    r"|\b(?:ml|l|kg|g|lb|gal|drum|tote|pail|bottle|case|kit|refill|cartridge)s?\b"
    r"|\b(?:acs|tech(?:nical)?|reagent|usp|nf|bp|fcc|food|industrial|anhydrous|solution"
    r"|aq\.?|conc(?:entrated)?)\b"
    r"|[®™]"
)

# Words that make a name look like a chemical.
CHEMICAL_WORDS = (
    "(acid|amine|amide|alcohol|oxide|chloride|sulfate|sulfite|sulfonate|acetate|glycol|ketone"
    "|benz|propyl|ethyl|methyl|hydroxide|carbonate|bicarbonate|phosphate|silicate|benzoate"
    "|nitrate|nitrite|bromide|iodide|citrate|lactate|tartrate|oxalate)"
)
# Words of things that are sold but are no chemicals.
NON_CHEMICAL_WORDS = (
    "(drum|tote|bottle|cap|lid|empty|pallet|charge|service|assembly|kit|tubing|hose|strap|pail"
    "|pump|liner|shipping|handling|case|refill|cartridge)"
)

# Common names that are looked up before other names.
COMMON_NAMES = [
    "isopropanol", "ethanol", "sodium carbonate", "sodium hydroxide", "potassium hydroxide",
    "calcium hydroxide", "ammonium hydroxide", "stoddard solvent", "hydrochloric acid",
    "methanol", "trisodium phosphate", "1-methyl-2-pyrrolidone",
]

# Everyday names -> what to look up (pattern, replacement, hint, note).
ALIASES = [
    (r"^\s*xylenes?\s*$", "1330-20-7", "cas", "mixed xylenes"),
    (r"^\s*white\s*spirit(s)?\s*$", "Stoddard solvent", "name", "synonym"),
    (r"^\s*mineral\s*spirit(s)?\s*$", "Stoddard solvent", "name", "synonym"),
    (r"^\s*muriatic\s*acid\s*$", "hydrochloric acid", "name", "vernacular"),
    (r"^\s*caustic\s*soda\s*$", "sodium hydroxide", "name", "vernacular"),
    (r"^\s*caustic\s*potash\s*$", "potassium hydroxide", "name", "vernacular"),
    (r"^\s*soda\s*ash\s*$", "sodium carbonate", "name", "vernacular"),
    (r"^\s*isopropyl\s*alcohol\s*$", "isopropanol", "name", "synonym"),
    (r"^\s*denatured\s*alcohol\s*$", "ethanol", "name", "synonym"),
    (r"^\s*wood\s*alcohol\s*$", "methanol", "name", "vernacular"),
    (r"^\s*grain\s*alcohol\s*$", "ethanol", "name", "vernacular"),
    (r"^\s*tsp\s*$", "trisodium phosphate", "name", "synonym"),
    (r"^\s*mek\s*$", "78-93-3", "cas", "methyl ethyl ketone"),
    (r"^\s*mibk\s*$", "108-10-1", "cas", "methyl isobutyl ketone"),
    (r"^\s*dcm\s*$", "75-09-2", "cas", "dichloromethane"),
    (r"^\s*ipa\s*$", "isopropanol", "name", "abbrev"),
    (r"^\s*nmp\s*$", "1-Methyl-2-pyrrolidone", "name", "abbrev"),
    (r"^\s*hydrated\s+lime\s*$", "calcium hydroxide", "name", "common"),
    (r"^\s*aqua\s+ammonia\s*$", "ammonium hydroxide", "name", "common"),
]

# Chemical families (id, name, pattern, note).
FAMILIES = [
    (1, "Acids", "(acid|acetate|benzoate|citrate|tartrate|oxalate)", "organic/inorganic acids & salts"),
    (2, "Bases", "(hydroxide|amine|ammonia|ammonium)", "bases"),
    (3, "Alcohols", "(alcohol|anol|ethanol|isopropanol|methanol|butanol|propanol)", "alcohols"),
    (4, "Ketones", "(ketone|methyl ethyl ketone|mek|acetone)", "ketones"),
    (5, "Glycols", "(glycol|ethylene glycol|propylene glycol|peg)", "glycols"),
    (6, "Aromatics", "(benzene|toluene|xylene|cumene|styrene|phenol)", "aromatic HC"),
    (7, "Halogenated", "(chloride|chloro|bromo|iodo|dichloro|trichloro|methylene chloride|dcm)", "halogenated"),
    (8, "Inorganics", "(sulfate|carbonate|bicarbonate|phosphate|silicate|nitrate|nitrite|bromide|iodide)", "inorganic salts"),
    (9, "Hydrocarbons", "(mineral spirits|stoddard|heptane|hexane|naphtha|white spirit)", "aliphatic HC"),
]

# Safety-sheet codes and words.
H_CODE = r"\bH[0-9]{3}[A-Z]?\b"
P_CODE = r"\bP[0-9]{3}[A-Z]?(?:\+P[0-9]{3}[A-Z]?)?\b"
SIGNAL_WORD = r"(?i)\b(DANGER|WARNING)\b"
SECTION_TAG = r"(?i)\bSECTION" + WS + r"*[0-9]+\b"
CONCENTRATION = (
    r"(?:([0-9]+(?:\.[0-9]+)?)" + WS + r"*(?:-|to|–)" + WS + r"*([0-9]+(?:\.[0-9]+)?))" + WS + r"*%"
    r"|\b([0-9]+(?:\.[0-9]+)?)" + WS + r"*%"
)
NAME_EDGE_CHARS = r"[ ,;:-]+"

# Names of the sixteen section columns, in order.
SECTION_COLUMNS = [
    "s1_identification", "s2_hazards", "s3_composition", "s4_first_aid", "s5_fire_fighting",
    "s6_accidental_release", "s7_handling_storage", "s8_exposure_ppe", "s9_physical_chemical",
    "s10_stability_reactivity", "s11_toxicology", "s12_ecology", "s13_disposal",
    "s14_transport", "s15_regulatory", "s16_other",
]

# Staging column maps, target <- source.
ITEM_COLUMNS = {
    "sku": "ItemNo", "name": "ItemName", "description": "Description", "cas": "CAS",
    "brand": "Brand", "family": "Family", "vendor": "Vendor",
}
CUSTOMER_COLUMNS = {
    "customer_code": "CustomerCode", "name": "CustomerName", "segment": "Segment", "region": "Region",
}
SALES_COLUMNS = {
    "tx_date": "Date", "customer_code": "CustomerCode", "sku": "ItemNo", "qty": "Qty", "revenue": "Revenue",
}
# Where an empty staging column is filled from, in order of preference.
BACKFILL_KEYS = {
    "name": ["Display Name", "Name"],
    "sku": ["Name", "Internal ID"],
    "description": ["Description"],
    "cas": ["CAS", "CAS No", "CAS Number", "CAS#"],
}
# Columns of a compound result file.
RESULT_COLUMNS = [
    "query_name", "query_hint", "source_item_id", "CID", "Title", "IUPACName", "MolecularFormula",
    "MolecularWeight", "CanonicalSMILES", "InChI", "InChIKey", "Synonyms",
]

# Confidences and limits.
SOURCE_COMPOUND = "pubchem"
CONF_RESULT_FILE = 0.99
CONF_DOCUMENT = 0.97
CONF_STREAM = 0.95
CONF_FAMILY_NAME = 0.85
CONF_FAMILY_REGISTRY = 0.8
FUZZY_THRESHOLD = 0.45
MIN_QUERY_LEN, MAX_QUERY_LEN = 3, 200
MIN_WEIGHT, MAX_WEIGHT = 1.0, 2000.0
MIN_PAGE_CHARS = 30
QUERIES_PER_ITEM = 3
