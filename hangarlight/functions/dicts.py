"""Fixed values that results depend on: word lists, needles and constants, in natural order."""

# Legal suffixes that do not change which entity a name refers to.
LEGAL_SUFFIXES = (
    "INCORPORATED", "CORPORATION", "COMPANY", "LIMITED", "TRUSTEE", "TRUST", "LLC", "L L C", "LLP", "LP",
    "PLC", "PC", "PA", "NA", "N A", "INC", "CORP", "CO", "LTD", "THE",
)

# Generic aviation tokens, generic words, and identity suffixes of names.
GENERIC_TOKENS = ("AVIATION", "AIRCRAFT", "AIRPLANE", "AIR", "AERO", "LEASING", "LEASE", "SERVICES", "SERVICE", "SALES")
GENERIC_WORDS = ("WINGS", "STAR", "CAPITAL", "MANAGEMENT", "INTERNATIONAL")
IDENTITY_SUFFIXES = ("HOLDING", "HOLDINGS", "GROUP", "PARTNERS", "PARTNERSHIP")

# Ordered street abbreviations.
STREET_WORDS = (
    (" STREET", " ST"), (" AVENUE", " AVE"), (" BOULEVARD", " BLVD"), (" DRIVE", " DR"), (" ROAD", " RD"), (" LANE", " LN"),
    (" PARKWAY", " PKWY"), (" SUITE", " "), (" STE", " "), (" FLOOR", " "), (" FL", " "),
)

# Registrants that are trustees, fractional operators or scheduled airlines.
TRUSTEE_NEEDLES = (
    "TRUSTEE", "OWNER TRUST", "AIRCRAFT TRUST", "BANK OF UTAH", "WILMINGTON TRUST", "TVPX", "WELLS FARGO BANK NORTHWEST",
    "WELLS FARGO TRUST", "US BANK TRUST", "U.S. BANK TRUST", "UMB BANK", "BANK OF OKLAHOMA", "BOKF", "FIRST SECURITY BANK",
)
FRACTIONAL_NEEDLES = (
    "NETJETS", "FLEXJET", "VISTAJET", "VISTA JET", "WHEELS UP", "PLANESENSE", "PLANE SENSE", "FLIGHT OPTIONS", "CITATIONSHARES",
    "CITATION SHARES", "DIRECTIONAL AVIATION", "NICHOLAS AIR", "JET LINX", "JETLINX", "SOLAIRUS", "EXECUTIVE JET", "AIRSHARE", "NJASPE",
)
AIRLINE_NEEDLES = (
    "AMERICAN AIRLINES", "DELTA AIR LINES", "DELTA AIRLINES", "UNITED AIRLINES", "SOUTHWEST AIRLINES", "JETBLUE", "ALASKA AIRLINES",
    "SPIRIT AIRLINES", "FRONTIER AIRLINES", "HAWAIIAN AIRLINES", "SKYWEST", "FEDERAL EXPRESS", "FEDEX CORPORATION", "FEDEX CORP",
    "UNITED PARCEL", "ENVOY AIR", "REPUBLIC AIRWAYS", "REPUBLIC AIRLINE", "MESA AIRLINES", "ALLEGIANT AIR", "SUN COUNTRY", "ATLAS AIR",
    "KALITTA", "HORIZON AIR", "PSA AIRLINES", "ENDEAVOR AIR", "AIR WISCONSIN", "COMMUTEAIR", "GOJET", "PIEDMONT AIRLINES", "AMERIFLIGHT",
    "ABX AIR", "POLAR AIR", "BREEZE AVIATION", "JETBLUE AIRWAYS",
)

# Airframes of corporate aviation.
TURBINE_ENGINES = ("2", "3", "4", "5")
CORPORATE_AIRFRAMES = ("5", "6")
MANUFACTURER_NEEDLES = (
    "GULFSTREAM", "BOMBARDIER", "CANADAIR", "LEARJET", "DASSAULT", "FALCON", "EMBRAER", "CESSNA", "TEXTRON", "HAWKER", "BEECHCRAFT",
    "BEECH", "PILATUS", "HONDA", "ECLIPSE", "CIRRUS", "IAI", "ISRAEL", "SABRELINER", "MITSUBISHI", "PIAGGIO", "SOCATA", "DAHER",
    "BRITISH AEROSPACE", "BAE", "WESTWIND", "ASTRA", "SIKORSKY", "LEONARDO", "AGUSTA", "AIRBUS HELICOPTER", "EUROCOPTER", "BELL",
    "BOEING", "AIRBUS",
)
AIRLINER_NEEDLES = (
    "737", "747", "757", "767", "777", "787", "A318", "A319", "A320", "A321", "A330", "A340", "A350", "A380", "ERJ", "E170", "E175",
    "E190", "E195", "CRJ", "MD-80", "MD-90", "DC-9", "A220",
)
AIRLINER_EXEMPT = ("BBJ", "ACJ", "BUSINESS", "VIP", "LINEAGE", "PRESTIGE", "PHENOM", "PRAETOR", "LEGACY")

# Exchanges that outrank others for a company's primary listing.
MAJOR_EXCHANGES = ("NYSE", "NASDAQ", "NYSE ARCA", "NYSE AMERICAN", "NYSE MKT", "AMEX")

# Match methods.
MANUAL_OVERRIDE = "manual_override"
EDGAR_NNUMBER = "edgar_nnumber"
FCC_LICENSEE_EXACT = "fcc_licensee_exact"
EXACT_LEGAL_NAME = "exact_legal_name"
EX21_SUBSIDIARY = "ex21_subsidiary"
ADDRESS_CLUSTER = "address_cluster"

# Strata of the rubric.
RUBRIC_STRATA = ("identity_easy", "identity_hard", "subsidiary_tp", "subsidiary_hold", "vanity", "filing", "namesake", "not_our_join")

# Filing text extraction.
N_NUMBER_PATTERN = r"\bN[1-9][0-9A-Z]{2,4}\b"
FILING_KEYWORDS = (
    "corporate aircraft", "corporate jet", "time-sharing", "timesharing", "dry lease", "aggregate incremental cost", "gulfstream",
    "bombardier", "dassault", "falcon", "citation", "personal use of the company", "aviation", "aircraft", "n-number", "tail number",
)
SKIPPED_FILES = (".jpg", ".jpeg", ".png", ".gif", ".svg", ".pdf", ".zip", ".xsd", ".xml", ".js", ".css")
SNIPPET_MARGIN, KEYWORD_MARGIN = 180, 800

# Publication floors.
MASTER_FLOOR = 300_000
SMALL_FEED = 50

# What index pages of filings and display names of filers look like.
INDEX_ROW = r'(?i)<td scope="row">(\d+)</td>\s*<td scope="row">[^<]*</td>\s*<td scope="row"><a href="(?:/ix\?doc=)?(/Archives/edgar/data/\d+/\d+/[^"]+)"'
VIEWER_LINK = r"""(?i)ix\?doc=(/Archives/edgar/data/\d+/\d+/[^&"']+\.(?:htm|html))"""
PAGE_LINK = r'(?i)href="(/Archives/edgar/data/\d+/\d+/[^"]+\.(?:htm|html))"'
TICKER_IN_NAME = r"\(([A-Z][A-Z0-9.\-]{0,6})\)"
