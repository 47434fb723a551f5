"""Explicit schemas of the domain tables. Missing text is the empty string, not null."""

AIRCRAFT_COLUMNS = (
    "n_number", "serial", "type_registrant", "registrant_name", "street", "city", "state",
    "type_aircraft", "type_engine", "status_code", "icao24", "make", "model",
)
AIRCRAFT = ", ".join(f"{c} string" for c in AIRCRAFT_COLUMNS) + ", fractional_owner boolean"
COMPANY = "cik string, ticker string, name string, exchange string, street string, city string, state string, former_names array<string>, ord long"
SUBSIDIARY_COLUMNS = ("parent_cik", "parent_name", "subsidiary_name", "parent_street", "parent_city", "parent_state")
ADDRESS = "cik string, street string, city string, state string, former_names array<string>"
EDGAR_HIT = (
    "cik string, ticker string, accession string, form string, n_number string, snippet string, filing_url string, keyword_hit boolean"
)
LICENCE = "n_number string, licensee_name string, uls_id string"
OVERRIDE = "n_number string, ticker string, cik string, company_name string, citation string, ord long"
ALIAS = "cik string, name string, ticker string, citation string, ord long"
GOLD_COMPANY = "ticker string, cik string, company_name string, registrant_names array<string>, ord long"
FORBIDDEN = "n_number string, must_not_ticker string, citation string, ord long"
RUBRIC = "n_number string, ticker string, must_not_ticker string, stratum string, split string, citation string, ord long"
MAPPING_COLUMNS = (
    "n_number", "icao24", "serial", "make", "model", "ticker", "cik", "company_name", "registrant_name",
    "match_method", "as_of_date", "source_url", "fleet_size", "aviation_issuer",
)
CURRENT = (
    ", ".join(f"{c} string" for c in MAPPING_COLUMNS[:12]) + ", fleet_size long, aviation_issuer boolean, deleted_at long"
)
REVIEW_COLUMNS = MAPPING_COLUMNS[:12]
CHANGELOG = "as_of_date string, n_number string, change string, detail string"
RUN = "as_of_date string, recorded_at string"
TRUST_COLUMNS = ("n_number", "icao24", "make", "model", "registrant_name", "reason", "as_of_date")
