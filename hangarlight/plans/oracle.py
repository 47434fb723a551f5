"""The comparison SQL for DuckDB: the same results, stated independently as window functions and lists."""

from __future__ import annotations

from ..functions import dicts as D
from ..operators.analytics import GENERIC_REGISTRANTS
from .universe import cte


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _any(text: str, needles) -> str:
    return "(" + " OR ".join(f"contains({text}, '{n}')" for n in needles) + ")"


def norm(x: str) -> str:
    plain = f"trim(regexp_replace(regexp_replace(upper({x}), '[&+]', ' AND ', 'g'), '[^A-Z0-9]+', ' ', 'g'))"
    cut = f"regexp_replace(regexp_replace({plain}, '^(THE )+', ''), '( ({'|'.join(D.LEGAL_SUFFIXES)}))+$', '')"
    return f"(CASE WHEN {cut} IN {_in(D.LEGAL_SUFFIXES)} THEN '' ELSE {cut} END)"


def street(x: str) -> str:
    out = norm(x)
    for word, short in D.STREET_WORDS:
        out = f"replace({out}, '{word}', '{short}')"
    return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"


def address(s: str, c: str, state: str) -> str:
    return f"(CASE WHEN {street(s)} = '' OR {norm(c)} = '' THEN '' ELSE {street(s)} || '|' || {norm(c)} || '|' || upper(trim({state})) END)"


def canonical(x: str) -> str:
    bare = f"regexp_replace(upper(trim({x})), '[- .]', '', 'g')"
    return f"(CASE WHEN {bare} = '' OR {bare} LIKE 'N%' THEN {bare} ELSE 'N' || {bare} END)"


def padded(x: str) -> str:
    digits = f"regexp_replace({x}, '[^0-9]', '', 'g')"
    return f"(CASE WHEN length({digits}) >= 10 THEN {digits} ELSE lpad({digits}, 10, '0') END)"


def preferred(t: str) -> str:
    u = f"upper(trim({t}))"
    return f"(regexp_matches({u}, '^[^-]*-[PW]') OR (length({u}) >= 5 AND NOT regexp_matches({u}, '[-.]') AND regexp_matches({u}, '[POW]$')))"


def airliner(blob: str) -> str:
    return f"(NOT {_any(blob, D.AIRLINER_EXEMPT)} AND {_any(blob, D.AIRLINER_NEEDLES)})"


_BLOB = "upper(make || ' ' || model)"
CORPORATE = f"""CASE WHEN upper(trim(status_code)) <> 'V' THEN 'invalid_status' WHEN trim(type_registrant) = '1' THEN 'individual'
 WHEN trim(type_engine) NOT IN {_in(D.TURBINE_ENGINES)} THEN 'not_turbine' WHEN trim(type_aircraft) NOT IN {_in(D.CORPORATE_AIRFRAMES)} THEN 'not_multi_or_rotor'
 WHEN {airliner(_BLOB)} THEN 'airliner_type'
 WHEN NOT ({_any(_BLOB, D.MANUFACTURER_NEEDLES)} OR (trim(type_engine) IN ('4', '5') AND trim(type_aircraft) = '5')) THEN 'manufacturer' END"""
CENSUS = f"""CASE WHEN trim(type_registrant) = '1' THEN 'individual'
 WHEN trim(type_engine) NOT IN {_in(D.TURBINE_ENGINES)} THEN 'not_turbine' WHEN trim(type_aircraft) NOT IN {_in(D.CORPORATE_AIRFRAMES)} THEN 'not_multi_or_rotor'
 WHEN {airliner(_BLOB)} THEN 'airliner_type' END"""


def classify(name: str, individual: str = "false", fractional: str = "false") -> str:
    u = f"upper({name})"
    return f"""CASE WHEN {individual} THEN 'individual' WHEN {fractional} THEN 'faa_fractional_flag' WHEN {_any(u, D.TRUSTEE_NEEDLES)} THEN 'trustee'
 WHEN {_any(u, D.FRACTIONAL_NEEDLES)} THEN 'fractional' WHEN {_any(u, D.AIRLINE_NEEDLES)} THEN 'airline' ELSE 'eligible' END"""


CLASS = classify("registrant_name", "trim(type_registrant) = '1'", "fractional_owner")


def tokens(n: str) -> str:
    return f"list_filter(string_split({n}, ' '), lambda t: t <> '' AND t NOT IN {_in(D.GENERIC_TOKENS)})"


def core(n: str) -> str:
    return f"coalesce(array_to_string({tokens(n)}, ' '), '')"


def alnum(x: str) -> str:
    return f"regexp_replace({x}, '[^A-Za-z0-9]', '', 'g')"


def corroborated(tk: str, pt: str, ticker: str) -> str:
    """Over prepared columns: token lists of the key and of the parent, and the upper-cased ticker."""
    c, p = f"coalesce(array_to_string({tk}, ' '), '')", f"coalesce(array_to_string({pt}, ''), '')"
    ids, weak = _in(D.IDENTITY_SUFFIXES), _in((*D.IDENTITY_SUFFIXES, *D.GENERIC_WORDS))
    runs = f"""len(list_filter(range(1, len({tk}) + 1), lambda i: len(list_filter(range(i, len({tk}) + 1), lambda j:
      array_to_string(list_slice({tk}, i, j), '') = {p}
      AND len(list_filter(range(1, len({tk}) + 1), lambda m: (m < i OR m > j) AND {tk}[m] IN {ids})) = 0)) > 0)) > 0"""
    shared = f"list_has_any(list_filter({tk}, lambda t: length(t) >= 4 AND t NOT IN {weak}), list_filter({pt}, lambda t: length(t) >= 4 AND t NOT IN {weak}))"
    return f"""CASE WHEN {c} = '' THEN false
      WHEN {ticker} <> '' AND ({c} = {ticker} OR ({alnum(ticker)} <> '' AND {alnum(c)} = {alnum(ticker)})) THEN true
      WHEN len(list_filter({tk}, lambda t: ({ticker} <> '' AND t = {ticker}) OR (regexp_matches(t, '^N[0-9A-Z]{{2,5}}$') AND regexp_matches(t[2:], '[0-9]')))) > 0 THEN true
      WHEN len(list_filter({tk}, lambda t: t IN {ids} AND NOT list_contains({pt}, t))) > 0 THEN false
      WHEN length({p}) >= 4 AND {runs} THEN true
      WHEN length({alnum(c)}) >= 4 AND contains({p}, {alnum(c)}) THEN true
      ELSE {shared} END"""


BEST = f"""row_number() OVER (PARTITION BY cik ORDER BY regexp_matches(upper(trim(ticker)), '[-.]'), upper(trim(exchange)) NOT IN {_in(D.MAJOR_EXCHANGES)},
  {preferred('ticker')}, length(trim(ticker)), upper(trim(ticker)), ord)"""

LISTED = f"""{cte('aliases')},
filled AS (SELECT c.cik, c.ticker, c.name, c.exchange, CASE WHEN c.street = '' THEN coalesce(a.street, '') ELSE c.street END AS street,
  CASE WHEN c.street = '' THEN coalesce(a.city, '') ELSE c.city END AS city, CASE WHEN c.street = '' THEN coalesce(a.state, '') ELSE c.state END AS state,
  CASE WHEN c.former <> '' THEN [c.former] WHEN coalesce(a.former, '') <> '' THEN [a.former] ELSE []::VARCHAR[] END AS former_names, c.ord
  FROM companies_flat c LEFT JOIN addresses_flat a ON a.cik = c.cik),
alias_hits AS (SELECT DISTINCT f.ord AS c_ord, f.cik AS c_cik, f.ticker AS c_ticker, a.ord, a.name AS alias_name, {norm('a.name')} AS nk
  FROM filled f JOIN aliases a ON f.cik = a.cik OR (a.ticker <> '' AND upper(trim(f.ticker)) = upper(trim(a.ticker)))),
alias_new AS (SELECT c_ord, list(alias_name ORDER BY h.ord) AS added FROM alias_hits h JOIN filled f ON f.ord = h.c_ord
  WHERE nk <> '' AND NOT list_contains(list_transform(list_concat([f.name], f.former_names), lambda x: {norm('x')}), nk) GROUP BY c_ord),
companies AS (SELECT f.* REPLACE (CASE WHEN added IS NULL THEN former_names ELSE list_concat(former_names, added) END AS former_names) FROM filled f LEFT JOIN alias_new n ON n.c_ord = f.ord)"""

INDEXES = f"""{LISTED},
best AS (SELECT * FROM (SELECT *, {BEST} AS rn FROM companies) WHERE rn = 1),
prim AS (SELECT * FROM best WHERE NOT {preferred('ticker')}),
name_rows AS (SELECT DISTINCT {norm('n')} AS key, ticker, cik, name FROM (SELECT ticker, cik, name, unnest(list_concat([name], former_names)) AS n FROM prim)),
nidx AS (SELECT key, list_sort(list(DISTINCT ticker)) AS tickers, arg_min({{'ticker': ticker, 'cik': cik, 'name': name}}, cik || '|' || ticker) AS hit FROM name_rows WHERE key <> '' GROUP BY key),
SUBS_HERE,
sub_rows AS (SELECT DISTINCT {norm('subsidiary_name')} AS key, p.ticker, p.cik, p.name FROM subsidiaries s JOIN prim p ON p.cik = s.parent_cik),
sidx AS (SELECT key, list_sort(list(DISTINCT ticker)) AS tickers, arg_min({{'ticker': ticker, 'cik': cik, 'name': name}}, cik || '|' || ticker) AS hit FROM sub_rows
  WHERE key <> '' AND length({alnum(core('key'))}) >= 4 GROUP BY key),
addr_rows AS (SELECT {address('street', 'city', 'state')} AS key, ticker, cik, name FROM prim UNION
  SELECT {address('parent_street', 'parent_city', 'parent_state')}, p.ticker, p.cik, p.name FROM subsidiaries s JOIN prim p ON p.cik = s.parent_cik),
aidx AS (SELECT key, list_sort(list(DISTINCT ticker)) AS tickers, arg_min({{'ticker': ticker, 'cik': cik, 'name': name}}, cik || '|' || ticker) AS hit FROM addr_rows WHERE key <> '' GROUP BY key)"""
# One WITH list holds the whole universe; the listing tables come first in it.
INDEXES = INDEXES.replace(cte("aliases"), cte("feed_new")).replace("SUBS_HERE,\n", "")
LISTED = LISTED.replace(cte("aliases"), cte("feed_new"))

DECIDED = f"""{INDEXES},
corp AS (SELECT *, {CLASS} AS class, {norm('registrant_name')} AS nkey, {address('street', 'city', 'state')} AS akey FROM aircraft WHERE ({CORPORATE}) IS NULL),
ov AS (SELECT o.n_number, o.ticker, o.cik, coalesce(nullif(o.company_name, ''), p.name, '') AS name, o.citation FROM overrides o LEFT JOIN prim p ON p.cik = {padded('o.cik')}),
ed_rows AS (SELECT {canonical('h.n_number')} AS n_number, upper(coalesce(nullif(h.ticker, ''), p.ticker)) AS t, {padded('h.cik')} AS cik, coalesce(p.name, '') AS name, h.filing_url, h.ord
  FROM edgar_hits h LEFT JOIN prim p ON p.cik = {padded('h.cik')} WHERE keyword_hit),
ed AS (SELECT n_number, list_sort(list(DISTINCT t)) AS tickers, arg_min({{'ticker': t, 'cik': cik, 'name': name, 'url': filing_url}}, ord) AS hit FROM ed_rows
  WHERE t IS NOT NULL AND n_number IN (SELECT n_number FROM aircraft) GROUP BY n_number),
lic AS (SELECT l.n_number, l.uls_id, l.licensee_name, coalesce(n.tickers, s.tickers) AS tickers, CASE WHEN n.key IS NOT NULL THEN n.hit ELSE s.hit END AS hit, n.key IS NULL AS sub
  FROM (SELECT *, {norm('licensee_name')} AS key FROM licences WHERE ({classify('licensee_name')}) <> 'trustee') l LEFT JOIN nidx n ON n.key = l.key LEFT JOIN sidx s ON s.key = l.key
  WHERE coalesce(n.tickers, s.tickers) IS NOT NULL),
lic1 AS (SELECT *, first_value(CASE WHEN len(tickers) = 1 THEN tickers[1] END IGNORE NULLS) OVER (PARTITION BY n_number ORDER BY uls_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS ft FROM lic),
lic2 AS (SELECT n_number, arg_min({{'many': len(tickers) > 1, 'tickers': CASE WHEN len(tickers) > 1 THEN tickers ELSE list_sort([ft, tickers[1]]) END}}, uls_id) FILTER (WHERE len(tickers) > 1 OR tickers[1] <> ft) AS stop,
  arg_min({{'ticker': hit.ticker, 'cik': hit.cik, 'name': hit.name, 'uls_id': uls_id, 'sub': sub, 'licensee': licensee_name}}, uls_id) FILTER (WHERE len(tickers) = 1) AS one FROM lic1 GROUP BY n_number),
forb AS (SELECT n_number, upper(must_not_ticker) AS forbidden FROM unpublished),
j AS (SELECT c.*, ov.ticker AS o_t, ov.cik AS o_c, ov.name AS o_n, ov.citation AS o_s, ed.tickers AS e_ts, ed.hit AS e, lic2.stop AS l_stop, lic2.one AS l, forbidden,
   n.tickers AS n_ts, n.hit AS n, s.tickers AS s_ts, s.hit AS s, a.tickers AS a_ts, a.hit AS a,
   {tokens('c.nkey')} AS tk, {tokens(norm('s.hit.name'))} AS s_pt, {tokens(norm('lic2.one.licensee'))} AS l_tk, {tokens(norm('lic2.one.name'))} AS l_pt
  FROM corp c LEFT JOIN ov USING (n_number) LEFT JOIN ed USING (n_number) LEFT JOIN lic2 USING (n_number) LEFT JOIN forb USING (n_number)
   LEFT JOIN nidx n ON n.key = c.nkey LEFT JOIN sidx s ON s.key = c.nkey LEFT JOIN aidx a ON a.key = c.akey),
step AS (SELECT *, CASE WHEN class IN ('fractional', 'faa_fractional_flag', 'airline', 'individual') THEN 'excluded' WHEN o_t IS NOT NULL THEN 'override' WHEN len(e_ts) = 1 THEN 'edgar' WHEN len(e_ts) > 1 THEN 'edgar_many'
   WHEN class = 'trustee' AND l_stop IS NOT NULL THEN 'lic_many'
   WHEN class = 'trustee' AND l IS NOT NULL THEN CASE WHEN NOT l.sub OR ({corroborated('l_tk', 'l_pt', 'upper(trim(l.ticker))')}) THEN 'lic_ok' ELSE 'lic_hold' END
   WHEN class = 'trustee' THEN 'trustee' WHEN nkey = '' THEN 'empty_name' WHEN len(n_ts) = 1 THEN 'name' WHEN len(n_ts) > 1 THEN 'name_many'
   WHEN len(s_ts) = 1 THEN CASE WHEN ({corroborated('tk', 's_pt', 'upper(trim(s.ticker))')}) THEN 'sub_ok' ELSE 'sub_hold' END
   WHEN len(s_ts) > 1 THEN 'sub_many' WHEN len(a_ts) = 1 THEN 'addr' ELSE 'unmatched' END AS st FROM j),
d0 AS (SELECT *, CASE WHEN st IN ('override', 'edgar', 'lic_ok', 'name', 'sub_ok') THEN 'published' WHEN st IN ('lic_hold', 'sub_hold', 'addr') THEN 'review'
    WHEN st LIKE '%\\_many' ESCAPE '\\' THEN 'conflict' WHEN st = 'excluded' THEN 'excluded' ELSE 'unresolved' END AS d_dest,
   CASE WHEN st = 'override' THEN 'manual_override' WHEN st LIKE 'edgar%' THEN 'edgar_nnumber' WHEN st LIKE 'lic%' THEN 'fcc_licensee_exact' WHEN st LIKE 'name%' THEN 'exact_legal_name'
    WHEN st LIKE 'sub%' THEN 'ex21_subsidiary' WHEN st = 'addr' THEN 'address_cluster' END AS method,
   upper(CASE WHEN st = 'override' THEN o_t WHEN st = 'edgar' THEN e.ticker WHEN st IN ('lic_ok', 'lic_hold') THEN l.ticker WHEN st = 'name' THEN n.ticker WHEN st IN ('sub_ok', 'sub_hold') THEN s.ticker WHEN st = 'addr' THEN a.ticker END) AS d_ticker,
   CASE WHEN st = 'override' THEN o_c WHEN st = 'edgar' THEN e.cik WHEN st IN ('lic_ok', 'lic_hold') THEN l.cik WHEN st = 'name' THEN n.cik WHEN st IN ('sub_ok', 'sub_hold') THEN s.cik WHEN st = 'addr' THEN a.cik END AS d_cik,
   CASE WHEN st = 'override' THEN o_n WHEN st = 'edgar' THEN e.name WHEN st IN ('lic_ok', 'lic_hold') THEN l.name WHEN st = 'name' THEN n.name WHEN st IN ('sub_ok', 'sub_hold') THEN s.name WHEN st = 'addr' THEN a.name END AS company_name,
   CASE WHEN st = 'override' THEN o_s WHEN st = 'edgar' THEN CASE WHEN e.url <> '' THEN e.url ELSE 'registry' END WHEN st IN ('lic_ok', 'lic_hold') THEN 'fcc-uls-aircraft:' || l.uls_id
     WHEN st IN ('sub_ok', 'sub_hold') THEN 'pudl:exhibit21' WHEN st IN ('name', 'addr') THEN 'registry' END AS source_url,
   CASE st WHEN 'edgar_many' THEN e_ts WHEN 'lic_many' THEN l_stop.tickers WHEN 'name_many' THEN n_ts WHEN 'sub_many' THEN s_ts END AS d_tickers,
   CASE WHEN st IN ('trustee', 'empty_name', 'unmatched') THEN st END AS reason FROM step),
decided AS (SELECT *, CASE WHEN d_dest = 'published' AND forbidden = d_ticker THEN 'review' ELSE d_dest END AS dest FROM d0),
pub AS (SELECT n_number, icao24, serial, make, model, d_ticker AS ticker, d_cik AS cik, company_name, registrant_name, method AS match_method, '2026-09-01' AS as_of_date, source_url,
  count(*) OVER (PARTITION BY d_ticker) AS fleet_size, d_ticker IN ('TAAA', 'TEAA') OR contains(upper(registrant_name), 'RING') AS aviation_issuer FROM decided WHERE dest = 'published'),
rev AS (SELECT n_number, icao24, serial, make, model, d_ticker AS ticker, d_cik AS cik, company_name, registrant_name, method AS match_method, '2026-09-01' AS as_of_date, source_url FROM decided WHERE dest = 'review'),
trusts AS (SELECT n_number, icao24, make, model, registrant_name, reason FROM decided WHERE dest = 'unresolved' AND reason = 'trustee')"""

FEED = f"""{cte('feed_new')},
o AS (SELECT 'N' || o_custkey AS n_number, ticker, lpad(cast(o_custkey % 7 AS VARCHAR), 10, '0') AS cik, 'exact_legal_name' AS match_method, 'OWNER ' || o_custkey || CASE WHEN o_custkey % 50 = 0 THEN o_orderstatus ELSE '' END AS registrant_name,
  CASE WHEN o_custkey % 40 = 0 THEN 1700000000 END::BIGINT AS deleted_at, 1::BIGINT AS fleet_size, '2026-08-31' AS as_of_date FROM feed_old WHERE rn = 1),
n AS (SELECT 'N' || o_custkey AS n_number, ticker, lpad(cast(o_custkey % 7 AS VARCHAR), 10, '0') AS cik, 'exact_legal_name' AS match_method, 'OWNER ' || o_custkey || CASE WHEN o_custkey % 50 = 0 THEN o_orderstatus ELSE '' END AS registrant_name,
  2::BIGINT AS fleet_size, '2026-09-01' AS as_of_date FROM feed_new WHERE rn = 1),
ch AS (SELECT coalesce(a.n_number, n.n_number) AS n_number, CASE WHEN n.n_number IS NULL THEN 'dropped' WHEN a.n_number IS NULL THEN 'new'
   WHEN a.ticker = n.ticker AND a.cik = n.cik AND a.match_method = n.match_method AND a.registrant_name = n.registrant_name THEN 'quiet' WHEN a.ticker <> n.ticker THEN 'owner_changed' ELSE 'updated' END AS change,
  a.ticker AS ot, a.match_method AS om, n.ticker AS nt, n.match_method AS nm, a.registrant_name AS oreg, n.registrant_name AS nreg, a.fleet_size AS ofl, n.fleet_size AS nfl, a.as_of_date AS oas, n.as_of_date AS nas
  FROM (SELECT * FROM o WHERE deleted_at IS NULL) a FULL JOIN n ON a.n_number = n.n_number),
clog AS (SELECT '2026-09-01' AS as_of_date, n_number, change, CASE change WHEN 'dropped' THEN ot || ' ' || om WHEN 'new' THEN nt || ' ' || nm ELSE ot || ' ' || om || ' -> ' || nt || ' ' || nm END AS detail FROM ch WHERE change <> 'quiet'),
cur AS (SELECT n_number, CASE WHEN change IN ('quiet', 'dropped') THEN ot ELSE nt END AS ticker, CASE WHEN change IN ('quiet', 'dropped') THEN oreg ELSE nreg END AS registrant_name,
  CASE WHEN change IN ('quiet', 'dropped') THEN ofl ELSE nfl END AS fleet_size, CASE WHEN change IN ('quiet', 'dropped') THEN oas ELSE nas END AS as_of_date, CASE WHEN change = 'dropped' THEN 1800000000 END::BIGINT AS deleted_at FROM ch
  UNION ALL SELECT n_number, ticker, registrant_name, fleet_size, as_of_date, deleted_at FROM o WHERE deleted_at IS NOT NULL AND n_number NOT IN (SELECT n_number FROM ch))"""

# The feed after two publications of its own: no row of the first day is deleted before the second.
TWO_DAYS = """day2 AS (SELECT coalesce(a.n_number, b.n_number) AS n_number, a.ticker AS ot,
  CASE WHEN b.n_number IS NULL THEN 'dropped' WHEN a.n_number IS NULL THEN 'new' WHEN a.ticker = b.ticker AND a.registrant_name = b.registrant_name THEN 'quiet' WHEN a.ticker <> b.ticker THEN 'owner_changed' ELSE 'updated' END AS change,
  CASE WHEN change IN ('quiet', 'dropped') THEN a.ticker ELSE b.ticker END AS ticker, CASE WHEN change IN ('quiet', 'dropped') THEN a.registrant_name ELSE b.registrant_name END AS registrant_name,
  CASE WHEN change IN ('quiet', 'dropped') THEN a.fleet_size ELSE b.fleet_size END AS fleet_size, CASE WHEN change IN ('quiet', 'dropped') THEN a.as_of_date ELSE b.as_of_date END AS as_of_date,
  CASE WHEN change = 'dropped' THEN 1800000000 END::BIGINT AS deleted_at FROM o a FULL JOIN n b ON a.n_number = b.n_number)"""

GOLD = f"""{DECIDED},
gold_names AS (SELECT upper(ticker) AS ticker, unnest(list_concat([registrant], CASE WHEN company_name <> '' THEN [company_name] ELSE [] END)) AS name, ord, generate_subscripts(list_concat([registrant], CASE WHEN company_name <> '' THEN [company_name] ELSE [] END), 1) AS k FROM gold_flat),
expected AS (SELECT {norm('name')} AS nk, arg_max(ticker, ord * 10 + k) AS expected FROM gold_names GROUP BY 1),
air AS (SELECT n_number, {norm('registrant_name')} AS ak, ({CORPORATE}) AS cr, ({CENSUS}) AS why, ({CLASS}) AS class FROM aircraft),
gh AS (SELECT a.n_number, expected, p.ticker AS got, nk, cr, class FROM air a JOIN expected e ON e.nk = ak LEFT JOIN pub p ON p.n_number = a.n_number)"""



# Whole documents with four mentions: every match with its place, snippet and wider surroundings.
SPLICED = """b AS (SELECT doc_id, coalesce(doc_id, 0) AS d, coalesce(text, '') AS body, length(coalesce(text, '')) AS n FROM documents),
            t AS (SELECT doc_id, ' The corporate aircraft N' || (100 + d % 900) || ' ' || substr(body, 1, n // 4) || ' dry lease of N' || (3000 + d % 6000) || ' ' || substr(body, n // 4 + 1, n // 2 - n // 4)
              || ' bond series N' || (10000 + d % 80000) || ' ' || substr(body, n // 2 + 1, n - n // 2) || ' n-number N' || (2000 + d % 7) || ' ' AS text FROM b),
            r AS (SELECT row_number() OVER () AS k, *, regexp_extract_all(text, '\\bN[1-9][0-9A-Z]{2,4}\\b') AS ns, string_split_regex(text, '\\bN[1-9][0-9A-Z]{2,4}\\b') AS gaps FROM t),
            m AS (SELECT k, doc_id, text, unnest(range(1, len(ns) + 1)) AS i, unnest(ns) AS n_number, unnest(list_transform(gaps[1:len(ns)], lambda x: length(x))) AS gap FROM r),
            p AS (SELECT doc_id, text, n_number, sum(gap + length(n_number)) OVER (PARTITION BY k ORDER BY i) - length(n_number) AS pos FROM m),
            s AS (SELECT doc_id, n_number, pos, trim(regexp_replace(substr(text, greatest(0, pos - 180)::BIGINT + 1, (pos + length(n_number) + 180 - greatest(0, pos - 180))::BIGINT), '[\\t-\\r ]+', ' ', 'g')) AS snippet,
              lower(substr(text, greatest(0, pos - 800)::BIGINT + 1, (pos + length(n_number) + 800 - greatest(0, pos - 800))::BIGINT)) AS wide FROM p)"""


def oracles() -> dict[str, str]:
    arr = lambda c: f"coalesce(array_to_string({c}, '|'), '')"
    hit = "hit.ticker AS ticker, hit.cik AS cik"
    reasons = f"""WITH {GOLD}, k AS (SELECT upper(ticker) AS ticker, cik, registrant AS name, {norm('registrant')} AS nk FROM gold_flat)
            SELECT k.ticker, k.cik, k.name, a.n_number, CASE WHEN why IS NOT NULL THEN 'airframe:' || why WHEN class <> 'eligible' THEN 'class:' || class WHEN u.must_not_ticker = k.ticker THEN 'unpublished_suppress'
              WHEN p.ticker = k.ticker THEN 'already_published_same_ticker' WHEN p.ticker IS NOT NULL THEN 'published_other_ticker' WHEN r.n_number IS NOT NULL THEN 'review_queue' WHEN x.tickers = [k.ticker] THEN 'already_in_name_index' WHEN x.tickers IS NOT NULL THEN 'uniqueness_collision' ELSE 'addable' END AS reason
            FROM k JOIN air a ON ak = k.nk LEFT JOIN pub p ON p.n_number = a.n_number LEFT JOIN rev r ON r.n_number = a.n_number LEFT JOIN unpublished u ON u.n_number = a.n_number LEFT JOIN nidx x ON x.key = k.nk WHERE k.nk <> ''"""
    sample = f"""WITH {DECIDED}, r AS (SELECT n_number, match_method, row_number() OVER (PARTITION BY match_method ORDER BY md5('43:' || n_number), n_number) AS pick FROM pub)
            SELECT n_number, match_method, pick FROM r WHERE pick <= CASE match_method WHEN 'exact_legal_name' THEN 20 WHEN 'ex21_subsidiary' THEN 10 WHEN 'edgar_nnumber' THEN 15 ELSE 0 END"""
    near = _any("lower(snippet)", D.FILING_KEYWORDS) + " OR " + _any("wide", D.FILING_KEYWORDS)
    decoded = "replace(t, '&#39;', '''')"
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("nbsp", "\u00a0"), ("middot", "\u00b7"), ("copy", "\u00a9"), ("amp", "&")):
        decoded = f"regexp_replace({decoded}, '&{name};?', '{char}', 'g')"
    return {
        "normalize_names": f"WITH {cte('aircraft')} SELECT n_number, {norm('registrant_name')} AS norm, {core(norm('registrant_name'))} AS core FROM aircraft",
        "normalize_addresses": f"WITH {cte('aircraft')} SELECT n_number, {address('street', 'city', 'state')} AS address FROM aircraft",
        "canonical_keys": f"WITH {cte('edgar_hits')} SELECT ord, {canonical('n_number')} AS n_number, {padded('cik')} AS cik, lower(trim(accession)) AS icao24 FROM edgar_hits",
        "corporate_filter_reasons": f"WITH {cte('aircraft')} SELECT n_number, coalesce({CORPORATE}, '') AS reason FROM aircraft",
        "classify_registrants": f"WITH {cte('aircraft')} SELECT n_number, {CLASS} AS class FROM aircraft",
        "primary_listings": f"WITH {INDEXES} SELECT cik, ticker, name, exchange FROM prim",
        "omitted_preferred": f"WITH {INDEXES} SELECT cik, ticker FROM best WHERE {preferred('ticker')}",
        "fill_addresses": f"WITH {LISTED} SELECT ord, cik, ticker, street, city, state, {arr('former_names')} AS former_names FROM filled",
        "apply_aliases": f"WITH {LISTED} SELECT ord, cik, ticker, {arr('former_names')} AS former_names FROM companies",
        "name_index": f"WITH {INDEXES} SELECT key, {arr('tickers')} AS tickers, {hit} FROM nidx",
        "subsidiary_index": f"WITH {INDEXES} SELECT key, {arr('tickers')} AS tickers, {hit} FROM sidx",
        "address_index": f"WITH {INDEXES} SELECT key, {arr('tickers')} AS tickers, {hit} FROM aidx",
        "corroboration": f"""WITH {INDEXES}, m AS (SELECT s.key, s.hit.ticker AS ticker, {tokens('s.key')} AS tk, {tokens(norm('s.hit.name'))} AS pt FROM sidx s)
            SELECT key, ticker, ({corroborated('tk', 'pt', 'upper(trim(ticker))')}) AS corroborated FROM m""",
        "resolve_published": f"WITH {DECIDED} SELECT * EXCLUDE (fleet_size, aviation_issuer), fleet_size FROM pub",
        "resolve_review": f"WITH {DECIDED} SELECT * FROM rev",
        "resolve_conflicts": f"WITH {DECIDED} SELECT n_number, registrant_name, {arr('d_tickers')} AS tickers, method FROM decided WHERE dest = 'conflict'",
        "resolve_unresolved": f"WITH {DECIDED} SELECT n_number, icao24, make, model, registrant_name, reason, '2026-09-01' AS as_of_date FROM decided WHERE dest = 'unresolved'",
        "resolve_funnel": f"WITH {DECIDED} SELECT dest, coalesce(method, '') AS method, coalesce(reason, '') AS reason, count(*) AS n FROM decided GROUP BY ALL",
        "resolve_by_method": f"WITH {DECIDED} SELECT match_method, count(*) AS tails, count(DISTINCT ticker) AS tickers FROM pub GROUP BY 1",
        "aviation_issuer": f"WITH {DECIDED} SELECT n_number, ticker, aviation_issuer FROM pub",
        "flight_departments": f"WITH {DECIDED} SELECT n_number, ticker, fleet_size FROM pub WHERE NOT aviation_issuer AND fleet_size BETWEEN 1 AND 6",
        "scd_changelog": f"WITH {FEED} SELECT * FROM clog",
        "scd_current": f"WITH {FEED} SELECT * FROM cur",
        "scd_change_counts": f"WITH {FEED} SELECT change, count(*) AS n FROM ch GROUP BY change",
        "changelog_for_day": f"WITH {FEED} SELECT as_of_date, n_number, change, detail FROM clog WHERE as_of_date = '2026-09-01'",
        "lookup": f"WITH {FEED} SELECT n_number, ticker, registrant_name FROM cur WHERE deleted_at IS NULL AND n_number = 'N11'",
        "feed_after_two_days": f"WITH {FEED}, {TWO_DAYS} SELECT n_number, ticker, registrant_name, fleet_size, as_of_date, deleted_at FROM day2",
        "feed_change_records": f"""WITH {FEED}, {TWO_DAYS} SELECT 1::BIGINT AS version, 'mappings_current' AS source, 'I' AS op, n_number AS key, '2026-08-31' AS as_of_date, NULL::VARCHAR AS ticker_before,
              ticker, registrant_name, NULL::VARCHAR AS deleted_at, NULL::VARCHAR AS change, NULL::VARCHAR AS recorded_at FROM o
            UNION ALL SELECT 1, 'changelog', 'I', n_number, '2026-08-31', NULL, NULL, NULL, NULL, 'new', NULL FROM o
            UNION ALL SELECT 2, 'mappings_current', CASE change WHEN 'new' THEN 'I' ELSE 'U' END, n_number, '2026-09-01', ot, ticker, registrant_name, deleted_at::VARCHAR, NULL, NULL FROM day2 WHERE change <> 'quiet'
            UNION ALL SELECT 2, 'changelog', 'I', n_number, '2026-09-01', NULL, NULL, NULL, NULL, change, NULL FROM day2 WHERE change <> 'quiet'
            UNION ALL SELECT version, 'refresh_run', 'I', day, day, NULL, NULL, NULL, NULL, NULL, day || 'T06:00:00Z' FROM (VALUES (1, '2026-08-31'), (2, '2026-09-01')) AS r(version, day)""",
        "eval_gold": f"""WITH {GOLD}, g AS (SELECT count(*) AS faa_gold_name_hits, count(*) FILTER (WHERE got = expected) AS name_true_positives, count(*) FILTER (WHERE got <> expected) AS name_false_positives FROM gh),
            t AS (SELECT count(*) FILTER (WHERE a.n_number IS NOT NULL AND p.ticker IS NOT DISTINCT FROM upper(t.ticker)) AS tail_true_positives, count(*) FILTER (WHERE a.n_number IS NOT NULL AND p.ticker IS DISTINCT FROM upper(t.ticker)) AS tail_false_negatives,
              count(*) FILTER (WHERE a.n_number IS NULL) AS tail_skipped_missing_master FROM gold_tails t LEFT JOIN aircraft a USING (n_number) LEFT JOIN pub p USING (n_number)),
            b AS (SELECT count(*) FILTER (WHERE p.ticker = upper(u.must_not_ticker)) AS tail_false_positives, count(a.n_number) AS unpublished_in_master, count(*) FILTER (WHERE a.n_number IS NULL) AS unpublished_skipped_missing_master
              FROM unpublished u LEFT JOIN aircraft a USING (n_number) LEFT JOIN pub p USING (n_number))
            SELECT g.*, t.*, b.*, (SELECT count(*) FROM gold_flat) AS gold_companies, (SELECT count(*) FROM gold_tails) AS gold_tails, (SELECT count(*) FROM unpublished) AS gold_unpublished_tails, (SELECT count(*) FROM pub) AS published_rows, (SELECT count(*) FROM trusts) AS unresolved_trusts,
              CASE WHEN name_true_positives + name_false_positives = 0 THEN 1.0 ELSE name_true_positives / (name_true_positives + name_false_positives) END AS precision_name,
              CASE WHEN faa_gold_name_hits = 0 THEN 0.0 ELSE name_true_positives / faa_gold_name_hits END AS recall_name,
              CASE WHEN tail_true_positives + tail_false_negatives = 0 THEN 1.0 ELSE tail_true_positives / (tail_true_positives + tail_false_negatives) END AS recall_tails FROM g, t, b""",
        "eval_rubric": f"""WITH {DECIDED}, r AS (SELECT u.*, a.n_number IS NOT NULL AS im, p.ticker AS got FROM rubric u LEFT JOIN aircraft a USING (n_number) LEFT JOIN pub p USING (n_number) WHERE split = 'holdout' AND stratum <> 'not_our_join'),
            c AS (SELECT stratum, count(*) AS n, count(*) FILTER (WHERE NOT im) AS skipped_missing_master, count(*) FILTER (WHERE im AND ticker <> '' AND got = ticker) AS true_positives,
              count(*) FILTER (WHERE im AND ticker <> '' AND got IS DISTINCT FROM ticker) AS false_negatives, count(*) FILTER (WHERE im AND ticker = '' AND got = must_not_ticker) AS false_positives FROM r GROUP BY stratum)
            SELECT *, true_positives / nullif(true_positives + false_negatives, 0) AS recall, true_positives / nullif(true_positives + false_positives, 0) AS precision FROM c""",
        "scorecard_coverage": f"""WITH {DECIDED} SELECT 'all' AS kind, '' AS value, count(*) AS tails, count(DISTINCT ticker) AS tickers FROM pub HAVING count(*) > 0
            UNION ALL SELECT 'method', match_method, count(*), count(DISTINCT ticker) FROM pub GROUP BY 2 UNION ALL SELECT 'aviation_issuer', aviation_issuer::INT::VARCHAR, count(*), count(DISTINCT ticker) FROM pub GROUP BY 2""",
        "gold_miss_buckets": f"""WITH {GOLD}, gn AS (SELECT DISTINCT ticker, {norm('name')} AS nk FROM gold_names), gt AS (SELECT DISTINCT gn.ticker, a.n_number, why FROM gn JOIN air a ON ak = nk WHERE nk <> ''),
            m AS (SELECT ticker, count(*) AS master_n, count(*) FILTER (WHERE why IS NULL) AS ok FROM gt GROUP BY 1), pb AS (SELECT ticker, count(*) AS n FROM pub GROUP BY 1), rv AS (SELECT ticker, count(*) AS n FROM rev GROUP BY 1),
            tr AS (SELECT DISTINCT gn.ticker FROM gn JOIN trusts t ON {norm('t.registrant_name')} = nk OR (length(nk) >= 6 AND contains({norm('t.registrant_name')}, nk)) WHERE nk <> '')
            SELECT upper(g.ticker) AS ticker, CASE WHEN pb.n > 0 THEN 'published' WHEN rv.n > 0 THEN 'review_queue' WHEN ok > 0 THEN 'master_name_not_published' WHEN master_n > 0 THEN 'airframe_filtered' WHEN tr.ticker IS NOT NULL THEN 'trust_name_only' ELSE 'no_master_legal_name' END AS bucket,
              coalesce(pb.n, 0) AS published_tails, coalesce(rv.n, 0) AS review_n, coalesce(master_n, 0) AS master_n, coalesce(ok, 0) AS airframe_pass_n, coalesce(master_n, 0) - coalesce(ok, 0) AS airframe_fail_n
            FROM (SELECT DISTINCT ticker FROM gold_flat) g LEFT JOIN m ON m.ticker = upper(g.ticker) LEFT JOIN pb ON pb.ticker = upper(g.ticker) LEFT JOIN rv ON rv.ticker = upper(g.ticker) LEFT JOIN tr ON tr.ticker = upper(g.ticker)""",
        "name_precision": f"""WITH {GOLD}, x AS (SELECT count(*) AS hits, count(*) FILTER (WHERE got = expected) AS tp, count(*) FILTER (WHERE got <> expected) AS fp FROM gh WHERE cr IS NULL AND class = 'eligible' AND nk <> '')
            SELECT *, CASE WHEN tp + fp = 0 THEN 1.0 ELSE tp / (tp + fp) END AS precision FROM x""",
        "alias_reasons": reasons,
        "alias_candidates": f"SELECT ticker, upper(name) AS name, array_to_string(list_sort(list(DISTINCT n_number)), '|') AS tails FROM ({reasons}) WHERE reason = 'addable' GROUP BY ALL",
        "harvest_top_tickers": f"WITH {cte('edgar_hits')} SELECT ticker, count(*) AS n FROM edgar_hits WHERE ticker <> '' GROUP BY 1 ORDER BY n DESC, ticker LIMIT 15",
        "sample_addresses": f"WITH {cte('aircraft')}, picked AS ({sample}) SELECT n_number, match_method, street, city, state FROM picked LEFT JOIN aircraft USING (n_number)",
        "unpublished_fps": f"WITH {DECIDED} SELECT DISTINCT p.n_number, p.ticker FROM pub p JOIN rubric u ON u.n_number = p.n_number AND upper(u.must_not_ticker) = p.ticker",
        "harvest_stats": f"WITH {cte('edgar_hits')} SELECT n_number, count(DISTINCT cik) AS ciks, count(*) AS hits, count(DISTINCT cik) = 1 AS unique_cik FROM edgar_hits GROUP BY n_number",
        "top_tickers": f"WITH {DECIDED} SELECT ticker, count(*) AS n FROM pub GROUP BY 1 ORDER BY n DESC, ticker LIMIT 15",
        "stratified_sample": sample,
        "stress_sample": f"""WITH {DECIDED}, m AS (SELECT p.n_number, length(replace({core(norm('registrant_name'))}, ' ', '')) AS core_len, CASE WHEN {norm('registrant_name')} = '' THEN 0 ELSE len(string_split({norm('registrant_name')}, ' ')) END AS n_tokens,
              (upper(c.exchange) = 'OTC')::INT AS is_otc FROM pub p JOIN prim c ON c.cik = p.cik WHERE p.match_method <> 'edgar_nnumber') SELECT * FROM m ORDER BY core_len, n_tokens, is_otc, n_number LIMIT 10""",
        "review_default_verdicts": f"""WITH {DECIDED} SELECT r.n_number, coalesce(CASE WHEN o.n_number IS NOT NULL THEN 'operator_tp' END, CASE WHEN match_method = 'address_cluster' THEN 'hold_address_cluster' WHEN upper(registrant_name) IN {_in(GENERIC_REGISTRANTS)} THEN 'hold_generic_ex21'
              WHEN list_has_any(string_split(upper(registrant_name), ' '), ['HOLDING', 'HOLDINGS']) THEN 'hold_identity_suffix' ELSE 'hold_uncorroborated_ex21' END) AS verdict FROM rev r LEFT JOIN unpublished o ON o.n_number = r.n_number""",
        "verdict_merge": f"""WITH {DECIDED} SELECT match_method AS stratum, CASE WHEN u.n_number IS NOT NULL THEN 'namesake' ELSE 'true_positive' END AS verdict, count(*) AS n FROM pub p LEFT JOIN unpublished u ON u.n_number = p.n_number GROUP BY 1, 2""",
        "reopen_rule": f"WITH {DECIDED} SELECT dest AS reason, count(DISTINCT d_ticker) AS issuers, CASE WHEN count(DISTINCT d_ticker) >= 3 THEN 'REOPEN' ELSE 'KILLED' END AS verdict FROM decided GROUP BY 1",
        "validate_rubric": f"""WITH {cte('rubric')}, own AS (SELECT n_number, unnest(list_filter([CASE WHEN n_number = '' THEN 'missing n_number' END, CASE WHEN trim(citation) = '' THEN 'missing citation' END, CASE WHEN split NOT IN ('train', 'holdout') THEN 'bad split' END,
              CASE WHEN stratum NOT IN {_in(D.RUBRIC_STRATA)} THEN 'unknown stratum' END, CASE WHEN stratum = 'not_our_join' AND (ticker <> '' OR must_not_ticker <> '') THEN 'not_our_join names a ticker' END,
              CASE WHEN stratum <> 'not_our_join' AND (ticker <> '') = (must_not_ticker <> '') THEN 'needs exactly one ticker' END], lambda x: x IS NOT NULL)) AS problem FROM rubric)
            SELECT * FROM own UNION ALL SELECT n_number, 'duplicate' FROM rubric GROUP BY 1 HAVING count(*) > 1
            UNION ALL SELECT CASE WHEN ticker <> '' THEN ticker ELSE must_not_ticker END, 'more than 2 tails' FROM rubric WHERE ticker <> '' OR must_not_ticker <> '' GROUP BY 1 HAVING count(*) > 2""",
        "edgar_extract": f"WITH {cte('aircraft')}, {SPLICED} SELECT doc_id, n_number, pos::INTEGER AS pos, snippet FROM s WHERE n_number IN (SELECT n_number FROM aircraft) AND ({near})",
        "edgar_extract_documents": f"WITH {SPLICED} SELECT doc_id, n_number, pos::INTEGER AS pos, snippet FROM s WHERE {near}",
        # The references that the pages hold; those of old names count without a semicolon too. Ampersands come last, so each is decoded once.
        "html_plain_text": f"SELECT page_id, length(t) AS n_chars, md5({decoded}) AS text_md5 FROM (SELECT page_id, regexp_replace(html, '<[^>]+>', ' ', 'g') AS t FROM pages)",
        "keyword_documents": f"SELECT doc_id, {_any('lower(text)', D.FILING_KEYWORDS)} AS keyword FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)",
        "valid_dates": """SELECT o_orderkey, true AS day_ok, false AS slash_ok, true AS instant_ok FROM orders""",
    }
