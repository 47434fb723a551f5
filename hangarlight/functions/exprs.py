"""Canonical keys, classification and corroboration as pure Column expressions (whole-stage codegen, no UDF)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import dicts as D


def any_needle(text: Column, needles) -> Column:
    """Substring test against a fixed list, as one alternation."""
    return text.rlike("|".join(re.escape(n) for n in needles))


# -- keys ------------------------------------------------------------------------------------------


def canonical_n_number(x: Column) -> Column:
    bare = F.regexp_replace(F.upper(F.trim(x)), "[- .]", "")
    return F.regexp_replace(bare, "^(?=[^N])", "N")


def canonical_icao24(x: Column) -> Column:
    return F.lower(F.trim(x))


def pad_cik(x: Column) -> Column:
    """Digits, padded with zeros to at least 10; longer ones stay whole."""
    led = F.concat(F.lit("0" * 10), F.regexp_replace(x, "[^0-9]", ""))
    return F.regexp_replace(led, "^0{0,10}(?=.{10})", "")


def normalize_name(raw: Column) -> Column:
    """Upper case, ampersand and plus as AND, other non-alphanumerics as one space; then leading THE and
    trailing legal suffixes go, repeatedly. A name that is nothing but a suffix becomes empty."""
    upper = F.regexp_replace(F.upper(raw), "[&+]", " AND ")
    plain = F.trim(F.regexp_replace(upper, "[^A-Z0-9]+", " "))
    suffixes = "|".join(D.LEGAL_SUFFIXES)
    cut = F.regexp_replace(F.regexp_replace(plain, "^(?:THE )+", ""), f"(?: (?:{suffixes}))+$", "")
    return F.regexp_replace(cut, f"^(?:{suffixes})$", "")


def normalize_street(raw: Column) -> Column:
    out = normalize_name(raw)
    for word, short in D.STREET_WORDS:
        out = F.replace(out, F.lit(word), F.lit(short))
    return F.trim(F.regexp_replace(out, " +", " "))


def normalize_address(street: Column, city: Column, state: Column) -> Column:
    """street|city|STATE; empty without a street or a city. Normalised parts hold no bar of their own."""
    whole = F.concat_ws("|", normalize_street(street), normalize_name(city), F.upper(F.trim(state)))
    return F.regexp_replace(whole, r"(?s)^(?:\|.*|[^|]*\|\|.*)$", "")


def is_calendar_day(x: Column) -> Column:
    """A strict YYYY-MM-DD day."""
    return F.coalesce(x.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(x, "yyyy-MM-dd").isNotNull(), F.lit(False))


def is_utc_instant(x: Column) -> Column:
    """A strict YYYY-MM-DDTHH:MM:SSZ instant."""
    shaped = x.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$")
    return F.coalesce(shaped & F.try_to_timestamp(x, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")).isNotNull(), F.lit(False))


# -- listings --------------------------------------------------------------------------------------


def preferred_or_warrant(ticker: Column) -> Column:
    t = F.upper(F.trim(ticker))
    series = (F.length(t) >= 5) & ~t.rlike("[-.]") & t.rlike("[POW]$")
    return t.rlike("^[^-]*-[PW]") | series


def major_exchange(exchange: Column) -> Column:
    return F.upper(F.trim(exchange)).isin(*D.MAJOR_EXCHANGES)


# -- airframes and registrants ---------------------------------------------------------------------


def is_scheduled_airliner(make_model: Column) -> Column:
    return ~any_needle(make_model, D.AIRLINER_EXEMPT) & any_needle(make_model, D.AIRLINER_NEEDLES)


def corporate_reason(a) -> Column:
    """Why an aircraft is outside corporate aviation; null if it is inside. ``a``: column getter."""
    engine, airframe = F.trim(a("type_engine")), F.trim(a("type_aircraft"))
    blob = F.upper(F.concat(a("make"), F.lit(" "), a("model")))
    jet = engine.isin("4", "5") & (airframe == "5")
    return (
        F.when(~F.upper(F.trim(a("status_code"))).eqNullSafe("V"), "invalid_status")
        .when(F.trim(a("type_registrant")) == "1", "individual")
        .when(~engine.isin(*D.TURBINE_ENGINES), "not_turbine")
        .when(~airframe.isin(*D.CORPORATE_AIRFRAMES), "not_multi_or_rotor")
        .when(is_scheduled_airliner(blob), "airliner_type")
        .when(~(any_needle(blob, D.MANUFACTURER_NEEDLES) | jet), "manufacturer")
    )


def census_reason(a) -> Column:
    """The census's shorter chain: neither status nor manufacturer."""
    blob = F.upper(F.concat(a("make"), F.lit(" "), a("model")))
    return (
        F.when(F.trim(a("type_registrant")) == "1", "individual")
        .when(~F.trim(a("type_engine")).isin(*D.TURBINE_ENGINES), "not_turbine")
        .when(~F.trim(a("type_aircraft")).isin(*D.CORPORATE_AIRFRAMES), "not_multi_or_rotor")
        .when(is_scheduled_airliner(blob), "airliner_type")
    )


def classify_registrant(name: Column, individual: Column, fractional_owner: Column) -> Column:
    n = F.upper(name)
    return (
        F.when(individual, "individual")
        .when(fractional_owner, "faa_fractional_flag")
        .when(any_needle(n, D.TRUSTEE_NEEDLES), "trustee")
        .when(any_needle(n, D.FRACTIONAL_NEEDLES), "fractional")
        .when(any_needle(n, D.AIRLINE_NEEDLES), "airline")
        .otherwise("eligible")
    )


# -- corroboration ---------------------------------------------------------------------------------


def name_tokens(norm: Column) -> Column:
    """Tokens of a normalised name without the generic aviation ones; [] for an empty name."""
    return F.filter(F.split(norm, " "), lambda t: (t != "") & ~t.isin(*D.GENERIC_TOKENS))


def distinctive_core(norm: Column) -> Column:
    return F.array_join(name_tokens(norm), " ")


def alnum_only(x: Column) -> Column:
    return F.regexp_replace(x, "[^A-Za-z0-9]", "")


def ex21_indexable(norm: Column) -> Column:
    return F.length(alnum_only(distinctive_core(norm))) >= 4


def looks_like_n_number_token(token: Column) -> Column:
    return token.rlike("^N(?=.*[0-9])[0-9A-Za-z]{2,5}$")


def overlap_token_ok(token: Column) -> Column:
    return (F.length(token) >= 4) & ~token.isin(*D.IDENTITY_SUFFIXES, *D.GENERIC_WORDS)


def consecutive_tokens_match_parent(tokens: Column, parent_alnum: Column) -> Column:
    """Some run of consecutive tokens spells the parent, and no identity suffix is left outside it."""
    places = F.when(F.size(tokens) > 0, F.sequence(F.lit(1), F.size(tokens))).otherwise(F.array().cast("array<int>"))

    def run_matches(i, j):
        spelled = F.array_join(F.slice(tokens, i, j - i + 1), "") == parent_alnum
        left = F.concat(F.slice(tokens, F.lit(1), i - 1), F.slice(tokens, j + 1, F.size(tokens)))
        return (j >= i) & spelled & ~F.exists(left, lambda t: t.isin(*D.IDENTITY_SUFFIXES))

    return (F.length(parent_alnum) >= 4) & F.exists(places, lambda i: F.exists(places, lambda j: run_matches(i, F.greatest(i, j))))


def has_extra_identity_suffix(tokens: Column, parent_tokens: Column) -> Column:
    return F.exists(tokens, lambda t: t.isin(*D.IDENTITY_SUFFIXES) & ~F.array_contains(parent_tokens, t))


def name_match_corroborated(norm: Column, parent_name: Column, ticker: Column) -> Column:
    """Whether an exact-key hit is strong enough to publish; the order of the tests is part of the rule.

    The token lists are bound once, as the fields of a one-row array, and the tests read them from there.
    """
    prepared = F.struct(
        name_tokens(norm).alias("tokens"),
        distinctive_core(norm).alias("core"),
        name_tokens(normalize_name(parent_name)).alias("parent_tokens"),
        alnum_only(distinctive_core(normalize_name(parent_name))).alias("parent"),
        F.upper(F.trim(ticker)).alias("ticker"),
    )
    return F.coalesce(F.get(F.transform(F.array(prepared), _corroborated), 0), F.lit(False))


def _corroborated(x: Column) -> Column:
    tokens, core, parent_tokens, parent, t = (x[k] for k in ("tokens", "core", "parent_tokens", "parent", "ticker"))
    core_alnum, t_alnum = alnum_only(core), alnum_only(t)
    named = (t != "") & ((core == t) | ((t_alnum != "") & (core_alnum == t_alnum)))
    token_hit = F.exists(tokens, lambda y: ((t != "") & (y == t)) | looks_like_n_number_token(y))
    shared = F.arrays_overlap(F.filter(tokens, overlap_token_ok), F.filter(parent_tokens, overlap_token_ok))
    return (
        F.when(core == "", False)
        .when(named, True)
        .when(token_hit, True)
        .when(has_extra_identity_suffix(tokens, parent_tokens), False)
        .when(consecutive_tokens_match_parent(tokens, parent), True)
        .when((F.length(core_alnum) >= 4) & parent.contains(core_alnum), True)
        .otherwise(shared)
    )
