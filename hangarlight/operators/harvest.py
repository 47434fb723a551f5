"""Registration numbers in filing texts: plain text, matches with snippets, file rules and index pages."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dicts as D
from ..functions.entities import unescape
from ..functions.exprs import any_needle

ARCHIVE = "https://www.sec.gov"
#: Characters of a block of a text, which is searched in one step.
BLOCK = 1024
#: Characters before a block and after it that decide where a word of it starts and ends.
BEFORE, AFTER = 64, 7


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, "<[^>]+>", " ")


def to_plain_text(html: Column) -> Column:
    """Tags become blanks, then all character references are decoded once; script and style text stays."""
    return unescape(strip_tags(html))


def decode(raw: Column) -> Column:
    """Bytes as UTF-8 text, with invalid sequences left out; from texts that have any, written U+FFFD go too."""
    text = raw.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.replace(F.make_valid_utf8(text), F.lit("�"), F.lit("")))


def keyword_hit(text: Column) -> Column:
    return any_needle(F.lower(text), D.FILING_KEYWORDS)


def _matches(window: Column, before: Column, size: Column) -> Column:
    """n_number and at (in ``window``) of the matches that start in its ``size`` characters after ``before``."""
    low = F.greatest(before - BEFORE, F.lit(0))
    text = F.substring(window, low + 1, before - low + size + AFTER)
    found, gaps = F.regexp_extract_all(text, F.lit(f"({D.N_NUMBER_PATTERN})"), F.lit(1)), F.split(text, D.N_NUMBER_PATTERN, -1)
    walked = F.aggregate(
        F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda n, gap: F.struct(n.alias("n"), F.length(gap).alias("gap"))),
        F.struct(low.alias("pos"), F.array().cast("array<struct<n:string,at:int>>").alias("out")),
        # At most a quarter of BLOCK matches lie in a window, so appending is cheap.
        lambda acc, x: F.struct(
            (acc["pos"] + x["gap"] + F.length(x["n"])).alias("pos"), F.array_append(acc["out"], F.struct(x["n"].alias("n"), (acc["pos"] + x["gap"]).alias("at"))).alias("out")
        ),
    )["out"]
    return F.filter(walked, lambda m: (m["at"] >= before) & (m["at"] < before + size))


def extract_hits(texts: DataFrame, allow: DataFrame | None = None) -> DataFrame:
    """doc_id, n_number, pos, snippet for each registration number with a filing keyword nearby.

    ``texts`` has doc_id and plain text. A text is cut into blocks; a block in which a number may start goes on with the
    ends of its neighbours, as wide as the margins, as a row of its own. Offsets, snippets and keyword tests are made
    inside such a row, so the work grows in proportion to the text and to its matches, and no text is
    copied. Whether a word starts is decided by the ``BEFORE`` characters before it.
    """
    margin = D.KEYWORD_MARGIN
    if not AFTER + margin <= BLOCK:
        raise ValueError("a block must be wider than the margins")
    found = texts.filter(F.col("text").rlike(D.N_NUMBER_PATTERN))
    blocks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def window(block: Column, k: Column) -> Column:
        head = F.coalesce(F.get("blocks", k - 1), F.lit(""))
        before = F.substring(head, F.greatest(F.length(head) - margin, F.lit(0)) + 1, F.lit(margin))
        after = F.substring(F.coalesce(F.get("blocks", k + 1), F.lit("")), 1, AFTER + margin)
        near = F.concat(F.substring(before, F.greatest(F.length(before) - BEFORE, F.lit(0)) + 1, F.lit(BEFORE)), block, F.substring(after, 1, AFTER))
        row = F.struct((k * BLOCK).alias("base"), F.length(before).alias("before"), F.length(block).alias("size"), F.concat(before, block, after).alias("text"))
        return F.when(near.rlike(D.N_NUMBER_PATTERN), row)

    windows = F.filter(F.transform("blocks", window), lambda w: w.isNotNull())
    rows = found.withColumn("blocks", blocks).select("doc_id", F.explode(windows).alias("w"))

    def cut(m: Column) -> Column:
        def around(wide: int) -> Column:
            low = F.greatest(m["at"] - wide, F.lit(0))
            return F.substring(F.col("w.text"), low + 1, m["at"] + F.length(m["n"]) + wide - low)

        snippet = F.trim(F.regexp_replace(around(D.SNIPPET_MARGIN), r"\s+", " "))
        kept = keyword_hit(snippet) | keyword_hit(around(margin))
        pos = F.col("w.base") - F.col("w.before") + m["at"]
        return F.when(kept, F.struct(m["n"].alias("n_number"), pos.alias("pos"), snippet.alias("snippet")))

    matched = rows.select("doc_id", "w", _matches(F.col("w.text"), F.col("w.before"), F.col("w.size")).alias("ms")).filter(F.size("ms") > 0)
    hits = matched.select("doc_id", F.explode(F.filter(F.transform("ms", cut), lambda h: h.isNotNull())).alias("h")).select("doc_id", "h.*")
    if allow is not None:
        hits = hits.join(allow.select("n_number").distinct(), "n_number", "left_semi")
    return hits.select("doc_id", "n_number", "pos", "snippet")


def skip_document_filename(name: Column) -> Column:
    bare = F.lower(F.regexp_replace(name, r"\?[^?]*$", ""))
    ends = "|".join(re.escape(s) for s in (*D.SKIPPED_FILES, "-index.html", "-index.htm"))
    return bare.rlike(f"(?:{ends})$")


def document_filename(hit_id: Column, accession: Column) -> Column:
    """The matched document's file from a hit id (accession:filename); null if there is none to open."""
    at = F.instr(hit_id, ":")
    prefix, name = F.substring(hit_id, F.lit(1), at - 1), F.substring(hit_id, at + 1, F.length(hit_id))
    readable = r"(?i)\.(?:htm|html|txt)$"
    usable = (name != "") & ~skip_document_filename(name)
    with_prefix = F.when(usable & ((prefix == accession) | name.rlike(readable)), name)
    alone = F.when(hit_id.rlike(readable) & ~skip_document_filename(hit_id), hit_id)
    return F.when(F.coalesce(hit_id, F.lit("")) == "", F.lit(None).cast("string")).when(at > 0, with_prefix).otherwise(alone)


def archives_url(cik: Column, accession: Column, filename: Column) -> Column:
    return F.concat_ws(
        "/", F.lit(f"{ARCHIVE}/Archives/edgar/data"), cik.cast("long").cast("string"), F.replace(accession, F.lit("-"), F.lit("")), filename
    )


def document_url_for_sequence(index_html: Column, sequence: Column) -> Column:
    """The document of a sequence number in an index page's table; null if it is absent or not a text."""
    found = [F.regexp_extract_all(index_html, F.lit(D.INDEX_ROW), F.lit(k)) for k in (1, 2)]
    rows = F.arrays_zip(found[0].alias("seq"), found[1].alias("path"))
    fits = F.filter(rows, lambda x: (x["seq"].try_cast("int") == sequence) & ~skip_document_filename(F.element_at(F.split(x["path"], "/"), -1)))
    return F.concat(F.lit(ARCHIVE), F.get(fits, 0)["path"])


def primary_document_url(index_html: Column, cik: Column, accession: Column) -> Column:
    """The viewer's document, else the first page linked in the archive, else the complete text file."""
    not_index = lambda p: ~F.lower(p).rlike(r"-index\.html$")
    viewer = F.filter(F.regexp_extract_all(index_html, F.lit(D.VIEWER_LINK), F.lit(1)), not_index)
    linked = F.filter(F.regexp_extract_all(index_html, F.lit(D.PAGE_LINK), F.lit(1)), not_index)
    page = F.concat(F.lit(ARCHIVE), F.coalesce(F.get(viewer, 0), F.get(linked, 0)))
    return F.coalesce(page, archives_url(cik, accession, F.concat(accession, F.lit(".txt"))))


def ticker_of_display_name(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, D.TICKER_IN_NAME, 1), F.lit(""))


def first_filings(hits: DataFrame, max_hits: int) -> DataFrame:
    """The first hit of each (cik, accession, file name), in input order (``ord``), at most ``max_hits``."""
    key = Window.partitionBy("cik", "accession", F.lower("filename")).orderBy("ord")
    return hits.withColumn("_k", F.row_number().over(key)).filter("_k = 1").drop("_k").orderBy("ord").limit(max_hits)


def records(hits: DataFrame) -> DataFrame:
    """Harvest records from rows (cik, ticker, accession, form, n_number, snippet, filing_url)."""
    cik = F.when(F.col("cik").rlike("^[0-9]+$"), F.when(F.length("cik") < 10, F.lpad("cik", 10, "0")).otherwise(F.col("cik"))).otherwise(F.col("cik"))
    return hits.select(
        cik.alias("cik"), "ticker", "accession", "form", "n_number", F.substring("snippet", 1, 500).alias("snippet"), "filing_url", F.lit(True).alias("keyword_hit")
    )


def diagnostics(texts: DataFrame, allow: DataFrame) -> DataFrame:
    """One row: documents, pattern matches, matches with keyword, and those on the allow-list."""
    matches = texts.agg(
        F.count("*").alias("filings"), F.coalesce(F.sum(F.regexp_count("text", F.lit(D.N_NUMBER_PATTERN))), F.lit(0)).cast("long").alias("n_re")
    )
    listed = allow.select("n_number").distinct().withColumn("on_list", F.lit(1))
    hits = extract_hits(texts).join(listed, "n_number", "left")
    counted = hits.agg(F.count("*").alias("keyword"), F.count("on_list").alias("master"))
    return matches.crossJoin(F.broadcast(counted))  # single rows
