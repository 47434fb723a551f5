"""Registration numbers in whole texts, against brute force."""

import html
import random
import re
import time
from html.entities import html5

from pyspark.sql import functions as F

from hangarlight.functions import dicts as D
from hangarlight.functions.entities import unescape
from hangarlight.operators import harvest
from hangarlight.plans.queries import QUERIES


def brute(rows):
    found = []
    for i, text in rows:
        for m in re.finditer(D.N_NUMBER_PATTERN, text or ""):
            cut = [text[max(0, m.start() - k) : m.end() + k] for k in (D.SNIPPET_MARGIN, D.KEYWORD_MARGIN)]
            snippet = re.sub(r"[\t-\r ]+", " ", cut[0]).strip(" ")
            if any(w in x.lower() for x in (snippet, cut[1]) for w in D.FILING_KEYWORDS):
                found.append((i, m.group(), m.start(), snippet))
    return sorted(found, key=str)


def hits(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_number", "pos", "snippet").collect()), key=str)


def test_extract_hits_on_odd_texts(spark):
    many = " ".join(f"N{k} falcon" if k % 3 else f"N{k}\n\t 𝛼é word" for k in range(1000, 3000))
    far = "N123 " + "x " * 500 + "gulfstream N456 " + "y " * 5000 + "N789"
    rows = [(1, None), (2, ""), (3, "N12"), (4, "aircraft N123"), (5, "N123 N123,N1234 tail number"), (6, many), (7, far), (None, "aviation N99999"), (8, "no number, aircraft")]
    assert hits(harvest.extract_hits(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_texts_become_plain(spark):
    rows = [(b"<p>A&amp;B &lt;x&gt;</p>",), (b"caf\xc3\xa9 \xff!\xe2\x82",), ("kept \ufffd".encode(),), (b"",), (None,)]
    raw = spark.createDataFrame(rows, "raw binary").select(harvest.decode(F.col("raw")).alias("t"))
    assert [r[0] for r in raw.select(harvest.to_plain_text(F.col("t"))).collect()] == [" A&B <x> ", "café !", "kept \ufffd", "", None]
    more = spark.createDataFrame([("&eacute;&#8217;&amp;",), (None,)], "t string")
    assert [r[0] for r in more.select(harvest.to_plain_text(F.col("t"))).collect()] == ["é’&", None]


def test_references_are_decoded_once_as_the_standard_says(spark):
    chosen = random.Random(4)
    names = sorted(html5)
    numbers = [0, 1, 8, 9, 0xB, 0xD, 0x1F, 0x26, 0x7F, 0x80, 0x81, 0x9F, 0xA0, 0xD7FF, 0xD800, 0xDFFF, 0xFDCF, 0xFDD0, 0xFDEF, 0xFFFE, 0x1F600, 0x1FFFF, 0x10FFFD, 0x10FFFF, 0x110000, 1 << 31, 1 << 64, 10**30]
    atoms = ["&", "&&", ";", " ", "x", "<", "#", "&#", "&#x", "&amp;lt;", "&amp;amp;", "&ampamp;", "&notit;", "&notin;", "&lt", "&NoSuch;", "&copyx", "&é;", "\n", "&" + "a" * 40 + ";"]
    atoms += [f"&#{n};" for n in numbers] + [f"&#{n}" for n in numbers] + [f"&#x{n:x};" for n in numbers] + [f"&#X{n:X}" for n in numbers]
    texts = ["&" + n for n in names] + [f"a&{n}b" for n in names] + ["".join(chosen.choices(atoms, k=chosen.randint(0, 9))) for _ in range(3000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", unescape(F.col("t")).alias("got")).collect()
    assert [(r.t, r.got) for r in rows] == [(t, html.unescape(t)) for t in texts]


def test_matches_at_the_edges_of_blocks(spark):
    """A number at every place around the first two borders of blocks, with and without a keyword at the end of a margin."""
    rows = []
    for at in (*range(harvest.BLOCK - 10, harvest.BLOCK + 3), *range(2 * harvest.BLOCK - 8, 2 * harvest.BLOCK + 2)):
        for word in ("N12", "N123", "N12345", "xN123", "N123456", "N123_", "N123 N99999"):
            for gap in (D.KEYWORD_MARGIN - len("aviation") - 1, D.KEYWORD_MARGIN):
                rows.append((len(rows), "é" * (at - 1) + " " + word + " " * gap + "aviation and the rest"))
                rows.append((len(rows), " " * max(0, at - gap - 9) + "aviation" + " " * gap + word + "."))
    assert hits(harvest.extract_hits(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_extraction_is_linear(spark):
    """Twice the matches in one text take at most 2.2 times the time."""

    def seconds(matches):
        text = "".join(f"N{1000 + k % 9000} falcon and other words " for k in range(matches))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string").cache()
        assert df.count() == 1
        start = time.perf_counter()
        assert harvest.extract_hits(df).count() == matches
        return time.perf_counter() - start

    seconds(4000)
    assert min(seconds(64000) for _ in range(3)) <= 2.2 * min(seconds(32000) for _ in range(3))


def test_documents_of_a_filing(spark):
    """From a hit's id and an index page to the document's address."""
    ids = [("0-1:a.htm", "a.htm"), ("0-1:a", "a"), ("0-2:a", None), ("0-2:b.TXT", "b.TXT"), ("0-1:x.jpg", None), ("0-1:x-index.html", None), ("c.html", "c.html"), ("c", None), ("", None), (None, None)]
    found = spark.createDataFrame(ids, "id string, wanted string").select("wanted", harvest.document_filename(F.col("id"), F.lit("0-1")).alias("got"))
    assert [(r.wanted, r.got) for r in found.collect()] == [(w, w) for _, w in ids]

    def row(k, path):
        return f'<td scope="row">{k}</td> <td scope="row">x</td> <td scope="row"><a href="{path}">d</a></td>'

    page = row(1, "/ix?doc=/Archives/edgar/data/12/34/main.htm") + row(2, "/Archives/edgar/data/12/34/ex.htm") + row(3, "/Archives/edgar/data/12/34/p.pdf")
    plain = 'href="/Archives/edgar/data/12/34/0-index.html" HREF="/Archives/edgar/data/12/34/other.html"'
    pages = spark.createDataFrame([(page,), (plain,), ("",), (None,)], "html string")
    at = harvest.ARCHIVE + "/Archives/edgar/data/12/34/"
    of = pages.select(*[harvest.document_url_for_sequence(F.col("html"), F.lit(k)) for k in (1, 2, 3, 4)]).first()
    assert tuple(of) == (at + "main.htm", at + "ex.htm", None, None)
    whole = harvest.ARCHIVE + "/Archives/edgar/data/12/00/0-0.txt"
    primary = pages.select(harvest.primary_document_url(F.col("html"), F.lit("0012"), F.lit("0-0"))).collect()
    assert [r[0] for r in primary] == [at + "main.htm", at + "other.html", whole, whole]
    names = [("Alpha Inc (AA) (CIK 12)", "AA"), ("Beta (BB.A, BB)", None), ("none", None), (None, None)]
    tickers = spark.createDataFrame(names, "n string, wanted string").select(harvest.ticker_of_display_name(F.col("n")).alias("got"))
    assert [r.got for r in tickers.collect()] == [w for _, w in names]


def test_harvest_from_hits_to_records(spark):
    hits = [("12", "0-1", "a.htm", 3), ("12", "0-1", "A.HTM", 1), ("12", "0-1", "b.htm", 2), ("9", "0-1", "a.htm", 0)]
    first = harvest.first_filings(spark.createDataFrame(hits, "cik string, accession string, filename string, ord long"), 2)
    assert [(r.cik, r.filename, r.ord) for r in first.collect()] == [("9", "a.htm", 0), ("12", "A.HTM", 1)]
    rows = [("12", "AA", "0-1", "10-K", "N123", "s" * 600, "u"), ("12345678901", None, "0-1", "8-K", "N124", None, "u"), ("x", "", "", "", "N1", "", "")]
    schema = "cik string, ticker string, accession string, form string, n_number string, snippet string, filing_url string"
    made = harvest.records(spark.createDataFrame(rows, schema)).collect()
    assert [(r.cik, r.snippet) for r in made] == [("0000000012", "s" * 500), ("12345678901", None), ("x", "")] and all(r.keyword_hit for r in made)
    texts = spark.createDataFrame([(1, "aircraft N123 and N124"), (2, "bond N125"), (3, None)], "doc_id long, text string")
    allow = spark.createDataFrame([("N123",), ("N123",), ("N125",)], "n_number string")
    assert tuple(harvest.diagnostics(texts, allow).first()) == (3, 3, 2, 1)


def test_query_reads_the_whole_documents(spark, tmp_path):
    real = "before " * 3000 + "our Gulfstream N7XY flew " + "after " * 3000
    rows = [(1, real, "en"), (2, None, "de"), (3, "", "en"), (4, "ä" * 4001, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))

    def spliced(i, text):
        text = text or ""
        a, b = len(text) // 4, len(text) // 2
        return f" The corporate aircraft N{100 + i % 900} {text[:a]} dry lease of N{3000 + i % 6000} {text[a:b]} bond series N{10000 + i % 80000} {text[b:]} n-number N{2000 + i % 7} "

    found = hits(QUERIES["edgar_extract_documents"](spark, str(tmp_path)))
    assert (1, "N7XY") in {r[:2] for r in found} and (1, "N10001") not in {r[:2] for r in found}
    assert found == brute([(i, spliced(i, t)) for i, t, _ in rows])
