"""Keys shared by many companies and many aircraft: decisions keep a fixed size, reports do not build pairs that they only count."""

from pyspark.sql import functions as F

from hangarlight.operators import analytics, indexes, resolve

AIR = "n_number string, serial string, type_registrant string, registrant_name string, street string, city string, state string, type_aircraft string, type_engine string, status_code string, icao24 string, make string, model string, fractional_owner boolean"


def aircraft(spark, rows):
    return spark.createDataFrame([(n, n, "3", name, "1 MAIN ST", "RENO", "NV", "5", "5", "V", (n or "").lower(), "GULFSTREAM", "G5", False) for n, name in rows], AIR)


def evidence(spark, companies, subsidiaries=(), licences=()):
    listed = [(f"{k:010d}", t, name, "NYSE", "", "", "", [], k) for k, (t, name) in enumerate(companies)]
    empty = lambda schema: spark.createDataFrame([], schema)
    return resolve.Evidence(
        spark.createDataFrame(listed, "cik string, ticker string, name string, exchange string, street string, city string, state string, former_names array<string>, ord long"),
        spark.createDataFrame(list(subsidiaries), "parent_cik string, parent_name string, subsidiary_name string, parent_street string, parent_city string, parent_state string"),
        empty("cik string, ticker string, accession string, form string, n_number string, snippet string, filing_url string, keyword_hit boolean, ord long"),
        spark.createDataFrame(list(licences), "n_number string, licensee_name string, uls_id string"),
        empty("n_number string, ticker string, cik string, company_name string, citation string, ord long"),
        empty("n_number string, must_not_ticker string, citation string, ord long"),
    )


def test_decisions_hold_no_lists_of_their_keys_and_conflicts_give_them_whole(spark):
    companies = [(f"A{k:03d}", "Common Name Inc") for k in range(300)] + [("ZZ", "Single Corp"), ("YY", "Other Corp")]
    subsidiaries = [(f"{k:010d}", "P", "Shared Wings LLC", "", "", "") for k in range(0, 300, 2)]
    licences = [("N3", "Common Name LLC", "01"), ("N4", "Single Inc", "01"), ("N4", "Other Inc", "02"), ("N5", "Shared Wings", "01"), ("N6", "Single Inc", "01"), ("N6", "Common Name", "02")]
    planes = aircraft(spark, [("N1", "Common Name LLC"), ("N2", "Shared Wings Inc"), *((f"N{k}", "BANK TRUSTEE") for k in (3, 4, 5, 6)), ("N7", "Single LLC")])
    given = evidence(spark, companies, subsidiaries, licences)
    decided = resolve.decide(planes, given, "x")
    rows = {r.n_number: r for r in decided.collect()}
    assert max(len(r.d.tickers or []) for r in rows.values()) == 2
    every, half = [f"A{k:03d}" for k in range(300)], [f"A{k:03d}" for k in range(0, 300, 2)]
    found = {r.n_number: (r.tickers, r.method) for r in resolve.conflicts(decided, given).collect()}
    assert found == {
        "N1": (every, "exact_legal_name"), "N2": (half, "ex21_subsidiary"), "N3": (every, "fcc_licensee_exact"), "N4": (["YY", "ZZ"], "fcc_licensee_exact"),
        "N5": (half, "fcc_licensee_exact"), "N6": (every, "fcc_licensee_exact"),
    }
    assert rows["N7"].dest == "published" and rows["N7"].d.ticker == "ZZ"


def test_brief_indexes_agree_with_whole_ones(spark):
    rows = spark.createDataFrame([("k", "B", "1", "x"), ("k", "A", "2", "y"), ("m", "A", "3", "z"), ("m", "A", "2", "w"), ("", "A", "1", "v"), ("o", None, "1", "u")], "key string, ticker string, cik string, name string")
    found = {r.key: (r.n, r.only, tuple(r.hit)) for r in indexes.brief(rows).collect()}
    whole = {r.key: (min(len(r.tickers), 2), r.tickers[0] if len(r.tickers) == 1 else None, tuple(r.hit)) for r in indexes._index(rows).collect()}
    assert found == whole and len(found) == 3


def test_the_census_counts_shared_names_without_their_pairs(spark):
    companies = spark.createDataFrame([(f"t{k:02d}", "1", "", ["Common Name Inc"]) for k in range(50)] + [("t00", "1", "Rare Corp", ["Common Name"]), ("u1", "2", "", ["Bankers"])], "ticker string, cik string, company_name string, registrant_names array<string>")
    # N0 is listed under two names, one of them with an airframe that does not pass; a tail without number is a tail as well.
    planes = aircraft(spark, [(f"N{k}", "Common Name LLC") for k in range(40)] + [("N0", "Rare Inc"), ("N1", "Common Name Inc"), ("N900", "Nobody")])
    planes = planes.withColumn("type_engine", F.when(F.col("registrant_name") == "Rare Inc", "1").otherwise(F.col("type_engine")))
    nothing = spark.createDataFrame([], "n_number string, ticker string")
    trusts = spark.createDataFrame([("N5", "The Bankers Trustee"), ("N5", "Other")], "n_number string, registrant_name string")
    report = analytics.gold_miss_buckets(companies, nothing, nothing, planes, trusts)
    found = {r.ticker: tuple(r)[1:] for r in report.collect()}
    assert len(found) == 51 and found["T07"] == ("master_name_not_published", 0, 0, 40, 40, 0)
    assert found["T00"] == ("master_name_not_published", 0, 0, 40, 39, 1)
    assert found["U1"] == ("trust_name_only", 0, 0, 0, 0, 0)


def test_the_census_joins_no_name_with_every_tail(spark):
    """No operator of the census puts out as many rows as there are pairs of companies and aircraft of one name."""
    companies = spark.createDataFrame([(f"t{k:03d}", "1", "", ["Common Name Inc"]) for k in range(200)], "ticker string, cik string, company_name string, registrant_names array<string>")
    planes = aircraft(spark, [(f"N{k}", "Common Name LLC") for k in range(300)])
    nothing = spark.createDataFrame([], "n_number string, ticker string")
    report = analytics.gold_miss_buckets(companies, nothing, nothing, planes, spark.createDataFrame([(f"N{k}", "Common Name Trustee") for k in range(300)], "n_number string, registrant_name string"))
    assert {r.master_n for r in report.collect()} == {300}
    assert 0 < most_rows(report) <= 2000


def most_rows(df):
    """The most rows that an operator of an executed plan put out, but for its grams."""
    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        rows = node.metrics().get("numOutputRows")
        below = [walk(node.children().apply(k)) for k in range(node.children().size())]
        return max([rows.get().value() if rows.isDefined() and "Join" in name else 0, *below])

    plan = df._jdf.queryExecution().executedPlan()
    return walk(plan)


def wide_joins(df, least):
    """How many joins of an executed plan put out so many rows or more."""
    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        rows = node.metrics().get("numOutputRows")
        own = int("Join" in name and rows.isDefined() and rows.get().value() >= least)
        return own + sum(walk(node.children().apply(k)) for k in range(node.children().size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_alias_reasons_make_their_pairs_in_the_last_join(spark):
    companies = spark.createDataFrame([(f"t{k:03d}", f"{k}", "", ["Common Name Inc"]) for k in range(60)] + [("u", "1", "", ["Solo Corp"]), ("v", "2", "", ["New Corp"])], "ticker string, cik string, company_name string, registrant_names array<string>")
    planes = aircraft(spark, [(f"N{k}", "Common Name LLC") for k in range(80)] + [("N900", "Solo Inc"), ("N901", "New Inc"), ("N902", "Solo Trustee"), (None, "New LLC")])
    names = indexes.brief(spark.createDataFrame([("COMMON NAME", "T001", "1", "a"), ("COMMON NAME", "T002", "2", "b"), ("SOLO", "U", "3", "c")], "key string, ticker string, cik string, name string"))
    published = spark.createDataFrame([("N1", "T003"), ("N2", "X")], "n_number string, ticker string")
    review = spark.createDataFrame([("N3",), ("N3",)], "n_number string")
    forbidden = spark.createDataFrame([("N4", "t005"), ("N4", "t006"), ("N1", "q")], "n_number string, must_not_ticker string")
    report = analytics.alias_reasons(companies, names, planes, published, review, forbidden)
    rows = report.collect()
    found = {}
    for r in rows:
        found.setdefault((r.ticker, r.n_number), []).append(r.reason)
    # N4 is barred twice, so it gives two rows a company.
    assert len(rows) == 60 * 81 + 4 and found["U", "N902"] == ["class:trustee"]
    assert found["T003", "N1"] == ["already_published_same_ticker"] and found["T004", "N1"] == found["T003", "N2"] == ["published_other_ticker"]
    assert found["T003", "N3"] == ["review_queue"] and sorted(found["T005", "N4"]) == ["uniqueness_collision", "unpublished_suppress"]
    assert found["T001", "N9"] == ["uniqueness_collision"] and found["U", "N900"] == ["already_in_name_index"] and found["V", "N901"] == found["V", None] == ["addable"]
    assert wide_joins(report, 4000) == 1


def test_the_cascade_gathers_no_tickers_of_a_key(spark):
    given = evidence(spark, [("A", "Alpha Inc"), ("B", "Alpha Inc")], [("0000000000", "P", "Beta LLC", "", "", "")], [("N1", "Alpha", "1")])
    decided = resolve.decide(aircraft(spark, [("N1", "Alpha Inc")]), given, "x")
    plan = decided._jdf.queryExecution().optimizedPlan().toString()
    # Hits of a tail are gathered by tail; tickers of names, subsidiaries and addresses are not.
    assert plan.count("collect_set(") == 1 and "collect_set(t#" in plan
    assert [r.dest for r in decided.collect()] == ["conflict"]
