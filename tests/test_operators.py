"""Operators on small fixtures: rules that the shared tables don't reach."""

import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoweave.functions import timeops, values
from chronoweave.operators import evaluation, features, labels, legal, modelling, panel, quality, serving, size_class, temporal, text
from chronoweave.plans.fixtures import Tables
from chronoweave.sources import containers, datasets, listings
from chronoweave.streaming import logs

D = dt.date


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_sticky_months(spark):
    add = lambda d, n: timeops.add_months_sticky(F.lit(d), n)
    got = one(spark, a=add(D(2023, 12, 31), 6), b=add(D(2023, 6, 30), 6), c=add(D(2024, 1, 30), 1), d=timeops.window_end(F.lit(D(2024, 2, 29)), 1), e=timeops.filing_deadline(F.lit(D(2023, 12, 31))))
    assert tuple(got) == (D(2024, 6, 30), D(2023, 12, 31), D(2024, 2, 29), D(2024, 3, 31), D(2024, 7, 15))


def test_asof_is_one_shuffle_without_loops(spark):
    left = spark.createDataFrame([("a", 1, 5), ("a", 2, 1), ("b", 3, 9)], "k string, id int, t int")
    right = spark.createDataFrame([("a", 2, "x"), ("a", 5, "y"), ("c", 1, "z")], "k string, at int, v string")
    joined = temporal.asof_join(left, right, ["k"], "t", "at", ["v"])
    assert [(r.id, r.at, r.v) for r in joined.collect()] == [(1, 5, "y")]
    outer = temporal.asof_join(left, right, ["k"], "t", "at", ["v"], how="left")
    assert {(r.id, r.v) for r in outer.collect()} == {(1, "y"), (2, None), (3, None)}
    plan = joined._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_small_cells_and_reasons(spark):
    df = spark.createDataFrame([(1, 10), (5, 50)], "n int, m int")
    assert [(r.m, r.suppressed) for r in values.suppress(df, ["m"], "n", 3).orderBy("n").collect()] == [(None, True), (50, False)]
    assert [r.m for r in values.suppress(df, ["m"], "n", None).orderBy("n").collect()] == [10, 50]
    rules = [("a", F.col("n") > 1), ("b", F.col("m") > 1)]
    assert [r[0] for r in df.orderBy("n").select(values.first_reason(rules)).collect()] == ["b", "a"]


def test_signatures_and_links(spark):
    df = spark.createDataFrame([(1, "IX GU 103/13."), (2, "KI1L/GU/43/2025"), (3, "vi gu 751/19/W"), (4, " "), (5, None)], "id int, s string")
    assert [r[0] for r in df.orderBy("id").select(legal.normalised_signature(F.col("s"))).collect()] == ["IX/GU/103/13", "KI1L/GU/43/2025", "VI/GU/751/19", None, None]
    pairs = spark.createDataFrame([("e", "A", "B"), ("e", "B", "C")], "krs string, a string, b string")
    published = spark.createDataFrame([("e", "A", D(2020, 1, 3)), ("e", "B", D(2020, 1, 1)), ("e", "C", D(2020, 1, 1)), ("e", "Z", D(2019, 1, 1))], "krs string, signature string, published_on date")
    assert {(r.signature, r.proceeding_id) for r in legal.linked_proceedings(pairs, published).collect()} == {("A", "B"), ("B", "B"), ("C", "B"), ("Z", "Z")}


def test_panel_withdrawal_and_precedence(spark):
    rows = [
        ("k", 1, D(2020, 1, 1), D(2020, 12, 31), D(2021, 5, 1), D(2021, 9, 1), False, "pass", 1),
        ("k", 2, D(2021, 1, 1), D(2021, 12, 31), D(2022, 5, 1), None, False, "pass", 1),
        ("k", 3, D(2021, 1, 1), D(2021, 12, 31), D(2022, 6, 1), None, True, "pass", 0),
        ("k", 4, D(2022, 1, 1), D(2022, 12, 31), D(2023, 6, 1), None, False, "quarantined", 1),
    ]
    statements = spark.createDataFrame(rows, "krs string, document_ref long, period_start date, period_end date, known_from date, deleted_on date, is_correction boolean, quality_grade string, prior_assets int")
    got = [(r.period_end.year, r.known_from, r.kind, r.document_ref) for r in panel.versions(panel.candidates(statements)).orderBy("period_end", "known_from").collect()]
    assert got == [
        (2019, D(2021, 5, 1), "comparative", 1), (2019, D(2021, 9, 1), "withdrawn", 1), (2020, D(2021, 5, 1), "filed", 1), (2020, D(2021, 9, 1), "withdrawn", 1),
        (2020, D(2022, 5, 1), "comparative", 2), (2021, D(2022, 5, 1), "filed", 2), (2021, D(2022, 6, 1), "correction", 3),
    ]


def test_leakage_mutant_is_caught(spark):
    """A feature that reads by period instead of publication must differ once sources are cut."""
    filings = spark.createDataFrame([("k", 1, D(2020, 12, 31), D(2021, 6, 30), None, False, "valid"), ("k", 2, D(2021, 3, 31), D(2021, 8, 1), None, False, "valid")], "krs string, document_ref long, period_end date, known_from date, deleted_on date, is_correction boolean, status string")
    grid = spark.createDataFrame([("k", D(2021, 7, 31))], "krs string, as_of_date date")

    def honest(rows, sources):
        return features.latest_flag(rows, sources["f"], F.col("document_ref"), "ref")

    def mutant(rows, sources):
        seen = rows.join(sources["f"], "krs").filter("period_end <= as_of_date")
        return seen.groupBy("krs", "as_of_date").agg(F.max("document_ref").cast("double").alias("value")).withColumn("feature", F.lit("ref"))

    assert features.truncation_diff(honest, grid, {"f": filings}, ["2021-07-31"]).isEmpty()
    assert not features.truncation_diff(mutant, grid, {"f": filings}, ["2021-07-31"]).isEmpty()


def test_label_hash_ignores_order(spark, small):
    rows = Tables(spark, small).orders.limit(50)
    assert labels.frozen_hash(rows, ["o_orderkey"]) == labels.frozen_hash(rows.orderBy(F.rand(1)), ["o_orderkey"])
    assert datasets.digest(rows) == datasets.digest(rows.repartition(3))


def test_contract(spark):
    schema = T.StructType([T.StructField("k", T.StringType(), False), T.StructField("n", T.IntegerType())])
    contract = quality.Contract(schema, ("k",), {"positive": F.col("n") > 0})
    df = spark.createDataFrame([("a", 1), ("a", -1), ("b", None)], "k string, n int")
    assert {r.rule: r.violations for r in contract.violations(df).collect()} == {"null:k": 0, "positive": 1, "unique:k": 1}
    with pytest.raises(ValueError):
        contract.violations(df.select("n", "k"))


def test_metrics_and_champion(spark):
    df = spark.createDataFrame([(1, 0.9, 1.0), (0, 0.9, 1.0), (0, 0.1, 2.0), (1, 0.2, 1.0)], "y int, probability double, w double")
    m = evaluation.metrics(df, [], w=F.col("w")).first()
    assert m.n == 4 and m.auc == pytest.approx((0.5 * 1 + 2 + 2) / (2 * 3))
    one_class = evaluation.metrics(df.filter("y = 1"), []).first()
    assert one_class.auc is None
    row = spark.createDataFrame([(60, 0.7, 0.71, -0.01), (2, 0.7, 0.9, -0.1), (60, 0.6, 0.9, -0.1)], "events int, auc_challenger double, auc_incumbent double, high double")
    assert [r.verdict for r in evaluation.champion(row, F.col("high"), 0.02, 50).collect()] == ["promoted", "provisional", "kept"]


def test_logistic_and_trees(spark):
    rows = spark.range(200).select((F.col("id") / 200).alias("a"), (F.col("id") % 7).cast("double").alias("b"), (F.col("id") > 120).cast("int").alias("y"))
    model = modelling.rank_logistic(rows, ["a", "b"])
    assert model.stages[-1].coefficients[0] > 0
    trees = modelling.boosted_trees(rows.withColumn("a", F.when(F.col("a") > 0.02, F.col("a"))), ["a", "b"], rounds=2)
    assert trees.stages[-1].getNumTrees == 2


def test_folds_and_scores(spark):
    rows = spark.createDataFrame([("a", D(2018, 12, 31), 12), ("b", D(2020, 3, 31), 12), ("c", D(2019, 6, 30), 12)], "krs string, as_of_date date, horizon_months int")
    assert {r.krs: r.side for r in modelling.purged_fold(rows, 2020, "2021-12-01", 12).collect()} == {"a": "train", "b": "test", "c": None}
    store = spark.createDataFrame([("a", 1.0, 2.0), ("b", None, 2.0)], "krs string, x double, z double")
    got = {r.krs: (r.missing_inputs, [d.feature for d in r.top_drivers or []]) for r in modelling.complete_cases(store, {"x": 0.1, "z": -1.0}, 0.0).collect()}
    assert got == {"a": ([], ["z", "x"]), "b": (["x"], [])}


def test_upsert_and_insert(spark):
    stored = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], "k string, n int, seen string")
    new = spark.createDataFrame([("b", 9, "new"), ("c", 3, "new")], "k string, n int, seen string")
    assert {tuple(r) for r in serving.merged(stored, new, ["k"], ["seen"]).collect()} == {("a", 1, "old"), ("b", 2, "new"), ("c", 3, "new")}
    assert [r.k for r in serving.insert_new(stored, new.unionByName(new), ["k"]).collect()] == ["c"]


def test_masking(spark):
    df = spark.createDataFrame([("write to jan.k@firma.com.pl or tel. 22 555 44 33, no 44051401359.",), ("+48 600 700 800 and 123456789012",)], "t string")
    assert [r[0] for r in df.select(text.masked(F.col("t"))).collect()] == ["write to [EMAIL] or tel. [PHONE], no [PESEL].", "[PHONE] and 123456789012"]


def test_mcnemar(spark):
    df = spark.createDataFrame([(True, False)] * 1 + [(False, True)] * 7 + [(True, True)] * 3, "a boolean, b boolean")
    r = text.mcnemar(df, "a", "b").first()
    assert (r.lost, r.won) == (1, 7) and r.p_value == pytest.approx(2 * 9 / 256)


def test_requests_and_judgement(spark):
    pages = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "page int, text string")
    stored = pages.filter("page = 3").select(F.sha2("text", 256).alias("request_key"))
    _, new = text.requests(pages, F.col("text"), stored)
    assert [r.prompt for r in new.collect()] == ["x"]
    answers = spark.createDataFrame([("the  firm went on", "firm went", "yes"), ("abc", "zzz", "yes"), ("abc", "abc", "maybe")], "page string, evidence string, value string")
    assert [r.discard_reason for r in text.judged(answers, "page", "evidence", "value", ["yes", "no"]).collect()] == [None, "evidence_not_on_page", "value_not_allowed"]


def test_size_classes():
    regime = size_class.REGIMES[0]
    assert size_class.possible(regime, ((1, 1), (1, 1), (500, 500))) == {0}
    assert size_class.possible(regime, ((2_000_000, 2_000_000), (1, 1), (0, 1000))) == {0, 1}
    years = [dict(fiscal_year=y, period_start=D(y, 1, 1), assets_low=a, assets_high=a, revenue_low=a, revenue_high=a, employment_low=None, employment_high=None) for y, a in ((2018, 1e6), (2019, 1e6), (2020, 9e6), (2021, 9e6))]
    assert [(r["size_class"], r["reason"]) for r in size_class.history(years)] == [("micro", "first_year"), ("micro", "two_years"), ("micro", "carried_over"), ("small", "two_years")]


XML = b"<JednostkaInna wersjaSchemy='1-2'><Bilans><Aktywa><KwotaA>10.5</KwotaA><KwotaB>7</KwotaB></Aktywa></Bilans></JednostkaInna>"


def test_containers(spark):
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr("a.xml", XML)
        z.writestr("b.pdf", b"%PDF-1.4 x")
    import base64

    signed = b"<Signature><Object Encoding='http://www.w3.org/2000/09/xmldsig#base64'>" + base64.b64encode(XML) + b"</Object></Signature>"
    files = spark.createDataFrame([("1", packed.getvalue()), ("2", signed), ("3", b"junk"), ("4", b"<a><b></a>"), ("5", b"<!DOCTYPE a><a/>")], "sha256 string, content binary")
    members = containers.members_of(files)
    assert {(r.sha256, r.member, r.kind, r.reason) for r in members.collect()} == {("1", "a.xml", "xml", None), ("1", "b.pdf", "pdf", None), ("2", "", "xml", None), ("3", None, None, "unknown_container"), ("4", None, None, "xml_malformed"), ("5", None, None, "xml_malformed")}
    facts = containers.facts_of(members, {"JednostkaInna": 1000})
    assert {(r.line_item, r.kind, float(r.value)) for r in facts.collect()} == {("Bilans/Aktywa", "current_year", 10500.0), ("Bilans/Aktywa", "prior_year", 7000.0)}
    rows = spark.createDataFrame([("1", 7, "dir/A.XML"), ("2", 8, "other")], "sha256 string, document_ref int, file_name string")
    assert {(r.sha256, r.document_ref) for r in containers.match_members(members, rows).collect()} == {("1", 7), ("2", 8)}


def test_listing(spark, tmp_path):
    (tmp_path / "l.csv").write_text("krs,name\n0000000001,a\n12,b\n0000000001,c\n")
    schema = T.StructType([T.StructField("krs", T.StringType()), T.StructField("name", T.StringType())])
    good, bad = listings.read_listing(spark, str(tmp_path / "l.csv"), schema, "krs")
    assert [tuple(r) for r in good.collect()] == [("0000000001", "a")] and [r.krs for r in bad.collect()] == ["12"]


def test_datasets(spark, tmp_path, small):
    root = f"file://{tmp_path}"
    df = Tables(spark, small).orders.limit(20)
    with pytest.raises(datasets.NotMaterialised):
        datasets.read_dataset(spark, root, "none", df.schema)
    assert datasets.external_view(spark, root, "none", df.schema).count() == 0
    name = datasets.freeze_set(df, root, "label_set_hash", ["o_orderkey"])
    assert datasets.same_rows(datasets.load_frozen(spark, root, "label_set_hash", name, df.schema), df)
    datasets.write_dataset(df.limit(5), root, f"label_set_hash={name}", ["o_orderkey"])
    with pytest.raises(ValueError):
        datasets.load_frozen(spark, root, "label_set_hash", name, df.schema)


def test_stream_reruns_add_nothing(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, n int")
    df.write.parquet(source)
    logs.stream_log(spark, source, "k string, n int", out, ["k"], str(tmp_path / "c1")).awaitTermination(60)
    logs.stream_log(spark, source, "k string, n int", out, ["k"], str(tmp_path / "c2")).awaitTermination(60)
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_no_loops_over_pairs_in_plans(spark, small):
    """Range joins keep their key: no cartesian product in the domain plans."""
    from chronoweave.plans import registry

    for name in ("label_grid", "panel_versions", "filing_metrics", "restatement_events"):
        plan = registry.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_bootstrap_replicates(spark, small):
    """As many as the reference's configuration asks for; the interval is that of its draws."""
    got = evaluation.bootstrap_brier(Tables(spark, small).prediction, "krs").first()
    assert got.replicates == 1000 and got.low <= got.middle <= got.high
