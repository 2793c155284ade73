"""Guards, errors and rules that the registered queries don't reach."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoweave.operators import evaluation, families, golden, legal, lifecycle, modelling, quality, quarantine, temporal, text
from chronoweave.sources import containers, datasets, extracts

D = dt.date


def test_long_chains_of_signatures(spark):
    names = [f"S{i:03d}" for i in range(90)]
    pairs = spark.createDataFrame([("e", a, b) for a, b in zip(names, names[1:], strict=False)] + [("f", "S001", "S002"), ("g", "X", "never published"), ("g", "never published", "Y")], "krs string, a string, b string")
    published = spark.createDataFrame([("e", n, D(2020, 1, 1) + dt.timedelta(days=(i * 37) % 90)) for i, n in enumerate(names)] + [("f", "S001", D(2020, 1, 2)), ("f", "S002", D(2020, 1, 2)), ("g", "X", D(2020, 1, 5)), ("g", "Y", D(2020, 1, 4))], "krs string, signature string, published_on date")
    got = {(r.krs, r.signature): r.proceeding_id for r in legal.linked_proceedings(pairs, published).collect()}
    first = min(range(90), key=lambda i: ((i * 37) % 90, names[i]))
    assert {v for (k, _), v in got.items() if k == "e"} == {names[first]} and len(got) == 94
    assert got["f", "S002"] == "S001" and got["g", "X"] == got["g", "Y"] == "Y"


def test_of_two_proceedings_of_a_day_the_first_by_id_leads(spark):
    rows = [("a", "liquidation_opened", "liquidation", D(2020, 1, 1)), ("ab", "bankruptcy_declared", "bankruptcy", D(2020, 1, 1)), ("x", "deregistered", "silent_exit", D(2020, 2, 1))]
    events = spark.createDataFrame([(g, "k", t, c, "opening", "", False, d, d, None, "KRS") for g, t, c, d in rows], "dedup_group_id string, krs string, event_type string, outcome_class string, stage string, ends string, precludes_silent_exit boolean, event_date date, known_from date, proceeding_id string, source string")
    assert {r.dedup_group_id: r.label_class for r in legal.canonical_events(events).collect()}["x"] == "liquidation"


def test_running_sums_by_brute_force(spark):
    rows = [(i % 3 if i % 7 else None, (i * 31) % 50, i) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, x int, n long")
    got = temporal.running_sums(df, ["g"], ["x", "n"], {"s": "n"}).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    sums, expected = {}, set()
    for g, x, n in order:
        sums[g] = sums.get(g, 0) + n
        expected.add((g, x, n, sums[g]))
    assert {tuple(r) for r in got} == expected
    values = [float((i * 37) % 101) for i in range(500)]
    import numpy as np

    found = evaluation.quantiles(spark.createDataFrame([(v,) for v in values] + [(None,)], "v double"), "v", [0.0, 0.1, 0.333, 0.5, 1.0])
    assert sorted(r.value for r in found.collect()) == pytest.approx(np.quantile(values, [0.0, 0.1, 0.333, 0.5, 1.0]).tolist())


def test_masks_take_the_earliest_span(spark):
    rows = [("Jan Kowalski (Jan) tel. 600 700 800, jan@x.pl", ["Jan", "Jan Kowalski"]), ("A.B+C wrote", ["A.B+C"]), ("\\E and (x", ["\\E", "(x", "", None]), (None, ["x"]), ("no one", None)]
    df = spark.createDataFrame(rows, "t string, p array<string>")
    assert [r[0] for r in df.select(text.masked(F.col("t"), F.col("p"))).collect()] == ["[PERSON] ([PERSON]) tel. [PHONE], [EMAIL]", "[PERSON] wrote", "[PERSON] and [PERSON]", None, "no one"]
    found = golden.masker_recall(df.withColumn("m", text.masked(F.col("t"), F.array(F.lit("Jan")))).select(F.array(F.lit("Jan"), F.lit("wrote")).alias("s"), "m").limit(2), "s", "m").first()
    assert (found.spans, found.hidden) == (4, 3)
    golden.export(df.select(text.masked(F.col("t")).alias("t")), "t")
    with pytest.raises(ValueError, match="not masked"):
        golden.export(df, "t")


def test_guards(spark):
    store = spark.createDataFrame([("v1", "h"), ("v1", "h")], "feature_set_version string, feature_set_hash string")
    assert lifecycle.one_identity(store, "v1") == "h"
    with pytest.raises(ValueError, match="alone"):
        lifecycle.one_identity(store.unionByName(spark.createDataFrame([("v2", "i")], store.schema)), "v1")
    one = spark.createDataFrame([(1, 0, 0.5), (2, 1, 0.6)], "id int, y int, probability double")
    with pytest.raises(ValueError, match="same rows"):
        lifecycle.paired(one, one.filter("id = 1"), ["id"])
    aliases = spark.createDataFrame([(12, "incumbent", 3)], "horizon_months int, alias string, version int")
    assert lifecycle.served_version(aliases, 12).first().version == 3
    with pytest.raises(ValueError, match="24 months"):
        lifecycle.served_version(aliases, 24)
    rows = spark.createDataFrame([("a", D(2020, 1, 31))], "krs string, as_of_date date")
    states = spark.createDataFrame([("a", None)], "krs string, excluded_reason string")
    with pytest.raises(ValueError, match="training data"):
        lifecycle.month_end_rows(rows, "2020-01-31", states, rows)
    facts = spark.createDataFrame([(1, "current_year", 1, 5), (1, "current_year", 9, 6)], "document_ref int, kind string, line_item int, value int")
    with pytest.raises(ValueError, match="carried by"):
        families.input_values(facts, {"assets": [1, 9]})
    lineage = spark.createDataFrame([(1, "x"), (1, "y")], "f int, l string")
    with pytest.raises(ValueError, match="two lineages"):
        quarantine.attach_lineage(lineage.select("f"), lineage, ["f"])
    pages = spark.createDataFrame([("k", 1, 1, True, False)], "krs string, document_ref int, page int, answered boolean, read boolean")
    with pytest.raises(ValueError, match="not read"):
        golden.frame(pages, spark.createDataFrame([("k", 1.0)], "krs string, weight double"), {"present": 1.0, "absent": 1.0}, "s")


def test_intervals_cover_refits(spark):
    rows = spark.createDataFrame([(f"e{i}", float(i % 2), float(i % 4 == 1 or i % 5 == 0)) for i in range(60)], "e string, x double, y double")

    def fit(train, weight):
        rates = {r.x: r.p for r in train.groupBy("x").agg((F.sum(F.col("y") * F.col(weight)) / F.sum(weight)).alias("p")).collect()}
        return lambda df: df.withColumn("probability", F.when(F.col("x") == 0, F.lit(rates[0.0])).otherwise(F.lit(rates[1.0])))

    got = {r.x: (r.low, r.high) for r in lifecycle.score_intervals(rows, rows.select("x").distinct(), fit, "e", ["x"], replicates=12).collect()}
    for x in (0.0, 1.0):
        rate = rows.filter(F.col("x") == x).agg(F.avg("y")).first()[0]
        assert got[x][0] <= rate <= got[x][1] and got[x][0] < got[x][1]
    again = {r.x: (r.low, r.high) for r in lifecycle.score_intervals(rows, rows.select("x").distinct(), fit, "e", ["x"], replicates=12).collect()}
    assert again == got


def test_classical_fit_leaves_out_what_has_no_score(spark):
    rows = spark.createDataFrame([(float(i), float(i > 20)) for i in range(40)] + [(None, 1.0)], "a double, y double")
    model, left_out = lifecycle.classical_fit(rows, F.col("a") * 2 - 1)
    assert left_out == 1 and model.stages[-1].coefficients[0] > 0


def test_draws_of_large_strata(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("s"), F.concat(F.lit("k"), F.col("id").cast("string")).alias("k")).repartition(5)
    got = modelling.permutation_draw(df, "s", "k", 7, "seed").collect()
    import hashlib

    for s in (0, 1):
        order = sorted((hashlib.sha256(f"seed:k{i}".encode()).hexdigest(), f"k{i}") for i in range(s, 500, 2))[:7]
        assert [r.k for r in sorted((r for r in got if r.s == s), key=lambda r: r.position)] == [k for _, k in order]
        assert {r.pi_denominator for r in got if r.s == s} == {250}


def test_replacement_survives_a_crash(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType())])
    root = f"file://{tmp_path}"
    datasets.write_dataset(spark.range(3).select(F.col("id").alias("k")), root, "d", ["k"])
    (tmp_path / "d").rename(tmp_path / "_before-d")  # as between the two renames
    assert datasets.read_dataset(spark, root, "d", schema).count() == 3
    datasets.write_dataset(spark.range(5).select(F.col("id").alias("k")), root, "d", ["k"])
    assert datasets.read_dataset(spark, root, "d", schema).count() == 5
    datasets.write_dataset(spark.range(6).select(F.col("id").alias("k")), root, "d", ["k"])
    assert datasets.read_dataset(spark, root, "d", schema).count() == 6 and not (tmp_path / "_before-d").exists()


def test_base64_of_containers():
    import base64

    inner = base64.b64encode(b"<Jednostka/>").decode()
    good = f'<Signature><Object Encoding="x#base64">{inner[:5]}\n {inner[5:]}</Object></Signature>'.encode()
    assert [k for _, k, _ in containers.unwrap(good)] == ["xml"]
    for bad in ("a", "zły==", "****"):
        with pytest.raises(containers.Unreadable):
            list(containers.unwrap(f'<Signature><Object Encoding="x#base64">{bad}</Object></Signature>'.encode()))


def test_extracts_reject_what_they_cannot_read(spark):
    rows = spark.createDataFrame([("1", "not json"), ("2", '{"odpis": {}}'), ("3", None)], "krs string, extract string")
    events, rejects = extracts.extract_events(rows, [extracts.Rule("dzial6.upadlosc", "x", "opening")])
    assert events.count() == rejects.count() == 0


def test_stale_rows_of_equal_tables(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a")], "k int, v string")
    assert {r.n_rows for r in quarantine.stale(df, df).collect()} == {0}
    assert quality.double_reported(spark.createDataFrame([], "krs string, line_item int, kind string, period_start date, period_end date, known_from date, document_ref int, value int")).count() == 0
