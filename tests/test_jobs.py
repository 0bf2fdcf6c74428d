"""Jobs on literal rows, and properties that hold for any input."""

import pytest
from decimal import Decimal

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom import fixtures as fx
from tallyloom.catalog import jobs
from tallyloom.operators import aggregates as agg
from tallyloom.operators import joins, reshape
from tallyloom.operators import totals as tot
from tallyloom.plans import graph, levels, providers, reach, report, sources_merge

FACT = "feature_value string, brand string, impressions decimal(18,2), mvpd string, data_type string"
FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
fact_rows = st.lists(
    st.tuples(
        st.sampled_from(["x", "y", "z", None]), st.just("b"),
        st.one_of(st.none(), st.integers(0, 10**6).map(Decimal)), st.sampled_from(["A", "B"]), st.sampled_from(["Network", "Day"]),
    ),
    min_size=1, max_size=60,
)


@FEW
@given(fact_rows)
def test_grouping_sets_equal_the_two_steps(spark, data):
    fact = agg.group_sum(spark.createDataFrame(data, FACT), ["feature_value", "brand", "mvpd", "data_type"]).select(*tot.FACT)
    one_pass = set(rows(tot.with_totals(fact)))
    with_features = fact.unionByName(tot.feature_totals(fact))
    two_steps = set(rows(with_features.unionByName(tot.cut_totals(with_features))))
    assert one_pass == two_steps


@FEW
@given(fact_rows)
def test_mapped_and_unmapped_add_up_to_the_input(spark, data):
    df = spark.createDataFrame(data, FACT)
    mapping = spark.createDataFrame([("x", "X"), ("y", "X")], "raw string, clean string")
    mapped = joins.map_or_unassigned(df, mapping, "feature_value", "raw", "clean", ["mvpd"])
    named = df.filter("feature_value is not null")
    total = float(named.agg(agg.exact_sum("impressions")).first()[0])
    assert sum(float(r.impressions) for r in mapped.collect()) == total
    missing = joins.anti_unmapped(named, mapping, "feature_value", "raw").agg(agg.exact_sum("impressions")).first()[0]
    assert sum(float(r.impressions) for r in mapped.collect() if r.feature_value == "Unassigned") == float(missing)


def test_summary_gets_no_second_total(frame):
    fact = frame(FACT, ("Total", "b", Decimal(3), "A", "Summary"), ("Total", "b", Decimal(4), "B", "Summary"))
    got = sorted((m, float(v)) for _, _, v, m, _ in rows(tot.with_totals(fact)))
    assert got == [("A", 3.0), ("B", 4.0), ("Total", 7.0)]


def test_cuts_add_up_to_their_total_row(spark, folder):
    t = fx.Tables(spark, folder)
    fact = jobs.fact(t).filter("metric_type = 'Impressions' and data_type not in ('Summary', 'Reach and Frequency')")
    sums = fact.groupBy("brand", "data_type", "mvpd").agg(
        F.sum(F.when(F.col("feature_value") == "Total", F.col("metric"))).alias("total"),
        F.sum(F.when(F.col("feature_value") != "Total", F.col("metric"))).alias("parts"),
    )
    got = sums.collect()
    assert got and all(r.total == r.parts for r in got)
    per_cut = {(r.brand, r.mvpd): set() for r in got}
    for r in got:
        per_cut[r.brand, r.mvpd].add(r.total)
    assert all(len(v) == 1 for v in per_cut.values())  # every cut shows the same whole


def test_report_order(spark, folder):
    t = fx.Tables(spark, folder)
    cuts = report.report_cuts(jobs.fact(t), fx.dma_map(t), fx.PROVIDERS)
    assert list(cuts) == ["Summary", "Dayparts", "Networks", "Market", "Day of Week", "Week"]
    days = [r.feature_value for r in report.in_report_order("Day of Week", cuts["Day of Week"]).filter("brand = 'BrandA'").collect()]
    assert days == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday", "Total"]
    summary = [r.cut for r in report.in_report_order("Summary", cuts["Summary"]).filter("brand = 'BrandA'").collect()]
    assert summary[-1] == "Reach and Frequency" and "Summary" not in summary
    assert [r.feature_value for r in report.in_report_order("Week", cuts["Week"]).filter("brand = 'BrandA'").collect()][-1] == "Total"
    assert "dma_code" in cuts["Market"].columns


def test_pivot_and_unpivot_are_inverse(frame):
    long = frame("k string, c string, v double", ("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 3.0), ("b", "y", 4.0))
    wide = reshape.pivot_sum(long, ["k"], "c", ["x", "y"], "v")
    assert rows(reshape.unpivot_columns(wide, ["k"], ["x", "y"], "c", "v"), "k", "c") == rows(long, "k", "c")


def test_stacked_groups(frame):
    wide = frame("id int, `Daypart 1` string, `Imps 1` string, `Daypart 2` string, `Imps 2` string", (1, "DA", "5", "EF", None), (2, "ON", "6", "PR", "7"))
    got = rows(reshape.stack_column_groups(wide, ["id"], ["Daypart", "Imps"]), "id", "Daypart")
    assert got == [(1, "DA", "5"), (2, "ON", "6"), (2, "PR", "7")]


def test_uneven_groups_raise(frame):
    for names in ("`Daypart 1` string, `Daypart 2` string, `Daypart 3` string, `Imps 1` string, `Imps 2` string", "`Daypart a` string, `Imps` string, `Start b` string, `Start c` string"):
        with pytest.raises(ValueError):
            reshape.stack_column_groups(frame(names), [], ["Daypart", "Start", "Imps"])
    surplus = frame("`Imps all` string, `Daypart a` string, `Imps a` string", ("9", "DA", "5"))
    assert rows(reshape.stack_column_groups(surplus, [], ["Daypart", "Imps"])) == [("DA", "5")]


def test_the_first_total_of_each_file_counts(frame):
    report = frame(
        "file string, line_no bigint, segment string, `Target.HH` string, `Imp` string",
        ("A B Cox reach", 0, "Sub Total", "30", "300"), ("A B Cox reach", 1, "Grand Total", "60", "600"),
        ("A B Cox reach 2", 0, "x", "1", "10"), ("A B Cox reach 3", 0, "x", "5", "5"), ("A B Cox reach 3", 1, "y", "5", "5"),
    )
    assert [(b, float(i), float(r)) for b, _, i, r in rows(reach.read_reach(report, ["Cox"]))] == [("A B", 310.0, 31.0)]


def test_reach_counts_total_segments_or_the_only_row(frame):
    report = frame(
        "file string, line_no bigint, segment string, `Target HH` string, `HH booked` string, `Delivered Impressions` string",
        ("b Cox reach", 0, "East", "1", "9", "10"), ("b Cox reach", 1, "Grand Total", "$1,000", "9", "2,500"),
        ("b Spectrum reach", 0, "Only one", "10", "9", "33"),
    )
    got = rows(reach.reach_frequency(reach.read_reach(report, ["Cox", "Spectrum"])).select("mvpd", "metric_type", "metric"), "mvpd", "metric_type")
    assert got == [
        ("Cox", "Frequency", 2.5), ("Cox", "Impressions", 2500.0), ("Cox", "Reach", 1000.0),
        ("Spectrum", "Frequency", 3.3), ("Spectrum", "Impressions", 33.0), ("Spectrum", "Reach", 10.0),
        ("Total", "Frequency", 2.51), ("Total", "Impressions", 2533.0), ("Total", "Reach", 1010.0),
    ]


def test_reach_from_other_reports(frame):
    sheet = frame("brand string, mvpd string, hh string, freq string", ("b", "Cox", "1,000", "2.5"), ("b", "Cox", "10", "1"))
    long = frame(
        "dimension_name string, dimension_value string, impressions_text string, uniques_text string",
        ("Campaign", "c1", "100", "7"), ("Campaign", "c2", "n/a", "3"), ("Campaign", "Total", "100", "10"), ("Hour", "1", "5", None),
    )
    both = reach.combine_reach(
        reach.reach_from_frequency(sheet, "hh", "freq"), reach.reach_from_campaigns(long, "b", "Comcast"),
        reach.reach_from_summary(frame("brand string, mvpd string, i string, h string", ("b", "Comcast", "1", "2")), "i", "h"),
    )
    got = [(m, float(i), float(r)) for _, m, i, r in rows(both, "mvpd")]
    assert got == [("Comcast", 101.0, 12.0), ("Cox", 2510.0, 1010.0)]


def test_wide_hours_replace_the_daypart_cut(frame):
    wide = frame(
        "`Daypart.1` string, `Start.1` string, `End.1` string, `Impressions.1` string,"
        " `Daypart.2` string, `Start.2` string, `End.2` string, `Impressions.2` string",
        ("DA", "9", "10", "5", "PR", "21", "22", "1"), ("DA", "10", "11", "6", "PR", "21", "22", "n/a"),
        ("DA", "9", "10", "7", None, None, None, None), ("??", "1", "2", "9", None, None, None, None),
    )
    cut = providers.wide_hour_dayparts(wide, "b", "Spectrum")
    got = {f: float(v) for f, _, v, _, _ in rows(cut)}
    assert got == {"Daytime - 9AM-4PM": 18.0, "Prime - 8PM-12AM": 1.0}
    fact = frame(FACT, ("x", "b", Decimal(1), "Spectrum", "Daypart"), ("x", "b", Decimal(2), "Cox", "Daypart"), ("x", "b", Decimal(3), "Spectrum", "Day"))
    replaced = sorted((m, t, float(v)) for _, _, v, m, t in rows(providers.replace_cut(fact, cut)))
    assert replaced == [("Cox", "Daypart", 2.0), ("Spectrum", "Day", 3.0), ("Spectrum", "Daypart", 1.0), ("Spectrum", "Daypart", 18.0)]


def test_level_change_pairs_every_result(frame):
    schema = "student_id int, first_name string, last_name string, grade int, activity_type string, window_name string, benchmark_category string, sgp_vector string"
    person = (1, "F", "L", 4, "S")
    df = frame(
        schema,
        (*person, "Fall Window", "On Watch", "x"), (*person, "Fall Window", "On Watch", "y"), (*person, "Fall Window", "Other", "x"),
        (*person, "Winter", "Urgent Intervention", "FALL_WINTER"), (*person, "Winter", "At/Above Benchmark", "FALL_WINTER"),
        (2, "F", "L", 4, "S", "Fall Window", "On Watch", "x"),
    )
    got = rows(levels.level_change(df).select("student_id", "level_x", "level_y", "status"), "level_x", "level_y")
    assert got == [(1, None, 1, None), (1, None, 4, None), (1, 3, 1, -2), (1, 3, 4, 1)]


def test_simple_graph(frame):
    schema = "`from` bigint, `to` bigint, gender_from string"
    a = frame(schema, (1, 2, "male"), (2, 1, "female"), (3, 3, "male"))
    b = frame(schema, (1, 2, "male"), (1, 4, "male"))
    assert rows(graph.graph_edges(a, b), "src", "dst") == [(1, 2, "blue", "orange"), (1, 4, "blue", None)]
    assert graph.union_edges(a, b).count() == 5


def test_merged_days_need_all_sources(frame):
    sheet = "display_by string, impressions_text string"
    a = frame(sheet, ("Sunday", "1,000"), ("Monday", "5"), ("Total", "1,005"))
    b = frame(sheet, ("Sunday", "1"), ("Monday", "n/a"), ("Total", "2"))
    c = frame("day_of_week string, impressions_text string", ("Sun", "7"), ("Mon", "8"), ("Total", "9"))
    got = rows(sources_merge.day_impressions(a, b, c))
    assert [(d, v and float(v)) for d, v, _ in got] == [("Monday", None), ("Sunday", 1008.0), ("Total", 1016.0)]


def test_merge_suffixes(frame):
    a, b = frame("k int, v int", (1, 2)), frame("j int, v int, w int", (1, 3, 4))
    got = joins.merge_inner(a, b, "k", "j")
    assert got.columns == ["k", "v_x", "v_y", "w"] and rows(got) == [(1, 2, 3, 4)]


def test_scalars_side_by_side(frame):
    assert rows(joins.combine_scalars(frame("a int", (1,)), frame("b string", ("x",)))) == [(1, "x")]


def _plain_net(x, y, hidden, rule):
    """Resilient back-propagation in numpy, row by row weight 1."""
    import numpy as np

    size = x.shape[1] + 1
    w = np.random.default_rng(rule.seed).normal(size=hidden * size + hidden + 1)
    last, step, moved = np.zeros_like(w), np.full_like(w, rule.start), np.zeros_like(w)
    ones = np.hstack([np.ones((len(x), 1)), x])
    for _ in range(rule.epochs):
        h = 1 / (1 + np.exp(-ones @ w[:hidden * size].reshape(hidden, size).T))
        d = w[hidden * size] + h @ w[hidden * size + 1:] - y
        back = d[:, None] * w[hidden * size + 1:] * h * (1 - h)
        g = np.concatenate([(back.T @ ones).ravel(), [d.sum()], h.T @ d])
        if np.abs(g).max() < rule.threshold:
            break
        for i in range(len(w)):
            if g[i] * last[i] < 0:
                step[i], move, last[i] = max(step[i] * rule.down, rule.least), -moved[i], 0.0
                moved[i] = 0.0
            else:
                step[i] = min(step[i] * rule.up, rule.most) if g[i] * last[i] > 0 else step[i]
                move = moved[i] = -np.sign(g[i]) * step[i]
                last[i] = g[i]
            w[i] += move
    return w


@pytest.fixture
def learnable(frame):
    return frame(
        "id int, eyes double, face_forward double, chin_up double, attention double", *[(i, i % 100 / 100, i % 5 / 5, 0.5, float(i % 100 > 50)) for i in range(400)]
    )


@pytest.mark.parametrize("hidden", [1, 5])
def test_nets_equal_the_plain_version(learnable, hidden):
    import numpy as np

    from tallyloom.plans import learning

    rule = learning.Rprop(epochs=25)
    net = next(n for n in learning.fit_nets(learning.compacted(learnable, "attention").persist(), [2, hidden], rule=rule) if n.hidden == hidden)
    data = np.array([tuple(r)[1:] for r in learnable.collect()])
    want = _plain_net(data[:, :3], data[:, 3], hidden, rule)
    assert net.epochs == 25 and np.abs(np.array(net.weights) - want).max() < 1e-6


def test_nets_stop_at_the_threshold_and_learn(learnable):
    from tallyloom.plans import learning

    rows_of = learning.compacted(learnable, "attention").persist()
    (net,) = learning.fit_nets(rows_of, [1], rule=learning.Rprop(epochs=60))
    scored = learnable.select("attention", net.output().alias("score")).collect()
    assert sum((r["score"] > 0.5) == (r["attention"] == 1) for r in scored) > 380
    (early,) = learning.fit_nets(rows_of, [1], rule=learning.Rprop(threshold=1e6))
    assert early.epochs == 0 and early.gradient < 1e6


def test_net_fits_depend_on_the_weights(learnable, frame):
    from tallyloom.plans import learning

    trained = learning.net_fits(learnable, "id", rule=learning.Rprop(epochs=30)).collect()
    assert {(r["hidden"], r["learned"]) for r in trained} == {(1, True), (5, True)} and sum(r["n"] for r in trained) == 200
    untrained = learning.net_fits(learnable, "id", rule=learning.Rprop(epochs=0)).collect()
    assert not any(r["learned"] for r in untrained)
    assert learning.net_fits(learnable.limit(0), "id").collect() == []


def test_epochs_do_not_read_the_rows_again(spark, learnable):
    from tallyloom.plans import learning

    read = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda i: read.add(1) or i, "int").asNondeterministic()
    out = learning.net_fits(learnable.withColumn("id", counted("id")), "id", rule=learning.Rprop(epochs=3)).collect()
    assert sum(r["n"] for r in out) == 200 and read.value <= 3 * 400


def test_reach_files_that_name_no_provider(frame):
    from tallyloom.plans import reach

    df = frame(
        "file string, line_no bigint, segment string, hh string, imp string",
        ("Acme parallel RF.csv", 1, "Total", "10", "100"), ("Acme Spectrum parallel reach.csv", 1, "Total", "1", "2"), ("Best reach 2.csv", 1, "Total", "5", "50"), ("Plain.csv", 1, "x", "7", "8"),
    )
    got = rows(reach.read_reach(df, ["Comcast", "Spectrum"], words={"parallel": "Comcast"}, default="Comcast").select("brand", "mvpd", F.col("reach").cast("int"), F.col("impressions").cast("int")), "brand", "mvpd")
    assert got == [("Acme", "Comcast", 10, 100), ("Acme", "Spectrum", 1, 2), ("Best", "Comcast", 5, 50), ("Plain", "Comcast", 7, 8)]
    assert rows(reach.read_reach(df, ["Comcast", "Spectrum"], brand="B").select("brand", "mvpd")) == [("B", "Spectrum")]
