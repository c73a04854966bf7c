import random

import pytest
from pyspark.sql import functions as F

from scopewise.operators import metrics as M
from scopewise.operators import ranking as R
from scopewise.operators import summaries as S
from scopewise.operators.quality import enforce_metrics
from scopewise.operators.views import ranking_view
from scopewise.spec import DEFAULT_SPEC, FactSpec


def by_name(df):
    return {r["entity_name"]: r for r in df.collect()}


def test_ranks_shares_and_flags(small):
    metrics = M.entity_metrics(small)
    assert metrics.columns == [*DEFAULT_SPEC.required, *DEFAULT_SPEC.derived]
    assert metrics.schema == DEFAULT_SPEC.metrics_schema() or [
        f.dataType for f in metrics.schema
    ] == [f.dataType for f in DEFAULT_SPEC.metrics_schema()]
    rows = by_name(metrics)
    order = sorted(rows, key=lambda n: rows[n]["rank_total"])
    assert [rows[n]["total"] for n in order] == [250, 200, 120, 0]
    alpha = rows["ALPHA"]
    assert (alpha["micro_share_pct"], alpha["small_share_pct"], alpha["medium_share_pct"]) == (80.0, 16.0, 4.0)
    assert rows["GAMMA"]["scope_total_share_pct"] == round(200 / 570 * 100, 4)
    delta = rows["DELTA"]
    assert delta["dominant_category"] == "NO_REGISTRATIONS"
    assert delta["micro_share_pct"] == delta["scope_total_share_pct"] == 0.0
    assert all(r["top_10_flag"] and r["bottom_10_flag"] for r in rows.values())
    enforce_metrics(metrics)


def test_zero_scope_total(fact):
    metrics = M.entity_metrics(fact([("A", "1", "X", "1", 0, 0, 0), ("A", "1", "Y", "2", 0, 0, 0)]))
    assert {r["scope_total_share_pct"] for r in metrics.collect()} == {0.0}
    enforce_metrics(metrics)


def test_ascending_rank_is_not_mirrored(fact):
    rows = [("A", "1", n, c, t, 0, 0) for n, c, t in (("X", "2", 5), ("X", "1", 5), ("B", "3", 5), ("Z", "4", 1))]
    found = {r["entity_code"]: r for r in M.entity_metrics(fact(rows)).collect()}
    assert [found[c]["rank_total"] for c in "3124"] == [1, 2, 3, 4]
    assert [found[c]["rank_total_ascending"] for c in "4312"] == [1, 2, 3, 4]


def brute_force(rows):
    """Ranks by plain sorting, per scope."""
    ranks = {}
    for scope in {r[0] for r in rows}:
        inside = [r for r in rows if r[0] == scope]
        total = {r[3]: r[4] + r[5] + r[6] for r in inside}
        down = sorted(inside, key=lambda r: (-total[r[3]], r[2], r[3]))
        up = sorted(inside, key=lambda r: (total[r[3]], r[2], r[3]))
        for i, r in enumerate(down, 1):
            ranks[r[3]] = [i]
        for i, r in enumerate(up, 1):
            ranks[r[3]].append(i)
    return ranks


def skewed_rows(seed=3, n=600):
    """One scope holds nearly everything; a third of it ties at zero."""
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        scope = "BIG" if i % 20 else f"S{i % 7}"
        zero = pick.random() < 0.35
        counts = [0, 0, 0] if zero else [pick.randrange(6), pick.randrange(4), pick.randrange(3)]
        rows.append((scope, scope, f"N{pick.randrange(40):02d}", str(i), *counts))
    return rows


@pytest.fixture
def many_slices(spark):
    """Small tables in sixteen slices, so that runs cross their borders."""
    changed = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("strategy", ["window", "range"])
def test_both_strategies_equal_plain_sorting(fact, many_slices, strategy):
    rows = skewed_rows()
    found = R.add_ranks(fact(rows), strategy=strategy).collect()
    assert {r["entity_code"]: [r["rank_total"], r["rank_total_ascending"]] for r in found} == brute_force(rows)


def test_strategies_give_the_same_metrics(fact, many_slices):
    df = fact(skewed_rows(seed=9))
    window = M.entity_metrics(df, strategy="window")
    ranged = M.entity_metrics(df)
    assert window.exceptAll(ranged).isEmpty() and ranged.exceptAll(window).isEmpty()
    with pytest.raises(ValueError):
        R.add_ranks(df, strategy="other")


def test_positions(spark, many_slices):
    values = list(range(500))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v, str(v)) for v in values], "v int, t string").repartition(7)
    found = R.add_position(df, ["v"]).collect()
    assert {(r["v"], r["position"]) for r in found} == {(v, v + 1) for v in range(500)}


def test_snapshots_are_never_combined(spark, fact):
    spec = FactSpec(snapshot_cols=("as_of",))
    one = fact([("A", "1", "X", "1", 5, 0, 0), ("A", "1", "Y", "2", 15, 0, 0)])
    two = fact([("A", "1", "X", "1", 1, 0, 0), ("A", "1", "Y", "2", 0, 0, 0)])
    both = one.withColumn("as_of", F.lit("2025")).unionByName(two.withColumn("as_of", F.lit("2026")))
    for strategy in ("window", "range"):
        found = {(r["as_of"], r["entity_name"]): r for r in M.entity_metrics(both, spec, strategy).collect()}
        assert found["2025", "Y"]["rank_total"] == 1
        assert found["2026", "X"]["rank_total"] == 1
        assert found["2025", "X"]["scope_total_share_pct"] == 25.0
        assert found["2026", "X"]["scope_total_share_pct"] == 100.0


def test_published_figures(published):
    metrics = M.entity_metrics(published)
    enforce_metrics(metrics)
    kpi = S.executive_summary(metrics).first()
    assert (kpi["micro_total"], kpi["small_total"], kpi["medium_total"], kpi["total_total"]) == (
        2969687, 54335, 4245, 3028267,
    )
    assert (kpi["micro_share_pct"], kpi["small_share_pct"], kpi["medium_share_pct"]) == (98.0656, 1.7943, 0.1402)
    assert kpi["average_per_entity"] == 91765.67
    assert (kpi["highest_entity_name"], kpi["highest_entity_code"], kpi["highest_total"]) == ("AHMADABAD", "438", 603761)
    assert (kpi["lowest_entity_name"], kpi["lowest_total"]) == ("DANG", 2404)
    assert S.mean_share_sum(metrics).first()["mean_share_sum"] == 100.0
    assert ranking_view(metrics, 10).count() == 20


def test_all_published_columns(published, published_rows):
    """All derived columns of all entities."""
    derived = {
        "rank_total": ("rank_total", int),
        "rank_total_ascending": ("rank_total_ascending", int),
        "micro_share_pct": ("micro_share_pct", float),
        "small_share_pct": ("small_share_pct", float),
        "medium_share_pct": ("medium_share_pct", float),
        "state_total_share_pct": ("scope_total_share_pct", float),
        "dominant_category": ("dominant_category", str),
        "top_10_flag": ("top_10_flag", lambda v: v == "True"),
        "bottom_10_flag": ("bottom_10_flag", lambda v: v == "True"),
    }
    found = by_name(M.entity_metrics(published))
    assert len(found) == len(published_rows) == 33
    names = [c for c in published_rows[0] if c not in ("state_name", "state_id", "district_name", "lg_dt_code", "medium", "micro", "small", "total")]
    assert len(names) == 9
    for row in published_rows:
        own = found[row["district_name"]]
        for theirs, (ours, kind) in zip(names, derived.values(), strict=True):
            assert own[ours] == kind(row[theirs]), (row["district_name"], theirs)


def twelve(fact):
    return fact([("GUJARAT", "24", f"E{i:02d}", str(i), 100 * i, 10 * i, i) for i in range(1, 13)])


def test_kpis_of_twelve(fact):
    kpi = S.executive_summary(twelve(fact)).first()
    assert (kpi["total_total"], kpi["average_per_entity"]) == (8658, 721.5)


def test_views(fact):
    metrics = M.entity_metrics(twelve(fact))
    view = ranking_view(metrics, 3)
    assert view.columns[:2] == ["ranking_group", "ranking_position"]
    top = view.where("ranking_group = 'TOP'").orderBy("ranking_position").collect()
    bottom = view.where("ranking_group = 'BOTTOM'").orderBy("ranking_position").collect()
    assert [r["entity_name"] for r in top] == ["E12", "E11", "E10"]
    assert [r["entity_name"] for r in bottom] == ["E01", "E02", "E03"]
    assert ranking_view(metrics, 50).count() == 24
    assert R.top_n(twelve(fact), 50).count() == 12
    with pytest.raises(ValueError, match="at least 1"):
        ranking_view(metrics, 0)
    with pytest.raises(ValueError, match="at least 1"):
        R.top_n(metrics, 0)


def test_top_n_equals_filtered_ranks(fact):
    df = fact(skewed_rows())
    ranked = R.add_ranks(df)
    for found, rank in ((R.top_n(df, 4), "rank_total"), (R.bottom_n(df, 4), "rank_total_ascending")):
        expected = ranked.where(f"{rank} <= 4").select(*df.columns)
        assert found.drop("ranking_position").exceptAll(expected).isEmpty()
        assert found.count() == expected.count()
