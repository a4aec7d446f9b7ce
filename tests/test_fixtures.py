"""Hand-made rows with known results, one trap each."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from support import rows_of

from tallyframe.functions import binning, metrics, numeric, parse
from tallyframe.operators import clean, distribution, frame as fr, joins, order, profile, quantiles, relate, rollup
from tallyframe.plans import cohort, era, scrape
from tallyframe.sources import html
from tallyframe.sources.csvfiles import BATTING, PLAYERS, read_csv

BATTERS = [
    ("a01", 1999, "AAA", 60, 200, 30, 60, 10, 40, 20, 10, 2, 2, 1),
    ("a01", 1999, "BBB", 50, 160, 25, 40, 5, 20, 16, 8, 0, None, 1),
    ("b02", 1999, "AAA", 100, 300, 40, 80, 8, 35, 30, 12, 1, 1, 2),
    ("c03", 2003, "AAA", 120, 16, 3, 1, 0, 0, 0, 0, 0, None, None),
    ("d04", 2004, "AAA", 130, 400, 60, 120, 20, 70, 40, 20, 2, 3, 4),
]
BAT_SCHEMA = (
    "playerID string, yearID int, teamID string, G long, AB long, R long, H long, HR long, RBI long, BB long, "
    "`2B` long, `3B` long, HBP long, SF long"
)


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_era_players(frame):
    players = era.era_players(frame(BATTERS, BAT_SCHEMA), {"early": (1990, 2003)})
    found = {r["playerID"]: r for r in players.collect()}
    assert set(found) == {"a01", "c03"}
    a, c = found["a01"], found["c03"]
    assert (a["G"], a["AB"], a["H"], a["BB"], a["HBP"], a["SF"], a["TB"]) == (110, 360, 100, 36, 2, 2, 167)
    assert (a["AVG"], a["OBP"], a["SLG"], a["OPS"]) == (0.278, 0.345, 0.464, 0.809)
    assert (c["HBP"], c["SF"], c["AVG"]) == (0, 0, 0.062)


def test_both_eras_and_missing_rates(frame):
    rows = BATTERS + [("e05", 2005, "AAA", 101, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0)]
    players = {r["playerID"]: r for r in era.era_players(frame(rows, BAT_SCHEMA)).collect()}
    assert players["a01"]["era"] == "steroid" and players["d04"]["era"] == "modern"
    assert players["e05"]["OBP"] == players["d04"]["OBP"] and players["e05"]["AVG"] is None
    season = era.era_players(frame(rows, BAT_SCHEMA), grain="season")
    assert "yearID" in season.columns and season.count() == 4
    assert {r["playerID"] for r in era.top_scorers(season, 1).collect()} == {"a01", "d04"}


def test_rounding_is_half_even(frame):
    df = frame([(0.0625,), (0.1875,), (2.5,), (-0.5,)], "x double")
    assert values(df, numeric.round_even("x", 3)) == [0.062, 0.188, 2.5, -0.5]
    assert values(df, numeric.round_even("x")) == [0.0, 0.0, 2.0, 0.0]


def test_share_code(frame):
    df = frame([(x,) for x in (0.0, 0.33, 0.34, 0.67, 0.68, -0.1, None)], "x double")
    assert values(df, binning.share_code("x")) == [0, 1, 2, 2, 3, 3, 3]


def test_count_code(frame):
    df = frame([(x,) for x in (0, 15, 16, 31, 45, 46, 60, 61, 75, 76, -1, None)], "x int")
    assert values(df, binning.count_code("x")) == [0, 1, 2, 3, 3, 5, 5, 4, 4, 5, 5, 5]
    assert values(df, binning.count_code("x", keep_gap=False)) == [0, 1, 2, 3, 3, 4, 4, 4, 4, 5, 5, 5]


def test_cut_code(frame):
    df = frame([(x,) for x in (0, 176, 177, 253, 324, 454, 455, None, -3)], "x int")
    assert values(df, binning.cut_code("x", binning.ELA_CUTS)) == [1, 1, 2, 2, 3, 4, 5, None, -3]


def test_quantile_bins(frame):
    df = frame([(float(x),) for x in range(1, 11)], "x double")
    bins = rows_of(distribution.quantile_bin_counts(df, "x"), "code", "n")
    assert bins == [(c, 2) for c in range(1, 6)]
    edges = [r["low"] for r in distribution.quantile_bin_counts(df, "x").orderBy("code").collect()]
    assert edges == pytest.approx([1, 2.8, 4.6, 6.4, 8.2])
    with pytest.raises(Exception, match="not unique"):
        distribution.quantile_bins(frame([(1.0,)] * 9, "x double"), "x").collect()


def test_histogram(frame):
    df = frame([(float(x),) for x in range(11)] + [(None,)], "x double")
    assert rows_of(distribution.histogram(df, "x", 5), "bin", "n") == [(0, 2), (1, 2), (2, 2), (3, 2), (4, 3)]
    density = distribution.histogram_density(df, "x", 5)
    assert density.agg(F.sum(F.col("density") * (F.col("high") - F.col("low")))).first()[0] == pytest.approx(1)
    assert rows_of(distribution.histogram(frame([(3.0,)] * 4, "x double"), "x", 2), "bin", "n") == [(0, 4), (1, 0)]


def test_density_integrates_to_one(frame):
    df = frame([(g, float(i * i % 37)) for g in "ab" for i in range(80)] + [("c", 1.0), (None, 2.0)], "g string, x double")
    kde = distribution.kernel_density(df, "x", "g", 200).toPandas()
    assert set(kde["g"]) == {"a", "b"}
    for _, part in kde.groupby("g"):
        part = part.sort_values("point")
        area = ((part["density"] + part["density"].shift()) / 2 * part["x"].diff()).sum()
        assert area == pytest.approx(1, abs=0.01)


def test_box(frame):
    df = frame([("a", float(x)) for x in (1, 2, 3, 4, 5, 100)], "g string, x double")
    r = distribution.box_stats(df, "x", "g").first()
    assert (r["q1"], r["median"], r["q3"]) == (2.25, 3.5, 4.75)
    assert (r["whisker_low"], r["whisker_high"], r["outliers"]) == (1.0, 5.0, 1)


def test_mode_and_fills(frame):
    df = frame([(s,) for s in ("b", "a", "b", "a", None, None, None)], "s string")
    assert rows_of(clean.column_modes(df, ["s"]), "mode", "freq", "distinct", "present") == [("a", 2, 2, 4)]
    assert sorted(values(clean.fill_mode(df, ["s"]), "s")) == ["a"] * 5 + ["b"] * 2
    numbers = frame([(1,), (None,), (3,)], "x int")
    assert sorted(values(clean.fill_mean(numbers, ["x"]), "x")) == [1, 2, 3]
    middle = frame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert sorted(values(clean.fill_median(middle, ["x"]), "x")) == [1, 2, 2.5, 3, 10]


def test_parse(frame):
    df = frame([("93%", "$31,141.72 "), ("0%", "$5"), (None, None)], "p string, m string")
    assert values(df, parse.percent_to_fraction("p")) == [0.93, 0.0, None]
    assert values(df, parse.money_to_number("m")) == [31141.72, 5.0, None]
    bad = frame([("abc",), ("nan%",), ("12d%",)], "p string")
    assert values(bad, parse.percent_to_fraction("p", strict=False)) == [None, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad.where("p = 'abc'").select(parse.percent_to_fraction("p")).collect()


def test_infer_numeric(frame):
    df = frame([("1", "a", "12d"), ("x", "b", "nan"), (None, None, "q")], "a string, b string, c string")
    typed = clean.infer_numeric(df)
    assert dict(typed.dtypes) == {"a": "double", "b": "string", "c": "string"}
    assert rows_of(typed, "a") == [(1.0,), (None,), (None,)]
    assert rows_of(clean.fill_zero(typed), "a", "b") == [(0.0, "0"), (0.0, "b"), (1.0, "a")]


def test_encode(frame):
    df = frame([("hi",), ("lo",), ("mid",), (None,)], "s string")
    assert values(df, parse.ordinal("s", {"hi": 3, "lo": 1})) == [3, 1, None, None]
    assert values(df, parse.merge_category("s", "lo", "mid")) == ["hi", "mid", "mid", None]
    assert values(df, parse.indicator("s", "hi")) == [1, 0, 0, 0]
    assert values(df, parse.strip_marker(F.concat("s", F.lit("*")))) == ["hi", "lo", "mid", None]


def test_keep_first_under_any_partitioning(frame):
    rows = [(1, "TOT", "p"), (2, "AAA", "p"), (3, "BBB", "q")]
    for parts in (1, 7):
        df = frame(rows, "id int, tm string, player string").repartition(parts)
        assert rows_of(order.keep_first(df, ["player"], [F.col("id")]), "id") == [(1,), (3,)]


def test_correlation(frame):
    df = frame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (None, 9.0, 5.0), (3.0, None, 5.0), (3.0, 7.0, 5.0)], "x double, y double, c double")
    assert relate.corr_pair(df, "x", "y").first()["r"] == pytest.approx(0.9933992678)
    assert relate.corr_pair(df, "x", "c").first()["r"] is None
    assert relate.corr_matrix(df, ["x", "y", "c"]).count() == 9


def test_redundant_columns(frame):
    rows = [(float(i), i + (i % 3) * 0.4, float((i * 7) % 11), float(-i)) for i in range(30)]
    df = frame(rows, "a double, b double, c double, d double")
    names = ["a", "b", "c", "d"]
    assert [r["column"] for r in relate.redundant_columns(df, names).orderBy("column").collect()] == ["b", "d"]
    assert {r["col_a"] for r in relate.corr_submatrix(df, names, "a").collect()} == {"a", "b", "d"}


@pytest.mark.parametrize("block", [512, 3])
def test_correlation_in_column_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(relate, "BLOCK", block)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 8)) + 1e9
    x[:, 3] = x[:, 0] * 2 + rng.normal(size=400)
    late = [None] * 150 + [0.1] * 250  # NULL in the first rows, constant after
    x[rng.random((400, 8)) < 0.1] = np.nan
    names = [f"c{i}" for i in range(8)] + ["late", "none"]
    rows = [(*[None if np.isnan(v) else float(v) for v in r], late[i], None) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).coalesce(1)
    got = {(r["col_a"], r["col_b"]): r["r"] for r in relate.corr_matrix(df, names).collect()}
    wanted = pd.DataFrame(x, columns=names[:8]).corr()
    assert len(got) == 100 and all(got[a, b] == pytest.approx(wanted.loc[a, b], abs=1e-6) for a in names[:8] for b in names[:8])
    assert all(got[a, b] is None for a in names for b in ("late", "none"))


def test_threshold(frame):
    df = frame([("w", 0.5), ("x", 0.3), ("y", 0.15), ("z", 0.05)], "f string, v double")
    shares = order.cumulative_share(df, "f", "v")
    assert order.count_to_threshold(shares, 0.9).first()["needed"] == 3
    assert order.first_rows(shares, [F.col("position")], 1).count() == 2


def test_not_equal_keeps_null(frame):
    df = frame([("TOT",), ("AAA",), (None,)], "tm string")
    assert fr.drop_value(df, "tm", "TOT").count() == 2


def test_masked_assignment(frame):
    df = fr.assign_where(frame([(1,), (2,), (None,)], "x int"), F.col("x") > 1, "y", 9)
    assert rows_of(df, "x", "y") == [(1, None), (2, 9), (None, None)]


def test_names_with_reserved_characters(frame):
    df = frame([(1, "a", 2.0)], "`park.key` int, `2B` string, `3P%` double")
    assert fr.columns_between(df, "park.key", "2B").columns == ["park.key", "2B"]
    assert fr.columns_at(df, [2, 0]).columns == ["3P%", "park.key"]
    assert profile.null_profile(df).count() == 3
    assert fr.drop_missing(df, ["park.key"]).count() == 1
    assert rollup.sum_by(df, ["2B"]).first()["park.key"] == 1


def test_sum_of_nothing_is_zero(frame):
    df = frame([("a", None), ("a", None), ("b", 2)], "k string, x int")
    assert rows_of(rollup.sum_by(df, ["k"])) == [("a", 0), ("b", 2)]


def test_join_suffixes_and_null_keys(frame):
    a = frame([("p", 1), (None, 2)], "k string, x int")
    b = frame([("p", 10), (None, 20), ("q", 30)], "k string, x int")
    assert rows_of(joins.merge(a, b, ["k"]), "k", "x_x", "x_y") == [("p", 1, 10)]
    assert rows_of(joins.merge(a, b, ["k"], null_safe=True), "k", "x_x", "x_y") == [("p", 1, 10), (None, 2, 20)]


def test_cohorts(frame):
    seasons = frame(
        [(1998.0, "Al*", "X", 10.0, 199.5, 20.0), (1998.0, "Bo", "TOT", 10.0, 300.0, 9.0), (1999.0, "Bo", None, 10.0, 300.0, 30.0)],
        "Year double, Player string, Tm string, G double, MP double, PER double",
    )
    players = frame([("Al", 1997), ("Bo*", 1997), ("Cy", 1990)], "Player string, `Rookie Year` int")
    spec = {"G": ["sum"], "PER": ["mean"]}
    rounded = cohort.compare_cohorts(seasons, players, range(1980, 2018), [1997], spec=spec)
    assert rows_of(rounded) == [(1996, 20.0, 25.0)]
    exact = cohort.compare_cohorts(seasons, players, range(1980, 2018), [1997], digits=None, spec=spec)
    assert rows_of(exact) == [(1996, 10.0, 30.0)]


PAGE = (
    "<table><tr><th>Rk</th><th>Player</th><th>G</th></tr><tr><th>1</th><td>p</td><td>9</td></tr>"
    "<tr><th>2</th><td>q</td><td>8</td></tr><tr><th>Rk</th><th>Player</th><th>G</th></tr></table>"
)


@pytest.mark.parametrize("reader", [html.table_rows, html.parsed_table_rows])
def test_html_rows(frame, reader):
    pages = frame([(1, PAGE)], "id int, html string")
    assert [r["name"] for r in html.header_names(pages, "html", ["id"]).orderBy("pos").collect()] == ["Player", "G"]
    one = html.to_columns(reader(pages, "html", ["id"], skip=1), ["Player", "G"], ["id"])
    assert rows_of(one, "Player", "G") == [("p", "9"), ("q", "8"), (None, None)]
    two = html.to_columns(reader(pages, "html", ["id"]), ["Player", "G"], ["id"])
    assert rows_of(two, "row", "Player", "G") == [(0, "q", "8"), (1, None, None)]


def test_messy_html(frame):
    page = (
        "<!-- <tr><td>hidden</td></tr> --><SCRIPT>var s='<tr><td>no</td></tr>'</SCRIPT><TABLE><TR CLASS=x><TD>a &amp; <b>b</b>"
        "<td title='t'>&lt;c&gt;<tr><td>d</td></tr></TABLE>"
    )
    rows = html.table_rows(frame([(1, page)], "id int, html string"), "html", ["id"], skip=0).orderBy("row").collect()
    assert [r["cells"] for r in rows] == [["a & b", "<c>"], ["d"]]
    nested = "<table><tr><td>x<table><tr><td>y</td></tr></table></td><td>z</td></tr></table>"
    parsed = html.parsed_table_rows(frame([(1, nested), (2, None)], "id int, html string"), "html", ["id"], skip=0)
    assert [r["cells"] for r in parsed.orderBy("row").collect()] == [["xy", "z"], ["y"]]


def test_pages_keep_their_own_headers(frame):
    page = lambda names, *rows: "<table><tr><th>Rk</th>" + "".join(f"<th>{n}</th>" for n in names) + "</tr>" + "".join(
        "<tr><th>1</th>" + "".join(f"<td>{v}</td>" for v in r) + "</tr>" for r in rows) + "</table>"
    pages = frame([(1, page(["Player", "Size"], ("a", 1))), (2, page(["Size", "Player", "G"], (2, "b", 7), (3,))), (3, None)], "id int, html string")
    table = scrape.season_table(pages, "html", "id", skip=1)
    assert table.columns == ["id", "row", "Player", "Size", "G"]
    assert rows_of(table) == [(1, 0, "a", "1", None), (2, 0, "b", "2", "7"), (2, 1, None, "3", None)]
    assert rows_of(scrape.season_table(pages, "html", "id", ["G"], skip=1), "G") == sorted([("7",), (None,), (None,)], key=repr)
    long = frame([(1, page(["Player"], ("a", 99)))], "id int, html string")
    with pytest.raises(Exception, match="2 cells under 1 names"):
        scrape.season_table(long, "html", "id", skip=1).collect()


def test_overlapping_eras(frame):
    rows = [("p", y, *[1] * 11) for y in (1995, 2000, 2010)]
    batting = frame(rows, "playerID string, yearID int, " + ", ".join(f"`{c}` long" for c in era.COUNTS))
    seasons = era.season_totals(batting, {"one": (1990, 2003), "two": (1999, 2016)}, min_games=0)
    assert rows_of(seasons, "era", "yearID") == [("one", 1995), ("one", 2000), ("two", 2000), ("two", 2010)]


def test_correlations_of_gaps_constants_and_offsets(frame):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4)) + [0, 1e7, -5, 0]
    x[:, 3] = 0.1
    x[::7, 0] = x[3::11, 2] = np.nan
    df = frame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], "a double, b double, c double, d double")
    got = {(r["col_a"], r["col_b"]): r["r"] for r in relate.corr_matrix(df, list("abcd")).collect()}
    want = pd.DataFrame(x, columns=list("abcd")).corr()
    assert len(got) == 16 and all(got["d", c] is None and got[c, "d"] is None for c in "abcd")
    assert all(got[i, j] == pytest.approx(want.loc[i, j], abs=1e-8) for i in "abc" for j in "abc")


def test_season_cleaning_keeps_first_row(frame):
    rows = "".join(
        f"<tr><th>1</th><td>{p}</td><td>{t}</td><td>{g}</td></tr>" for p, t, g in (("Al", "TOT", "9"), ("Al", "X", ""), ("Bo", "Y", ""))
    )
    head = "<tr><th>Rk</th><th>Player</th><th>Tm</th><th>G</th></tr>"
    pages = frame([(1, f"<table>{head}<tr></tr>{rows}{head}</table>")], "id int, html string")
    season = scrape.clean_season(scrape.season_table(pages, "html", "id"), "id")
    assert rows_of(season, "Player", "Tm", "G") == [("Al", "TOT", 9.0), ("Bo", "Y", 0.0)]
    joined = scrape.joined_seasons(season, season)
    assert sorted(joined.columns) == ["G_x", "G_y", "Player", "Tm_x", "Tm_y"]


def test_csv_by_name_and_whole(spark, tmp_path):
    path = tmp_path / "bat.csv"
    columns = BATTING.names[::-1]
    path.write_text(",".join(columns) + ",note\n" + ",".join("" if c == "HBP" else "7" for c in columns) + ",x\n")
    row = read_csv(spark, str(path), BATTING).first()
    assert row["HBP"] is None and row["yearID"] == 7 and row["playerID"] == "7"
    people = tmp_path / "players.csv"
    people.write_text("name,from,to,pos,h,w,born,college\nAl*,1990,1995,G,6-1,190,x,\n")
    player = read_csv(spark, str(people), PLAYERS, whole=True).first()
    assert player["Rookie Year"] == 1990 and player["College"] is None
    marked = tmp_path / "marked.csv"
    marked.write_text("playerID," + ",".join(c for c in columns if c != "playerID") + "\nx," + ",".join(["N/A"] * (len(columns) - 1)) + "\n")
    assert [v for v in read_csv(spark, str(marked), BATTING).first() if v is not None] == ["x"]
    marked.write_text("playerID," + ",".join(c for c in columns if c != "playerID") + "\nx," + ",".join(["7q"] * (len(columns) - 1)) + "\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_csv(spark, str(marked), BATTING).collect()


def test_metrics(frame):
    df = frame([(100.0, 5.0)], "MP double, G double")
    assert values(df, metrics.minutes_per_game()) == [20.0]
    assert values(frame([(1.0, 0.0)], "MP double, G double"), metrics.minutes_per_game()) == [None]


def test_describe_and_profile(frame):
    df = frame([("a", 1), ("b", None), ("a", 2), (None, 2)], "s string, n int")
    assert rows_of(profile.describe_text(df, ["s"])) == [("s", 3, 2, "a", 2)]
    assert rows_of(profile.schema_profile(df), "column", "type", "non_null") == [("n", "int", 3), ("s", "string", 3)]
    assert rows_of(profile.null_profile(df)) == [("n", 1, 0.25), ("s", 1, 0.25)]
    shares = profile.share_of_total(df, "s")
    assert shares.agg(F.sum("share")).first()[0] == pytest.approx(1)
    assert rows_of(profile.distinct_count_distribution(df)) == [(2, 1)]


def test_trends(frame):
    df = frame([(g, float(i), 3.0 * i + 1, 2.0) for g in "ab" for i in range(5)], "g string, x double, y double, c double")
    found = {(r["g"], r["stat"]): r for r in relate.trend_by_stat(df, ["x", "c"], "y", ["g"]).collect()}
    assert found["a", "x"]["slope"] == pytest.approx(3) and found["b", "x"]["intercept"] == pytest.approx(1)
    assert found["a", "c"]["slope"] is None and found["a", "c"]["r"] is None
    assert values(relate.with_trend(df, "x", "y"), "trend") == pytest.approx(values(df, "y"))


def test_quantiles_of_nothing(frame):
    df = frame([("a", None)], "g string, x double")
    assert quantiles.quantiles(df, ["g"], "x", [0.5]).count() == 0
    assert math.isclose(quantiles.quantiles(frame([("a", 4.0)], "g string, x double"), ["g"], "x", [0.5]).first()["q"][0], 4.0)
