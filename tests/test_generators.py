import re

import pytest
from pyspark.sql import functions as F

from finloom import functions as fn
from finloom.functions.templates import template_runs
from finloom.functions.values import amount_units
from finloom.plans import specs as s
from finloom.plans.tables import ROW_ID, project_table
from finloom.sources.domains import read_domains
from finloom.sources.rows import row_ids


def build(spark, specs, rows=2000, partitions=4, **choices):
    return project_table(row_ids(spark, rows, partitions), s.TableSpec("t", (), tuple(specs)), rows, **choices)


MIXED = (s.DenseKey("id"), s.Pick("kind", ("a", "b", "c"), (5, 3, 2)), s.words("name", 9, 4, null_rate=0.3),
         s.Amount("amt"), s.Day("day"), s.Template("code", "rr-dddd"), s.Real("size", 1, 9))


def test_values_do_not_depend_on_partitions(spark):
    one = build(spark, MIXED, partitions=1)
    many = build(spark, MIXED, partitions=13)
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_seed_and_table_name_change_the_stream():
    base = fn.salt(42, "t", "c")
    assert len({base, fn.salt(43, "t", "c"), fn.salt(42, "u", "c"), fn.salt(42, "t", "d")}) == 4
    assert 0 <= base < 2**63


def test_text_is_spread_evenly(spark):
    letters = (build(spark, [s.Template("t", "rrr")], rows=26_000).select(F.explode(F.split("t", "")).alias("c"))
               .where("c <> ''").groupBy("c").count().collect())
    assert len(letters) == 26
    assert all(abs(row["count"] - 3000) < 400 for row in letters)


@pytest.mark.parametrize("template", ["rrd", "+d (ddd) ddd-dddd", "rrrrrrrr.rrrrrrr", "ZFSM_rrd", "aaa", "r" * 40,
                                      "d" * 40, "\\r\\a\\d\\\\rad", "no marks!".replace("a", "e").replace("r", "x")])
def test_text_matches_its_own_pattern(spark, template):
    rows = build(spark, [s.Template("t", template)], rows=200).collect()
    pattern = re.compile(fn.template_regex(template))
    assert all(pattern.fullmatch(row.t) for row in rows)


def test_template_ending_in_escape_raises():
    with pytest.raises(ValueError):
        template_runs("rr\\")


def test_weights_are_relative(spark):
    rows = build(spark, [s.Pick("p", ("x", "y"), (41, 41))], rows=20_000).groupBy("p").count().collect()
    assert all(abs(row["count"] - 10_000) < 500 for row in rows)
    assert build(spark, [s.Pick("p", ("x", "y"), (1, 0))]).where("p = 'y'").isEmpty()


@pytest.mark.parametrize("weights", [(0, 0), (1, -1), (1.5, 2), (1,)])
def test_bad_weights_raise(weights):
    with pytest.raises(ValueError):
        fn.pick("1L", ("x", "y"), weights)


def test_quotes_in_values_survive(spark):
    values = ("Men's", "back\\slash", 'double"quote')
    seen = {row.p for row in build(spark, [s.Pick("p", values)]).select("p").distinct().collect()}
    assert seen == set(values)


@pytest.mark.parametrize("rate,low,high", [(0.0, 0, 0), (0.3, 5600, 6400), (1.0, 20_000, 20_000), (1.7, 20_000, 20_000),
                                           (-1, 0, 0), (None, 0, 0)])
def test_null_rate(spark, rate, low, high):
    nulls = build(spark, [s.Day("d", null_rate=rate)], rows=20_000).where("d is null").count()
    assert low <= nulls <= high


def test_ranges_hold_their_ends(spark):
    frame = build(spark, [s.Whole("w", -2, 3), s.Day("d", "2024-02-28", "2024-03-01"), s.Amount("a", "-0.00002", "0.00002")],
                  rows=3000)
    low = frame.agg(F.min("w"), F.max("w"), F.min("d"), F.max("d"), F.min("a"), F.max("a")).first()
    assert [str(x) for x in low] == ["-2", "3", "2024-02-28", "2024-03-01", "-0.00002", "0.00002"]


def test_amounts_are_exact_and_wide_ranges_use_a_coarser_unit():
    assert amount_units(-2_000_000, 5_000_000, 5)[0] == 5
    assert amount_units("0.0001", "200", 18)[0] == 15
    with pytest.raises(ValueError):
        amount_units(5, 1, 2)


def test_reference_stays_inside_its_domain(spark):
    frame = build(spark, [s.Ref("r", "p"), s.Ref("one", "q")], rows=5000, sizes={"p": 7, "q": 1})
    assert {row.r for row in frame.select("r").distinct().collect()} == set(range(1, 8))
    assert {row.one for row in frame.select("one").distinct().collect()} == {1}


def test_undeclared_domain_raises(spark):
    with pytest.raises(KeyError, match="declare how many rows"):
        build(spark, [s.Ref("r", "p")])


def test_pad_grows_with_its_domain_on_both_sides(spark):
    assert fn.pad_width(4, 9_999) == 4 and fn.pad_width(4, 10_000) == 5
    with pytest.raises(ValueError):
        fn.pad_width(4, 10_000, strict=True)
    parent = build(spark, [s.TextKey("k", "C", 2)], rows=150)
    child = build(spark, [s.TextRef("k", "p", "C", 2)], rows=2000, sizes={"p": 150})
    assert parent.select("k").distinct().count() == 150
    assert child.join(parent, "k", "left_anti").isEmpty()


def test_partial_copy_takes_its_pad_from_the_dimension(spark):
    part = build(spark, [s.TextKey("k", "C", 2, domain="p")], rows=50, sizes={"p": 150})
    assert part.first().k == "C_001"


def test_code_agrees_with_its_id_unless_independent(spark):
    columns = (s.Ref("pid", "p"), s.TextRef("code", "p", "P", 4, draws_as="pid"))
    same = F.col("code") == fn.text_key(F.col("pid"), "P", 4)
    paired = build(spark, columns, sizes={"p": 50})
    apart = build(spark, columns, sizes={"p": 50}, options=s.Options(independent_codes=True))
    assert paired.where(~same).isEmpty()
    assert apart.where(same).count() < 200


def test_ragged_levels_have_no_gaps(spark):
    levels = s.level_family("lvl", 8, 2, 0.15, cd="rr")
    gap = " or ".join(f"(lvl_{n}_cd is null and lvl_{n + 1}_cd is not null)" for n in range(1, 8))
    assert build(spark, levels, options=s.Options(ragged=True)).where(gap).isEmpty()
    assert not build(spark, levels).where(gap).isEmpty()


def test_domains_replace_defaults_and_the_longer_name_wins(spark):
    domains = read_domains({"domains": {"kind": {"values": ["q"]}, "t.kind": {"values": ["z"], "weights": [3]},
                                        "amounts": {"amt": {"min": 1, "max": 2}}}})
    frame = build(spark, MIXED, domains=domains)
    assert {row.kind for row in frame.select("kind").distinct().collect()} == {"z"}
    assert frame.where("amt not between 1 and 2").isEmpty()


def test_paired_lists_stay_paired_only_while_they_match(spark):
    pair = (s.Pick("cd", ("a", "b"), (3, 1)), s.Pick("nm", ("A", "B"), (3, 1), draws_as="cd"))
    mixed = F.col("nm") != F.upper("cd")
    assert build(spark, pair).where(mixed).isEmpty()
    both = read_domains({"cd": {"values": ["x", "y", "z"]}, "nm": {"values": ["X", "Y", "Z"]}})
    assert build(spark, pair, domains=both).where(mixed).isEmpty()
    one = build(spark, pair, domains=read_domains({"cd": {"values": ["x", "y", "z"]}}))
    assert {row.nm for row in one.where("cd = 'z'").select("nm").distinct().collect()} == {"A", "B"}


PAIR = {"cd+nm": {"pairs": [["x", "X"], ["y", "Y"], ["z", "Z"]], "weights": [5, 2, 1]}}


@pytest.mark.parametrize("options", [s.Options(), s.Options(independent_codes=True)])
@pytest.mark.parametrize("columns", [
    (s.Pick("cd", ("a", "b")), s.Pick("nm", ("A", "B", "C"), (3, 1, 1))),
    (s.Pick("cd", ("a", "b")), s.Pick("nm", ("A", "B"), draws_as="cd", null_rate=0.3))])
def test_pairs_name_one_member_whatever_the_columns_were(spark, columns, options):
    frame = build(spark, columns, domains=read_domains(PAIR), options=options)
    assert frame.where(F.col("nm") != F.upper("cd")).isEmpty()
    assert {row.cd for row in frame.select("cd").distinct().collect()} == {"x", "y", "z"}
    shares = {row.cd: row["count"] / frame.count() for row in frame.groupBy("cd").count().collect()}
    assert shares["x"] > shares["y"] > shares["z"] > 0


@pytest.mark.parametrize("options", [s.Options(), s.Options(independent_codes=True)])
def test_pairs_of_ordered_and_linked_columns(spark, options):
    pairs = {"cd+nm": {"pairs": [["x", "X"], ["y", "Y"], ["z", "Z"]]}}
    for columns in ((s.Cycle("cd", ("a",), 4), s.Cycle("nm", ("A", "B"), 4)),
                    (s.CodeOf("cd", ("a", "b"), "id"), s.CodeOf("nm", ("A", "B"), "id"))):
        frame = build(spark, columns, domains=read_domains(pairs), options=options)
        assert frame.where(F.col("nm") != F.upper("cd")).isEmpty() and frame.select("cd").distinct().count() == 3


def test_ranges_of_reals_dates_and_periods(spark):
    columns = (s.Real("r", 0.0, 1.0), s.Day("d"), s.Period("p", "cal"), s.YearOf("y", "p"), s.Constant("c", "EN"))
    domains = read_domains({"r": {"min": -2, "max": -1}, "d": {"min": "2024-02-28", "max": "2024-03-01"},
                            "p": {"min": 201911, "max": 202002}, "c": {"constant": "FR"}})
    frame = build(spark, columns, domains=domains, sizes={"cal": 192})
    assert frame.where("r not between -2 and -1 or c <> 'FR' or y <> p div 100").isEmpty()
    assert sorted(str(row.d) for row in frame.select("d").distinct().collect()) == [
        "2024-02-28", "2024-02-29", "2024-03-01"]
    assert sorted(row.p for row in frame.select("p").distinct().collect()) == [201911, 201912, 202001, 202002]


@pytest.mark.parametrize("columns, domains, why", [
    ((s.Period("p", "cal"),), {"p": {"min": 201711, "max": 201802}}, "not a range"),
    ((s.Period("p", "cal"),), {"p": {"min": 201801, "max": 202101}}, "not a range"),
    ((s.Period("p", "cal"),), {"p": {"min": 201813, "max": 201902}}, "no fiscal period"),
    ((s.Day("d"),), {"d": {"min": "2024-03-01", "max": "2024-02-01"}}, "empty range"),
    ((s.Day("d"),), {"d": {"values": ["2024-03-01"]}}, "takes a range"),
    ((s.Pick("k", ("a",)),), {"k": {"min": 1, "max": 2}}, "takes a list"),
    ((s.Pick("k", ("a",)),), {"k": {"values": []}}, "empty"),
    ((s.Cycle("k", ("a",)),), {"k": {"values": ["a", "b"], "weights": [1, 2]}}, "without weights"),
    ((s.Constant("k", "a"),), {"k": {"values": ["a", "b"]}}, "one value"),
    ((s.Template("k", "rr"),), {"k": {"values": ["a"]}}, "follow from"),
    ((s.Pick("cd", ("a",)), s.Cycle("nm", ("A",))), {"cd+nm": {"pairs": [["x", "X"]]}}, "not drawn as"),
    ((s.Cycle("cd", ("a",), 2), s.Cycle("nm", ("A",))), {"cd+nm": {"pairs": [["x", "X"]]}}, "not repeated as"),
    ((s.Pick("cd", ("a",)), s.Pick("nm", ("A",))), {**PAIR, "t.cd": {"values": ["q"]}}, "another domain"),
    ((s.Pick("o", ("a",)), s.Pick("cd", ("a",), draws_as="o"), s.Pick("nm", ("A",))), PAIR, "is drawn as o"),
])
def test_domains_that_do_not_suit_their_column_are_refused(spark, columns, domains, why):
    with pytest.raises(ValueError, match=why):
        build(spark, columns, domains=read_domains(domains), sizes={"cal": 24}).collect()


@pytest.mark.parametrize("broken", [{"cd": {"pairs": [["x", "X"]]}}, {"cd+nm": {"pairs": [["x"]]}}, {"cd+nm": {"pairs": []}},
                                    {"k": {"min": 1, "max": None}}])
def test_malformed_domains_are_refused(broken):
    with pytest.raises(ValueError):
        read_domains(broken)


def test_subset_extra_and_rename(spark):
    frame = build(spark, MIXED, columns=["kind", "id"], extra=[("twice", F.col(ROW_ID) * 2)], rename={"kind": "sort"})
    assert frame.columns == ["sort", "id", "twice"]
    with pytest.raises(KeyError):
        build(spark, MIXED, columns=["nothing"])


def test_label_is_null_when_a_part_is(spark):
    frame = build(spark, [s.Pick("p", ("x",), null_rate=0.5), s.Label("l", "a {p} b")])
    assert frame.where("(p is null) <> (l is null)").isEmpty()
    assert frame.where("l is not null").first().l == "a x b"


def test_int_key_refuses_too_many_rows():
    with pytest.raises(ValueError):
        fn.int_key(None, 2**31)


def test_fiscal_periods(spark):
    assert fn.period_count(None) == fn.period_count(0) == fn.period_count(192) == 192
    with pytest.raises(ValueError):
        fn.period_count(193)
    assert fn.period_count(30) == 30
    periods = spark.range(30).select(fn.nth_period(F.col("id")).alias("p")).collect()
    assert [row.p for row in periods][::12] == [201801, 201901, 202001]
    back = spark.range(30).select(F.col("id"), fn.period_position(fn.nth_period(F.col("id"))).alias("n"))
    assert back.where("n <> id + 1").isEmpty()
