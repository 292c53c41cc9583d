"""Text functions against pandas ``.str`` on small frames of our own."""

import pandas as pd
from pyspark.sql import functions as F

from flowframe.functions import text as TX
from flowframe.operators import group as G

LABELS = ["\u00a0 Red-Kite\t", "owl", " heron-7-east ", "", "\u00c9mile-42", None]
NOTES = ["write to ann.lee@mail.test before noon", "ring +1 (555) 010-2030 today", "nothing here", "b@c.test or +1 (555) 010-9999", None]
READINGS = ["t=4 p=17 t=5", "none", "p=9", "t=12p=3", None]


def _col(spark, values):
    return spark.createDataFrame(pd.DataFrame({"i": range(len(values)), "s": values}), "i int, s string")


def _list(values):
    return [None if pd.isna(v) else v for v in values]


def test_strip_lower_length_split(spark):
    s = pd.Series(LABELS)
    got = _col(spark, LABELS).select(
        "i", TX.lower(TX.strip(F.col("s"))).alias("low"), TX.length(F.col("s")).alias("n"),
        *TX.split_columns(TX.strip(F.col("s")), "-", 3, ["a", "b", "c"])).orderBy("i").toPandas()
    assert _list(got["low"]) == _list(s.str.strip().str.lower())
    assert _list(got["n"]) == _list(s.str.len())
    parts = s.str.strip().str.split("-", expand=True)
    assert [_list(got[c]) for c in "abc"] == [_list(parts[k]) for k in range(3)]


def test_contains_prefix_digits_and_masking(spark):
    s = pd.Series(LABELS)
    got = _col(spark, LABELS).select(
        "i", TX.contains(F.col("s"), "-", regex=False).alias("dash"), TX.startswith(F.col("s"), " ").alias("blank"),
        TX.extract(F.col("s"), r"([0-9]+)").alias("digits"), TX.replace_regex(F.col("s"), r"(\w)-(\w)", r"\2+\1").alias("swap")
    ).orderBy("i").toPandas()
    assert _list(got["dash"]) == _list(s.str.contains("-", regex=False))
    assert _list(got["blank"]) == _list(s.str.startswith(" "))
    assert _list(got["digits"]) == _list(s.str.extract(r"([0-9]+)")[0])
    assert _list(got["swap"]) == _list(s.str.replace(r"(\w)-(\w)", r"\2+\1", regex=True))


def test_groups_that_take_no_part_are_missing(spark):
    """One pattern with alternatives: the branch that did not match is NULL, not ''."""
    for pattern in (r"(?P<mail>[a-z.]+@[a-z.]+)|(?P<phone>\+1 \([0-9]{3}\) [0-9-]+)",
                    r"(?P<word>[a-z]+) (?P<opt>z)?(?P<rest>.*)", r"(?P<maybe>x*)?@(?P<tail>[a-z]*)"):
        exp = pd.Series(NOTES).str.extract(pattern)
        got = _col(spark, NOTES).select("i", *TX.extract_named(F.col("s"), pattern)).orderBy("i").toPandas()
        for c in exp.columns:
            assert _list(got[c]) == _list(exp[c]), (pattern, c)


def test_code_needs_a_pattern_and_defaults(spark):
    got = _col(spark, READINGS).select("i", TX.extract_code(F.col("s"), r"p=(\d+)", -1).alias("p")).orderBy("i").toPandas()
    assert got["p"].tolist() == [17, -1, 9, 3, -1]


def test_every_match(spark):
    pattern = r"(?P<name>[tp])=(?P<value>\d+)"
    exp = pd.Series(READINGS).str.extractall(pattern).reset_index()
    got = (_col(spark, READINGS).select("i", F.posexplode(TX.extract_all(F.col("s"), pattern)).alias("match", "m"))
           .select("i", "match", "m.name", "m.value").orderBy("i", "match").toPandas())
    for mine, theirs in (("i", "level_0"), ("match", "match"), ("name", "name"), ("value", "value")):
        assert got[mine].tolist() == exp[theirs].tolist()


def test_explode_keeps_empty_list(spark):
    pdf = pd.DataFrame({"row": [7, 8, 9, 10], "xs": [[4], [], [1, 1], None]})
    got = G.explode_list(spark.createDataFrame(pdf, "row long, xs array<int>"), "xs").toPandas()
    assert len(got) == len(pdf.explode("xs")) == 5 and got["xs"].isna().sum() == 2


def test_opaque_group_function(spark):
    """A function without a native form still goes group by group."""
    pdf = pd.DataFrame({"g": ["a", "a", "b"], "v": [3.0, 1.0, 5.0]})
    got = G.group_apply(spark.createDataFrame(pdf), ["g"], lambda d: d.assign(v=d["v"].cumprod()), "g string, v double").toPandas()
    assert sorted(map(tuple, got.to_numpy())) == [("a", 3.0), ("a", 3.0), ("b", 5.0)]
