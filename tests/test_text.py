import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scholarloom.functions import text as tx


def values(spark, texts, *columns):
    return [tuple(r) for r in spark.createDataFrame([(t,) for t in texts], "t string").select(*columns).collect()]


def test_white_space(spark):
    got = values(spark, ["  a  b\n", None], tx.strip("t"), tx.collapse("t"), tx.squeeze_blank_lines(F.lit("\n\na\n\n\n\nb ")))
    assert got[0] == ("a  b", "a b", "a\n\nb\n") and got[1][:2] == (None, None)


def test_numbers(spark):
    [(a, b)] = values(spark, ["x1 10-20 18.5 <0.05 −3e-4 7% v2.0.1"], tx.structured_numbers("t"), tx.content_numbers("t"))
    assert a == ["20", "18.5", "<0.05", "−3e-4", "7%"] or a == ["10", "20", "18.5", "<0.05", "−3e-4", "7%"] or a == ["10", "-20", "18.5", "<0.05", "−3e-4", "7%"]
    assert b[:3] == ["1", "10", "-20"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="x1.2-+−%<≤ E e\n", max_size=25), min_size=1, max_size=20))
def test_numbers_like_python(spark, texts):
    two = re.compile(r"[+−\-±]?(?:\d+(?:\.\d+)?|\.\d+)(?:[Ee][+−\-]?\d+)?%?")
    one = re.compile(r"(?<![\w.])(?:[<>≤≥]?\s*[-+−]?(?:\d+(?:\.\d+)?|\.\d+)(?:[Ee][+−-]?\d+)?%?)(?![\w.])")
    for t, (a, b) in zip(texts, values(spark, texts, tx.structured_numbers("t"), tx.content_numbers("t")), strict=True):
        assert a == [x.strip() for x in one.findall(t)] and b == two.findall(t)


@pytest.mark.parametrize("title, level", [("1 Introduction", 2), ("3.1 Methodology", 3), ("3.7.1 Objective", 4), ("1.2.3.4.5.6.7 x", 6), ("Note A1 x", 3), ("Abstract", 2), ("2020", 2)])
def test_heading_level(spark, title, level):
    assert values(spark, [title], tx.heading_level("t")) == [(level,)]


@pytest.mark.parametrize("title, level", [("0.1", 3), ("3.7.1", 4), ("7", 2), ("1.2x", 2)])
def test_heading_level_of_a_number_alone(spark, title, level):
    assert values(spark, [title], tx.heading_level("t")) == [(level,)]


def test_headings(spark):
    got = values(spark, ["# 5.1 results \nx", "## Conclusions", "### References", "# Bibliography\n", "References"], tx.has_heading("t", "Results"), tx.has_heading("t", "Conclusion"), tx.has_references("t"))
    assert got == [(True, False, False), (False, False, False), (False, False, True), (False, False, True), (False, False, False)]


def test_small_ones(spark):
    got = values(
        spark, ["Table 1", "Fig. 2:", "x."], tx.with_period("t"), tx.without_images(F.lit('<td><IMG src="a.jpg"/></td>')), tx.safe_long(F.lit(" 12 ")), tx.safe_long(F.lit("1.5")),
        tx.longest_available(F.lit(" ab "), F.lit("cd"), F.lit(None)), tx.first_available(F.lit(" "), F.lit("z")), tx.date_text(F.lit("2020"), F.lit("3"), F.lit("x")), tx.date_text(F.lit(None), F.lit("3"), F.lit("4")),
    )
    assert [g[0] for g in got] == ["Table 1.", "Fig. 2:", "x."] and got[0][1:] == ("<td></td>", 12, None, "ab", "z", "2020-03-x", None)


def test_tex(spark):
    wrapped = r"\documentclass[12pt]{minimal}\usepackage{amsmath}\begin{document}$$ x_1 $$\end{document}"
    got = values(spark, [wrapped, r"\usepackage{a}\setlength{\b}{1pt} $y$", r"\(z\)", "$$"], tx.inline_tex("t"))
    assert got == [("x_1",), ("y",), ("z",), ("$$",)]


def test_casefold(spark):
    letters = [chr(c) for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000 and chr(c).casefold() != chr(c)] + ["ΣΑΣ", "Straße", "İI", "ı"]
    got = {r.c: r.f for r in spark.createDataFrame([(c,) for c in letters], "c string").select("c", tx.casefold("c").alias("f")).collect()}
    unlike = {c for c in letters if got[c] != c.casefold()}
    # Cherokee small letters fold to capitals; a letter or two differ between Unicode versions.
    assert {c for c in unlike if not ("Ꭰ" <= c <= "ᏽ" or "ꭰ" <= c <= "ꮿ")} == set()
