"""Extraction and cleaning on hand-written markup."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pageloom.functions import wikitext


def apply(spark, text, expression):
    row = spark.createDataFrame([(text,)], "t string").select(expression(F.col("t")).alias("r")).first()
    return row.r


# input, result of the rules as listed, result of the corrected order
CLEANING = [
    ('A <ref name="x"/> PROSE <ref>n</ref> B', "A B", "A PROSE B"),
    ("{{Box\n| a = 1}}\nPROSE {{b|{x}}} {{cite}} B", "} B", "PROSE } B"),
    ("<gallery>\nf.jpg|c\n</gallery> z <script>v</script> y", "f.jpg|c\nz v y", "z y"),
    ("<references/> P <ref>k</ref> Q", "Q", "P Q"),
    ("{| class=x\n|+ cap\n! H\n|-\n| c1 || c2\n|}\nend", "! H\nend", "! H\nend"),
    ("{{a {{b {{c}} x}} y}} tail", "tail", "tail"),
    ("{{a {{b {{c {{d}} }} }} }} tail", "}} tail", "}} tail"),
    ("a<br/>b<BR>c<br />d", "a\nb\nc\nd", "a\nb\nc\nd"),
    ("'''bold''' ''it'' http://a.b/c [http://x.y lab el] [https://q.r]", "bold it lab el", "bold it lab el"),
    ("[[File:a.jpg|thumb|see [[Beta]] x]]", "x]]", "x]]"),
    ("[[Target|label]] and [[Plain]]", "label and Plain", "label and Plain"),
    ("== Head ==\n* item\n\n\n  # two", "Head\nitem\ntwo", "Head\nitem\ntwo"),
    ("", "", ""),
    (None, "", ""),
]


@pytest.mark.parametrize("text,compat,fixed", CLEANING)
def test_cleaning(spark, text, compat, fixed):
    assert apply(spark, text, lambda t: wikitext.clean_wikitext(t, compat=True)) == compat
    assert apply(spark, text, wikitext.clean_wikitext) == fixed


def test_deeper_templates_take_more_passes(spark):
    text = "{{a {{b {{c {{d}} }} }} }} tail"
    assert apply(spark, text, lambda t: wikitext.clean_wikitext(t, template_depth=4)) == "tail"


@pytest.mark.parametrize(
    "expression,text,expected",
    [
        (wikitext.templates, "{{Infobox {{date}}", ["Infobox {{date"]),
        (wikitext.templates, "{{{p}}} {{#if:x}}", ["{p", "#if:x"]),
        (wikitext.external_links, "[http://x.y/z lab el]", ["http://x.y/z lab el"]),
        (wikitext.categories, "[[:Category:Foo]]", []),
        (wikitext.links, "[[:Category:Foo]]", []),
        (wikitext.links, "[[ :Foo]]", [":Foo"]),
        (wikitext.links, "[[A|a]] [[A#s]] [[ A ]] [[file:x]] [[IMAGE:y]] [[ ]]", ["A"]),
        (wikitext.link_targets, "[[A|a]] [[A#s]] [[B]]", ["A", "A", "B"]),
        (wikitext.categories, "[[category: X |k]] [[CATEGORY:X]] [[Category:Y]]", ["X", "Y"]),
        (wikitext.categories, None, []),
        (wikitext.links, "", []),
    ],
)
def test_extraction(spark, expression, text, expected):
    assert apply(spark, text, expression) == expected


@pytest.mark.parametrize("text,count", [("[[a]] [[b]]", 2), ("", 0), ("none", 0), ("[[", 1), (None, 0)])
def test_split_count(spark, text, count):
    assert apply(spark, text, lambda t: wikitext.split_count(t, wikitext.LINK_MARKUP)) == count


def test_steps_are_guarded_and_change_nothing(spark):
    parts = [" ", "  ", "\t", "\n", "\r", "\r\n", "\u0085", "\u2028", "\x0b", "a", "b c", "|", "{|", "|-", "{{", "}}", "[[", "]]", "[http://x.y", "https://q z"]
    parts += ["<ref>", "</ref>", "<ref/>", "<br/>", "<Style a>", "</style>", "<", ">", "=", "''", "*", "#", "[[File:", " " * 9, "\n \n", " \n\n "]
    rng = random.Random(5)
    texts = [("".join(rng.choices(parts, k=rng.randint(0, 25))),) for _ in range(1500)] + [(None,)]
    df = spark.createDataFrame(texts, "t string")
    for compat in (False, True):
        plain = F.coalesce("t", F.lit(""))
        for step in wikitext.cleaning_steps(compat):
            plain = F.regexp_replace(plain, *step)
        cleaned = wikitext.clean_wikitext(F.col("t"), compat)
        assert df.where(~plain.eqNullSafe(cleaned)).isEmpty()
        plan = df.select(cleaned.alias("c"))._jdf.queryExecution().optimizedPlan().toString()
        # Every pattern stands under a test of the text.
        assert plan.count("THEN regexp_replace(") == plan.count("regexp_replace(")


def test_nested_cleaning_computes_each_step_once(spark):
    df = spark.createDataFrame([("{{a {{b}} c}} [[File:x|[[y]] ]] z",)], "t string").select(wikitext.clean_nested(F.col("t")).alias("c"))
    assert df.first().c == "z"
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.count("<noinclude") == 1
