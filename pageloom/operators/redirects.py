"""Redirects followed to the page they end at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.titles import norm_title
from pageloom.operators.articles import require_columns
from pageloom.operators.skew import broadcast_if_small
from pageloom.storage import durable


def redirect_steps(pages: DataFrame) -> DataFrame:
    """``title_norm, target``: one step of each redirect title.

    Titles are compared as links are, by their normalized form; a section behind a
    number sign is no part of the target. Of several redirects under one title the
    smallest target counts. A title that an article bears is no redirect.
    """
    require_columns(pages, ("title", "redirect"))
    main = F.col("ns").cast("int") == 0 if "ns" in pages.columns else F.lit(True)
    titles = pages.where(main).select(norm_title(F.col("title")).alias("title_norm"), norm_title(F.substring_index("redirect", "#", 1)).alias("target"))
    # An article under the title counts as the smallest target of all and takes it out.
    smallest = titles.where(F.col("title_norm") != "").groupBy("title_norm").agg(
        F.min("target").alias("target"), F.count_if(F.col("target").isNull()).alias("articles")
    )
    return smallest.where((F.col("articles") == 0) & (F.col("target") != "")).select("title_norm", "target")


def redirect_ends(steps: DataFrame) -> DataFrame:
    """``title_norm, end, hops``: where each chain of redirects ends, by pointer doubling.

    ``end`` is the first title of the chain that is no redirect, whether a page bears
    it or not; it is null for titles on a circle or on the way into one, and so is
    ``hops``. Each round doubles the steps taken, so a chain of length l takes log l
    rounds, one join each. A title ends with the one it points to; once a round ends
    no title, all that are left point at each other and lie on or before circles.
    """
    jumps = durable(steps.select("title_norm", F.col("target").alias("at"), F.lit(1).cast("bigint").alias("hops"), F.lit(True).alias("going")), "redirects")
    before = None
    while (left := jumps.where("going").count()) and left != before:
        onward = jumps.select(F.col("title_norm").alias("via"), F.col("at").alias("onward"), F.col("hops").alias("more"), F.col("going").alias("goes_on"))
        moved = jumps.where("going").join(broadcast_if_small(onward), F.col("at") == F.col("via"), "left").select(
            "title_norm",
            F.coalesce("onward", "at").alias("at"),
            (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"),
            F.coalesce("goes_on", F.lit(False)).alias("going"),
        )
        jumps = durable(moved.unionByName(jumps.where("not going")), "redirects")
        before = left
    ended = ~F.col("going")
    return jumps.select("title_norm", F.when(ended, F.col("at")).alias("end"), F.when(ended, F.col("hops")).alias("hops"))


def follow(mentions: DataFrame, ends: DataFrame, title: str = "title_norm") -> DataFrame:
    """Mentions with every redirect title replaced by the title it ends at; those of circles go.

    All mentions stay on their side of the join, which a title that very many
    pages mention therefore doesn't collect into one group.
    """
    known = broadcast_if_small(ends.select(F.col("title_norm").alias("redirect_norm"), "end"))
    through: Column = F.when(F.col("redirect_norm").isNull(), F.col(title)).otherwise(F.col("end"))
    columns = [through.alias(name) if name == title else F.col(name) for name in mentions.columns]
    return mentions.join(known, F.col(title) == F.col("redirect_norm"), "left").select(*columns).where(F.col(title).isNotNull())
