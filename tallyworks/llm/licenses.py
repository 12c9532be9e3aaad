"""Licence scan by Dice coefficient over word bigrams (operator 2), DataFrame functions only.

A text's lines, and its runs of consecutive lines, are candidates. Lines without a letter or digit are passed over. A run
has at most one line more than the largest size bound has bigrams: each line brings a word, so only a run that repeats
bigrams could be longer and still match. Text is normalised: lower case, everything but letters and digits is a space. A candidate's and a template's distinct word bigrams are compared:
Dice = 2 * common / (both sizes). Dice >= t is only possible if t / (2 - t) <= size / template size <= (2 - t) / t; a line
whose number of words rules out every template is never turned into bigrams, and no template outside the bounds is
compared. Numbers count as words, so versions are told apart.

Templates are a table (license, text); it is part of the plan and must stay small (at most `MOST` rows, checked). By
default it holds short licence notices. Of matches that share lines the best is taken first: higher Dice, then fewer
lines, then the earlier one. Returned are, for each document and licence, the best Dice and the number of lines of its
matches. The SQL below knows single lines only. Null and empty texts have none. Equal scores of one line go to the smaller name, so a
line counts for one licence. Repeated rows are counted together if they have one id.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

THRESHOLD = 0.8
MOST = 1000

#: Notices of common licences; fixed values.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def _word_list(text: str) -> list[str]:
    return "".join(c if "a" <= c <= "z" or "0" <= c <= "9" else " " for c in text.lower()).split()


def _bigrams(text: str) -> list[str]:
    words = _word_list(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def _words(line: Column) -> Column:
    """Words of a line; other letters part words as signs do."""
    return F.filter(F.split(F.lower(line), "[^a-z0-9]+"), lambda w: w != "")


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license, dice (rounded to 6 places), lines."""
    if len(templates) > MOST:
        raise ValueError(f"at most {MOST} templates")
    known = [(name, grams) for name, text in templates if (grams := _bigrams(text))]
    least, most = threshold / (2 - threshold), (2 - threshold) / threshold
    fewest, largest = min(len(g) for _, g in known) * least, max(len(g) for _, g in known) * most
    longest = math.floor(largest) + 1
    # a match has at least this share of a template's bigrams, so it has one of any larger rest: the longest are asked for
    rare = set()
    for _, own in known:
        by_length = sorted(own, key=lambda g: (-len(g), g))
        rare |= {max(g.split(), key=len) for g in by_length[: len(own) - math.ceil(len(own) * least - 1e-9) + 1]}
    lower = F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    held = docs.select("doc_id", lower.alias("text")).where(" or ".join(f"contains(text, '{w}')" for w in sorted(rare)))
    # explode(array(x)) keeps x from being written into every place that uses it, and so from being worked out there anew
    split = F.filter(F.split("text", "\n", -1), lambda line: line.rlike("[a-z0-9]"))
    lines = held.select("doc_id", F.monotonically_increasing_id().alias("row"), F.explode(F.array(split)).alias("lines"))
    # the first line of a run has a template's word pair or ends in a template's word; without it the run is no worse
    needed = "|".join(sorted({w for _, grams in known for g in grams for w in g.split()}, key=lambda w: (-len(w), w)))
    opens = rf"(?<![a-z0-9])({needed})([^a-z0-9]+({needed})(?![a-z0-9])|[^a-z0-9]*$)"
    places = F.filter(F.sequence(F.lit(1), F.size("lines")), lambda i: F.element_at("lines", i).rlike(opens))
    starts = lines.where(F.size("lines") > 0).select(
        "doc_id", "row", F.explode(F.transform(places, lambda i: F.struct(i.alias("start"), F.slice("lines", i, longest).alias("lines")))).alias("s")
    )
    # each word met for the first time but one brings a bigram: lines after too many different words belong to no match
    def further(state: Column, line: Column) -> Column:
        seen = F.array_union(state["seen"], _words(line))
        ends = F.struct(state["seen"].alias("seen"), state["n"].alias("n"), F.lit(False).alias("on"))
        goes_on = F.struct(seen.alias("seen"), (state["n"] + 1).alias("n"), F.lit(True).alias("on"))
        return F.when(~state["on"], state).when(F.size(seen) > largest + 1, ends).otherwise(goes_on)

    nothing = F.struct(F.array().cast("array<string>").alias("seen"), F.lit(0).alias("n"), F.lit(True).alias("on"))
    count = F.aggregate("s.lines", nothing, further, lambda state: state["n"])
    counted = starts.select("doc_id", "row", "s.start", "s.lines", F.explode(F.array(count)).alias("count")).where("count > 0")
    ahead = counted.select("doc_id", "row", "start", F.explode(F.array(F.transform(F.slice("lines", F.lit(1), F.col("count")), _words))).alias("ahead"))
    runs = ahead.select("doc_id", "row", "start", "ahead", F.explode(F.sequence(F.lit(1), F.size("ahead"))).alias("n"))
    words = runs.select(
        "doc_id", "row", "start", (F.col("start") + F.col("n") - 1).alias("end"), F.explode(F.array(F.flatten(F.slice("ahead", F.lit(1), F.col("n"))))).alias("words")
    ).where((F.size("words") >= 2) & (F.size("words") > fewest))
    pairs = F.zip_with(F.slice("words", 1, F.size("words") - 1), F.slice("words", 2, F.size("words") - 1), lambda a, b: F.concat_ws(" ", a, b))
    grams = words.select("doc_id", "row", "start", "end", F.explode(F.array(F.array_distinct(pairs))).alias("grams"))
    sized = grams.where(F.size("grams").between(fewest, largest))

    def dice(name: str, own: list[str]) -> Column:
        size = F.size("grams")
        common = F.size(F.array_intersect("grams", F.array(*map(F.lit, own))))
        value = F.when(size.between(len(own) * least, len(own) * most), 2 * common / (size + len(own)))
        return F.struct((-value).alias("minus"), F.lit(name).alias("license"))

    best = F.array_min(F.filter(F.array(*[dice(*k) for k in known]), lambda s: s["minus"] <= -threshold))
    scored = sized.select("doc_id", "row", "start", "end", best.alias("best")).where(F.col("best").isNotNull())
    return (
        _apart(scored.select("doc_id", "row", "start", "end", "best.minus", "best.license"))
        .groupBy("doc_id", "license")
        .agg(F.round(F.max(-F.col("minus")), 6).alias("dice"), F.sum(F.col("end") - F.col("start") + 1).alias("lines"))
    )


def _apart(matches: DataFrame) -> DataFrame:
    """The matches of each row that stay when the best are taken first and none may share lines with one taken."""
    # a match no better than a part of it is never taken
    shorter = F.least(
        F.min("minus").over(Window.partitionBy("row", "start").orderBy("end").rowsBetween(Window.unboundedPreceding, -1)),
        F.min("minus").over(Window.partitionBy("row", "end").orderBy(F.desc("start")).rowsBetween(Window.unboundedPreceding, -1)),
    )
    better = matches.withColumn("part", shorter).where("part is null or minus < part")
    # matches that share lines, also by way of others, are one cluster
    order = Window.partitionBy("row").orderBy("start", "end")
    reached = better.withColumn("reached", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    new = F.when(F.col("reached") >= F.col("start"), 0).otherwise(1)
    clusters = reached.withColumn("new", new).withColumn("cluster", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    match = F.struct("minus", (F.col("end") - F.col("start")).alias("more"), "start", "end", "license")
    ranked = clusters.groupBy("doc_id", "row", "cluster").agg(F.sort_array(F.collect_list(match)).alias("ranked"))
    none = F.array().cast(ranked.schema["ranked"].dataType)

    def take(taken: Column, m: Column) -> Column:
        shares = F.exists(taken, lambda t: (t["start"] <= m["end"]) & (m["start"] <= t["end"]))
        return F.when(shares, taken).otherwise(F.concat(taken, F.array(m)))

    return ranked.select("doc_id", F.explode(F.aggregate("ranked", none, take)).alias("m")).select("doc_id", "m.*")


def oracle_sql(templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same rows in plain SQL, without the pruning."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({i}, {quoted(name)}, {quoted(text)})" for i, (name, text) in enumerate(templates))
    grams = """list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"""
    words = """list_filter(string_split(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')"""
    return f"""
WITH t AS (SELECT id, license, {grams} AS g FROM (SELECT id, license, {words.format('text')} AS w FROM (VALUES {values}) AS v(id, license, text))),
lines AS (SELECT row_number() OVER () AS line, doc_id, {words.format('l')} AS w FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l FROM documents)),
grams AS (SELECT line, doc_id, unnest({grams}) AS gram, len({grams}) AS size FROM lines WHERE len(w) > 1),
common AS (
  SELECT g.line, g.doc_id, t.id, t.license, 2.0 * count(*) / (g.size + len(t.g)) AS dice
  FROM grams g JOIN (SELECT id, license, g, unnest(g) AS gram FROM t) t ON g.gram = t.gram GROUP BY g.line, g.doc_id, g.size, t.id, t.license, t.g
),
best AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY dice DESC, license) AS k FROM common WHERE dice >= {threshold})
SELECT doc_id, license, round(max(CAST(dice AS DOUBLE)), 6) AS dice, count(*) AS lines FROM best WHERE k = 1 GROUP BY doc_id, license
"""
