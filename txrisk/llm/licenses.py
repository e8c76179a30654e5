"""License texts by diagonal voting, with spans verified in order.

Every pair of neighbouring words of a text is joined to the places where it stands in the templates.  A
pair at word p that is word o of a template votes for the diagonal p - o: where the template would
begin.  A diagonal keeps which places of the template voted, each once.  A place in the text is a diagonal and those
at most ``WIDTH`` behind it (that many words added or left out altogether); where their votes could be enough, the span is
verified: the pairs found are aligned with the template, and only the longest run of them that rises both in the text and in the
template counts.  The join compares the words themselves besides their hash.

Phrases must be whole and on one diagonal.  Notices count from ``LEAST_SHARE`` of their pairs on, aligned;
their labels are added to those of phrases.  Of overlapping places of one notice (diagonals at most ``WIDTH`` apart) the one with most aligned
pairs is kept, the last of several.  The score is the largest share found, 1 for a phrase.

Null texts are empty, and have no words.  Equal rows give equal results, as many as there are; rows
without an id are rows like others.  An empty table gives an empty result; other columns are
not read.  A row travels once, as its votes and one more.  The words of a text are one array in a task, and the diagonals of one
text and template are one group there, however long the text is.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import lower_ascii

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LEAST_SHARE = 0.6
#: diagonals of one place are at most so far apart
WIDTH = 6

# The phrases that must be found, and openings of common notices.
PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by", "this work is licensed under a creative commons attribution"),
]


def words(text: Column) -> Column:
    """The words of a text: runs of a-z (A-Z in lower case), 0-9 and whatever is not ASCII."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def templates(docs: DataFrame) -> DataFrame:
    """The pairs of all templates: a few hundred rows, whatever the data."""
    rows = []
    for kind, known in (("phrase", PHRASES), ("notice", NOTICES)):
        for label, text in known:
            w = text.split()
            if len(w) > 64:
                raise ValueError(f"the places of a template are the bits of a number, so it has 64 words at most: {text}")
            need = len(w) - 1 if kind == "phrase" else math.ceil(LEAST_SHARE * (len(w) - 1))
            rows += [(f"{kind} {text}", label, kind == "phrase", len(w) - 1, need, o, a, b) for o, (a, b) in enumerate(zip(w, w[1:]))]
    fields = "template string, label string, phrase boolean, pairs int, need int, place int, t0 string, t1 string"
    return docs.sparkSession.createDataFrame(rows, fields).withColumn("gram", F.xxhash64("t0", "t1"))


def aligned(frame: Column, pairs: Column) -> Column:
    """The length of the longest run of votes that rises in the text and in the template.

    ``frame`` has the diagonals of a place, each with the bits of the places that voted.  Votes are taken in the order of the text, of
    one word the last place first; ``ends[k]`` is the earliest place at which a run of ``k + 1`` of them can end.
    """
    places = F.sequence(F.lit(0), pairs - 1)
    votes = F.flatten(
        F.transform(
            frame,
            lambda d: F.transform(
                F.filter(places, lambda o: F.call_function("getbit", d["places"], o) == 1),
                lambda o: F.struct((d["diagonal"] + o).alias("at"), (-o).alias("back")),
            ),
        )
    )

    def longer(ends: Column, vote: Column) -> Column:
        before = F.size(F.filter(ends, lambda e: e < -vote["back"]))
        return F.concat(F.slice(ends, F.lit(1), before), F.array(-vote["back"]), F.slice(ends, before + 2, F.size(ends)))

    return F.size(F.aggregate(F.array_sort(votes), F.array().cast("array<int>"), longer))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, notices`` for each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("h"), F.md5(text).alias("key"), words(text).alias("words")).drop("h")
    counted = plain.withColumn("n_words", F.size("words").cast("long"))
    # place 0 is the row itself; word p of the text is at place p + 1
    places = counted.select("doc_id", "key", "n_words", "words", F.posexplode(F.concat(F.array(F.lit("")), "words")).alias("place_1", "w0"))
    grams = places.select(
        "doc_id", "key", "n_words", (F.col("place_1") - 1).alias("at"), "w0", F.get("words", F.col("place_1")).alias("w1")
    ).withColumn("gram", F.xxhash64("w0", "w1"))
    known = F.broadcast(templates(docs))
    hit = (grams.gram == known.gram) & (grams.w0 == known.t0) & (grams.w1 == known.t1)
    votes = grams.join(known, hit, "left").where("template is not null or at = -1")
    text_and_template = ["doc_id", "key", "n_words", "template", "label", "phrase", "pairs", "need"]
    diagonals = votes.groupBy(*text_and_template, (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("votes"), F.bit_or(F.expr("shiftleft(1L, place)")).alias("places")
    )
    # the row itself has no template; a phrase is on one diagonal; a notice may be where the diagonals around have votes enough
    by = Window.partitionBy("doc_id", "key", "template").orderBy("diagonal")
    around = by.rangeBetween(-WIDTH, WIDTH)
    own = F.bit_count("places")
    may = F.col("template").isNull() | F.when(F.col("phrase"), own == F.col("need")).otherwise(F.col("around") >= F.col("need"))
    open_ = diagonals.withColumn("around", F.sum(own).over(around)).where(may)
    framed = open_.withColumn("frame", F.collect_list(F.struct("diagonal", "places")).over(by.rangeBetween(0, WIDTH)))
    found = F.when(F.col("phrase"), F.col("pairs")).otherwise(aligned(F.col("frame"), F.col("pairs")))
    verified = framed.withColumn("aligned", F.when(F.col("template").isNotNull(), found)).where("template is null or aligned >= need")
    rank = F.struct("aligned", "diagonal")
    placed = verified.withColumn("best", F.max(rank).over(around) == rank).where("template is null or phrase or best")
    # a text that stands in m equal rows has m rows of its own
    result = placed.groupBy("doc_id", "key", "n_words").agg(
        F.max(F.when(F.col("template").isNull(), F.col("votes"))).alias("rows"),
        F.collect_list(
            F.when(F.col("template").isNotNull(), F.struct("label", "phrase", (F.col("aligned") / F.col("pairs")).alias("share"), F.col("diagonal").alias("begin")))
        ).alias("found"),
    )
    base = F.filter("found", lambda s: s["phrase"])
    notices = F.filter("found", lambda s: ~s["phrase"])
    result = result.select("doc_id", "n_words", "rows", base.alias("base"), notices.alias("notices"))
    sure = F.concat("base", "notices")
    return result.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.begin").cast("long").alias("first_word"),
        F.array_max("base.begin").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(sure["label"])), ",").alias("labels"),
        F.coalesce(F.array_max(sure["share"]), F.lit(0.0)).alias("score"),
        F.transform(F.array_sort("notices"), lambda s: F.struct(s["label"].alias("label"), s["begin"].alias("word"), s["share"].alias("share"))).alias("notices"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("copy"),
    ).drop("copy")
