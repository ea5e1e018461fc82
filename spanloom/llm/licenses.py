"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a line, or a run of successive lines, as notices are often wrapped: runs of up to ``run``
lines whatever their length, and runs of any number of lines that have at most ``SLACK`` times the
words of the template.  A run counts only where no shorter run inside it matches the same template.  Tokens of the templates are ordered by their frequency over all
blocks, rarest first.  A template that must share ``need`` tokens with a block shares
one of its ``size - need + 1`` rarest with the block's as many, so only those prefixes
are joined; short blocks (length filter) and matches too late in either order to still
reach ``need`` (positional filter) are dropped before the overlap is counted in full.
All of it is DataFrame and SQL functions; the templates are a fixed, small table.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanloom.llm.work import stage

#: Phrases of the contract and their labels.
PHRASES = {"mit": ("mit", "license"), "apache": ("apache", "license"), "gpl": ("general", "public", "license")}

#: Notices by which public licenses are commonly declared.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "this work is licensed under the gnu general public license version"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license version"),
    ("agpl", "licensed under the gnu affero general public license version"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by", "licensed under a creative commons attribution license"),
    ("cc-by-nc", "licensed under cc by nc"),
    ("cc-by-sa", "licensed under cc by sa"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
]

#: Lines of a run of long lines; and the words of a longer run, as a multiple of the template's.
RUN, SLACK = 5, 2

#: Between words: ASCII characters that are neither digits nor letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _places(words: str, phrase: tuple[str, ...]) -> str:
    """SQL for the starts of the phrase in the array column ``words``."""
    test = " AND ".join([f"x = '{phrase[0]}'", *(f"get({words}, i + {k}) = '{w}'" for k, w in enumerate(phrase) if k)])
    return f"filter(transform({words}, (x, i) -> IF({test}, i, -1)), p -> p >= 0)"


def _short_lines(scanned: DataFrame, run: int, most: int, least: int) -> DataFrame:
    """Runs of over ``run`` lines with at most ``most`` words: ``doc_id, same, line, width, span, own``.

    Only texts that have as many short lines in a row are taken apart.  A line looks ahead as far as ``most`` words
    reach, over lines that hold words of templates, so it sees at most as many lines."""
    starts = F.sequence(F.lit(1), F.size("sizes") - run)
    near = F.exists(starts, lambda i: F.aggregate(F.slice("sizes", i, F.lit(run + 1)), F.lit(0), lambda a, n: a + n) <= most)
    some = scanned.where((F.size("sizes") > run) & near).select("doc_id", "same", "sizes", "lines").dropDuplicates(["doc_id", "same"])
    rows = some.select("doc_id", "same", F.posexplode(F.arrays_zip("sizes", "lines")).alias("line", "x"))
    text = Window.partitionBy("doc_id", "same")
    before = F.coalesce(F.sum("x.sizes").over(text.orderBy("line").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.select("doc_id", "same", "line", before.alias("before"), (before + F.col("x.sizes")).alias("upto"), F.col("x.lines").alias("own")).where("size(own) > 0")
    ahead = F.collect_list(F.struct("line", "upto", "own")).over(text.orderBy("before").rangeBetween(Window.currentRow, most))
    rows = rows.withColumn("ahead", ahead)
    runs = F.transform(
        "ahead", lambda y, k: F.struct((y["line"] - F.col("line") + 1).alias("width"), (y["upto"] - F.col("before")).alias("span"), (k + 1).alias("n"))
    )
    wide = rows.select("doc_id", "same", "line", "ahead", F.explode(F.filter(runs, lambda r: (r["width"] > run) & (r["span"] <= most))).alias("r"))
    own = F.array_distinct(F.flatten(F.slice("ahead.own", F.lit(1), F.col("r.n"))))
    return wide.select("doc_id", "same", "line", "r.width", "r.span", own.alias("own")).where(F.size("own") >= least)


def scan_licenses(
    docs: DataFrame, *, templates: list[tuple[str, str]] | None = None, containment: float = 0.9, run: int = RUN
) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, n_blocks``.

    ``n_base`` to ``base_labels`` are of the PHRASES; ``labels`` adds those of templates of
    which a block (a line or a run of lines) holds at least ``containment`` of the distinct words; ``score`` is the
    largest containment found (1 for a phrase, 0 for none); ``n_blocks`` counts the matches.
    Null texts count as empty and have no words; equal rows give equal results, and rows
    with a null ``doc_id`` are matched like others; other columns are ignored; an empty
    table gives an empty one; very long texts are read whole.  Templates are a parameter of
    fixed size, and broadcast; they may be whole license texts, in any writing, over any number of lines."""
    spark = docs.sparkSession
    low_words = lambda text: re.findall(WORD, text.translate(str.maketrans(_UP, _LOW)))
    rows = [(i, label, sorted(set(low_words(text))), len(low_words(text))) for i, (label, text) in enumerate(templates or TEMPLATES)]
    rows = [r for r in rows if r[2]]
    most = SLACK * max((r[3] for r in rows), default=0)
    least = min((math.ceil(len(r[2]) * containment - 1e-9) for r in rows), default=1)
    vocabulary = sorted({w for r in rows for w in r[2]})
    vocab = F.array(*[F.lit(w) for w in vocabulary])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    scanned = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    # one pass over the texts; words are taken apart only where a phrase can stand
    low = F.when(
        F.col("text").rlike("(?i)license"), F.split(F.translate("text", _UP, _LOW), BETWEEN)
    ).otherwise(F.array().cast("array<string>"))
    # lower() equals lowering A-Z in words of a-z but for the Kelvin sign, which is hidden from it
    plain = F.when(F.col("text").contains("\u212a"), F.replace("text", F.lit("\u212a"), F.lit("\u00e5"))).otherwise(F.col("text"))
    split = F.transform(F.split(plain, "\n"), lambda line: F.split(F.lower(line), BETWEEN))
    lines = F.transform(split, lambda w: F.struct(F.size(F.array_remove(w, "")).alias("n"), F.array_intersect(w, vocab).alias("own")))
    scanned = scanned.select(
        "doc_id",
        F.xxhash64("text").alias("same"),
        # a text that begins between words has an empty first entry
        F.filter(low, lambda w: w != "").alias("words"),
        lines.alias("cut"),
    )
    scanned = scanned.select(
        "doc_id", "same", F.aggregate("cut", F.lit(0).cast("long"), lambda a, c: a + c["n"]).alias("n_words"),
        F.col("cut.n").alias("sizes"), F.col("cut.own").alias("lines"), *[F.expr(_places("words", p)).alias(label) for label, p in PHRASES.items()]
    )
    scanned = stage(scanned, "blocks")

    def runs(width: int):
        def run(x, i):
            last = F.get("lines", i + F.lit(width - 1))
            held = x if width == 1 else F.array_distinct(F.flatten(F.slice("lines", i + F.lit(1), F.lit(width))))
            some = (F.size(x) > 0) & last.isNotNull() & (F.size(last) > 0)
            return F.struct(i.alias("line"), F.lit(width).alias("width"), F.lit(0).cast("long").alias("span"), F.when(some, held).otherwise(F.array().cast("array<string>")).alias("own"))

        return F.filter(F.transform("lines", run), lambda r: F.size(r["own"]) >= least)

    block = scanned.select("doc_id", "same", F.inline(F.concat(*[runs(w) for w in range(1, run + 1)])))
    block = block.unionByName(_short_lines(scanned, run, most, least))
    often = scanned.select(F.explode(F.flatten("lines")).alias("word")).groupBy("word").agg(F.count("*").alias("often"))
    words = F.broadcast(spark.range(1).select(F.explode(vocab).alias("word")))
    order = words.join(often, "word", "left").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "word"))).alias("all")
    )
    order = stage(order.select(F.col("all.word").alias("order")), "order")  # one row: all words, rarest first

    def ranked(df: DataFrame, column: str) -> DataFrame:
        # an intersection keeps the order of its first array
        return df.crossJoin(F.broadcast(order)).withColumn(column, F.array_intersect("order", column)).drop("order")

    entries = [
        F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.array(*[F.lit(w) for w in parts]).alias("parts"), F.lit(SLACK * n).alias("longest"))
        for i, label, parts, n in rows
    ]
    pattern = spark.range(1).select(F.inline(F.array(*entries)))
    pattern = (
        ranked(pattern, "parts")
        .withColumn("size", F.size("parts"))
        .withColumn("need", F.ceil(F.col("size") * F.lit(containment) - F.lit(1e-9)).cast("int"))
    )
    prefix = pattern.select("template", "label", "parts", "longest", "size", "need", F.posexplode("parts").alias("i", "word")).where(
        "i < size - need + 1"
    )
    # tokens after the longest prefix of any template are not joined
    first = F.slice("own", F.lit(1), F.size("own") - F.lit(least - 1))
    tokens = ranked(block, "own").select("doc_id", "same", "line", "width", "span", "own", F.posexplode(first).alias("j", "word"))
    length = F.size("own")
    candidates = tokens.join(F.broadcast(prefix), "word").where(
        (F.col("span") <= F.col("longest"))
        & (length >= F.col("need"))  # length
        & (F.col("j") < length - F.col("need") + 1)  # prefix of the block
        & (1 + F.least(F.col("size") - F.col("i") - 1, length - F.col("j") - 1) >= F.col("need"))  # position
    )
    shared = F.size(F.array_intersect("own", "parts"))
    at = ["doc_id", "same", "line", "width", "template", "label"]
    matched = candidates.where(shared >= F.col("need")).select(*at, (shared / F.col("size")).alias("share")).distinct()
    # of runs that begin in a line the shortest; and not where a run that begins later ends as early
    here = ["doc_id", "same", "template", "label"]
    short = matched.groupBy(*here, "line").agg(F.min(F.struct((F.col("line") + F.col("width")).alias("stop"), "share")).alias("m"))
    later = Window.partitionBy(*here).orderBy(F.desc("line")).rowsBetween(Window.unboundedPreceding, -1)
    found = (
        short.withColumn("inner", F.min("m.stop").over(later))
        .where("inner is null or inner > m.stop")
        .groupBy("doc_id", "same")
        .agg(F.collect_set("label").alias("more"), F.max("m.share").alias("share"), F.count("*").alias("n_blocks"))
    )
    all_places = F.concat(*PHRASES)
    base = F.filter(F.array(*[F.when(F.size(p) > 0, F.lit(p)) for p in PHRASES]), lambda x: x.isNotNull())
    a, b = scanned.alias("a"), found.alias("b")
    return (
        a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.same") == F.col("b.same")), "left")
        .select(
            "a.doc_id",
            "n_words",
            F.size(all_places).cast("long").alias("n_base"),
            F.array_min(all_places).cast("long").alias("first_word"),
            F.array_max(all_places).cast("long").alias("last_word"),
            F.array_join(F.array_sort(base), ",").alias("base_labels"),
            F.array_join(F.array_sort(F.array_distinct(F.concat(base, F.coalesce("more", F.array().cast("array<string>"))))), ",").alias("labels"),
            F.when(F.size(all_places) > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
            F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"),
        )
    )
