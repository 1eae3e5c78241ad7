"""Operator 12: license scan by diagonal voting.

Words are lower-cased (A-Z) runs of letters, digits and everything beyond
ASCII. Every text's rolling k-gram hashes are joined with the k-grams of the
templates; a match of text position p and template position t votes for the
diagonal p - t. A vote counts only if the k words themselves are equal.

* A phrase (two or three words) stands where one diagonal has all its votes.
* A longer template may be quoted with words left out, added or changed, which
  moves the rest to another diagonal. Diagonals at most ``DRIFT`` apart are
  merged into one span, and the span is verified by its share: how many of the
  template's grams were found there. ``LEAST_SHARE`` of them make a span.

Expressions, joins and aggregates of Spark only. Votes are aggregated by
(document, template, diagonal) before they move and then written; what follows
has a few rows for each document that mentions a license, and one that carries
its length.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, let


class Template(NamedTuple):
    label: str
    text: str
    base: bool = False


# The phrases that make a base label.
PHRASES = (Template("mit", "mit license", True), Template("apache", "apache license", True),
           Template("gpl", "general public license", True))
# Opening clauses of well-known licenses, as published.
NOTICES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                    "associated documentation files, to deal in the Software without restriction"),
    Template("apache", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance "
                       "with the License. You may obtain a copy of the License at"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                    "General Public License as published by the Free Software Foundation"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
                    "is hereby granted, provided that the above copyright notice"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    Template("cc-by", "Licensed under CC BY 4.0"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0"),
)
TEMPLATES = PHRASES + NOTICES

#: Words of a gram for phrases and for longer templates; a template of fewer than ``LONG`` words is a phrase.
SHORT, LONG = 2, 4
DRIFT, LEAST_SHARE = 12, 0.6
#: More template grams than this are not broadcast.
BROADCAST_GRAMS = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column | str) -> Column:
    """The words of a text, an empty array for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _APART), "")


def _hashes(words: Column) -> Column:
    """Hashes of the 2-grams at all n words, then of the 4-grams at all n words (those that the
    text's end cuts short equal no template's, as words are compared too), then the end's mark."""
    def long(pairs: Column) -> Column:
        fours = F.transform(pairs, lambda x, i: F.xxhash64(F.lit(LONG), x, F.get(pairs, i + 2)))
        return F.concat(pairs, fours, F.array(_end()))

    def short(h: Column) -> Column:
        return let(F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1))), long)
    return let(F.transform(words, lambda w: F.xxhash64(w)), short)


def _end() -> Column:
    return F.xxhash64(F.lit("end of text"))


def template_grams(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """hash, template (its number), at (word of the template), k, gram; one row more for the end's mark (template -1)."""
    rows = [(i, t.text) for i, t in enumerate(templates)]
    words = spark.createDataFrame(rows, "template int, text string").select("template", words_of("text").alias("words"))
    n, k = F.size("words"), F.when(F.size("words") < LONG, SHORT).otherwise(LONG)
    grams = (words.select("template", "words", n.alias("n"), k.alias("k"), F.posexplode(_hashes(F.col("words"))).alias("p", "hash"))
             .withColumn("at", F.when(F.col("k") == SHORT, F.col("p")).otherwise(F.col("p") - F.col("n")))
             .where("at between 0 and n - k")
             .select("hash", "template", "at", "k", F.array_join(F.expr("slice(words, at + 1, k)"), " ").alias("gram")))
    return grams.unionByName(spark.range(1).select(
        _end().alias("hash"), F.lit(-1).alias("template"), F.lit(0).alias("at"), F.lit(0).alias("k"), F.lit("").alias("gram")))


def diagonals(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Votes of each (doc_id, version of its text, template, diagonal): ``seen``, the template's words
    where a shared gram begins. Template -1 has one row for each text: its number of words as
    ``diagonal`` and in ``copies`` how many rows are this document."""
    spark = docs.sparkSession
    grams = template_grams(spark, templates)
    if sum(len(t.text.split()) for t in templates) <= BROADCAST_GRAMS:
        grams = F.broadcast(grams)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("version"), words_of("text").alias("words"))
    places = rows.select("doc_id", "version", "words", F.posexplode(_hashes(F.col("words"))).alias("_p", "_hash"))
    n, p, k = F.size("words"), F.col("_p"), F.col("k")
    place = F.when(k == SHORT, p).when(k == LONG, p - n).otherwise(n)
    same = F.when(k == 0, p == 2 * n).otherwise(
        (place >= 0) & (F.array_join(F.slice("words", F.greatest(place, F.lit(0)) + 1, k), " ") == F.col("gram")))
    votes = places.join(grams, (F.col("_hash") == F.col("hash")) & same).select(
        "doc_id", "version", "template", (place - F.col("at")).alias("diagonal"), "at")
    return (votes.groupBy("doc_id", "version", "template", "diagonal")
            .agg(F.collect_set("at").alias("seen"), F.count("*").alias("copies")))


def spans(votes: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Where templates stand: doc_id, version, template, label, base, start, length (words), share.

    ``votes`` as from ``diagonals``. Overlapping templates all have their spans."""
    n = [len(_python_words(t.text)) for t in templates]
    grams = [max(x - (SHORT if x < LONG else LONG) + 1, 1) for x in n]
    by = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("template") + 1)
    order = Window.partitionBy("doc_id", "version", "template").orderBy("diagonal")
    exact = by([x < LONG for x in n])
    apart = F.col("diagonal") - F.lag("diagonal").over(order)
    rows = (votes.where("template >= 0").withColumn("_exact", exact)
            .withColumn("_new", (apart.isNull() | F.col("_exact") | (apart > DRIFT)).cast("int"))
            .withColumn("_span", F.sum("_new").over(order))
            .groupBy("doc_id", "version", "template", "_span")
            .agg(F.array_distinct(F.flatten(F.collect_list("seen"))).alias("seen"),
                 F.min(F.col("diagonal") + F.array_min("seen")).alias("start"),
                 F.max(F.col("diagonal") + F.array_max("seen")).alias("last"),
                 F.first("_exact").alias("_exact")))
    size = F.when(F.col("_exact"), by(n)).otherwise(F.col("last") - F.col("start") + LONG)
    share = F.size("seen") / by(grams)
    found = rows.select("doc_id", "version", "template", by([t.label for t in templates]).alias("label"),
                        by([t.base for t in templates]).alias("base"), F.col("start").cast("long").alias("start"),
                        size.cast("long").alias("length"), share.alias("share"), "_exact")
    return found.where(F.when(F.col("_exact"), F.col("share") == 1).otherwise(F.col("share") >= LEAST_SHARE)).drop("_exact")


def _python_words(text: str) -> list[str]:
    import re

    return [w for w in re.split(_APART, text.translate(str.maketrans(_UPPER, _LOWER))) if w]


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """License spans of every row of ``docs`` (doc_id, text).

    One row for each row of ``docs`` (repeated rows as often as they occur):
    doc_id, n_words, spans (start, length, template, label, base, share; in
    that order). Null and empty texts have no words and no spans; rows of
    equal doc_id and different texts are kept apart; an empty table gives no
    rows. Other columns are ignored."""
    # written once: the end marks and the spans both read it, and a lost executor re-reads files
    votes = Scratch(docs.sparkSession, "licenses").save(diagonals(docs, templates), "votes")
    marks = votes.where("template = -1").select("doc_id", "version", F.col("diagonal").cast("long").alias("n_words"),
                                                "copies", F.lit(None).alias("span"))
    span = F.struct("start", "length", "template", "label", "base", "share")
    found = spans(votes, templates).select("doc_id", "version", F.lit(None).cast("long").alias("n_words"),
                                           F.lit(None).cast("long").alias("copies"), span.alias("span"))
    rows = (marks.unionByName(found).groupBy("doc_id", "version")
            .agg(F.max("n_words").alias("n_words"), F.max("copies").alias("copies"),
                 F.sort_array(F.collect_list("span")).alias("spans")))
    return (rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select("doc_id", "n_words", "spans"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    base = F.filter("spans", lambda s: s["base"])
    labels = lambda s: F.array_join(F.sort_array(F.array_distinct(F.transform(s, lambda x: x["label"]))), ",")
    starts = F.transform(base, lambda s: s["start"])
    return scan(docs).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("spans")).alias("labels"),
        F.round(F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)), 6).alias("score"))


def _oracle() -> str:
    """The query's result for DuckDB, on words instead of hashes."""
    values = ", ".join(f"({i}, '{t.label}', {str(t.base).lower()}, {_python_words(t.text)!r})" for i, t in enumerate(TEMPLATES))
    return f"""
with texts as (
  select row_number() over () as r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_APART}'), lambda x: x <> '') as w from documents),
templates(template, label, base, w) as (values {values}),
template_words as (select template, label, base, w, len(w) as n, case when len(w) < {LONG} then {SHORT} else {LONG} end as k from templates),
template_grams as (select template, k, a as spot, list_slice(w, a + 1, a + k) as gram
  from (select *, unnest(range(n - k + 1)) as a from template_words)),
places as (select r, w, unnest(range(len(w))) as p from texts),
grams as (select r, p, {SHORT} as k, list_slice(w, p + 1, p + {SHORT}) as gram from places where p + {SHORT} <= len(w)
  union all select r, p, {LONG}, list_slice(w, p + 1, p + {LONG}) from places where p + {LONG} <= len(w)),
votes as (select distinct r, template, p - spot as diagonal, spot from grams join template_grams using (k, gram)),
lines as (select r, template, diagonal, list(spot) as seen, min(diagonal + spot) as begins
  from votes group by all),
marked as (select *, lag(diagonal) over (partition by r, template order by diagonal) as previous
  from lines join template_words using (template)),
numbered as (select *, sum(case when previous is null or n < {LONG} or diagonal - previous > {DRIFT} then 1 else 0 end)
  over (partition by r, template order by diagonal) as span from marked),
spans as (select r, template, label, base, n, k, min(begins) as start,
  len(list_distinct(flatten(list(seen)))) / (n - k + 1)::double as share
  from numbered group by r, template, label, base, n, k, span),
found as (select * from spans where share >= case when n < {LONG} then 1 else {LEAST_SHARE} end)
select any_value(doc_id) as doc_id, any_value(len(texts.w))::bigint as n_words, count(*) filter (base) as n_base,
  min(start) filter (base) as first_word, max(start) filter (base) as last_word,
  coalesce(string_agg(distinct label, ',' order by label) filter (base), '') as base_labels,
  coalesce(string_agg(distinct label, ',' order by label), '') as labels,
  round(coalesce(max(share), 0), 6)::double as score
from texts left join found using (r) group by r
"""


ORACLE = _oracle()
