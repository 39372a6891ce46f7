"""License scans as an exact set-similarity join between text blocks and templates.

A template is a set of words with a label. A text block is the run of words
around one word of a template, as far as the template is long to either side. A
block matches if it holds at least ``THRESHOLD`` of the template's words.

Words are ordered by how often they occur in all texts, rare ones first. A block
that matches must hold one of the template's first words in this order (the
prefix), so only blocks near prefix words are looked at. A place with too few words
of any template (length filter), or with too few words before and after the
shared word in the order (positional filter), is dropped before its words are
compared. The filters lose no match.

Phrases are templates that must match in full and whose words must also stand
consecutively; every such place is reported.

Only DataFrame functions are used. The text is read once: each document keeps the
positions of template words, a small part of its words. NULL texts have no words.
Repeated rows give repeated results, empty tables an empty one, and only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stpanel.llm.urls import lower_ascii
from stpanel.operators.storage import materialize

THRESHOLD = 0.8
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Fixed phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Distinctive words of well-known license texts and the labels they add. Where these
#: stand further apart in the original than a block reaches, its full wording follows.
TEMPLATES = {
    "licensed cc by nc": "cc-by-nc",
    "licensed cc by sa": "cc-by-sa",
    "creative commons attribution license": "cc-by",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "permission hereby granted free charge person obtaining copy software associated documentation": "mit",
    "redistribution source binary forms without modification permitted provided following conditions met": "bsd",
    "licensed apache license version except compliance obtain copy": "apache",
    "free software redistribute modify terms gnu general public license published foundation": "gpl",
    "released public domain": "public-domain",
    "released into the public domain": "public-domain",
    "creative commons attribution 4 0 international license": "cc-by",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
    "with the license you may obtain a copy of the license": "apache",
}


def words(text: str = "text") -> Column:
    """Lower-cased (A-Z) words of a text; none for NULL."""
    lowered = lower_ascii(F.coalesce(F.col(text), F.lit("")))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _template_rows(phrases: Mapping[str, str], templates: Mapping[str, str], threshold: float):
    for kind, group in ((True, phrases), (False, templates)):
        for text, label in group.items():
            ordered = text.split()
            if kind and len(set(ordered)) != len(ordered):
                raise ValueError(f"a phrase repeats a word: {text}")
            size = len(set(ordered))
            yield kind, label, ordered, size if kind else -(-size * round(threshold * 100) // 100)


def scan(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
    text: str = "text",
    doc_id: str = "doc_id",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` per row.

    ``n_base``, ``first_word`` and ``last_word`` describe the places of phrases;
    ``score`` is the largest share of a template found in a block, 1 with a phrase.
    """
    all_templates = list(_template_rows(phrases, templates, threshold))
    vocabulary = sorted({w for _, _, ordered, _ in all_templates for w in ordered})
    found = F.array_compact(
        F.transform("words", lambda w, i: F.when(w.isin(vocabulary), F.struct(i.alias("pos"), w.alias("word"))))
    )
    stored = materialize(
        docs.select(F.col(doc_id).alias("doc_id"), words(text).alias("words")).select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            found.alias("hits"),
        ),
        "license-hits",
    )
    seen = {
        r["word"]: r["n"]
        for r in stored.select(F.explode("hits.word").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (seen.get(w, 0), w)))}
    matches = _join(stored, all_templates, rank)
    labels = matches.groupBy("row").agg(
        F.sum(F.size("places")).alias("n_base"),
        F.min(F.array_min("places")).alias("first_word"),
        F.max(F.array_max("places")).alias("last_word"),
        F.collect_set(F.when(F.col("base"), F.col("label"))).alias("base"),
        F.collect_set("label").alias("all"),
        F.max("share").alias("score"),
    )
    return (
        stored.select("row", "doc_id", "n_words")
        .join(labels, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
            F.col("first_word").cast("long").alias("first_word"),
            F.col("last_word").cast("long").alias("last_word"),
            F.coalesce(F.array_join(F.array_sort("base"), ","), F.lit("")).alias("base_labels"),
            F.coalesce(F.array_join(F.array_sort("all"), ","), F.lit("")).alias("labels"),
            F.coalesce("score", F.lit(0.0)).alias("score"),
        )
    )


def _prefix(ordered: Sequence[str], needed: int, rank: Mapping[str, int]) -> list[str]:
    """The rarest words of a template, of which any block that matches holds one."""
    by_rank = sorted(set(ordered), key=rank.__getitem__)
    return by_rank[: len(by_rank) - needed + 1]


def _prefixes(stored: DataFrame, all_templates: Sequence, rank: Mapping[str, int]) -> DataFrame:
    """One row per prefix word of each template: a table as small as the templates."""
    rows = []
    for base, label, ordered, needed in all_templates:
        size = len(set(ordered))
        for i, word in enumerate(_prefix(ordered, needed, rank)):
            rows.append(
                F.struct(
                    F.lit(base).alias("base"),
                    F.lit(label).alias("label"),
                    F.array(*map(F.lit, ordered)).alias("ordered"),
                    F.lit(size).alias("size"),
                    F.lit(needed).alias("needed"),
                    F.lit(word).alias("word"),
                    F.lit(i).alias("place"),
                    F.lit(ordered.index(word)).alias("offset"),
                )
            )
    return stored.sparkSession.range(1).select(F.inline(F.array(*rows)))


def _join(stored: DataFrame, all_templates: Sequence, rank: Mapping[str, int]) -> DataFrame:
    """``row, base, label, places, share`` of the blocks that match."""
    prefixes = _prefixes(stored, all_templates, rank)
    prefix_words = [_prefix(ordered, needed, rank) for _, _, ordered, needed in all_templates]
    around = 2 * (max(len(t[2]) for t in all_templates) - 1)  # a block that holds a word reaches this far from it
    starters = sorted({w for words_ in prefix_words for w in words_})
    at_hit = lambda i: F.get("hits", i)

    # The neighbourhood is cut out before rows are made: no row carries all hits
    # of its document. A stretch of positions holds at most as many hits.
    def surroundings(i: Column) -> Column:
        first, last = F.greatest(i - around, F.lit(0)), F.least(i + around, F.size("hits") - 1)
        near = F.transform(F.sequence(first, last), at_hit)
        return F.struct(at_hit(i)["pos"].alias("pos"), at_hit(i)["word"].alias("word"), near.alias("near"))

    starts = F.filter(F.sequence(F.lit(0), F.size("hits")), lambda i: at_hit(i)["word"].isin(starters))
    hits = stored.select("row", F.inline(F.transform(starts, surroundings)))
    ranks = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])
    reach = F.size("ordered") - 1
    wide = F.filter("near", lambda h: (F.abs(h["pos"] - F.col("pos")) <= 2 * reach) & F.array_contains("ordered", h["word"]))
    pairs = hits.join(F.broadcast(prefixes), "word").withColumn("wide", wide).drop("near")
    pairs = pairs.withColumn("shared", F.array_distinct(F.transform("wide", lambda h: h["word"])))
    own = ranks[F.col("word")]
    after = F.size(F.filter("shared", lambda w: ranks[w] > own))
    before = F.size("shared") - after - 1
    bound = F.least(before, F.col("place")) + 1 + F.least(after, F.col("size") - F.col("place") - 1)
    centres = F.filter("wide", lambda h: F.abs(h["pos"] - F.col("pos")) <= reach)
    start = F.col("pos") - F.col("offset")
    inside = F.filter(
        "wide",
        lambda h: (h["pos"] >= start)
        & (h["pos"] <= start + reach)
        & (F.get("ordered", h["pos"] - start) == h["word"]),
    )
    places = F.when(F.col("base") & (F.size(inside) == F.size("ordered")), F.array(start)).otherwise(
        F.array().cast("array<int>")
    )
    return (
        pairs.filter((F.size("shared") >= F.col("needed")) & (bound >= F.col("needed")))
        .withColumn("overlap", F.array_max(F.transform(centres, _block_size)))
        .filter(F.col("overlap") >= F.col("needed"))
        .withColumn("places", places)
        .filter(~F.col("base") | (F.size("places") > 0))
        .select("row", "base", "label", "places", (F.col("overlap") / F.col("size")).alias("share"))
    )


def _block_size(centre: Column) -> Column:
    """Distinct template words in the block around a hit."""
    block = F.filter("wide", lambda h: F.abs(h["pos"] - centre["pos"]) <= F.size("ordered") - 1)
    return F.size(F.array_distinct(F.transform(block, lambda h: h["word"])))
