"""Licence scan: a sparse word n-gram classifier of paragraphs, in DataFrame operations only.

Paragraphs that start at a line with a licence word are candidates; their word
n-grams around such words are the features. A multinomial logistic regression
with an L1 penalty is trained on the templates and on paragraphs of the corpus,
which are labelled by how much of a template they hold; those that hold little
of any are the unknown class. The scores are calibrated by a temperature fitted
on held-out paragraphs, and a predicted family must be confirmed by its
template's own n-grams. Families besides the likeliest count if a paragraph holds
all word pairs of a template of theirs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.tables import whole_text
from orderloom.sources.staging import stage

# Wording of well-known licences, one phrase that tells each of them per line: identifiers, short forms, and
# sentences of their notices, in lower case and without punctuation.
TEMPLATES = {
    "agpl-3.0": [
        "gnu affero general public license version 3",
        "spdx license identifier agpl 3.0",
        "gnu affero general public license as published by the free software foundation either version 3",
        "agplv3",
    ],
    "apache-2.0": [
        "licensed under the apache license version 2.0",
        "spdx license identifier apache 2.0",
        "licensed under the terms of the apache 2.0 license",
        "apache license 2.0",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "released under the bsd license",
        "licensed under the bsd license",
        "spdx license identifier bsd 2 clause",
        "spdx license identifier bsd 3 clause",
    ],
    "bsl-1.0": ["boost software license version 1.0", "spdx license identifier bsl 1.0"],
    "cc-by-4.0": ["licensed under cc by 4.0", "creative commons attribution 4.0 international license", "spdx license identifier cc by 4.0"],
    "cc-by-nc-4.0": ["licensed under cc by nc 4.0", "creative commons attribution noncommercial 4.0 international license"],
    "cc-by-sa-4.0": ["licensed under cc by sa 4.0", "creative commons attribution sharealike 4.0 international license"],
    "cc0-1.0": ["cc0 1.0 universal public domain dedication license", "spdx license identifier cc0 1.0"],
    "epl-2.0": ["eclipse public license v 2.0", "eclipse public license version 2.0", "eclipse public license 2.0", "spdx license identifier epl 2.0"],
    "gpl-2.0": [
        "gnu general public license version 2",
        "this work is licensed under the gnu general public license version 2",
        "spdx license identifier gpl 2.0",
        "gnu general public license as published by the free software foundation either version 2",
        "gplv2",
    ],
    "gpl-3.0": [
        "gnu general public license version 3",
        "this work is licensed under the gnu general public license version 3",
        "spdx license identifier gpl 3.0",
        "gnu general public license as published by the free software foundation either version 3",
        "gplv3",
    ],
    "isc": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        "released under the isc license",
        "spdx license identifier isc",
    ],
    "lgpl": ["gnu lesser general public license", "spdx license identifier lgpl", "lgplv3"],
    "mit": [
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "spdx license identifier mit",
    ],
    "mpl-2.0": ["subject to the terms of the mozilla public license v 2.0", "mozilla public license version 2.0", "spdx license identifier mpl 2.0"],
    "proprietary": ["all rights reserved"],
    "unlicense": ["this is free and unencumbered software released into the public domain", "spdx license identifier unlicense"],
    "zlib": ["released under the zlib license", "licensed under the zlib license", "spdx license identifier zlib"],
}
# Every feature holds one of these words (not "mit", which is German for "with"); a line without them can't start a paragraph.
ANCHORS = (
    "license licensed licence licenced licenses licences copyright rights reserved redistribution permission granted "
    "public domain apache gnu gpl agpl lgpl gplv2 gplv3 lgplv3 agplv3 mozilla mpl eclipse epl boost zlib spdx creative commons cc cc0 "
    "bsd isc unlicense unencumbered"
).split()
UNKNOWN = "unknown"
FAMILIES = (UNKNOWN, *sorted(TEMPLATES))

PARAGRAPH_LINES = 24  # over which a notice's sentence may be spread
MAX_TRAINING = 8000  # paragraphs of the corpus
MAX_FEATURES = 2000
ANCHOR_LINE = r"(?i)(?<![\p{L}\p{N}])(?:" + "|".join(sorted(ANCHORS, key=lambda w: (-len(w), w))) + r")(?![\p{L}\p{N}])"


def _tokens(text: Column) -> Column:
    """Words and version numbers in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:\.\p{N}+)*"), F.lit(0))


def _grams(tokens: Column, sizes: tuple[int, ...]) -> Column:
    """Distinct word n-grams that hold an anchor."""
    anchors = F.array(*[F.lit(a) for a in ANCHORS])

    def of(n: int) -> Column:
        starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1))).otherwise(F.array().cast("array<int>"))
        near = F.filter(starts, lambda i: F.arrays_overlap(F.slice(tokens, i, F.lit(n)), anchors))
        return F.transform(near, lambda i: F.array_join(F.slice(tokens, i, F.lit(n)), " "))

    return F.array_distinct(F.concat(*[of(n) for n in sizes]))


def paragraphs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs``' other columns, ``line`` (from 0), ``grams`` and ``tokens``: a row for each line with a licence word.

    The paragraph goes on to the next blank line, over ``PARAGRAPH_LINES`` lines at most; later lines of a longer
    notice that hold such a word start paragraphs of their own.
    """
    lines = F.split("__whole", "\n")
    starts = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(lines, i).rlike(ANCHOR_LINE))
    some = docs.withColumn("__whole", whole_text(text_col)).filter(F.col("__whole").rlike(ANCHOR_LINE)).drop(text_col)
    rows = some.select("*", F.explode(starts).alias("line")).withColumn("__part", F.array_join(F.slice(lines, F.col("line") + 1, F.lit(PARAGRAPH_LINES)), "\n"))
    rows = rows.withColumn("tokens", _tokens(F.regexp_replace("__part", r"(?s)\n\s*\n.*$", ""))).drop("__part", "__whole")
    return rows.withColumn("grams", _grams(F.col("tokens"), (1, 2, 3)))


def _pieces(phrase: str) -> list[str]:
    """The phrase's word pairs; a phrase of one word is its only piece."""
    words = phrase.split()
    return [" ".join(words[i : i + 2]) for i in range(len(words) - 1)] or words


def held_share(tokens: Column, family: str) -> Column:
    """The largest share of a phrase's word pairs that a paragraph holds, over the family's phrases."""
    pairs = F.zip_with(
        F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))),
        F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    if any(len(t.split()) == 1 for t in TEMPLATES[family]):
        pairs = F.concat(pairs, tokens)
    shares = [F.size(F.array_intersect(pairs, F.array(*[F.lit(p) for p in _pieces(t)]))) / float(len(set(_pieces(t)))) for t in TEMPLATES[family]]
    return F.greatest(*shares) if len(shares) > 1 else shares[0]


@dataclass(frozen=True)
class LicenceModel:
    """Weights per n-gram and family; ``temperature`` divides the scores."""

    weights: dict[str, list[float]]
    intercepts: list[float]
    temperature: float

    def scores(self, grams: Column) -> Column:
        """Array of raw scores, FAMILIES in order."""
        zero = F.array(*[F.lit(float(b)) for b in self.intercepts])
        if not self.weights:
            return zero
        table = F.create_map(*[x for g, w in sorted(self.weights.items()) for x in (F.lit(g), F.array(*[F.lit(float(v)) for v in w]))])
        known = F.filter(F.transform(grams, lambda g: F.element_at(table, g)), lambda w: w.isNotNull())
        return F.aggregate(known, zero, lambda total, w: F.zip_with(total, w, lambda a, b: a + b))

    def probabilities(self, grams: Column) -> Column:
        def shares(raw: Column) -> Column:
            powers = F.transform(raw, lambda v: F.exp((v - F.array_max(raw)) / self.temperature))
            return F.get(F.transform(F.array(powers), lambda p: F.transform(p, lambda v: v / F.aggregate(p, F.lit(0.0), lambda a, b: a + b))), F.lit(0))

        return F.get(F.transform(F.array(self.scores(grams)), shares), F.lit(0))


def _weak_label(tokens: Column) -> Column:
    """Family whose template the paragraph holds nearly whole, 0 if it holds little of any, null between."""
    shares = F.array(*[held_share(tokens, f) for f in FAMILIES[1:]])
    best = F.array_max(shares)
    return F.when(best >= 0.9, F.array_position(shares, best)).when(best <= 0.4, F.lit(0)).cast("double")


def _template_rows(spark) -> DataFrame:
    """Every phrase in a few settings, and licence words out of place for the unknown class."""
    rows = [(i, s.format(t)) for i, f in enumerate(FAMILIES) if i for t in TEMPLATES[f] for s in ("{}", "{} see the license file", "copyright 2020 the authors {}")]
    rows += [(0, f"the {a} of the thing and what it is for") for a in ANCHORS] + [(0, f"a {a} was given to {b}") for a in ANCHORS for b in ("them", "the public")]
    return spark.createDataFrame(rows, "label long, text string").withColumn("label", F.col("label").cast("double"))


def fit_licences(rows: DataFrame, max_rows: int = MAX_TRAINING, penalty: float = 0.002) -> LicenceModel:
    """Train on the templates and at most ``max_rows`` different paragraphs (of ``paragraphs``), chosen by a hash of their words."""
    spark = rows.sparkSession
    order = F.xxhash64("tokens")
    chosen = rows.select("tokens").distinct().orderBy(order, "tokens").limit(max_rows)
    # The limit leaves one partition; the labels of all of it would be one task's work.
    distinct = chosen.repartition(spark.sparkContext.defaultParallelism).withColumn("grams", _grams(F.col("tokens"), (1, 2, 3)))
    corpus = distinct.withColumn("label", _weak_label(F.col("tokens"))).filter("label is not null")
    fixed = _template_rows(spark).withColumn("tokens", _tokens(F.col("text"))).withColumn("grams", _grams(F.col("tokens"), (1, 2, 3)))
    both = corpus.withColumn("held", F.pmod(order, F.lit(5)) == 0).unionByName(fixed.withColumn("held", F.lit(False)).drop("text"))
    data = stage(both, "licence-training")
    counted = data.select(F.explode("grams").alias("g"), "label").groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.max("label").alias("any"))
    # N-grams of licences first, then frequent ones; a bounded vocabulary.
    words = [r["g"] for r in counted.filter("n > 1").orderBy((F.col("any") > 0).desc(), F.col("n").desc(), "g").limit(MAX_FEATURES).collect()]
    vectors = CountVectorizerModel.from_vocabulary(words, inputCol="grams", outputCol="features").setBinary(True)
    featured = vectors.transform(data)
    machine = LogisticRegression(family="multinomial", regParam=penalty, elasticNetParam=0.9, maxIter=60, standardization=False)
    fitted = machine.fit(featured.filter(~F.col("held")).select("features", "label"))
    matrix, intercepts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    # Classes are numbered up to the largest label seen; the templates show all of them.
    weights = {w: matrix[:, j].tolist() for j, w in enumerate(words) if (matrix[:, j] != 0).any()}
    raw = LicenceModel(weights, intercepts.tolist(), 1.0)
    return LicenceModel(weights, intercepts.tolist(), _temperature(data.filter("held"), raw))


def _temperature(held: DataFrame, model: LicenceModel) -> float:
    """The divisor of the scores with the least log loss on held-out paragraphs; 1 if there are none."""
    grid = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0]
    scored = held.select(F.col("label").cast("int").alias("label"), model.scores(F.col("grams")).alias("raw"))

    def loss(t: float) -> Column:
        top = F.array_max("raw")
        total = F.aggregate("raw", F.lit(0.0), lambda a, v: a + F.exp((v - top) / t))
        return F.avg(F.log(total) - (F.get(F.col("raw"), F.col("label")) - top) / t)

    losses = scored.agg(*[loss(t).alias(f"t{i}") for i, t in enumerate(grid)]).first()
    known = [(v, t) for v, t in zip(losses, grid) if v is not None]
    return min(known)[1] if known else 1.0


def find_licences(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_probability: float = 0.5, least_share: float = 0.75, max_rows: int = MAX_TRAINING
) -> DataFrame:
    """One row per row of ``docs``: id, ``licences``, an array of (family, line, probability, share) by line.

    ``line`` is the first line (from 0) of the first paragraph that shows the family; a paragraph may show several. Null and empty
    texts, and texts without licence words, have none; texts are read whole; rows
    repeated with the same id and text share their licences; a null id stays null; other columns
    are ignored; an empty table gives no rows.
    """
    keyed = docs.select(F.col(id_col).alias("__id"), F.xxhash64(whole_text(text_col)).alias("__hash"), whole_text(text_col).alias("__text"))
    rows = stage(paragraphs(keyed, "__text"), "paragraphs")
    model = fit_licences(rows, max_rows)
    each = F.array(*[held_share(F.col("tokens"), f) for f in FAMILIES[1:]])
    shown = F.zip_with(
        F.slice("chances", 2, len(FAMILIES) - 1), F.zip_with(each, F.array(*[F.lit(f) for f in FAMILIES[1:]]), lambda s, f: F.struct(s.alias("share"), f.alias("family"))),
        lambda p, x: F.struct(p.alias("p"), x["share"].alias("share"), x["family"].alias("family")),
    )
    # Only one family can be the likeliest; the others of a paragraph that names several are known by their whole template.
    sure = F.filter(shown, lambda x: ((x["p"] >= least_probability) & (x["p"] >= F.array_max("chances")) & (x["share"] >= least_share)) | (x["share"] >= 1))
    confirmed = rows.withColumn("chances", model.probabilities(F.col("grams"))).select("__id", "__hash", "line", F.explode(sure).alias("found"))
    confirmed = confirmed.select("__id", "__hash", "line", "found.*")
    per_family = confirmed.groupBy("__id", "__hash", "family").agg(
        F.min("line").alias("line"), F.max("p").alias("probability"), F.max("share").alias("share")
    )
    found = per_family.groupBy(F.col("__id").alias("__fid"), F.col("__hash").alias("__fhash")).agg(
        F.array_sort(F.collect_list(F.struct("line", "family", "probability", "share"))).alias("licences")
    )
    same = F.col("__id").eqNullSafe(F.col("__fid")) & (F.col("__hash") == F.col("__fhash"))
    none = F.array().cast("array<struct<line:int,family:string,probability:double,share:double>>")
    joined = keyed.select("__id", "__hash").join(stage(found, "licences"), same, "left")
    return joined.select(F.col("__id").alias(id_col), F.coalesce("licences", none).alias("licences"))
