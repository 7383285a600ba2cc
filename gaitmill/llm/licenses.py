"""Licences of files: TF-IDF cosine to templates, then inheritance along directories.

Lines that can reach the threshold and files named like licence files are compared
with short templates as sparse TF-IDF vectors. A file without a licence of its own takes
that of the licence file in its nearest ancestor directory.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaitmill.operators.shared import salted_join, settle

# Notices as they are commonly written.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, under the MIT License"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Released under the 3-Clause BSD License."),
    ("BSD-2-Clause", "Released under the 2-Clause BSD License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0, no rights reserved under this license."),
    ("proprietary", "Copyright. All rights reserved. No license is granted."),
    ("proprietary", "All rights reserved."),
)
#: Terms of the templates: a line without any of them has cosine 0 to all of them.
ANCHORS = tuple(sorted({w for _, t in TEMPLATES for w in re.split(r"[^a-z0-9.]+|\.(?![0-9])", t.lower()) if w}))
#: Share of files below which a word does not get any rarer.
RARE = 0.001
LICENSE_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice)[^/]*$"
THRESHOLD = 0.6


def terms(text: Column) -> Column:
    """Lower-case words and numbers; version points stay inside a number."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}0-9.]+|\.(?![0-9])"), lambda t: t != "")


def template_terms(spark: SparkSession) -> DataFrame:
    """``template``, ``license``, ``term``, ``tf``: some hundreds of rows."""
    rows = [(i, name, text) for i, (name, text) in enumerate(TEMPLATES)]
    split = spark.createDataFrame(rows, "template int, license string, text string")
    return (
        split.select("template", "license", F.explode(terms(F.col("text"))).alias("term"))
        .groupBy("template", "license", "term")
        .agg(F.count("*").alias("tf"))
    )


def vocabulary_idf(files: DataFrame, vocabulary: list[str]) -> tuple[dict[str, float], float]:
    """IDF of the templates' terms over all ``files`` (column ``text``), and that of a
    term that no file has. The result has one number per term of the templates.

    An IDF depends on the share of files with the term, not on the number of files."""
    words = F.array(*[F.lit(w) for w in vocabulary])
    found = files.select(F.explode(F.array_intersect(terms(F.col("text")), words)).alias("term"))
    counted = {r["term"]: r["n"] for r in found.groupBy("term").agg(F.count("*").alias("n")).collect()}
    total = files.count()
    shares = {w: counted.get(w, 0) / max(total, 1) for w in vocabulary}
    return {w: 1 - math.log(share + RARE) for w, share in shares.items()}, 1 - math.log(RARE)


def telling_terms(weights: dict[int, dict[str, float]]) -> list[str]:
    """Terms of which a text must have one to reach ``THRESHOLD`` with any template:
    the heaviest of each template, as many as leave the rest too light. ``weights`` are
    unit vectors, so a text with only the rest has at most its length as cosine."""
    telling = set()
    for terms_of in weights.values():
        left = 1.0
        for term, weight in sorted(terms_of.items(), key=lambda x: (-x[1], x[0])):
            if left < (THRESHOLD - 1e-6) ** 2:
                break
            telling.add(term)
            left -= weight**2
    return sorted(telling)


def own_licenses(files: DataFrame) -> DataFrame:
    """``file``, ``license``, ``cosine``: the best template of each file of ``files``
    (``file``, ``path``, ``text``) that reaches ``THRESHOLD``.

    Every line is a document, and a licence file is one besides; those without any of
    ``telling_terms`` cannot reach ``THRESHOLD`` and are left out. Terms
    outside the templates count in the length of a vector as a term no file has. Ties go
    to the earlier template.
    """
    spark = files.sparkSession
    listed = template_terms(spark).collect()
    vocabulary = sorted({r["term"] for r in listed})
    idf, unseen = vocabulary_idf(files, vocabulary)
    norms: Counter[int] = Counter()
    for r in listed:
        norms[r["template"]] += (r["tf"] * idf[r["term"]]) ** 2
    scaled = [
        (r["term"], r["template"], r["license"], r["tf"] * idf[r["term"]] / norms[r["template"]] ** 0.5)
        for r in listed
    ]
    weights = spark.createDataFrame(scaled, "term string, template int, license string, weight double")
    idfs = spark.createDataFrame(sorted(idf.items()), "term string, idf double")

    of_template: dict[int, dict[str, float]] = {}
    for term, template, _, weight in scaled:
        of_template.setdefault(template, {})[term] = weight
    telling = F.array(*[F.lit(w) for w in telling_terms(of_template)])

    def speaks(text: str) -> Column:
        return F.arrays_overlap(terms(F.col(text)), telling)

    speaking = files.where(speaks("text"))
    lines = speaking.select("file", F.posexplode(F.split("text", r"\R")).alias("line", "said"))
    whole = speaking.where(F.col("path").rlike(LICENSE_FILE)).select(
        "file", F.lit(-1).alias("line"), F.col("text").alias("said")
    )
    vectors = (
        lines.where(speaks("said"))
        .unionByName(whole)
        .select("file", "line", F.explode(terms(F.col("said"))).alias("term"))
        .groupBy("file", "line", "term")
        .agg(F.count("*").alias("tf"))
        .join(F.broadcast(idfs), "term", "left")
        .withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unseen)))
    )
    vectors = settle(vectors.select("file", "line", "term", "w"))
    lengths = vectors.groupBy("file", "line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    products = (
        vectors.join(F.broadcast(weights), "term")
        .groupBy("file", "line", "template", "license")
        .agg(F.sum(F.col("w") * F.col("weight")).alias("product"))
    )
    scored = products.join(lengths, ["file", "line"]).withColumn(
        "cosine", F.round(F.col("product") / F.col("length"), 12)
    )
    best = F.max(F.struct("cosine", (-F.col("template")).alias("first"), "license"))
    return (
        scored.where(F.col("cosine") >= THRESHOLD)
        .groupBy("file")
        .agg(best.alias("best"))
        .select("file", "best.license", "best.cosine")
    )


def ancestors(directory: Column) -> Column:
    """The directory and all above it, the root ("") last."""
    parts = F.when(directory == "", F.array().cast("array<string>")).otherwise(F.split(directory, "/"))
    depths = F.sequence(F.size(parts), F.lit(0), F.lit(-1))
    return F.transform(depths, lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def scan_licenses(
    files: DataFrame, *, key: str = "doc_id", path: Column | str = "path", text: str = "text"
) -> DataFrame:
    """One row per file: ``key``, ``path``, ``own_license``, ``cosine``, ``license``,
    ``inherited_from`` (path of the directory, null where the licence is its own).

    Null texts and paths count as empty; a file at the top is in the directory "".
    Several licence files in a directory: the best cosine, then the first name. Repeated
    rows stay. Empty tables give empty ones. Other columns are ignored. Directories, not
    files, meet their ancestors: paths are joined once per distinct directory.
    """
    at = path if isinstance(path, Column) else F.col(path)
    clean = F.regexp_replace(F.coalesce(at, F.lit("")), "^/+|/+$", "")
    rows = files.select(
        F.col(key).alias("key"), clean.alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    # Rows that agree in everything are one file: its number is a digest of all of it.
    identified = rows.withColumn("file", F.md5(F.concat_ws("\x1f", F.col("key"), "path", F.md5("text"))))
    own = settle(own_licenses(identified.select("file", "path", "text")))
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    named = (
        identified.drop("text")
        .withColumn("directory", folder)
        .join(own, "file", "left")
        .select("key", "path", "directory", F.col("license").alias("own_license"), "cosine")
    )
    named = settle(named)
    best = F.min_by("own_license", F.struct(-F.col("cosine"), F.col("path")))
    granted = (
        named.where(F.col("path").rlike(LICENSE_FILE) & F.col("own_license").isNotNull())
        .groupBy("directory")
        .agg(best.alias("granted"))
    )
    above = named.select("directory").distinct().select(
        "directory", F.posexplode(ancestors(F.col("directory"))).alias("up", "ancestor")
    )
    nearest = (
        above.join(granted.withColumnRenamed("directory", "ancestor"), "ancestor")
        .groupBy("directory")
        .agg(F.min_by(F.struct("ancestor", "granted"), "up").alias("n"))
        .select("directory", F.col("n.ancestor").alias("from"), F.col("n.granted").alias("granted"))
    )
    mine = F.col("own_license").isNotNull()
    return salted_join(named, nearest, ["directory"], "path", how="left").select(
        F.col("key").alias(key),
        "path",
        "own_license",
        "cosine",
        F.coalesce("own_license", "granted").alias("license"),
        F.when(~mine, F.col("from")).alias("inherited_from"),
    )
