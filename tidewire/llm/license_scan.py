"""Licence scans: sparse TF-IDF cosine of headers and licence files to templates, inherited down the directories.

Built from DataFrame expressions alone. The templates are a fixed short list, so their term weights are the only thing
that is broadcast.
"""

import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import stored

#: Names of licences and the notices that works carry.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "MPL-2.0": "Subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0. Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0. Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Released under CC0 1.0 Universal, public domain dedication.",
    "proprietary": "All rights reserved.",
}
#: Names of each licence; all that tells it apart from others must stand in a notice.
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"),
    "MIT": ("MIT License", "MIT"),
    "GPL-3.0": ("GNU General Public License, version 3", "GPLv3", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"),
    "GPL-2.0": ("GNU General Public License, version 2", "GPLv2", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPLv3", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "LGPLv2.1", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPLv3", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"),
    "GPL": ("GNU General Public License", "GPL"),
    "LGPL": ("GNU Lesser General Public License", "LGPL"),
    "AGPL": ("GNU Affero General Public License", "AGPL"),
    "MPL-2.0": ("Mozilla Public License, v. 2.0", "Mozilla Public License, version 2.0", "MPL-2.0"),
    "BSD-3-Clause": ("BSD 3-Clause License", "BSD-3-Clause"),
    "BSD-2-Clause": ("BSD 2-Clause License", "BSD-2-Clause"),
    "ISC": ("ISC License", "ISC"),
    "Zlib": ("zlib License", "Zlib"),
    "Unlicense": ("Unlicense",),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC-BY-4.0"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC-4.0"),
    "CC0-1.0": ("CC0 1.0 Universal", "CC0 1.0", "CC0-1.0"),
    "proprietary": ("All rights reserved",),
}
PHRASES = (
    "Licensed under the {}", "Licensed under {}", "Released under the {}", "Released under {}",
    "This work is licensed under the {}", "Distributed under the {}", "Distributed under the terms of the {}",
    "Available under the {}", "Under the terms of the {}", "Subject to the terms of the {}", "License: {}",
    "SPDX-License-Identifier: {}")
#: A name joined to the notice that ends right before it.
JOINED = ("or {}", "and {}", "or the {}", "and the {}")
#: Terms right before a notice that take it back, and those that may stand between.
DENIED, BETWEEN = ["not", "never", "cannot", "no"], ["yet", "currently", "be", "been", "longer", "being"]
#: Headers and beginnings of licence texts, with the terms that must be met.
FREE = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as "
        "published by the Free Software Foundation, either version {} of the License, or (at your option) any later version.")
HEADERS = [
    *((license, FREE.format(name, version), terms.split() + [version]) for license, name, version, terms in (
        ("GPL-2.0", "General Public License", "2", "general public"),
        ("GPL-3.0", "General Public License", "3", "general public"),
        ("LGPL-2.1", "Lesser General Public License", "2.1", "lesser general public"),
        ("LGPL-3.0", "Lesser General Public License", "3", "lesser general public"),
        ("AGPL-3.0", "Affero General Public License", "3", "affero general public"))),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction", ["permission", "charge"]),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met", ["redistribution", "permitted"]),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
     "promote products derived from this software without specific prior written permission", ["endorse"]),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted", ["permission", "fee"]),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
     "to alter it and redistribute it freely", ["permission", "anyone"]),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", ["unencumbered"]),
]
#: Whole licence texts.
TEXTS = Path(__file__).with_name("licenses")
#: Least cosine of a licence file to a whole text: common words alone give other prose up to about 0.7.
WHOLE = 0.85
#: Words of names that do not tell licences apart.
COMMON = {"license", "version", "v", "gnu", "universal", "international"}
#: Rank of notices; those of lower rank count only where there is none of a higher one. Works that grant a licence often
#: reserve all rights as well, and a name without version or the common beginning of BSD texts tells less than others.
RESERVED, VAGUE, NAMED, TEXT = range(4)
VAGUE_NAMES = {"GPL", "LGPL", "AGPL"}
#: Words that licence files have.
CUE = r"(?i)licen[sc]e|all\W+rights\W+reserved|public\W+domain|creative\W+commons|spdx" \
    r"|permission\W+(?:is|to)|redistribution\W+and\W+use|to\W+endorse|unencumbered"
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
NOT_TERM = r"[^a-z0-9.-]+|(?<![a-z0-9])[.-]+|[.-]+(?![a-z0-9])"
#: v3, 3.0 and 3 are one term.
NUMBER = r"^v?([0-9]+)(?:[.]0)?$"
#: Terms of a text that are looked through together.
BLOCK = 1000


def terms_of(text: str) -> list[str]:
    return [re.sub(NUMBER, r"\1", t) for t in re.findall(TERM, text.lower().replace("licence", "license"))]


def lowered(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit("licence"), F.lit("license"))


def any_term(terms: list[str]) -> str:
    """A pattern that ``lowered`` texts with any of the terms match, and maybe others."""
    spelled = [f"v?{t}(?:[.]0)?" if t.isdigit() else re.escape(t) for t in terms]
    return f"(?<![a-z0-9])(?:{'|'.join(spelled)})(?![a-z0-9])"


def deciding(rarest: list[str], unit: dict[str, float], least: float) -> list[str]:
    """The first terms without any of which no window has a cosine of ``least``."""
    rest = 1.0
    for n, term in enumerate(rarest, 1):
        rest -= unit[term] ** 2
        if rest < least * abs(least) - 1e-9:
            return rarest[:n]
    return rarest


def text_terms(text: Column) -> Column:
    """The same in Spark."""
    parts = F.split(lowered(text), NOT_TERM)
    return F.transform(F.filter(parts, lambda t: t != ""), lambda t: F.regexp_replace(t, NUMBER, "$1"))


def notices() -> list[tuple[str, str, list[str], int, bool, bool]]:
    """(licence, text, terms that must be met, rank, whether for licence files alone, whether joined to another)."""
    made = {}

    def add(license, text, needs, rank=NAMED, title=False, joined=False):
        made.setdefault((license, tuple(terms_of(text))), (license, text, needs, rank, title, joined))

    for license, names in NAMES.items():
        for name in names:
            needs = sorted(set(terms_of(name)) - COMMON)
            if license == "proprietary":
                add(license, name, needs, RESERVED)
                continue
            rank = VAGUE if license in VAGUE_NAMES else NAMED
            for phrase in PHRASES:
                add(license, phrase.format(name), needs, rank)
            for phrase in JOINED:
                add(license, phrase.format(name), needs, rank, joined=True)
            if license in TEMPLATES and name == names[0]:
                add(license, TEMPLATES[license], needs)
            if len(terms_of(name)) > 1:  # a licence file's title; elsewhere a bare name is no notice
                add(license, name, needs, rank, True)
    for license, text, needs in HEADERS:
        add(license, text, needs, VAGUE if license == "BSD-2-Clause" else NAMED)
    return list(made.values())


def term_weights(bags: list[Counter]) -> tuple[dict[str, float], float, list[dict[str, float]]]:
    """idf of each term, idf of terms that no bag has, and the unit weights of each bag."""
    known = Counter(term for bag in bags for term in bag)
    idf = {term: math.log((1 + len(bags)) / (1 + n)) + 1 for term, n in known.items()}
    norms = [math.sqrt(sum((n * idf[t]) ** 2 for t, n in bag.items())) for bag in bags]
    return idf, math.log(1 + len(bags)) + 1, [
        {t: n * idf[t] / norm for t, n in bag.items()} for bag, norm in zip(bags, norms)]


def file_matches(docs: DataFrame) -> DataFrame:
    """Columns of ``header_matches``: licence files and the whole text each is nearest to, at a place before all others."""
    spark = docs.sparkSession
    texts = {path.stem: path.read_text() for path in sorted(TEXTS.glob("*.txt"))}
    names = list(texts)
    idf, unseen, units = term_weights([Counter(terms_of(text)) for text in texts.values()])
    weights = spark.createDataFrame(
        [(t, rarity, [unit.get(t, 0.0) for unit in units]) for t, rarity in idf.items()],
        "term string, idf double, units array<double>")
    keys = ["doc_id", "text_key", "is_file"]
    counted = docs.where("is_file").select(
        "doc_id", F.xxhash64("text").alias("text_key"), "is_file", F.explode(text_terms(F.col("text"))).alias("term")
    ).groupBy(*keys, "term").agg(F.count("*").alias("n"))
    weight = F.col("n") * F.coalesce("idf", F.lit(unseen))
    scored = counted.join(F.broadcast(weights), "term", "left").groupBy(*keys).agg(
        F.sqrt(F.sum(weight * weight)).alias("norm"), *(
            F.sum(weight * F.coalesce(F.get("units", F.lit(at)), F.lit(0.0))).alias(f"p{at}") for at in range(len(names))))
    best = F.array_max(F.array(*(
        F.struct((F.col(f"p{at}") / F.col("norm")).alias("similarity"), F.lit(name).alias("license"))
        for at, name in enumerate(names))))
    return scored.select(*keys, F.lit(TEXT).alias("rank"), best.alias("best")).select(
        *keys, "rank", "best.*", F.lit(-1).alias("start"), F.lit(-1).alias("end"), F.lit(False).alias("joined"),
        F.lit(False).alias("denied")).where(F.col("similarity") >= WHOLE)


def header_matches(
    docs: DataFrame, templates: list[tuple[str, str, list[str], int, bool, bool]], least: float, leading: int | None
) -> DataFrame:
    """Windows of each text that are near enough to a notice, one row each.

    ``doc_id, text_key, is_file, rank, similarity, license, start, end, joined, denied``; ``start`` and ``end`` count
    terms. Titles count in licence files, with ``leading`` only among their first so many terms.

    A window has the notice's own length and holds all its needed terms, one of them at least at its own place, whatever
    the lines, so neither the words around a notice nor other notices change its similarity. Of a notice without needed
    terms any term may be the one at its place. In texts without the words of ``CUE`` a window also holds another word of
    the notice: a bare name, the German "mit" say, is no notice. Texts that lack a term without which no window can be near are not cut.
    """
    spark = docs.sparkSession
    split = [terms_of(text) for _, text, *_ in templates]
    idf, unseen, units = term_weights([Counter(terms) for terms in split])
    listed, anchors, cues = [], [], set()
    for at, ((license, _, needs, rank, title, joined), terms) in enumerate(zip(templates, split)):
        rarest = sorted(set(needs or terms), key=lambda t: (-idf[t], terms.index(t)))
        telling = rarest[:1] if needs else deciding(rarest, units[at], least)
        cues.update(telling)
        places = [(term, before) for before, term in enumerate(terms) if not needs or term in needs]
        others = sorted(set(terms) - set(needs)) if needs else []
        listed.append((at, license, rank, title, joined, len(terms), needs, telling, others))
        anchors += [(at, term, before, places[:i]) for i, (term, before) in enumerate(places)]
    listed = spark.createDataFrame(
        listed, "notice int, license string, rank int, title boolean, joined boolean, size int, needs array<string>, "
        "telling array<string>, others array<string>").join(spark.createDataFrame(
            anchors, "notice int, anchor string, before int, prior array<struct<term:string,before:int>>"), "notice")
    weights = spark.createDataFrame(
        [(at, t, w) for at, unit in enumerate(units) for t, w in unit.items()], "notice int, term string, unit double")
    rarities = spark.createDataFrame(list(idf.items()), "term string, idf double")
    reach = max(map(len, split)) + 2  # and the two terms before a notice
    starting, cues = sorted({a[1] for a in anchors}), sorted(cues)

    # Blocks of terms with margins, then the surroundings of each anchor: bounded rows for texts of any length.
    cut = docs.where(lowered(F.col("text")).rlike(any_term(cues))).select(
        "doc_id", F.xxhash64("text").alias("text_key"), "is_file", F.col("text").rlike(CUE).alias("cued"),
        text_terms(F.col("text")).alias("terms"))
    blocks = cut.select("doc_id", "text_key", "is_file", "cued", F.inline(F.transform(
        F.sequence(F.lit(0), F.size("terms"), F.lit(BLOCK)),
        lambda b: F.struct(
            b.alias("block"), F.least(b, F.lit(reach)).alias("margin"),
            F.slice("terms", F.greatest(b - reach, F.lit(0)) + 1, F.least(b, F.lit(reach)) + BLOCK + reach).alias("part")))))
    places = F.filter(
        F.sequence(F.lit(0), F.lit(BLOCK - 1)), lambda i: F.get("part", F.col("margin") + i).isin(starting))
    around = blocks.select("doc_id", "text_key", "is_file", "cued", F.inline(F.transform(places, lambda i: F.struct(
        (F.col("block") + i).alias("at"), F.get("part", F.col("margin") + i).alias("anchor"),
        F.least(F.col("margin") + i, F.lit(reach)).alias("lead"),
        F.slice("part", F.greatest(F.col("margin") + i - reach, F.lit(0)) + 1, F.lit(2 * reach)).alias("near"))))).where(
        F.arrays_overlap("near", F.array(*map(F.lit, cues))))
    begin = F.col("lead") - F.col("before")
    window = F.slice("near", F.greatest(begin, F.lit(0)) + 1, F.col("size") + F.least(begin, F.lit(0)))
    start = (F.col("at") - F.col("before")).cast("int")
    last, earlier = (F.coalesce(F.when(begin >= n, F.get("near", begin - n)), F.lit("")) for n in (1, 2))
    denied = last.isin(DENIED) | (last.isin(BETWEEN) & earlier.isin(DENIED))
    sooner = F.exists("prior", lambda q: F.coalesce(F.get("near", begin + q["before"]) == q["term"], F.lit(False)))
    titled = F.lit(True) if leading is None else start <= leading
    windows = around.join(F.broadcast(listed), "anchor").where(~F.col("title") | F.col("is_file") & titled).where(
        ~sooner).select("doc_id", "text_key", "is_file", "cued", "notice", "license", "rank", "needs", "telling", "others", start.alias("start"),
        (start + F.col("size")).alias("end"), "joined", denied.alias("denied"), window.alias("window")).where(
        F.arrays_overlap("window", "telling")).where(
        F.col("cued") | (F.size("others") == 0) | F.arrays_overlap("window", "others")).where(F.size(F.array_except("needs", "window")) == 0)
    keys = ["doc_id", "text_key", "is_file", "notice", "license", "rank", "start", "end", "joined", "denied"]
    counted = windows.select(*keys, F.explode("window").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("n"))
    weight = F.col("n") * F.coalesce("idf", F.lit(unseen))
    scored = counted.join(F.broadcast(rarities), "term", "left").join(
        F.broadcast(weights), ["notice", "term"], "left").groupBy(*keys).agg(
        (F.sum(weight * F.coalesce("unit", F.lit(0.0))) / F.sqrt(F.sum(weight * weight))).alias("similarity"))
    return scored.where(F.col("similarity") >= least).select(
        "doc_id", "text_key", "is_file", "rank", "similarity", "license", "start", "end", "joined", "denied")


def settled(found: DataFrame) -> DataFrame:
    """The matches that hold: of windows that share terms the nearest alone, unless it is denied.

    A joined name holds where it follows a notice that holds. Matches meet in parts of ``BLOCK`` terms, so a group has
    a bounded size in texts of any length; windows that share terms across the ends of parts may both hold.
    """
    keys = ["doc_id", "text_key", "is_file"]
    one = F.struct("rank", "similarity", (F.col("end") - F.col("start")).alias("size"), "license", "start", "end",
                   "joined", "denied")
    parts = found.groupBy(*keys, F.expr(f"start div {BLOCK}").alias("part")).agg(
        F.sort_array(F.collect_set(one), asc=False).alias("matches"))
    none = F.filter("matches", lambda m: F.lit(False))

    def nearest(held, m):
        shares = F.exists(held, lambda h: (h["start"] < m["end"]) & (m["start"] < h["end"]))
        return F.when(shares, held).otherwise(F.concat(held, F.array(m)))

    def following(held, m):
        after = ~m["joined"] | F.exists(held, lambda h: h["end"] == m["start"])
        return F.when(after & ~m["denied"], F.concat(held, F.array(m))).otherwise(held)

    alone = parts.select(*keys, F.aggregate("matches", none, nearest).alias("matches"))
    placed = F.array_sort("matches", lambda a, b: a["start"] - b["start"])
    held = alone.select(*keys, F.aggregate(placed, F.filter("matches", lambda m: F.lit(False)), following).alias("matches"))
    return held.select(*keys, F.inline("matches")).select(*keys, "rank", "similarity", "license", "start")


def ancestors(folder: Column) -> Column:
    """The folder and its ancestors, nearest first, the root as the empty text."""
    parts = F.array_remove(F.split(folder, "/"), "")
    depths = F.sequence(F.size(parts), F.lit(0), F.lit(-1))
    return F.transform(depths, lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def inherited(folders: DataFrame, licensed: DataFrame) -> DataFrame:
    """``folder, license, origin`` from the nearest of ``folder`` and its ancestors among ``licensed`` folders."""
    each = folders.select("folder", F.posexplode(ancestors(F.col("folder"))).alias("up", "origin"))
    return each.join(licensed, "origin").groupBy("folder").agg(
        F.min(F.struct("up", "origin", "license")).alias("nearest")).select(
        "folder", F.col("nearest.license").alias("inherited"), F.col("nearest.origin").alias("origin"))


def license_scan(
    docs: DataFrame, path: Column, is_license_file: Column, templates: dict[str, str] | None = None, least: float = 0.6,
    leading: int | None = None,
) -> DataFrame:
    """``doc_id, folder, similarity, license, licenses, inherited, origin, effective``, one row per input row.

    ``license`` is that of the notice nearest to any window of the text (see ``header_matches``) by TF-IDF cosine, if
    ``least`` or more. A licence
    file is also compared as a whole with whole licence texts, which decide where one is near. Names without a version
    count only where no better notice is found, a reservation of all rights only where no licence is; of equal ones the
    last by name. ``licenses`` has all licences that count like that one, in order of their names, joined ones ("MIT or
    Apache-2.0") among them. A notice right after "not" and the like is none. ``templates`` gives other notices by licence, in place of all of these.
    Files for which ``is_license_file`` holds give their folder its licence: the best match among them. With ``leading``
    they do so only if they are a whole licence text or a notice begins among their first so many terms. A file inherits from the nearest folder upwards; ``effective`` prefers its own. ``path`` names folders and
    file by slashes; a null path lies in the root. Null and empty texts have no licence; repeated rows score alike;
    other columns are ignored.
    """
    named = docs.select("doc_id", "text", path.alias("path"), F.coalesce(is_license_file, F.lit(False)).alias("is_file"))
    placed = named.select(
        "doc_id", F.xxhash64("text").alias("text_key"), "is_file",
        F.regexp_replace(F.coalesce("path", F.lit("")), "/*[^/]*$", "").alias("folder"))
    listed = [(k, v, [], NAMED, False, False) for k, v in templates.items()] if templates else notices()
    found = header_matches(named, listed, least, leading)
    if not templates:
        found = found.unionByName(file_matches(named))
    every = F.collect_set(F.struct("rank", "license"))  # no more than there are licences
    # Stored, since both the files and their folders read them.
    matches = stored(settled(found).groupBy(
        F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), F.col("is_file").alias("_file")).agg(
        F.max(F.struct("rank", "similarity", "license")).alias("best"), every.alias("every"),
        F.min("start").alias("first")).select("_doc", "_key", "_file", "best.*", "first", F.sort_array(F.transform(
            F.filter("every", lambda e: e["rank"] == F.col("best.rank")), lambda e: e["license"])).alias("licenses")), "license-matches")
    judged = placed.join(
        matches, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_key") == F.col("_key"))
        & (F.col("is_file") == F.col("_file")), "left").drop("_doc", "_key", "_file")
    giving = F.lit(True) if leading is None else F.col("first") <= leading
    licensed = judged.where(F.col("is_file") & F.col("license").isNotNull() & giving).groupBy(
        F.array_join(F.array_remove(F.split("folder", "/"), ""), "/").alias("origin")).agg(
        F.max(F.struct("rank", "similarity", "license")).alias("best")).select("origin", F.col("best.license").alias("license"))
    given = inherited(placed.select("folder").distinct(), licensed)
    return judged.join(given, "folder", "left").select(
        "doc_id", "folder", "similarity", "license", "licenses", "inherited", "origin",
        F.coalesce("license", "inherited").alias("effective"))
