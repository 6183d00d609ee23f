"""License scans by ordered signature rules, in column expressions alone.

Text becomes lower-case words parted by single spaces. A rule is a regular
expression over such words with a label, a priority, a confidence, and
keywords and a hint without which it cannot match. A text that holds none of a few general
terms meets no rule; another meets only rules whose keywords it holds. A find
that lies inside one of equal or higher priority is suppressed.

The hundreds of rules come from families of licenses and the forms in which
they are stated, with some whole sentences besides.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Phrases and their labels.
BASE = {
    "gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit",
}

# Label, name as a regular expression over words, identifier as words, keywords of which a name has one.
_VERSION = "(?: version| v)?"
FAMILIES = [
    ("apache-2.0", rf"apache(?: software)?(?: license)?{_VERSION} 2(?: 0)?", "apache 2 0", "apache"),
    ("apache-1.1", rf"apache(?: software)?(?: license)?{_VERSION} 1 1", "apache 1 1", "apache"),
    ("apache", "apache(?: software)? licen[sc]e", "apache", "apache"),
    ("mit", "(?:mit|expat|x11) licen[sc]e", "mit", "mit|expat|x11"),
    ("mit-0", "mit no attribution", "mit 0", "mit"),
    ("bsd-2-clause", "(?:simplified bsd|bsd 2 clause|freebsd|2 clause bsd)(?: license)?", "bsd 2 clause", "bsd"),
    ("bsd-3-clause", "(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)(?: license)?", "bsd 3 clause", "bsd"),
    ("bsd-4-clause", "(?:original bsd|bsd 4 clause|4 clause bsd)(?: license)?", "bsd 4 clause", "bsd"),
    ("bsd", "bsd(?: style)? licen[sc]e", "bsd", "bsd"),
    ("0bsd", "(?:zero clause bsd|bsd zero clause)(?: license)?", "0bsd", "bsd"),
    ("isc", "isc licen[sc]e", "isc", "isc"),
    ("zlib", "zlib(?: libpng)? licen[sc]e", "zlib", "zlib"),
    ("gpl-1.0", rf"(?:gnu )?(?:general public license|gpl){_VERSION} ?1(?: 0)?", "gpl 1 0", "general public|gpl"),
    ("gpl-2.0", rf"(?:gnu )?(?:general public license|gpl){_VERSION} ?2(?: 0)?", "gpl 2 0", "general public|gpl"),
    ("gpl-3.0", rf"(?:gnu )?(?:general public license|gpl){_VERSION} ?3(?: 0)?", "gpl 3 0", "general public|gpl"),
    ("gpl", "(?:gnu general public licen[sc]e|gnu gpl)", "gpl", "gnu"),
    ("lgpl-2.0", rf"(?:gnu )?(?:library general public license|lgpl){_VERSION} 2(?: 0)?", "lgpl 2 0", "library general|lgpl"),
    ("lgpl-2.1", rf"(?:gnu )?(?:lesser general public license|lgpl){_VERSION} 2 1", "lgpl 2 1", "lesser|lgpl"),
    ("lgpl-3.0", rf"(?:gnu )?(?:lesser general public license|lgpl){_VERSION} 3(?: 0)?", "lgpl 3 0", "lesser|lgpl"),
    ("lgpl", "gnu (?:lesser|library) general public licen[sc]e", "lgpl", "gnu"),
    ("agpl-3.0", rf"(?:gnu )?(?:affero general public license|agpl){_VERSION} 3(?: 0)?", "agpl 3 0", "affero|agpl"),
    ("agpl", "(?:gnu )?affero general public licen[sc]e", "agpl", "affero"),
    ("gfdl", "gnu free documentation licen[sc]e", "gfdl", "free documentation"),
    ("mpl-1.1", rf"(?:mozilla public license|mpl){_VERSION} 1 1", "mpl 1 1", "mozilla|mpl"),
    ("mpl-2.0", rf"(?:mozilla public license|mpl){_VERSION} 2(?: 0)?", "mpl 2 0", "mozilla|mpl"),
    ("mpl", "mozilla public licen[sc]e", "mpl", "mozilla"),
    ("epl-1.0", rf"(?:eclipse public license|epl){_VERSION} 1(?: 0)?", "epl 1 0", "eclipse|epl"),
    ("epl-2.0", rf"(?:eclipse public license|epl){_VERSION} 2(?: 0)?", "epl 2 0", "eclipse|epl"),
    ("epl", "eclipse public licen[sc]e", "epl", "eclipse"),
    ("cddl-1.0", "common development and distribution licen[sc]e", "cddl 1 0", "common development"),
    ("cpl-1.0", "common public licen[sc]e", "cpl 1 0", "common public"),
    ("eupl-1.2", "european union public licen[sc]e", "eupl 1 2", "european union"),
    ("artistic-2.0", rf"artistic license{_VERSION} 2(?: 0)?", "artistic 2 0", "artistic"),
    ("artistic", "(?:perl )?artistic licen[sc]e", "artistic 1 0", "artistic"),
    ("boost", "boost software licen[sc]e", "bsl 1 0", "boost"),
    ("bsl-1.1", "business source licen[sc]e", "busl 1 1", "business source"),
    ("sspl", "server side public licen[sc]e", "sspl 1 0", "server side"),
    ("elastic", "elastic licen[sc]e", "elastic 2 0", "elastic"),
    ("unlicense", "(?:the )?unlicense", "unlicense", "unlicense"),
    ("wtfpl", "do what the f[a-z]* you want to public license", "wtfpl", "you want to"),
    ("psf", "python software foundation licen[sc]e", "psf 2 0", "python"),
    ("ruby", "ruby licen[sc]e", "ruby", "ruby"),
    ("php", "php licen[sc]e", "php 3 01", "php"),
    ("openssl", "openssl licen[sc]e", "openssl", "openssl"),
    ("ofl-1.1", "(?:sil )?open font licen[sc]e", "ofl 1 1", "open font"),
    ("odbl", "open (?:data commons open )?database licen[sc]e", "odbl 1 0", "database"),
    ("odc-by", "open data commons attribution licen[sc]e", "odc by 1 0", "data commons"),
    ("pddl", "public domain dedication and licen[sc]e", "pddl 1 0", "public domain"),
    ("ogl", "open government licen[sc]e", "ogl uk 3 0", "open government"),
    ("ms-pl", "microsoft public licen[sc]e", "ms pl", "microsoft"),
    ("ms-rl", "microsoft reciprocal licen[sc]e", "ms rl", "microsoft"),
    ("upl", "universal permissive licen[sc]e", "upl 1 0", "universal permissive"),
    ("afl-3.0", "academic free licen[sc]e", "afl 3 0", "academic free"),
    ("osl-3.0", "open software licen[sc]e", "osl 3 0", "open software"),
    ("ncsa", "(?:university of illinois )?ncsa (?:open source )?licen[sc]e", "ncsa", "ncsa"),
    ("json", "json licen[sc]e", "json", "json"),
    ("openrail", "(?:bigscience |creativeml )?open ?rail(?: m)?(?: license)?", "openrail", "rail"),
    ("llama", "llama [0-9 ]*community licen[sc]e", "llama", "llama"),
    ("cc0", "(?:cc0|cc zero|creative commons zero)(?: 1 0)?", "cc0 1 0", "cc|creative"),
] + [
    (
        "cc-" + "-".join(parts),
        r"(?:cc|creative commons) " + " ".join(words[p] for p in parts) + r"(?: [1-4] [05])?", "cc " + " ".join(parts), "cc|creative",
    )
    for words in [{
        "by": "(?:by|attribution)", "nc": "(?:nc|non ?commercial)",
        "nd": "(?:nd|no ?deriv(?:ative)?s?)", "sa": "(?:sa|share ?alike)",
    }]
    for parts in (("by",), ("by", "sa"), ("by", "nc"), ("by", "nd"), ("by", "nc", "sa"), ("by", "nc", "nd"))
]

# Form, regular expression around a name (N) or an identifier (S), keyword, priority, confidence.
FORMS = [
    ("tag", "spdx license identifier (?:[a-z0-9]+ )*?S(?: only| or later)?", "spdx", 3, 0.99),
    ("classifier", "license osi approved N", "osi approved", 3, 0.97),
    ("notice", "(?:licensed|released|distributed|published|provided|available|covered|governed)(?: to you)? (?:under|by)"
     "(?: the)?(?: terms(?: and conditions)? of)?(?: the)? N", "e", 2, 0.95),
    ("field", "licen[sc]e(?: type| is)? S", "licen", 2, 0.85),
    ("copying", "(?:subject to|see|read|accompanying|copy of)(?: the)?(?: terms of)?(?: the)? N", "e", 2, 0.9),
    ("title", "N", " ", 1, 0.7),
]

# Sentences of license texts: label, regular expression, keyword.
SENTENCES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", "with or without fee"),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "source and binary"),
    ("zlib", "this software is provided as is without any express or implied warranty", "as is"),
    ("gpl", "this program is free software you can redistribute it and or modify it", "free software"),
    ("lgpl", "this library is free software you can redistribute it and or modify it", "free software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", "source code form"),
    ("apache", "you may not use this file except in compliance with the license", "in compliance"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("cc0", "to the extent possible under law (?:[a-z0-9]+ )*?waived all copyright", "waived all"),
    ("public-domain", "(?:released|dedicated|placed) (?:in|in ?to) the public domain", "public domain"),
    ("proprietary", "all rights reserved", "rights reserved"),
    ("proprietary", "(?:proprietary and confidential|confidential and proprietary)", "proprietary"),
    ("proprietary", "unauthori[sz]ed (?:copying|use|reproduction|distribution)", "unauthori"),
    ("no-derivatives", "may not be (?:copied|reproduced|distributed)(?: or (?:copied|reproduced|distributed))? without", "may not be"),
]

#: A text meets rules only if it holds one of these; every match of a phrase or rule does. A space stands for
#: whatever parts two words, the underscore included.
GATE = (
    r"(?i)licen[sc]|spdx|apache|creative commons|cc(?: by|0| zero| attribution)(?![a-z])|(?<![a-z])(?:[al]?gpl|mpl|epl|(?:free)?bsd)(?![a-z])"
    r"|rights reserved|public domain|mit no attribution|open(?: )?rail|hereby granted|without fee"
    r"|source and binary|implied warranty|free software|source code form|unencumbered|waived all|proprietary and"
    r"|and proprietary|unauthori[sz]ed|may not be"
).replace(" ", r"[\W_]+")
_OTHER = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def rules() -> list[dict]:
    """All rules, in order: name, label, regex over a text of `` word word ``, keywords, hint, priority, confidence."""
    made = []
    for label, name, identifier, keyword in FAMILIES:
        for form, pattern, hint, priority, confidence in FORMS:
            inner = pattern.replace("N", f"(?:{name})").replace("S", identifier)
            own = identifier.split()[0] if "S" in pattern else keyword
            made.append((f"{label}/{form}", label, inner, own, hint, priority, confidence))
    for k, (label, pattern, keyword) in enumerate(SENTENCES):
        made.append((f"{label}/sentence{k}", label, pattern, keyword, keyword, 2, 0.9))
    keys = ("name", "label", "regex", "keywords", "hint", "priority", "confidence")
    return [dict(zip(keys, (*r[:2], f" (?:{r[2]})(?= )", r[3].split("|"), *r[4:]))) for r in made]


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``n_words``, ``n_base``, ``first_word``,
    ``last_word``, ``base_labels``, ``labels``, ``score``, ``finds``.

    ``n_base`` counts the places of the ``BASE`` phrases; ``first_word`` and
    ``last_word`` are the word numbers, from 0, where the first and last of them
    start, null if there is none. ``base_labels`` are their labels and
    ``labels`` those and the labels of the rules' finds that are not suppressed,
    both distinct, sorted and joined by commas. ``score`` is the highest
    confidence of such a find, 0 if there is none. ``finds`` is how many stay.

    A null text is empty: no words, no labels, score 0. Repeated rows stay and
    null ids are kept. Other columns are not read. The finds of a text are rows
    while they are sorted out, never one list.
    """
    phrases = f" ({'|'.join(BASE)})(?= )"
    table = json.dumps([{"at": i} | r for i, r in enumerate(rules())])
    kinds = "array<struct<at:int,label:string,regex:string,keywords:array<string>,hint:string,priority:int,confidence:double>>"
    raw = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counted = raw.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.regexp_count("text", F.lit(_WORD)).cast("bigint").alias("n_words"),
        F.when(F.col("text").rlike(GATE), F.concat(
            F.lit(" "), F.regexp_replace(F.regexp_replace(F.lower("text"), _OTHER, " "), "^ | $", ""), F.lit(" ")
        )).alias("norm"),
    )
    placed = counted.select(
        "row", "doc_id", "n_words", "norm",
        F.split("norm", phrases, -1).alias("gaps"), F.regexp_extract_all("norm", F.lit(phrases), F.lit(1)).alias("found"),
    )
    applied = placed.withColumn("rules", F.expr(f"""CASE WHEN norm IS NOT NULL THEN
        filter(from_json({_quoted(table)}, '{kinds}'), r -> contains(norm, r.hint) AND exists(r.keywords, k -> contains(norm, k))) END"""))
    one = """transform(r_found, (m, i) -> named_struct('rule', r.at, 'label', r.label, 'priority', r.priority,
        'confidence', r.confidence, 'i', i, 'gap', size(split(r_gaps[i], ' ')) - 1, 'words', size(split(m, ' ')) - 1))"""
    one = one.replace("r_found", "regexp_extract_all(norm, r.regex, 0)").replace("r_gaps[i]", "split(norm, r.regex, -1)[i]")
    has = F.coalesce(F.size("found") > 0, F.lit(False))
    last_gap, last_found = F.element_at("gaps", -1), F.element_at("found", -1)
    base = applied.select(
        "row", "doc_id", "n_words", F.when(has, F.size("found")).otherwise(0).cast("bigint").alias("n_base"),
        F.when(has, _spaces(F.element_at("gaps", 1))).alias("first_word"),
        F.when(has, F.col("n_words") - _spaces(last_found) - _spaces(last_gap)).alias("last_word"),
        F.when(has, F.array_sort(F.array_distinct(F.transform("found", _label)))).otherwise(F.array().cast("array<string>")).alias("base"),
        F.explode_outer(F.expr(f"flatten(transform(rules, r -> {one}))")).alias("find"),
    ).select("*", "find.*").drop("find").repartition("row")
    matches = Window.partitionBy("row", "rule").orderBy("i")
    spans = base.withColumn("end", F.sum(F.col("gap") + F.col("words")).over(matches))
    spans = spans.withColumn("start", F.col("end") - F.col("words"))
    before = Window.partitionBy("row").orderBy("start", F.desc("end"), F.desc("priority"), "rule").rowsBetween(Window.unboundedPreceding, -1)
    reach = [F.max(F.when(F.col("priority") >= p, F.col("end"))).over(before).alias(f"reach{p}") for p in (1, 2, 3)]
    inside = F.coalesce(F.element_at(F.array("reach1", "reach2", "reach3"), F.col("priority")) >= F.col("end"), F.lit(False))
    kept = spans.select("*", *reach).withColumn("stays", F.col("rule").isNotNull() & ~F.when(F.col("rule").isNotNull(), inside).otherwise(False))
    whole = kept.groupBy("row").agg(
        *(F.first(c).alias(c) for c in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base")),
        F.collect_set(F.when(F.col("stays"), F.col("label"))).alias("more"),
        F.coalesce(F.max(F.when(F.col("stays"), F.col("confidence"))), F.lit(0.0)).alias("score"),
        F.count_if("stays").alias("finds"),
    )
    return whole.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "more")), ",").alias("labels"), "score", "finds",
    )


def _spaces(c: Column) -> Column:
    """Words of a stretch, each with its space before it; one fewer for the words of a phrase or an end."""
    return (F.char_length(c) - F.char_length(F.replace(c, F.lit(" "), F.lit("")))).cast("bigint")


def _label(phrase: Column) -> Column:
    found = F.lit(None).cast("string")
    for text, label in BASE.items():
        found = F.when(phrase == text, label).otherwise(found)
    return found


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
