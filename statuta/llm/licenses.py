"""License scans: ordered signature rules with keyword gates and interval suppression.

Text is lower-cased (A-Z only) and read as words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``, joined by single spaces; every rule is a
pattern over that form and an offset is a number of words. Base phrases are reported at all their places. The rules add
labels: a rule is tried only if the words hold its keyword (any match does), each match is an interval, and an interval inside another of a
stronger (or the same, longer or earlier) rule is suppressed. Rules come in three strengths: 0 for identifiers and whole
sentences, 1 for "licensed under ..." statements, 2 for bare names.

Of rules with the same interval the stronger one stays, then the one whose label comes first. Texts of any length are read whole, in
time that grows with their length (times the logarithm of their matches). Nulls and empty texts have no words, no labels and score 0.
Rows are judged alike if repeated; empty tables give empty results; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, running, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]

#: label; keyword of the text; names (patterns over words); distinctive passages.
FAMILIES: list[tuple[str, str, str, list[str]]] = [
    ("mit", "mit", r"mit(?: x11)?", ["permission is hereby granted free of charge to any person obtaining a copy of this software"]),
    ("mit-0", "mit", r"mit(?: 0| no attribution)", []),
    ("apache-1", "apache", r"apache(?: software)?(?: license)?(?: version| v)? 1 [01]", ["redistribution and use in source and binary forms .{0,400} the apache software foundation"]),
    ("apache-2", "apache", r"apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?", ["you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"]),
    ("bsd-1-clause", "bsd", r"bsd (?:1|one) clause", []),
    ("bsd-2-clause", "bsd|freebsd", r"(?:simplified bsd|freebsd|bsd (?:2|two) clause|(?:2|two) clause bsd)", []),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd (?:3|three) clause|(?:3|three) clause bsd)", ["neither the name of .{1,80} nor the names of its contributors may be used to endorse or promote products"]),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd (?:4|four) clause|(?:4|four) clause bsd)", ["all advertising materials mentioning features or use of this software must display"]),
    ("0bsd", "bsd|0bsd", r"(?:zero clause bsd|bsd zero clause|0bsd)", []),
    ("bsd", "bsd", r"bsd(?: style| like)?", []),
    ("isc", "isc", r"isc", ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"]),
    ("gpl-1", "gnu|gpl|general public", r"(?:gnu )?(?:gpl|general public license)(?: version| v)? ?1(?: 0)?", []),
    ("gpl-2", "gnu|gpl|general public", r"(?:gnu )?(?:gpl|general public license)(?: version| v)? ?2(?: 0)?", ["under the terms of the gnu general public license as published by the free software foundation either version 2"]),
    ("gpl-3", "gnu|gpl|general public", r"(?:gnu )?(?:gpl|general public license)(?: version| v)? ?3(?: 0)?", ["under the terms of the gnu general public license as published by the free software foundation either version 3"]),
    ("gpl", "gnu|gpl|general public", r"(?:gnu gpl|gnu general public license|gpl)", []),
    ("lgpl-2", "gnu|lgpl|lesser general|library general", r"(?:gnu )?(?:lgpl|(?:lesser|library) general public license)(?: version| v)? ?2(?: 0)?", []),
    ("lgpl-2.1", "gnu|lgpl|lesser general|library general", r"(?:gnu )?(?:lgpl|lesser general public license)(?: version| v)? ?2 1", []),
    ("lgpl-3", "gnu|lgpl|lesser general|library general", r"(?:gnu )?(?:lgpl|lesser general public license)(?: version| v)? ?3(?: 0)?", []),
    ("lgpl", "gnu|lgpl|lesser general|library general", r"(?:gnu )?(?:lgpl|lesser general public license|library general public license)", []),
    ("agpl-3", "gnu|agpl|affero", r"(?:gnu )?(?:agpl|affero general public license|affero gpl)(?: version| v)? ?3(?: 0)?", []),
    ("agpl", "gnu|agpl|affero", r"(?:gnu )?(?:agpl|affero general public license|affero gpl)", []),
    ("gfdl", "gnu|gfdl|free documentation", r"(?:gnu )?(?:gfdl|free documentation license)(?: version 1 [123])?", []),
    ("mpl-1.0", "mozilla|mpl", r"(?:mozilla public license|mpl)(?: version| v)? 1 0", []),
    ("mpl-1.1", "mozilla|mpl", r"(?:mozilla public license|mpl)(?: version| v)? 1 1", []),
    ("mpl-2.0", "mozilla|mpl", r"(?:mozilla public license|mpl)(?: version| v)? ?2(?: 0)?", ["this source code form is subject to the terms of the mozilla public license v 2 0"]),
    ("mpl", "mozilla|mpl", r"mozilla public license", []),
    ("epl-1.0", "eclipse|epl", r"(?:eclipse public license|epl)(?: version| v)? ?1(?: 0)?", []),
    ("epl-2.0", "eclipse|epl", r"(?:eclipse public license|epl)(?: version| v)? ?2(?: 0)?", []),
    ("edl", "eclipse", r"eclipse distribution license(?: 1 0)?", []),
    ("eupl", "eupl|european union", r"(?:eupl|european union public licen[cs]e)(?: version| v)?(?: 1 [012])?", []),
    ("cddl-1.0", "cddl|common development", r"(?:cddl|common development and distribution license)(?: version| v)?(?: 1 0)?", []),
    ("cddl-1.1", "cddl|common development", r"(?:cddl|common development and distribution license)(?: version| v)? 1 1", []),
    ("cpl-1.0", "common public", r"common public license(?: version| v)?(?: 1 0)?", []),
    ("ipl-1.0", "ibm public", r"ibm public license(?: version| v)?(?: 1 0)?", []),
    ("cc0", "cc0|creative commons|cc zero", r"(?:cc0|cc zero|creative commons zero)(?: 1 0)?(?: universal)?", ["to the extent possible under law .{1,120} waived all copyright and related or neighboring rights"]),
    ("cc-by", "cc|creative commons", r"(?:cc by|creative commons attribution)(?: [1234] [05])?(?: international)?", []),
    ("cc-by-sa", "cc|creative commons", r"(?:cc by sa|creative commons attribution share ?alike)(?: [1234] [05])?", []),
    ("cc-by-nd", "cc|creative commons", r"(?:cc by nd|creative commons attribution no ?derivatives)(?: [1234] [05])?", []),
    ("cc-by-nc", "cc|creative commons", r"(?:cc by nc|creative commons attribution non ?commercial)(?: [1234] [05])?", []),
    ("cc-by-nc-sa", "cc|creative commons", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: [1234] [05])?", []),
    ("cc-by-nc-nd", "cc|creative commons", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?derivatives)(?: [1234] [05])?", []),
    ("cc", "creative commons", r"creative commons", []),
    ("pddl", "pddl|public domain dedication", r"(?:pddl|public domain dedication and license)", []),
    ("odbl", "odbl|open database", r"(?:odbl|open database license)(?: 1 0)?", []),
    ("odc-by", "odc|open data commons", r"(?:odc by|open data commons attribution license)", []),
    ("cdla-permissive", "cdla|community data", r"(?:cdla|community data license agreement) permissive(?: [12] 0)?", []),
    ("cdla-sharing", "cdla|community data", r"(?:cdla|community data license agreement) sharing(?: 1 0)?", []),
    ("ogl-uk", "open government", r"open government licen[cs]e(?: v?[123](?: 0)?)?", []),
    ("unlicense", "unlicense", r"(?:the )?unlicense", ["this is free and unencumbered software released into the public domain"]),
    ("wtfpl", "wtfpl|fuck", r"(?:wtfpl|do what the fuck you want to public license)", []),
    ("zlib", "zlib", r"zlib(?: libpng)?", ["this software is provided as is without any express or implied warranty in no event will the authors be held liable"]),
    ("libpng", "libpng", r"libpng", []),
    ("bsl-1.0", "boost|bsl", r"(?:boost software license|bsl)(?: version| v)?(?: 1 0)?", []),
    ("busl-1.1", "business source|busl", r"(?:business source license|busl)(?: 1 1)?", []),
    ("artistic-1.0", "artistic", r"artistic license(?: version| v)?(?: 1 0)?", []),
    ("artistic-2.0", "artistic", r"artistic license(?: version| v)? ?2(?: 0)?", []),
    ("perl", "perl", r"same terms as perl(?: itself)?", ["free software you can redistribute it and or modify it under the same terms as perl itself"]),
    ("python-2.0", "python|psf", r"(?:python software foundation license|psf license|python license)(?: version| v)?(?: 2)?", []),
    ("php-3.0", "php", r"php license(?: version| v)?(?: 3 0[01]?)?", []),
    ("ruby", "ruby", r"ruby license", []),
    ("ofl-1.1", "ofl|open font", r"(?:sil )?(?:ofl|open font license)(?: version| v)?(?: 1 [01])?", []),
    ("ubuntu-font", "ubuntu font", r"ubuntu font licence(?: 1 0)?", []),
    ("afl", "academic free", r"academic free license(?: version| v)?(?: [123] [012])?", []),
    ("osl", "open software license", r"open software license(?: version| v)?(?: [123] [01])?", []),
    ("ecl-2.0", "educational community", r"educational community license(?: version| v)?(?: 2 0)?", []),
    ("ncsa", "ncsa|university of illinois", r"(?:ncsa|university of illinois ncsa)(?: open source)?", []),
    ("ms-pl", "microsoft|ms pl", r"(?:ms pl|microsoft public license)", []),
    ("ms-rl", "microsoft|ms rl", r"(?:ms rl|microsoft reciprocal license)", []),
    ("upl-1.0", "upl|universal permissive", r"(?:upl|universal permissive license)(?: 1 0)?", []),
    ("vim", "vim", r"vim license", []),
    ("x11", "x11", r"x11", []),
    ("w3c", "w3c", r"w3c software(?: and document)?(?: notice and)?", []),
    ("postgresql", "postgresql", r"postgresql", []),
    ("openssl", "openssl", r"openssl", []),
    ("sleepycat", "sleepycat", r"sleepycat", []),
    ("qpl-1.0", "qpl|q public", r"(?:qpl|q public license)(?: 1 0)?", []),
    ("apsl-2.0", "apple public", r"apple public source license(?: 2 0)?", []),
    ("cecill", "cecill", r"cecill(?: b| c)?(?: 2 [01])?", []),
    ("mulan-2.0", "mulan", r"mulan (?:psl|permissive software license)(?: v?2)?", []),
    ("sspl-1.0", "sspl|server side public", r"(?:sspl|server side public license)(?: v?1)?", []),
    ("elastic-2.0", "elastic", r"elastic license(?: 2 0)?", []),
    ("commons-clause", "commons clause", r"commons clause", []),
    ("polyform-nc", "polyform", r"polyform noncommercial(?: license)?(?: 1 0 0)?", []),
    ("openrail-m", "openrail|rail", r"(?:creativeml )?(?:open ?rail(?: m)?|bigscience open rail m)", []),
    ("public-domain", "public domain", r"public domain", ["dedicated to the public domain", "has been placed in the public domain", "is in the public domain"]),
    ("proprietary", "reserved|proprietary|confidential", r"proprietary (?:and confidential|software)", ["all rights reserved", "unauthorized copying of this file via any medium is strictly prohibited"]),
]


def _rules() -> list[tuple[str, str, str, int, str]]:
    """(label, needed piece, keywords, strength, pattern over padded words), strongest first. No text matches without the piece and a keyword."""
    out = []
    for label, keyword, names, passages in FAMILIES:
        key = "|".join(f" {k}" for k in keyword.split("|"))
        # A passage has its own words for a keyword: its text need not name the license.
        out += [(label, "", " " + p.split(" .{")[0], 0, rf"(?<= ){p}(?= )") for p in passages]
        out.append((label, " spdx license identifier ", key, 0, rf"(?<= )spdx license identifier {names}(?: only| or later)?(?= )"))
        out.append((label, " under ", key, 1, rf"(?<= )(?:licensed|released|distributed|available|published|provided|redistributed|covered|used|made available)(?: by [^ ]+)? under (?:the |a |an )?(?:terms of (?:the )?)?(?:open source )?{names}(?: licen[cs]e)?(?: version| v)?(?= )"))
        out.append((label, " licen", key, 1, rf"(?<= )licen[cs]e (?:is |type |name )?(?:the )?{names}(?= )"))
        bare = any(x in names for x in ("licen", "domain", "gpl", "cc", "same terms", "clause", "rail"))
        out.append((label, "" if bare else " licen", key, 2, rf"(?<= ){names}(?= )" if bare else rf"(?<= )(?:the )?{names} (?:public )?licen[cs]e[ds]?(?= )"))
    return sorted(out, key=lambda r: r[3])


RULES = _rules()
STRENGTHS = 3
SCORES = [0.95, 0.85, 0.6]


def words_form(text: Column) -> Column:
    """The text's words joined by single spaces, with one before and one after; '' if it has none."""
    body = F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), GAP, " "))
    return F.when(body == "", F.lit("")).otherwise(F.concat(F.lit(" "), body, F.lit(" ")))


def _spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def word_places(norm: Column, pattern: Column) -> Column:
    """array<struct<start,end>>, in words, of a pattern's matches, each of which begins and ends at a word's edge."""
    gaps = F.transform(F.split(norm, pattern, -1), _spaces)
    hits = F.transform(F.regexp_extract_all(norm, pattern, F.lit(0)), _spaces)

    def summed(x: Column) -> Column:
        # Each gap ends in the space before a match, so the spaces up to a match's end number its last word, counted from 1.
        steps = F.transform(x["hits"], lambda n, i: F.get(x["gaps"], i) + n)
        return let(running(steps, lambda a, b: a + b), lambda ends: F.transform(x["hits"], lambda n, i: F.struct((F.get(ends, i) - n - 1).alias("start"), F.get(ends, i).alias("end"))))

    return let(F.struct(gaps.alias("gaps"), hits.alias("hits")), summed)


def base_hits(norm: Column) -> Column:
    none = F.array().cast("array<struct<start:int,end:int,label:string>>")

    def hits(phrase: str, label: str) -> Column:
        made = F.transform(word_places(norm, F.lit(f"(?<= ){phrase}(?= )")), lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end"), F.lit(label).alias("label")))
        return F.when(F.contains(norm, F.lit(f" {phrase} ")), made).otherwise(none)

    return F.concat(*[hits(*b) for b in BASE])


def rule_hits(norm: Column) -> Column:
    """Unsuppressed intervals: array<struct<start,end,strength,label>>."""
    keyed: dict[str, dict[str, list]] = {}
    for label, need, key, strength, pattern in RULES:
        keyed.setdefault(need, {}).setdefault(key, []).append(F.struct(F.lit(label).alias("label"), F.lit(strength).alias("strength"), F.lit(pattern).alias("pattern")))
    gates = F.array(*[F.struct(F.lit(need).alias("need"), F.array(*[F.struct(F.split(F.lit(key), r"\|").alias("keys"), F.array(*rules).alias("rules")) for key, rules in by.items()]).alias("by")) for need, by in keyed.items()])
    needed = F.flatten(F.transform(F.filter(gates, lambda g: F.contains(norm, g["need"])), lambda g: g["by"]))
    open_ = F.filter(needed, lambda g: F.exists(g["keys"], lambda k: F.contains(norm, k)))
    live = F.filter(F.flatten(F.transform(open_, lambda g: g["rules"])), lambda r: F.rlike(norm, r["pattern"]))
    every = F.flatten(F.transform(live, lambda r: F.transform(word_places(norm, r["pattern"]), lambda h: F.struct(h["start"].alias("start"), (-h["end"]).alias("back"), r["strength"].alias("strength"), r["label"].alias("label")))))

    def unsuppressed(hits: Column) -> Column:
        """In order of start, longest first, an interval lies inside an earlier one of no lesser strength if one of those ends no sooner."""
        reach = F.struct(*[running(F.transform(hits, lambda h: F.when(h["strength"] <= k, -h["back"])), F.greatest).alias(f"r{k}") for k in range(STRENGTHS)])

        def kept(r: Column) -> Column:
            before = lambda h, i: F.coalesce(*[F.when(h["strength"] == k, F.get(r[f"r{k}"], i - 1)) for k in range(STRENGTHS)], F.lit(-1))
            free = F.filter(hits, lambda h, i: before(h, i) < -h["back"])
            return F.transform(free, lambda h: F.struct(h["start"].alias("start"), (-h["back"]).alias("end"), h["strength"].alias("strength"), h["label"].alias("label")))

        return let(reach, kept)

    return let(F.sort_array(every), unsuppressed)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: words, base places and labels, all labels, a score and the rules' intervals."""
    text = text_of(F.col(text_col))

    def of(norm: Column) -> Column:
        return F.struct(base_hits(norm).alias("base"), rule_hits(norm).alias("rules"))

    found = docs.select(
        F.col(id_col).alias("doc_id"),
        F.when(text == "", 0).otherwise(F.size(F.split(text, RAW_GAP)) - F.left(text, F.lit(1)).rlike(RAW_GAP).cast("int") - F.right(text, F.lit(1)).rlike(RAW_GAP).cast("int")).alias("n"),
        let(words_form(text), of).alias("x"),
    ).select("doc_id", "n", "x.*")
    starts = F.transform("base", lambda h: h["start"])
    labels = lambda *a: F.array_join(F.array_sort(F.array_distinct(F.concat(*[F.transform(c, lambda h: h["label"]) for c in a]))), ",")
    best = F.array_min(F.transform("rules", lambda h: h["strength"]))
    score = F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.get(F.array(*map(F.lit, SCORES)), best), F.lit(0.0)))
    return found.select(
        "doc_id",
        F.col("n").cast("long").alias("n_words"),
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        labels("base").alias("base_labels"),
        labels("base", "rules").alias("labels"),
        score.alias("score"),
        F.array_join(F.transform("rules", lambda h: F.concat_ws(":", h["label"], h["start"].cast("string"), h["end"].cast("string"))), ",").alias("places"),
    )
