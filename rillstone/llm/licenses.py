"""Licence scans by a positional index of rare licence words.

Each licence notice is a template: its words with their positions. Words that few
templates share have a high inverse document frequency; they are the anchors. In every
text, the anchors found are looked up in the index, and each hit proposes where a
template would have to begin. Hits that agree on a template and a beginning intersect
there, and a label is given where the template's mandatory key phrase stands at its
place, unless the longer phrase of another template, which contains it, stands around it. All
rare words of a text are looked up, not only the rarest, so that a text may hold any number of
notices. Everything is one projection: no shuffle, no join, whatever a text holds.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.shared import LOWER, UPPER, table

#: Fixed by the contract: what parts words, and the phrases with their labels.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Template:
    """A notice, the label it stands for, and the phrase that must be found in it."""

    label: str
    notice: str
    phrase: str


TEMPLATES = (
    Template("agpl", "licensed under the gnu affero general public license", "affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("apache", "licensed under the apache license", "apache license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    Template("bsd", "released under the bsd license", "bsd license"),
    Template("cc-by", "licensed under cc by 4 0", "cc by"),
    Template("cc-by", "creative commons attribution 4 0 international license", "creative commons attribution"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc0", "dedicated to the public domain under cc0 1 0", "cc0 1 0"),
    Template("gpl", "this work is licensed under the gnu general public license", "general public license"),
    Template("gpl-2.0", "gnu general public license version 2", "general public license version 2"),
    Template("gpl-3.0", "gnu general public license version 3", "general public license version 3"),
    Template("isc", "released under the isc license", "isc license"),
    Template("lgpl", "gnu lesser general public license", "lesser general public license"),
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy",
             "permission is hereby granted free of charge"),
    Template("mpl-2.0", "mozilla public license version 2 0", "mozilla public license"),
    Template("reserved", "copyright all rights reserved", "all rights reserved"),
    # what bodies of licences say
    Template("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to",
             "the software is provided as is without warranty of any kind express or implied"),
    Template("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
             "redistributions of source code must retain the above copyright notice"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             "distribute this software for any purpose with or without fee is hereby granted"),
    Template("apache-2.0", "you may not use this file except in compliance with the license", "may not use this file except in compliance with the license"),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
             "under the terms of the gnu general public license"),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation",
             "under the terms of the gnu lesser general public license"),
    Template("agpl", "under the terms of the gnu affero general public license as published by the free software foundation",
             "under the terms of the gnu affero general public license"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license",
             "subject to the terms of the mozilla public license"),
    # lines that name a licence by its short identifier
    *(Template(label, f"spdx license identifier {name}", f"spdx license identifier {name}") for label, name in (
        ("agpl", "agpl"), ("apache-2.0", "apache 2 0"), ("bsd", "bsd"), ("cc-by", "cc by"), ("cc-by-sa", "cc by sa"),
        ("cc0", "cc0 1 0"), ("gpl", "gpl"), ("gpl-2.0", "gpl 2 0"), ("gpl-3.0", "gpl 3 0"), ("isc", "isc"), ("lgpl", "lgpl"),
        ("mit", "mit"), ("mpl-2.0", "mpl 2 0"), ("unlicense", "unlicense"))),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "unencumbered software released into the public domain"),
)

#: Words that are in more than this share of the templates anchor nothing.
COMMON_SHARE = 0.8
#: Anchors that must agree on a beginning (or all of a template's, where it has fewer).
AGREEING = 2


def _idf() -> dict[str, float]:
    df = Counter(w for t in TEMPLATES for w in set(t.notice.split()))
    return {w: math.log((1 + len(TEMPLATES)) / (1 + n)) for w, n in df.items()}


def anchors() -> dict[str, float]:
    """The index's words with their inverse document frequencies, rare ones only.

    A word of a key phrase that is rare outside licences stays; short function words
    and numbers, which every text holds, do not.
    """
    plain = set("a above and any are as be but by can copy fee file following for forms form free from hereby if in "
                "including into is it kind limited list may modify must not notice of or person provided purpose "
                "released retain source subject terms that the this to under use version with without work you "
                "0 1 2 3 4".split())  # fmt: skip
    rare = math.log((1 + len(TEMPLATES)) / (1 + COMMON_SHARE * len(TEMPLATES)))
    found = {w: x for w, x in _idf().items() if x >= rare and w not in plain}
    # the three words by which the base phrases are found
    return found | {w: _idf().get(w, rare) for w in ("cc", "general", "reserved")}


def postings() -> list[tuple[str, int, int, float]]:
    """The index: word, template, position in it, inverse document frequency."""
    weight = anchors()
    return [
        (word, t, at, weight[word])
        for t, template in enumerate(TEMPLATES)
        for at, word in enumerate(template.notice.split())
        if word in weight
    ]


def _needed(t: int) -> int:
    return min(AGREEING, sum(1 for _, of, _, _ in postings() if of == t))


def _full(t: int) -> float:
    return sum(x for _, of, _, x in postings() if of == t)


def phrase_offset(template: Template) -> int:
    """Where the key phrase begins within the notice, in words."""
    words, phrase = template.notice.split(), template.phrase.split()
    return next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)


def containing() -> list[tuple[int, str, int]]:
    """Template, a longer phrase of another label that contains its own, and where in it."""
    out = set()
    for t, template in enumerate(TEMPLATES):
        own = template.phrase.split()
        for other in TEMPLATES:
            words = other.phrase.split()
            for at in range(len(words) - len(own) + 1):
                if len(words) > len(own) and other.label != template.label and words[at : at + len(own)] == own:
                    out.add((t, other.phrase, at))
    return sorted(out)


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, so far as words of ASCII letters can tell.

    ``lower`` is fast and also changes other letters; only two of those turn into
    ASCII letters, and texts with one of them take the slow exact way.
    """
    odd = F.contains(text, F.lit("K")) | F.contains(text, F.lit("İ"))
    return F.when(odd, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def _stands(words: Column, at: Column, phrase: str) -> Column:
    """Whether the phrase's words stand consecutively from position ``at``."""
    parts = phrase.split()
    found = at >= 0
    for i, part in enumerate(parts):
        found = found & (F.get(words, at + i) == part)
    return F.coalesce(found, F.lit(False))


def _index_column() -> Column:
    """word -> array of (template, position, idf), as a literal map."""
    by_word: dict[str, list[Column]] = {}
    for word, t, at, weight in postings():
        by_word.setdefault(word, []).append(
            F.struct(F.lit(t).alias("t"), F.lit(at).alias("at"), F.lit(weight).alias("idf"))
        )
    empty = F.filter(
        F.array(F.struct(F.lit(0).alias("t"), F.lit(0).alias("at"), F.lit(0.0).alias("idf"))),
        lambda _: F.lit(False),
    )
    pairs = [x for w in anchors() for x in (F.lit(w), F.array(*by_word[w]) if w in by_word else empty)]
    return F.create_map(*pairs)


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Licence notices of every text.

    Result: the kept columns, ``n_words``, ``base`` (the base phrases found: label and
    first word), ``notices`` (label, first word of the key phrase, score of each
    template found, but for those within a longer phrase of another label) and ``score``, the largest share of a template's weight that was
    found at one place (0.5 at least where a base phrase stands, else 0). A null text
    counts as empty; an empty one has no words and no notices. Repeated rows give
    repeated results. Other columns, whatever their names, are left out.
    """
    words = F.regexp_extract_all(lower_ascii(F.coalesce(F.col(text), F.lit(""))), F.lit(WORD), F.lit(0))
    rare = sorted(anchors())
    here = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], words.alias("w"))
    # positions of anchors; all that follows touches these alone
    at = F.filter(
        F.transform("w", lambda x, i: F.when(x.isin(rare), i)), lambda i: i.isNotNull()
    )
    here = here.withColumn("hits", at)

    def base_places(phrase: str, label: str) -> Column:
        anchor, back = {"cc by": ("cc", 0), "general public license": ("general", 0),
                        "all rights reserved": ("reserved", 2)}[phrase]
        found = F.filter(
            F.col("hits"),
            lambda i: (F.get(F.col("w"), i) == anchor) & _stands(F.col("w"), i - back, phrase),
        )
        return F.transform(found, lambda i: F.struct(F.lit(label).alias("label"), (i - back).alias("at")))

    index = _index_column()
    proposals = F.flatten(
        F.transform(
            F.col("hits"),
            lambda i: F.transform(
                F.element_at(index, F.get(F.col("w"), i)),
                lambda p: F.struct(p["t"].alias("t"), (i - p["at"]).alias("start"), p["idf"].alias("idf")),
            ),
        )
    )
    here = here.withColumn("base", F.concat(*[base_places(p, x) for p, x in BASE.items()]))
    here = here.withColumn("found", F.array_sort(proposals))
    # runs of equal (template, beginning) in the sorted proposals
    heads = F.filter(
        F.sequence(F.lit(0), F.size("found") - 1),
        lambda j: (j == 0)
        | (F.get("found", j)["t"] != F.get("found", j - 1)["t"])
        | (F.get("found", j)["start"] != F.get("found", j - 1)["start"]),
    )
    here = here.withColumn("heads", F.when(F.size("found") > 0, heads).otherwise(F.array().cast("array<int>")))

    def run(j: Column, r: Column) -> Column:
        upto = F.coalesce(F.get("heads", r + 1), F.size("found"))
        share = F.aggregate(
            F.slice("found", j + 1, upto - j), F.lit(0.0), lambda total, x: total + x["idf"]
        )
        head = F.get("found", j)
        return F.struct(head["t"].alias("t"), head["start"].alias("start"), (upto - j).alias("n"), share.alias("idf"))

    longer = containing()

    def verified(c: Column) -> Column:
        ok = F.lit(False)
        for t, template in enumerate(TEMPLATES):
            place = c["start"] + phrase_offset(template)
            here_ok = (c["t"] == t) & (c["n"] >= _needed(t)) & _stands(F.col("w"), place, template.phrase)
            for which, phrase, inside in longer:
                if which == t:
                    here_ok = here_ok & ~_stands(F.col("w"), place - inside, phrase)
            ok = ok | here_ok
        return ok

    labels = F.array(*[F.lit(t.label) for t in TEMPLATES])
    offsets = F.array(*[F.lit(phrase_offset(t)) for t in TEMPLATES])
    full = F.array(*[F.lit(_full(t)) for t in range(len(TEMPLATES))])
    notices = F.transform(
        F.filter(F.transform("heads", run), verified),
        lambda c: F.struct(
            F.get(labels, c["t"]).alias("label"),
            (c["start"] + F.get(offsets, c["t"])).alias("at"),
            F.least(F.lit(1.0), c["idf"] / F.get(full, c["t"])).alias("score"),
        ),
    )
    here = here.withColumn("notices", notices)
    floor = F.when(F.size("base") > 0, 0.5).otherwise(0.0)
    best = F.coalesce(F.array_max(F.transform("notices", lambda n: n["score"])), F.lit(0.0))
    return here.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        F.size("w").cast("long").alias("n_words"),
        "base",
        "notices",
        F.round(F.greatest(floor, best), 9).alias("score"),
    )


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels of all documents."""
    found = scan(table(spark, sf_dir, "documents"))
    base = F.transform("base", lambda b: b["label"])
    more = F.transform("notices", lambda n: n["label"])
    place = F.transform("base", lambda b: b["at"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(place).cast("long").alias("first_word"),
        F.array_max(place).cast("long").alias("last_word"),
        _joined(base).alias("base_labels"),
        _joined(F.concat(base, more)).alias("labels"),
        "score",
    )


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else repr(x) for x in r) + ")" for r in rows)


#: The same in SQL, over one row for each word.
ORACLE_OP1 = f"""
with doc as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents),
posting(word, t, pos, idf) as (values {_values(postings())}),
template(t, label, plen, poff, phrase, needed, full_idf) as (values {_values([
    (t, x.label, len(x.phrase.split()), phrase_offset(x), x.phrase, _needed(t), _full(t))
    for t, x in enumerate(TEMPLATES)])}),
longer(t, phrase, off, plen) as (values {_values([(t, x, at, len(x.split())) for t, x, at in containing()])}),
base(phrase, label, plen) as (values {_values([(p, x, len(p.split())) for p, x in BASE.items()])}),
word as (select r, unnest(w) as word, unnest(range(len(w))) as i from doc),
start as (select r, t, i - pos as s, sum(idf) as idf, count(*) as n
  from word join posting using (word) group by all),
notice as (select start.r, template.label, least(1.0, idf / full_idf) as score
  from start join template using (t) join doc on doc.r = start.r
  where n >= needed and s + poff >= 0
    and array_to_string(list_slice(w, s + poff + 1, s + poff + plen), ' ') = phrase
    and not exists (select 1 from longer where longer.t = start.t and s + poff >= off
      and array_to_string(list_slice(w, s + poff - off + 1, s + poff - off + longer.plen), ' ') = longer.phrase)),
place as (select word.r, base.label, i
  from word join base on split_part(phrase, ' ', 1) = word join doc on doc.r = word.r
  where array_to_string(list_slice(w, i + 1, i + plen), ' ') = phrase),
pb as (select r, count(*) as n_base, min(i) as first_word, max(i) as last_word,
  string_agg(distinct label, ',' order by label) as base_labels from place group by r),
pl as (select r, string_agg(distinct label, ',' order by label) as labels
  from (select r, label from place union all select r, label from notice) group by r),
ps as (select r, max(score) as score from notice group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base,
  first_word::bigint as first_word, last_word::bigint as last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
  round(greatest(coalesce(score, 0.0::double), case when n_base > 0 then 0.5::double else 0.0::double end), 9)::double as score
from doc left join pb using (r) left join pl using (r) left join ps using (r)
"""
