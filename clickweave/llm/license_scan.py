"""Licence scan by a positional index of rare words.

Each template is a run of words with the place of every word (its postings) and
the phrases that must stand in it. The corpus says how rare each licence word is
(inverse document frequency over all rows). A template is looked up by the
``LOOKED_UP`` words of highest frequency weight among those of its mandatory
phrases. All of them stand wherever the template does, so a file that lacks one is
done with that template, and for every other file they are the rarest words that it
shares with the phrases. Each looked-up word proposes starts (its place in the file
less its place in the template); the starts that all words propose are left, and
none where the template stands is lost, however many notices the file has. There
the mandatory phrases are verified word by word, and enough of the other words must
agree. Each base phrase is looked up by its rarest word, so that all its places are
found.

Rarity only chooses what is looked up: which labels a text gets depends on nothing
but the text.

Only built-in column functions are used. A row is scanned where it lies: no join
and no shuffle but the count of documents per licence word, whose groups are the
words of the templates, a number that doesn't depend on the data.

Words are compared in place: replaced words lower a notice's share, and behind an
inserted or left-out word nothing agrees any more, so a whole notice bears that only
behind its mandatory phrases and the part that its ``share`` asks for.

Defined results: null and empty texts have no words, no labels and score 0; a null
id is carried; repeated rows are scanned each on its own; other columns are
ignored; over an empty table all words are equally rare; a task holds the words of
its longest text, which is never cut.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from clickweave.llm.common import texts

#: Phrases and the labels they stand for.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)


@dataclass(frozen=True)
class Template:
    """``text`` as words; ``phrases`` (parts of it) that must stand in their place."""

    label: str
    text: str
    phrases: tuple[str, ...]
    share: float = 0.75

    @property
    def words(self) -> list[str]:
        return self.text.split()

    def places(self) -> list[tuple[int, list[str]]]:
        """(place in the template, words) of each mandatory phrase."""
        found = []
        for phrase in self.phrases:
            part = phrase.split()
            at = next(i for i in range(len(self.words)) if self.words[i:i + len(part)] == part)
            found.append((at, part))
        return found


#: Words of each template that are looked up.
LOOKED_UP = 3
#: A word of a mandatory phrase counts as much as so many others. Weights don't depend on
#: the corpus, so a text's labels don't depend on other texts.
MANDATORY_WEIGHT = 5.0
#: Short notices as they are commonly written. Fixed values.
TEMPLATES = (
    Template("gpl-3.0", "licensed under the gnu general public license version 3",
             ("gnu general public license version 3",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2",
             ("gnu general public license version 2",)),
    Template("lgpl", "licensed under the gnu lesser general public license",
             ("gnu lesser general public license",)),
    Template("agpl", "licensed under the gnu affero general public license",
             ("gnu affero general public license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0",
             ("apache license version 2 0",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy "
             "of this software and associated documentation files",
             ("permission is hereby granted free of charge", "software and associated")),
    Template("bsd", "redistribution and use in source and binary forms with or without "
             "modification are permitted", ("redistribution and use in source",)),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license v 2 0",)),
    Template("isc", "permission to use copy modify and or distribute this software for any "
             "purpose with or without fee is hereby granted",
             ("permission to use copy modify", "with or without fee")),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc0-1.0", "cc0 1 0 universal public domain dedication", ("cc0 1 0 universal",)),
)
_WARRANTY = "without warranty of any kind express or implied including but not limited to the"
_BSD = ("redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met 1 redistributions of source "
        "code must retain the above copyright notice this list of conditions and the following "
        "disclaimer 2 redistributions in binary form must reproduce the above copyright notice "
        "this list of conditions and the following disclaimer in the documentation and or other "
        "materials provided with the distribution")
_BSD_END = ("this software is provided by the copyright holders and contributors as is and any "
            "express or implied warranties including but not limited to the implied warranties of "
            "merchantability and fitness for a particular purpose are disclaimed in no event shall "
            "the copyright holder or contributors be liable for any direct indirect incidental "
            "special exemplary or consequential damages including but not limited to procurement "
            "of substitute goods or services loss of use data or profits or business interruption "
            "however caused and on any theory of liability whether in contract strict liability or "
            "tort including negligence or otherwise arising in any way out of the use of this "
            "software even if advised of the possibility of such damage")


def _gnu(thing: str, name: str, version: str, label: str) -> Template:
    """The notice that the GNU licences ask to put into each file."""
    whose = f"{name} as published by the free software foundation"
    which = f"either version {version} of the license or at your option any later version"
    return Template(label, f"this {thing} is free software you can redistribute it and or modify it "
                    f"under the terms of the {whose} {which} this {thing} is distributed in the "
                    "hope that it will be useful but without any warranty without even the implied "
                    "warranty of merchantability or fitness for a particular purpose see the "
                    f"{name} for more details", (whose, which), 0.6)


#: Whole notices. Fixed values.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of "
             "this software and associated documentation files the software to deal in the software "
             "without restriction including without limitation the rights to use copy modify merge "
             "publish distribute sublicense and or sell copies of the software and to permit persons "
             "to whom the software is furnished to do so subject to the following conditions the "
             "above copyright notice and this permission notice shall be included in all copies or "
             "substantial portions of the software the software is provided as is "
             f"{_WARRANTY} warranties of merchantability fitness for a particular purpose and "
             "noninfringement in no event shall the authors or copyright holders be liable for any "
             "claim damages or other liability whether in an action of contract tort or otherwise "
             "arising from out of or in connection with the software or the use or other dealings "
             "in the software",
             ("obtaining a copy of this software and associated documentation files",
              "merge publish distribute sublicense"), 0.6),
    Template("bsd-2-clause", f"{_BSD} {_BSD_END}",
             ("redistribution and use in source and binary forms",
              "provided with the distribution this software is provided by"), 0.6),
    Template("bsd-3-clause", f"{_BSD} 3 neither the name of the copyright holder nor the names of "
             "its contributors may be used to endorse or promote products derived from this "
             f"software without specific prior written permission {_BSD_END}",
             ("redistribution and use in source and binary forms", "3 neither the name of"), 0.6),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose "
             "with or without fee is hereby granted provided that the above copyright notice and "
             "this permission notice appear in all copies the software is provided as is and the "
             "author disclaims all warranties with regard to this software including all implied "
             "warranties of merchantability and fitness in no event shall the author be liable for "
             "any special direct indirect or consequential damages or any damages whatsoever "
             "resulting from loss of use data or profits whether in an action of contract "
             "negligence or other tortious action arising out of or in connection with the use or "
             "performance of this software",
             ("for any purpose with or without fee is hereby granted",
              "the author disclaims all warranties"), 0.6),
    Template("apache-2.0", "licensed under the apache license version 2 0 the license you may not "
             "use this file except in compliance with the license you may obtain a copy of the "
             "license at http www apache org licenses license 2 0 unless required by applicable "
             "law or agreed to in writing software distributed under the license is distributed on "
             "an as is basis without warranties or conditions of any kind either express or implied "
             "see the license for the specific language governing permissions and limitations under "
             "the license", ("apache license version 2 0", "in compliance with the license"), 0.6),
    _gnu("program", "gnu general public license", "3", "gpl-3.0-or-later"),
    _gnu("program", "gnu general public license", "2", "gpl-2.0-or-later"),
    _gnu("library", "gnu lesser general public license", "2 1", "lgpl-2.1-or-later"),
    _gnu("program", "gnu affero general public license", "3", "agpl-3.0-or-later"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license "
             "v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at "
             "https mozilla org mpl 2 0", ("mozilla public license v 2 0", "a copy of the mpl"), 0.6),
    Template("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 "
             "international license", ("creative commons attribution 4 0",)),
    Template("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike "
             "4 0 international license", ("creative commons attribution sharealike 4 0",)),
    Template("cc-by-nc-4.0", "this work is licensed under a creative commons attribution "
             "noncommercial 4 0 international license",
             ("creative commons attribution noncommercial 4 0",)),
)
#: Words that say nothing by themselves are no entries of the index.
COMMON = frozenset("the a of to in and or by is any for with under this are use on 0 1 2 3 4 v "
                   "version terms subject free".split())


def words_of(text: Column) -> Column:
    """The text's words; A-Z become lower case, nothing else does."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))


def strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def idf(docs: DataFrame, words: Sequence[str]) -> dict[str, float]:
    """Inverse document frequency of the given words over all rows; one number per word."""
    seen = docs.select(F.explode(F.concat(
        F.array_intersect(words_of(F.coalesce("text", F.lit(""))), strings(words)),
        F.array(F.lit("")))).alias("word"))
    counts = {r["word"]: r["n"] for r in seen.groupBy("word").agg(F.count("*").alias("n")).collect()}
    total = counts.get("", 0)
    return {w: math.log((1 + total) / (1 + counts.get(w, 0))) for w in words}


def stands_at(tokens: Column, start: Column, words: Sequence[str]) -> Column:
    """Do the words stand one after the other from ``start`` (from 0) on?"""
    same = [F.coalesce(F.get(tokens, start + i) == w, F.lit(False)) for i, w in enumerate(words)]
    return reduce(lambda a, b: a & b, same)


def phrase_places(tokens: Column, occurrences: Column, words: Sequence[str],
                  rarity: dict[str, float]) -> Column:
    """Starts of a phrase, looked up by its rarest word."""
    at = max(range(len(words)), key=lambda i: (rarity[words[i]], -i))
    starts = F.transform(F.filter(occurrences, lambda o: o["w"] == words[at]),
                         lambda o: o["i"] - at)
    return F.filter(starts, lambda s: (s >= 0) & stands_at(tokens, s, words))


def mandatory(template: Template) -> list[tuple[str, int]]:
    """(word, place in the template) of the phrases' words that may be looked up, each word once."""
    found = [(w, at + i) for at, part in template.places() for i, w in enumerate(part)]
    kept = [(w, p) for w, p in found if w not in COMMON] or found
    return sorted({w: p for w, p in reversed(kept)}.items(), key=lambda wp: wp[1])


def postings(template: Template, rarity: dict[str, float]) -> list[tuple[str, int]]:
    """The rarest words of the mandatory phrases, each with its place in the template."""
    return sorted(mandatory(template), key=lambda wp: (-rarity[wp[0]], wp[1]))[:LOOKED_UP]


def proposed_starts(occurrences: Column, entries: Sequence[tuple[str, int]]) -> Column:
    """Starts on which the postings of all entries agree."""
    def shifted(word: str, place: int) -> Column:
        return F.transform(F.filter(occurrences, lambda o: o["w"] == word),
                           lambda o: o["i"] - place)

    agreed = reduce(F.array_intersect, [shifted(w, p) for w, p in entries])
    return F.filter(agreed, lambda s: s >= 0)


def template_scores(tokens: Column, occurrences: Column, template: Template,
                    rarity: dict[str, float]) -> Column:
    """For each start that passes, the share of the template's weight that agrees."""
    entries, words = postings(template, rarity), template.words
    must = len({at + i for at, part in template.places() for i in range(len(part))})
    whole = MANDATORY_WEIGHT * must + len(words) - must

    def verified(start: Column) -> Column:
        return reduce(lambda a, b: a & b, [F.slice(tokens, start + at + 1, len(part)) == strings(part)
                                           for at, part in template.places()])

    def score(start: Column) -> Column:
        same = F.zip_with(F.slice(tokens, start + 1, len(words)), strings(words),
                          lambda a, b: a.eqNullSafe(b))
        agree = F.size(F.filter(same, lambda x: x))
        return (agree + (MANDATORY_WEIGHT - 1) * must) / whole

    starts = F.filter(proposed_starts(occurrences, entries), verified)
    return F.filter(F.transform(starts, score), lambda share: share >= template.share)


def license_scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES + NOTICES,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, n_base, first_word, last_word, base_labels, labels, score)."""
    rows = texts(docs, id_col, text_col)
    phrases = [(p.split(), label) for p, label in BASE]
    rarity = idf(rows, sorted({w for p, _ in phrases for w in p}
                              | {w for t in templates for w, _ in mandatory(t)}))
    entries = [{w for w, _ in postings(t, rarity)} for t in templates]
    looked_up = sorted({max(p, key=lambda w: rarity[w]) for p, _ in phrases}.union(*entries))

    tokens, present = F.col("tokens"), F.col("present")
    rows = rows.select("id", words_of(F.coalesce("text", F.lit(""))).alias("tokens"))
    rows = rows.withColumn("present", F.array_intersect(tokens, strings(looked_up)))
    # Rows without any looked-up word, nearly all of them, stop here.
    occurrences = F.filter(F.transform(tokens, lambda w, i: F.struct(i.alias("i"), w.alias("w"))),
                           lambda o: F.array_contains(present, o["w"]))
    rows = rows.withColumn("occurrences", F.when(F.size(present) > 0, occurrences).otherwise(
        F.array().cast("array<struct<i:int,w:string>>")))

    def guarded(needed: Sequence[str], value: Column, kind: str) -> Column:
        """Only where the file has all the words; it must have them for a result."""
        all_there = reduce(lambda a, b: a & b, [F.array_contains(present, w) for w in needed])
        return F.when(all_there, value).otherwise(F.array().cast(f"array<{kind}>"))

    places = [guarded([max(p, key=lambda w: rarity[w])],
                      phrase_places(tokens, F.col("occurrences"), p, rarity), "int")
              for p, _ in phrases]
    scores = [guarded(sorted(e), template_scores(tokens, F.col("occurrences"), t, rarity), "double")
              for t, e in zip(templates, entries)]
    rows = rows.select("id", F.size("tokens").alias("n_words"),
                       *[p.alias(f"p{i}") for i, p in enumerate(places)],
                       *[s.alias(f"s{i}") for i, s in enumerate(scores)])
    starts = F.concat(*[F.col(f"p{i}") for i in range(len(phrases))])
    base = F.array(*[F.when(F.size(f"p{i}") > 0, label) for i, (_, label) in enumerate(phrases)])
    more = F.array(*[F.when(F.size(f"s{i}") > 0, t.label) for i, t in enumerate(templates)])
    best = F.array_max(F.concat(*[F.col(f"s{i}") for i in range(len(templates))]))

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(labels))), ",")

    base_score = F.when(F.size(starts) > 0, 0.75).otherwise(0.0)
    return rows.select(F.col("id").alias(id_col), F.col("n_words").cast("long"),
                       F.size(starts).cast("long").alias("n_base"),
                       F.array_min(starts).cast("long").alias("first_word"),
                       F.array_max(starts).cast("long").alias("last_word"),
                       joined(base).alias("base_labels"),
                       joined(F.concat(base, more)).alias("labels"),
                       F.greatest(F.coalesce(best, F.lit(0.0)), base_score).alias("score"))
