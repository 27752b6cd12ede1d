"""Licence notices found by Dice coefficient over word bigrams, in DataFrame operations alone.

A text's lines, and its paragraphs of several lines, are normalised (lower case, only letters and
digits) and compared with licence templates: twice the common bigrams over the sum of both
numbers, each bigram once. A coefficient of t needs sizes within t / (2 - t) and (2 - t) / t of each
other, so most templates are ruled out by size alone. It also needs a share of t / (2 - t) of the
template's bigrams, so of any larger rest at least one: each template names words that occur in
so many of its bigrams, and only texts and units holding such a word are normalised at all.
Everything happens inside one row: no shuffle, no explode.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
    "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
)
_MIT_KEEP = " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_MIT_AS_IS = (
    " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
    "the above copyright notice and this permission notice appear in all copies."
)
_ISC_AS_IS = (
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
    "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_OPENING = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_TWO = (
    " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_BSD_THIRD = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission."
)
_BSD_AS_IS = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED "
    "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def _gnu(kind: str, *versions: str, work: str = "program") -> tuple[str, ...]:
    """The notices of a GNU licence: a sentence, and the header of a file."""
    name = f"GNU {kind} Public License"
    return tuple(
        wording
        for v in versions
        for wording in (
            f"This work is licensed under the {name}, version {v}.",
            f"This {work} is free software: you can redistribute it and/or modify it under the terms of the {name} as published "
            f"by the Free Software Foundation, either version {v} of the License, or (at your option) any later version.",
        )
    )


# Wordings of public licences and of their usual notices. Licences that open alike
# each have their own; the sentence that both BSD licences open with names both.
TEMPLATES: Mapping[str, tuple[str, ...]] = {
    "AGPL-3.0": _gnu("Affero General", "3"),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "This project is licensed under the Apache License, Version 2.0.",
    ),
    "BSD-2-Clause": ("Released under the BSD 2-Clause License.", _BSD_OPENING + _BSD_TWO, _BSD_OPENING + _BSD_TWO + _BSD_AS_IS),
    "BSD-2-Clause OR BSD-3-Clause": (_BSD_OPENING,),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        _BSD_OPENING + _BSD_TWO + _BSD_THIRD,
        _BSD_OPENING + _BSD_TWO + _BSD_THIRD + _BSD_AS_IS,
        _BSD_THIRD,
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC0-1.0": ("Released under CC0 1.0 Universal, Public Domain Dedication.",),
    "GPL-2.0": _gnu("General", "2"),
    "GPL-3.0": _gnu("General", "3"),
    "ISC": (_ISC_GRANT, _ISC_GRANT + _ISC_AS_IS),
    "LGPL-2.0": _gnu("Library General", "2", work="library"),
    "LGPL-2.1": _gnu("Lesser General", "2.1", work="library"),
    "LGPL-3.0": _gnu("Lesser General", "3") + _gnu("Lesser General", "3", work="library")[1:],
    "MIT": (
        "Released under the MIT License.",
        f"{_MIT_GRANT}, subject to the following conditions:",
        f"{_MIT_GRANT}, subject to the following conditions:" + _MIT_KEEP + _MIT_AS_IS,
        "This project is released under the MIT License.",
        "This project is licensed under the MIT License.",
    ),
    "MIT-0": (f"{_MIT_GRANT}.", f"{_MIT_GRANT}." + _MIT_AS_IS),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}

# Shorter words are looked for as words of their own, longer ones anywhere.
_LONG = 5
_NOT_WORD = r"[^\p{L}\p{N}]+"
_BLANK_LINE = r"\n[ \t\r]*\n"


def template_bigrams(templates: Mapping[str, tuple[str, ...]]) -> list[tuple[str, list[str]]]:
    """(licence, sorted distinct bigrams) of each wording, by licence."""
    out = []
    for name in sorted(templates):
        for wording in templates[name]:
            words = re.findall(r"[^\W_]+", wording.lower())
            out.append((name, sorted({f"{a} {b}" for a, b in zip(words, words[1:])})))
    return out


def needed_words(templates: Mapping[str, tuple[str, ...]], least: float) -> list[str]:
    """Words of which every unit that matches some template at ``least`` holds one or more."""
    chosen: set[str] = set()
    for _, grams in template_bigrams(templates):
        missed = len(grams) - math.ceil(len(grams) * least / (2 - least) - 1e-9)
        open_ = [set(g.split(" ")) for g in grams]
        covered = 0
        while covered <= missed:
            # A word chosen before costs nothing; else a long one, or one of many consonants.
            count = Counter(w for g in open_ for w in g)
            rank = lambda w: (w in chosen, len(w) if len(w) >= _LONG else 0, len(re.sub("[aeiouy0-9]", "", w)), count[w], w)
            word = max(count, key=rank)
            chosen.add(word)
            covered += count[word]
            open_ = [g for g in open_ if word not in g]
    # Long words are looked for anywhere, so one that holds another adds nothing.
    return sorted(w for w in chosen if not any(v != w and len(v) >= _LONG and v in w for v in chosen))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), body)[0]


def best_match(unit: Column, templates: Mapping[str, tuple[str, ...]], least: float) -> Column:
    """struct(dice, license) of the closest template at ``least`` or more, else null; ties by name."""
    grams = template_bigrams(templates)
    every = sorted({g for _, part in grams for g in part})
    low = min(len(g) for _, g in grams) * least / (2 - least)
    entries = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(n).alias("license"), F.lit(len(g)).alias("n"), F.array(*map(F.lit, g)).alias("grams")) for i, (n, g) in enumerate(grams)))
    words = F.split(F.trim(F.regexp_replace(F.lower(unit), _NOT_WORD, " ")), " ")

    def compare(own: Column) -> Column:
        n = F.size(own)
        sized = F.filter(entries, lambda t: (n >= t.n * (least / (2 - least))) & (n <= t.n * ((2 - least) / least)))
        dice = F.transform(
            sized, lambda t: F.struct((2.0 * F.size(F.array_intersect(own, t.grams)) / (n + t.n)).alias("dice"), (-t.i).alias("i"), t.license.alias("license"))
        )
        return F.array_max(F.filter(dice, lambda d: d.dice >= least))

    def bigrams(w: Column) -> Column:
        pairs = F.transform(F.slice(w, F.lit(1), F.size(w) - 1), lambda x, i: F.concat(x, F.lit(" "), F.get(w, i + 1)))
        near = _let(pairs, lambda p: F.when(F.exists(p, lambda g: g.isin(every)), compare(F.array_distinct(p))))
        return F.when(F.size(w) - 1 >= low, near)

    return _let(words, bigrams)


def scan(docs: DataFrame, text_col: str = "text", templates: Mapping[str, tuple[str, ...]] = TEMPLATES, least: float = 0.8) -> DataFrame:
    """``docs`` as (rest, license, score, n_matches, matches).

    ``rest`` is a struct of the row, ``matches`` holds (license, score, unit) of every line, and every
    paragraph of several lines, that a template matches at ``least`` or more; ``license`` and
    ``score`` are the best of them, ties by name, null where there is none. Null, empty and blank
    texts and units of one word match nothing; repeated rows and repeated lines count each.
    """
    text = F.col(f"`{text_col}`")
    paragraphs = F.filter(F.split(text, _BLANK_LINE), lambda p: F.contains(p, F.lit("\n")))
    needed = needed_words(templates, least)
    short = "|".join(w for w in needed if len(w) < _LONG)
    alone = rf"(?<![\p{{L}}\p{{N}}])(?:{short})(?![\p{{L}}\p{{N}}])"

    def holds(unit: Column) -> Column:
        def any_of(low: Column) -> Column:
            tests = [F.contains(low, F.lit(w)) for w in needed if len(w) >= _LONG]
            return reduce(Column.__or__, tests + [low.rlike(alone)] * bool(short))

        return _let(F.lower(unit), any_of)

    units = F.when(holds(text), F.filter(F.concat(F.split(text, "\n"), paragraphs), holds))
    hits = F.filter(
        F.transform(units, lambda u: F.struct(best_match(u, templates, least).alias("m"), u.alias("unit"))), lambda h: h.m.isNotNull()
    )
    found = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("rest"),
        F.coalesce(F.transform(hits, lambda h: F.struct(h.m.license.alias("license"), h.m.dice.alias("score"), h.unit.alias("unit"), h.m.i.alias("i"))), F.array()).alias("matches"),
    )
    best = F.array_max(F.transform("matches", lambda m: F.struct(m.score.alias("score"), m.i.alias("i"), m.license.alias("license"))))
    shown = F.transform("matches", lambda m: F.struct(m.license.alias("license"), m.score.alias("score"), m.unit.alias("unit")))
    return found.select("rest", best.license.alias("license"), best.score.alias("score"), F.size("matches").alias("n_matches"), shown.alias("matches"))
