"""License scans by a positional index of rare template words.

Each template is a canonical notice. Its words have an IDF over the templates; those of highest IDF are
its anchors, in that order. A start needs `AGREE` of a template's anchors, so it has one of the first
few: only these, the rarest licence words of a file, are looked up, and each place d of one with
posting (template, p) proposes the start d - p. A proposed start is kept if enough anchors stand at
about their relative positions, which intersects the postings, and counts as found when the mandatory
key phrases stand in the stretch it covers. No start that has enough anchors is missed, however long
the file is. The base phrases are counted besides, wherever they stand.

Defined results: a null or empty text has no words, no labels and score 0; of equally good starts the
earliest is taken and all templates that pass are labelled, so ties lose nothing; repeated rows are
scanned alike; an empty table gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame

from . import common
from .registry import query

# Phrases and labels of the contract.
BASE = {
    b"gnu general public license": "gpl",
    b"apache license": "apache",
    b"cc by": "cc-by",
    b"mit license": "mit",
}

# Public licence notices, as (label, mandatory key phrases, text).
TEMPLATES = [
    ("gpl-notice", ["free software", "gnu general public license", "free software foundation"],
     "This program is free software: you can redistribute it and/or modify it under the terms of the "
     "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
     "License, or (at your option) any later version."),
    ("gpl-line", ["licensed under the gnu general public license"],
     "This work is licensed under the GNU General Public License, version 3."),
    ("apache-notice", ["licensed under the apache license", "in compliance with the license"],
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
     "in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2.0", ["licensed under the apache license version 2 0"],
     "Licensed under the Apache License, Version 2.0."),
    ("mit-notice", ["permission is hereby granted free of charge", "deal in the software without restriction"],
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit-line", ["released under the mit license"], "Released under the MIT License."),
    ("bsd-notice", ["redistribution and use in source and binary forms", "are permitted provided that"],
     "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met"),
    ("cc-by-nc-4.0", ["licensed under cc by nc 4 0"], "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", ["licensed under cc by sa 4 0"], "Licensed under CC BY-SA 4.0."),
    ("cc-by-4.0", ["creative commons attribution 4 0 international"],
     "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("mpl-2.0", ["subject to the terms of the mozilla public license"],
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("lgpl-notice", ["gnu lesser general public license"],
     "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
     "Lesser General Public License as published by the Free Software Foundation"),
    ("agpl-notice", ["gnu affero general public license"],
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "Affero General Public License as published by the Free Software Foundation"),
    ("mit-full", ["permission is hereby granted free of charge", "substantial portions of the software",
             "the software is provided as is"],
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
     "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
     "following conditions: The above copyright notice and this permission notice shall be included in all "
     "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
     "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR "
     "A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
     "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
     "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("isc", ["permission to use copy modify and or distribute this software for any purpose", "the author disclaims all warranties"],
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
     "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
     "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
     "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
     "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
     "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("bsd-2-clause", ["redistributions of source code must retain the above copyright notice",
                      "redistributions in binary form must reproduce the above copyright notice"],
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
     "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
     "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
     "documentation and/or other materials provided with the distribution."),
    ("zlib", ["this software is provided as is without any express or implied warranty", "altered source versions must be plainly marked"],
     "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
     "be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
     "use this software for any purpose, including commercial applications, and to alter it and redistribute it "
     "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
     "you must not claim that you wrote the original software. 2. Altered source versions must be plainly marked "
     "as such, and must not be misrepresented as being the original software. 3. This notice may not be removed "
     "or altered from any source distribution."),
    ("unlicense", ["free and unencumbered software released into the public domain"],
     "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
     "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
     "binary, for any purpose, commercial or non-commercial, and by any means."),
    ("bsl-1.0", ["boost software license"],
     "Boost Software License - Version 1.0. Permission is hereby granted, free of charge, to any person or "
     "organization obtaining a copy of the software and accompanying documentation covered by this license"),
]
AGREE = 0.6  # share of a template's rare words that must agree on one start
SLACK = 2  # words by which agreeing starts may differ

# To lower case, and every byte that is no word character to a space.
_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Index:
    """Postings of the rarest template words, and per template all anchors with their positions."""

    def __init__(self, templates=TEMPLATES):
        self.templates = [(label, [words_of(k.encode()) for k in keys], words_of(text.encode()))
                          for label, keys, text in templates]
        seen = Counter(w for _, _, words in self.templates for w in set(words))
        self.idf = {w: math.log((1 + len(self.templates)) / n) for w, n in seen.items()}
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)  # of the words that are looked up
        self.anchors: list[list[tuple[bytes, list[int]]]] = []
        self.needed: list[int] = []
        for t, (_, _, words) in enumerate(self.templates):
            rare = sorted(set(words), key=lambda w: (-self.idf[w], w))[: max(2, min(12, len(set(words)) // 2 + 1))]
            self.anchors.append([(w, [p for p, x in enumerate(words) if x == w]) for w in rare])
            self.needed.append(math.ceil(AGREE * len(rare) - 1e-9))
            # `needed` of n anchors cannot all be among the last needed - 1.
            for w, at in self.anchors[t][: len(rare) - self.needed[t] + 1]:
                self.postings[w] += [(t, p) for p in at]
        self.vocabulary = frozenset(w for anchors in self.anchors for w, _ in anchors)

    def starts(self, words: list[bytes]) -> dict[int, list[tuple[int, float]]]:
        """Per template the starts at which enough anchors agree, with their share, in order."""
        places: dict[bytes, list[int]] = {}
        for d, w in enumerate(words):
            if w in self.vocabulary:
                places.setdefault(w, []).append(d)
        proposed: dict[int, set[int]] = {}
        for w in self.postings.keys() & places.keys():
            for t, p in self.postings[w]:
                proposed.setdefault(t, set()).update(d - p for d in places[w])
        out = {}
        for t, near in sorted(proposed.items()):
            votes: dict[int, int] = defaultdict(int)  # start -> the anchors that stand exactly there, as bits
            for bit, (w, at) in enumerate(self.anchors[t]):
                for p in at:
                    for d in places.get(w, ()):
                        votes[d - p] |= 1 << bit
            kept = []
            for s in sorted({s + x for s in near for x in range(-SLACK, SLACK + 1)} & votes.keys()):
                agreed = 0
                for x in range(-SLACK, SLACK + 1):
                    agreed |= votes.get(s + x, 0)
                if agreed.bit_count() >= self.needed[t]:
                    kept.append((s, agreed.bit_count() / len(self.anchors[t])))
            if kept:
                out[t] = kept
        return out

    def scan(self, words: list[bytes]) -> list[tuple[str, int, float]]:
        """(label, start, share) of every template found."""
        found = []
        for t, kept in self.starts(words).items():
            label, keys, template = self.templates[t]
            for s, share in sorted(kept, key=lambda x: (-x[1], x[0])):
                if self._verified(words, keys, s, len(template)):
                    found.append((label, s, share))
                    break
        return found

    @staticmethod
    def _verified(words, keys, start, length) -> bool:
        """All key phrases stand, as consecutive words, in the aligned stretch (with slack)."""
        stretch = b" " + b" ".join(words[max(0, start - 2 * SLACK): max(0, start) + length + 4 * SLACK]) + b" "
        return all(b" " + b" ".join(k) + b" " in stretch for k in keys)


def scan_text(text: bytes, index: Index) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text."""
    words = words_of(text)
    joined = b" " + b" ".join(words) + b" "
    places, labels = [], set()
    for phrase, label in BASE.items():
        at = joined.find(b" " + phrase + b" ")
        while at >= 0:
            places.append(joined.count(b" ", 0, at))
            labels.add(label)
            at = joined.find(b" " + phrase + b" ", at + 1)
    found = index.scan(words)
    score = max([0.5 if labels else 0.0, *(share for _, _, share in found)])
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)), ",".join(sorted(labels | {f[0] for f in found})), min(1.0, score))


def scan(docs: DataFrame, templates=None) -> DataFrame:
    """One row per row of `docs` (doc_id, text)."""
    templates = templates or TEMPLATES
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def run(batches):
        index = Index(templates)
        for batch in batches:
            buf, offsets = common.text_buffer(batch.column(1))
            data = memoryview(buf)
            rows = [scan_text(bytes(data[i:j]), index) for i, j in zip(offsets[:-1], offsets[1:])]
            columns = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, "
             "base_labels string, labels string, score double")


@query("op6_license_scan")
def op6_license_scan(spark, sf_dir):
    common.small_batches(spark)
    return scan(common.table(spark, sf_dir, "documents"))
