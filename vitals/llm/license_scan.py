"""Licence notices in texts by a positional index of their rarest words.

Every template is filed under the words of the highest inverse document frequency of its mandatory phrase, with their positions. A text's
occurrences of such words give postings (template, start); a start that the rare words agree on is checked for the
template's mandatory phrase and scored by the share of its words in place.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import alnum_words, slices, tidy, word_hash

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class Template:
    """``must``: words of ``text`` that have to stand in their place, one after the other."""

    label: str
    text: str
    must: str
    base: bool = False


def phrase(label: str, text: str) -> Template:
    return Template(label, text, text, True)


# Phrases of the query contract, and beginnings of common notices.
BASE = (phrase("mit", "under the mit license"), phrase("apache-2", "apache license version 2"), phrase("cc-by-nc", "cc by nc"))
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "licensed under the apache license"),
    Template("gpl-2", "gnu general public license version 2", "gnu general public license version 2"),
    Template("gpl-3", "gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "terms of the gnu general public license"),
    Template("lgpl", "gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl-3", "gnu affero general public license version 3", "gnu affero general public license"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    Template("cc0", "cc0 1 0 universal public domain dedication", "cc0 1 0 universal"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)
# Whole licences, from below their line of copyright, without punctuation.
LICENCES = (
    Template(
        "mit",
        """permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files the software to deal in the software without restriction including without limitation the rights
        to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to
        whom the software is furnished to do so subject to the following conditions the above copyright notice and this
        permission notice shall be included in all copies or substantial portions of the software the software is provided
        as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
        fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for
        any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in
        connection with the software or the use or other dealings in the software""",
        "use copy modify merge publish distribute sublicense and or sell copies",
    ),
    Template(
        "isc",
        """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
        provided that the above copyright notice and this permission notice appear in all copies the software is provided as
        is and the author disclaims all warranties with regard to this software including all implied warranties of
        merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential
        damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract
        negligence or other tortious action arising out of or in connection with the use or performance of this software""",
        "this permission notice appear in all copies",
    ),
    Template(
        "bsd-2",
        """redistribution and use in source and binary forms with or without modification are permitted provided that the
        following conditions are met 1 redistributions of source code must retain the above copyright notice this list of
        conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice
        this list of conditions and the following disclaimer in the documentation and or other materials provided with the
        distribution this software is provided by the copyright holders and contributors as is and any express or implied
        warranties including but not limited to the implied warranties of merchantability and fitness for a particular
        purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect
        incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or
        services loss of use data or profits or business interruption however caused and on any theory of liability whether
        in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this
        software even if advised of the possibility of such damage""",
        "redistributions in binary form must reproduce the above copyright notice",
    ),
    Template(
        "bsd-3",
        """redistribution and use in source and binary forms with or without modification are permitted provided that the
        following conditions are met 1 redistributions of source code must retain the above copyright notice this list of
        conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice
        this list of conditions and the following disclaimer in the documentation and or other materials provided with the
        distribution 3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission this software is provided by
        the copyright holders and contributors as is and any express or implied warranties including but not limited to the
        implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the
        copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential
        damages including but not limited to procurement of substitute goods or services loss of use data or profits or
        business interruption however caused and on any theory of liability whether in contract strict liability or tort
        including negligence or otherwise arising in any way out of the use of this software even if advised of the
        possibility of such damage""",
        "may be used to endorse or promote products derived from this software",
    ),
    Template(
        "zlib",
        """this software is provided as is without any express or implied warranty in no event will the authors be held liable
        for any damages arising from the use of this software permission is granted to anyone to use this software for any
        purpose including commercial applications and to alter it and redistribute it freely subject to the following
        restrictions 1 the origin of this software must not be misrepresented you must not claim that you wrote the original
        software if you use this software in a product an acknowledgment in the product documentation would be appreciated
        but is not required 2 altered source versions must be plainly marked as such and must not be misrepresented as being
        the original software 3 this notice may not be removed or altered from any source distribution""",
        "altered source versions must be plainly marked as such",
    ),
    Template(
        "bsl-1",
        """permission is hereby granted free of charge to any person or organization obtaining a copy of the software and
        accompanying documentation covered by this license the software to use reproduce display distribute execute and
        transmit the software and to prepare derivative works of the software and to permit third parties to whom the
        software is furnished to do so all subject to the following the copyright notices in the software and this entire
        statement including the above license grant this restriction and the following disclaimer must be included in all
        copies of the software in whole or in part and all derivative works of the software unless such copies or derivative
        works are solely in the form of machine executable object code generated by a source language processor""",
        "machine executable object code generated by a source language processor",
    ),
    Template(
        "unlicense",
        """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use
        compile sell or distribute this software either in source code form or as a compiled binary for any purpose
        commercial or non commercial and by any means in jurisdictions that recognize copyright laws the author or authors of
        this software dedicate any and all copyright interest in the software to the public domain we make this dedication
        for the benefit of the public at large and to the detriment of our heirs and successors we intend this dedication to
        be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright
        law""",
        "dedicate any and all copyright interest in the software to the public domain",
    ),
    Template(
        "wtfpl",
        """everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is
        allowed as long as the name is changed do what the fuck you want to public license terms and conditions for copying
        distribution and modification 0 you just do what the fuck you want to""",
        "do what the fuck you want to public license",
    ),
    Template(
        "apache-2",
        """licensed under the apache license version 2 0 the license you may not use this file except in compliance with the
        license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable
        law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties
        or conditions of any kind either express or implied see the license for the specific language governing permissions
        and limitations under the license""",
        "see the license for the specific language governing permissions and limitations",
    ),
)
#: Words that a template is filed under.
ANCHORS = 3
#: The least share of a template's words in place.
SHARE = 0.5


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _codes(hashes: np.ndarray, vocab: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(vocab, hashes), len(vocab) - 1)
    return np.where(vocab[at] == hashes, at, -1)


def inverse_frequencies(docs: DataFrame, words: list[str]) -> dict[str, float]:
    """log(documents / documents with the word) of the templates' words, over all of ``docs`` (text). One row a word comes back."""
    order = sorted(words, key=word_hash)
    vocab = np.array([word_hash(w) for w in order], np.uint64)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocab) + 1, np.int64)
        for batch in batches:
            total[-1] += batch.num_rows
            for _, data, offsets in slices(batch.column(0)):
                hashes, _, _, first = alnum_words(data, offsets)
                codes = _codes(hashes, vocab)
                at = np.flatnonzero(codes >= 0)
                row = np.searchsorted(first, at, "right") - 1
                seen = np.unique(row * len(vocab) + codes[at]) % len(vocab)
                total[:-1] += np.bincount(seen, minlength=len(vocab))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["word", "n"])

    rows = docs.select("text").mapInArrow(tidy(task), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    n = {r.word: r.n for r in rows}
    everything = n.get(len(vocab), 0)
    return {w: math.log((everything + 1) / (n.get(i, 0) + 1)) for i, w in enumerate(order)}


def scan(docs: DataFrame, templates: tuple[Template, ...] = BASE + NOTICES + LICENCES, anchors: int = ANCHORS, share: float = SHARE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: one row for each row of ``docs`` (doc_id, text).

    Base templates are found wherever their words stand one after the other. Other templates need their mandatory phrase
    in its place, half of their rare words, and ``share`` of all words in place: a notice for its opening sentence, a
    licence for its whole text. ``score``: the largest share found, 1 for a base template. A null or empty text has no
    words; repeated rows stay; an empty table gives no rows. The templates must fit in a task's closure.
    """
    texts = [words_of(t.text) for t in templates]
    order = sorted({w for t in texts for w in t}, key=word_hash)
    vocab = np.array([word_hash(w) for w in order], np.uint64)
    code = {w: i for i, w in enumerate(order)}
    idf = inverse_frequencies(docs, order)
    plans, filed = [], []
    for nth, (t, words) in enumerate(zip(templates, texts, strict=True)):
        must = words_of(t.must)
        at = next(i for i in range(len(words)) if words[i : i + len(must)] == must)
        rare = sorted(dict.fromkeys(must), key=lambda w: (-idf[w], w))[: 1 if t.base else anchors]
        filed += [(code[w], nth, i) for w in rare for i in range(at, at + len(must)) if words[i] == w]
        plans.append((t, np.array([code[w] for w in words]), at, len(must), len(rare)))
    # the index: postings (template, position) of each word that templates are filed under
    posted = np.array(sorted(filed), np.int64)
    heads = np.searchsorted(posted[:, 0], np.arange(len(vocab) + 1))

    def candidates(codes: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(template, starts, votes): where the filed words among ``codes`` put each template, and how many of them agree."""
        n = np.append(np.diff(heads), 0)[codes]  # the last for words of no template
        at = np.flatnonzero(n)
        n = n[at]
        posting = np.repeat(heads[codes[at]] - np.cumsum(n) + n, n) + np.arange(n.sum())
        nth, start = posted[posting, 1], np.repeat(at, n) - posted[posting, 2]
        order = np.lexsort((start, nth))
        nth, start = nth[order], start[order]
        new = np.flatnonzero(np.concatenate([[True], (nth[1:] != nth[:-1]) | (start[1:] != start[:-1])])[: len(nth)])
        votes = np.diff(np.append(new, len(nth)))
        nth, start = nth[new], start[new]
        cuts = np.searchsorted(nth, np.arange(len(plans) + 1))
        return [(i, start[a:b], votes[a:b]) for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if b > a]

    def starts(codes: np.ndarray, row: np.ndarray, first: np.ndarray, plan: tuple, found: np.ndarray, votes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a template stands, and the share of its words in place there."""
        t, words, at, length, rare = plan
        found = found[(votes * 2 >= rare) & (found + at >= 0) & (found + at + length <= len(codes))]
        # the mandatory phrase within one text
        for k in range(length):
            found = found[codes[found + at + k] == words[at + k]]
        found = found[row[found + at] == row[found + at + length - 1]]
        if t.base or not len(found):
            return found + at, np.ones(len(found))
        home = row[found + at]
        low, high = first[home], first[home + 1]
        hits = np.zeros(len(found))
        for k, w in enumerate(words):
            x = found + k
            inside = (x >= low) & (x < high)
            hits[inside] += codes[x[inside]] == w
        good = hits >= share * len(words)
        return (found + at)[good], (hits / len(words))[good]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in slices(batch.column(1)):
                hashes, _, _, first = alnum_words(data, offsets)
                n = len(offsets) - 1
                codes, row = _codes(hashes, vocab), np.repeat(np.arange(n), np.diff(first))
                count, low, high = np.zeros(n, np.int64), [None] * n, [None] * n
                labels, base, score = [set() for _ in range(n)], [set() for _ in range(n)], np.zeros(n)
                for nth, found, votes in candidates(codes):
                    plan = plans[nth]
                    places, shares = starts(codes, row, first, plan, found, votes)
                    for p, s in zip(places.tolist(), shares.tolist(), strict=True):
                        r = int(row[p])
                        labels[r].add(plan[0].label)
                        score[r] = max(score[r], s)
                        if plan[0].base:
                            p -= int(first[r])
                            base[r].add(plan[0].label)
                            count[r] += 1
                            low[r] = p if low[r] is None else min(low[r], p)
                            high[r] = p if high[r] is None else max(high[r], p)
                joined = lambda sets: pa.array([",".join(sorted(x)) for x in sets], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), pa.array(np.diff(first).astype(np.int64)), pa.array(count), pa.array(low, pa.int64()), pa.array(high, pa.int64()), joined(base), joined(labels), pa.array(score)], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return docs.select("doc_id", "text").mapInArrow(tidy(task), "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
