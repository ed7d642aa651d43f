"""Phrases found in a text by their rarest three letters.

A table of phrases travels as one constant inside the plan, grouped by a checksum of one group of
three characters that each phrase contains, the one that fewest phrases have. A text looks up its
own groups of three and tests only the phrases behind them, so the cost of a row follows the
length of its text and hardly the number of phrases. Phrases of one or two characters have no
such group and are tested on every row, and so are all phrases of a table of up to ``SCAN``
entries, where that takes less time than the look-ups; the result is the same.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import let

# Zero-width matches, one at every character.
GRAMS = r"(?s)(?=(...))"
# The look-ups cost a row about as much as the tests of some hundred phrases.
SCAN = 200


def grams(text: str) -> set[str]:
    return {text[i:i + 3] for i in range(len(text) - 2)}


class PhraseIndex:
    """``entries``: dicts with ``phrase`` and whatever ``schema`` (a DDL struct) names besides.

    ``found`` gives, of a text, the array of the entries whose phrase is in it, in no fixed order.
    An empty phrase is in every text. Entries may repeat a phrase.
    """

    def __init__(self, entries: list[dict], schema: str):
        self.schema = schema
        common = Counter(g for e in entries for g in grams(e["phrase"]))
        size = 1
        while size < 2 * len(entries):
            size *= 2
        self.size = size
        self.always: list[dict] = []
        self.buckets: list[list[dict]] = [[] for _ in range(size)]
        for e in entries:
            rarest = min(grams(e["phrase"]) if len(entries) > SCAN else (), key=lambda g: (common[g], g), default=None)
            if rarest is None:
                self.always.append(e)
            else:
                self.buckets[zlib.crc32(rarest.encode()) % size].append(e)

    def found(self, text: Column) -> Column:
        """``text`` as the phrases are written: index phrases in lower case for texts in lower case."""
        table = F.from_json(F.lit(json.dumps(self.buckets)), f"array<array<{self.schema}>>")
        always = F.from_json(F.lit(json.dumps(self.always)), f"array<{self.schema}>")
        if not any(self.buckets):
            return let(text, lambda t: F.when(t.isNotNull(), F.filter(always, lambda e: F.contains(t, e["phrase"]))))

        def look(t):
            own = F.array_distinct(F.regexp_extract_all(t, F.lit(GRAMS), F.lit(1)))
            near = F.flatten(F.transform(own, lambda g: F.element_at(table, (F.crc32(g) % self.size + 1).cast("int"))))
            if self.always:
                near = F.concat(always, near)
            # Two groups of three may share a bucket and offer its phrases twice.
            return F.array_distinct(F.filter(near, lambda e: F.contains(t, e["phrase"])))

        return let(text, look)
