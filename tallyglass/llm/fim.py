"""Fill-in-the-middle: documents cut into prefix, middle and suffix at units of text, and put in another order.

A unit is a run of ASCII letters or one other code point. Cuts are given as ranks
of units, so a rank has to be turned into a place in the text. One Aho-Corasick
automaton scans each text once for its events: places where the class changes
from letter to other or back, and the sentinels. Between two events nothing
changes, so a gap of letters is one unit and a gap of other code points has as many
units as code points: the events with the units before each are all that a
rank lookup needs (a search among them and a subtraction).

The automaton reads one symbol for each code point: bytes that continue a code
point are left out, letters that no sentinel has are one symbol, and so are all
others that no sentinel has. So its patterns are the pairs of a letter's and
another's symbol, both ways, and the sentinels themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Of a hundred texts, how many are transformed, and how many of these put the suffix first.
RATE, SUFFIX_FIRST = 90, 20
#: Names the draw; another gives other cuts.
SEED = 1

_LETTERS = bytes([*range(65, 91), *range(97, 123)])
_CONTINUE = bytes(range(0x80, 0xC0))
_CHANGE, _SENTINEL = 0, 1


class Scanner:
    """The automaton and the table of symbols for some sentinels of ASCII characters."""

    def __init__(self, sentinels: tuple[str, ...] = SENTINELS):
        own = set("".join(sentinels).encode("ascii"))
        letter, other = (next(c for c in x if c not in own) for x in (_LETTERS, range(128)))
        self.table = bytes(c if c in own else letter if c in _LETTERS else other for c in range(256))
        letters = {chr(c) for c in own if c in _LETTERS} | {chr(letter)}
        others = {chr(c) for c in own if c not in _LETTERS} | {chr(other)}
        self.letters = frozenset(letters)
        self.automaton = ahocorasick.Automaton()
        for a in letters:
            for b in others:
                self.automaton.add_word(a + b, _CHANGE)
                self.automaton.add_word(b + a, _CHANGE)
        for s in sentinels:
            self.automaton.add_word(s, _SENTINEL)
        self.automaton.make_automaton()

    def scan(self, text: bytes) -> Events:
        """The events of a text in UTF-8."""
        symbols = text.translate(self.table, _CONTINUE).decode("ascii")
        found = np.fromiter((2 * at + kind for at, kind in self.automaton.iter(symbols)), np.int64)
        changes = found[found & 1 == _CHANGE] >> 1
        return Events(len(symbols), changes, symbols[:1] in self.letters, len(changes) < len(found))


class Events:
    """Code points of a text, where its class changes, what it starts with, and whether it has a sentinel."""

    def __init__(self, length: int, changes: np.ndarray, letters_first: bool, has_sentinel: bool):
        self.length, self.has_sentinel, self.letters_first = length, has_sentinel, letters_first
        self.at = np.concatenate([[0], changes, [length]])  # gaps are between neighbours
        gaps = np.diff(self.at)
        gaps[0 if letters_first else 1 :: 2] = gaps[0 if letters_first else 1 :: 2] > 0  # letters: one unit
        self.before = np.concatenate([[0], np.cumsum(gaps)])

    @property
    def units(self) -> int:
        return int(self.before[-1])

    def place(self, rank: int) -> int:
        """The code points that the first ``rank`` units have."""
        gap = min(int(np.searchsorted(self.before, rank, "right")) - 1, len(self.at) - 2)
        if (gap % 2 == 0) == self.letters_first:  # a gap of letters is before or after the cut as a whole
            return int(self.at[gap + (rank > self.before[gap])])
        return int(self.at[gap] + rank - self.before[gap])


def draws(name: str, seed: int = SEED) -> list[int]:
    """Four numbers for a document: the groups of eight digits of the hex SHA-256 of ``seed:name``."""
    digits = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def form_of(empty: bool, has_sentinel: bool, h3: int, h4: int, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> str:
    """``plain``, ``psm`` or ``spm``."""
    if empty or has_sentinel or h3 % 100 >= rate:
        return "plain"
    return "spm" if h4 % 100 < suffix_first else "psm"


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row of ``docs``.

    ``n`` counts the units of the whole text. Both cuts are drawn from 0 to n; the
    prefix ends after the lesser, the middle after the greater. Output is the
    text itself (plain: empty texts, those with a sentinel, and a share of the
    others), or the parts behind their sentinels: prefix, suffix, middle (psm) or
    suffix, prefix, middle (spm). A null text is an empty one; a null doc_id draws
    as the empty name. Repeated rows give repeated results, other columns are
    ignored, no rows give no rows. A text is taken whole, whatever its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        p, s, m = (x.encode() for x in SENTINELS)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or b""
                events = scanner.scan(text)
                h1, h2, h3, h4 = draws("" if doc is None else str(doc), seed)
                form = form_of(not text, events.has_sentinel, h3, h4, rate, suffix_first)
                if form == "plain":
                    rows.append((events.units, form, None, None, text))
                    continue
                a, b = (events.place(r) for r in sorted((h1 % (events.units + 1), h2 % (events.units + 1))))
                if len(text) == events.length:  # ASCII: code points are bytes
                    prefix, middle, suffix = text[:a], text[a:b], text[b:]
                else:
                    whole = text.decode("utf-8", "surrogatepass")
                    prefix, middle, suffix = (x.encode("utf-8", "surrogatepass") for x in (whole[:a], whole[a:b], whole[b:]))
                output = (s, suffix, p, prefix, m, middle) if form == "spm" else (p, prefix, s, suffix, m, middle)
                rows.append((events.units, form, a, b - a, b"".join(output)))
            n, forms, a, b, out = zip(*rows) if rows else ((),) * 5
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    found = rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary")
    return found.withColumn("output", F.col("output").cast("string"))


def restored(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The text that ``transform`` made ``output`` from.

    Parts of a text have no sentinel, and none can arise where a part meets one, so
    the first of each kind behind the leading one is the one that was put there.
    """
    output, form = (F.col(x) if isinstance(x, str) else x for x in (output, form))
    parts = F.split(output, "|".join(SENTINELS), 4)  # the empty one before the first sentinel, then three parts
    first, second, middle = parts[1], parts[2], parts[3]
    return F.when(form == "psm", F.concat(first, middle, second)).when(form == "spm", F.concat(second, middle, first)).otherwise(output)


def op12_fim(spark, sf_dir: str) -> DataFrame:
    """Every document transformed and rebuilt, as digests."""
    out = transform(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
  [('0x' || substr(h, 8 * i + 1, 8))::BIGINT for i in [0, 1, 2, 3]] AS draw FROM d),
c AS (SELECT *, len(units) AS n, least(draw[1] % (len(units) + 1), draw[2] % (len(units) + 1)) AS a,
  greatest(draw[1] % (len(units) + 1), draw[2] % (len(units) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR draw[3] % 100 >= 90 THEN 'plain'
    WHEN draw[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS prefix, coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
  coalesce(array_to_string(units[b + 1:n], ''), '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p
"""
