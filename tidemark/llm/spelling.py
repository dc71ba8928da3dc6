"""Spelling variants by a trie of letter-group counts.

A word's letters fall into groups, and a word is the vector of its counts per
group. Words one edit apart have nearly the same vector: one count higher at most
(a surplus) and one lower (a deficit). The trie arranges words by successive counts;
a search goes down it with a budget of one surplus and one deficit, and the words of
the leaves it reaches are compared letter by letter. The trie's first levels, over
coarse groups, are its subtrees in Spark: a word lives in one, and visits those its
budget reaches; the levels over fine groups are walked inside a subtree's task, depth
first and with all words that are searched there at once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import batch_of, documents, saved, ship, slices, utf8

LEAST_LETTERS = 6
LEAST_COUNT = 5
# A form stands at least so many times as often as its variant.
TIMES = 5
# A run loses a letter if this divides its hash.
DAMAGE = 199

# Letter groups, about equally frequent; all other letters are the last group.
GROUPS = ("aeiouy", "rnstl", "cdmphg")
# Groups are cut in two and in six. A subtree's key takes the first of these cuts with
# which no subtree owns more than SUBTREE words.
CUTS = (1, 2, 6)
SUBTREE = 20_000
# Words of a trie node that is not branched further, and letters compared at once.
LEAF = 24
BLOCK = 1 << 22
# Distinct words a task counts before it hands them on, and characters searched at once.
HELD = 200_000
PIECE = 1 << 20

COUNTED = pa.schema([("word", pa.string()), ("n", pa.int64())])
SENT = pa.schema([("subtree", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("guest", pa.bool_())])
PAIRS = pa.schema([("a", pa.string()), ("na", pa.int64()), ("b", pa.string()), ("nb", pa.int64())])
PAIRS_SQL = "a string, na bigint, b string, nb bigint"

_LETTERS = "[A-Za-zÀ-ÿ]"
_RUN = re.compile(_LETTERS + "{%d,}" % LEAST_LETTERS)
_GAP = re.compile("[^A-Za-zÀ-ÿ]")


# -- words -------------------------------------------------------------------------


def runs_of(text: str) -> Counter:
    """The runs of at least LEAST_LETTERS letters of a text and how often they stand there."""
    found: Counter = Counter()
    at = 0
    while at < len(text):
        stop = at + PIECE
        if stop < len(text):
            gap = _GAP.search(text, stop)
            stop = gap.start() if gap else len(text)
        found.update(_RUN.findall(text, at, stop))
        at = stop
    return found


def word_counts(docs: DataFrame, least_count: int = LEAST_COUNT, damage: int = DAMAGE) -> DataFrame:
    """word, n of rows (doc_id, text): the words that stand ``least_count`` times at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in slices(batches):
            data, ends = utf8(batch.column("text"))
            for key, a, b in zip(batch.column("doc_id").to_pylist(), ends[:-1], ends[1:]):
                # lower() of bytes changes A-Z only
                found = runs_of(data[a:b].tobytes().lower().decode("utf-8"))
                start = zlib.crc32(b"%s:" % (b"" if key is None else str(key).encode()))
                for word, times in found.items():
                    h = zlib.crc32(word.encode("utf-8"), start)
                    if h % damage == 0:
                        place = h % len(word)
                        word = word[:place] + word[place + 1 :]
                        if len(word) < LEAST_LETTERS:
                            continue
                    total[word] += times
                if len(total) > HELD:
                    yield batch_of(COUNTED, list(total), list(total.values()))
                    total.clear()
        if total:
            yield batch_of(COUNTED, list(total), list(total.values()))

    counted = docs.mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# -- the trie ----------------------------------------------------------------------


def _group(letter: str, cut: int) -> int:
    for i, some in enumerate(GROUPS):
        if letter in some:
            return i * cut + some.index(letter) % cut
    return len(GROUPS) * cut + ord(letter) % cut


_LETTER_CODES = (*range(0x61, 0x7B), *range(0xC0, 0x100))
_PLACES = {cut: {chr(c): _group(chr(c), cut) for c in _LETTER_CODES} for cut in CUTS}
_FINE = np.zeros(256, np.int64)
_FINE[list(_LETTER_CODES)] = [_group(chr(c), CUTS[-1]) for c in _LETTER_CODES]


def vector(word: str, cut: int) -> list[int]:
    """The word's letters per group."""
    counts, places = [0] * ((len(GROUPS) + 1) * cut), _PLACES[cut]
    for letter in word:
        counts[places[letter]] += 1
    return counts


def within_budget(counts: list[int]) -> Iterator[list[int]]:
    """Vectors that differ by a surplus and a deficit of one at most, the vector itself first."""
    yield counts
    for i in range(len(counts)):
        for step in (1, -1):
            if counts[i] + step >= 0:
                yield [*counts[:i], counts[i] + step, *counts[i + 1 :]]
    for i, j in combinations(range(len(counts)), 2):
        for step in (1, -1):
            if counts[i] + step >= 0 and counts[j] - step >= 0:
                other = list(counts)
                other[i] += step
                other[j] -= step
                yield other


class Words:
    """Words as letters: padded on the right and on the left, and their counts per fine group."""

    def __init__(self, words: list[str]) -> None:
        self.sizes = np.array([len(w) for w in words], np.int64)
        letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        owner = np.repeat(np.arange(len(words)), self.sizes)
        place = np.arange(len(letters)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        width = int(self.sizes.max(initial=0)) + 1
        groups = (len(GROUPS) + 1) * CUTS[-1]
        self.counts = np.bincount(owner * groups + _FINE[letters], minlength=len(words) * groups).reshape(-1, groups).astype(np.int16)
        self.left, self.right = np.zeros((2, len(words), width), np.uint8)
        self.left[owner, place] = letters
        self.right[owner, self.sizes[owner] - 1 - place] = letters

    def one_edit(self, asked: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of places that one inserted, deleted or replaced letter makes equal:
        what the words share from the left and from the right leaves one letter at most."""
        found = [(asked[:0], others[:0])]
        width = int(max(self.sizes[asked].max(initial=0), self.sizes[others].max(initial=0))) + 1
        step = max(1, BLOCK // max(1, len(others) * width))
        # No word has a 1: what is past a word's end differs from what is past the other's.
        left, right = (np.where(x[others, :width] == 0, 1, x[others, :width]) for x in (self.left, self.right))
        for at in range(0, len(asked), step):
            some = asked[at : at + step]
            size, other = self.sizes[some][:, None], self.sizes[others][None, :]
            head = (self.left[some, None, :width] == left[None]).argmin(axis=2)
            tail = (self.right[some, None, :width] == right[None]).argmin(axis=2)
            longer = np.maximum(size, other)
            near = (np.abs(size - other) <= 1) & (head + tail >= longer - 1) & (head < longer)
            x, y = np.nonzero(near)
            found.append((some[x], others[y]))
        return tuple(np.concatenate(part) for part in zip(*found))

    def near(self, own: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(asked, own) places of the words one edit apart, by depth-first search down the trie of ``own``."""
        found = [(asked[:0], own[:0])]
        full = np.ones(len(asked), bool)
        ahead = [(own, 0, asked, full, full)]
        while ahead:
            node, level, here, surplus, deficit = ahead.pop()
            if not len(here):
                continue
            if len(node) <= LEAF or level == self.counts.shape[1]:
                found.append(self.one_edit(here, node))
                continue
            counts, wanted = self.counts[node, level], self.counts[here, level]
            for count in np.unique(counts):
                more, less = wanted == count + 1, wanted == count - 1
                kept = (wanted == count) | (more & surplus) | (less & deficit)
                ahead.append((node[counts == count], level + 1, here[kept], (surplus & ~more)[kept], (deficit & ~less)[kept]))
        return tuple(np.concatenate(part) for part in zip(*found))


def _key(counts: list[int]) -> str:
    return " ".join(map(str, counts))


def _subtrees(cut: int, visits: bool):
    """Each word in its own subtree, and with ``visits`` as a guest in those of greater key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                rows: list[tuple[str, str, int, bool]] = []
                for word, n in zip(part.column("word").to_pylist(), part.column("n").to_pylist()):
                    counts = vector(word, cut)
                    rows.append((_key(counts), word, n, False))
                    if visits:
                        rows += [(_key(other), word, n, True) for other in within_budget(counts) if other > counts]
                yield batch_of(SENT, *zip(*rows))

    return run


def _meet(subtree: pa.Table) -> pa.Table:
    """The near pairs of one subtree: its own words among themselves and with its guests."""
    words = subtree.column("word").combine_chunks()
    guest = subtree.column("guest").to_numpy().astype(bool)
    own = np.flatnonzero(~guest)
    if not len(own):
        return PAIRS.empty_table()
    a, b = Words(words.to_pylist()).near(own, np.arange(len(words)))
    once = guest[a] | (a < b)
    a, b = a[once], b[once]
    n = subtree.column("n")
    return pa.table([words.take(a), n.take(a), words.take(b), n.take(b)], schema=PAIRS)


def near_words(words: DataFrame, subtree: int = SUBTREE) -> DataFrame:
    """a, na, b, nb: each pair of words (word, n) one edit apart, once."""
    sent = "subtree string, word string, n bigint, guest boolean"
    for cut in CUTS:
        owned = words.mapInArrow(_subtrees(cut, False), sent).groupBy("subtree").agg(F.count(F.lit(1)).alias("k"))
        if cut == CUTS[-1] or (owned.agg(F.max("k")).first()[0] or 0) <= subtree:
            break
    return words.mapInArrow(_subtrees(cut, True), sent).groupBy("subtree").applyInArrow(_meet, PAIRS_SQL)


# -- forms -------------------------------------------------------------------------


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int = DAMAGE, subtree: int = SUBTREE) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word.

    Words are longest runs of ASCII and Latin-1 letters with A-Z lowered, at least six letters
    that stand five times at least in all rows together. Where ``damage`` divides the crc32 of
    ``doc_id:run`` the run loses a letter first; a row without an id hashes ``:run``. A null or
    empty text has no words, repeated rows count each, no words give no rows. A word's form is its near word of
    largest n (ties: the smallest) if that stands TIMES times as often; root follows forms to
    the last one.
    """
    ship(docs.sparkSession)
    words = saved(word_counts(documents(docs, id_col, text_col), damage=damage), "spelling-words")
    pairs = saved(near_words(words, subtree), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("k")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("k"))
    )
    near = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("k")).alias("rank"), "other")).alias("best")
    )
    known = words.join(near, "word", "left")
    enough = -F.col("best.rank") >= TIMES * F.col("n")
    known = saved(
        known.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.rank")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(known)
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(known: DataFrame) -> DataFrame:
    """word, root of the words with a form. A form stands TIMES times as often, so chains
    are short; their length is halved by every round."""
    roots = known.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    most = known.agg(F.max("n")).first()[0] or 1
    longest, reach = 1, 1
    while LEAST_COUNT * TIMES**longest <= most:
        longest += 1
    while reach < longest:
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = saved(roots.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
        reach *= 2
    return roots


# The hash as SQL has it: one step per bit, a byte's value first. The near words of a word share
# a pattern of it with one letter masked, or are it less a letter.
ORACLE = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
  ) WHERE length(run) >= {LEAST_LETTERS} GROUP BY ALL
), hashed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      range(1, octet_length(encode(doc_id || ':' || run)) + 1),
      lambda i: list_prepend(('0x' || hex(encode(doc_id || ':' || run))[2 * i - 1 : 2 * i])::BIGINT, list_value(-1, -1, -1, -1, -1, -1, -1, -1))))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x::BIGINT) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) AS h
  FROM runs
), words AS (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT CASE WHEN h % {DAMAGE} = 0 THEN run[: (h % length(run))::INT] || run[(h % length(run))::INT + 2 :] ELSE run END AS word, times FROM hashed
  ) WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(times) >= {LEAST_COUNT}
), places AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words
), masked AS (
  SELECT word, n, i, word[: i - 1] AS a, word[i + 1 :] AS b FROM places
), pairs AS (
  SELECT x.word, y.word AS other, y.n AS k FROM masked x JOIN masked y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM masked x JOIN words y ON x.a || x.b = y.word
  UNION SELECT y.word, x.word, x.n FROM masked x JOIN words y ON x.a || x.b = y.word
), best AS (
  SELECT word, count(*) AS n_near, max(k) AS k, min(other) FILTER (k = most) AS other
  FROM (SELECT *, max(k) OVER (PARTITION BY word) AS most FROM pairs) GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN k >= {TIMES} * n THEN other END AS form, CASE WHEN k >= {TIMES} * n THEN k END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
), roots AS (
  SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""
