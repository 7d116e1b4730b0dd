"""Spelling variants by a bit-sliced position index.

The vocabulary holds, for each position and letter, a bitset of the words that
have the letter there. A word is looked up by walking its letters once: the set
of words that agree so far (no error) and the set of words that agree but for
one error are carried along together, the latter against the same position
(replaced), the next one (the other word has a letter more) or the one before
(a letter less). Each step is a few word-parallel operations on bitsets, for
all words of the index at once. Bits are in the order of falling counts, so the
lowest bit of the answer is the commonest variant and its bit count is their
number: pairs are never listed.

An index need not hold the whole vocabulary. Of two words that differ by one
error, with m letters in the shorter one, either the first m // 2 or the last
m // 2 letters are the same, so words meet by half and by their two lengths
only. A half that more than ``TILE`` words share is split, and its tiles meet
in pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import staged

RUN = r"[a-zÀ-ÿ]"  # after A-Z are lower-cased
SHORTEST = 7      # code points of a word at least
LEAST = 2         # occurrences of a word at least
DROP = 31         # a run whose hash this divides loses a letter
RATIO = 10        # a form occurs so many times as often at least
TILE = 32_768     # words of one index (expected)
HELD = 400_000    # words that a task counts before it hands them on
SALTS = 16
GROUP = ("cross", "least", "side", "half")


def count_words(doc_id: int | None, text: str, long_run: re.Pattern, shortest: int, counts: Counter) -> None:
    """Add the words of one text; a run that the rule picks loses one letter wherever it stands in the text."""
    # bytes.lower knows A-Z only.
    for run, n in Counter(long_run.findall(text.encode("utf-8", "replace").lower().decode())).items():
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
        if h % DROP == 0:
            if len(run) == shortest:
                continue
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        counts[run] += n


def vocabulary(docs: DataFrame, doc_id: str, text: str, shortest: int, least: int) -> DataFrame:
    """(word, n) of the whole corpus; tasks count before they shuffle."""
    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        long_run, counts = re.compile(f"{RUN}{{{shortest},}}"), Counter()

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

        for t in it:
            for i, text_ in zip(t.column("doc_id").to_pylist(), t.column("text"), strict=True):
                count_words(i, text_.as_py() or "", long_run, shortest, counts)
                if len(counts) >= HELD:
                    yield full()
                    counts.clear()
        yield full()

    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def halves(words: DataFrame, shortest: int) -> DataFrame:
    """Each word under the halves by which it can meet others, with the part that remains to be compared.

    ``cross`` 0 brings words of ``least`` letters together, ``cross`` 1 those
    of ``least`` and of ``least`` + 1; ``side`` 0 shares the first half, 1 the last.
    """
    size = F.length("word")
    rows = []
    for cross, low, least in ((0, None, size), (1, None, size), (1, shortest, size - 1)):
        for side in (0, 1):
            row = F.struct(F.lit(cross).alias("cross"), least.alias("least"), F.lit(side).alias("side"))
            rows.append(row if low is None else F.when(least >= low, row))
    meet = words.select("word", "n", F.explode(F.array(*rows)).alias("g")).filter("g is not null").select("word", "n", "g.*")
    cut = F.floor(F.col("least") / 2).cast("int")
    return meet.withColumn("half", F.when(F.col("side") == 0, F.left("word", cut)).otherwise(F.right("word", cut)))


def tiled(rows: DataFrame, tile: int) -> DataFrame:
    """``rows`` dealt to (i, q): index tile and query tile; ``role`` 0 both, 1 index, 2 query."""
    big = staged(rows.groupBy(*GROUP).agg(F.count("*").alias("size")).filter(F.col("size") > tile)
                 .select(*GROUP, F.ceil(F.col("size") / tile).cast("int").alias("tiles")), "spelling-tiles")
    # As salted copies, so that a half that a third of all words share is read by many tasks.
    salted = big.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int")).join(salted, [*GROUP, "salt"], "left")
    mine = F.pmod(F.xxhash64(F.lit("tile"), "word"), F.col("tiles")).cast("int")
    places = F.when(F.col("tiles").isNull(), F.expr("array(named_struct('i', 0, 'q', 0, 'role', 0))")).otherwise(
        F.flatten(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda o: F.array(
            F.struct(mine.alias("i"), o.cast("int").alias("q"), F.lit(1).alias("role")),
            F.struct(o.cast("int").alias("i"), mine.alias("q"), F.lit(2).alias("role"))))))
    return dealt.select(*GROUP, "word", "n", F.explode(places).alias("p")).select(*GROUP, "word", "n", "p.*")


def sliced(words: list[str]) -> dict[tuple[int, str], int]:
    """For each (position, letter), the words that have it there, as the bits of one number."""
    members: dict[tuple[int, str], list[int]] = {}
    for b, w in enumerate(words):
        for at in enumerate(w):
            members.setdefault(at, []).append(b)
    if len(words) <= 64:
        return {at: sum(1 << b for b in bits) for at, bits in members.items()}
    out = {}
    for at, bits in members.items():
        flags = bytearray((len(words) + 7) // 8)
        for b in bits:
            flags[b >> 3] |= 1 << (b & 7)
        out[at] = int.from_bytes(flags, "little")
    return out


def one_error(index: dict[tuple[int, str], int], every: int, word: str, shift: int, head: int) -> tuple[int, int]:
    """(words one error from ``word``, words with its first ``head`` letters), as bits.

    The index holds words of len(word) + ``shift`` letters: for 0 a letter is
    replaced, for 1 they have one more, for -1 one less.
    """
    zero, one, same = every, every if shift == 1 else 0, every
    for j, c in enumerate(word):
        here = index.get((j, c), 0)
        if shift == 0:
            one = one & here | zero & ~here
            zero &= here
        elif shift == 1:
            zero &= here
            one = one & index.get((j + 1, c), 0) | zero
        else:
            one = one & index.get((j - 1, c), 0) | zero
            zero &= here
        if j + 1 == head:
            same = zero
        if not one and not zero:
            return 0, 0
    return one, same


def _answers(group: tuple, rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, str, int]]:
    """(word, number of variants, commonest variant, its n) of the group's query words."""
    cross, least, side, _ = group[:4]
    head = least // 2
    rest = (lambda w: w[head:]) if side == 0 else (lambda w: w[:-head])
    for size, shift in ((least, 0),) if not cross else ((least, 1), (least + 1, -1)):
        asked = [w for w, _, role in rows if role != 1 and len(w) == size]
        known = sorted(((-n, w) for w, n, role in rows if role != 2 and len(w) == size + shift))
        if not asked or not known:
            continue
        index, every = sliced([rest(w) for _, w in known]), (1 << len(known)) - 1
        for w in asked:
            near, same = one_error(index, every, rest(w), shift, head if side else 0)
            if side:  # what shares the first half too was found there
                near &= ~same
            if near:
                n, best = known[(near & -near).bit_length() - 1]
                yield w, near.bit_count(), best, -n


def _look_up(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups arrive sorted; one may go on in the next batch."""
    def out(found: list) -> pa.RecordBatch:
        cols = list(zip(*found, strict=True)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)],
                                          ["word", "n_near", "form", "form_n"])

    at, rows, found = None, [], []
    for t in it:
        for *group, word, n, role in zip(*(t.column(c).to_pylist() for c in (*GROUP, "i", "q", "word", "n", "role")), strict=True):
            if group != at:
                if len(rows) > 1:
                    found.extend(_answers(at, rows))
                at, rows = group, []
            rows.append((word, n, role))
        if len(found) > 10_000:
            yield out(found)
            found = []
    if len(rows) > 1:
        found.extend(_answers(at, rows))
    yield out(found)


def near_words(words: DataFrame, shortest: int = SHORTEST, tile: int = TILE) -> DataFrame:
    """(word, n_near, best_n, best): for words that have one, the number of near words and the commonest of them."""
    dealt = tiled(halves(words, shortest), tile)
    found = (dealt.repartition(*GROUP, "i", "q").sortWithinPartitions(*GROUP, "i", "q")
             .mapInArrow(_look_up, "word string, n_near long, form string, form_n long"))
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("b"))
    return best.select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.form").alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """(word, root): where the forms of ``links`` (word, form) lead; every round doubles the steps taken.

    A form's count is several times its word's, so there are few rounds. Only
    words that are a form and have one move a root on; these few meet the
    rest by salt, so that a form of very many words is no task's work alone.
    """
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        on = on.join(links.select("root").distinct(), "root", "left_semi")
        on = staged(on.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), "spelling-steps")
        if on.isEmpty():
            return links
        salt = F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int")
        links = staged(links.withColumn("salt", salt).join(on, ["root", "salt"], "left")
                       .select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = SHORTEST, least: int = LEAST, ratio: int = RATIO,
             tile: int = TILE) -> DataFrame:
    """One row for each word of the corpus: word, form, root, n, n_near, form_n.

    Words are runs of Latin letters of ``shortest`` code points or more that
    occur ``least`` times or more; a null doc_id counts as an empty one in the
    rule that drops letters. A word's form is its commonest near word, of
    equals the first in code-point order, if that occurs ``ratio`` times as
    often at least, else null; the root is where forms lead in the end. Null
    and empty texts have no words; repeated rows count as often as they stand
    there. An empty table gives an empty result. Columns beside the two named
    are not read.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1: forms lead to ever commoner words")
    words = staged(vocabulary(docs, doc_id, text, shortest, least), "spelling-words")
    near = near_words(words, shortest, tile)
    form = F.col("best_n") >= ratio * F.col("n")
    rows = staged(words.join(near, "word", "left").select(
        "word", F.when(form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(form, F.col("best_n")).alias("form_n")), "spelling-forms")
    roots = _roots(rows.filter("form is not null").select("word", F.col("form").alias("root")))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
