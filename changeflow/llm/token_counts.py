"""Token counts of texts of any length, by overlapping chunks that are spliced.

A huge text is cut into chunks that read ``OVERLAP`` code points of the next
one, and the chunks are encoded apart from each other, with offsets. Where the
words of two neighbours (the pieces that the tokenizer's pattern cuts before it
merges bytes) begin at the same place of the overlap, the whole text has a word
begin there too: the pattern reads forward only, so from a common beginning on
both chunks go through the same words as the whole text does. A beginning near
a chunk's end is not used, for the pattern looks ahead by at most a contraction
and a special token could be cut there (``settled``). The text's tokens are
then each chunk's tokens between its splices.

Chunks without a common beginning (a word longer than the overlap) have their
overlap widened to the whole neighbour: they are encoded again as one, until
all neighbours meet. Texts of up to ``CHUNK`` code points are encoded whole, and
so is every text if the tokenizer has a pattern for which this isn't proven.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import staged
from changeflow.llm.packing import Encoder

CHUNK = 65_536  # code points from one chunk to the next; longer texts are huge
OVERLAP = 512   # code points of the next chunk that each chunk reads
LIMIT = 1024    # tokens above which a text is over the limit
CONTRACTION = 4  # code points that the pattern looks ahead at most, and one more
ENCODED = "key string, first int, last int, total long, head_at array<long>, head_n array<long>, tail_at array<long>, tail_n array<long>"


@lru_cache(maxsize=1)
def _encoder(path: str, ranks: str | None) -> Encoder:
    """One for each Python worker."""
    return Encoder(path, ranks)


def splices(path: str) -> bool:
    """Whether the file's tokenizer is one for which splicing is proven: the byte-level pattern, nothing added or changed before it."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    before = spec.get("pre_tokenizer") or {}
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in spec.get("added_tokens", ()))
    return before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and spec.get("normalizer") is None and plain


def word_starts(tokenizer, text: str) -> tuple[int, list[tuple[int, int]]]:
    """Tokens of ``text``, and for each of its words (code point where it begins, tokens before it)."""
    got = tokenizer.encode(text, add_special_tokens=False)
    starts, last = [], None
    for n, (word, (at, _)) in enumerate(zip(got.word_ids, got.offsets, strict=True)):
        if word != last:
            starts.append((at, n))
            last = word
    return len(got.ids), starts


def settled(tokenizer) -> int:
    """Code points before a chunk's end in which a word's beginning may be another one in the whole text."""
    special = [len(t.content) for t in tokenizer.get_added_tokens_decoder().values()]
    return max([0, *special]) + CONTRACTION


def _counted(docs: DataFrame, path: str, ranks: str | None, chunk: int | None, overlap: int) -> DataFrame:
    """Short texts with their counts; huge ones as chunks: ``own`` is the chunk's part, ``ahead`` what it reads of the next."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, ranks)
        for t in it:
            sizes = pc.fill_null(pc.binary_length(t.column("text")), 0).cast(pa.int64())
            counts, huge = [], []
            for i, text in enumerate(t.column("text")):
                text = text.as_py() or ""
                if chunk is not None and len(text) > chunk:
                    huge.append(i)
                    counts.append(None)
                else:
                    counts.append(len(encoder(text)) // 4)
            whole = [i for i, n in enumerate(counts) if n is not None]
            none = pa.nulls(len(whole), pa.string())
            yield pa.RecordBatch.from_arrays(
                [t.column("doc_id").take(pa.array(whole, pa.int64())), sizes.take(pa.array(whole, pa.int64())),
                 pa.array([counts[i] for i in whole], pa.int64()), none, pa.nulls(len(whole), pa.int32()), none, none], names)
            for i in huge:
                text, key = t.column("text")[i].as_py(), uuid.uuid4().hex
                for piece, at in enumerate(range(0, len(text), chunk)):
                    yield pa.RecordBatch.from_arrays(
                        [t.column("doc_id").slice(i, 1), sizes.slice(i, 1), pa.nulls(1, pa.int64()), pa.array([key]), pa.array([piece], pa.int32()),
                         pa.array([text[at:at + chunk]]), pa.array([text[at + chunk:at + chunk + overlap]])], names)

    names = ["doc_id", "n_bytes", "n_tokens", "key", "piece", "own", "ahead"]
    return docs.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_tokens long, key string, piece int, own string, ahead string")


def _encoded(chunks: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """Chunks (key, first, last, own, ahead) as tokens and the words that begin in the overlaps at either end."""
    def encode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _encoder(path, None).tokenizer
        margin = settled(tokenizer)
        for t in it:
            cols: list[list] = [[], [], [], [], []]
            for first, own, ahead in zip(t.column("first").to_pylist(), t.column("own"), t.column("ahead"), strict=True):
                own, ahead = own.as_py(), ahead.as_py()
                total, starts = word_starts(tokenizer, own + ahead)
                start, sure = first * chunk, len(own) + len(ahead) - margin
                head = [(start + a, n) for a, n in starts if first and a <= overlap]
                tail = [(start + a, n) for a, n in starts if ahead and len(own) <= a <= sure]
                for c, v in zip(cols, (total, [a for a, _ in head], [n for _, n in head], [a for a, _ in tail], [n for _, n in tail]), strict=True):
                    c.append(v)
            kinds = [pa.int64(), *[pa.list_(pa.int64())] * 4]
            yield pa.RecordBatch.from_arrays([t.column("key"), t.column("first"), t.column("last"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
                                             ["key", "first", "last", "total", "head_at", "head_n", "tail_at", "tail_n"])

    return chunks.select("key", "first", "last", "own", "ahead").mapInArrow(encode, ENCODED)


def _seams(encoded: DataFrame) -> DataFrame:
    """(key, first, extra) for each chunk with one before it: the tokens that both count, null where no words begin together."""
    before = encoded.select("key", (F.col("last") + 1).alias("first"), F.col("total").alias("all"), F.col("tail_at").alias("at"), F.col("tail_n").alias("n"))
    common = F.get(F.array_intersect("at", "head_at"), 0)
    tokens = lambda at, n: F.element_at(n, F.array_position(at, F.col("p")).cast("int"))
    return (before.join(encoded.select("key", "first", "head_at", "head_n"), ["key", "first"])
            .withColumn("p", common)
            .select("key", "first", F.when(F.col("p").isNotNull(), F.col("all") - tokens(F.col("at"), F.col("n"))
                                           + tokens(F.col("head_at"), F.col("head_n"))).alias("extra")))


def _widened(encoded: DataFrame, seams: DataFrame, chunks: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """``encoded`` with neighbours that did not meet encoded as one; the rows of one text are few and small."""
    w = Window.partitionBy("key").orderBy("first")
    apart = F.col("extra").isNotNull() | (F.col("first") == 0)
    runs = (encoded.select("key", "first", "last").join(seams, ["key", "first"], "left")
            .withColumn("run", F.max(F.when(apart, F.col("first"))).over(w)))
    spans = runs.groupBy("key", "run").agg(F.max("last").alias("last"), F.count("*").alias("n")).filter("n > 1").select("key", F.col("run").alias("first"), "last")
    parts = spans.select("key", "first", "last", F.explode(F.sequence("first", "last")).alias("piece")).join(chunks.select("key", "piece", "own", "ahead"), ["key", "piece"])
    wide = parts.groupBy("key", "first", "last").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "own"))), lambda x: x["own"]), "").alias("own"),
        F.max_by("ahead", "piece").alias("ahead"))
    gone = runs.join(spans.select("key", F.col("first").alias("run")), ["key", "run"], "left_semi").select("key", "first")
    return encoded.join(gone, ["key", "first"], "left_anti").select(*encoded.columns).unionByName(_encoded(wide, path, chunk, overlap))


def count_tokens(docs: DataFrame, path: str, ranks: str | None = None, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).

    Tokens are those of ``Tokenizer.encode(text, add_special_tokens=False)``
    for the file at ``path``; a special token's string inside a text is that
    token. ``ranks`` names the same vocabulary for the faster encoder
    (``packing.Encoder``), which short Western texts take. Null and empty texts
    have no bytes and no tokens. Repeated rows give repeated rows, a null doc_id
    stays null, an empty table gives an empty one. Columns beside the two named
    are not read.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = staged(_counted(own, path, ranks, chunk if splices(path) else None, overlap), "token-chunks")
    short = rows.filter("key is null").select("doc_id", "n_bytes", "n_tokens")
    chunks = rows.filter("key is not null")
    if not chunks.isEmpty():
        encoded = staged(_encoded(chunks.withColumns({"first": F.col("piece"), "last": F.col("piece")}), path, chunk, overlap), "token-words")
        seams = staged(_seams(encoded), "token-seams")
        while not seams.filter("extra is null").isEmpty():
            encoded = staged(_widened(encoded, seams, chunks, path, chunk, overlap), "token-words")
            seams = staged(_seams(encoded), "token-seams")
        parts = encoded.select("key", F.col("total").alias("n")).unionByName(seams.select("key", (-F.col("extra")).alias("n")))
        summed = parts.groupBy("key").agg(F.sum("n").alias("n_tokens"))
        short = short.unionByName(chunks.filter("piece = 0").select("doc_id", "n_bytes", "key").join(summed, "key").drop("key"))
    return short.withColumn("over_limit", F.col("n_tokens") > limit)
