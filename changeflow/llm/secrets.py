"""Secret scans through a trigram inverted index.

Each rule's regex is turned into a Boolean query over trigrams: alternatives
(OR) of sets of trigrams (AND) that every match must contain, ASCII letters
lower-cased. The index holds a posting for each document and each trigram that
some rule asks for; intersecting the postings of an alternative gives the
rule's candidates, and only those texts are read by the rule's regex. A rule
whose regex makes no trigram mandatory (a run of hex digits, say) scans all
texts.

Everything runs as DataFrame operations; a text travels only if it is a
candidate's.
"""

from __future__ import annotations

import re._constants as ops
import re._parser as parser
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import fresh, staged
from changeflow.llm.spans import SPAN, as_spans, found, listed, merged, number_of, replaced

MAX_WORDS = 64  # literal alternatives that a regex part is expanded into before it counts as anything


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``pattern`` is what a match looks like (in the syntax that Java, RE2 and Python share) and what
    trigrams are derived from; ``java`` the same language in a form that never backtracks far. A match counts if its
    ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    java: str = ""
    group: int = 0
    least: int = 0
    base: bool = False
    case: bool = True

    @property
    def matcher(self) -> str:
        return self.java or self.pattern


_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

# The base kinds, in their order.
BASE = (
    Rule("assign", _ASSIGN, _ASSIGN.replace(r"\x20*", r"\x20*+").replace("-]+)", "-]++)"), group=1, least=6, base=True),
    Rule("access", "AKIA[A-Z0-9]{16,}", "AKIA[A-Z0-9]{16,}+", base=True),
    Rule("hex", "[0-9a-f]{24,}", "(?<![0-9a-f])[0-9a-f]{24,}+", base=True),
)

# What the method adds: tokens with a fixed prefix, keys in armour, and passwords in addresses.
ADDED = (
    Rule("private_key", "-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----"),
    Rule("forge_token", "gh[pousr]_[A-Za-z0-9]{36,}", "gh[pousr]_[A-Za-z0-9]{36,}+"),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]{10,}", "xox[abprs]-[A-Za-z0-9-]{10,}+"),
    Rule("cloud_key", "AIza[A-Za-z0-9_-]{35,}", "AIza[A-Za-z0-9_-]{35,}+"),
    Rule("payment_key", "(?:sk|rk)_live_[A-Za-z0-9]{16,}", "(?:sk|rk)_live_[A-Za-z0-9]{16,}+"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
         r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    Rule("address_password", "(?:https?|ftp|postgres|mysql|redis|amqp)://[A-Za-z0-9._-]{1,64}:[A-Za-z0-9._-]{4,64}@"),
)
RULES = (*BASE, *ADDED)


@dataclass
class _Part:
    """What a piece of a regex can be: all its strings (None: too many), and the trigram alternatives it makes mandatory."""

    words: list[str] | None
    query: list[frozenset[str]] = field(default_factory=lambda: [frozenset()])


def _trigrams(word: str) -> frozenset[str]:
    return frozenset(word[i:i + 3] for i in range(len(word) - 2))


def _settle(p: _Part) -> list[frozenset[str]]:
    """The part's query, with its words' trigrams taken in."""
    if p.words is None:
        return p.query
    return [q | _trigrams(w) for w in p.words for q in p.query]


def _then(a: _Part, b: _Part) -> _Part:
    if a.words is not None and b.words is not None and len(a.words) * len(b.words) <= MAX_WORDS:
        return _Part([x + y for x in a.words for y in b.words], [p | q for p in a.query for q in b.query])
    return _Part(None, [p | q for p in _settle(a) for q in _settle(b)])


def _part(tokens) -> _Part:
    """Parts in a row: known strings grow as long as they stay few, and what they are then becomes mandatory."""
    whole, run = [frozenset()], _Part([""])
    for op, arg in tokens:
        one = _token(op, arg)
        joined = _then(run, one)
        if joined.words is not None:
            run = joined
        else:
            whole = [p | q for p in whole for q in _settle(run)]
            run = one if one.words is not None else _Part([""])
            if one.words is None:
                whole = [p | q for p in whole for q in one.query]
    if whole == [frozenset()]:
        return run
    return _Part(None, [p | q for p in whole for q in _settle(run)])


def _token(op, arg) -> _Part:
    if op is ops.LITERAL:
        return _Part([chr(arg).lower()])
    if op is ops.IN:
        chars: set[str] = set()
        for kind, x in arg:
            if kind is ops.LITERAL:
                chars.add(chr(x).lower())
            elif kind is ops.RANGE and x[1] - x[0] < 8:
                chars.update(chr(c).lower() for c in range(x[0], x[1] + 1))
            else:
                return _Part(None)
        return _Part(sorted(chars)) if len(chars) <= 8 else _Part(None)
    if op is ops.SUBPATTERN:
        return _part(arg[-1])
    if op is ops.BRANCH:
        each = [_part(x) for x in arg[1]]
        if all(p.words is not None for p in each):
            return _Part([w for p in each for w in p.words], [frozenset()])
        return _Part(None, [q for p in each for q in _settle(p)])
    if op in (ops.MAX_REPEAT, ops.MIN_REPEAT, ops.POSSESSIVE_REPEAT):
        low, high, inner = arg
        one = _part(inner)
        if low == high == 1:
            return one
        if low == 0:
            return _Part(["", *one.words]) if high == 1 and one.words is not None else _Part(None)
        return _Part(None, _settle(one))
    return _Part(None)


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of mandatory trigrams, lower case, the smallest ones only; an empty list if there is no mandatory one."""
    query = set(_settle(_part(parser.parse(pattern))))
    least = [q for q in query if not any(p < q for p in query)]
    return [] if frozenset() in least else sorted(least, key=sorted)


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc, hash): the index, restricted to trigrams that some rule asks for."""
    low = docs.select("doc", "hash", F.lower("text").alias("low"))
    there = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select("doc", "hash", F.explode(there).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame | None:
    """(doc, hash, kinds): the rules whose query a text meets; None if no rule has a query."""
    asked = [(r.kind, f"{r.kind}/{i}", t, len(q)) for r in rules for i, q in enumerate(trigram_query(r.pattern)) for t in q]
    if not asked:
        return None
    spark = docs.sparkSession
    # As many rows as the rules have trigrams, whatever the corpus.
    terms = F.broadcast(spark.createDataFrame(asked, "kind string, alternative string, trigram string, needed int"))
    met = (postings(docs, sorted({a[2] for a in asked})).join(terms, "trigram")
           .groupBy("doc", "hash", "kind", "alternative", "needed").agg(F.count_distinct("trigram").alias("n"))
           .filter("n = needed"))
    return met.groupBy("doc", "hash").agg(F.collect_set("kind").alias("kinds"))


def _found(rule: Rule, rank: int) -> Column:
    valid = (lambda x: F.length(x["part"]) >= rule.least) if rule.least else None
    return as_spans(found("text", rule.matcher, rule.group or None), rule.kind, rank, valid)


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc, hash, spans): one row for each distinct (doc_id, text) of ``docs``.

    Spans are (start, rank, end, kind), sorted. Null and empty texts have none.
    """
    own = docs.select(F.col(doc_id).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    ranks = {r.kind: i for i, r in enumerate(rules)}
    indexed = [r for r in rules if trigram_query(r.pattern)]
    scanned = [r for r in rules if not trigram_query(r.pattern)]
    none = F.array().cast(SPAN)
    full = own.select("doc", "hash", F.concat(none, *[_found(r, ranks[r.kind]) for r in scanned]).alias("spans"))
    full = full.filter(F.size("spans") > 0)
    chosen = candidates(own, tuple(indexed))
    if chosen is not None:
        chosen = staged(chosen, "candidates").withColumnsRenamed({"doc": "doc2", "hash": "hash2"})
        read = own.join(chosen, own["doc"].eqNullSafe(chosen["doc2"]) & (own["hash"] == chosen["hash2"]))
        each = [F.when(F.array_contains("kinds", r.kind), _found(r, ranks[r.kind])).otherwise(none) for r in indexed]
        full = full.unionByName(read.select("doc", "hash", F.concat(*each).alias("spans")))
    # Repeated rows find the same spans; they count once.
    return (full.select("doc", "hash", F.explode("spans").alias("s")).distinct()
            .groupBy("doc", "hash").agg(F.collect_list("s").alias("spans"))
            .select("doc", "hash", merged(F.col("spans")).alias("spans")))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans): one row for each row of ``docs``; a row without secrets has an empty array.

    Repeated rows repeat; a null doc_id is a value like any other. An empty
    table gives an empty one. Other columns are not read.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"))
    got = secret_spans(docs, doc_id, text, rules)
    both = own.join(got, own["doc_id"].eqNullSafe(got["doc"]) & (own["h"] == got["hash"]), "left")
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    return both.select("doc_id", F.coalesce("spans", none).alias("spans"))


def digest(scanned: DataFrame, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """The counts, the hash of the base spans and the list of all."""
    kinds = [r.kind for r in base]
    own = F.filter("spans", lambda x: x["kind"].isin(kinds))
    return scanned.select("doc_id", *[number_of(F.col("spans"), k).alias(f"n_{k}") for k in kinds],
                          F.sha2(listed(own), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every secret replaced by its kind in brackets, and ``n_chars`` set anew where text changed.

    Rows and columns stay; a null text stays null.
    """
    doc, hashed, spans = fresh(docs, "doc", "hash", "spans")
    # Written, so that Spark knows their size before the join: while it is small, no text travels.
    got = staged(secret_spans(docs, doc_id, text, rules).toDF(doc, hashed, spans), "secret-spans")
    here = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    both = docs.join(got, docs[doc_id].eqNullSafe(got[doc]) & (here == got[hashed]), "left")
    new = F.when(F.col(spans).isNotNull(), replaced(F.col(text), F.col(spans), lambda x: F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))).otherwise(F.col(text))
    out = both.withColumn(text, new)
    if n_chars:
        out = out.withColumn(n_chars, F.when(F.col(spans).isNotNull(), F.length(text).cast(docs.schema[n_chars].dataType)).otherwise(F.col(n_chars)))
    return out.select(*docs.columns)
