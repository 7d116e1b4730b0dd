"""Personal data by patterns, and what gives it away by information theory.

Patterns find addresses, numbers and the like: the protected entities. Words
that stand in the same text can reveal an entity even when it is masked itself.
How much a term t tells about an entity e is estimated from the corpus, over
its different texts: their pointwise mutual information,

    PMI(e; t) = log( p(e | t) / p(e) ),   p(e | t) = n(e, t) / n(t),   p(e) = n(e) / N,

against all the information that e holds, IC(e) = -log p(e). The disclosure is
PMI / IC: 1 says that t occurs with e alone and gives it away. A term whose
disclosure reaches ``REMOVE`` is removed where e stands too, one that reaches
``GENERALISE`` is replaced by what kind of word it is. Only pairs that occur in
``SUPPORT`` different texts count, so that a text's chance words don't.

Nothing is lost by what isn't counted: an entity or a term of fewer than
``SUPPORT`` texts has no such pair, and a term of more than

    n(e) ^ GENERALISE * N ^ (1 - GENERALISE)

texts cannot reach the threshold, for n(e, t) <= n(e). Entities that stand in
the same texts tell the same and are counted as one, and so are terms: pairs
are made of such classes, by salt, and pre-aggregated, never of all entities
and words of a text. Texts are read where they lie. All steps are DataFrame
operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import fresh, staged
from changeflow.llm.spans import behind, found, listed, matches_in, merged, number_of, replaced, walked
from changeflow.operators.key_index import LANE_BITS, bit_at

SUPPORT = 3          # different texts in which a pair must occur
GENERALISE = 0.7
REMOVE = 0.9
MIN_TERM = 3         # shorter words give nothing away by themselves

# The base kinds in their order, with a form of each pattern that never backtracks far.
KINDS = ("email", "ip", "card", "phone")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# What the rest of the card pattern's digits look like at the least: no scan of shorter runs is walked through.
CARD_GATE = r"[0-9](?:[\x20-]?[0-9]){13}"
TERM = r"[\p{L}\p{N}]++"
LANES = 256          # of the bitmap that tells repeated texts
SALTS = 16           # parts into which the pairs of one text are dealt
PIECE = "struct<at:int,text:string,left:boolean,right:boolean>"


def _luhn(digits: Column) -> Column:
    """Whether a string of 14 to 19 digits passes the Luhn check."""
    turned = F.reverse(digits)
    places = F.sequence(F.lit(1), F.length(digits))

    def worth(i: Column) -> Column:
        d = F.substr(turned, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, F.lit(2)).otherwise(F.lit(1))
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(places, worth), F.lit(0), lambda s, x: s + x) % 10 == 0


def _card(x: Column) -> Column:
    digits = F.regexp_replace(x["match"], "[^0-9]", "")
    return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(F.lit(False))


def _ip(x: Column) -> Column:
    return F.forall(F.split(x["match"], r"\."), lambda p: p.rlike("^0*+(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})$"))


def _phone(x: Column) -> Column:
    return F.length(F.regexp_replace(x["match"], "[^0-9]", "")).between(10, 15)


def _matches(text: str) -> list[Column]:
    """Valid matches of each base kind."""
    c = F.col(text)
    return [found(text, EMAIL, gate=c.contains("@")), F.filter(found(text, IP), _ip),
            F.filter(found(text, CARD, gate=c.rlike(CARD_GATE)), _card), F.filter(found(text, PHONE, gate=c.contains("+")), _phone)]


def _base(rows: DataFrame) -> DataFrame:
    """``rows`` (with text) and ``entities``: base spans with what stands there."""
    names = [f"found_{k}" for k in KINDS]
    got = rows.withColumns(dict(zip(names, _matches("text"), strict=True)))

    def named(i: int) -> Column:
        return F.transform(names[i], lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(i).alias("rank"),
                                                        F.lit(KINDS[i]).alias("kind"), x["match"].alias("match")))

    each = [named(i) for i in range(len(KINDS))]
    return got.withColumn("entities", F.concat(*each)).drop(*names)


def _sorted(spans: Column) -> Column:
    return F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))))


def _apart(text: str, entities: str) -> Column:
    """What lies between the entities of a text, as pieces (at, text, left, right): whether an entity lies on that side."""
    spans = _sorted(F.col(entities))
    piece = lambda at, x, right: F.struct(at.alias("at"), x.alias("text"), (at > 0).alias("left"), right.alias("right"))
    between = walked(F.col(text), spans, lambda x, at, gap: piece(at, gap, F.lit(True)), PIECE)
    return F.concat(between, F.array(piece(*behind(F.col(text), spans), F.lit(False))))


def _whole(piece: Column, start: Column, end: Column) -> Column:
    """Whether a word of a piece touches no entity."""
    return ~(piece["left"] & (start == 0)) & ~(piece["right"] & (end == F.length(piece["text"])))


def _places(pieces: Column) -> Column:
    """(start, end, term) of the words that lie apart from entities."""
    def words(p: Column) -> Column:
        kept = F.filter(matches_in(p["text"], TERM), lambda m: _whole(p, m["start"], m["end"]) & (F.length(m["match"]) >= MIN_TERM))
        return F.transform(kept, lambda m: F.struct((m["start"] + p["at"]).alias("start"), (m["end"] + p["at"]).alias("end"), F.lower(m["match"]).alias("term")))

    return F.flatten(F.transform(pieces, words))


def _terms(pieces: Column) -> Column:
    """The different terms that lie apart from entities."""
    def words(p: Column) -> Column:
        left = F.when(p["left"], F.regexp_replace(p["text"], r"^[\p{L}\p{N}]++", "")).otherwise(p["text"])
        # The word at the end, if an entity follows: the last gap between words is empty.
        every = F.regexp_extract_all(left, F.lit(TERM), F.lit(0))
        cut = p["right"] & left.rlike(r"[\p{L}\p{N}]\z")
        return F.when(cut, F.slice(every, F.lit(1), F.greatest(F.size(every) - 1, F.lit(0)))).otherwise(every)

    every = F.transform(F.flatten(F.transform(pieces, words)), F.lower)
    return F.filter(F.array_distinct(every), lambda w: F.length(w) >= MIN_TERM)


def _classes(pairs: DataFrame, name: str) -> DataFrame:
    """(name, n, one, two): in how many texts it stands, and a digest of which; those that agree are one class."""
    return pairs.groupBy(name).agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("hash")).alias("one"),
                                   F.bit_xor(F.xxhash64(F.lit("two"), "hash")).alias("two")).filter(F.col("n") >= SUPPORT)


def _repeated(texts: DataFrame) -> tuple[DataFrame, Column]:
    """``texts`` and a test that holds for all rows whose text is there more than once, and for few others.

    The test is a bitmap of ``LANES`` rows of 4 KB whatever the corpus, and so
    is broadcast; were very many texts repeated, it would hold for more others.
    """
    lane, bit = F.pmod(F.xxhash64("hash"), F.lit(LANES)), F.pmod(F.xxhash64(F.lit("bit"), "hash"), F.lit(LANE_BITS))
    twice = texts.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1")
    lanes = twice.groupBy(lane.alias("lane")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    both = texts.withColumn("lane", lane).join(F.broadcast(lanes), "lane", "left")
    return both, F.coalesce(bit_at(F.col("bits"), bit), F.lit(False))


def _texts_with(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, of): different texts that hold each term.

    A text that is there once counts where it lies, so tasks hand on one number
    for a term; only of repeated texts do (term, hash) pairs travel, to count once.
    """
    rows, twice = _repeated(texts)
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))
    seen = rows.select(F.when(twice, F.col("hash")).alias("copied"), F.explode(words).alias("term")).join(terms, "term")
    each = seen.groupBy("term", "copied").agg(F.count("*").alias("n"))
    return each.groupBy("term").agg(F.sum(F.when(F.col("copied").isNull(), F.col("n")).otherwise(F.lit(1))).alias("of"))


def disclosures(texts: DataFrame) -> DataFrame | None:
    """(hash, term, disclosure): the terms that give an entity of their text away, None if there are none.

    ``texts`` has text, its entities and its hash; rows that repeat a text count once.
    """
    held = texts.filter(F.size("entities") > 0)
    names = F.array_distinct(F.transform("entities", lambda x: F.concat_ws(":", x["kind"], F.lower(x["match"]))))
    entities = staged(held.select("hash", F.explode(names).alias("entity")).distinct(), "pii-entities")
    shared = staged(_classes(entities, "entity"), "pii-shared")
    if shared.isEmpty():
        return None
    known = ("n", "one", "two")
    asked = staged(entities.join(shared, "entity").select("hash", F.struct(*known).alias("e")).distinct(), "pii-asked")
    near = held.join(asked.select("hash").distinct(), "hash", "left_semi")
    terms = staged(near.select("hash", F.explode(_terms(_apart("text", "entities"))).alias("term")).distinct(), "pii-terms")
    often = staged(_classes(terms, "term"), "pii-often")
    if often.isEmpty():
        return None
    often = staged(often.join(_texts_with(texts, often.select("term")), "term").select("term", F.struct(*known, "of").alias("t")), "pii-counts")
    total = texts.select("hash").distinct().count()
    told = F.least(F.col("both") / F.col("t.of"), F.lit(1.0))
    p = F.col("e.n") / F.lit(float(total))
    most = F.pow(F.col("e.n").cast("double"), F.lit(GENERALISE)) * total ** (1 - GENERALISE)
    salt = F.pmod(F.xxhash64("t"), F.lit(SALTS)).cast("int")
    left = asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    right = staged(terms.join(often, "term").select("hash", "t").distinct().withColumn("salt", salt), "pii-classes")
    together = left.join(right, ["hash", "salt"]).filter(F.col("t.of") <= most * (1 + 1e-9))
    pairs = (together.groupBy("e", "t").agg(F.count("*").alias("both")).filter(F.col("both") >= SUPPORT)
             .withColumn("disclosure", F.least(F.log(told / p) / F.greatest(-F.log(p), F.lit(1e-9)), F.lit(1.0)))
             .filter(F.col("disclosure") >= GENERALISE).select("e", "t", "disclosure"))
    pairs = staged(pairs, "pii-told")
    if pairs.isEmpty():
        return None
    by_text = together.join(pairs, ["e", "t"]).groupBy("hash", "t").agg(F.max("disclosure").alias("disclosure"))
    return by_text.join(terms.join(often, "term"), ["hash", "t"]).select("hash", "term", "disclosure")


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, entities, terms): one row for each row of ``docs``.

    ``entities`` are the base spans, ``terms`` the spans of terms that give an
    entity of their text away, with the greatest disclosure. Null and empty
    texts have none. Rows that repeat a text get the same spans and count once
    in the statistics. Ties don't arise: a span is kept for what it reaches. An
    empty table gives an empty one. Other columns are not read.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = _base(own).withColumn("hash", F.md5("text"))
    told = disclosures(texts)
    none = F.array().cast("array<struct<start:int,end:int,disclosure:double>>")
    if told is None:
        return texts.select("doc_id", "entities", none.alias("terms"))
    told = staged(told.groupBy("hash").agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("told")), "pii-by-text")
    places = F.filter(_places(_apart("text", "entities")), lambda w: F.map_contains_key("told", w["term"]))
    terms = F.array_sort(F.transform(places, lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"),
                                                               F.element_at("told", w["term"]).alias("disclosure"))))
    found_ = texts.filter(F.size("entities") > 0).join(told, "hash").select("hash", terms.alias("terms")).dropDuplicates(["hash"])
    # Texts without entities can have no terms: their own id spreads them over the join's tasks.
    key = F.when(F.size("entities") > 0, F.col("hash")).otherwise(F.concat(F.lit("-"), F.xxhash64("doc_id").cast("string")))
    rows = texts.select("doc_id", "entities", key.alias("hash"))
    return rows.join(staged(found_, "pii-spans"), "hash", "left").select("doc_id", "entities", F.coalesce("terms", none).alias("terms"))


def digest(got: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of their spans, and the list of all spans."""
    base = F.transform("entities", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["rank"].alias("rank"), x["kind"].alias("kind")))
    more = F.transform("terms", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(len(KINDS)).alias("rank"), F.lit("term").alias("kind")))
    every = got.select("doc_id", merged(base).alias("base"), merged(base, more).alias("every"))
    return every.select("doc_id", *[number_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("every")).alias("spans"))


def generalised(term: Column) -> Column:
    """What kind of word a term is."""
    return (F.when(term.rlike(r"^\p{N}+$"), "[NUMBER]").when(term.rlike(r"\p{N}"), "[CODE]")
            .when(term.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]"))


def sanitise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``text`` sanitised: entities by their kind in brackets, telling terms generalised or removed.

    Rows, other columns and null texts stay.
    """
    key = F.md5(F.coalesce(F.col(text), F.lit("")))
    got = find(docs.select(key.alias("doc_id"), F.col(text).alias("text")))
    got = got.filter((F.size("entities") > 0)).dropDuplicates(["doc_id"])
    base = F.transform("entities", lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end"), F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")).alias("kind")))
    more = F.transform("terms", lambda x: F.struct(x["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), x["end"].alias("end"),
                                                   F.when(x["disclosure"] >= REMOVE, F.lit("")).otherwise(F.lit("?")).alias("kind")))
    hashed, spans = fresh(docs, "hash", "spans")
    got = got.select(F.col("doc_id").alias(hashed), F.array_sort(F.concat(base, more)).alias(spans))
    both = docs.join(got, key == F.col(hashed), "left")
    by = lambda x: F.when(x["kind"] == "?", generalised(F.substr(F.col(text), x["start"] + 1, x["end"] - x["start"]))).otherwise(x["kind"])
    return both.withColumn(text, F.when(F.col(spans).isNotNull(), replaced(F.col(text), F.col(spans), by)).otherwise(F.col(text))).select(*docs.columns)
