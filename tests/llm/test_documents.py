"""Operators over documents against brute force, and on odd rows."""

import itertools
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from changeflow.llm import graph, lang_id, licenses, mixing, packing, pii, secrets, simhash
from tests.llm import brute
from tests.llm.conftest import ODD, rows_of


def test_fingerprints_and_components(documents, odd, none):
    for docs in (documents, odd):
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        prints = [(i, brute.fingerprint(t)) for i, t in rows]
        want = Counter((i, f"{p:016x}", c) for (i, p), c in zip(prints, brute.components(prints), strict=True))
        got = Counter(rows_of(simhash.simhash_groups(docs).select("doc_id", "fingerprint", "component_id")))
        assert got == want
    assert simhash.simhash_groups(none).count() == 0


def test_tiles_find_every_near_pair(spark):
    """Fingerprints around a few centres, split into tiny tiles."""
    rng = random.Random(3)
    prints = set()
    for _ in range(6):
        c = rng.getrandbits(64)
        prints |= {c ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 3))}) for _ in range(60)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    rows = [(i, p[0] % (1 << 64)) for i, p in enumerate(signed)]
    want = brute.components(rows)
    tile, simhash.TILE = simhash.TILE, 8
    try:
        df = spark.createDataFrame(signed, "fp long")
        got = {r["node"]: r["root"] for r in simhash.connected_components(simhash.near_links(df)).collect()}
    finally:
        simhash.TILE = tile
    groups, roots = defaultdict(set), defaultdict(set)
    for (p,), (i, _) in zip(signed, rows, strict=True):
        groups[want[i]].add(p)
        roots[got.get(p, p)].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, roots.values()))


def test_hot_keys_join_where_they_lie(spark):
    """Half of the rows share a key, and 1,500 keys are rare: the same rows as a plain join; the rows shuffled lack the hot key."""
    rows = spark.range(6000).selectExpr("if(id < 3000, -1, id % 1500) as k", "id", "'x' as n")
    known = spark.range(-1, 1500).selectExpr("id as k", "id * 2 as twice")
    got = graph.join_unique(rows, known, "k")
    assert got.columns == ["k", "id", "n", "twice"]
    assert Counter(rows_of(got)) == Counter(rows_of(rows.join(known, "k")))
    assert graph.join_unique(rows.limit(0), known, "k").count() == 0


def test_components_of_chains_and_stars(spark):
    """A long chain, a star and loose pairs, by structs with null parts."""
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(3000 + 2 * i, 3001 + 2 * i) for i in range(50)] + [(7, 7)]
    df = spark.createDataFrame(links, "x long, y long").select(
        *[F.struct(F.when(F.col(c) % 3 > 0, F.col(c) % 2).alias("p"), F.col(c).alias("q")).alias(c) for c in ("x", "y")])
    got = {r["node"]["q"]: tuple(r["root"]) for r in graph.connected_components(df, "x", "y").collect()}
    groups = [range(301), range(1000, 1200), *[(3000 + 2 * i, 3001 + 2 * i) for i in range(50)]]
    order = lambda q: (q % 3 > 0, q % 2 if q % 3 else 0, q)  # noqa: E731 - null parts come first
    want = {q: min(g, key=order) for g in groups for q in g}
    assert {q: r[1] for q, r in got.items()} == want


def test_keep_one_of_each_group(odd):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda x: (x is None, x))
    # 1 = 2 up to case; 3, 4, 5 and a null row have no words; 6, 6 and 7 are alike.
    assert ids == [1, 3, 6, 8, 9, 10, None]


def test_secrets(documents, odd, none):
    more = [(r.kind, r.pattern) for r in secrets.ADDED]
    hidden = "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1B2" * 9 + " xoxb-1234567890-abc postgres://me:hunter22@host " + "secret=" * 3
    for docs in (documents, odd, odd.withColumn("text", F.concat("text", F.lit(hidden)))):
        want = Counter()
        for r in docs.collect():
            found = brute.secrets(r["text"], more)
            kinds = Counter(k for _, _, k, _ in found)
            want[(r["doc_id"], *[kinds[k] for k in brute.SECRET_KINDS], *brute.spans_digest(found, 3))] += 1
        assert Counter(rows_of(secrets.digest(secrets.scan(docs)))) == want
    assert secrets.scan(none).count() == 0


@pytest.mark.parametrize("rule", secrets.RULES, ids=lambda r: r.kind)
def test_trigram_queries_are_mandatory(rule):
    """Strings that the pattern matches meet the query."""
    rng = random.Random(1)
    samples = {
        "assign": ['API_KEY = "abcdefgh"', "passwd:abcdefg", "Token=xyzxyz", "apikey='123456"], "access": ["AKIA" + "Z9" * 9],
        "private_key": ["-----BEGIN PRIVATE KEY-----", "-----BEGIN EC PRIVATE KEY-----"], "forge_token": ["ghs_" + "q" * 36],
        "chat_token": ["xoxp-" + "1" * 12], "cloud_key": ["AIza" + "x" * 35], "payment_key": ["rk_live_" + "7" * 16],
        "signed_token": ["eyJ" + "a" * 8 + ".eyJ" + "b" * 8 + "." + "c" * 8], "address_password": ["https://u:passw@h", "redis://u:passw@h"],
        "hex": ["".join(rng.choice("0123456789abcdef") for _ in range(30))]}
    query = secrets.trigram_query(rule.pattern)
    assert (not query) == (rule.kind == "hex")
    for s in samples[rule.kind]:
        assert re.search(rule.pattern, s)
        assert not query or any(all(t in s.lower() for t in q) for q in query)


def test_redact(odd):
    got = secrets.redact(odd)
    assert got.columns == odd.columns and got.count() == odd.count()
    text = {r["doc_id"]: r for r in got.filter("doc_id in (8, 9)").collect()}
    assert text[9]["text"].startswith('[ASSIGN]" and [ACCESS] aé😀') and text[9]["n_chars"] == len(text[9]["text"])
    assert text[8]["text"] == dict((r[0], r[1]) for r in ODD)[8]
    assert got.filter("doc_id = 3 and text is null").count() == 1


def test_pii(spark, documents, odd, none):
    adverse = [(100, "1" * 30_000, None, None), (101, "a." * 20_000 + "@b.cc", None, None), (102, "+1 " + "(" * 5000 + "+12345 67890", None, None),
               (103, "00255.1.1.0 256.1.1.1 1.1.1.1111111111111111111111", None, None), (104, "4111-1111-1111-1111 4111-1111-1111-1112", None, None)]
    docs = spark.createDataFrame([*ODD, *adverse], "doc_id long, text string, lang string, source string")
    for df in (documents, docs):
        want = Counter()
        for r in df.collect():
            found = brute.pii(r["text"])
            kinds = Counter(k for _, _, k, _ in found)
            want[(r["doc_id"], *[kinds[k] for k in pii.KINDS], brute.spans_digest(found, 4)[0])] += 1
        got = pii.digest(pii.find(df))
        assert Counter(rows_of(got.drop("spans"))) == want
        for r in got.collect():
            base = [s for s in r["spans"].split(",") if s and not s.startswith("term:")]
            assert len(base) == r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"]
    assert pii.find(none).count() == 0


def test_disclosing_terms(spark):
    """A name that stands by one address only gives it away; common words don't."""
    filler = "the meeting is moved to the large room and everyone should bring notes about plans".split()
    rng = random.Random(5)
    docs = [(i, " ".join(rng.sample(filler, 8)) + f" contact Zyrkovia at boss@corp{'' if i < 6 else i}.com " * (i < 12) + " ".join(rng.sample(filler, 8)), "en", "s")
            if i < 6 else (i, " ".join(rng.choices(filler, k=40)) + f" write to user{i}@mail.org today", "en", "s") for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.find(df)).collect()}
    text = {d[0]: d[1] for d in docs}
    for i in range(60):
        terms = {text[i][int(a):int(b)] for a, b in re.findall(r"term:(\d+):(\d+)", got[i])}
        assert ("Zyrkovia" in terms) == (i < 6)
        assert not terms & set(filler)
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert "Zyrkovia" not in clean[0] and "boss@" not in clean[0] and "[EMAIL]" in clean[0]
    assert clean[59] == text[59].replace("user59@mail.org", "[EMAIL]")


def test_pieces_and_packing(spark, documents, odd, none):
    tokenizer = packing.Encoder(packing.tokenizer_path()).tokenizer
    tokenizer.encode_special_tokens = False
    for docs in (documents, odd):
        want = Counter()
        for r in docs.collect():
            ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
            want.update((r["doc_id"], n, *p) for n, p in enumerate(brute.cut(ids, 1024)))
        got = rows_of(packing.pack(docs))
        assert Counter(r[:5] for r in got) == want
        placed = defaultdict(list)
        for r in got:
            placed[r[5]].append((r[6], r[3]))
        for parts in placed.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 1024
        lengths = [r[3] for r in got]
        assert len(placed) <= max(-(-sum(lengths) // 1024), sum(2 * n > 1024 for n in lengths)) * 1.02 + 1
    assert packing.pack(none).count() == 0


def test_plan_uses_exact_complements():
    plan = packing.plan_patterns({1000: 5, 24: 3, 14: 1, 10: 1, 7: 1, 8: 1, 9: 1, 500: 4, 524: 2})
    used = Counter()
    for pattern, n in plan:
        assert sum(pattern) <= 1024
        for x in pattern:
            used[x] += n
    assert used == Counter({1000: 5, 24: 3, 14: 1, 10: 1, 7: 1, 8: 1, 9: 1, 500: 4, 524: 2})
    assert ((1000, 24), 3) in plan and ((1000, 14, 10), 1) in plan and ((1000, 9, 8, 7), 1) in plan and ((524, 500), 2) in plan
    rng = random.Random(2)
    for _ in range(20):
        sizes = Counter(rng.randint(1, 1024) for _ in range(rng.randint(1, 400)))
        plan = packing.plan_patterns(dict(sizes))
        used = Counter()
        for pattern, n in plan:
            assert sum(pattern) <= 1024
            used.update({x: m * n for x, m in Counter(pattern).items()})
        assert used == sizes


def test_fast_encoder_gives_the_same_ids():
    path = packing.tokenizer_path()
    plain, fast = packing.Encoder(path), packing.Encoder(path, packing.tokenizer_path(packing.RANKS))
    chars = [bytes([i]).decode("cp1252") for i in range(256) if i not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
    rng = random.Random(4)
    texts = ["".join(rng.choices(chars, k=60)) for _ in range(1500)] + [a + b + "a" for a in chars for b in chars[::7]]
    texts += ["", " ", "\n\n x  y", "<|endoftext|>", "a<|endoftext|>b", "日本語 text", "ab" * 5000, " " * 5000 + "x"]
    assert all(plain(x) == fast(x) for x in texts)


def test_copies_hide_no_disclosing_term(spark):
    """One of the texts that give a name away stands a thousand times."""
    near = [(i, f"note {i}: contact Zyrkovia at boss@corp.com") for i in range(3)]
    far = [(10 + i, " ".join(f"w{i}x{j}" for j in range(50))) for i in range(200)]
    df = spark.createDataFrame(near + [(1000 + i, near[0][1]) for i in range(1000)] + far, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.find(df)).collect()}
    at = near[0][1].index("Zyrkovia")
    assert all(f"term:{at}:{at + 8}" in got[i] for i in (0, 1, 2, 1000, 1999))


def test_very_long_blank_runs_are_packed(spark):
    """A run that ends tiktoken's search goes through tokenizers."""
    texts = ["x" + " " * 2_000_000 + "a", "x" + "\n" * 2_000_000 + "a"]
    tokenizer = packing.Encoder(packing.tokenizer_path()).tokenizer
    got = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    want = Counter((i, n, *p) for i, t in enumerate(texts) for n, p in enumerate(brute.cut([*tokenizer.encode(t, add_special_tokens=False).ids, 2], 1024)))
    assert Counter(r[:5] for r in rows_of(got)) == want


def test_licenses(spark, documents, odd, none):
    cases = [(200, "Released under teh MIT licence!"), (201, "x Licensed under the Apach License,\nVersion 2.0. foo"),
             (202, "under the MIT license under the mit license"), (203, "CC-BY-NC, cc by ncc"), (204, "under the limit license plate")]
    docs = spark.createDataFrame([(i, t, None, None) for i, t in cases], "doc_id long, text string, lang string, source string")
    for df in (documents, odd, docs):
        texts = df.collect()
        want = Counter((r["doc_id"], *brute.licenses(r["text"], licenses.BASE)) for r in texts)
        got = licenses.scan(df)
        assert Counter(rows_of(got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"))) == want
        for r in got.collect():
            assert 0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
            assert r["score"] == 1 or not r["n_base"]
            assert (r["score"] > 0) == bool(r["labels"])
    found = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert found[200]["labels"] == "mit" and 0 < found[200]["score"] < 1
    text = cases[1][1]
    label, a, b, edits = found[201]["spans"].split(":")
    assert label == "apache-2" and edits == "1" and text[int(a):int(b)] == "Licensed under the Apach License,\nVersion 2.0"
    assert found[203]["base_labels"] == "cc-by-nc" and found[203]["n_base"] == 1
    assert licenses.scan(none).count() == 0


def test_notices_side_by_side_are_all_found():
    """Notices with different numbers of edits in one window, the best one at any place."""
    scanner = licenses.Scanner(licenses.BASE, licenses.NOTICES)
    forms = {"released under the mit license": 0, "releazed under the mit license": 1, "releazed undar the mit license": 2}
    for order in itertools.product(forms, repeat=4):
        _, near = scanner(f" {' '.join(order)} ")
        assert [x[3] for x in sorted(near)] == [forms[x] for x in order]


def test_fuzzy_search_misses_nothing(documents):
    """Every notice within its bound is found: pigeonhole seeds against a full edit-distance table."""
    rng = random.Random(7)
    scanner = licenses.Scanner(licenses.BASE, licenses.NOTICES)
    words = "lorem the license of and under version public terms by".split()
    for _ in range(150):
        notice, label = rng.choice(list(licenses.NOTICES.items()))
        chars = list(notice)
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(len(chars))
            rng.choice([lambda: chars.__setitem__(i, rng.choice("abc ")), lambda: chars.pop(i), lambda: chars.insert(i, rng.choice("xyz"))])()
        text = " ".join(words_ for words_ in (" " + " ".join(rng.choices(words, k=5)) + " " + "".join(chars) + " " + " ".join(rng.choices(words, k=5)) + " ").split())
        joined = f" {text} "
        _, near = scanner(joined)
        for n, lab in licenses.NOTICES.items():
            if brute.edits_within(joined, n, licenses.errors_for(n)):
                hit = [x for x in near if x[2] == lab]
                closer = [x for x in near if x[3] / x[4] <= licenses.errors_for(n) / len(n)]
                assert hit or closer, (n, text)


def test_mixing_budgets(spark, documents, odd, none):
    def weight(level, name):
        named, default = mixing.WEIGHTS[mixing.LEVELS[level]]
        return named.get(name, default)

    for docs, ratio in ((documents, 1.0), (documents, 0.3), (documents, 3.7), (odd, 1.0)):
        rows = mixing.plan(docs, budget_ratio=ratio).collect()
        assert len(rows) == docs.count()
        leaves, read, most = Counter(), Counter(), Counter()
        for r in rows:
            leaf = (r["domain"], r["lang"], r["source"])
            leaves[leaf] += r["tokens"]
            read[leaf] += r["tokens"] * r["epochs"]
            most[leaf] = max(most[leaf], r["tokens"])
            assert 0 <= r["epochs"] <= mixing.MAX_EPOCHS
        want = brute.budgets(leaves, weight, ratio, mixing.MAX_EPOCHS)
        for leaf, budget in want.items():
            # The prefix stops before the document that no longer fits.
            assert budget * (1 - 1e-9) - most[leaf] - 1 <= read[leaf] <= budget * (1 + 1e-9) + 1, (leaf, budget, read[leaf])
    assert mixing.plan(none).count() == 0


def test_mixing_prefix_is_seeded_and_rows_repeat(documents):
    a, b = (Counter(rows_of(mixing.plan(documents, seed=s))) for s in ("x", "x"))
    assert a == b and a != Counter(rows_of(mixing.plan(documents, seed="y")))
    plan = mixing.plan(documents).groupBy().agg(F.sum("epochs")).first()[0]
    out = mixing.mixed(documents)
    assert out.columns == documents.columns and out.count() == plan


def test_language_id_heldout(documents, odd, none):
    """Held-out accuracy: the declared language is hidden from half of the rows."""
    docs = documents.withColumn("shown", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    got = lang_id.identify(docs, "text", F.col("shown"), F.col("source"))
    hidden = got.filter("doc_id % 2 = 1 and length(text) >= 100").select("lang", "detected", "accepted").collect()
    assert sum(r["lang"] == r["detected"] for r in hidden) >= 0.95 * len(hidden)
    assert sum(r["accepted"] for r in hidden) >= 0.95 * len(hidden)
    rows = lang_id.identify(odd, "text", F.col("lang"), F.col("source"))
    assert rows.count() == len(ODD) and rows.columns[:len(odd.columns)] == odd.columns and rows.columns[-3:] == ["_detected", "confidence", "accepted"]
    assert rows.filter("text is null or trim(text) = ''").filter("accepted or _detected <> 'und'").count() == 0
    assert lang_id.identify(none, "text", F.col("lang"), F.col("source")).count() == 0
    kept = lang_id.keep_identified(odd)
    assert kept.columns == odd.columns


def test_language_evidence_decides_when_text_cannot(spark):
    """A short text of no language follows its host's and its markup's evidence."""
    de, en = "der hund und die katze gehen nach hause weil es regnet", "the dog and the cat are going home because of the rain"
    rows = [(i, de, "de", "http://a.example.de/x") for i in range(40)] + [(100 + i, en, "en", "http://b.example.com/x") for i in range(40)]
    rows += [(500, "zzxq", None, "http://a.example.de/y"), (501, "zzxq", None, "http://b.example.com/y"), (502, "zzxq", "de", None), (503, "zzxq", "en", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, url string")
    got = {r["doc_id"]: r["detected"] for r in lang_id.identify(df, "text", F.col("lang"), F.col("url")).collect() if r["doc_id"] >= 500}
    assert got == {500: "de", 501: "en", 502: "de", 503: "en"}


def test_rare_declared_languages_are_modelled(spark):
    """A language of 0.1 % of the rows is found, declared or not; one with too few rows to model keeps its documents."""
    en, de, fo = "the dog and the cat are going home because of the rain", "der hund und die katze gehen nach hause weil es regnet", "hundurin og kettan fara heim tí at tað regnar úti"
    rows = [(i, f"{en} {i}", "en", "http://a.com/x") for i in range(10_000)] + [(10_000 + i, f"{de} {i}", "de", "http://b.de/x") for i in range(9_980)]
    rows += [(20_000 + i, f"{fo} {i}", "fo" if i else None, "http://c.fo/x") for i in range(20)] + [(30_000, "sjálvandi kundi hann svimja væl", "xo", "http://d.xo/x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, url string")
    got = lang_id.identify(df, "text", F.col("lang"), F.col("url")).filter("doc_id >= 20000").collect()
    assert {(r["doc_id"] < 30_000, r["detected"], r["accepted"]) for r in got} == {(True, "fo", True), (False, "xo", True)}
    few = lang_id.identify(df.filter("doc_id >= 30000"), "text", F.col("lang"), F.col("url")).collect()
    assert [(r["detected"], r["accepted"]) for r in few] == [("xo", True)]
