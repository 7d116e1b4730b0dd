"""Vector codes, token counts and spelling variants against plain versions, and on odd rows."""

import math
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from changeflow.llm import code_books, packing, spelling, token_counts
from tests.llm.conftest import SF
from tests.llm.brute import lower_ascii


# ---- vector codes

def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """[(vec_id, code, error)] and the final codebooks of vectors of one length, by looking at everything."""
    x = [[math.floor(Fraction(c) * scale) for c in v] for _, v in rows]
    cuts = code_books.part_slices(len(x[0]), parts)
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:entries]
    books = [[x[i][c] for i in first] for c in cuts]

    def nearest(v, book):
        far = [sum((a - b) ** 2 for a, b in zip(v, e)) for e in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p, c in enumerate(cuts):
            groups = {}
            for v in x:
                groups.setdefault(nearest(v[c], books[p])[0], []).append(v[c])
            books[p] = [[sum(col) // len(groups[e]) for col in zip(*groups[e])] if e in groups else old for e, old in enumerate(books[p])]
    out = []
    for (i, _), v in zip(rows, x):
        got = [nearest(v[c], books[p]) for p, c in enumerate(cuts)]
        out.append((i, bytes(a for a, _ in got).hex(), sum(e for _, e in got)))
    return out, books


def test_codes_match_plain_version(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want, books = plain_codes(rows)
    got = code_books.compress(df).collect()
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in got) == sorted(want)
    assert {r["codebooks_sha256"] for r in got} == {code_books._digest([np.array(b, object) for b in books])}
    labels = {r["vec_id"]: r["label"] for r in df.collect()}
    sums = Counter()
    for i, _, e in want:
        sums[labels[i]] += e
    assert all(r["label_error"] == sums[labels[r["vec_id"]]] for r in got)


def test_codes_of_odd_rows(spark):
    rng = random.Random(3)
    some = [(i, [rng.choice([0.0, 0.25, -0.5, 1.0]) for _ in range(16)]) for i in range(40)]  # ties everywhere
    huge = [(100 + i, [rng.uniform(-1e30, 1e30) for _ in range(9)]) for i in range(30)]
    odd = [(200, None), (201, [float("nan")] * 16), (202, [None] * 16), (203, [float("-inf")] + [0.0] * 15), (204, []), (None, some[3][1]), (5, some[5][1])]
    df = spark.createDataFrame([(*r, (r[0] or 0) % 2 if (r[0] or 0) % 3 else None, "x") for r in [*some, *huge, *odd]],
                               "vec_id long, embedding array<double>, label int, salt string")
    got = code_books.compress(df).collect()
    assert len(got) == 40 + 30 + 3
    a, _ = plain_codes([*some, odd[5], odd[6]])
    b, _ = plain_codes(huge)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    small = [(r["vec_id"], r["code"], r["error"]) for r in got if r["error"] is not None and r["vec_id"] != 204]
    assert sorted(small, key=key) == sorted(a, key=key)
    # Errors beyond a long are null; codes are exact all the same.
    assert sorted((r["vec_id"], r["code"]) for r in got if r["error"] is None) == sorted(x[:2] for x in b)
    assert [(r["code"], r["error"]) for r in got if r["vec_id"] == 204] == [("00" * 8, 0)]
    assert all(r["label_error"] is None for r in got)  # each label has such a row
    assert code_books.compress(df.limit(0)).count() == 0
    few = code_books.compress(df.filter("vec_id < 3")).collect()
    assert len(few) == 3 and all(r["error"] == 0 for r in few)  # each vector is an entry


def test_bounds_never_change_an_assignment_and_spare_scans():
    rng = np.random.default_rng(1)
    centre = rng.integers(-4000, 4000, (10, 64))
    x = (centre[rng.integers(0, 10, 3000)] + rng.integers(-300, 300, (3000, 64))).astype(float)
    history = [[x[:16, c] for c in code_books.part_slices(64, 8)]]
    bounds, tally = None, code_books.Rescans()
    for _ in range(7):
        bounds = code_books.assign(x, code_books.Carried(history), bounds, tally)
        for p, c in enumerate(code_books.part_slices(64, 8)):
            assert (bounds["code"][:, p] == code_books.squared(x[:, c], history[-1][p]).argmin(1)).all()
        sums = {(p, e): [int((bounds["code"][:, p] == e).sum()), *(int(s) for s in x[bounds["code"][:, p] == e][:, c].sum(0))]
                for p, c in enumerate(code_books.part_slices(64, 8)) for e in range(16) if (bounds["code"][:, p] == e).any()}
        history.append(code_books.moved_books(history, sums))
    assert tally.full < 0.7 * tally.seen


# ---- token counts

PATH = packing.tokenizer_path()


@pytest.fixture(scope="module")
def tokenizer():
    return packing.Encoder(PATH).tokenizer


def nasty(rng: random.Random, n: int) -> str:
    bits = ["word", " ", "  ", "\n", "\n\n \t", "don't", "'re", "'", "'ll've", "é", "漢字", "😀", "12345", "...", "<|endoftext|>", "<|endof", "|>", "x" * 40, " " * 30, " ", "ß", "=" * 20]
    out = []
    while sum(map(len, out)) < n:
        out.append(rng.choice(bits))
    return "".join(out)


def test_spliced_counts_match_whole_texts(spark, tokenizer):
    """Chunks of 64 with overlaps of 24: every kind of cut, and words longer than a chunk."""
    rng = random.Random(11)
    texts = [nasty(rng, rng.choice([10, 63, 64, 65, 130, 700, 3000])) for _ in range(300)]
    texts += ["y" * 5000, " " * 5000, "a " + "y" * 1000 + " b" * 500, "<|endoftext|>" * 300, "", None, "漢" * 900, "\n" * 77 + "z"]
    df = spark.createDataFrame([(i % 290, t, "k", 1) for i, t in enumerate(texts)], "doc_id long, text string, key string, piece int")
    got = token_counts.count_tokens(df, PATH, chunk=64, overlap=24).collect()
    want = [(i % 290, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts)]
    assert sorted((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == sorted(want)
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)


def test_token_counts_of_tables_and_odd_rows(spark, odd, none, documents, tokenizer):
    ranks = packing.tokenizer_path(packing.RANKS)
    for df in (odd, documents):
        got = token_counts.count_tokens(df, PATH, ranks).collect()
        want = [(r["doc_id"], len((r["text"] or "").encode()), len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids)) for r in df.collect()]
        key = lambda r: (r[0] is None, r[0] or 0, r[1:])
        assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got), key=key) == sorted(want, key=key)
    assert token_counts.count_tokens(none, PATH, ranks).count() == 0


def test_a_tokenizer_without_proof_is_not_spliced():
    assert token_counts.splices(PATH)
    assert not token_counts.splices(packing.tokenizer_path("word_bpe_49k.json"))


# ---- spelling variants

def plain_variants(docs, shortest=7, least=2, ratio=10):
    counts = Counter()
    for i, text in docs:
        run = ""
        for c in lower_ascii(text or "") + " ":
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
                continue
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            word = run[:h % len(run)] + run[h % len(run) + 1:] if run and h % 31 == 0 else run
            if len(word) >= shortest:
                counts[word] += 1
            run = ""
    words = {w: n for w, n in counts.items() if n >= least}
    by_gap = {}
    for w in words:
        for j in range(len(w)):
            by_gap.setdefault((j, w[:j] + w[j + 1:]), set()).add(w)
    near = {w: set() for w in words}
    for (_, gap), same in by_gap.items():
        for w in same:
            near[w] |= same - {w}
            if gap in words:
                near[w].add(gap)
                near[gap].add(w)
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), words[forms[w]] if forms[w] else None))
    return sorted(out)


def listed(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect())


def test_variants_match_plain_version(spark, documents, odd, none):
    for df in (documents, odd):
        assert listed(spelling.variants(df)) == plain_variants([(r["doc_id"], r["text"]) for r in df.collect()])
    assert spelling.variants(none).count() == 0


def test_variants_of_close_words_and_split_halves(spark):
    """Few letters, many errors, chains of forms, and halves that more words share than one index takes."""
    rng = random.Random(9)
    words = ["abababa", "ÀÿéÀÿéÀÿé", "MixedCase", "aaaaaaaa"]
    for _ in range(250):
        w = rng.choice(words)
        at = rng.randrange(len(w) + 1)
        words.append(rng.choice([w[:at] + rng.choice("ab") + w[at:], w[:at] + w[at + 1:], w[:at] + rng.choice("abé") + w[at + 1:]]))
    docs = [(i, ", ".join(rng.choices(words[:4], k=40) + rng.choices(words, k=12))) for i in range(400)]
    docs += [(None, "abababa " * 300), (7, "a" * 20_000 + " " + "a" * 20_000 + " " + "a" * 19_999)]
    df = spark.createDataFrame([(*d, "w", 1) for d in docs], "doc_id long, text string, word string, n int")
    want = plain_variants(docs)
    assert any(w[1] and w[1] != w[2] for w in want)
    assert listed(spelling.variants(df)) == want
    assert listed(spelling.variants(df, tile=5)) == want


# ---- language ID

def test_junk_languages_have_no_model_and_pages_are_identified(spark):
    from changeflow.llm import lang_id, queries

    rows = [(i, "the cat sat on the mat and looked at the dog in the garden", "en", "a.com") for i in range(30)]
    rows += [(100 + i, "der Hund und die Katze sind im Garten und sehen sich an", "de", "b.de") for i in range(30)]
    rows += [(200 + i, f"zzqx vvkp wwrj number {i}", f"junk{chr(97 + i % 20)}x", "c.org") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = lang_id.fit_text_model(df, "text", df["lang"], df["text"])
    assert model.languages == ["de", "en"] and model.others
    got = {r["doc_id"]: r["detected"] for r in lang_id.identify(df, "text", df["lang"], df["source"]).collect()}
    assert got[0] == "en" and got[100] == "de" and len(got) == 260
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = queries.pages_lang_id(spark, SF).collect()
    assert len(found) == pages.count()
    declared = {r["page_id"]: r["html"] for r in pages.collect()}
    import re
    named = [(r["detected"], m[1]) for r in found if (m := re.search(r'<html[^>]*lang="([a-z]+)', declared[r["page_id"]])) and r["accepted"]]
    assert not named or sum(a == b for a, b in named) >= 0.9 * len(named)
