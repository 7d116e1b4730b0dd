"""The registered queries of this subpackage against their SQL, and the pipeline's stages."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from changeflow.llm import packing, queries
from tests.llm import brute
from tests.llm.conftest import SF
from tests.oracle_compare import compare, duck


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    res = compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLE[name])
    assert res["cols_match"] and res["rows_spark"] == res["rows_oracle"] and res["values_match"], res


def test_pipeline_stages(spark, documents):
    """Each stage keeps what the one before kept, but for its own decisions."""
    docs, seen = documents, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        seen.append((name, docs))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == documents.columns
    known, unique, masked, mixed, packed = (d for _, d in seen)
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert known.count() >= 0.95 * documents.count()
    ids = [r["doc_id"] for r in known.collect()]
    prints = [(i, brute.fingerprint(texts[i])) for i in ids]
    want = {i for (i, _), c in zip(prints, brute.components(prints), strict=True) if i == c}
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted(want)
    assert masked.count() == unique.count()
    for r in masked.collect():
        assert not [s for s in brute.secrets(r["text"]) if s[2] == "access"]
        assert (r["text"] == texts[r["doc_id"]]) == (not brute.secrets(texts[r["doc_id"]]))
    assert {r["doc_id"] for r in mixed.collect()} <= want
    whole = packed.agg(F.sum("length")).first()[0]
    encoder = packing.Encoder(packing.tokenizer_path())
    assert whole == sum(len(encoder(r["text"] or "")) // 4 + 1 for r in mixed.collect())
    for _, d in seen:
        d.unpersist()


def test_entry_without_the_subpackage(tmp_path):
    """__spark_entry__ imports with the subpackage and the pipeline taken away."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(f"{root}/changeflow", tmp_path / "changeflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'cdc_parse' in q and 'pipeline' not in q and not [k for k in q if k.startswith('op')]"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})


def test_pii_terms_match_sql(spark):
    """A table in which terms do give entities away."""
    import random

    import duckdb

    from changeflow.llm import pii
    from tests.oracle_compare import canon

    filler = "the meeting is moved to the large room and everyone should bring notes about plans".split()
    rng = random.Random(5)
    near = [(i, " ".join(rng.sample(filler, 8)) + " contact Zyrkovia at boss@corp.com " + " ".join(rng.sample(filler, 8))) for i in range(6)]
    far = [(i, " ".join(rng.choices(filler, k=40)) + f" write to user{i}@mail.org or {i}.2.3.4 today +1 555 123 45{i:02d} 4111 1111 1111 1111") for i in range(6, 60)]
    # A name in a heading, far from the address; copies of one text by the hundred; a text's words that touch an entity.
    far += [(100 + i, "Wolkenstein reports " + " ".join(rng.choices(filler, k=30)) + " x1.2.3.4y far@away.net ok") for i in range(4)]
    far += [(200 + i, near[0][1]) for i in range(300)] + [(600 + i, f"{w} lone@some.org") for i, w in enumerate(filler[:3])]
    df = spark.createDataFrame([*near, *far, (3, "x"), (None, None), (7, "")], "doc_id long, text string")
    got = pii.digest(pii.find(df))
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    want = con.execute(queries.PII)
    cols = [d[0] for d in want.description]
    rows = canon([tuple(r) for r in got.collect()], got.columns)
    assert rows == canon(want.fetchall(), cols)
    told = {r["doc_id"]: [x for x in r["spans"].split(",") if x.startswith("term:")] for r in got.collect()}
    assert all(told[i] for i in (0, 1, 2, 4, 5)) and all(told[200 + i] == told[0] for i in range(300)) and not told[20]
    assert all("term:0:11" in told[100 + i] for i in range(4)) and not any(told[600 + i] for i in range(3))


def test_a_text_of_fifty_thousand_addresses(spark):
    from changeflow.llm import pii

    text = "".join(f"10.{i // 62500}.{i // 250 % 250}.{i % 250} " for i in range(50_000)) + "Wolkenstein"
    df = spark.createDataFrame([(i, f"{text} {i}") for i in range(3)] + [(9, "x"), (10, "y")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.digest(pii.find(df)).collect()}
    assert [got[i]["n_ip"] for i in (0, 1, 2, 9)] == [50_000] * 3 + [0]
    at = len(text) - 11
    assert all(f"term:{at}:{at + 11}" in got[i]["spans"] for i in range(3))
