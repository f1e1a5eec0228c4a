import hashlib
import re

from test_decontaminate import plain as plain_contamination
from test_pii import plain as plain_pii
from test_quality import plain as plain_quality
from test_simhash import plain_components, plain_fingerprint

import corpus_pipeline as P
from martflow.llm.mixing import poisson_table


def uniform(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2 ** 52


def test_stages_against_plain_versions(spark, sf_small):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    columns = spark.read.parquet(f"{sf_small}/documents.parquet").columns
    frame, out = spark.read.parquet(f"{sf_small}/documents.parquet"), {}
    for name, stage in P.STAGES:
        frame = P.written(stage(spark, frame, sf_small), name)
        out[name] = frame.collect()
        assert frame.columns[:len(columns)] == columns
    # no line is common enough here, so the base rules decide
    good = {i for i, d in docs.items() if not plain_quality(d.text)[-1]}
    assert sorted(r.doc_id for r in out["quality_rules"]) == sorted(good)
    fps = [(i, plain_fingerprint(docs[i].text)) for i in sorted(good)]
    one = set(plain_components(fps, 4))
    assert sorted(r.doc_id for r in out["near_dedup"]) == sorted(one) and len(one) < len(good)
    clean = {r[0] for r in plain_contamination([(i, docs[i].text) for i in one], items) if not r[-1]}
    assert sorted(r.doc_id for r in out["decontamination"]) == sorted(clean) and len(clean) < len(one)
    assert sorted(r.doc_id for r in out["pii"]) == sorted(clean)
    for r in out["pii"]:
        text = docs[r.doc_id].text
        assert not plain_pii(r.text) and r.n_chars == len(r.text)
        if not plain_pii(text) and "[" not in r.text:
            assert r.text == text
        assert len(re.findall(r"\[(?:EMAIL|IP|CARD|PHONE|IBAN|SSN|LOCAL_PHONE)\]", r.text)) <= len(re.findall(r"[0-9@]", text))
    size = {}
    for r in out["pii"]:
        size[r.source] = size.get(r.source, 0) + 1
    whole = sum(n ** 0.5 for n in size.values())
    want = {}
    for r in out["pii"]:
        rate = size[r.source] ** 0.5 / whole * len(clean) / size[r.source]
        assert rate <= 64
        want[r.doc_id] = sum(c <= uniform(f"mix|{r.doc_id}|1") for c in poisson_table(rate))
    got = {}
    for r in out["mixing"]:
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {i: n for i, n in want.items() if n}
    keys = [r.shuffle_key for r in out["mixing"]]
    assert set(keys) == {hashlib.md5(f"mix/order|{i}|{k}".encode()).hexdigest() for i, n in got.items() for k in range(1, n + 1)}


def test_stages_on_odd_tables(spark, sf_small):
    ddl = "doc_id long, text string, lang string, source string, n_chars long"
    empty = spark.createDataFrame([], ddl)
    odd = spark.createDataFrame([(1, None, None, None, None), (1, None, None, None, None), (None, "", "en", "s", 0)]
                                + [(2, "plain words " + " ".join(f"w{i}" for i in range(60)), "en", "s", 300)] * 2, ddl)
    for name, stage in P.STAGES:
        assert stage(spark, empty, sf_small).count() == 0
        out = stage(spark, odd, sf_small)
        assert out.columns[:5] == odd.columns
        rows = out.collect()
        if name == "quality_rules":
            assert [r.doc_id for r in rows] == [2, 2]
        if name == "near_dedup":  # the null and empty texts are one group; rows without an id stay
            assert sorted(r.doc_id or 0 for r in rows) == [0, 1, 2]
        if name in ("decontamination", "pii"):
            assert len(rows) == 5
